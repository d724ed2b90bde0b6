"""Token files, spelling variants, clusters, and near-equal windows, against brute force; edge rows included."""

from __future__ import annotations

import glob
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tilequery.llm import clusters, lm, quotes, spelling, suffix, token_files

SF = "/root/testdata/sf0.001"
JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_encoder(library):
    """White space of all kinds, signs, digits, scripts, special strings, and random mixtures."""
    own = token_files.Encoder(JSON, P.PATTERN)
    odd = ["", " ", "\n", "\n\n a", "a  b", "a   b\n \n c ", " a", "a ", "it's 's don't 12 34.5", "x\x0by z", "\x1c a \x1d", "<|endoftext|> a<|endoftext|>", "日本語 テキスト", "é à ü ß", "👍🏽 ok", "a\r\nb\tc", "a\n\n\nb", "²³ ½ x²", "ª º aª", "Ͱx", "word," * 3, "a" * 300 + " " + "b" * 300]
    draw = random.Random(1)
    odd += ["".join(draw.choice(" \n\t'sabcé1٣ªß.-日 ²́ЖΩ") for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    for t in odd:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == library(t), repr(t)


@pytest.fixture(scope="module")
def texts(spark):
    """Documents, nulls, an empty and a very long text, a repeated row and id, and a column whose name the operators use."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(None, "no id"), (9001, None), (9002, ""), (9003, " ".join(f"w{i}" for i in range(30000))), (9004, "one two"), (9004, "one two"), (9004, "three"), (-5, "first")]
    return spark.createDataFrame([(*r, 7, 1.5) for r in rows], "doc_id long, text string, part int, ids double").repartition(5).cache()


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, texts, library, tmp_path, encoding):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(token_files.encoded(texts, JSON, P.PATTERN), path, encoding, row_group=1 << 16, page_rows=20)
    want = {}
    for r in texts.collect():
        want.setdefault(r.doc_id, Counter())[tuple(library(r.text or "")) + (0,)] += 1
    stored = spark.read.parquet(path)
    got = token_files.with_starts(stored, "doc_id", "n_tokens", "ids").orderBy("start").collect()
    assert [r.doc_id for r in got] == [d for d in sorted(want, key=lambda d: (d is not None, d or 0)) for _ in range(want[d].total())]
    assert [r.start for r in got] == np.cumsum([0, *(len(r.ids) for r in got)])[:-1].tolist() and all(r.n_tokens == len(r.ids) for r in got)
    for d, ids in want.items():
        assert Counter(tuple(r.ids) for r in got if r.doc_id == d) == ids
    digest = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.digests(stored).collect()}
    assert digest == {(r.doc_id, r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}
    stream = [i for r in got for i in r.ids]
    for start, n in [(0, 1), (1000, 5000), (len(stream) - 3, 10), (0, len(stream)), (17, 0), (len(stream) + 5, 4)]:
        piece = sorted(token_files.read_window(spark, path, start, n).collect(), key=lambda r: r.start)
        assert [i for r in piece for i in r.ids] == stream[start : start + n] and (not piece or piece[0].start == start)
    assert sorted(r.doc_id for r in token_files.read_documents(spark, path, [3, 9004]).collect()) == [3, 9004, 9004, 9004]
    # What was written: several row groups, an index of pages for each column, and the encoding asked for.
    metas = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*.parquet")]
    assert max(m.num_row_groups for m in metas) > 1
    columns = [m.row_group(0).column(i) for m in metas if m.num_rows for i in range(m.num_columns)]
    assert all(c.has_column_index and c.has_offset_index for c in columns)
    ids = [c.encodings for c in columns if c.path_in_schema.startswith("ids.")]
    assert all(("RLE_DICTIONARY" in e) == (encoding == "dictionary") and ("DELTA_BINARY_PACKED" in e) == (encoding == "delta") for e in ids)
    plan = token_files.read_documents(spark, path, [3])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,3)]" in plan or "In(doc_id" in plan
    lengths = token_files.part_starts(stored)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<part:int,n_tokens:bigint>" in lengths


def test_token_files_of_nothing(spark, texts, tmp_path):
    token_files.write_tokens(token_files.encoded(texts.limit(0), JSON, P.PATTERN), str(tmp_path / "none"))
    stored = spark.read.schema("part int, before long, doc_id long, n_tokens long, ids array<int>").parquet(str(tmp_path / "none"))
    assert token_files.digests(stored).collect() == []
    with pytest.raises(ValueError, match="dictionary or delta"):
        token_files.write_tokens(texts, str(tmp_path / "x"), "plain")


def noisy(rows):
    out = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return out


def groups(n):
    """(form, root, near words) of each word of ``n`` by trying every edit."""
    letters = sorted({c for w in n for c in w})
    near, form = {}, {}
    for w in n:
        tried = {w[:i] + c + w[j:] for i in range(len(w) + 1) for j in (i, i + 1) if j <= len(w) for c in ["", *letters]} - {w}
        near[w] = tried & n.keys()
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (n[w], form.get(w), n.get(form.get(w)), root(w), len(near[w])) for w in n}


def test_spelling_of_documents(spark, texts):
    rows = [(r.doc_id, r.text) for r in texts.collect()]
    counts = noisy(rows)
    got = {r.word: tuple(r)[1:] for r in spelling.spelling_variants(texts).select("word", "n", "form", "form_n", "root", "n_near").collect()}
    assert got == groups({w: k for w, k in counts.items() if k >= 3 and len(w) >= 5})
    assert {r.word: r.n for r in spelling.noisy_words(texts).groupBy("word").sum("n").toDF("word", "n").collect()} == counts
    assert spelling.spelling_variants(texts.limit(0)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_of_words(spark, seed, monkeypatch):
    """Few letters, so that nearly all words are near others: repeats of letters, short words, words around the depth of the trie, long chains of forms."""
    monkeypatch.setattr(spelling, "DEEPEST", 9)
    draw = random.Random(seed)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 7))) for _ in range(250)}
    for size in (8, 9, 10, 11, 40):
        base = "".join(draw.choice("abÿ÷") for _ in range(size))
        words |= {base, base[1:], base[:-1], base + "a", "b" + base, "a" * size, *(base[:i] + draw.choice("xab") + base[i + 1 :] for i in range(size))}
    n = {w: draw.choice([1, 2, 3, 8, 17, 40, 100]) for w in words}
    n |= {"chain"[: i + 1] + "z" * 3: 3**i for i in range(5)}
    got = {r.word: tuple(r)[1:] for r in spelling.group_spellings(spark.createDataFrame(list(n.items()), "word string, n long")).select("word", "n", "form", "form_n", "root", "n_near").collect()}
    assert got == groups(n)


def brute_clusters(rows, k, rounds, seed):
    """k-means with Python's whole numbers; rows of (id, list)."""
    import hashlib

    name = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i, _ in rows]
    v = [[int(np.floor(64 * float(x))) for x in e] for _, e in rows]
    c = [v[i] for i in sorted(range(len(rows)), key=lambda i: (name[i], v[i]))[:k]]

    def assign():
        return [min(((sum((x - y) ** 2 for x, y in zip(p, m, strict=True)), j) for j, m in enumerate(c)), default=None) for p in v]

    for _ in range(rounds):
        own = assign()
        for j in range(len(c)):
            members = [p for p, (_, a) in zip(v, own, strict=True) if a == j]
            if members:
                c[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return sorted((i, a, d) for (i, _), (d, a) in zip(rows, assign(), strict=True)), c


@pytest.mark.parametrize("spread", [0.001, 0.1, 1.0, 1000.0])
def test_clusters(spark, spread):
    """Tight and loose groups, ties, repeated rows, and vectors that are left out."""
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + spread * draw.normal(size=8)).astype(np.float32).tolist()) for i in range(240)] + [(500, [0.5] * 8), (500, [0.5] * 8), (501, [-0.0] * 8)]
    bad = [(600, None), (601, [1.0] * 7), (602, [1.0] * 7 + [None]), (603, [float("nan")] * 8), (604, [float("inf")] + [0.0] * 7), (605, [])]
    df = spark.createDataFrame([(*r, 3, 2.0) for r in rows + bad], "vec_id long, embedding array<float>, cluster int, v double").repartition(4)
    out, centroids, scanned = clusters.cluster(df, size=8, k=6, rounds=5)
    want, c = brute_clusters(rows, 6, 5, 1)
    assert sorted(map(tuple, out.collect())) == want and centroids.tolist() == c
    assert scanned[0] == len(rows) and len(scanned) == 6
    if spread == 0.001:
        assert scanned[-1] < len(rows) / 4


def test_clusters_of_few(spark):
    schema = "vec_id long, embedding array<double>"
    out, centroids, _ = clusters.cluster(spark.createDataFrame([(None, [1.0, 2.0]), (4, [3.0, -1.0])], schema), size=2)
    assert len(centroids) == 2 and sorted(r.distance for r in out.collect()) == [0, 0]
    out, centroids, _ = clusters.cluster(spark.createDataFrame([(1, None)], schema), size=2)
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance"] and len(centroids) == 0
    with pytest.raises(Exception, match="component too large"):
        clusters.cluster(spark.createDataFrame([(1, [1e30, 0.0])], schema), size=2)


def test_approach_bounds_every_vector():
    """No vector of a sphere comes nearer to a moved centroid than the bound says, and the bound is below the drift where the sphere is off the axis."""
    draw = np.random.default_rng(3)
    below = 0
    for _ in range(300):
        old = draw.normal(size=(4, 3)) * 10
        new = old + draw.normal(size=(4, 3)) * draw.choice([0.0, 0.1, 3.0])
        radius = draw.uniform(0, 6, 4)
        bound, drift = clusters.approach(old, new, radius), np.sqrt(((new - old) ** 2).sum(1))
        assert (bound <= drift[None] + 1e-9).all()
        below += (bound < 0.9 * drift[None]).sum()
        for i in range(4):
            x = draw.normal(size=(200, 3))
            x = old[i] + x / np.linalg.norm(x, axis=1, keepdims=True) * radius[i] * draw.uniform(0, 1, (200, 1)) ** 0.3
            gain = np.linalg.norm(x[:, None] - old[None], axis=2) - np.linalg.norm(x[:, None] - new[None], axis=2)
            assert (gain <= bound[i] + 1e-9).all()
    assert below > 500


def test_near_equal_windows_stay(spark):
    """Windows of 50 bytes that differ from another in one to three bytes, in all places, also in steps that cancel in a linear rank: only true repeats go."""
    draw = random.Random(5)
    base = "abcdefgaijklmnoaqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWX"
    rows = {base, base[:7] + "m" + base[8:15] + "e" + base[16:]}
    while len(rows) < 10_000:
        w = list(base if draw.random() < 0.7 else "".join(draw.choice("ab") for _ in range(50)))
        for _ in range(draw.randint(1, 3)):
            w[draw.randrange(50)] = draw.choice("abcdefghijklmnopqrstuvwxyz ")
        rows.add("".join(w))
    df = spark.createDataFrame(list(enumerate(sorted(rows))) + [(20_000, base)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix.drop_repeats(df).collect()}
    assert got.pop(20_000) == 50 and set(got.values()) == {0} and len(got) == len(rows)


def test_counts_beyond_32_bits():
    """A range adds up what chunks count, also above 2**32."""
    keys, counts = np.array([5, 9], "<u8"), np.array([4_000_000_000, 1], "<u4")
    asked = pa.table({"range": [3] * 3, "chunk": [1, 2, 3], "keys": [lm.planes(keys)] * 3, "n": [2] * 3, "counts": [lm.squeezed(counts)] * 3})
    told = lm._answer(asked)
    assert all(lm.unsqueezed(c, 2, "<u8").tolist() == [12_000_000_000, 3] for c in told.column("counts").to_pylist())
    assert sum(told.column("tokens").to_pylist()) == 12_000_000_003 and sum(told.column("types").to_pylist()) == 2


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_automaton_step_by_step(order):
    """Each token's probability by following arcs one text at a time, and pieces of any length read as whole texts do."""
    draw = random.Random(order)
    texts = [" ".join(draw.choice("abcdef") for _ in range(draw.choice([0, 1, 3, 40]))) for _ in range(30)]
    train = [[*t.split(), ""] for t in texts[:20]]
    seen = Counter()
    for t in train:
        line = ["", *t]
        for n in range(1, order + 1):
            for i in range(1, len(line)):
                if i - n + 1 >= 0:
                    seen[tuple(line[i - n + 1 : i + 1])] += 1
    tokens, types = sum(map(len, train)), len({w for t in train for w in t})

    def p(history, word):
        if not history:
            return (seen[(word,)] + 0.5) / (tokens + 0.5 * (types + 1))
        return (seen[(*history, word)] + 2.0 * p(history[1:], word)) / (seen[history] + 2.0)

    grams = lm.Grams([t.encode() for t in texts], order)
    own = lm.Grams([t.encode() for t in texts[:20]], order)
    counts = [np.array([dict(zip(own.keys[n].tolist(), np.bincount(own.which[n]).tolist(), strict=True)).get(k, 0) for k in grams.keys[n].tolist()], "<u8") for n in range(order)]
    automaton = lm.Automaton(grams, counts, tokens, types, 2.0)
    want = [np.log10(p(tuple(["", *t.split(), ""][max(0, i - order + 2) : i + 1]) if order > 1 else (), [*t.split(), ""][i])) for t in texts for i in range(len(t.split()) + 1)]
    for piece in (1, 2, 7, 256):
        assert automaton.read(grams.sizes, piece) == pytest.approx(np.array(want), rel=1e-9)


def test_lines_that_quote_nothing_stay(spark):
    """Comparisons and redirections; but not what an attribution introduces, nor old levels below a quote that links."""
    texts = ["Set x to > 3.\n> 5 is more than 4\nend", "$ ls\n> out.txt", "Ann wrote:\n> long lost words\nyes", "the original words", "> > older words\n> the original words\nreply", "> the original words\nok\n\n> a > b\nso"]
    df = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string")
    got = {r.turn: (r.body, r.n_linked, r.n_unlinked) for r in quotes.link_quotes(df).collect()}
    assert got == {0: (texts[0], 0, 1), 1: (texts[1], 0, 1), 2: ("yes", 0, 1), 3: (texts[3], 0, 0), 4: ("reply", 1, 1), 5: ("ok\n\n> a > b\nso", 1, 1)}
