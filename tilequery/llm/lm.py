"""Language-model scores from a weighted backoff automaton.

States are the words before a word, at most ``order - 1``; an arc is an n-gram of the training rows. A state h that was
seen c(h) times gives word w, from which the state h' without h's first word gives p(w | h'), the probability

    (c(h w) + STRENGTH * p(w | h')) / (c(h) + STRENGTH)

which is the weight of the arc where the n-gram exists, and without it (c = 0) the weight of h's failure arc times
that of h'. A state that was never seen fails with weight 1. Every state's probabilities sum to one. The lowest state is the
base model of single words. A text's score adds up the log-probabilities of its words from left to right, its end included; the
state before each word follows from the words alone, so a task takes the steps of all its texts side by side.

Every n-gram of the training rows is in the model, at any input size. The model is not held anywhere as a whole: rows are
packed into chunks; each chunk asks, by ranges of 64-bit keys, how often its distinct n-grams occur in training, and brings its own
counts along; each range sums them and answers the chunks. What moves is pre-aggregated, so a frequent n-gram has one row for
each chunk at most, and its range is no larger than others. (Two of a billion n-grams share a key with a chance of 3 %.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import chunk_texts, chunked, crc32_mod, from_planes, mixed, planes, range_bits, squeezed, unsqueezed, word_hashes, written

ORDER, STRENGTH = 3, 2.0
END = mixed(np.array([0x9E3779B97F4A7C15], np.uint64))[0]
#: Bits of a key that go with it into its range, next to those that name the range.
_REST = 48
_PIECE = 900_000


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text and its end, as keys in order; tokens of each text."""
    keys, sizes, at = [], [], 0
    while at < len(texts):
        size, to = len(texts[at]), at + 1
        while to < len(texts) and size + len(texts[to]) <= _PIECE:
            size, to = size + len(texts[to]), to + 1
        text, word = word_hashes(texts[at:to])
        n = np.bincount(text, minlength=to - at) + 1
        out = np.full(int(n.sum()), END)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(n) - 1] = False
        out[inside] = word
        keys.append(out)
        sizes.append(n)
        at = to
    return np.concatenate(keys), np.concatenate(sizes)


class Grams:
    """The n-grams of some texts: by order from 1, ``keys`` of the distinct ones (sorted) and where each place's is among them.

    ``places[n - 1]`` tells which tokens end an n-gram of n words: one end token stands before each text, so there are
    n-grams of n words from the (n - 1)th token on.
    """

    def __init__(self, texts: list[bytes], order: int) -> None:
        words, self.sizes = _words(texts)
        before = np.arange(len(words)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.keys, self.which, self.places = [], [], []
        gram = words
        for n in range(1, order + 1):
            if n > 1:
                history = np.roll(gram, 1)
                if n == 2:
                    history[before == 0] = END
                gram = mixed(mixed(history) + words)
            places = np.flatnonzero(before >= n - 2)
            keys, which = np.unique(gram[places], return_inverse=True)
            self.keys.append(keys)
            self.which.append(which)
            self.places.append(places)

    def by_range(self, n: int, bits: int) -> np.ndarray:
        """Where the keys of each range begin, and the end."""
        return np.searchsorted(self.keys[n] >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def _asks(chunks: DataFrame, bits: int, order: int) -> DataFrame:
    """``(range, chunk, keys, n, counts)``: the distinct n-grams of each chunk, and how often its training rows have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = Grams(chunk_texts(row), order)
                learn = np.repeat(np.frombuffer(row["flags"], np.uint8), grams.sizes)
                for n in range(order):
                    counts = np.bincount(grams.which[n], learn[grams.places[n]], len(grams.keys[n])).astype("<u4")
                    rest = (grams.keys[n] << np.uint64(bits)) >> np.uint64(64 - _REST)
                    cuts = grams.by_range(n, bits)
                    some = np.flatnonzero(np.diff(cuts)).tolist()
                    spans = [(cuts[r], cuts[r + 1]) for r in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n << bits | r for r in some], pa.int32()), pa.array([row["chunk"]] * len(some), pa.int64()), pa.array([planes(rest[s:e]) for s, e in spans], pa.binary())]
                        + [pa.array([int(e - s) for s, e in spans], pa.int64()), pa.array([squeezed(counts[s:e]) for s, e in spans], pa.binary())],
                        ["range", "chunk", "keys", "n", "counts"],
                    )

    return chunks.select("chunk", "flags", "sizes", "bytes", "text").mapInArrow(run, "range int, chunk long, keys binary, n long, counts binary")


def _answer(table: pa.Table) -> pa.Table:
    """``(chunk, range, n, counts, types, tokens)``: the counts over all chunks; types and tokens of the range stand in its first row."""
    n = table.column("n").to_pylist()
    keys = from_planes(table.column("keys"), "<u8")
    counts = np.concatenate([unsqueezed(x, k, "<u4") for x, k in zip(table.column("counts").to_pylist(), n, strict=True)]).astype(np.int64)
    order = np.argsort(keys)
    new = np.r_[True, keys[order[1:]] != keys[order[:-1]]]
    group = np.cumsum(new) - 1
    total = np.bincount(group, counts[order])
    whole = np.empty(len(keys), "<u8")
    whole[order] = total[group].astype(np.uint64)
    cuts = np.cumsum([0, *n]).tolist()
    first = [1] + [0] * (len(n) - 1)
    return pa.table({
        "chunk": table.column("chunk"), "range": table.column("range"), "n": table.column("n"), "counts": pa.array([squeezed(whole[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
        "types": pa.array([k * int((total > 0).sum()) for k in first], pa.int64()), "tokens": pa.array([k * int(total.sum()) for k in first], pa.int64()),
    })


class Automaton:
    """States, arcs and failure arcs for the n-grams of some texts.

    An n-gram that training has is the arc of its last word from the state of the words before; below the highest order it is a state too. State 0 has no
    words. ``arcs[n, i]`` is the arc that token i could take from a state of n words, the last number (never seen) where there is none.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, types: int, strength: float) -> None:
        order, sizes = len(counts), [len(k) for k in grams.keys]
        offset = np.r_[0, np.cumsum(sizes)]
        none, length = int(offset[-1]), len(grams.which[0])
        count = np.concatenate([*[c.astype(float) for c in counts], [0.0]])
        self.seen = count > 0
        self.arcs = np.full((order, length), none, np.int64)
        for n in range(order):
            self.arcs[n, grams.places[n]] = offset[n] + grams.which[n]
        #: Before a text stands an end token, seen as often as the one after it.
        self.begin = int(self.arcs[0, grams.sizes[0] - 1]) if length else none
        z = tokens + 0.5 * (types + 1)
        p = np.full(none + 1, 0.5 / z)
        p[: sizes[0]] = (count[: sizes[0]] + 0.5) / z
        after, fail = np.zeros(none + 1, np.int64), np.zeros(none + 1, np.int64)
        starts = np.cumsum(grams.sizes) - grams.sizes
        for n in range(order):
            own = np.arange(offset[n], offset[n + 1])
            if n:
                place = np.empty(sizes[n], np.int64)
                place[grams.which[n]] = grams.places[n]
                shorter = self.arcs[n - 1, place]  # without the first word; what training has, it has without a word too
                history = self.arcs[n - 1, np.maximum(place - 1, 0)]
                if n == 1:
                    history[np.isin(place, starts)] = self.begin
                p[own] = (count[own] + strength * p[shorter]) / (count[history] + strength)
            after[own] = own + 1 if n < order - 1 else shorter + 1 if n else 0
            if 0 < n < order - 1:
                fail[own + 1] = shorter + 1
        self.weight, self.after, self.fail = np.log10(p), after, fail
        self.words = np.r_[0, np.repeat(np.arange(1, order), sizes[: order - 1])]  # of each state
        self.loss = np.r_[0.0, np.log10(strength / (count[: len(self.words) - 1] + strength))]

    def read(self, sizes: np.ndarray, piece: int = 256) -> np.ndarray:
        """log10 probability of each token, the texts read from left to right."""
        order = len(self.arcs)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        text, k = ranges(np.zeros(len(sizes), np.int64), -(-sizes // piece))
        first = starts[text] + k * piece
        last = np.minimum(first + piece, ends[text])
        at = np.maximum(first - (order - 1), starts[text])
        begin = self.begin + 1 if order > 1 and self.seen[self.begin] else 0
        state = np.where(at == starts[text], begin, 0)
        out = np.zeros(self.arcs.shape[1])
        while len(at):
            arc = self.arcs[self.words[state], at]
            for _ in range(order):
                lost = np.flatnonzero(~self.seen[arc] & (state > 0))
                if not len(lost):
                    break
                own = lost[at[lost] >= first[lost]]  # each token is read for its score once
                out[at[own]] += self.loss[state[own]]
                state[lost] = self.fail[state[lost]]
                arc[lost] = self.arcs[self.words[state[lost]], at[lost]]
            own = at >= first
            out[at[own]] += self.weight[arc[own]]
            state = np.where(self.seen[arc], self.after[arc], 0)
            at = at + 1
            if (at == last).any():
                go = at < last
                at, state, first, last = at[go], state[go], first[go], last[go]
        return out


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, value) of all whole numbers in the half-open ranges."""
    n = end - start
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[which]


def text_scores(grams: Grams, counts: list[np.ndarray], tokens: int, types: int, strength: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known tokens, base score, score) of each text, given how often training has the distinct n-grams."""
    text = np.repeat(np.arange(len(grams.sizes)), grams.sizes)
    seen = counts[0][grams.which[0]].astype(float)
    base = np.log10((seen + 0.5) / (tokens + 0.5 * (types + 1)))
    whole = Automaton(grams, counts, tokens, types, strength).read(grams.sizes)
    return tuple(np.bincount(text, x, len(grams.sizes)) for x in (seen > 0, base, whole))


def score(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)`` for every row, by the model of the rows where ``learn`` is true.

    Words are runs of characters that are not ASCII white space, A-Z in lower case; each text ends with one end token. Null and
    empty texts are one end token; a null ``learn`` is false. Every row counts for itself, repeated rows and ids too. Without
    training rows every word has the same probability of one. An empty table gives no rows. Other columns play no part.
    """
    chunks = chunked(df.select(id_col, text_col, F.coalesce(learn, F.lit(False)).alias("_learn")), id_col, text_col, "_learn")
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    bits = range_bits(df, size // 6)
    kind = "chunk long, range int, n long, counts binary, types long, tokens long"
    answers = written(_asks(chunks, bits, order).groupBy("range").applyInArrow(_answer, kind), "answers")
    types, tokens = (int(x or 0) for x in answers.filter(F.col("range") < 1 << bits).agg(F.sum("types"), F.sum("tokens")).first())
    numbers = ["n_tokens", "n_known", "train_tokens"]
    schema = T.StructType([df.schema[id_col], *[T.StructField(c, T.LongType()) for c in numbers], *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]])

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        grams = Grams(chunk_texts(row), order)
        found: list[list[np.ndarray]] = [[] for _ in range(order)]
        for r, n, packed in sorted(zip(*[answers.column(c).to_pylist() for c in ("range", "n", "counts")], strict=True)):
            found[r >> bits].append(unsqueezed(packed, n, "<u8"))
        counts = [np.concatenate([np.zeros(0, "<u8"), *x]) for x in found]
        known, base, whole = text_scores(grams, counts, tokens, types, strength)
        ids = rows.column("ids").combine_chunks().flatten()
        return pa.Table.from_arrays([ids, pa.array(grams.sizes.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array([tokens] * len(ids), pa.int64()), pa.array(base), pa.array(whole)], schema.names)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, schema)


def op2_lm_score(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document, then ``per_token`` (score by token) and ``gain`` (what the states before a word
    add to the base score, by token). Edge rows as in :func:`score`; a null id counts as empty text in the crc32."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score(docs, crc32_mod("doc_id", 5) != 1)
    per_token, gain = F.col("score") / F.col("n_tokens"), (F.col("score") - F.col("base_score")) / F.col("n_tokens")
    return out.select("doc_id", (crc32_mod("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", per_token.alias("per_token"), gain.alias("gain"))
