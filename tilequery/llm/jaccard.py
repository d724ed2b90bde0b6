"""Jaccard self-join on word n-grams by vertical partitioning.

The global order of n-grams is the order of their hashes. It is cut into K fragments. Two sets whose
Jaccard similarity reaches the threshold differ in at most H elements, so at least K - H of their
fragments are equal; K exceeds H by a quarter. Documents that share a fragment's contents are candidates, and
only documents stay that share as many fragments as a linked pair must; no linked pair is missed.

A sketch of each set, the parity of its elements in a number of buckets, never says that two sets differ
more than they do: candidates that it keeps apart are dropped. For the rest the order is cut again;
partial overlaps are counted fragment by fragment and summed for each pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import broadcast_if_small, components, discard, from_planes, mixed, pack_ranges, planes, range_bits, runs, small_batches, unpack, utf8, word_hashes, written

#: Fragments in which the overlaps of candidate pairs are counted, and pairs of a document that one task group holds.
FRAGMENTS, GROUP = 4, 500
#: Documents and bytes of sketches in a block of those that are compared around a centre.
BLOCK, BLOCK_BYTES = 1024, 8 << 20
#: Fragments that meet in one group, about. Of one set in ``PROBE`` (by its digest) the fragments are counted beforehand: a range
#: of hashes that gets over four times as many is dealt out in parts. That decides how the work is cut, not what is found.
MOST, PROBE = 1 << 20, 16
_BATCH = 900_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct word n-grams of each text, sorted by both.

    A text with fewer words than ``words`` has its whole sequence as its one n-gram; one without words has none.
    """
    text, word = word_hashes(texts)
    n = np.bincount(text, minlength=len(texts))
    if len(word) >= words:
        h = np.zeros(len(word) - words + 1, np.uint64)
        for i in range(words):
            h = mixed(h + _STEP) + word[i : len(word) - words + 1 + i]
        inside = text[: len(h)] == text[words - 1 :]
        h, owner = mixed(h)[inside], text[: len(h)][inside]
    else:
        h, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        at = np.searchsorted(text, short)
        whole = n[short].astype(np.uint64)
        for i in range(words - 1):
            there = n[short] > i
            whole[there] = mixed(whole[there] * _STEP) + word[at[there] + i]
        h, owner = np.r_[h, mixed(whole + np.uint64(1))], np.r_[owner, short]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = runs(owner, h)
    return owner[keep], h[keep]


@lru_cache(maxsize=8)
def _classes(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size of each size class, and for each class H and how many fragments its sets are cut into.

    A set's partner is in its own class or a neighbour's: classes grow by 100 / percent.
    """
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(bounds[-1] * 100 // percent + 1)
    largest = [b - 1 for b in bounds[1:]]
    differ = [2 * s * (100 - percent) // (100 + percent) for s in largest]
    return np.array(bounds[:-1]), np.array(differ), np.array([h + 2 + h // 4 for h in differ])


def fragments(owner: np.ndarray, h: np.ndarray, percent: int, up: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set number, key) of the fragments of the sets, cut as their size class is (``up`` 1: the next larger), and by set
    number the sets that occur, how many keys they have, and how many a linked set has too.

    Two linked sets share a class, and in it at least K - H of K fragments are equal. Empty
    fragments say nothing and are left out, unless a set has so many that they could be
    all that two sets share: then it gives them too, and so does the other, which has as many.
    """
    bounds, differ, pieces = _classes(percent)
    start = runs(owner)
    size = np.diff(np.r_[start, len(owner)])
    own_class = np.searchsorted(bounds, size, side="right") - 1 + up
    k, d = pieces[own_class], differ[own_class]
    useful = d > 0  # sets of a class without H are linked only if they are equal
    piece = ((h >> np.uint64(32)) * np.repeat(k, size).astype(np.uint64)) >> np.uint64(32)
    at = runs(owner, piece)
    which = np.searchsorted(start, at, side="right") - 1
    content = np.add.reduceat(mixed(h ^ _STEP), at) if len(at) else h
    seed = own_class.astype(np.uint64) << np.uint64(40)
    key = mixed(content + mixed(seed[which] + piece[at]))
    use = useful[which]
    out_owner, out_key = [owner[at][use]], [key[use]]
    filled = np.bincount(which, minlength=len(start))
    need = filled - d
    for i in np.flatnonzero(useful & (need < 1)).tolist():
        rest = np.setdiff1d(np.arange(k[i], dtype=np.uint64), piece[at][which == i])
        out_owner.append(np.full(len(rest), owner[start[i]]))
        out_key.append(mixed(mixed(seed[i] + rest)))
    keys = np.where(useful, np.where(need < 1, k, filled), 0)
    return np.concatenate(out_owner), np.concatenate(out_key), owner[start], keys, np.maximum(need, 1)


def parity(h: np.ndarray) -> np.ndarray:
    """The sketch of a set as 64-bit numbers: whether the elements of each bucket are odd in number.

    Buckets are a power of two, four for each element at least. Every element that is in one of two sets only changes one
    bit, so the bits that differ are at most as many as these elements. Halves put together by XOR are the sketch of half the buckets.
    """
    buckets = max(64, 1 << (4 * len(h) - 1).bit_length())
    odd = np.bincount(((h >> np.uint64(8)) & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows) folded to so many 64-bit numbers."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def set_digests(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Set numbers that occur, sizes, and a 128-bit digest of each set."""
    start = runs(owner)
    ends = np.r_[start[1:], len(owner)][: len(start)].tolist()
    return owner[start], np.diff(np.r_[start, len(owner)]), [hashlib.blake2b(h[s:e].tobytes(), digest_size=16).digest() for s, e in zip(start.tolist(), ends, strict=True)]


def _node(digest: bytes) -> int:
    """Stands for a document whose id several rows carry: such an id may have several sets."""
    return int.from_bytes(digest[:8], "little", signed=True)


_UP = (0, 1)


def _described(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, own, sketch, probe, keys0, need0, keys1, need1)`` for every row; no digest, own (see ``_node``) and
    sketch where the set is empty. ``probe``, for one set in ``PROBE``: the upper 32 bits of the keys of its fragments."""
    counts = [f"{c}{u}" for u in _UP for c in ("keys", "need")]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("own", T.LongType()), T.StructField("sketch", T.BinaryType()), T.StructField("probe", T.ArrayType(T.IntegerType())), *[T.StructField(c, T.IntegerType()) for c in counts]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH):
            owner, h = shingle_sets(utf8(batch.column("text")), words)
            which, size, digest = set_digests(owner, h)
            n, d, s = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows, [None] * batch.num_rows
            n[which] = size
            ends = np.cumsum(size).tolist()
            for i, x, e, m in zip(which.tolist(), digest, ends, size.tolist(), strict=True):
                d[i], s[i] = x, parity(h[e - m : e]).tobytes()
            own = [x and _node(x) for x in d]
            probe = [[] if x is not None and x % PROBE == 0 else None for x in own]
            asked = np.array([x is not None for x in probe], bool)
            numbers = []
            for u in _UP:
                holder, key, sets, keys, need = fragments(owner, h, percent, u)
                for i, k in zip(holder[asked[holder]].tolist(), (key[asked[holder]] >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist(), strict=True):
                    probe[i].append(k)
                for x in (keys, need):
                    whole = np.zeros(batch.num_rows, np.int32)
                    whole[sets] = x
                    numbers.append(pa.array(whole))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(d, pa.binary()), pa.array(own, pa.int64()), pa.array(s, pa.binary()), pa.array(probe, pa.list_(pa.int32())), *numbers], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _hot_ranges(nodes: DataFrame, bits: int) -> DataFrame:
    """``(range, salts)``, written: the ranges of hashes that hold many more fragments than others, and in how many parts they are dealt out."""
    found = nodes.select(F.explode("probe").alias("k")).groupBy(F.shiftrightunsigned("k", 32 - bits).alias("range")).agg((F.count("*") * PROBE).alias("n"))
    return written(found.filter(F.col("n") > 4 * MOST).select("range", F.ceil(F.col("n") / MOST).cast("int").alias("salts")), "hot")


def _dealt(packed: DataFrame, hot: DataFrame) -> DataFrame:
    """``packed`` with ``salts`` (null where the range is not hot) and ``salt``, the part of a hot range that a row goes to."""
    rows = packed.join(broadcast_if_small(hot), "range", "left")
    return rows.withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("keys", "nodes"), F.col("salts"))).cast("int"))


def _shared_keys(docs: DataFrame, hot: DataFrame, words: int, percent: int, bits: int) -> DataFrame:
    """``(key, node, up)``, written: the fragments of ``docs (doc_id, text, several)`` that several documents have alike.

    The fragments of a range meet in one group. Those of a hot range meet in several, which say only
    what they hold; documents of each fragment are counted afterwards.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH):
            owner, h = shingle_sets(utf8(batch.column("text")), words)
            nodes = _nodes(batch, owner, h)
            parts = [fragments(owner, h, percent, u)[:2] for u in _UP]
            own, keys = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            up = np.repeat(np.array(_UP, np.uint8), [len(p[0]) for p in parts])
            rows = pack_ranges(bits, keys, up=up, nodes=nodes[own])
            packed = [planes(np.frombuffer(x, "<i8")) for x in rows.column("nodes").to_pylist()]
            yield rows.set_column(rows.schema.get_field_index("nodes"), "nodes", pa.array(packed, pa.binary()))

    def meet(table: pa.Table) -> pa.Table:
        keys, nodes, up = unpack(table.column("keys"), "<u4"), from_planes(table.column("nodes"), "<i8"), unpack(table.column("up"), "u1")
        order = np.lexsort((nodes, keys))
        keys, nodes, up = keys[order], nodes[order], up[order]
        keep = runs(keys, nodes)
        keys, nodes, up = keys[keep], nodes[keep], up[keep]
        start = runs(keys)
        many = np.repeat(np.diff(np.r_[start, len(keys)]) > 1, np.diff(np.r_[start, len(keys)])) if len(keys) else np.zeros(0, bool)
        part = table.column("salts")[0].as_py() is not None
        many |= part
        whole = (np.int64(table.column("range")[0].as_py()) << 32) | keys[many].astype(np.int64)
        return pa.table({"key": whole, "node": nodes[many], "up": up[many].astype(np.int32), "part": np.full(len(whole), part)})

    packed = docs.filter("doc_id IS NOT NULL").mapInArrow(cut, "range int, keys binary, up binary, nodes binary")
    if hot.isEmpty():
        rows = packed.withColumn("salts", F.lit(None).cast("int"))
        return written(rows.groupBy("range").applyInArrow(meet, "key long, node long, up int, part boolean").drop("part"), "keys")
    met = written(_dealt(packed, hot).groupBy("range", "salt").applyInArrow(meet, "key long, node long, up int, part boolean"), "met")
    parts = met.filter("part").select("key", "node", "up").distinct()
    several = parts.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key")
    keys = written(met.filter("NOT part").select("key", "node", "up").unionByName(parts.join(several, "key", "left_semi")), "keys")
    discard(met)
    return keys


def _nodes(batch: pa.RecordBatch, owner: np.ndarray, h: np.ndarray) -> np.ndarray:
    """By row the node: the id, or what stands for the set where several rows carry the id."""
    nodes = np.array(batch.column("doc_id").to_pylist(), np.int64)
    several = np.flatnonzero(np.array(batch.column("several").to_pylist(), bool))
    for i in several.tolist():
        s, e = np.searchsorted(owner, (i, i + 1))
        nodes[i] = _node(hashlib.blake2b(h[s:e].tobytes(), digest_size=16).digest())
    return nodes


def _sets(docs: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """``(id, n, piece, part)``: the sets of the documents that some pair needs, cut into fragments of the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH):
            owner, h = shingle_sets(utf8(batch.column("text")), words)
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            rows: list[list] = [[], [], [], []]
            for i, node in enumerate(_nodes(batch, owner, h).tolist()):
                own = h[cut[i] : cut[i + 1]]
                piece = np.searchsorted(own >> np.uint64(62), np.arange(FRAGMENTS + 1, dtype=np.uint64))
                for p in range(FRAGMENTS):
                    for column, x in zip(rows, (node, len(own), p, own[piece[p] : piece[p + 1]].astype("<u8").tobytes()), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["id", "n", "piece", "part"])

    needed = broadcast_if_small(needed.select(F.col("id").alias("doc_id")).distinct())
    wanted = docs.filter("NOT several").join(needed, "doc_id", "left_semi").unionByName(docs.filter("several"))
    found = wanted.filter("doc_id IS NOT NULL").mapInArrow(run, "id long, n long, piece int, part binary")
    return found.dropDuplicates(["id", "piece"])


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the written pairs ``(a, b)`` whose sets reach the similarity.

    A document's pairs are dealt out in groups of about ``GROUP``, each fragment for itself; the elements that two sets share
    are counted in each fragment and summed for each pair.
    """
    sets = written(_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")), words), "sets")
    salted = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("m")), "a")
    salted = written(salted.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("m") / GROUP)).alias("salt")), "salted")
    columns = ["a", "salt", "piece", "b", "n", "part"]
    members = broadcast_if_small(salted).join(sets, F.col("b") == F.col("id")).select(*columns)
    centres = broadcast_if_small(salted.select("a", "salt").distinct()).join(sets, F.col("a") == F.col("id")).withColumn("b", F.lit(None).cast("long")).select(*columns)

    def overlaps(table: pa.Table) -> pa.Table:
        b, n, parts = (table.column(c).to_pylist() for c in ("b", "n", "part"))
        at = b.index(None)
        centre = np.frombuffer(parts[at], "<u8")
        rows = [i for i, x in enumerate(b) if x is not None]
        lengths = np.array([len(parts[i]) // 8 for i in rows], np.int64)
        flat = np.frombuffer(b"".join([parts[i] for i in rows]), "<u8")
        hit = np.zeros(len(flat) + 1, np.int64)
        if len(centre):
            np.cumsum(centre[np.minimum(np.searchsorted(centre, flat), len(centre) - 1)] == flat, out=hit[1:])
        ends = np.cumsum(lengths)
        values = ([table.column("a")[0].as_py()] * len(rows), [b[i] for i in rows], [n[at] + n[i] for i in rows], hit[ends] - hit[ends - lengths])
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("a", "b", "total", "shared"), values, strict=True)})

    counted = members.unionByName(centres).groupBy("a", "salt", "piece").applyInArrow(overlaps, "a long, b long, total long, shared long")
    summed = counted.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("total").alias("total"))
    out = written(summed.filter(f"100 * shared >= {percent} * (total - shared)").select("a", "b"), "linked")
    discard(sets, salted)
    return out


def _may_link(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``(a, b)`` that the sketches do not keep apart."""
    other = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(other, "b").join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
    both = both.filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = ([np.frombuffer(x, "<u8")[None] for x in batch.column(c).to_pylist()] for c in ("sa", "sb"))
            words = [min(x.shape[1], y.shape[1]) for x, y in zip(sa, sb, strict=True)]
            apart = np.array([int(np.bitwise_count(folded(x, w) ^ folded(y, w)).sum()) for x, y, w in zip(sa, sb, words, strict=True)], np.int64)
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            keep = pa.array((100 + percent) * apart <= (100 - percent) * total)
            yield batch.select(["a", "b"]).filter(keep)

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def _apart_around(held: DataFrame, nodes: DataFrame, found: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs ``(a, b)`` of documents that share a fragment, that are in different components and that the sketches do not keep apart.

    ``held`` is ``(key, centre, node)``. Only keys whose documents are in several components count; two documents of one
    key share its centre. Around each centre the documents outside the largest component are compared with
    all, in blocks. ``forest`` gives only the pairs, nearest first, that join components within a pair of blocks.
    """
    member = held.join(found, F.col("node") == F.col("id"), "left").select("key", "centre", "node", F.coalesce("component", "node").alias("component"))
    member = written(member, "member")
    still_open = member.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    around = written(member.join(still_open, "key", "left_semi").select("centre", "node", "component").distinct(), "around")
    discard(member)
    sized = around.groupBy("centre", "component").agg(F.count("*").alias("m"))
    most = sized.groupBy("centre").agg(F.max(F.struct("m", "component")).alias("most"), F.sum("m").alias("m")).select("centre", F.col("most.component").alias("main"), F.col("most.m").alias("mains"), "m")
    rows = around.join(most, "centre").join(nodes.select("node", "n", "sketch"), "node").withColumn("other", F.col("component") != F.col("main"))
    rows = rows.withColumn("bytes", F.octet_length("sketch") * F.col("m"))
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("bytes") / BLOCK_BYTES))
    others = F.greatest(F.lit(1), F.ceil(blocks * (F.col("m") - F.col("mains")) / F.col("m")))
    # Sketches of one centre's documents differ in size: the block number must not depend on a document's own.
    plan = written(rows.groupBy("centre").agg(F.max(blocks).cast("long").alias("blocks"), F.max(others).cast("long").alias("others")), "plan")
    rows = rows.select("centre", "node", "component", "n", "sketch", "other").join(broadcast_if_small(plan), "centre")
    left = rows.filter("other").select("centre", F.pmod(F.xxhash64("node"), F.col("others")).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("asks"), "node", "component", "n", "sketch")
    right = rows.select("centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("i"), F.pmod(F.xxhash64("node"), F.col("blocks")).alias("j"), F.lit(False).alias("asks"), "node", "component", "n", "sketch")

    def compare(table: pa.Table) -> pa.Table:
        asks, node, component, n = (table.column(c).to_numpy() for c in ("asks", "node", "component", "n"))
        raw = table.column("sketch").to_pylist()
        words = np.array([len(x) // 8 for x in raw])
        pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        asking = [(w, np.flatnonzero(asks & (words == w))) for w in np.unique(words[asks]).tolist()]
        given = [(w, np.flatnonzero(~asks & (words == w))) for w in np.unique(words[~asks]).tolist()]
        for wx, x in asking:
            for wy, y in given:
                if max(wx, wy) > 2 * min(wx, wy):
                    continue  # such sizes are never similar
                sx, sy = (folded(np.frombuffer(b"".join([raw[i] for i in own]), "<u8").reshape(len(own), -1), min(wx, wy)) for own in (x, y))
                for i, s in zip(x.tolist(), sx, strict=True):
                    distance = np.bitwise_count(sy ^ s).sum(1, dtype=np.int64)
                    total = n[y] + n[i]
                    hit = (component[y] != component[i]) & ((100 + percent) * distance <= (100 - percent) * total) & (100 * np.minimum(n[y], n[i]) >= percent * np.maximum(n[y], n[i]))
                    if hit.any():
                        pairs.append((np.full(int(hit.sum()), i), y[hit], distance[hit] / total[hit]))
        if not pairs:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        p, q, share = (np.concatenate(c) for c in zip(*pairs, strict=True))
        if forest:
            root = {c: c for c in component.tolist()}

            def find(k: int) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            keep = []
            for k in np.argsort(share, kind="stable").tolist():
                u, v = find(int(component[p[k]])), find(int(component[q[k]]))
                if u != v:
                    root[max(u, v)] = min(u, v)
                    keep.append(k)
            p, q = p[keep], q[keep]
        return pa.table({"a": np.minimum(node[p], node[q]), "b": np.maximum(node[p], node[q])})

    out = written(left.unionByName(right).groupBy("centre", "i", "j").applyInArrow(compare, "a long, b long").distinct(), "apart")
    discard(around, plan)
    return out


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row: the smallest id that links reach, the document's own included.

    Two documents link where ``100 * |A and B| >= percent * |A or B|`` of their distinct word n-grams.
    Of equal sets one document is compared. The documents that share a fragment are first compared with one of
    them, its centre: the one that has most fragments in common with others. Where that leaves several components
    around a centre, all pairs between components that the sketches leave are verified, those first that would join most.

    A null id links with nothing and has no component; empty and null texts link with
    nothing; rows that repeat an id count as one document, whatever their texts; other columns play no part. An
    empty table gives an empty result. Ids are whole numbers.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    described = written(_described(docs, words, percent), "described")
    repeated = written(described.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    any_repeated = not repeated.isEmpty()
    flagged = broadcast_if_small(repeated).withColumn("several", F.lit(True)) if any_repeated else None

    def with_flag(rows: DataFrame) -> DataFrame:
        return rows.join(flagged, "doc_id", "left").fillna(False, ["several"]) if any_repeated else rows.withColumn("several", F.lit(False))

    named = with_flag(described.filter("doc_id IS NOT NULL"))
    named = named.withColumn("node", F.when(F.col("several") & F.col("own").isNotNull(), F.col("own")).otherwise(F.col("doc_id")))
    same = named.filter("digest IS NOT NULL")
    same = same.join(same.groupBy("digest").agg(F.min("node").alias("b")), "digest").select(F.col("node").alias("a"), "b", "doc_id", "several").filter("a <> b")
    same = written(same, "same")
    equal = same.select("a", "b")
    if any_repeated:
        rows = named.filter("several AND digest IS NOT NULL")
        equal = equal.unionByName(rows.join(rows.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b").filter("a <> b"))
    # Of equal sets one stands for all. An id that several rows carry is left in: they may differ.
    docs = with_flag(docs.filter("doc_id IS NOT NULL")).join(broadcast_if_small(same.filter("NOT several").select("doc_id").distinct()), "doc_id", "left_anti").select("doc_id", "text", "several")
    nodes = named.filter("digest IS NOT NULL").join(equal.select(F.col("a").alias("node")).distinct(), "node", "left_anti") if not any_repeated else named.filter("digest IS NOT NULL").dropDuplicates(["node"])
    nodes = nodes.withColumn("n", F.col("n_shingles"))

    total = described.agg(F.sum(F.col("keys0") + F.col("keys1"))).first()[0] or 0
    bits = range_bits(df, total, MOST)
    hot = _hot_ranges(nodes, bits)
    keys = _shared_keys(docs, hot, words, percent, bits)
    discard(hot)
    # A linked set has as many keys in common as the class demands: documents with fewer shared keys cannot be linked.
    asked = nodes.select("node", F.expr("stack(2, 0, keys0, need0, 1, keys1, need1) AS (up, have, need)"))
    enough = keys.groupBy("node", "up").agg(F.count("*").alias("shared")).join(asked, ["node", "up"]).filter("shared >= need").select("node", "up", (F.col("have") - F.col("shared")).alias("alone"))
    held = keys.join(enough, ["node", "up"]).select("key", "node", "alone")
    centre = held.groupBy("key").agg(F.min(F.struct("alone", "node")).alias("c"), F.count("*").alias("m")).filter("m > 1").select("key", F.col("c.node").alias("centre"))
    held = written(held.join(centre, "key").select("key", "centre", "node"), "held")
    discard(keys)

    pairs = held.select(F.col("centre").alias("a"), F.col("node").alias("b")).filter("a <> b").distinct()
    near = written(_may_link(pairs, nodes, percent), "near")
    links = written(equal.unionByName(verified(near, docs, words, percent)), "links")
    found = components(links)
    for forest in (True, False):
        apart = _apart_around(held, nodes, found, percent, forest)
        if apart.isEmpty():
            continue
        late = verified(apart, docs, words, percent)
        if not late.isEmpty():
            links = written(links.unionByName(late), "links")
            found = components(links)
    discard(held, near)
    if any_repeated:
        ids = named.join(found, F.col("node") == F.col("id"), "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
        least = ids.groupBy("component").agg(F.min("doc_id").alias("least"))
        found = ids.join(least, "component").groupBy("doc_id").agg(F.min("least").alias("component")).withColumnRenamed("doc_id", "id")
    out = described.join(found, F.col("doc_id") == F.col("id"), "left")
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document: four words, 85 percent; edge rows as in :func:`near_duplicates`."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4, percent=85)
