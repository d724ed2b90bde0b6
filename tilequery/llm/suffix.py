"""Repeated substrings across documents, by distributed prefix doubling.

The rank of a position at length h + d comes from the pair of ranks at h of the position and of the one d further on.
Ranks double inside a task as long as nearly every position shares its rank with others anyway, to ``START`` bytes. From there on
each round brings equal ranks together in Spark: positions are sorted by rank in ranges of ranks, those whose rank no other
document has are dropped, and the next round ranks the pairs of what is left, up to the full length.

Texts are packed into chunks in the order of their ids, so that chunks compare as their documents do. A chunk sends its distinct
ranks, sorted, to their ranges, and gets a bit for each of them back. Rounds before the last only drop positions, so short ranks do: two ranks that look the same
keep a position too long and lose nothing. The last round decides: there a rank of 64 bits goes with 32 bits of a second hash, which is
taken from the string's bytes and not from ranks. Bytes are spread before the first pair is ranked, so strings that differ in a few bytes are no likelier to
look the same than others: 1e13 different strings that come as far as the last round (most of them are dropped before) hold a pair that does with a chance of 1e-3.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import broadcast_if_small, chunk_texts, chunked, mixed, range_bits, squeezed, unsqueezed, written

#: Bytes of the first rank that leaves a task, where ``length`` allows.
START = 32
_CHUNK = 2 << 20
#: Positions whose ranks are worked out together, so that what is needed on the way stays small.
_SLICE = 1 << 15
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rank of a pair of ranks, which must be spread over 64 bits: of plain bytes, two differences could cancel."""
    out = np.empty(len(x), np.uint64)
    for s in range(0, len(x), _SLICE):
        z = x[s : s + _SLICE] * _A + y[s : s + _SLICE]
        z ^= z >> np.uint64(29)
        z *= _B
        z ^= z >> np.uint64(32)
        out[s : s + len(z)] = z
    return out


def lengths(length: int) -> list[int]:
    """The lengths at which ranks are compared: a power of two, doubled, and ``length`` itself."""
    if length < 9:
        raise ValueError("length must be at least 9")
    out = [min(START, 1 << ((length - 1).bit_length() - 1))]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


def first_ranks(raw: bytes, length: int) -> np.ndarray:
    """Ranks of all positions at ``length``, a power of two from 8 on: eight bytes are their own rank, spread one to one, then ranks double."""
    n = len(raw)
    if n < length:
        return np.zeros(0, np.uint64)
    words, rank, h = np.ndarray((n - 7,), "<u8", raw, strides=(1,)), np.empty(n - 7, np.uint64), 8
    for s in range(0, n - 7, _SLICE):
        rank[s : s + _SLICE] = mixed(words[s : s + _SLICE])
    while h < length:
        rank, h = _pair(rank[:-h], rank[h:]), 2 * h
    return rank


def second_hash(raw: bytes, at: np.ndarray, length: int) -> np.ndarray:
    """32 bits of the ``length`` bytes from each position on, eight at a time; no ranks go into it."""
    found = np.empty(len(at), np.uint32)
    words = np.ndarray((max(0, len(raw) - 7),), "<u8", raw, strides=(1,))
    for s in range(0, len(at), _SLICE):
        own = at[s : s + _SLICE]
        out = np.full(len(own), length, np.uint64)
        for offset in [*range(0, length - 8, 8), length - 8]:
            out = mixed((out ^ words[own + offset]) + _C)
        found[s : s + len(own)] = out >> np.uint64(32)
    return found


class Positions:
    """The positions of a chunk that are still in question, and their ranks; ``rounds`` are answered one by one."""

    def __init__(self, row: dict, length: int, bits: int, width: int) -> None:
        self.texts = chunk_texts(row)
        self.length, self.rounds, self.bits, self.width = length, lengths(length), bits, width
        self.raw = b"".join(self.texts)
        n = len(self.raw)
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.ends = np.cumsum(self.sizes)
        self.doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.ids = np.array([0 if i is None else i for i in row["ids"]], np.int64)
        named = np.array([i is not None for i in row["ids"]], bool)
        self.to_end = np.repeat(np.where(named, self.ends, 0), self.sizes) - np.arange(n)
        self.rank = first_ranks(self.raw, self.rounds[0])
        self.at = np.flatnonzero(self.to_end[: len(self.rank)] >= self.rounds[0])
        self.rank = self.rank[self.at]
        self.check = None
        self.round = 0
        self._group()

    def _group(self) -> None:
        """Sort the positions by rank: ``order``, where each rank's positions begin, and the distinct ranks."""
        if self.round == len(self.rounds) - 1:
            self.order = np.argsort(self.rank)
            rank, check = self.rank[self.order], self.check[self.order]
            new = np.r_[True, (rank[1:] != rank[:-1]) | (check[1:] != check[:-1])] if len(rank) else np.zeros(0, bool)
        else:
            # Short ranks and places fit into one number together, which sorts fastest.
            short, place = self.rank >> np.uint64(64 - self.width), np.uint64(len(self.rank).bit_length())
            if self.width + place <= 64:
                both = np.sort(short << place | np.arange(len(short), dtype=np.uint64))
                rank, self.order = both >> place, (both & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)
            else:
                self.order = np.argsort(short)
                rank = short[self.order]
            new = np.r_[True, rank[1:] != rank[:-1]] if len(rank) else np.zeros(0, bool)
        self.start = np.flatnonzero(new)
        self.distinct = rank[self.start]
        self.group = np.cumsum(new) - 1

    def cuts(self) -> np.ndarray:
        """Where the distinct ranks of each range begin, and the end."""
        whole = 64 if self.round == len(self.rounds) - 1 else self.width
        return np.searchsorted(self.distinct >> np.uint64(whole - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))

    def shared_inside(self) -> np.ndarray:
        """Distinct ranks that several documents of the chunk have."""
        doc = self.doc[self.at[self.order]]
        other = np.r_[False, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
        other[self.start] = False
        return np.bincount(self.group, other, len(self.start)) > 0

    def first_docs(self) -> np.ndarray:
        """The smallest id that has each distinct rank in the chunk."""
        ids = self.ids[self.doc[self.at[self.order]]]
        return np.minimum.reduceat(ids, self.start) if len(ids) else ids

    def answered(self, shared: np.ndarray) -> None:
        """Drop the positions whose rank is not shared, and rank the pairs of those left at the next length."""
        keep = np.zeros(len(self.at), bool)
        keep[self.order] = shared[self.group]
        dense = np.zeros(len(self.raw) + 1, np.int64)  # place of each position among those kept, from 1
        at, rank = self.at[keep], self.rank[keep]
        dense[at] = np.arange(1, len(at) + 1)
        self.round += 1
        h = self.rounds[self.round]
        further = at + (h - self.rounds[self.round - 1])
        second = dense[np.minimum(further, len(self.raw))]
        go = (second > 0) & (self.to_end[at] >= h)
        self.at, self.rank = at[go], _pair(rank[go], rank[second[go] - 1])
        if self.round == len(self.rounds) - 1:
            self.check = second_hash(self.raw, self.at, self.length)
        self._group()

    def repeated(self, earlier: np.ndarray) -> np.ndarray:
        """Positions whose string also starts in a document of smaller id, given which distinct ranks have one in a chunk before."""
        own = self.ids[self.doc[self.at[self.order]]]
        return self.at[self.order[earlier[self.group] | (own > self.first_docs()[self.group])]]


_ASKS = "range int, chunk long, n long, keys binary, rest binary"
_ANSWERS = "chunk long, round int, range int, n long, bits binary"


def _ask(positions: Positions, chunk: int) -> pa.Table:
    """The distinct ranks of a round by range: sorted steps between them, and whether several documents have them or, in the last round, the rest of the rank."""
    cuts = positions.cuts()
    some = np.flatnonzero(np.diff(cuts)).tolist()
    spans = [(int(cuts[r]), int(cuts[r + 1])) for r in some]
    last = positions.round == len(positions.rounds) - 1
    steps = np.diff(positions.distinct, prepend=np.uint64(0))
    for s, _ in spans:
        steps[s] = positions.distinct[s]
    if last:
        rest = positions.check[positions.order[positions.start]]
        more = [squeezed(rest[s:e]) for s, e in spans]
    else:
        several = positions.shared_inside()
        more = [np.packbits(several[s:e]).tobytes() for s, e in spans]
    columns = [pa.array(some, pa.int32()), pa.array([chunk] * len(some), pa.int64()), pa.array([e - s for s, e in spans], pa.int64()), pa.array([squeezed(steps[s:e]) for s, e in spans], pa.binary())]
    return pa.Table.from_arrays([*columns, pa.array(more, pa.binary())], ["range", "chunk", "n", "keys", "rest"])


def _answer(round_: int, last: bool):
    """For the ranks of one range: a bit for each that tells whether other documents have it too; in the last round, documents of a chunk before."""

    def run(table: pa.Table) -> pa.Table:
        n = table.column("n").to_pylist()
        keys = np.concatenate([np.cumsum(unsqueezed(x, k, "<u8"), dtype=np.uint64) for x, k in zip(table.column("keys").to_pylist(), n, strict=True)])
        packed = table.column("rest").to_pylist()
        if last:
            rest = np.concatenate([unsqueezed(x, k, "<u4") for x, k in zip(packed, n, strict=True)])
            chunk = np.repeat(table.column("chunk").to_numpy(), n)
            order = np.argsort(keys)
            same = keys[order[1:]] == keys[order[:-1]]
            if (same & (rest[order[1:]] != rest[order[:-1]])).any():
                order = np.lexsort((rest, keys))
            new = np.r_[True, (keys[order[1:]] != keys[order[:-1]]) | (rest[order[1:]] != rest[order[:-1]])]
            start = np.flatnonzero(new)
            least = np.minimum.reduceat(chunk[order], start)
            bits = np.empty(len(keys), bool)
            bits[order] = chunk[order] > least[np.cumsum(new) - 1]
        else:
            several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=k) for x, k in zip(packed, n, strict=True)]).astype(bool)
            order = np.argsort(keys)
            new = np.r_[True, keys[order[1:]] != keys[order[:-1]]]
            group = np.cumsum(new) - 1
            shared = np.bincount(group, 1 + several[order]) > 1
            bits = np.empty(len(keys), bool)
            bits[order] = shared[group]
        cuts = np.cumsum([0, *n]).tolist()
        answers = [pa.compress(np.packbits(bits[s:e]).tobytes(), "zstd", asbytes=True) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table({"chunk": table.column("chunk"), "round": pa.array([round_] * len(n), pa.int32()), "range": table.column("range"), "n": table.column("n"), "bits": pa.array(answers, pa.binary())})

    return run


def _bits(answers: pa.Table, round_: int) -> np.ndarray:
    """The answers of a round in the order of the distinct ranks."""
    rows = sorted((r, n, b) for k, r, n, b in zip(*[answers.column(c).to_pylist() for c in ("round", "range", "n", "bits")], strict=True) if k == round_)
    return np.concatenate([np.zeros(0, bool), *[np.unpackbits(np.frombuffer(pa.decompress(b, -(-n // 8), "zstd", asbytes=True), np.uint8), count=n).astype(bool) for _, n, b in rows]])


def _cut(positions: Positions, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(bytes removed, maximal removed runs, what is left) of each text, without the ``length`` bytes from each position ``at`` on."""
    n, docs = len(positions.raw), len(positions.sizes)
    mark = np.zeros(n + 1, np.int32)
    mark[at] = 1
    mark[: n + 1] -= np.bincount(at + length, minlength=n + 1)[: n + 1].astype(np.int32)
    gone = np.cumsum(mark[:n]) > 0
    begins = gone & ~np.r_[False, gone[:-1]] if n else gone
    first = (positions.ends - positions.sizes)[positions.sizes > 0]
    begins[first] = gone[first]
    removed, spans = np.bincount(positions.doc, gone, docs), np.bincount(positions.doc, begins, docs)
    left = np.frombuffer(positions.raw, np.uint8)[~gone].tobytes()
    ends = np.cumsum(positions.sizes - removed).astype(np.int64).tolist()
    return removed.astype(np.int64), spans.astype(np.int64), [left[s:e] for s, e in zip([0, *ends], ends, strict=False)]


def drop_repeats(df: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept binary)`` for every row.

    Removed is each byte that a ``length``-byte string covers which also starts in a document of
    smaller id; strings are judged on the input. ``n_spans`` counts maximal removed runs, ``kept`` holds
    the other bytes. Null text reads as empty; texts shorter than ``length`` keep everything. A
    null id is not compared and keeps everything. Rows that repeat an id are one document: they never count as earlier than
    each other, and equal texts get equal results. An empty table gives no rows. Other columns play no part.
    Ids are whole numbers; ``length`` is 9 at least. A task holds some 60 bytes for each byte of a chunk, or of one text that is longer.
    """
    rounds = lengths(length)
    docs = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias(text_col))
    # A text that stands as a whole in a document of smaller id has nothing to ask, and nothing to tell that the other does not.
    whole = docs.select(F.col(id_col).alias("_id"), F.md5(text_col).alias("_digest")).filter("_id IS NOT NULL AND _digest IS NOT NULL")
    least = whole.groupBy("_digest").agg(F.min("_id").alias("_least"), F.max("_id").alias("_most")).filter("_least < _most").select("_digest", "_least")
    copies = written(whole.join(least, "_digest").filter("_id > _least").select("_id", "_digest").distinct(), "copies")
    marked = docs.join(broadcast_if_small(copies).withColumn("_copy", F.lit(True)), (F.col(id_col) == F.col("_id")) & (F.md5(text_col) == F.col("_digest")), "left").select(id_col, text_col, "_copy")
    chunks = chunked(marked.filter("_copy IS NULL"), id_col, text_col, max_bytes=_CHUNK, by_id=True)
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    bits = range_bits(df, size)
    width = min(56, max(bits + 16, size.bit_length() + 3))  # an eighth of the ranks looks shared by chance at most

    def ready(row: dict, answers: pa.Table | None = None, rounds_: int = 0) -> Positions:
        positions = Positions(row, length, bits, width)
        for i in range(rounds_):
            positions.answered(_bits(answers, i))
        return positions

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _ask(ready(row), row["chunk"]).to_batches()

    def later(k: int):
        def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
            row = rows.to_pylist()[0]
            return _ask(ready(row, answers, k), row["chunk"])

        return run

    parts: list[DataFrame] = []
    for k in range(len(rounds)):
        asks = chunks.groupBy("chunk").cogroup(_union(parts).groupBy("chunk")).applyInArrow(later(k), _ASKS) if k else chunks.mapInArrow(first, _ASKS)
        parts.append(written(asks.groupBy("range").applyInArrow(_answer(k, k == len(rounds) - 1), _ANSWERS), "answers"))

    schema = T.StructType([T.StructField(id_col, T.LongType()), *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType())])

    def cut(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        positions = ready(row, answers, len(rounds) - 1)
        removed, spans, kept = _cut(positions, positions.repeated(_bits(answers, len(rounds) - 1)), length)
        return pa.Table.from_arrays([rows.column("ids").combine_chunks().flatten(), pa.array(positions.sizes), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())], schema.names)

    done = chunks.groupBy("chunk").cogroup(_union(parts).groupBy("chunk")).applyInArrow(cut, schema)
    n, long = F.octet_length(text_col).cast("long"), F.octet_length(text_col) >= length
    zero, none = F.lit(0).cast("long"), F.lit(b"")
    removed = marked.filter("_copy").select(id_col, n.alias("n_bytes"), F.when(long, n).otherwise(zero).alias("n_removed"), F.when(long, 1).otherwise(0).cast("long").alias("n_spans"), F.when(long, none).otherwise(F.encode(text_col, "UTF-8")).alias("kept"))
    return done.unionByName(removed)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document, at 50 bytes; edge rows as in :func:`drop_repeats`."""
    out = drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
