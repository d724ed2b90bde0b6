"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN_DIR: dict[str, str] = {}

#: ASCII white space, as the contracts define it: everything else is part of a word.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); one of our own only in local mode without one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="spark-llm-", dir="/tmp")
    return _OWN_DIR[app]


#: While a table is written: Spark removes the shuffle files of a query when it ends, not when the driver next
#: collects garbage, and batches for Python workers are cut by bytes too, so that long rows do not pile up.
_WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts the lineage, survives lost executors, and frees what was shuffled for it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in _WHILE_WRITING}
    for k, v in _WHILE_WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def bounded(df: DataFrame) -> DataFrame:
    """``df``; its session cuts batches for Python workers by bytes from now on, unless it has its own bound."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, _WHILE_WRITING[key])
    return df


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing will read any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, most_bytes: int = 16 << 20) -> DataFrame:
    """Write ``df`` unless it is a table of :func:`written`, and hint a broadcast only where its values take few bytes; else joins shuffle, and AQE splits hot keys."""
    df = df if hasattr(df, "written_to") else written(df, "small")
    fixed = sum(isinstance(f.dataType, (T.NumericType, T.BooleanType)) for f in df.schema)
    loose = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if fixed + len(loose) < len(df.columns):
        return df
    rows, rest = df.agg(F.count("*"), F.sum(sum(loose, F.lit(0)))).first()
    return F.broadcast(df) if rows * 8 * len(df.columns) + (rest or 0) <= most_bytes else df


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null reads as empty."""
    return [x or b"" for x in pc.cast(column, pa.binary()).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def crc32_mod(column: str, n: int):
    """``crc32(column as text) mod n``; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def parts_for(df: DataFrame, least: int = 1) -> int:
    """Shuffle partitions of the session, the unit by which this library sizes hash ranges."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected ``edges (a, b)`` -> ``(id, component)``, component the smallest id.

    Alternating large-star / small-star rounds. A vertex's minimum is a map-side combined
    aggregate joined back to its edges, so that a hub's edges stay spread over tasks.
    Vertices without an edge to another one are not in the result; repeated edges and
    loops are harmless; an empty input gives an empty result.
    """

    def fingerprint(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = written(e, name)
    before = fingerprint(e)
    while True:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min(F.least("x", "y")).alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, e = e, written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        discard(last)
        after = fingerprint(e)
        if after == before:
            break
        before = after
    out = written(e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()), name)
    discard(e)
    return out


# --- hash ranges --------------------------------------------------------------------------------
# Positions and signatures are many and small. Tasks pack them into one row for each range of
# hashes, Spark deals the ranges out, and each range is looked at with numpy.


def range_bits(df: DataFrame, keys: int = 0, most: int = 1 << 20) -> int:
    """log2 of the number of hash ranges: two for each shuffle partition at least, and about ``most`` of ``keys`` in each at most."""
    return max(1, (max(2 * parts_for(df), -(-keys // most)) - 1).bit_length())


def pack_ranges(bits: int, keys: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """Rows ``(range, keys, *columns)`` of packed values; of each 64-bit key the range and the 32 bits after it are kept.

    Two different keys look the same with a chance of (keys of a range) / 2**32, so what
    is found has to be confirmed; nothing is lost.
    """
    owner = (keys >> np.uint64(64 - bits)).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    owner, rest = owner[order], ((keys[order] << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    ends = np.r_[cuts[1:], len(owner)][: len(cuts)]
    packed = {"keys": rest, **{k: v[order] for k, v in columns.items()}}
    arrays = [pa.array([v[s:e].tobytes() for s, e in zip(cuts.tolist(), ends.tolist(), strict=True)], pa.binary()) for v in packed.values()]
    return pa.RecordBatch.from_arrays([pa.array(owner[cuts]), *arrays], ["range", *packed])


def unpack(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new value starts in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def planes(values: np.ndarray) -> bytes:
    """Differences of neighbours, byte by byte: what compresses well in a shuffle."""
    step = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(step.view(np.uint8).reshape(len(step), -1).T).tobytes()


def from_planes(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    parts = [np.cumsum(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).view(dtype).ravel(), dtype=dtype) for x in column.to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


# --- words ----------------------------------------------------------------------------------------

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and their inverses."""
    odd = 0xF1357AEA2E62A9C5
    out = []
    for base in (odd, pow(odd, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each word in order: runs of bytes that are not ASCII white space, A-Z in lower case."""
    raw = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, gap].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers(1 << max(16, (len(raw) + 1).bit_length()))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[: len(raw)], dtype=np.uint64, out=total[1:])
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.searchsorted(first, start, side="right") - 1, mixed((total[end] - total[start]) * inverse[start])


# --- chunks ---------------------------------------------------------------------------------------
# A chunk is some rows packed into one: tasks ask for a chunk as a whole and answers come back to it.


_ZSTD = 6


def chunked(df: DataFrame, id_col: str, text_col: str, flag_col: str | None = None, max_bytes: int = 4 << 20, by_id: bool = False) -> DataFrame:
    """``(chunk, ids, flags, sizes, bytes, text)``, written: the rows in order, about ``max_bytes`` of UTF-8 text in each chunk (one row at least), compressed. Null text reads as empty.

    ``by_id`` sorts the rows by id first: then ids of a chunk of higher number are larger, since rows of one id stay together.
    """
    flags = F.col(flag_col) if flag_col else F.lit(False)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), flags.alias("flag"))
    if by_id:
        rows = rows.repartitionByRange("id").sortWithinPartitions("id")
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), *[T.StructField(c, T.BinaryType()) for c in ("flags", "sizes")], T.StructField("bytes", T.LongType()), T.StructField("text", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        flags: list[bool] = []

        def packed() -> pa.RecordBatch:
            nonlocal number
            joined = b"".join(texts)
            flat = pa.chunked_array(ids).combine_chunks()
            row = [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat), *[pa.array([x.tobytes()], pa.binary()) for x in (np.array(flags, np.uint8), np.array([len(t) for t in texts], "<i8"))]]
            out = pa.RecordBatch.from_arrays([*row, pa.array([len(joined)]), pa.array([pa.Codec("zstd", compression_level=_ZSTD).compress(joined, asbytes=True)], pa.binary())], schema.names)
            number += 1
            ids.clear(), texts.clear(), flags.clear()
            return out

        size = 0
        for batch in small_batches(batches, "text", max_bytes):
            own = utf8(batch.column("text"))
            more = sum(map(len, own))
            if texts and size + more > max_bytes and not (by_id and ids[-1][-1] == batch.column("id")[0]):
                yield packed()
                size = 0
            ids.append(batch.column("id"))
            texts += own
            flags += [bool(x) for x in batch.column("flag").to_pylist()]
            size += more
        if texts:
            yield packed()

    return written(rows.mapInArrow(run, schema), "chunks")


def chunk_texts(row: dict) -> list[bytes]:
    """The texts of a row of :func:`chunked`."""
    joined = pa.decompress(row["text"], row["bytes"], "zstd", asbytes=True) if row["bytes"] else b""
    ends = np.cumsum(np.frombuffer(row["sizes"], "<i8")).tolist()
    return [joined[s:e] for s, e in zip([0, *ends], ends, strict=False)]


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers, compressed."""
    planes_ = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()
    return pa.compress(planes_, "zstd", asbytes=True)


def unsqueezed(packed: bytes, n: int, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(pa.decompress(packed, n * width, "zstd", asbytes=True) if n else b"", np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()
