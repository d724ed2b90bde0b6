"""Byte-level BPE over Arrow batches, with the ``tokenizers`` library."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._shared import bounded, small_batches

#: Pieces that a worker remembers, and the longest that it remembers; others are encoded anew each time.
_REMEMBERED, _LONGEST = 400_000, 64


def byte_to_char() -> list[str]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the rest for U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Codec:
    """Encoder and decoder for one file of ranks and one splitting pattern."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        alphabet = byte_to_char()
        spelled = {t: "".join([alphabet[b] for b in t]) for t in ranks}
        merges = []
        for t, r in ranks.items():
            for i in range(1, len(t)):
                a, b = t[:i], t[i:]
                if a in ranks and b in ranks:
                    merges.append((r, max(ranks[a], ranks[b]), spelled[a], spelled[b]))
        merges.sort()
        model = models.BPE(vocab={spelled[t]: r for t, r in ranks.items()}, merges=[m[2:] for m in merges], ignore_merges=True)
        self._tokenizer = Tokenizer(model)
        self._tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._split = regex.compile(pattern)
        back = {c: b for b, c in enumerate(alphabet)}
        self._bytes: dict[int, bytes] = {self._tokenizer.token_to_id(s): bytes([back[c] for c in s]) for s in spelled.values()}
        self._known: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        return {p: np.array(e.ids, "<u4").tobytes() for p, e in zip(pieces, self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False), strict=True)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers. Each match of the pattern is encoded by itself."""
        out = []
        for text in texts:
            pieces = self._split.findall(text)
            rare: dict[str, bytes] = {}
            if new := [p for p in set(pieces) if p not in self._known]:
                if len(self._known) > _REMEMBERED:
                    self._known.clear()
                    new = list(set(pieces))
                learnt = self._learn(new)
                self._known.update((p, i) for p, i in learnt.items() if len(p) <= _LONGEST)
                rare = {p: i for p, i in learnt.items() if len(p) > _LONGEST}
            known = self._known
            out.append(b"".join([known[p] for p in pieces] if not rare else [rare[p] if p in rare else known[p] for p in pieces]))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, text: str, ids: bytes) -> list[tuple[int, int]]:
        """Characters (start, end) that each token touches; tokens that split a character share it."""
        sizes = np.array([len(self._bytes[i]) for i in np.frombuffer(ids, "<u4").tolist()], np.int64)
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        end = np.cumsum(sizes)
        return [(int(char[s]), int(char[e - 1]) + 1) for s, e in zip(end - sizes, end, strict=True)]


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """``(id, ids array<int>[, offsets array<struct<start,end>>])`` for every row.

    A null or empty text gives no ids. Rows are handled one by one: repeated ids stay
    repeated, other columns play no part. No shuffle. The path must be readable on the executors.
    """
    fields = [df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    if offsets:
        fields.append(T.StructField("offsets", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in small_batches(batches, text_col):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            ids = own.encode(texts)
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            arrays = [batch.column(id_col), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))]
            if offsets:
                arrays.append(pa.array([[{"start": s, "end": e} for s, e in own.offsets(t, i)] for t, i in zip(texts, ids, strict=True)], span))
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return bounded(df).select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, bytes binary, text string)`` for every row; null ids read as none.

    Bytes are exact. In ``text`` a character that the ids hold only in part is U+FFFD.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("bytes", T.BinaryType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            raw = [own.decode(np.array(i or [], "<u4").tobytes()) for i in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(raw, pa.binary()), pa.array([r.decode(errors="replace") for r in raw], pa.string())], schema.names)

    return bounded(df).select(id_col, ids_col).mapInArrow(run, schema)


def digests(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: encode, decode the ids again, and digest both."""
    schema = T.StructType([df.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in small_batches(batches, text_col):
            ids = own.encode([t or "" for t in batch.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i in ids]), pa.array([hashlib.sha256(own.decode(i)).hexdigest() for i in ids])], schema.names)

    return bounded(df).select(id_col, text_col).mapInArrow(run, schema)


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document: each match of the pattern is encoded by itself, the ids are decoded again. Null reads as empty; repeated rows stay repeated; an empty table gives no rows."""
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
