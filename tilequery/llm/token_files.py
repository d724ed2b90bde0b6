"""Token ids as Parquet list columns, in the order of document ids, and selective reads of them.

A table has a row for each document: ``part`` and ``before`` (its file, and the ids before it there), ``n_tokens``, and ``ids``, encoded by
dictionary or by deltas. Rows are sorted by id within files and files follow each other, so pages and row groups hold ranges of
ids and of places; their indexes let a reader of some documents, or of a window of the token stream, skip the rest, and one of lengths
or places never touches the ids.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded, shared_dir, small_batches
from .bpe import byte_to_char

#: Words that a worker remembers before the older half goes, and the longest that it remembers.
_REMEMBERED, _LONGEST = 500_000, 48
#: What lies before is letters, marks and signs of Latin, Greek and Cyrillic, on which all versions of Unicode agree.
_AGREED = "\u0530"
#: ASCII signs: a run of them behind letters is one piece.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
END = 0


class Encoder:
    """Ids of the ``tokenizers`` library for a byte-level vocabulary with the usual pattern; strings of special tokens are ordinary text.

    No piece of the pattern goes on behind a space that stands between two other characters, so texts are cut there. A word
    goes to the library's model once, by pieces, and is remembered; words of scripts beyond ``_AGREED`` go to the whole tokenizer.
    """

    _CUT = re.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")

    def __init__(self, path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._model, self._pieces = self._tokenizer.model, regex.compile(pattern)
        self._spelled = dict(enumerate(byte_to_char()))
        self._model._resize_cache(0)  # words are remembered here, and the library's own memory costs more than it saves
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._rest: dict[str, bytes] = {}

    def _spell(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self._spelled)

    def _model_ids(self, spelled: str) -> bytes:
        return array("I", [t.id for t in self._model.tokenize(spelled)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that is no word behind a space."""
        ids = self._rest.get(piece)
        if ids is None:
            ids = self._model_ids(self._spell(piece))
            if len(piece) < 8 and len(self._rest) < _REMEMBERED // 8:
                self._rest[piece] = ids
        return ids

    def _text(self, text: str) -> bytes:
        """Ids of a text that nothing is remembered of."""
        if text and max(text) >= _AGREED:
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([self._word(p[1:]) if p[1:].isalpha() and p[0] == " " else self._piece(p) for p in self._pieces.findall(text)])

    def _word(self, word: str) -> bytes:
        """Ids of a word and the space before it; a word that begins with a line break has none."""
        ids = self._new.get(word)
        if ids is None:
            ids = self._old.get(word)
            if ids is None:
                plain = word.isascii()
                if word.isalpha() and (plain or max(word) < _AGREED):
                    ids = self._model_ids("\u0120" + word if plain else self._spell(" " + word))
                elif plain and (stem := word.rstrip(_SIGNS)).isalpha():
                    ids = self._word(stem) + self._piece(word[len(stem) :])
                else:
                    ids = self._text(word if word[:1] == "\n" else " " + word)
            if len(word) <= _LONGEST:
                self._new[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers of this machine's order."""
        # A text of words between single spaces or line breaks is cut at both, any other between two characters that are no white space.
        calm = " ".join(text.split()) == text.replace("\n", " ")
        first, *words = text.replace("\n", " \n").split(" ") if calm else self._CUT.split(text)
        ids = list(map(self._new.get, words))
        if None in ids:
            ids = [self._word(w) if i is None else i for w, i in zip(words, ids, strict=True)]
        out = self._text(first) + b"".join(ids)
        if len(self._new) > _REMEMBERED:
            self._old, self._new = self._new, {}
        return out


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encoded(df: DataFrame, tokenizer: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", end: int | None = END) -> DataFrame:
    """``(part, before, id, n_tokens, ids)`` of every row, in the order of ids (nulls first; equal ids by the text's hash).

    ``part`` numbers the partitions, ``before`` counts the ids of the rows before in its part; ``end`` is put behind each document. Null
    text reads as empty; repeated rows stay repeated; other columns play no part. A text and its ids must fit into a task, not more.
    """
    kind = df.schema[id_col]
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), kind, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    last = b"" if end is None else np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, before = encoder(tokenizer, pattern), TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, text_col, 1 << 20):
            ids = [own.encode(t or "") + last for t in batch.column(text_col).to_pylist()]
            sizes = np.array([len(i) // 4 for i in ids], np.int64)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), part, np.int32)), pa.array(before + ends - sizes), batch.column(id_col), pa.array(sizes), lists], schema.names)
            before += int(sizes.sum())

    rows = df.select(F.col(id_col), F.col(text_col).alias(text_col))
    ordered = rows.repartitionByRange(F.col(id_col).asc_nulls_first()).sortWithinPartitions(F.col(id_col).asc_nulls_first(), F.xxhash64(text_col))
    return bounded(ordered).mapInArrow(run, schema)


def write_tokens(df: DataFrame, path: str, encoding: str = "dictionary", row_group: int = 32 << 20, page_rows: int = 1000, codec: str = "zstd") -> None:
    """Write :func:`encoded` rows as Parquet with row groups of about ``row_group`` bytes and pages of at most ``page_rows`` rows, each with its index.

    ``encoding`` of the ids: ``dictionary``, or ``delta`` (bit-packed differences). Other columns are sorted or nearly so, and take deltas. The
    options are this write's own; the session is left as it is.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")
    options = {"parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(row_group), "parquet.page.row.count.limit": str(page_rows), "parquet.enable.dictionary": "false", "compression": codec}
    if encoding == "dictionary":
        options |= {"parquet.enable.dictionary#ids.list.element": "true", "parquet.dictionary.page.size": str(1 << 20)}
    df.write.options(**options).parquet(path)


def part_starts(tokens: DataFrame) -> DataFrame:
    """``(part, first)``: ids in all parts before; a row for each part, from the lengths alone."""
    by = tokens.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    return by.select("part", (F.sum("_n").over(W.orderBy("part")) - F.col("_n")).alias("first"))


def with_starts(tokens: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the stored rows and ``start``, the ids of all documents before. Parts are as few as files, which bounds what is broadcast."""
    rows = tokens.select("part", "before", *columns)
    return rows.join(F.broadcast(part_starts(tokens)), "part").select(*columns, (F.col("first") + F.col("before")).alias("start"))


def read_documents(spark: SparkSession, path: str, ids: list[int], id_col: str = "doc_id") -> DataFrame:
    """The stored rows of some documents; pages whose range holds none of the ids are skipped."""
    return spark.read.parquet(path).filter(F.col(id_col).isin(ids))


def read_window(spark: SparkSession, path: str, start: int, n: int, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, ids)``: ids ``start`` to ``start + n`` of the whole stream, by document, cut at the ends; reads the pages around the window only."""
    if start < 0 or n < 0:
        raise ValueError("a window begins at 0 or later and has no negative length")
    tokens = spark.read.parquet(path)
    meta = part_starts(tokens).withColumn("_end", F.lead("first").over(W.orderBy("part"))).filter((F.col("first") < start + n) & (F.coalesce("_end", F.lit(start + 1)) > start)).collect()
    pieces = []
    for r in meta:  # the files that the window touches
        low, high = start - r["first"], start + n - r["first"]
        rows = tokens.filter((F.col("part") == r["part"]) & (F.col("before") < high) & (F.col("before") + F.col("n_tokens") > low))
        skip = F.greatest(F.lit(0), F.lit(low) - F.col("before"))
        length = F.least(F.col("n_tokens"), F.lit(high) - F.col("before")) - skip
        pieces.append(rows.select(F.col(id_col), (F.lit(r["first"]) + F.col("before") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), length.cast("int")).alias("ids")))
    out = tokens.select(F.col(id_col), F.lit(0).cast("long").alias("start"), "ids").limit(0)
    for p in pieces:
        out = out.unionByName(p)
    return out


def digests(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of stored rows, all from what is read back; the crc is that of little-endian unsigned 32-bit integers."""
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), tokens.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("ids")
            flat = memoryview(np.ascontiguousarray(lists.flatten().to_numpy(), "<i4")).cast("B")
            ends = np.cumsum(lists.value_lengths().to_numpy().astype(np.int64) * 4).tolist()
            crc = [zlib.crc32(flat[s:e]) for s, e in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("before"), b.column(id_col), pa.array(lists.value_lengths(), pa.int64()), pa.array(crc, pa.int64())], schema.names)

    read = bounded(tokens).select("part", "before", id_col, "ids").mapInArrow(run, schema)
    return read.join(F.broadcast(part_starts(tokens)), "part").select(id_col, (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op11_token_files(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document, from the files; null and empty texts hold the end id alone, an empty table gives no rows."""
    import uuid

    import public_tokenizers

    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN), path)
    return digests(spark.read.parquet(path))
