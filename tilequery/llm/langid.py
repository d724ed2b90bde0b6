"""Language identification as mixture inference over byte n-grams.

Each language is a smoothed distribution over hashed byte trigrams. A document is a mixture of
languages: expectation-maximisation estimates the proportions, and a language joins the set only
where the gain in log-likelihood exceeds a penalty for one more parameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded, crc32_mod, small_batches, utf8

#: Hashed trigrams: the model has this many numbers for each language, whatever the size of the corpus.
BUCKETS = 1 << 15
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: Lower-case ASCII letters and bytes of other scripts stay; all else is a word boundary.
_KEEP = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def trigram_buckets(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text, one space at its ends; those of two spaces or more are left out."""
    b = _KEEP[np.frombuffer(b" " + text + b" ", np.uint8)]
    if len(b) < 3:
        return np.zeros(0, np.int64)
    gap = b == 32
    h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(17)
    return h[~(gap[:-2] & gap[1:-1] | gap[1:-1] & gap[2:])].astype(np.int64)


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages and their log-free trigram probabilities (languages, BUCKETS) from all rows with a language.

    Tasks sum their rows before the shuffle; what reaches the driver is one number for each
    language and bucket that occurs. No labelled rows: no languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "bucket", "n"])
            sums.clear()

        for batch in small_batches(batches, text_col):
            for lang, text in zip(batch.column(lang_col).to_pylist(), utf8(batch.column(text_col)), strict=True):
                if lang not in sums:
                    if len(sums) >= 64:
                        yield from flush()
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += np.bincount(trigram_buckets(text), minlength=BUCKETS)
        yield from flush()

    rows = df.filter(F.col(lang_col).isNotNull()).select(lang_col, text_col).mapInArrow(count, "lang string, bucket int, n long")
    table = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    model = np.zeros((len(langs), BUCKETS))
    place = {x: i for i, x in enumerate(langs)}
    model[[place[x] for x in table.column("lang").to_pylist()], table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return langs, (model + 0.5) / (model.sum(1, keepdims=True) + 0.5 * BUCKETS)


def _em(likelihood: np.ndarray, counts: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Mixture proportions and the log-likelihood that they reach."""
    share, n = start, counts.sum()
    for _ in range(rounds):
        share = share * (likelihood @ (counts / (share @ likelihood))) / n
    return share, float(counts @ np.log(share @ likelihood))


def infer(text: bytes, model: np.ndarray, penalty: float = 2.0, rounds: int = 12) -> np.ndarray | None:
    """Proportion of each language; ``None`` where the text has no trigram of letters."""
    found = mixture(text, model, penalty, rounds)
    return None if found is None else found[0]


def mixture(text: bytes, model: np.ndarray, penalty: float = 2.0, rounds: int = 12) -> tuple[np.ndarray, float] | None:
    """Proportion of each language, and the gain in log-likelihood for each trigram over a background of equal buckets."""
    found = np.bincount(trigram_buckets(text), minlength=BUCKETS)
    at = np.flatnonzero(found)
    if not len(at):
        return None
    counts, likelihood = found[at].astype(float), model[:, at]
    single = np.log(likelihood) @ counts
    chosen = [int(single.argmax())]
    best, share = float(single.max()), np.ones(1)
    n = len(model)
    if n > 1:
        spread, _ = _em(likelihood, counts, np.full(n, 1 / n), rounds)
        for other in np.argsort(-spread).tolist():
            if other in chosen:
                continue
            if spread[other] < 1e-3:
                break
            tried, reached = _em(likelihood[[*chosen, other]], counts, np.full(len(chosen) + 1, 1 / (len(chosen) + 1)), rounds)
            if reached - best <= penalty * np.log(counts.sum() + 1):
                break
            chosen, best, share = [*chosen, other], reached, tried
    out = np.zeros(n)
    out[chosen] = share
    return out, best / float(counts.sum()) + float(np.log(BUCKETS))


def predict(df: DataFrame, langs: list[str], model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` (the largest proportion, ties to the first name), ``score`` (that proportion), ``languages``, ``shares`` (the set, largest first), ``gain`` (over the background, see ``mixture``).

    ``und`` with score and gain 0 where the text is null or has no letter, or nothing was learnt.
    Columns of ``df`` with these names are replaced. No shuffle; the model is of fixed size.
    """
    new = ["lang_pred", "score", "languages", "shares", "gain"]
    kept = [c for c in df.columns if c.lower() not in new]
    model_of = df.sparkSession.sparkContext.broadcast((langs, model))
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("languages", T.ArrayType(T.StringType())), T.StructField("shares", T.ArrayType(T.DoubleType())), T.StructField("gain", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, own = model_of.value
        for batch in small_batches(batches, text_col):
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(text_col).to_pylist():
                share, gain = (text and names and _LETTER.search(text) and mixture(text.encode(), own)) or (None, 0.0)
                order = [] if share is None else [i for i in np.argsort(-share, kind="stable").tolist() if share[i] > 0]
                out[0].append(names[order[0]] if order else UNKNOWN)
                out[1].append(min(1.0, float(share[order[0]])) if order else 0.0)
                out[2].append([names[i] for i in order])
                out[3].append([float(share[i]) for i in order])
                out[4].append(gain)
            arrays = [pa.array(x, t) for x, t in zip(out, (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *arrays], schema.names)

    return bounded(df).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """True for the third of the documents that are never learnt from; a null id is learnt from."""
    return crc32_mod(id_col, 3) == 1


def op4_langid(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document, then ``languages``, the set of the mixture as JSON, largest share first; edge rows as in :func:`predict`.

    A null id is learnt from. Repeated rows stay repeated; an empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs, model = fit(docs.filter(~held_out()))
    found = predict(docs.select("doc_id", "text"), langs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.to_json("languages").alias("languages"))
