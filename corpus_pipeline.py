"""A training corpus from raw documents, in stages that each write and read a table.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame with the columns of ``documents``, the last one its own.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilequery.llm import bpe, jaccard, langid, mixing, pii
from tilequery.llm._shared import broadcast_if_small, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if one language has this share of it, and its languages explain it better than a background of equal
#: trigrams. In sf0.01 the smallest share of a document is 0.596 and the smallest gain 2.39; random letters gain -1.2 at most.
LEAST_SHARE, LEAST_GAIN = 0.55, 0.0


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``lang`` becomes the inferred language. Documents without one go: no text, no letter, no main language, or gibberish."""
    docs = docs.select(*COLUMNS)
    found = langid.predict(docs, *langid.fit(docs))
    clear = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE) & (F.col("gain") > LEAST_GAIN)
    return found.filter(clear).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the document of smallest id stays. Documents without an id stay."""
    docs = docs.select(*COLUMNS)
    groups = jaccard.near_duplicates(docs)
    copies = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(broadcast_if_small(copies), "doc_id", "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become ``<KIND>``; ``n_chars`` follows the text."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mix(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, ids``; a repeated document is repeated here too."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = docs.withColumn("about", F.struct("doc_id", "source", "lang"))
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN, id_col="about")
    return ids.select("about.doc_id", "about.source", "about.lang", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("near_copies", near_copies),
    ("pii", personal_data),
    ("mixture", mixture),
    ("byte_bpe", tokens),
]
#: SQL cannot express the first stage; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written and read again. An empty table gives no rows; null and empty
    texts go at the first stage, as documents without a language; rows that repeat an id are one document to the second."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
