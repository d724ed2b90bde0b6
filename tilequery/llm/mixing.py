"""Mix sources to target weights: repetition rates per source, whole copies plus one hash-seeded copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import WORD, broadcast_if_small

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Words to take in all, as a share of all words, and the most of one source as a multiple of its words.
SHARE, MOST = 1.5, 2.0


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Sources by code point, a null source last, take the weights in turn. Targets share
    ``share`` of all words by weight; none exceeds ``most`` times its source's words, and
    what is above goes to the others by weight until none is above. That is the level
    at which ``sum(min(weight * level, most * size))`` meets the total: sources reach their cap in
    the order of cap / weight, so a running sum over the sources finds it. One row for
    each source (no rows in the windows but these).
    """
    by = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    everywhere = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int")).cast("double"))
    by = by.withColumn("cap", most * F.col("source_size"))
    at = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    by = (
        by.withColumn("total", share * F.sum("source_size").over(everywhere))
        .withColumn("capped", F.coalesce(F.sum("cap").over(at.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(at.rowsBetween(0, W.unboundedFollowing)))
    )
    # The first source, in this order, that is not above its cap fixes the level; from there on the levels only fall.
    by = by.withColumn("level", (F.col("total") - F.col("capped")) / F.col("rest"))
    by = by.withColumn("level", F.max(F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.col("level"))).over(everywhere))
    return by.select("source", "source_size", F.least(F.coalesce(F.col("weight") * F.col("level"), F.col("cap")), F.col("cap")).alias("target"))


def uniform(seed: int, *columns: str) -> Column:
    """A number in [0, 1) from a hash of the columns: the same for every run and every partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan_mix(df: DataFrame, seed: int = 0, id_col: str = "doc_id", **how) -> DataFrame:
    """``df``'s rows with ``size, source_size, target, copies``, and no other columns than id and source.

    Every document of a source gets floor(rate) copies, rate = target / source_size, and one
    more where its hash falls below the fraction. Null text: size 0. Null source: a source
    of its own. Repeated ids share one draw. A source without words has target 0.
    """
    sized = df.select(F.col(id_col), F.col("source"), word_count().alias("size"))
    targets = source_targets(sized, **how)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = (F.floor(rate) + F.when(uniform(seed, id_col) < rate - F.floor(rate), 1).otherwise(0)).cast("long")
    out = sized.alias("d").join(broadcast_if_small(targets).alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    return out.select(f"d.{id_col}", "d.source", "size", "source_size", "target", copies.alias("copies"))


def mix(df: DataFrame, seed: int = 0, id_col: str = "doc_id", **how) -> DataFrame:
    """``df`` with each row as often as its source's rate says; columns as in ``df``.

    Cases as in :func:`plan_mix`. The rows are read once more and not shuffled: a row carries its
    source's rate from a table of one row for each source, broadcast if its count allows.
    """
    targets = source_targets(df.select("source", word_count().alias("size")), **how)
    targets = targets.select(F.col("source").alias("_mix_source"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_mix_rate"))
    rate = F.col("_mix_rate")
    copies = (F.floor(rate) + F.when(uniform(seed, id_col) < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    out = df.join(broadcast_if_small(targets), F.col("source").eqNullSafe(F.col("_mix_source")))
    return out.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), copies))).select(*[F.col(f"`{c}`") for c in df.columns])


def op9_mix(spark, sf_dir: str) -> DataFrame:
    plan = plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP9_SQL = """
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
  2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM s) AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(coalesce(weight * (SELECT max(level) FROM l WHERE weight * level <= cap), cap), cap) AS target FROM l),
r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
