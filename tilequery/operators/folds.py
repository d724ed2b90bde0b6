"""Fold assignment, fold statistics and sampling of slides."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tiles import BACKGROUND, KEY, check_not_empty, join_nulls

#: Buckets of the hash order; a rank is counted inside a bucket and shifted by the buckets before.
_BUCKETS = 1024


def collapse_rare_labels(df: DataFrame, n_folds: int) -> DataFrame:
    """``stratify_label``: labels with fewer rows than folds count as background. Rows without a label are counted as one label; they stay without one, or become background."""
    counts = df.groupBy("label").agg(F.count("*").alias("_n"))
    return join_nulls(df, counts, "label").withColumn("stratify_label", F.when(F.col("_n") < n_folds, BACKGROUND).otherwise(F.col("label"))).drop("_n")


def check_strata(df: DataFrame, n_folds: int) -> DataFrame:
    """Raise where labels were collapsed and background still has fewer rows than folds."""
    moved, background = df.agg(F.count_if(F.col("stratify_label") != F.col("label")), F.count_if(F.col("stratify_label") == BACKGROUND)).first()
    if moved and background < n_folds:
        raise ValueError(f"background has {background} rows for {n_folds} folds")
    return df


def drop_rare_class_slides(df: DataFrame, n_folds: int, check: bool = False) -> DataFrame:
    """Rows whose label is found in at least ``n_folds`` slides; rows without a label go. ``check`` raises where none is left."""
    common = df.groupBy("label").agg(F.countDistinct("slide_id").alias("k")).filter(F.col("k") >= n_folds).select("label")
    out = df.join(common, "label", "left_semi")
    return check_not_empty(out, "labels in enough slides") if check else out


def stratified_folds(df: DataFrame, n_folds: int = 5, seed: int | None = 0, label: str = "label") -> DataFrame:
    """``fold``: rank in label order modulo the folds, so each label's rows differ by one at most between folds.

    Two-phase rank: counts of (label, bucket) give each bucket its offset, so no window holds
    a whole label. ``seed`` None ranks in key order, with slides as buckets. A null label is a label, a null slide a slide; both come first. Repeated keys are ranked in any order; an empty table stays empty.
    """
    order = F.struct(*KEY) if seed is None else F.struct(F.xxhash64(F.lit(seed), *KEY), *KEY)
    bucket = F.col("slide_id") if seed is None else F.floor((F.xxhash64(F.lit(seed), *KEY) / (2.0**64) + 0.5) * _BUCKETS)
    df = df.withColumn("_bucket", bucket).withColumn("_order", order)
    counts = df.groupBy(F.col(label).alias("_label"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_n"))
    offsets = counts.select("_label", "_b", (F.sum("_n").over(W.orderBy("_label", "_b")) - F.col("_n")).alias("_offset"))
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(label, "_bucket").orderBy("_order")) - 1)
    joined = ranked.join(offsets, F.col(label).eqNullSafe(F.col("_label")) & F.col("_bucket").eqNullSafe(F.col("_b")))
    return joined.withColumn("fold", ((F.col("_rank") + F.col("_offset")) % n_folds).cast("int")).drop("_bucket", "_order", "_label", "_b", "_offset", "_rank")


def stratified_group_folds(df: DataFrame, n_folds: int = 5, seed: int | None = 0, label: str = "label") -> DataFrame:
    """``fold`` with all tiles of a slide in one fold.

    Slides of one majority label (ties by name) are dealt out by size, there and back, so folds
    differ by at most one slide of each majority label. The window runs over slides. Tiles without a slide are one slide; a null label comes first among equals.
    """
    by = df.groupBy("slide_id", label).agg(F.count("*").alias("n"))
    slides = by.groupBy("slide_id").agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("m"), F.col(label).alias("l"))).alias("top")).select("slide_id", "n", F.col("top.l").alias("major"))
    tie = [F.col("slide_id")] if seed is None else [F.xxhash64(F.lit(seed), "slide_id"), F.col("slide_id")]
    rank = F.row_number().over(W.partitionBy("major").orderBy(F.col("n").desc(), *tie)) - 1
    place = rank % (2 * n_folds)
    slides = slides.withColumn("fold", F.when(place < n_folds, place).otherwise(2 * n_folds - 1 - place).cast("int"))
    return join_nulls(df, slides.select("slide_id", "fold"), "slide_id")


def balanced_group_folds(df: DataFrame, n_folds: int = 5, seed: int = 0, label: str = "label", block: int = 1024) -> DataFrame:
    """``fold`` with all tiles of a slide in one fold, so that every label's tiles are spread evenly.

    Slides are dealt by hash into blocks of about ``block``. In each block, the largest slides first, a slide goes to the fold where it
    leaves the labels' shares of the block most even (ties: the fold with fewer tiles, then the lower one). Blocks are
    balanced one by one, so their sum is, and no task holds more than a block of slides. A null label is a label of its own, and tiles without a slide are one slide.
    """
    by = df.groupBy("slide_id", F.coalesce(F.col(label).cast("string"), F.lit("")).alias("_label")).agg(F.count("*").alias("n"))
    slides = by.groupBy("slide_id").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("_label", "n"))).alias("by"))
    blocks = F.ceil(slides.agg(F.count("*").alias("k")).select(F.col("k") / block).scalar())
    dealt = slides.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "slide_id"), F.greatest(F.lit(1), blocks)))

    def assign(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "slide_id"], ascending=[False, True])
        labels = sorted({k for m in rows["by"] for k in m})
        counts = np.array([[m.get(k, 0) for k in labels] for m in rows["by"]], float)
        share = counts / counts.sum(0)
        held, tiles, folds = np.zeros((n_folds, len(labels))), np.zeros(n_folds), []
        for own, n in zip(share, rows["n"], strict=True):
            after = held[None] + np.eye(n_folds)[:, :, None] * own
            uneven = after.std(1).mean(1).round(12)
            best = min(range(n_folds), key=lambda k: (uneven[k], tiles[k], k))
            held[best] += own
            tiles[best] += n
            folds.append(best)
        return pd.DataFrame({"slide_id": rows["slide_id"], "fold": folds})

    assigned = dealt.groupBy("block").applyInPandas(assign, "slide_id string, fold int")
    return join_nulls(df, assigned, "slide_id")


def fold_statistics(df: DataFrame) -> DataFrame:
    """Per fold: validation and training tiles, share, slides, tissue mean and population deviation. A null fold is a fold; null slides and proportions are left out of counts and means; no rows give no rows."""
    everywhere = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = df.groupBy("fold").agg(F.count("*").alias("val_tiles"), F.countDistinct("slide_id").alias("slides"), F.round(F.avg("tissue_prop"), 4).alias("tissue_mean"), F.round(F.stddev_pop("tissue_prop"), 4).alias("tissue_std"))
    total = F.sum("val_tiles").over(everywhere)
    return per.select("fold", "val_tiles", (total - F.col("val_tiles")).alias("train_tiles"), F.round(F.col("val_tiles") / total, 4).alias("val_share"), "slides", "tissue_mean", "tissue_std")


def fold_size_cv(df: DataFrame) -> DataFrame:
    """Population deviation over mean of the folds' sizes; null for an empty table."""
    return df.groupBy("fold").agg(F.count("*").alias("n")).agg(F.round(F.stddev_pop("n") / F.avg("n"), 9).alias("cv"))


def fold_label_distribution(df: DataFrame, labels: list[str], label: str = "label") -> DataFrame:
    """Rows of each fold and label, 0 where there are none; labels that are not listed are not counted. ``label`` may name the stratifying label."""
    return df.groupBy("fold").pivot(label, labels).count().fillna(0)


def tiles_per_slide(df: DataFrame) -> DataFrame:
    """``(slide_id, n)``; null slides count together."""
    return df.groupBy("slide_id").agg(F.count("*").alias("n"))


#: So few slides are looked at one by one on the driver.
_FEW = 10_000


def slide_budget(df: DataFrame, max_tiles: int, seed: int | None = 0) -> DataFrame:
    """Slides in random order (``seed`` None: by id): each is taken if it still fits the budget, else skipped; if none fits, the smallest is taken.

    Slides are dealt into ranges of the order once. A round takes the longest run of slides that fits, whose end is found from the sums of the ranges
    and the running sum of one of them; what is larger than the rest of the budget goes, and the next round begins behind the slide that was skipped. The
    last few slides, ``_FEW`` at most, are looked at on the driver; before, no task holds more than a range. Tiles without a slide are one slide.
    A budget that is not positive and a table without tiles raise at once.
    """
    if max_tiles <= 0:
        raise ValueError("the budget must be positive")
    spark = df.sparkSession
    hashed = F.lit(0).cast("long") if seed is None else F.xxhash64(F.lit(seed), "slide_id")
    slides = tiles_per_slide(df).select(F.struct(hashed.alias("h"), "slide_id").alias("at"), "slide_id", "n")
    ranged = slides.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "at").withColumn("part", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rest, taken, last, many = max_tiles, F.lit(False), None, False
        few: list[tuple[str | None, int]] = []
        while True:
            behind = F.lit(True) if last is None else F.col("at") > last
            left = ranged.filter(behind & (F.col("n") <= rest))
            sums = left.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("k")).orderBy("part").collect()  # a row for each range
            if sum(r.k for r in sums) <= _FEW:
                for r in left.orderBy("at").select("slide_id", "n").collect():
                    if r.n <= rest:
                        few.append((r.slide_id, r.n))
                        rest -= r.n
                break
            before, part, many = 0, None, True
            for r in sums:
                if before + r.n > rest:
                    part = r.part
                    break
                before += r.n
            if part is None:
                taken, rest = taken | (behind & (F.col("n") <= rest)), rest - before
                break
            running = left.filter(F.col("part") == part).withColumn("sum", F.sum("n").over(W.partitionBy("part").orderBy("at")) + before)
            over = running.filter(F.col("sum") > rest).agg(F.min(F.struct("at", "sum", "n")).alias("first")).first()["first"]
            skipped = F.struct(F.lit(over["at"]["h"]).cast("long").alias("h"), F.lit(over["at"]["slide_id"]).cast("string").alias("slide_id"))
            taken = taken | (behind & (F.col("n") <= rest) & (F.col("at") < skipped))
            rest, last = rest - (over["sum"] - over["n"]), skipped
        if not few and rest == max_tiles:
            least = ranged.agg(F.min(F.struct("n", "slide_id")).alias("s")).first()["s"]
            if least is None:
                raise ValueError("no tiles to sample from")
            few = [(least["slide_id"], least["n"])]
    finally:
        ranged.unpersist()
    out = spark.createDataFrame(few, "slide_id string, n long")
    return slides.filter(taken).select("slide_id", "n").unionByName(out) if many else out


def smallest_slide(df: DataFrame) -> DataFrame:
    """The slide of fewest tiles (ties: the first id); a row of nulls for an empty table."""
    return tiles_per_slide(df).agg(F.min(F.struct("n", "slide_id")).alias("s")).select("s.slide_id", "s.n")


def worst_slides(predictions: DataFrame, k: int) -> DataFrame:
    """All tiles of the ``k`` slides of lowest accuracy (ties by id); a null prediction or target is wrong."""
    right = F.coalesce(F.col("pred") == F.col("target"), F.lit(False)).cast("double")
    accuracy = predictions.groupBy("slide_id").agg(F.avg(right).alias("a"))
    return predictions.join(accuracy.orderBy("a", "slide_id").limit(k).select("slide_id"), "slide_id", "left_semi")


def first_slides(df: DataFrame, k: int) -> DataFrame:
    """All tiles of the first ``k`` slides by id; a null slide is never taken."""
    return df.join(df.select("slide_id").distinct().orderBy("slide_id").limit(k), "slide_id", "left_semi")
