"""Catalogue and train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilequery.functions.columns import file_name, group_id

from .tiles import join_nulls


def assign_organ(df: DataFrame, dictionary: DataFrame, path: str = "wsi_path") -> DataFrame:
    """``organ`` by source: MUG from a dictionary on the stem, MOU and TCGA from the folder, FNBRNO fixed, else (also for a null source) Unknown.

    A stem that the dictionary repeats takes the smallest of its organs, so slides are never doubled; a null path has no folder, and a null stem no entry.
    """
    folder = F.lower(F.element_at(F.split(path, "/"), -2))
    source = F.upper("source")
    known = dictionary.groupBy("id_stem").agg(F.min("organ").alias("_known"))
    organ = F.when(source == "MUG", F.coalesce("_known", F.lit("MUG_Unknown"))).when(source.isin("MOU", "TCGA"), folder).when(source == "FNBRNO", F.lit("pancreas")).otherwise(F.lit("Unknown"))
    return df.drop("organ").join(known, "id_stem", "left").withColumn("organ", organ).drop("_known")


def fix_organ_typos(df: DataFrame) -> DataFrame:
    """Known misspellings of organs set right; nulls and other names stay."""
    return df.replace({"gallblader": "gallbladder"}, subset=["organ"])


def assign_group_id(df: DataFrame) -> DataFrame:
    """``group_id`` of each slide (see ``columns.group_id``); null where stem or source is."""
    return df.withColumn("group_id", group_id())


def normalise_metadata(df: DataFrame) -> DataFrame:
    """mpp to 4 places, magnification as a whole number, 0 and N/A where missing."""
    mpp = [F.bround(F.coalesce(F.expr(f"try_cast({c} AS DOUBLE)"), F.lit(0.0)), 4).alias(c) for c in ("mpp_x", "mpp_y")]
    magnification = F.coalesce(F.expr("try_cast(magnification AS DOUBLE)"), F.lit(0.0)).cast("int").alias("magnification")
    return df.select("wsi_path", *mpp, magnification, F.coalesce("vendor", F.lit("N/A")).alias("vendor"))


def pair_annotations(slides: DataFrame, annotations: DataFrame) -> DataFrame:
    """Slides with their annotations by stem: a row for each pair of equal stems, so repeated stems multiply; a null stem pairs with nothing."""
    return slides.join(annotations, "id_stem")


def dense_label_id(df: DataFrame, column: str = "organ") -> DataFrame:
    """``label``: number of the organ among the sorted distinct ones, null for a null organ; the window sees only those. An empty table stays empty."""
    ids = df.select(column).filter(F.col(column).isNotNull()).distinct().withColumn("label", (F.dense_rank().over(W.orderBy(column)) - 1).cast("int"))
    return df.drop("label").join(ids, column, "left")


def order_catalogue(df: DataFrame) -> DataFrame:
    """By source, then stem, nulls first; rows that agree in both have no order."""
    return df.orderBy("source", "id_stem")


def drop_excluded(df: DataFrame, missing: DataFrame) -> DataFrame:
    """Slides whose path is not among the missing ones; a null path stays, repeated rows stay repeated."""
    return df.join(missing, "wsi_path", "left_anti")


def merge_rare_strata(df: DataFrame, least: int = 5) -> DataFrame:
    """``stratify_target`` = source_organ in lower case. An organ with a target below ``least`` rows moves as a whole
    to its sorted sources and its name; targets still below become ``other_rare_organs``.

    A target counts over all spellings of its organ. Null parts are left out of the name; an empty table stays empty.
    """
    df = df.withColumn("_target", F.concat_ws("_", F.lower("source"), F.lower("organ")))
    targets = df.groupBy("organ", "_target").agg(F.count("*").alias("n"))
    small = targets.groupBy("_target").agg(F.sum("n").alias("n"), F.collect_set("organ").alias("organs")).filter(F.col("n") < least).select(F.explode("organs").alias("organ")).distinct()
    merged = df.join(small, "organ", "left_semi").groupBy("organ").agg(F.concat_ws("_", F.array_join(F.array_sort(F.collect_set(F.lower("source"))), "_"), "organ").alias("_merged"))
    df = df.join(merged, "organ", "left").withColumn("_target", F.coalesce("_merged", "_target")).drop("_merged")
    counts = df.groupBy("_target").agg(F.count("*").alias("_n"))
    target = F.when(F.col("_n") < least, F.lit("other_rare_organs")).otherwise(F.col("_target"))
    return df.join(counts, "_target").withColumn("stratify_target", target).drop("_target", "_n")


def _order(seed: int | None, *keys: str) -> Column:
    return F.struct(*keys) if seed is None else F.struct(F.xxhash64(F.lit(seed), *keys), *keys)


def grouped_stratified_split(df: DataFrame, test_size: float = 0.2, seed: int | None = 0) -> DataFrame:
    """``split`` of train or test: groups whole, each stratum near ``test_size``.

    A group's stratum is its most frequent target (ties by name). In hash order (``seed`` None:
    key order) groups go to test while their running size is within the share of the stratum's rows. The
    window runs over groups, one row for each, not over slides. Rows without a group are one group; a null target is a target. An empty table stays empty.
    """
    by = df.groupBy("group_id", "stratify_target").agg(F.count("*").alias("n"))
    groups = by.groupBy("group_id").agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("m"), "stratify_target")).alias("s")).select("group_id", "n", F.col("s.stratify_target").alias("stratum"))
    running = F.sum("n").over(W.partitionBy("stratum").orderBy(_order(seed, "group_id")))
    groups = groups.withColumn("split", F.when(running <= test_size * F.sum("n").over(W.partitionBy("stratum")), "test").otherwise("train"))
    return join_nulls(df, groups.select("group_id", "split"), "group_id")


def group_leakage(train: DataFrame, test: DataFrame) -> DataFrame:
    """Groups of both splits, each once; a null group in both counts as shared."""
    return train.select("group_id").intersect(test.select("group_id"))


def split_statistics(df: DataFrame) -> DataFrame:
    """One row over rows with ``split``: sizes, distinct groups, targets, organs and sources of each split, leakage, share of test.

    Nulls are not counted as values; an empty table gives zeros and a null share.
    """
    per = df.groupBy("group_id").agg(F.countDistinct("split").alias("k")).agg(F.count_if(F.col("k") > 1).alias("leaking_groups"))

    def of(split: str, column: Column) -> Column:
        return F.when(F.col("split") == split, column)

    test = F.count_if(F.col("split") == "test")
    counted = {"groups": "group_id", "targets": "stratify_target", "organs": "organ", "sources": "source"}
    stats = df.agg(
        F.count("*").alias("slides"), F.count_if(F.col("split") == "train").alias("train"), test.alias("test"),
        *[F.countDistinct(of(k, F.col(c))).alias(f"{k}_{n}") for k in ("train", "test") for n, c in counted.items()], F.bround(F.try_divide(test, F.count("*")), 4).alias("test_ratio"),
    )
    return stats.crossJoin(F.broadcast(per))


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, percent)``: shares rounded to 4 places, then times 100."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.select("value", "n", (F.bround(F.col("n") / F.sum("n").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), 4) * 100).alias("percent"))


def compare_distributions(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Shares of each value in both splits, 0 where a split lacks it; a null value stands in a row for each split. Empty splits give no shares."""
    a = class_distribution(train, column).select("value", F.col("percent").alias("train_percent"))
    b = class_distribution(test, column).select("value", F.col("percent").alias("test_percent"))
    return a.join(b, "value", "full").fillna(0.0, ["train_percent", "test_percent"])


def missing_annotations(slides: DataFrame, polygons: DataFrame) -> DataFrame:
    """Slides without a mapped polygon; a null id has none. Repeated slides stay repeated, repeated polygons count once."""
    return slides.join(polygons.select(F.col("slide_id").alias("id")).distinct(), "id", "left_anti")


def slide_basename(df: DataFrame, path: str = "path") -> DataFrame:
    """File name of each slide and of its map; null paths give nulls."""
    return df.select("id", file_name(F.col(path)).alias("file"), F.regexp_replace(file_name(F.col(path)), r"(?<=.)\.[^.]*$", ".tiff").alias("map_file"))


def slide_hash_id(df: DataFrame) -> DataFrame:
    """``id``: SHA-256 of the row as JSON, in column order; nulls are left out of the JSON, so equal rows get equal ids."""
    return df.withColumn("id", F.sha2(F.to_json(F.struct(*df.columns)), 256))
