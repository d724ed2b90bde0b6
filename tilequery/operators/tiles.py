"""Filters, labels, joins and statistics of tiles."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilequery.functions.columns import any_above, coverage_family, first_max, number, total

KEY = ["slide_id", "x", "y"]
QUANTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
BACKGROUND = "background"


def any_annotation(df: DataFrame, prefix: str = "roi_coverage_") -> DataFrame:
    """Rows with a coverage above 0; null counts as 0, NaN never as above."""
    return df.filter(any_above(coverage_family(df, prefix)))


def on_tissue(df: DataFrame, column: str = "roi_tissue_coverage", floor: float = 0.0) -> DataFrame:
    """Rows above the floor; null and NaN are not."""
    return df.filter(number(column) > floor)


def select_tiles(df: DataFrame, **renamed: str) -> DataFrame:
    """Key and coverage columns; ``new=old`` renames."""
    return df.select(*[F.col(old).alias(new) for new, old in renamed.items()], *[c for c in df.columns if "_coverage_" in c])


def label_tiles(df: DataFrame, prefix: str = "roi_coverage_") -> DataFrame:
    """``label``: the class of most coverage (the first of equals), background where all are 0; ``tissue_prop``: their sum."""
    family = coverage_family(df, prefix)
    names = [c.removeprefix(prefix) for c in family]
    return df.withColumn("tissue_prop", total(family)).withColumn("label", F.when(F.col("tissue_prop") == 0, BACKGROUND).otherwise(first_max(family, names)))


def dominant_class(df: DataFrame, classes: list[str], prefix: str = "roi_coverage_") -> DataFrame:
    """``stratum``: the class of most coverage (the first of equals), background where none is above 0; null counts as 0."""
    columns = [prefix + c for c in classes]
    return df.withColumn("stratum", F.when(total(columns) > 0, first_max(columns, classes)).otherwise(BACKGROUND))


def eligible_samples(df: DataFrame, thresholds: dict[str, float], least: float = 0.0, prefix: str = "roi_coverage_") -> DataFrame:
    """Rows of one class at most, with enough tissue and enough of their class; ``label`` is the largest class.

    With ``least`` 0 a row without any coverage is kept and gets the first class, if that class's threshold is 0.
    """
    family = coverage_family(df, prefix)
    names = [c.removeprefix(prefix) for c in family]
    if absent := [n for n in names if n not in thresholds]:
        raise ValueError(f"no threshold for {absent}")
    values = F.array(*[number(c) for c in family])
    limit = F.element_at(F.array(*[F.lit(float(thresholds[n])) for n in names]), F.array_position(values, F.array_max(values)).cast("int"))
    keep = (total(family) >= least) & (F.size(F.filter(values, lambda v: v > 0)) <= 1) & (F.array_max(values) >= limit)
    return df.filter(keep).withColumn("tissue_prop", total(family)).withColumn("label", first_max(family, names))


def select_folds(df: DataFrame, include: list[int] | None = None, exclude: list[int] | None = None) -> DataFrame:
    """Rows of the included folds without the excluded ones; a null fold goes where either is given. Raises without a column ``fold``."""
    if include is None and exclude is None:
        return df
    check_columns(df, "fold")
    if include is not None:
        df = df.filter(F.col("fold").isin(include))
    return df if exclude is None else df.filter(~F.col("fold").isin(exclude))


def join_tissue(tiles: DataFrame, tissue: DataFrame) -> DataFrame:
    """Annotated tiles with their tissue; both sides are filtered before the join. A null in a key meets nothing; repeated keys multiply; no rows on a side give none."""
    return any_annotation(tiles).join(on_tissue(tissue), KEY)


def count_rows(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows, and for each name how many meet its condition (null: not)."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def filter_report(tiles: DataFrame, tissue: DataFrame, prefix: str = "roi_coverage_") -> DataFrame:
    """Rows before, after the annotation filter, and on tissue, in one pass over the tiles."""
    marked = tiles.select(*KEY, any_above(coverage_family(tiles, prefix)).alias("annotated"))
    joined = marked.join(on_tissue(tissue).select(*KEY, F.lit(True).alias("found")), KEY, "left")
    return joined.agg(F.count("*").alias("original"), F.count_if("annotated").alias("annotated"), F.count_if(F.col("annotated") & F.col("found")).alias("on_tissue"))


def coverage_means(df: DataFrame) -> DataFrame:
    """Rows and means of all coverage columns; nulls are left out of a mean, an empty table gives 0 and nulls."""
    return df.agg(F.count("*").alias("tiles"), *[F.round(F.avg(c), 9).alias(c) for c in df.columns if "coverage" in c])


def stratum_counts(df: DataFrame, classes: list[str]) -> DataFrame:
    """Rows of each class and of background, 0 where there are none."""
    all_of = df.sparkSession.createDataFrame([(c,) for c in [*classes, BACKGROUND]], "stratum string")
    counts = dominant_class(df, classes).groupBy("stratum").agg(F.count("*").alias("n"))
    return F.broadcast(all_of).join(counts, "stratum", "left").fillna(0, ["n"])


def long_form(df: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """``(*keys, column, value)`` of the columns; null and NaN values are left out."""
    return df.unpivot(list(keys), columns, "column", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))


def frequencies(df: DataFrame, *keys: str, value: str = "value") -> DataFrame:
    """``(*keys, value, n)``: how often each group has each value. Null and NaN values are left out, a null key is a group of its own, and the two zeros are one value.

    Statistics, quantiles, sweeps and histograms read this table, so the rows below are scanned once: all plans share its shuffle.
    """
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, (v + 0.0).alias("value")).agg(F.count("*").alias("n"))


def same_keys(left: str, right: str, keys: list[str] | tuple[str, ...]) -> Column:
    """Equal keys of two aliases, nulls equal."""
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys], F.lit(True))


def join_nulls(df: DataFrame, other: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """``df`` with the other columns of ``other``; null keys meet null keys."""
    named = other.select(*[F.col(k).alias(f"_key_{k}") if k in keys else F.col(k) for k in other.columns])
    return df.join(named, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]), how).drop(*[f"_key_{k}" for k in keys])


#: Buckets of an octave: values of one bucket agree to five digits.
_COARSE = 1 << 16


def _coarse(v: Column) -> Column:
    """Bucket on a logarithmic scale, in the order of the values."""
    return F.floor(F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.log2(F.abs(v)) + 1075)) * _COARSE)


def _holding(counts: DataFrame, within: list[str], bucket: str, wanted: str) -> DataFrame:
    """Buckets (with ``_m`` rows each) that hold a rank wanted of their group; ranks are then counted from the bucket's first row."""
    before = F.sum("_m").over(W.partitionBy(*within).orderBy(bucket)) - F.col("_m")
    inside = F.filter(F.transform(F.col(wanted), lambda r: F.struct(r["i"].alias("i"), (r["rank"] - F.col("_before")).alias("rank"))), lambda r: (r["rank"] >= 0) & (r["rank"] < F.col("_m")))
    return counts.withColumn("_before", before).withColumn("_w", inside).filter(F.size("_w") > 0)


def _coarse_counts(freq: DataFrame, *keys: str) -> DataFrame:
    """A row for each coarse bucket of :func:`frequencies`: rows, extremes, and sums of the differences to the bucket's own mark and of their squares; and of its group, rows and mean."""
    v = F.col("value")
    # Differences to a mark nearby keep their digits where all values are large and alike.
    mark = F.when(F.abs(v) < float("inf"), F.signum("_a") * F.pow(F.lit(2.0), F.least(F.lit(1023.0), F.abs("_a") / _COARSE - 1075))).otherwise(v)
    rows = freq.select(*keys, "value", "n", _coarse(v).alias("_a")).withColumn("_mark", mark)
    off = F.when(v == F.col("_mark"), 0.0).otherwise(v - F.col("_mark"))
    sums = [F.sum("n").alias("_m"), F.min("value").alias("_low"), F.max("value").alias("_high"), F.any_value("_mark").alias("_mark"), F.sum(off * F.col("n")).alias("_s1"), F.sum(off * off * F.col("n")).alias("_s2")]
    by = W.partitionBy(*keys)
    counts = rows.groupBy(*keys, "_a").agg(*sums).withColumn("_n", F.sum("_m").over(by))
    return counts.withColumn("_mean", F.sum(F.col("_mark") * F.col("_m") + F.col("_s1")).over(by) / F.col("_n"))


def exact_quantiles(freq: DataFrame, *keys: str, coarse: DataFrame | None = None) -> DataFrame:
    """``(*keys, q)``: the nine quantiles of each group of :func:`frequencies`, linear between neighbours.

    Counts of buckets tell which of them hold a quantile's neighbours, and only the different values of these are ranked. Buckets are
    logarithmic, so neither a large group nor an outlier fills a window: one holds a group's buckets, or the values of a bucket.
    """
    coarse = _coarse_counts(freq, *keys) if coarse is None else coarse
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), (F.floor((F.col("_n") - 1) * q) + up).cast("long").alias("rank")) for i, q in enumerate(QUANTILES) for up in (0, 1)])
    held = _holding(coarse.select(*keys, "_a", "_m", "_n", ranks.alias("_ranks")), [*keys], "_a", "_ranks").select(*keys, "_a", "_n", F.col("_w").alias("_ranks"))
    rows = freq.select(*keys, "value", F.col("n").alias("_m"), _coarse(F.col("value")).alias("_a"))
    near = rows.alias("r").join(held.alias("c"), same_keys("r", "c", [*keys, "_a"])).select("r.*", "_n", "_ranks")
    hits = _holding(near, [*keys, "_a"], "value", "_ranks").select(*keys, "_n", "value", F.explode("_w.i").alias("_i"))
    both = hits.groupBy(*keys, "_n", "_i").agg(F.min("value").alias("_x"), F.max("value").alias("_y"))
    part = F.element_at(F.array(*map(F.lit, QUANTILES)), F.col("_i") + 1) * (F.col("_n") - 1)
    q = F.when(F.col("_x") == F.col("_y"), F.col("_x")).otherwise(F.col("_x") + (F.col("_y") - F.col("_x")) * (part - F.floor(part)))
    return both.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", q.alias("_q")))), lambda s: s["_q"]).alias("q"))


def frequency_stats(freq: DataFrame, *keys: str) -> DataFrame:
    """Count, mean, population deviation, extremes and nine quantiles (linear between neighbours) of each group of :func:`frequencies`; all but the quantiles from counts of coarse buckets."""
    coarse = _coarse_counts(freq, *keys)
    far = F.col("_mark") - F.col("_mean")
    squares = F.sum(F.col("_s2") + 2 * far * F.col("_s1") + far * far * F.col("_m"))
    base = coarse.groupBy(*keys).agg(F.sum("_m").alias("n"), F.any_value("_mean").alias("mean"), F.sqrt(F.greatest(F.lit(0.0), squares / F.sum("_m"))).alias("std"), F.min("_low").alias("min"), F.max("_high").alias("max"))
    out = base.alias("b").join(exact_quantiles(freq, *keys, coarse=coarse).alias("q"), same_keys("b", "q", keys)).select("b.*", F.col("q.q").alias("q"))
    return _rounded_stats(out, keys)


def _rounded_stats(out: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    quantiles = [F.round(F.col("q")[i], 6).alias(f"q{int(p * 100):02d}") for i, p in enumerate(QUANTILES)]
    return out.select(*keys, "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max", *quantiles)


def scalar_stats(df: DataFrame, *keys: str, value: str = "value", exact: bool = True) -> DataFrame:
    """:func:`frequency_stats` of rows; ``exact=False`` takes approximate quantiles, in one pass. Null and NaN values are left out, a null key is a group; an empty table gives no rows."""
    if exact:
        return frequency_stats(frequencies(df, *keys, value=value), *keys)
    sound = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    stats = [F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max")]
    return _rounded_stats(sound.groupBy(*keys).agg(*stats, F.percentile_approx(value, list(QUANTILES), 10000).alias("q")), keys).filter("n > 0")


def histogram_bin(value: Column, bins: int = 20) -> Column:
    """0-based bin on [0, 1], half-open, the last closed; null outside. Edges are ``i / bins`` as ``i * (1 / bins)``."""
    guess = F.least(F.floor(value * bins).cast("int"), F.lit(bins - 1))
    step = 1.0 / bins
    low, high = guess * F.lit(step), (guess + 1) * F.lit(step)
    fixed = F.when(value < low, guess - 1).when((value >= high) & (guess < bins - 1), guess + 1).otherwise(guess)
    return F.when((value >= 0) & (value <= 1), fixed)


def frequency_histogram(freq: DataFrame, *keys: str, bins: int = 20) -> DataFrame:
    """``(*keys, bin, n)`` of :func:`frequencies`, empty bins as 0; a group whose values are all outside [0, 1] has empty bins only."""
    places = F.array(*[F.sum(F.when(F.col("_bin") == i, F.col("n")).otherwise(0)).alias(f"_{i}") for i in range(bins)])
    wide = freq.withColumn("_bin", histogram_bin(F.col("value"), bins)).groupBy(*keys).agg(places.alias("_n"))
    return wide.select(*keys, F.posexplode("_n").alias("bin", "n")).withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def coverage_histogram(df: DataFrame, *keys: str, value: str = "value", bins: int = 20) -> DataFrame:
    """:func:`frequency_histogram` of rows; null and NaN values are left out, a null key is a group. Without ``keys`` an empty table gives empty bins."""
    return frequency_histogram(frequencies(df, *keys, value=value), *keys, bins=bins)


def frequency_sweep(freq: DataFrame, n: int = 1000, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(*keys, i, threshold, above)``: rows of each group of :func:`frequencies` strictly above each of ``n`` evenly spaced thresholds on [0, 1].

    Values are put into buckets once; a reverse running sum over at most ``n + 1`` buckets of a group gives all counts.
    """
    step = F.lit(1.0) / (n - 1)
    v = F.col("value")
    guess = F.greatest(F.lit(0), F.least(F.ceil(v * (n - 1)), F.lit(n))).cast("int")  # thresholds 0 .. guess - 1 are below v
    fixed = F.when((guess > 0) & ((guess - 1) * step >= v), guess - 1).when((guess < n) & (guess * step < v), guess + 1).otherwise(guess)
    # A map of the filled buckets for each group, from which the empty ones are told: no join, so null keys stay.
    held = freq.groupBy(*keys, fixed.cast("int").alias("_bucket")).agg(F.sum("n").alias("_c"))
    if not keys:
        held = held.unionByName(freq.sparkSession.range(1).select(F.lit(0).alias("_bucket"), F.lit(0).cast("long").alias("_c")))
    per = held.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_bucket", "_c"))).alias("_map")) if keys else held.groupBy("_bucket").agg(F.sum("_c").alias("_c")).agg(F.map_from_entries(F.collect_list(F.struct("_bucket", "_c"))).alias("_map"))
    filled = per.select(*keys, F.explode(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda b: F.struct(b.alias("b"), F.coalesce(F.try_element_at("_map", b), F.lit(0).cast("long")).alias("c")))).alias("_s"))
    above = F.sum("_s.c").over(W.partitionBy(*keys).orderBy(F.col("_s.b").desc()))
    out = filled.select(*keys, (F.col("_s.b") - 1).alias("i"), above.alias("above"))
    return out.select(*keys, "i", (F.col("i") * step).alias("threshold"), "above")


def threshold_sweep(df: DataFrame, n: int = 1000, value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """:func:`frequency_sweep` of rows; null and NaN values are left out, a null key is a group. Without ``keys`` an empty table gives zeros."""
    return frequency_sweep(frequencies(df, *keys, value=value), n, keys)


def _coverage_frequencies(tiles: DataFrame, tissue: DataFrame, classes: list[str], prefix: str, tissue_column: str) -> DataFrame:
    """Frequencies by ``column`` and ``stratum`` of the joined tiles: class columns over all rows (``all``), tissue by dominant class."""
    rows = dominant_class(join_tissue(tiles, tissue), classes, prefix)
    values = [F.struct(F.lit(prefix + c).alias("column"), F.lit("all").alias("stratum"), F.col(prefix + c).cast("double").alias("value")) for c in classes]
    values.append(F.struct(F.lit(tissue_column).alias("column"), F.col("stratum").alias("stratum"), F.col(tissue_column).cast("double").alias("value")))
    return frequencies(rows.select(F.inline(F.array(*values))), "column", "stratum")


def _restratified(freq: DataFrame, strata: Column) -> DataFrame:
    """Frequencies with each row in all of the strata of an array, which may be empty; the filter stays above the counts, whose shuffle all readers then share."""
    moved = freq.select("column", F.explode_outer(strata).alias("stratum"), "value", "n").filter("stratum IS NOT NULL")
    return moved.groupBy("column", "stratum", "value").agg(F.sum("n").alias("n"))


def threshold_report(tiles: DataFrame, tissue: DataFrame, classes: list[str], prefix: str = "roi_coverage_", tissue_column: str = "roi_tissue_coverage", exact: bool = True) -> DataFrame:
    """Statistics of the joined tiles: each class column over all rows (stratum ``all``), and tissue overall and by dominant class.

    Strata without rows are absent; nulls and NaN are left out; no joined rows give no rows. All of it comes from one table of frequencies; ``exact=False`` scans the rows for approximate quantiles.
    """
    if not exact:
        rows = dominant_class(join_tissue(tiles, tissue), classes, prefix)
        own = long_form(rows, [prefix + c for c in classes]).select("column", F.lit("all").alias("stratum"), "value")
        tissue_rows = long_form(rows, [tissue_column], "stratum").select("column", F.explode(F.array("stratum", F.lit("all"))).alias("stratum"), "value")
        return scalar_stats(own.unionByName(tissue_rows), "column", "stratum", exact=False)
    freq = _coverage_frequencies(tiles, tissue, classes, prefix, tissue_column)
    both = F.when(F.col("column") == tissue_column, F.array("stratum", F.lit("all"))).otherwise(F.array("stratum"))
    return frequency_stats(_restratified(freq, both), "column", "stratum")


def threshold_curves(tiles: DataFrame, tissue: DataFrame, classes: list[str], prefix: str = "roi_coverage_", tissue_column: str = "roi_tissue_coverage", n: int = 1000) -> DataFrame:
    """The whole threshold analysis of the joined tiles, as ``(column, stratum, kind, key, value)``, from one table of frequencies.

    Each class column over all rows, and tissue by dominant class (groups without rows are absent): ``stat``, ``sweep`` of ``n``
    thresholds, ``histogram`` of 20 bins. Tissue over all rows: ``stat``. Tissue of annotated and of background rows: ``histogram_binary``.
    """
    freq = _coverage_frequencies(tiles, tissue, classes, prefix, tissue_column)
    group, is_tissue = ("column", "stratum"), F.col("column") == tissue_column
    stats = frequency_stats(_restratified(freq, F.when(is_tissue, F.array("stratum", F.lit("all"))).otherwise(F.array("stratum"))), *group)
    names = [c for c in stats.columns if c not in group]
    stats = stats.select(*group, *[F.col(c).cast("double") for c in names]).unpivot(list(group), names, "key", "value")
    side = F.when(F.col("stratum") == BACKGROUND, BACKGROUND).otherwise("annotated")
    binary = _restratified(freq, F.when(is_tissue, F.array(side)))
    parts = [
        stats.select(*group, F.lit("stat").alias("kind"), "key", "value"),
        frequency_sweep(freq, n, keys=group).select(*group, F.lit("sweep").alias("kind"), F.col("i").cast("string").alias("key"), F.col("above").cast("double").alias("value")),
        frequency_histogram(freq, *group).select(*group, F.lit("histogram").alias("kind"), F.col("bin").cast("string").alias("key"), F.col("n").cast("double").alias("value")),
        frequency_histogram(binary, *group).select(*group, F.lit("histogram_binary").alias("kind"), F.col("bin").cast("string").alias("key"), F.col("n").cast("double").alias("value")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def metrics_table(df: DataFrame, split: str, metric: str) -> DataFrame:
    """A one-row table of numbers as ``(split, metric, key, value)``; a null number stays as a null value, further rows give further rows, an empty table none."""
    wide = df.select(*[F.col(c).cast("double") for c in df.columns])
    return wide.unpivot([], wide.columns, "key", "value").select(F.lit(split).alias("split"), F.lit(metric).alias("metric"), "key", "value")


def attach_slide_info(tiles: DataFrame, slides: DataFrame) -> DataFrame:
    """Tiles with path, level and tile size of their slide, which replace columns of these names; tiles of unknown slides go."""
    info = slides.select(F.col("id").alias("slide_id"), "path", "level", "tile_extent_x", "tile_extent_y")
    return tiles.drop(*info.columns[1:]).join(info, "slide_id")


def attach_annotation_path(slides: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Slides with the annotation path of their slide path, empty where the catalogue has none; a path that the catalogue repeats repeats its slide."""
    paths = catalogue.select(F.col("wsi_path").alias("path"), "annotation_path")
    return slides.join(paths, "path", "left").withColumn("annotation_path", F.coalesce("annotation_path", F.lit("")))


def slides_with_masks(slides: DataFrame, masks: DataFrame, wanted: list[str], check: bool = False) -> tuple[DataFrame, DataFrame]:
    """(slides that have every wanted mask, slides that lack one). ``check`` raises where no slide has them all."""
    full = masks.filter(F.col("mask").isin(wanted)).groupBy(F.col("slide_id").alias("id")).agg(F.countDistinct("mask").alias("k")).filter(F.col("k") == len(wanted)).select("id")
    have = slides.join(full, "id", "left_semi")
    return check_not_empty(have, "slides with every mask") if check else have, slides.join(full, "id", "left_anti")


def select_slides(tiles: DataFrame, chosen: DataFrame) -> DataFrame:
    """Tiles of the chosen slides, which may repeat; a null slide is never chosen."""
    return tiles.join(chosen.select("slide_id"), "slide_id", "left_semi")


def map_class_index(df: DataFrame, classes: list[str], label: str = "label") -> DataFrame:
    """``target``: place of the label among the classes; other labels raise when the row is read."""
    place = F.array_position(F.array(*map(F.lit, classes)), F.col(label)).cast("int") - 1
    return df.withColumn("target", F.when(place >= 0, place).otherwise(F.raise_error(F.concat(F.lit("unknown label "), F.coalesce(label, F.lit("null")))).cast("int")))


def missing_keys(wanted: DataFrame, given: DataFrame) -> DataFrame:
    """Rows of ``wanted`` that ``given`` lacks, repeats counted: two wanted and one given leave one. Nulls are equal."""
    return wanted.exceptAll(given)


def require_slides(tiles: DataFrame, slides: DataFrame) -> DataFrame:
    """Tiles with their slide; a tile of an unknown slide raises when it is read."""
    info = slides.withColumnRenamed("id", "slide_id").withColumn("_known", F.lit(True))
    joined = tiles.join(info, "slide_id", "left")
    sure = F.when(F.col("_known"), F.col("slide_id")).otherwise(F.raise_error(F.concat(F.lit("unknown slide "), F.coalesce("slide_id", F.lit("null")))))
    return joined.withColumn("slide_id", sure).drop("_known")


def join_embeddings(meta: DataFrame, vectors: DataFrame, check: bool = False) -> DataFrame:
    """Rows of ``meta`` with their vector, which replaces an ``embedding`` of theirs; rows without one go. ``check`` raises where none is left."""
    out = meta.drop("embedding").join(vectors.select(*KEY, "embedding"), KEY)
    return check_not_empty(out, "join with vectors") if check else out


def check_not_empty(df: DataFrame, what: str) -> DataFrame:
    """``df``; raises where it has no rows."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows left")
    return df


def check_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df``; raises where it lacks one of the columns."""
    if absent := [n for n in names if n not in df.columns]:
        raise ValueError(f"no column {absent}")
    return df


def check_slide_ids(df: DataFrame, column: str = "slide_id") -> DataFrame:
    """Raise on an empty table and on null slide ids."""
    rows, nulls = df.agg(F.count("*"), F.count_if(F.col(column).isNull())).first()
    if not rows or nulls:
        raise ValueError(f"{nulls} null slide ids in {rows} rows" if rows else "the table of tiles is empty")
    return df


def filter_tiles(tiles: DataFrame, tissue: DataFrame, tissue_column: str = "roi_tissue_coverage") -> DataFrame:
    """The filter job with its checks: annotated tiles on tissue. Raises where the annotation or the tissue filter leaves nothing."""
    check_columns(tissue, tissue_column)
    marked = check_not_empty(any_annotation(tiles), "annotation filter")
    return check_not_empty(marked.join(on_tissue(tissue, tissue_column), KEY), "tissue filter")
