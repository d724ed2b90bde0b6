"""Jobs: an operator, its checks, and the table it writes, in one run of the plan.

Checks count rows while they stream to the sink (``DataFrame.observe``), so nothing is computed for a check alone. A job writes beside its target,
and takes the target's place only when all checks hold: a failed job leaves the target as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilequery.sources.files import delete, exists, move

from .folds import balanced_group_folds, collapse_rare_labels, drop_rare_class_slides, stratified_folds, stratified_group_folds
from .geometry import mask_coverage
from .modelling import training_set
from .tiles import BACKGROUND, KEY, any_annotation, check_columns, label_tiles, on_tissue

STRATEGIES = {"stratified": stratified_folds, "stratified_group": stratified_group_folds, "balanced_group": balanced_group_folds}


class Checks:
    """Counts taken while a plan runs, and what they must fulfil."""

    def __init__(self) -> None:
        self._seen: list[tuple[Observation, str, Callable[[dict[str, int]], str | None]]] = []

    def watch(self, df: DataFrame, what: str, fault: Callable[[dict[str, int]], str | None], **counts: Column) -> DataFrame:
        """``df``, counted on its way: ``rows``, and how many meet each condition; ``fault`` says what is wrong with the counts, or nothing."""
        seen = Observation(f"{what}-{uuid.uuid4().hex}")
        self._seen.append((seen, what, fault))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])

    def some(self, df: DataFrame, what: str) -> DataFrame:
        """``df``, which must have rows."""
        return self.watch(df, what, lambda c: None if c["rows"] else "no rows left")

    def faults(self) -> list[str]:
        """What is wrong, in the order of the checks. Where Spark finds a table empty while it runs, it leaves out the part of the plan that made it, and
        the counts there: they are 0 if the last check saw no rows, so that nothing was written, and else unknown."""
        found = [(_counts(seen), what, fault) for seen, what, fault in self._seen]
        nothing = bool(found) and not (found[-1][0] or _Zero())["rows"]
        told = [(counts if counts is not None else _Zero(), what, fault) for counts, what, fault in found if counts is not None or nothing]
        return [f"{what}: {said}" for counts, what, fault in told if (said := fault(counts))]


def _counts(seen: Observation) -> dict[str, int] | None:
    try:
        return seen.get
    except Py4JJavaError:  # there is no row of counts
        return None


class _Zero(dict):
    def __missing__(self, key: str) -> int:
        return 0


def write_checked(df: DataFrame, path: str, checks: Checks) -> None:
    """Write Parquet to ``path`` if the checks that watch ``df``'s plan hold; else raise with all that is wrong, and leave ``path`` as it was. What was there is replaced."""
    spark, aside = df.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        df.write.parquet(aside)
        if faults := checks.faults():
            raise ValueError("; ".join(faults))
        if exists(spark, path):
            delete(spark, path)
        move(spark, aside, path)
    finally:
        if exists(spark, aside):
            delete(spark, aside)


def filter_job(tiles: DataFrame, tissue: DataFrame, path: str, tissue_column: str = "roi_tissue_coverage") -> None:
    """Annotated tiles on tissue. Raises where a column is missing, or where the annotation or the tissue filter leaves nothing."""
    check_columns(tissue, tissue_column)
    checks = Checks()
    marked = checks.some(any_annotation(tiles), "annotation filter")
    write_checked(checks.some(marked.join(on_tissue(tissue, tissue_column), KEY), "tissue filter"), path, checks)


def coverage_job(tiles: DataFrame, slides: DataFrame, sizes: DataFrame, cells: DataFrame, path: str) -> None:
    """:func:`mask_coverage` of tiles. Raises on an empty table of tiles, on tiles without a slide, and where no mask belongs to a slide."""
    checks = Checks()
    given = checks.watch(tiles, "tiles", lambda c: None if c["rows"] else "the table is empty")
    given = checks.watch(given, "tiles", lambda c: f"{c['nulls']} null slide ids" if c["nulls"] else None, nulls=F.col("slide_id").isNull())
    write_checked(checks.some(mask_coverage(given, slides, sizes, cells), "masks of slides"), path, checks)


def folds_job(tiles: DataFrame, path: str, strategy: str = "stratified", n_folds: int = 5, **how) -> None:
    """Labelled tiles with ``fold``. Raises on an unknown strategy or fewer than two folds, and where no label is common enough, tiles lack a slide, or collapsed labels leave background too small."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy {strategy}: one of {sorted(STRATEGIES)}")
    if n_folds < 2:
        raise ValueError("at least two folds")
    checks = Checks()
    rows = label_tiles(tiles)
    if strategy == "stratified":
        rows = checks.watch(collapse_rare_labels(rows, n_folds), "labels", lambda c: f"background has {c['background']} rows for {n_folds} folds" if c["moved"] and c["background"] < n_folds else None, moved=F.col("stratify_label") != F.col("label"), background=F.col("stratify_label") == BACKGROUND)
        how = {"label": "stratify_label"} | how
    else:
        rows = drop_rare_class_slides(rows, n_folds)
    out = checks.watch(STRATEGIES[strategy](rows, n_folds, **how), "folds", lambda c: "no rows left" if not c["rows"] else f"{c['nulls']} null slide ids" if c["nulls"] else None, nulls=F.col("slide_id").isNull())
    write_checked(out, path, checks)


def training_job(vectors: DataFrame, meta: DataFrame, classes: list[str], thresholds: dict[str, float], path: str, least: float = 0.0, include: list[int] | None = None, exclude: list[int] | None = None) -> None:
    """:func:`training_set`. Raises on a class without a threshold, on a missing column ``fold`` where folds are chosen, and where the filters or the join leave nothing."""
    checks = Checks()
    rows = checks.some(meta, "tiles")
    write_checked(checks.some(training_set(vectors, rows, classes, thresholds, least, include, exclude), "filters and join with vectors"), path, checks)


def resume_by_slide(slides: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, slides_per_run: int = 1000) -> int:
    """Write ``work(slides)`` slide by slide so that a broken run can go on; returns how many slides were left to do.

    ``work`` maps some rows of ``slides`` (by ``id``) to rows with ``slide_id``. Slides are dealt by hash into runs of about ``slides_per_run``; a
    run's slides are written as partitions, replacing what a broken run may have left of them, and then noted in ``<path>/_done``. A later
    call skips the noted slides. The first run pins names and types (``<path>/_columns``); rows are cast to them, and a missing column raises. Slides without
    rows are noted too; repeated ids are done once, null ids are left out. An empty table of slides writes nothing.
    """
    spark = slides.sparkSession
    named = slides.filter("id IS NOT NULL").dropDuplicates(["id"])
    done = f"{path.rstrip('/')}/_done"
    left = named.join(spark.read.schema("id string").parquet(done), "id", "left_anti") if exists(spark, done) else named
    count = left.count()
    runs = max(1, -(-count // slides_per_run))
    run_of = F.pmod(F.xxhash64("id"), F.lit(runs))
    if count:
        left_ids = left.select("id").persist()
        try:
            left_ids.count()  # what is left is settled before the first run adds to the notes
            for k in range(runs):
                ids = left_ids.filter(run_of == k)
                if ids.isEmpty():
                    continue
                rows = _pinned(work(named.join(ids, "id", "left_semi")), path)
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slide_id").parquet(path)
                ids.write.mode("append").parquet(done)
        finally:
            left_ids.unpersist()
    return count


def _pinned(rows: DataFrame, path: str) -> DataFrame:
    spark, at = rows.sparkSession, f"{path.rstrip('/')}/_columns"
    if not exists(spark, at):
        spark.createDataFrame([(rows.schema.json(),)], "value string").coalesce(1).write.text(at)
    schema = pinned_schema(spark, path)
    check_columns(rows, *schema.names)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def pinned_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns that the first run of :func:`resume_by_slide` fixed."""
    import json

    return T.StructType.fromJson(json.loads(spark.read.text(f"{path.rstrip('/')}/_columns").first().value))


def read_by_slide(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`resume_by_slide` has written so far, with its own names and types."""
    schema = pinned_schema(spark, path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)
