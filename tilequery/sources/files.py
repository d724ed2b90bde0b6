"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilequery.functions.columns import path_stem

CATALOGUE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id_stem", "source", "organ")] + [T.StructField("label", T.IntegerType()), T.StructField("wsi_path", T.StringType()), T.StructField("annotation_path", T.StringType())]
    + [T.StructField("mpp_x", T.DoubleType()), T.StructField("mpp_y", T.DoubleType()), T.StructField("magnification", T.IntegerType()), T.StructField("vendor", T.StringType())]
)


def scan_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``(id_stem, path)`` of all files below a folder whose name fits; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select(path_stem(F.col("path")).alias("id_stem"), "path")


def scan_sources(scans: dict[str, DataFrame]) -> DataFrame:
    """One table of several scans, each row with the key of its scan."""
    parts = [df.withColumn("source", F.lit(key)) for key, df in scans.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue from CSV with a header, in the columns of ``CATALOGUE``; fields that do not fit their type are null, an empty file gives no rows."""
    return spark.read.option("header", "true").schema(CATALOGUE).csv(path)


def read_tiles(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet tiles, all columns or some, of which only those are read; a missing column raises."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """``(path, format, doc)``: GeoJSON by ``.geo.json`` or ``.geojson``, Darwin by other ``.json``; other files give no row."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))
    return annotation_format(docs).filter("format IS NOT NULL")


def annotation_format(df: DataFrame) -> DataFrame:
    """``format`` by the suffix of ``path`` in any case; null for others and for a null path."""
    low = F.lower("path")
    return df.withColumn("format", F.when(low.endswith(".geo.json") | low.endswith(".geojson"), "geojson").when(low.endswith(".json"), "darwin"))


def write_tiles(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Parquet, one file for each task; ``schema`` pins names and types."""
    if schema:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    df.write.mode("overwrite").parquet(path)


def file_count(rows: int, rows_per_file: int) -> int:
    return max(1, rows // rows_per_file)


def write_sized(df: DataFrame, path: str, rows_per_file: int = 5000) -> None:
    """Files of at least ``rows_per_file`` rows, as even as a round-robin deals them."""
    df.repartition(file_count(df.count(), rows_per_file)).write.mode("overwrite").parquet(path)


def write_catalogue(df: DataFrame, path: str) -> None:
    """CSV with a header, which replaces what is there; nulls are empty fields. No rows leave a folder that reads as no rows."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_class_map(df: DataFrame, path: str) -> None:
    """Each pair of organ and label once, as JSON lines, which replace what is there; a null part is left out of its line."""
    df.select("organ", "label").distinct().write.mode("overwrite").json(path)


def resolve_template(template: str, **values: str) -> str:
    """The template with each ``{name}`` filled in; a name without a value raises."""
    return template.format(**values)


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark reaches."""
    store, place = _at(spark, path)
    return store.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it; nothing happens where there is none."""
    store, place = _at(spark, path)
    store.delete(place, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder; raises where the store refuses."""
    store, place = _at(spark, old)
    if not store.rename(place, _at(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def store_bucketed(df: DataFrame, table: str, buckets: int, keys: tuple[str, ...] = ("slide_id", "x", "y"), path: str | None = None) -> DataFrame:
    """Save ``df`` as a table in buckets by its keys, sorted inside, and read it. Joins and counts by these keys of tables with as many buckets shuffle nothing.

    Vectors are shuffled once, when they are stored; later joins move only the other side, or nothing. Null keys share a bucket. What the
    table held is replaced; ``path`` names its folder, else it is the warehouse's.
    """
    spread = df.repartition(buckets, *keys)  # a bucket is one file
    writer = spread.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
