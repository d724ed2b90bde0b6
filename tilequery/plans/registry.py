"""Queries over the derived tables, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilequery.functions import columns as C
from tilequery.operators import catalogue as cat
from tilequery.operators import folds, geometry, modelling, tiles
from tilequery.sources.files import annotation_format, scan_sources
from tilequery.sources.fixtures import table, with_tables

CLASSES = ["A", "N", "R"]
ROI = [f"roi_coverage_{c}" for c in CLASSES]
THRESHOLDS = {"A": 0.0, "N": 0.2, "R": 0.1}
KEY = "slide_id, x, y"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *names: str):
    """Register a function as the query of its name; ``sql`` reads the named derived tables."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_tables(sql, *names)
        return f

    return register


# SQL fragments that several oracles share.
LABEL = "CASE WHEN roi_coverage_A >= roi_coverage_N AND roi_coverage_A >= roi_coverage_R THEN 'A' WHEN roi_coverage_N >= roi_coverage_R THEN 'N' ELSE 'R' END"
SUM = "(roi_coverage_A + roi_coverage_N + roi_coverage_R)"
ANY = "(roi_coverage_A > 0 OR roi_coverage_N > 0 OR roi_coverage_R > 0)"
STRATUM = f"CASE WHEN {SUM} > 0 THEN {LABEL} ELSE 'background' END"
ELIGIBLE = f"""{SUM} >= 0 AND (CASE WHEN roi_coverage_A > 0 THEN 1 ELSE 0 END + CASE WHEN roi_coverage_N > 0 THEN 1 ELSE 0 END + CASE WHEN roi_coverage_R > 0 THEN 1 ELSE 0 END) <= 1
  AND greatest(roi_coverage_A, roi_coverage_N, roi_coverage_R) >= CASE {LABEL} WHEN 'A' THEN 0.0 WHEN 'N' THEN 0.2 ELSE 0.1 END"""
JOINED = f"SELECT t.*, s.tile_tissue_coverage, s.roi_tissue_coverage FROM tiles t JOIN tissue s USING ({KEY}) WHERE {ANY} AND roi_tissue_coverage > 0"
LABELLED = f"SELECT *, {SUM} AS tissue_prop, CASE WHEN {SUM} = 0 THEN 'background' ELSE {LABEL} END AS label FROM tiles"
GROUPED = "SELECT *, CASE WHEN upper(source) = 'TCGA' THEN substr(id_stem, 1, 12) ELSE id_stem END AS group_id FROM catalogue"
MERGED = f"""WITH g AS ({GROUPED}), a AS (SELECT *, lower(source) || '_' || lower(organ) AS t0 FROM g),
small AS (SELECT DISTINCT organ FROM a WHERE t0 IN (SELECT t0 FROM a GROUP BY t0 HAVING count(*) < 5)),
m AS (SELECT organ, array_to_string(list_sort(list(DISTINCT lower(source))), '_') || '_' || organ AS t1 FROM a WHERE organ IN (SELECT organ FROM small) GROUP BY organ),
b AS (SELECT a.*, coalesce(t1, t0) AS t2 FROM a LEFT JOIN m ON a.organ = m.organ),
c AS (SELECT t2, count(*) AS n FROM b GROUP BY t2),
strata AS (SELECT b.*, CASE WHEN n < 5 THEN 'other_rare_organs' ELSE b.t2 END AS stratify_target FROM b JOIN c ON b.t2 = c.t2)"""
SPLIT = f"""{MERGED}, w AS (SELECT group_id, stratify_target, count(*) AS n FROM strata GROUP BY 1, 2),
h AS (SELECT group_id, sum(n) AS n, min({{'m': -n, 's': stratify_target}}).s AS stratum FROM w GROUP BY 1),
r AS (SELECT *, CASE WHEN sum(n) OVER (PARTITION BY stratum ORDER BY group_id) <= 0.2::DOUBLE * sum(n) OVER (PARTITION BY stratum) THEN 'test' ELSE 'train' END AS split FROM h),
parted AS (SELECT strata.*, split FROM strata JOIN r ON strata.group_id = r.group_id)"""
FOLDS = f"""WITH l AS ({LABELLED}), f AS (SELECT *, CAST((row_number() OVER (ORDER BY label, slide_id, x, y) - 1) % 5 AS INT) AS g FROM l),
k AS (SELECT l.*, CAST((row_number() OVER (PARTITION BY label ORDER BY slide_id, x, y) - 1) % 5 AS INT) AS fold FROM l)"""
PREDICTED = "prob_A, prob_N, prob_R"


def _t(spark, sf, *names):
    out = [table(spark, sf, n) for n in names]
    return out[0] if len(out) == 1 else out


def _labelled(spark, sf):
    return tiles.label_tiles(_t(spark, sf, "tiles"))


def _folded(spark, sf):
    return folds.stratified_folds(_labelled(spark, sf), 5, None)


def _strata(spark, sf):
    return cat.merge_rare_strata(cat.assign_group_id(_t(spark, sf, "catalogue")))


def _parted(spark, sf):
    return cat.grouped_stratified_split(_strata(spark, sf), 0.2, None)


# --- scans, columns and filters -------------------------------------------------------------------


@query("SELECT 'docs' AS source, doc_id AS id FROM documents UNION ALL SELECT 'vecs', vec_id FROM embeddings", "documents", "base")
def scan_sources_union(spark, sf):
    docs, vecs = _t(spark, sf, "documents", "embeddings")
    return scan_sources({"docs": docs.select(F.col("doc_id").alias("id")), "vecs": vecs.select(F.col("vec_id").alias("id"))})


@query(f"SELECT {KEY}, roi_coverage_A FROM tiles", "tiles")
def read_tiles(spark, sf):
    return _t(spark, sf, "tiles").select("slide_id", "x", "y", "roi_coverage_A")


@query(f"SELECT count(*) AS rows, count(*) FILTER (WHERE {ANY}) AS annotated FROM tiles", "tiles")
def count_rows(spark, sf):
    return tiles.count_rows(_t(spark, sf, "tiles"), annotated=C.any_above(ROI))


@query(f'SELECT slide_id, lower(name) AS name, CAST("left" AS DOUBLE) AS x0, CAST(top AS DOUBLE) AS y0, "right" AS x1, bottom AS y1, q.format FROM (SELECT s.*, CASE WHEN "left" % 3 = 0 THEN \'darwin\' ELSE \'geojson\' END AS format FROM squares s) q', "squares")
def read_annotation_documents(spark, sf):
    """Texts of both formats, parsed: a document for each grid column of a slide."""
    squares = _t(spark, sf, "squares").withColumn("format", F.when(F.col("left") % 3 == 0, "darwin").otherwise("geojson"))
    docs = _documents(spark, sf, squares.filter("format = 'geojson'")).withColumn("format", F.lit("geojson"))
    docs = docs.unionByName(_documents(spark, sf, squares.filter("format = 'darwin'"), _darwin).withColumn("format", F.lit("darwin")))
    names = spark.createDataFrame([("nerve", "NERVE", 0), ("fat", "Fat", 1)], "class string, raw_name string, class_index int")
    flat = geometry.flatten_annotations(docs, names)
    corner = F.col("rings")[0]
    read_as = F.when(corner[0][0] % 3 == 0, "darwin").otherwise("geojson")
    return flat.select("slide_id", F.col("class").alias("name"), corner[0][0].alias("x0"), corner[0][1].alias("y0"), corner[2][0].alias("x1"), corner[2][1].alias("y1"), read_as.alias("format"))


@query("SELECT annotation_path AS path, CASE WHEN lower(annotation_path) LIKE '%.geo.json' OR lower(annotation_path) LIKE '%.geojson' THEN 'geojson' WHEN lower(annotation_path) LIKE '%.json' THEN 'darwin' END AS format FROM catalogue", "catalogue")
def read_annotations(spark, sf):
    return annotation_format(_t(spark, sf, "catalogue").select(F.col("annotation_path").alias("path")))


@query("SELECT id_stem, 'out/' || source || '/' || id_stem || '.parquet' AS path FROM catalogue", "catalogue")
def resolve_template(spark, sf):
    return _t(spark, sf, "catalogue").select("id_stem", C.fill_template(F.lit("out/{split}/{stem}.parquet"), split=F.col("source"), stem=F.col("id_stem")).alias("path"))


@query(f"SELECT 'train' AS split, 'filter' AS metric, key, value FROM (SELECT 'rows' AS key, count(*)::DOUBLE AS value FROM tiles UNION ALL SELECT 'annotated', count(*) FILTER (WHERE {ANY})::DOUBLE FROM tiles)", "tiles")
def metrics_table(spark, sf):
    return tiles.metrics_table(count_rows(spark, sf), "train", "filter")


@query("SELECT annotation_path AS path, regexp_replace(annotation_path, '^.*/(.*)\\.geo\\.json$', '\\1') AS stem, regexp_replace(wsi_path, '^.*/(.*)\\.[^.]*$', '\\1') AS slide_stem FROM catalogue", "catalogue")
def path_stem(spark, sf):
    return _t(spark, sf, "catalogue").select(F.col("annotation_path").alias("path"), C.path_stem(F.col("annotation_path")).alias("stem"), C.path_stem(F.col("wsi_path")).alias("slide_stem"))


@query("""SELECT c.id_stem, CASE upper(source) WHEN 'MUG' THEN coalesce(k.organ, 'MUG_Unknown') WHEN 'MOU' THEN lower(c.organ) WHEN 'TCGA' THEN lower(c.organ) WHEN 'FNBRNO' THEN 'pancreas' ELSE 'Unknown' END AS organ
FROM catalogue c LEFT JOIN (SELECT id_stem, 'o' || organ AS organ FROM catalogue WHERE label = 1) k ON c.id_stem = k.id_stem""", "catalogue")
def assign_organ(spark, sf):
    c = _t(spark, sf, "catalogue")
    known = c.filter("label = 1").select("id_stem", F.concat(F.lit("o"), "organ").alias("organ"))
    return cat.assign_organ(c, known).select("id_stem", "organ")


@query(f"SELECT id_stem, group_id FROM ({GROUPED})", "catalogue")
def assign_group_id(spark, sf):
    return cat.assign_group_id(_t(spark, sf, "catalogue")).select("id_stem", "group_id")


@query("SELECT id_stem, CASE WHEN organ = 'de' THEN 'gallbladder' ELSE organ END AS organ FROM catalogue", "catalogue")
def fix_organ_typos(spark, sf):
    c = _t(spark, sf, "catalogue").withColumn("organ", F.when(F.col("organ") == "de", "gallblader").otherwise(F.col("organ")))
    return cat.fix_organ_typos(c).select("id_stem", "organ")


@query(f"SELECT {KEY} FROM tiles WHERE {ANY}", "tiles")
def any_annotation(spark, sf):
    return tiles.any_annotation(_t(spark, sf, "tiles")).select("slide_id", "x", "y")


@query(f"SELECT {KEY}, roi_tissue_coverage FROM tissue WHERE roi_tissue_coverage > 0.3", "tissue")
def on_tissue(spark, sf):
    return tiles.on_tissue(_t(spark, sf, "tissue"), floor=0.3).select("slide_id", "x", "y", "roi_tissue_coverage")


@query(f"SELECT {KEY}, label, tissue_prop FROM ({LABELLED})", "tiles")
def label_tiles(spark, sf):
    return _labelled(spark, sf).select("slide_id", "x", "y", "label", "tissue_prop")


@query(f"SELECT {KEY}, {STRATUM} AS stratum FROM tiles", "tiles")
def dominant_class(spark, sf):
    return tiles.dominant_class(_t(spark, sf, "tiles"), CLASSES).select("slide_id", "x", "y", "stratum")


@query(f"SELECT {KEY}, {LABEL} AS label, {SUM} AS tissue_prop FROM tiles WHERE {ELIGIBLE}", "tiles")
def eligible_samples(spark, sf):
    return tiles.eligible_samples(_t(spark, sf, "tiles"), THRESHOLDS).select("slide_id", "x", "y", "label", "tissue_prop")


@query(f"{FOLDS} SELECT {KEY}, g AS fold FROM f WHERE g IN (0, 1, 2) AND g NOT IN (1)", "tiles")
def select_folds(spark, sf):
    return tiles.select_folds(_folded(spark, sf), [0, 1, 2], [1]).select("slide_id", "x", "y", "fold")


@query("SELECT slide_id, x AS tile_x, y AS tile_y, tile_coverage_A, tile_coverage_N, tile_coverage_R, roi_coverage_A, roi_coverage_N, roi_coverage_R FROM tiles", "tiles")
def select_tiles(spark, sf):
    return tiles.select_tiles(_t(spark, sf, "tiles"), slide_id="slide_id", tile_x="x", tile_y="y")


@query("SELECT id, id || '.svs' AS file, id || '.tiff' AS map_file FROM slides", "slides")
def slide_basename(spark, sf):
    return cat.slide_basename(_t(spark, sf, "slides"))


@query("""SELECT sha256('{"path":"' || path || '","level":0,"extent_x":896,"extent_y":28784,"tile_extent_x":224,"tile_extent_y":224,"stride_x":112,"stride_y":112,"mpp_x":0.5,"mpp_y":0.5,"downsample":1.0}') AS id, path FROM slides""", "slides")
def slide_hash_id(spark, sf):
    return cat.slide_hash_id(_t(spark, sf, "slides").drop("id")).select("id", "path")


@query("SELECT wsi_path, 0.25::DOUBLE * 0 + 0.2525 AS mpp_x, 0.0::DOUBLE AS mpp_y, CAST(20 + label AS INT) AS magnification, CASE WHEN label = 1 THEN 'N/A' ELSE vendor END AS vendor FROM catalogue", "catalogue")
def normalise_metadata(spark, sf):
    c = _t(spark, sf, "catalogue")
    return cat.normalise_metadata(c.select("wsi_path", F.lit("0.25250001").alias("mpp_x"), F.lit("none").alias("mpp_y"), F.concat((F.lit(20) + F.col("label")).cast("string"), F.lit(".9")).alias("magnification"), F.when(F.col("label") == 0, F.col("vendor")).alias("vendor")))


@query("SELECT DISTINCT organ, source, 'a_' || source || '_' || organ AS name FROM (SELECT source, organ FROM catalogue)", "catalogue")
def safe_name(spark, sf):
    return _t(spark, sf, "catalogue").select("organ", "source", C.safe_name(F.concat(F.lit("a:;"), "source", F.lit("//"), "organ")).alias("name")).distinct()


# --- joins ----------------------------------------------------------------------------------------


@query("SELECT c.id_stem, c.wsi_path, d.annotation_path FROM catalogue c JOIN catalogue d ON c.id_stem = d.id_stem WHERE d.label = 1", "catalogue")
def pair_annotations(spark, sf):
    c = _t(spark, sf, "catalogue")
    return cat.pair_annotations(c.select("id_stem", "wsi_path"), c.filter("label = 1").select("id_stem", "annotation_path"))


@query(f"SELECT {KEY}, roi_coverage_A, roi_tissue_coverage FROM ({JOINED})", "tiles", "tissue")
def join_tissue(spark, sf):
    return tiles.join_tissue(*_t(spark, sf, "tiles", "tissue")).select("slide_id", "x", "y", "roi_coverage_A", "roi_tissue_coverage")


@query(f"SELECT {KEY}, roi_coverage_A, tile_tissue_coverage FROM ({JOINED})", "tiles", "tissue")
def filter_tiles(spark, sf):
    return tiles.filter_tiles(*_t(spark, sf, "tiles", "tissue")).select("slide_id", "x", "y", "roi_coverage_A", "tile_tissue_coverage")


@query(f"SELECT {KEY}, label, embedding FROM vectors", "vectors")
def join_embeddings(spark, sf):
    v = _t(spark, sf, "vectors")
    return tiles.join_embeddings(v.select("slide_id", "x", "y", "label"), v)


@query(f"SELECT {KEY}, path, level, tile_extent_x, tile_extent_y FROM tiles JOIN slides ON slide_id = id", "tiles", "slides")
def attach_slide_info(spark, sf):
    return tiles.attach_slide_info(*_t(spark, sf, "tiles", "slides")).select("slide_id", "x", "y", "path", "level", "tile_extent_x", "tile_extent_y")


@query("SELECT id_stem, wsi_path FROM catalogue WHERE wsi_path NOT IN (SELECT wsi_path FROM missing)", "catalogue", "missing")
def drop_excluded(spark, sf):
    return cat.drop_excluded(*_t(spark, sf, "catalogue", "missing")).select("id_stem", "wsi_path")


#: Slides of tiles, and those of vectors, which have neither masks nor annotations.
ALL_SLIDES = "SELECT id, path FROM slides UNION ALL SELECT DISTINCT slide_id, '/data/' || slide_id || '.svs' FROM vectors"


def _all_slides(spark, sf):
    slides, vectors = _t(spark, sf, "slides", "vectors")
    others = vectors.select(F.col("slide_id").alias("id"), F.concat(F.lit("/data/"), "slide_id", F.lit(".svs")).alias("path")).distinct()
    return slides.select("id", "path").unionByName(others)


HAVE = "SELECT slide_id AS id FROM mask_cells WHERE mask IN ('tissue', 'residual') GROUP BY slide_id HAVING count(DISTINCT mask) = 2"


@query(f"SELECT id, id IN ({HAVE}) AS complete FROM ({ALL_SLIDES})", "mask_cells", "slides", "vectors")
def slides_with_masks(spark, sf):
    masks = _t(spark, sf, "mask_cells").select("slide_id", "mask").distinct()
    have, lack = tiles.slides_with_masks(_all_slides(spark, sf), masks, ["tissue", "residual"])
    return have.select("id", F.lit(True).alias("complete")).unionByName(lack.select("id", F.lit(False).alias("complete")))


@query(f"SELECT {KEY} FROM tiles WHERE slide_id IN (SELECT slide_id FROM tissue GROUP BY slide_id HAVING avg(roi_tissue_coverage) > (SELECT avg(roi_tissue_coverage) FROM tissue))", "tiles", "tissue")
def select_slides(spark, sf):
    t, tissue = _t(spark, sf, "tiles", "tissue")
    all_of = tissue.agg(F.avg("roi_tissue_coverage").alias("of_all"))
    chosen = tissue.groupBy("slide_id").agg(F.avg("roi_tissue_coverage").alias("mean")).join(F.broadcast(all_of)).filter("mean > of_all")
    return tiles.select_slides(t, chosen).select("slide_id", "x", "y")


@query("SELECT c.wsi_path AS path, coalesce(a.annotation_path, '') AS annotation_path FROM catalogue c LEFT JOIN catalogue a ON a.wsi_path = c.wsi_path AND a.label = 1", "catalogue")
def attach_annotation_path(spark, sf):
    c = _t(spark, sf, "catalogue")
    return tiles.attach_annotation_path(c.select(F.col("wsi_path").alias("path")), c.filter("label = 1"))


@query(f"SELECT {KEY}, CASE label WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS target FROM ({LABELLED})", "tiles")
def map_class_index(spark, sf):
    return tiles.map_class_index(_labelled(spark, sf), [*CLASSES, "background"]).select("slide_id", "x", "y", "target")


def _percent(where: str, name: str) -> str:
    return f"SELECT organ AS value, round_even(count(*) / (SELECT count(*) FROM parted WHERE {where}), 4) * 100 AS {name} FROM parted WHERE {where} GROUP BY organ"


@query(SPLIT + ", p AS (" + _percent("split = 'train'", "train_percent") + "), q AS (" + _percent("split = 'test'", "test_percent") + ") SELECT coalesce(p.value, q.value) AS value, coalesce(train_percent, 0) AS train_percent, coalesce(test_percent, 0) AS test_percent FROM p FULL JOIN q ON p.value = q.value", "catalogue")
def compare_distributions(spark, sf):
    p = _parted(spark, sf)
    return cat.compare_distributions(p.filter("split = 'train'"), p.filter("split = 'test'"), "organ")


@query(f"SELECT id, path FROM ({ALL_SLIDES}) WHERE id NOT IN (SELECT slide_id FROM squares)", "slides", "squares", "vectors")
def missing_annotations(spark, sf):
    polygons = geometry.flatten_annotations(_documents(spark, sf), _mapping(spark))
    return cat.missing_annotations(_all_slides(spark, sf), polygons).select("id", "path")


@query(f"SELECT {KEY}, path FROM tiles JOIN slides ON slide_id = id", "tiles", "slides")
def require_slides(spark, sf):
    return tiles.require_slides(*_t(spark, sf, "tiles", "slides")).select("slide_id", "x", "y", "path")


# --- catalogue and split --------------------------------------------------------------------------


@query(f"{MERGED} SELECT id_stem, source, organ, group_id, stratify_target FROM strata", "catalogue")
def merge_rare_strata(spark, sf):
    return _strata(spark, sf).select("id_stem", "source", "organ", "group_id", "stratify_target")


@query(f"{SPLIT} SELECT id_stem, source, group_id, split FROM parted", "catalogue")
def grouped_stratified_split(spark, sf):
    return _parted(spark, sf).select("id_stem", "source", "group_id", "split")


PER_SPLIT = ", ".join(f"count(DISTINCT {c}) FILTER (WHERE split = '{k}') AS {k}_{n}" for k in ("train", "test") for n, c in {"groups": "group_id", "targets": "stratify_target", "organs": "organ", "sources": "source"}.items())


@query(f"{SPLIT} SELECT count(*) AS slides, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'test') AS test, {PER_SPLIT}, round_even(count(*) FILTER (WHERE split = 'test') / count(*), 4) AS test_ratio, 0::BIGINT AS leaking_groups FROM parted", "catalogue")
def split_statistics(spark, sf):
    return cat.split_statistics(_parted(spark, sf))


@query("SELECT organ AS value, count(*) AS n, round_even(count(*) / (SELECT count(*) FROM catalogue), 4) * 100 AS percent FROM catalogue GROUP BY organ", "catalogue")
def class_distribution(spark, sf):
    return cat.class_distribution(_t(spark, sf, "catalogue"), "organ")


@query(f"{GROUPED.replace('SELECT *', 'SELECT DISTINCT group_id FROM (SELECT *', 1)}) WHERE label = 1 AND group_id IN (SELECT group_id FROM ({GROUPED}) WHERE label = 0)", "catalogue")
def group_leakage(spark, sf):
    c = cat.assign_group_id(_t(spark, sf, "catalogue"))
    return cat.group_leakage(c.filter("label = 0"), c.filter("label = 1"))


@query("SELECT id_stem, organ, CAST(dense_rank() OVER (ORDER BY organ) - 1 AS INT) AS label FROM catalogue", "catalogue")
def dense_label_id(spark, sf):
    return cat.dense_label_id(_t(spark, sf, "catalogue")).select("id_stem", "organ", "label")


@query("SELECT source, id_stem FROM catalogue ORDER BY source, id_stem", "catalogue")
def order_catalogue(spark, sf):
    return cat.order_catalogue(_t(spark, sf, "catalogue").select("source", "id_stem"))


@query("SELECT slide_id FROM mask_sizes EXCEPT ALL SELECT slide_id FROM mask_sizes WHERE mask = 'tissue'", "mask_sizes")
def missing_keys(spark, sf):
    m = _t(spark, sf, "mask_sizes")
    return tiles.missing_keys(m.select("slide_id"), m.filter("mask = 'tissue'").select("slide_id"))


# --- aggregations ---------------------------------------------------------------------------------


@query(f"SELECT count(*) AS original, count(*) FILTER (WHERE {ANY}) AS annotated, (SELECT count(*) FROM ({JOINED})) AS on_tissue FROM tiles", "tiles", "tissue")
def filter_report(spark, sf):
    return tiles.filter_report(*_t(spark, sf, "tiles", "tissue"))


@query("SELECT count(*) AS tiles, round(avg(tile_tissue_coverage), 9) AS tile_tissue_coverage, round(avg(roi_tissue_coverage), 9) AS roi_tissue_coverage FROM tissue", "tissue")
def coverage_means(spark, sf):
    return tiles.coverage_means(_t(spark, sf, "tissue"))


def _stats_sql(keys: str, rows: str) -> str:
    q = ", ".join(f"round(quantile_cont(value, {p}), 6) AS q{int(p * 100):02d}" for p in tiles.QUANTILES)
    return f"SELECT {keys}count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max, {q} FROM ({rows}) GROUP BY ALL"


LONG = " UNION ALL ".join(f"SELECT slide_id, 'roi_coverage_{c}' AS \"column\", roi_coverage_{c} AS value FROM tiles" for c in CLASSES)
STRATA = f"SELECT *, {STRATUM} AS stratum FROM ({JOINED})"
REPORT = " UNION ALL ".join([*[f"SELECT 'roi_coverage_{c}' AS \"column\", 'all' AS stratum, roi_coverage_{c} AS value FROM s" for c in CLASSES], *[f"SELECT 'roi_tissue_coverage', {k}, roi_tissue_coverage FROM s" for k in ("stratum", "'all'")]])


@query(_stats_sql('"column", ', LONG), "tiles")
def scalar_stats(spark, sf):
    return tiles.scalar_stats(tiles.long_form(_t(spark, sf, "tiles"), ROI, "slide_id"), "column")


@query(f"WITH s AS ({STRATA}) " + _stats_sql('"column", stratum, ', REPORT), "tiles", "tissue")
def threshold_report(spark, sf):
    return tiles.threshold_report(*_t(spark, sf, "tiles", "tissue"), CLASSES)


CURVES = f"""WITH s AS ({STRATA}),
g AS ({" UNION ALL ".join(f"SELECT 'roi_coverage_{c}' AS \"column\", 'all' AS stratum, roi_coverage_{c} AS value FROM s" for c in CLASSES)} UNION ALL SELECT 'roi_tissue_coverage', stratum, roi_tissue_coverage FROM s),
b AS (SELECT 'roi_tissue_coverage' AS "column", CASE stratum WHEN 'background' THEN stratum ELSE 'annotated' END AS stratum, roi_tissue_coverage AS value FROM s),
w AS ({_stats_sql('"column", stratum, ', "SELECT * FROM g UNION ALL SELECT 'roi_tissue_coverage', 'all', roi_tissue_coverage FROM s")}),
e AS (SELECT range AS bin, range * (1.0::DOUBLE / 20) AS low, CASE WHEN range = 19 THEN 2.0::DOUBLE ELSE (range + 1) * (1.0::DOUBLE / 20) END AS high FROM range(20))
{" UNION ALL ".join(f"SELECT \"column\", stratum, 'stat' AS kind, '{k}' AS key, CAST({k} AS DOUBLE) AS value FROM w" for k in ["n", "mean", "std", "min", "max", *(f"q{int(p * 100):02d}" for p in tiles.QUANTILES)])}
UNION ALL SELECT "column", stratum, 'sweep', CAST(range AS VARCHAR), CAST(count(*) FILTER (value > range * (1.0::DOUBLE / 999)) AS DOUBLE) FROM g, range(1000) GROUP BY "column", stratum, range
UNION ALL SELECT "column", stratum, 'histogram', CAST(bin AS VARCHAR), CAST(count(*) FILTER (value >= low AND value < high AND value <= 1) AS DOUBLE) FROM g, e GROUP BY "column", stratum, bin
UNION ALL SELECT "column", stratum, 'histogram_binary', CAST(bin AS VARCHAR), CAST(count(*) FILTER (value >= low AND value < high AND value <= 1) AS DOUBLE) FROM b, e GROUP BY "column", stratum, bin"""


@query(CURVES, "tiles", "tissue")
def threshold_curves(spark, sf):
    return tiles.threshold_curves(*_t(spark, sf, "tiles", "tissue"), CLASSES)


@query("""WITH e AS (SELECT range AS bin, range * (1.0::DOUBLE / 20) AS low, CASE WHEN range = 19 THEN 2.0::DOUBLE ELSE (range + 1) * (1.0::DOUBLE / 20) END AS high FROM range(20))
SELECT CAST(bin AS INT) AS bin, count(t.v) AS n FROM e LEFT JOIN (SELECT roi_tissue_coverage AS v FROM tissue WHERE roi_tissue_coverage BETWEEN 0 AND 1) t ON v >= low AND v < high GROUP BY bin""", "tissue")
def coverage_histogram(spark, sf):
    return tiles.coverage_histogram(_t(spark, sf, "tissue").select(F.col("roi_tissue_coverage").alias("value")))


@query("SELECT CAST(range AS INT) AS i, range * (1.0::DOUBLE / 999) AS threshold, count(v) AS above FROM range(1000) LEFT JOIN (SELECT roi_tissue_coverage AS v FROM tissue) ON v > range * (1.0::DOUBLE / 999) GROUP BY range", "tissue")
def threshold_sweep(spark, sf):
    return tiles.threshold_sweep(_t(spark, sf, "tissue").select(F.col("roi_tissue_coverage").alias("value")))


@query("SELECT CAST(range AS INT) AS bucket, count(v) AS above FROM range(11) LEFT JOIN (SELECT roi_tissue_coverage AS v FROM tissue) ON v > range * 0.1::DOUBLE GROUP BY range", "tissue")
def reverse_running_count(spark, sf):
    return tiles.threshold_sweep(_t(spark, sf, "tissue").select(F.col("roi_tissue_coverage").alias("value")), 11).select(F.col("i").alias("bucket"), "above")


@query(f"SELECT k.stratum, count(t.stratum) AS n FROM (VALUES ('A'), ('N'), ('R'), ('background')) k(stratum) LEFT JOIN (SELECT {STRATUM} AS stratum FROM tiles) t ON t.stratum = k.stratum GROUP BY 1", "tiles")
def stratum_counts(spark, sf):
    return tiles.stratum_counts(_t(spark, sf, "tiles"), CLASSES)


@query("SELECT slide_id, count(*) AS n FROM tiles GROUP BY 1", "tiles")
def tiles_per_slide(spark, sf):
    return folds.tiles_per_slide(_t(spark, sf, "tiles"))


# --- folds and sampling ---------------------------------------------------------------------------


@query(f"WITH l AS ({LABELLED}) SELECT {KEY}, CASE WHEN count(*) OVER (PARTITION BY label) < 3000 THEN 'background' ELSE label END AS stratify_label FROM l", "tiles")
def collapse_rare_labels(spark, sf):
    return folds.collapse_rare_labels(_labelled(spark, sf), 3000).select("slide_id", "x", "y", "stratify_label")


#: The corner of the first four slides is a class of its own.
CORNERED = f"SELECT {KEY}, CASE WHEN x = 0 AND y < 1120 AND slide_id IN ('S0', 'S1', 'S2', 'S3') THEN 'corner' ELSE label END AS label FROM ({LABELLED})"


@query(f"WITH l AS ({CORNERED}), k AS (SELECT label FROM l GROUP BY label HAVING count(DISTINCT slide_id) >= 5) SELECT {KEY}, label FROM l WHERE label IN (SELECT label FROM k)", "tiles")
def drop_rare_class_slides(spark, sf):
    corner = (F.col("x") == 0) & (F.col("y") < 1120) & F.col("slide_id").isin("S0", "S1", "S2", "S3")
    return folds.drop_rare_class_slides(_labelled(spark, sf).withColumn("label", F.when(corner, "corner").otherwise(F.col("label"))), 5).select("slide_id", "x", "y", "label")


@query(f"{FOLDS} SELECT {KEY}, label, g AS fold FROM f", "tiles")
def stratified_folds(spark, sf):
    return _folded(spark, sf).select("slide_id", "x", "y", "label", "fold")


@query()
def stratified_folds_hashed(spark, sf):
    return folds.stratified_folds(_labelled(spark, sf), 5, 0).select("slide_id", "x", "y", "label", "fold")


GROUP_FOLDS = f"""WITH l AS ({LABELLED}), b AS (SELECT slide_id, label, count(*) AS n FROM l GROUP BY 1, 2),
s AS (SELECT slide_id, sum(n) AS n, min({{'m': -n, 'l': label}}).l AS major FROM b GROUP BY 1),
r AS (SELECT *, (row_number() OVER (PARTITION BY major ORDER BY n DESC, slide_id) - 1) % 10 AS p FROM s)"""


@query(f"{GROUP_FOLDS} SELECT {KEY}, CAST(CASE WHEN p < 5 THEN p ELSE 9 - p END AS INT) AS fold FROM l JOIN r USING (slide_id)", "tiles")
def stratified_group_folds(spark, sf):
    return folds.stratified_group_folds(_labelled(spark, sf), 5, None).select("slide_id", "x", "y", "fold")


@query()
def balanced_group_folds(spark, sf):
    return folds.balanced_group_folds(_labelled(spark, sf)).select("slide_id", "x", "y", "label", "fold")


@query(f"{FOLDS} SELECT g AS fold, count(*) AS val_tiles, (SELECT count(*) FROM f) - count(*) AS train_tiles, round(count(*) / (SELECT count(*) FROM f), 4) AS val_share, count(DISTINCT slide_id) AS slides, round(avg(tissue_prop), 4) AS tissue_mean, round(stddev_pop(tissue_prop), 4) AS tissue_std FROM f GROUP BY g", "tiles")
def fold_statistics(spark, sf):
    return folds.fold_statistics(_folded(spark, sf))


@query(f"{FOLDS} SELECT round(stddev_pop(n) / avg(n), 9) AS cv FROM (SELECT count(*) AS n FROM f GROUP BY g)", "tiles")
def fold_size_cv(spark, sf):
    return folds.fold_size_cv(_folded(spark, sf))


@query(f"{FOLDS}, r AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY label) < 3000 THEN 'background' ELSE label END AS stratify_label FROM f) SELECT g AS fold, " + ", ".join(f"count(*) FILTER (WHERE stratify_label = '{c}') AS \"{c}\"" for c in [*CLASSES, "background"]) + " FROM r GROUP BY g", "tiles")
def fold_stratifying_distribution(spark, sf):
    return folds.fold_label_distribution(folds.collapse_rare_labels(_folded(spark, sf), 3000), [*CLASSES, "background"], "stratify_label")


@query(f"{FOLDS} SELECT g AS fold, " + ", ".join(f"count(*) FILTER (WHERE label = '{c}') AS \"{c}\"" for c in [*CLASSES, "background"]) + " FROM f GROUP BY g", "tiles")
def fold_label_distribution(spark, sf):
    return folds.fold_label_distribution(_folded(spark, sf), [*CLASSES, "background"])


@query("""WITH RECURSIVE c AS (SELECT slide_id, count(*) AS n, row_number() OVER (ORDER BY slide_id) AS r FROM tiles GROUP BY slide_id),
go AS (SELECT 0::BIGINT AS r, 0::BIGINT AS used, NULL::VARCHAR AS slide_id, 0::BIGINT AS n UNION ALL
SELECT c.r, go.used + CASE WHEN go.used + c.n <= 2000 THEN c.n ELSE 0 END, CASE WHEN go.used + c.n <= 2000 THEN c.slide_id END, c.n FROM go JOIN c ON c.r = go.r + 1)
SELECT slide_id, n FROM go WHERE slide_id IS NOT NULL""", "tiles")
def slide_budget(spark, sf):
    return folds.slide_budget(_t(spark, sf, "tiles"), 2000, None)


@query("SELECT slide_id, count(*) AS n FROM tiles GROUP BY slide_id ORDER BY n, slide_id LIMIT 1", "tiles")
def smallest_slide(spark, sf):
    return folds.smallest_slide(_t(spark, sf, "tiles"))


@query(f"SELECT {KEY}, pred FROM predictions WHERE slide_id IN (SELECT slide_id FROM predictions GROUP BY slide_id ORDER BY avg(CASE WHEN pred = target THEN 1.0 ELSE 0.0 END), slide_id LIMIT 3)", "predictions")
def worst_slides(spark, sf):
    return folds.worst_slides(_t(spark, sf, "predictions"), 3).select("slide_id", "x", "y", "pred")


@query(f"SELECT {KEY} FROM tiles WHERE slide_id IN (SELECT DISTINCT slide_id FROM tiles ORDER BY slide_id LIMIT 2)", "tiles")
def first_slides(spark, sf):
    return folds.first_slides(_t(spark, sf, "tiles"), 2).select("slide_id", "x", "y")


# --- null keys: every row stays -----------------------------------------------------------------------

HOLED_LABEL = "SELECT *, CASE WHEN count(*) OVER (PARTITION BY label) < 3000 THEN 'background' ELSE label END AS stratify_label FROM holed"


@query(f"SELECT {KEY}, stratify_label FROM ({HOLED_LABEL})", "holed")
def collapse_rare_labels_nulls(spark, sf):
    return folds.collapse_rare_labels(_t(spark, sf, "holed"), 3000).select("slide_id", "x", "y", "stratify_label")


@query(f"SELECT {KEY}, label, CAST((row_number() OVER (ORDER BY label NULLS FIRST, slide_id NULLS FIRST, x, y) - 1) % 5 AS INT) AS fold FROM (SELECT DISTINCT {KEY}, label FROM holed WHERE slide_id IS NOT NULL OR x = 0)", "holed")
def stratified_folds_nulls(spark, sf):
    rows = _t(spark, sf, "holed").filter("slide_id IS NOT NULL OR x = 0").select("slide_id", "x", "y", "label").distinct()
    return folds.stratified_folds(rows, 5, None).select("slide_id", "x", "y", "label", "fold")


@query(f"""WITH b AS (SELECT slide_id, label, count(*) AS n FROM holed GROUP BY 1, 2),
s AS (SELECT slide_id, sum(n) AS n, arg_min(coalesce(label, ''), (-n, coalesce(label, ''))) AS major FROM b GROUP BY 1),
r AS (SELECT *, (row_number() OVER (PARTITION BY major ORDER BY n DESC, slide_id NULLS FIRST) - 1) % 10 AS p FROM s)
SELECT h.slide_id, x, y, CAST(CASE WHEN p < 5 THEN p ELSE 9 - p END AS INT) AS fold FROM holed h JOIN r ON h.slide_id IS NOT DISTINCT FROM r.slide_id""", "holed")
def stratified_group_folds_nulls(spark, sf):
    return folds.stratified_group_folds(_t(spark, sf, "holed"), 5, None).select("slide_id", "x", "y", "fold")


@query("""WITH w AS (SELECT group_id, stratify_target, count(*) AS n FROM holed_catalogue GROUP BY 1, 2),
h AS (SELECT group_id, sum(n) AS n, min({'m': -n, 's': stratify_target}).s AS stratum FROM w GROUP BY 1),
r AS (SELECT *, CASE WHEN sum(n) OVER (PARTITION BY stratum ORDER BY group_id NULLS FIRST) <= 0.2::DOUBLE * sum(n) OVER (PARTITION BY stratum) THEN 'test' ELSE 'train' END AS split FROM h)
SELECT id_stem, c.group_id, split FROM holed_catalogue c JOIN r ON c.group_id IS NOT DISTINCT FROM r.group_id""", "holed_catalogue")
def grouped_stratified_split_nulls(spark, sf):
    return cat.grouped_stratified_split(_t(spark, sf, "holed_catalogue"), 0.2, None).select("id_stem", "group_id", "split")


@query("SELECT id_stem, organ, CASE WHEN organ IS NOT NULL THEN CAST(dense_rank() OVER (ORDER BY organ NULLS LAST) - 1 AS INT) END AS label FROM holed_catalogue", "holed_catalogue")
def dense_label_id_nulls(spark, sf):
    return cat.dense_label_id(_t(spark, sf, "holed_catalogue")).select("id_stem", "organ", "label")


@query("SELECT part, CAST(range AS INT) AS i, range * (1.0::DOUBLE / 99) AS threshold, count(*) FILTER (value > range * (1.0::DOUBLE / 99)) AS above FROM holed, range(100) WHERE value IS NOT NULL GROUP BY part, range", "holed")
def threshold_sweep_nulls(spark, sf):
    return tiles.threshold_sweep(_t(spark, sf, "holed"), 100, keys=("part",))


@query("""WITH e AS (SELECT range AS bin, range * (1.0::DOUBLE / 20) AS low, CASE WHEN range = 19 THEN 2.0::DOUBLE ELSE (range + 1) * (1.0::DOUBLE / 20) END AS high FROM range(20))
SELECT part, CAST(bin AS INT) AS bin, count(*) FILTER (value >= low AND value < high AND value <= 1) AS n FROM holed, e WHERE value IS NOT NULL GROUP BY part, bin""", "holed")
def coverage_histogram_nulls(spark, sf):
    return tiles.coverage_histogram(_t(spark, sf, "holed"), "part")


@query(_stats_sql("part, ", "SELECT part, value FROM holed WHERE value IS NOT NULL"), "holed")
def scalar_stats_nulls(spark, sf):
    return tiles.scalar_stats(_t(spark, sf, "holed"), "part")


# --- geometry and maps ----------------------------------------------------------------------------


@query("SELECT id AS slide_id, CAST(a.range AS INT) AS x, CAST(b.range AS INT) AS y FROM slides, range(0, 673, 112) a, range(0, 28561, 112) b", "slides")
def grid_tiles(spark, sf):
    return geometry.grid_tiles(_t(spark, sf, "slides"))


_CORNERS = (("left", "top"), ("right", "top"), ("right", "bottom"), ("left", "bottom"), ("left", "top"))


def _corners(square):
    return [(square[a].cast("double") if a != "left" else F.col(a).cast("double"), square[b].cast("double")) for a, b in _CORNERS]


def _geojson(squares):
    def feature(square):
        ring = F.array(*[F.array(x, y) for x, y in _corners(square)])
        return F.struct(F.lit("Feature").alias("type"), F.struct(square["name"].alias("name")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))

    return F.struct(F.transform(squares, feature).alias("features"))


def _darwin(squares):
    def annotation(square):
        path = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in _corners(square)])
        return F.struct(square["name"].alias("name"), F.struct(path.alias("path")).alias("polygon"))

    return F.struct(F.transform(squares, annotation).alias("annotations"))


def _documents(spark, sf, squares=None, written=_geojson):
    """The squares as one text for each grid column of a slide, in an order that does not hang on how rows arrive. Squares are gathered as their sides: written out they take ten times the room."""
    squares = _t(spark, sf, "squares") if squares is None else squares
    gathered = F.sort_array(F.collect_list(F.struct("name", "top", "right", "bottom")))
    return squares.groupBy("slide_id", "left").agg(F.to_json(written(gathered)).alias("doc")).select("slide_id", "doc")


def _polygons(spark, sf):
    """A shape for each square: documents hold a grid column each, so the number in a document is made one of the slide."""
    flat = geometry.flatten_annotations(_documents(spark, sf), _mapping(spark))
    corner = F.element_at("rings", 1)[0]
    return flat.withColumn("polygon", F.shiftleft(corner[0].cast("long"), 32) + F.shiftright("polygon", 32))


def _mapping(spark):
    return spark.createDataFrame([("Nerve", "Nerve", 0), ("Fat", "fat", 1), ("Soft", "FAT", 2)], "class string, raw_name string, class_index int")


MAPPED = "SELECT s.*, m.class, m.class_index FROM squares s JOIN (VALUES ('Nerve', 'nerve', 0), ('Fat', 'fat', 1), ('Soft', 'fat', 2)) m(class, raw, class_index) ON lower(s.name) = m.raw"


@query(f'SELECT slide_id, class, CAST("left" AS DOUBLE) AS x0, CAST(top AS DOUBLE) AS y0, "right" AS x1, bottom AS y1 FROM ({MAPPED})', "squares")
def flatten_annotations(spark, sf):
    flat = geometry.flatten_annotations(_documents(spark, sf), _mapping(spark))
    corner = F.col("rings")[0]
    return flat.select("slide_id", "class", corner[0][0].alias("x0"), corner[0][1].alias("y0"), corner[2][0].alias("x1"), corner[2][1].alias("y1"))


def _union_sql(tiles_and_shapes: str, whole: str) -> str:
    """Coverage by the union of rectangles: ``tiles_and_shapes`` has slide_id, x, y, class, w, h, and l, o, r, b in the tile's scale.

    Rectangles are cut to the tile and to its central half; strips between neighbouring sides are covered by the union of their rectangles' spans.
    """
    return f"""j AS ({tiles_and_shapes}),
q AS (SELECT slide_id, x, y, class, part, w, h, greatest(l, x + w * part) AS l, greatest(o, y + h * part) AS o, least(r, x + w * (1 - part)) AS r, least(b, y + h * (1 - part)) AS b FROM j, (VALUES (0.0::DOUBLE), (0.25::DOUBLE)) k(part)),
c AS (SELECT * FROM q WHERE l < r AND o < b),
v AS (SELECT slide_id, x, y, class, part, l AS v FROM c UNION SELECT slide_id, x, y, class, part, r FROM c),
s AS (SELECT *, lead(v) OVER (PARTITION BY slide_id, x, y, class, part ORDER BY v) AS u FROM v),
d AS (SELECT slide_id, x, y, class, part, u - s.v AS width, s.v AS v, o, b, max(b) OVER (PARTITION BY slide_id, x, y, class, part, s.v ORDER BY o, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM s JOIN c USING (slide_id, x, y, class, part) WHERE c.l <= s.v AND c.r >= s.u),
a AS (SELECT slide_id, x, y, class, part, sum(width * greatest(0.0::DOUBLE, b - greatest(o, coalesce(seen, o)))) AS area FROM d GROUP BY ALL),
n AS (SELECT DISTINCT slide_id, x, y, class, w, h FROM c)
SELECT n.slide_id, n.x, n.y, n.class, round(a.area / {whole}, 9) AS tile_coverage, round(coalesce(4 * e.area, 0.0::DOUBLE) / {whole}, 9) AS roi_coverage
FROM n JOIN a ON a.slide_id = n.slide_id AND a.x = n.x AND a.y = n.y AND a.class = n.class AND a.part = 0 LEFT JOIN a e ON e.slide_id = n.slide_id AND e.x = n.x AND e.y = n.y AND e.class = n.class AND e.part = 0.25"""


COVERED = "WITH " + _union_sql(f"""SELECT t.slide_id, t.x, t.y, class, 224 AS w, 224 AS h, "left" AS l, top AS o, "right" AS r, bottom AS b
  FROM tiles t JOIN ({MAPPED}) m ON t.slide_id = m.slide_id AND t.x < "right" AND t.x + 224 > "left" AND t.y < bottom AND t.y + 224 > top""", "(w * h)")


@query(COVERED, "tiles", "squares")
def rectangle_coverage(spark, sf):
    t, squares = _t(spark, sf, "tiles", "squares")
    named = squares.join(F.broadcast(_mapping(spark)), F.lower("name") == F.lower("raw_name"))
    return geometry.rectangle_coverage(t, named, _t(spark, sf, "slides"))


@query(COVERED, "tiles", "squares")
def polygon_coverage(spark, sf):
    return geometry.polygon_coverage(_t(spark, sf, "tiles"), _polygons(spark, sf), _t(spark, sf, "slides"))


#: Slides of two scales, two extents and three tile sizes, and the tiles of their grids that leave the slide by less than a tile.
MIXED = """SELECT id, CASE WHEN kind = 0 THEN 896 ELSE 500 END AS extent_x, CASE WHEN kind = 0 THEN 28784 ELSE 14000 END AS extent_y, tile AS tile_extent_x, tile - 20 * kind AS tile_extent_y,
  100 AS stride_x, 120 AS stride_y, CASE WHEN kind = 0 THEN 1e0 ELSE 2e0 END AS downsample FROM (SELECT id, mod(length(id), 2) AS kind, 200 + 50 * mod(length(id), 3) AS tile FROM slides) k"""
MIXED_TILES = "SELECT m.id AS slide_id, CAST(a.range AS INT) AS x, CAST(b.range AS INT) AS y FROM mixed m, range(0, 896, 100) a, range(0, 28784, 120) b WHERE a.range < extent_x AND b.range < extent_y"


def _mixed(spark, sf):
    """Slides and tiles of :data:`MIXED`, and the grid as it is kept."""
    _t(spark, sf, "slides").createOrReplaceTempView("slides_of_mixed")
    slides = spark.sql(MIXED.replace("FROM slides", "FROM slides_of_mixed"))
    return slides, geometry.grid_tiles(slides, "keep")


def _mixed_sql(body: str) -> str:
    return f"WITH mixed AS ({MIXED}), mt AS ({MIXED_TILES}){body}"


@query(_mixed_sql(" SELECT * FROM mt"), "slides")
def grid_tiles_mixed(spark, sf):
    return _mixed(spark, sf)[1]


COVERED_MIXED = _mixed_sql("") + f""", m AS (SELECT q.slide_id, q.class, "left" / downsample AS l, top / downsample AS o, "right" / downsample AS r, bottom / downsample AS b, mixed.* FROM ({MAPPED}) q JOIN mixed ON id = q.slide_id),
""" + _union_sql("""SELECT t.slide_id, t.x, t.y, class, tile_extent_x AS w, tile_extent_y AS h, l, o, r, b
  FROM mt t JOIN m ON t.slide_id = m.slide_id AND t.x < r AND t.x + tile_extent_x > l AND t.y < b AND t.y + tile_extent_y > o""", "(w * h)")


@query(COVERED_MIXED, "slides", "squares")
def rectangle_coverage_mixed(spark, sf):
    slides, t = _mixed(spark, sf)
    named = _t(spark, sf, "squares").join(F.broadcast(_mapping(spark)), F.lower("name") == F.lower("raw_name"))
    return geometry.rectangle_coverage(t, named, slides)


@query(COVERED_MIXED, "slides", "squares")
def polygon_coverage_mixed(spark, sf):
    slides, t = _mixed(spark, sf)
    return geometry.polygon_coverage(t, _polygons(spark, sf), slides)


@query(_mixed_sql(""", c AS (SELECT t.slide_id, x // gcd(stride_x, tile_extent_x) + i.range AS cell_x, y // gcd(stride_y, tile_extent_y) + j.range AS cell_y, (x + y) / 1000 AS v
  FROM mt t JOIN mixed ON id = t.slide_id, range(60) i, range(60) j WHERE i.range < tile_extent_x // gcd(stride_x, tile_extent_x) AND j.range < tile_extent_y // gcd(stride_y, tile_extent_y)
  AND x // gcd(stride_x, tile_extent_x) + i.range < extent_x // gcd(stride_x, tile_extent_x) AND y // gcd(stride_y, tile_extent_y) + j.range < extent_y // gcd(stride_y, tile_extent_y))
SELECT slide_id, CAST(cell_x AS INT) AS cell_x, CAST(cell_y AS INT) AS cell_y, round(avg(v), 9) AS value FROM c GROUP BY ALL"""), "slides")
def scalar_map_mixed(spark, sf):
    slides, t = _mixed(spark, sf)
    return geometry.scalar_map(t.withColumn("v", (F.col("x") + F.col("y")) / 1000), "v", slides)


@query("""WITH m AS (SELECT *, CASE WHEN lower(name) = 'nerve' THEN 0 ELSE 1 END AS class_index FROM squares)
SELECT slide_id, CAST(cx AS INT) AS cell_x, CAST(cy AS INT) AS cell_y, max(class_index) AS value FROM (SELECT slide_id, class_index, cx, unnest(range(CAST(floor(top / 56.0) AS BIGINT), CAST(ceil(bottom / 56.0) AS BIGINT))) AS cy FROM
(SELECT *, unnest(range(CAST(floor("left" / 56.0) AS BIGINT), CAST(ceil("right" / 56.0) AS BIGINT))) AS cx FROM m)) GROUP BY ALL""", "squares")
def rasterise_rectangles(spark, sf):
    return geometry.rasterise_rectangles(_t(spark, sf, "squares").withColumn("class_index", F.when(F.lower("name") == "nerve", 0).otherwise(1)))


LABEL_CELLS = f"""SELECT slide_id, CAST(cx AS INT) AS cell_x, CAST(cy AS INT) AS cell_y, max(class_index) AS value FROM (SELECT slide_id, class_index, cx, unnest(range(CAST(ceil(top / 56.0 - 0.5) AS BIGINT), CAST(ceil(bottom / 56.0 - 0.5) AS BIGINT))) AS cy FROM
(SELECT *, unnest(range(CAST(ceil("left" / 56.0 - 0.5) AS BIGINT), CAST(ceil("right" / 56.0 - 0.5) AS BIGINT))) AS cx FROM ({MAPPED}))) GROUP BY ALL"""


@query(f"SELECT slide_id, cell_y, min(cell_x) AS first, max(cell_x) AS last, value FROM (SELECT *, cell_x - row_number() OVER (PARTITION BY slide_id, cell_y, value ORDER BY cell_x) AS run FROM ({LABEL_CELLS})) GROUP BY slide_id, cell_y, value, run", "squares")
def label_runs(spark, sf):
    return geometry.label_runs(geometry.flatten_annotations(_documents(spark, sf), _mapping(spark)), 56.0)


@query(LABEL_CELLS, "squares")
def rasterise_labels(spark, sf):
    return geometry.rasterise_labels(geometry.flatten_annotations(_documents(spark, sf), _mapping(spark)), 56.0)


MASKED = f"""WITH c AS (SELECT t.slide_id, t.x, t.y, m.mask, count(*) AS n, count(*) FILTER (WHERE cell_x >= x // 56 + 1 AND cell_x < x // 56 + 3 AND cell_y >= y // 56 + 1 AND cell_y < y // 56 + 3) AS rn
FROM tiles t JOIN mask_cells m ON t.slide_id = m.slide_id AND cell_x >= x // 56 AND cell_x < x // 56 + 4 AND cell_y >= y // 56 AND cell_y < y // 56 + 4 AND cell_x < 16 AND cell_y < 514 GROUP BY ALL),
k AS (SELECT t.slide_id, t.x, t.y, z.mask, coalesce(n, 0) / 16 AS tile_coverage, coalesce(rn, 0) / 4 AS roi_coverage FROM tiles t JOIN mask_sizes z ON t.slide_id = z.slide_id LEFT JOIN c ON c.slide_id = t.slide_id AND c.x = t.x AND c.y = t.y AND c.mask = z.mask)"""


@query(f"{MASKED} SELECT * FROM k", "tiles", "mask_cells", "mask_sizes")
def mask_coverage(spark, sf):
    return geometry.mask_coverage(*_t(spark, sf, "tiles", "slides", "mask_sizes", "mask_cells"))


@query(f"{MASKED} SELECT {KEY}, " + ", ".join(f"max({k}_coverage) FILTER (WHERE mask = '{m}') AS {k}_{m}_coverage" for m in ("tissue", "residual") for k in ("tile", "roi")) + f" FROM k GROUP BY {KEY}", "tiles", "mask_cells", "mask_sizes")
def mask_coverage_multi(spark, sf):
    return geometry.mask_coverage_multi(mask_coverage(spark, sf), ["tissue", "residual"])


@query("SELECT slide_id, mask, cell_x, cell_y, CASE (cell_x + cell_y) % 4 WHEN 0 THEN 85 WHEN 1 THEN 170 WHEN 2 THEN 255 ELSE 0 END AS value FROM mask_cells", "mask_cells")
def remap_cells(spark, sf):
    k = (F.col("cell_x") + F.col("cell_y")) % 4
    return geometry.remap_cells(_t(spark, sf, "mask_cells").withColumn("value", F.when(k == 3, 255).otherwise(k)), 3)


CELLS = "SELECT slide_id, CAST(x // 112 AS INT) + dx AS cell_x, CAST(y // 112 AS INT) + dy AS cell_y, p.* EXCLUDE (slide_id, x, y) FROM {t} p, (VALUES (0), (1)) a(dx), (VALUES (0), (1)) b(dy) WHERE x // 112 + dx < 8 AND y // 112 + dy < 257"


@query("WITH c AS (" + CELLS.format(t="predictions") + "), v AS (SELECT slide_id, cell_x, cell_y, sum(round(prob_A * 1099511627776)) AS a, sum(round(prob_N * 1099511627776)) AS n, sum(round(prob_R * 1099511627776)) AS r FROM c GROUP BY ALL) SELECT slide_id, cell_x, cell_y, CASE WHEN a >= n AND a >= r THEN 85 WHEN n >= r THEN 170 ELSE 255 END AS value FROM v", "predictions")
def vote_map(spark, sf):
    return geometry.vote_map(_t(spark, sf, "predictions"), CLASSES, _t(spark, sf, "slides"))


@query("WITH c AS (" + CELLS.format(t="predictions") + ") SELECT slide_id, cell_x, cell_y, " + ", ".join(f"CAST((255 * sum(CAST(round(prob_{c} * 1099511627776) AS BIGINT)) + 128 * count(*)) // (count(*) * 1099511627776) AS INT) AS map_{c}" for c in CLASSES) + " FROM c GROUP BY ALL", "predictions")
def probability_map(spark, sf):
    return geometry.probability_map(_t(spark, sf, "predictions"), CLASSES, _t(spark, sf, "slides"))


@query("WITH c AS (" + CELLS.format(t="tiles") + ") SELECT slide_id, cell_x, cell_y, round(avg(roi_coverage_A), 9) AS value FROM c GROUP BY ALL", "tiles")
def scalar_map(spark, sf):
    return geometry.scalar_map(_t(spark, sf, "tiles"), "roi_coverage_A", _t(spark, sf, "slides"))


@query("SELECT slide_id AS slide, min({'f': abs(mpp - CASE WHEN slide_id LIKE '%3' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END), 'l': level}).l AS level FROM (SELECT DISTINCT slide_id, CAST(x / 112 AS INT) AS level, 0.25::DOUBLE * power(2, CAST(x / 112 AS INT)) AS mpp FROM tiles) GROUP BY slide_id", "tiles")
def nearest_level(spark, sf):
    t = _t(spark, sf, "tiles").select(F.col("slide_id").alias("slide"), (F.col("x") / 112).cast("int").alias("level")).distinct()
    levels = t.withColumn("mpp", 0.25 * F.pow(F.lit(2.0), "level"))
    return geometry.nearest_level(levels, 1.0, t.filter(F.col("slide").endswith("3")))


# --- modelling ------------------------------------------------------------------------------------

TEN = [str(i) for i in range(10)]


def _vectors(spark, sf):
    """Vectors with one-hot coverage columns, as tiles with an annotation would have them, and folds."""
    v = _t(spark, sf, "vectors")
    meta = v.select("slide_id", "x", "y", *[F.when(F.col("label") == int(c), 0.5).otherwise(0.0).alias(f"roi_coverage_{c}") for c in TEN], (F.col("x") / 112 % 5).cast("int").alias("fold"))
    return v.select("slide_id", "x", "y", "embedding"), meta


def _trained(spark, sf):
    v, meta = _vectors(spark, sf)
    rest = modelling.training_set(v, meta, TEN, dict.fromkeys(TEN, 0.1), 0.1, exclude=[0])
    held = modelling.training_set(v, meta, TEN, dict.fromkeys(TEN, 0.1), 0.1, include=[0])
    return modelling.predict_probe(modelling.fit_linear_probe(rest, 0.01, 10), held, TEN)


@query(f"SELECT {KEY}, CAST(label AS INT) AS target, CAST(x // 112 % 5 AS INT) AS fold FROM vectors WHERE label IS NOT NULL AND x // 112 % 5 <> 0", "vectors")
def training_set(spark, sf):
    v, meta = _vectors(spark, sf)
    return modelling.training_set(v, meta, TEN, dict.fromkeys(TEN, 0.1), 0.1, exclude=[0]).select("slide_id", "x", "y", "target", "fold")


@query(f"SELECT {KEY}, -1 AS target FROM vectors WHERE label > 3", "vectors")
def prediction_set(spark, sf):
    v, _ = _vectors(spark, sf)
    tissue = _t(spark, sf, "vectors").select("slide_id", "x", "y", (F.col("label") / 10.0).cast("double").alias("roi_tissue_coverage"))
    return modelling.prediction_set(v, tissue, 0.3).select("slide_id", "x", "y", "target")


@query("SELECT CAST(k.range AS INT) AS target, count(p.target) AS n, (SELECT count(*) FROM predictions) / (4 * greatest(count(p.target), 1)) AS weight FROM range(4) k LEFT JOIN predictions p ON p.target = k.range GROUP BY k.range", "predictions")
def class_weights(spark, sf):
    return modelling.class_weights(_t(spark, sf, "predictions"), 4)


CONFUSION = "WITH g AS (SELECT CAST(a.range AS INT) AS target, CAST(b.range AS INT) AS pred FROM range(4) a, range(4) b), m AS (SELECT g.target, g.pred, count(p.target) AS n FROM g LEFT JOIN predictions p ON p.target = g.target AND p.pred = g.pred GROUP BY 1, 2)"
PER_CLASS = f"{CONFUSION}, r AS (SELECT target, sum(n) FILTER (WHERE target = pred) AS tp, sum(n) AS support FROM m GROUP BY 1), c AS (SELECT pred, sum(n) AS predicted FROM m GROUP BY 1), k AS (SELECT target AS class_index, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS accuracy, CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END AS f1, support::BIGINT AS support, predicted::BIGINT AS predicted FROM r JOIN c ON target = pred)"


@query(f"{CONFUSION} SELECT target, pred, n, CASE WHEN sum(n) OVER (PARTITION BY target) > 0 THEN n / sum(n) OVER (PARTITION BY target) ELSE 0 END AS share FROM m", "predictions")
def confusion_matrix(spark, sf):
    return modelling.confusion_matrix(_t(spark, sf, "predictions"), 4)


@query(f"{PER_CLASS} SELECT * FROM k", "predictions")
def per_class_metrics(spark, sf):
    return modelling.per_class_metrics(_t(spark, sf, "predictions"), 4)


@query(f"{PER_CLASS} SELECT round(avg(accuracy), 9) AS macro_accuracy, round(avg(f1), 9) AS macro_f1 FROM k WHERE support + predicted > 0", "predictions")
def macro_metrics(spark, sf):
    return modelling.macro_metrics(_t(spark, sf, "predictions"), 4)


PER_SLIDE = "SELECT slide_id, avg(CASE WHEN pred = target THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy, count(*) AS n FROM predictions GROUP BY slide_id"


@query(f"SELECT *, slide_id || '.svs' AS file FROM ({PER_SLIDE})", "predictions")
def slide_accuracy(spark, sf):
    return modelling.slide_accuracy(*_t(spark, sf, "predictions", "slides"))


@query(f"SELECT round(avg(accuracy), 9) AS mean, round(median(accuracy), 9) AS median, min(accuracy) AS min FROM ({PER_SLIDE})", "predictions")
def slide_accuracy_summary(spark, sf):
    return modelling.slide_accuracy_summary(_t(spark, sf, "predictions"))


@query("WITH n AS (SELECT target, (SELECT count(*) FROM predictions) / (3 * count(*)) AS w FROM predictions GROUP BY target) SELECT round(sum(w * -ln(CASE target WHEN 0 THEN prob_A WHEN 1 THEN prob_N ELSE prob_R END)) / sum(w), 9) AS loss FROM predictions JOIN n USING (target)", "predictions")
def weighted_log_loss(spark, sf):
    return modelling.weighted_log_loss(_t(spark, sf, "predictions"), CLASSES)


@query()
def linear_probe(spark, sf):
    return _trained(spark, sf)


@query()
def cross_validate(spark, sf):
    v, meta = _vectors(spark, sf)
    rows = modelling.training_set(v, meta, TEN, dict.fromkeys(TEN, 0.1), 0.1)
    return modelling.choose_weight_decay(modelling.cross_validate(rows, TEN, [0.0, 1e-5, 1e-4, 1e-3, 1e-2], [0, 1, 2, 3, 4]))


@query(f"SELECT {KEY}, [CAST(roi_coverage_A AS FLOAT), CAST(roi_coverage_N AS FLOAT)] AS embedding FROM tiles", "tiles")
def embed_tiles(spark, sf):
    t = _t(spark, sf, "tiles").select("slide_id", "x", "y", F.array("roi_coverage_A", "roi_coverage_N").alias("tile"))
    return modelling.embed_tiles(t, lambda batch: [list(map(float, v)) for v in batch["tile"]])
