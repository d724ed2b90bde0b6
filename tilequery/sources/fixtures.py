"""Logical tables derived from the driver's Parquet, by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER = ("lineitem", "documents", "labels", "embeddings")

#: name -> (tables it reads, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "base": (("lineitem",), "SELECT l_orderkey AS ok, l_linenumber AS ln, min(l_returnflag) AS rf, min(l_discount) AS d, max(l_tax) AS t, max(l_quantity) AS q FROM lineitem GROUP BY l_orderkey, l_linenumber"),
    "grid": (("base",), "SELECT 'S' || CAST(CAST(floor(ok / 256) AS BIGINT) AS STRING) AS slide_id, CAST((ln - 1) * 112 AS INT) AS x, CAST((ok % 256) * 112 AS INT) AS y, ok, ln, rf, d, t, q FROM base"),
    "roi": (("grid",), "SELECT *, CASE WHEN rf = 'A' THEN d * 10 ELSE 0e0 END AS roi_coverage_A, CASE WHEN rf = 'N' THEN d * 10 ELSE 0e0 END AS roi_coverage_N, CASE WHEN rf = 'R' THEN d * 10 WHEN q > 45 THEN t ELSE 0e0 END AS roi_coverage_R FROM grid"),
    "tiles": (("roi",), "SELECT slide_id, x, y, roi_coverage_A * 0.5e0 AS tile_coverage_A, roi_coverage_N * 0.5e0 AS tile_coverage_N, roi_coverage_R * 0.5e0 AS tile_coverage_R, roi_coverage_A, roi_coverage_N, roi_coverage_R FROM roi"),
    "tissue": (("grid",), "SELECT slide_id, x, y, CASE WHEN q <= 5 THEN 0e0 ELSE q / 50e0 END AS tile_tissue_coverage, CASE WHEN q <= 5 THEN 0e0 ELSE q / 50e0 END AS roi_tissue_coverage FROM grid"),
    "slides": (("grid",), "SELECT DISTINCT slide_id AS id, '/data/' || slide_id || '.svs' AS path, 0 AS level, 896 AS extent_x, 28784 AS extent_y, 224 AS tile_extent_x, 224 AS tile_extent_y, 112 AS stride_x, 112 AS stride_y, 0.5e0 AS mpp_x, 0.5e0 AS mpp_y, 1e0 AS downsample FROM grid"),
    # Tiles of which some lack a slide, a label or a value; `part` is a key that is null for some.
    "holed": (("roi",), "SELECT CASE WHEN slide_id IN ('S1', 'S4') THEN NULL ELSE slide_id END AS slide_id, x, y, CASE WHEN q > 45 THEN NULL ELSE rf END AS label, CASE WHEN ln = 2 THEN NULL ELSE d * 10 END AS value, CASE WHEN ln = 1 THEN NULL WHEN ln > 4 THEN 'b' ELSE 'a' END AS part FROM roi"),
    "mask_marks": (("grid",), "SELECT slide_id, 'tissue' AS mask, x, y FROM grid WHERE q > 10 UNION ALL SELECT slide_id, 'residual' AS mask, x, y FROM grid WHERE q > 40"),
    "mask_cells": (("mask_marks",), "SELECT DISTINCT slide_id, mask, CAST(x / 56 AS INT) + dx AS cell_x, CAST(y / 56 AS INT) + dy AS cell_y, 255 AS value FROM mask_marks CROSS JOIN (SELECT 0 AS dx UNION ALL SELECT 1) AS p CROSS JOIN (SELECT 0 AS dy UNION ALL SELECT 1) AS r"),
    "mask_sizes": (("slides",), "SELECT id AS slide_id, mask, 16 AS mask_w, 514 AS mask_h FROM slides CROSS JOIN (SELECT 'tissue' AS mask UNION ALL SELECT 'residual') AS m"),
    "labelled": (("documents", "labels"), "SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id"),
    "named": (("labelled",), "SELECT 'PT-' || lpad(CAST(CAST(floor(doc_id / 200) AS BIGINT) AS STRING), 9, '0') || '-' || CAST(doc_id AS STRING) AS id_stem, CASE source WHEN 'src0' THEN 'TCGA' WHEN 'src1' THEN 'MOU' WHEN 'src2' THEN 'MUG' WHEN 'src3' THEN 'FNBRNO' ELSE source END AS source, lang, quality, toxic, doc_id FROM labelled"),
    "catalogue": (("named",), "SELECT id_stem, source, lang AS organ, quality AS label, '/data/' || source || '/' || lang || '/' || id_stem || '.svs' AS wsi_path, '/data/' || source || '/' || lang || '/' || id_stem || '.geo.json' AS annotation_path, 0.2525e0 AS mpp_x, 0.2525e0 AS mpp_y, 40 AS magnification, 'v' || CAST(toxic AS STRING) AS vendor FROM named"),
    "holed_catalogue": (("catalogue",), "SELECT id_stem, CASE WHEN organ = 'de' THEN NULL ELSE organ END AS organ, CASE WHEN label = 1 THEN NULL ELSE substr(id_stem, 1, 12) END AS group_id, source AS stratify_target FROM catalogue"),
    "missing": (("named",), "SELECT '/data/' || source || '/' || lang || '/' || id_stem || '.svs' AS wsi_path FROM named WHERE toxic = 1"),
    "vectors": (("embeddings",), "SELECT 'E' || CAST(vec_id % 20 AS STRING) AS slide_id, CAST(floor(vec_id / 20) * 112 AS INT) AS x, 0 AS y, label, embedding FROM embeddings"),
    "scored": (("roi",), "SELECT slide_id, x, y, CASE WHEN roi_coverage_A >= roi_coverage_N AND roi_coverage_A >= roi_coverage_R THEN 0 WHEN roi_coverage_N >= roi_coverage_R THEN 1 ELSE 2 END AS target, (CASE WHEN ok % 7 = 0 THEN roi_coverage_R ELSE roi_coverage_A END + 0.1e0) / (roi_coverage_A + roi_coverage_N + roi_coverage_R + 0.3e0) AS prob_A, (roi_coverage_N + 0.1e0) / (roi_coverage_A + roi_coverage_N + roi_coverage_R + 0.3e0) AS prob_N, (CASE WHEN ok % 7 = 0 THEN roi_coverage_A ELSE roi_coverage_R END + 0.1e0) / (roi_coverage_A + roi_coverage_N + roi_coverage_R + 0.3e0) AS prob_R FROM roi"),
    "predictions": (("scored",), "SELECT slide_id, x, y, target, CASE WHEN prob_A >= prob_N AND prob_A >= prob_R THEN 0 WHEN prob_N >= prob_R THEN 1 ELSE 2 END AS pred, prob_A, prob_N, prob_R FROM scored"),
    "squares": (("grid",), "SELECT slide_id, x + 50 AS left, y + 50 AS top, CAST(x + 162 + 1000 * t AS DOUBLE) AS right, CAST(y + 162 + 1000 * t AS DOUBLE) AS bottom, CASE rf WHEN 'A' THEN 'nerve' WHEN 'N' THEN 'NERVE' ELSE 'Fat' END AS name FROM grid WHERE d > 0"),
}


def _needed(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for n in names:
        if n in TABLES:
            out += [x for x in _needed(TABLES[n][0]) if x not in out]
        if n not in out:
            out.append(n)
    return out


def with_tables(body: str, *names: str) -> str:
    """SQL for DuckDB: ``body`` with the derived tables that it names in front."""
    ctes = [f"{n} AS ({TABLES[n][1]})" for n in _needed(names) if n in TABLES]
    rest = body.lstrip()
    if rest.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(ctes)}, {rest[15:]}"
    return f"WITH {', '.join(ctes)}, {rest[5:]}" if rest.startswith("WITH ") else f"WITH {', '.join(ctes)} {rest}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table (or one of the driver's) as a lazy DataFrame."""
    ctes = [f"{n} AS ({TABLES[n][1]})" if n in TABLES else f"{n} AS (SELECT * FROM parquet.`{sf_dir}/{n}.parquet`)" for n in _needed((name,))]
    return spark.sql(f"WITH {', '.join(ctes)} SELECT * FROM {name}")
