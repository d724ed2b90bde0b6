"""Hand-made edge cases and invariants."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilequery.functions import columns as C
from tilequery.operators import catalogue, folds, geometry, modelling, tiles
from tilequery.plans import registry
from tilequery.sources import files

NAN = float("nan")


def test_ties_nulls_and_nan(spark):
    rows = [("s", 0, 0, 0.5, 0.5), ("s", 1, 0, 0.0, 0.0), ("s", 2, 0, NAN, 0.2), ("s", 3, 0, None, None)]
    df = spark.createDataFrame(rows, "slide_id string, x int, y int, roi_coverage_A double, roi_coverage_B double")
    assert [r.label for r in tiles.label_tiles(df).orderBy("x").collect()] == ["A", "background", "B", "background"]
    assert [r.x for r in tiles.any_annotation(df).orderBy("x").collect()] == [0, 2]
    kept = tiles.eligible_samples(df, {"A": 0.0, "B": 0.1}).orderBy("x").collect()
    assert [(r.x, r.label) for r in kept] == [(1, "A"), (2, "B"), (3, "A")]
    with pytest.raises(ValueError):
        tiles.eligible_samples(df, {"A": 0.0})
    with pytest.raises(ValueError):
        C.coverage_family(df, "nothing_")


def test_histogram_edges(spark):
    values = [0.0, 0.15, 0.3, 1.0, -0.1, 1.1, 0.05, 0.95]
    edges = np.arange(21) * 0.05
    edges[-1] = 1.0
    want, _ = np.histogram(values, edges)
    df = spark.createDataFrame([(v,) for v in values], "value double")
    assert [r.n for r in tiles.coverage_histogram(df).orderBy("bin").collect()] == want.tolist()


def test_threshold_curves(spark):
    t = [("s", 0, 0, 0.6, 0.2), ("s", 1, 0, 0.0, 0.5), ("s", 2, 0, 1.0, 0.0), ("s", 3, 0, 0.3, 0.4)]
    v = {0: 0.5, 1: 0.25, 2: 1.0, 3: 0.75}
    df = spark.createDataFrame(t, "slide_id string, x int, y int, roi_coverage_A double, roi_coverage_B double")
    tissue = spark.createDataFrame([("s", x, 0, c) for x, c in v.items()], "slide_id string, x int, y int, roi_tissue_coverage double")
    got = {tuple(r)[:4]: r.value for r in tiles.threshold_curves(df, tissue, ["A", "B"]).collect()}
    at = np.linspace(0, 1, 1000)
    groups = {("roi_coverage_A", "all"): [r[3] for r in t], ("roi_coverage_B", "all"): [r[4] for r in t], ("roi_tissue_coverage", "A"): [0.5, 1.0], ("roi_tissue_coverage", "B"): [0.25, 0.75]}
    for g, values in groups.items():
        assert got[(*g, "stat", "n")] == len(values) and got[(*g, "stat", "mean")] == pytest.approx(np.mean(values))
        assert [got[(*g, "sweep", str(i))] for i in range(1000)] == [sum(x > a for x in values) for a in at]
        assert sum(got[(*g, "histogram", str(i))] for i in range(20)) == len(values)
    assert got["roi_tissue_coverage", "all", "stat", "n"] == 4
    assert sum(n for k, n in got.items() if k[1:3] == ("annotated", "histogram_binary")) == 4
    # Tiles of class B alone, counted as background where only A is a class.
    one = {tuple(r)[:4]: r.value for r in tiles.threshold_curves(df, tissue, ["A"]).collect()}
    assert one["roi_tissue_coverage", "background", "histogram_binary", "5"] == 1 and one["roi_coverage_A", "all", "stat", "n"] == 4


def test_choice_of_weight_decay(spark, monkeypatch):
    rows = [(w, k, 0.5, f) for w, fs in {0.0: (0.2, 0.4), 0.1: (0.5, 0.3), 0.01: (0.6, 0.2)}.items() for k, f in enumerate(fs)]
    out = modelling.choose_weight_decay(spark.createDataFrame(rows, "weight_decay double, fold int, macro_accuracy double, macro_f1 double")).collect()
    assert len(out) == 6 and {r.weight_decay: (round(r.mean_f1, 6), r.chosen) for r in out} == {0.0: (0.3, False), 0.01: (0.4, True), 0.1: (0.4, False)}
    given = []
    monkeypatch.setattr(modelling, "cross_validate", lambda df, *args: given.append(args[1:]) or spark.createDataFrame(rows, "weight_decay double, fold int, macro_accuracy double, macro_f1 double"))
    assert "chosen" in registry.QUERIES["cross_validate"](spark, "/root/testdata/sf0.001").columns
    assert given == [([0.0, 1e-5, 1e-4, 1e-3, 1e-2], [0, 1, 2, 3, 4])]


def test_cross_validate_small(spark):
    rng = np.random.default_rng(3)
    rows = [("s", i, 0, i % 4 // 2, i % 2, (rng.normal(size=3) + 3 * (i % 2)).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "slide_id string, x int, y int, fold int, target int, embedding array<double>").coalesce(1).cache()
    out = modelling.choose_weight_decay(modelling.cross_validate(df, ["a", "b"], [0.0, 1e-2], [0, 1], 5)).collect()
    assert len(out) == 4 and len({r.weight_decay for r in out if r.chosen}) == 1 and min(r.macro_f1 for r in out) > 0.8


def test_stems(spark):
    df = spark.createDataFrame([("/a/b.GEO.json",), ("/a/b.c.svs",), ("/a/.x",), ("plain",)], "path string")
    assert [r[0] for r in df.select(C.path_stem(F.col("path"))).collect()] == ["b", "b.c", ".x", "plain"]


def test_rounding_and_lut():
    assert geometry.spread_lut(2)[:2] == [128, 255]
    assert geometry.spread_lut(3)[255] == 0


SLIDES = "id string, extent_x int, extent_y int, tile_extent_x int, tile_extent_y int, stride_x int, stride_y int, downsample double"


def test_polygon_with_hole(spark):
    square = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    polygons = spark.createDataFrame([("s", "c", 0, 1, [square(0.0, 224.0), square(56.0, 168.0)])], "slide_id string, class string, class_index int, polygon long, rings array<array<array<double>>>")
    places = spark.createDataFrame([("s", 0, 0)], "slide_id string, x int, y int")
    slides = spark.createDataFrame([("s", 896, 896, 224, 224, 112, 112, 1.0)], SLIDES)
    r = geometry.polygon_coverage(places, polygons, slides).first()
    assert (r.tile_coverage, r.roi_coverage) == (0.75, 0.0)
    cells = geometry.rasterise_labels(polygons, 56.0)
    assert cells.filter("value = 0").count() == 12 and cells.filter("value = 255").count() == 4


def holds(ring, x, y):
    """Whether a ring goes round each point, by counting the edges above."""
    ring = np.array(ring)
    odd = np.zeros(x.shape, bool)
    for (x0, y0), (x1, y1) in zip(ring, np.roll(ring, -1, axis=0), strict=True):
        if x0 != x1:
            odd ^= ((x0 <= x) != (x1 <= x)) & (y0 + (y1 - y0) * (x - x0) / (x1 - x0) < y)
    return odd


def test_polygons_of_slides_of_different_scale(spark):
    """Union of overlapping stars with holes, also copies of one, against a fine grid of points; slides of three scales."""
    rng = np.random.default_rng(8)
    slides = [("s", 900, 900, 224, 200, 112, 100, 1.0), ("t", 450, 450, 150, 150, 100, 150, 2.0), ("u", 300, 300, 64, 64, 64, 64, 4.0)]
    polygons = []
    for i in range(40):
        # Stars around a middle: simple outlines that are not convex.
        corners = 40 if i == 7 else 12
        turn = (np.arange(corners) + rng.random(corners)) / corners * 2 * np.pi
        middle, far = rng.uniform(0, 900, 2), rng.uniform(20, 250, len(turn))
        ring = middle + np.c_[np.cos(turn) * far, np.sin(turn) * far]
        polygons.append((slides[i % 3][0], "ab"[i % 2], i, [ring.tolist(), *([(middle + (ring - middle) * 0.4).tolist()] if i % 2 == 0 else [])]))
    polygons += [(*polygons[0][:2], 100, polygons[0][3]), (*polygons[0][:2], 101, [[[0.0, 0.0], [2000.0, 0.0], [2000.0, 150.0], [0.0, 150.0]]])]
    df = spark.createDataFrame(polygons, "slide_id string, class string, polygon long, rings array<array<array<double>>>")
    sdf = spark.createDataFrame(slides, SLIDES)
    tiles_ = geometry.grid_tiles(sdf, "keep")
    got = {(r.slide_id, r.x, r.y, r["class"]): (r.tile_coverage, r.roi_coverage) for r in geometry.polygon_coverage(tiles_, df, sdf).collect()}
    seen, points = 0, (np.arange(150) + 0.5) / 150
    for sid, ex, ey, tw, th, sx, sy, down in slides:
        for x in range(0, ex, sx):
            for y in range(0, ey, sy):
                for c in "ab":
                    want = []
                    for part in (0.0, 0.25):
                        px, py = np.meshgrid(x + tw * (part + (1 - 2 * part) * points), y + th * (part + (1 - 2 * part) * points))
                        inside = np.zeros(px.shape, bool)
                        for s, k, _, rings in polygons:
                            if (s, k) == (sid, c):
                                inside |= np.logical_xor.reduce([holds(np.array(r) / down, px, py) for r in rings])
                        want.append(inside.mean())
                    assert got.get((sid, x, y, c), (0.0, 0.0)) == pytest.approx(tuple(want), abs=0.012), (sid, x, y, c)
                    seen += 0 < want[0] < 1
    assert seen > 60


def test_polygons_whose_numbers_change(spark):
    """Numbers that come out otherwise each time they are read: rings and boxes belong together all the same. Documents do not hang on the order of their rows."""
    slides = spark.createDataFrame([("s", 20000, 300, 100, 100, 100, 100, 1.0)], SLIDES)
    number = F.udf(lambda: random.getrandbits(40), "long").asNondeterministic()
    rows = [("s", "a", [[[x, 0.0], [x + 50, 0.0], [x + 50, 100.0], [x, 100.0]]]) for x in (100.0 * i for i in range(200))]
    df = spark.createDataFrame([*rows, ("s", "a", [[[120.0, 0.0], [180.0, 0.0], [180.0, 100.0], [120.0, 100.0]]]), ("s", None, rows[0][2]), ("s", "a", None)], "slide_id string, class string, rings array<array<array<double>>>")
    places = geometry.grid_tiles(slides).unionAll(spark.createDataFrame([("s", 7, 0), ("s", 0, 0)], "slide_id string, x int, y int"))  # off the grid, and a tile again
    got = {(r.x, r.y): r.tile_coverage for r in geometry.polygon_coverage(places, df.withColumn("polygon", number()), slides).collect()}
    assert got == {(100 * i, 0): 0.8 if i == 1 else 0.5 for i in range(200)}
    squares = spark.createDataFrame([("s", 50, 50 + 112 * i, 200.0, 300.0 + i, "Fat") for i in range(9)], "slide_id string, left int, top int, right double, bottom double, name string").coalesce(1)
    docs = [registry._documents(spark, "", squares.sortWithinPartitions(order)).collect() for order in (F.asc("top"), F.desc("top"))]
    assert docs[0] == docs[1]


def test_union_of_shifted_shapes(spark):
    """Two squares that overlap, one with a hole that the other covers in part; a null class and an upside-down box cover nothing; no shapes give no rows."""
    slides = spark.createDataFrame([("s", 100, 100, 100, 100, 100, 100, 1.0)], SLIDES)
    places = spark.createDataFrame([("s", 0, 0), ("s", 0, 0)], "slide_id string, x int, y int")

    def square(x, y, side):
        return [[x, y], [x + side, y], [x + side, y + side], [x, y + side]]

    rows = [("s", "a", 1, [square(0.0, 0.0, 40.0), square(10.0, 10.0, 20.0)]), ("s", "a", 2, [square(20.0, 20.0, 40.0)])]
    df = spark.createDataFrame(rows, "slide_id string, class string, polygon long, rings array<array<array<double>>>")
    r = geometry.polygon_coverage(places, df, slides).collect()
    assert len(r) == 1 and r[0].tile_coverage == pytest.approx((1600 - 400 + 1600 - (400 - 100)) / 1e4)
    boxes = spark.createDataFrame([("s", "a", 0, 0, 40, 40), ("s", "a", 20, 20, 60, 60), ("s", "a", 20, 20, 60, 60), ("s", "b", 0, 0, 100, 100), ("s", "b", 5, 5, 9, 9), ("s", None, 0, 0, 9, 9), ("s", "c", 9, 9, 3, 3), ("s", "d", None, 0, 9, 9)], "slide_id string, class string, left int, top int, right int, bottom int")
    got = {r["class"]: (r.tile_coverage, r.roi_coverage) for r in geometry.rectangle_coverage(places, boxes, slides).collect()}
    assert got == {"a": (0.28, round((15 * 15 + 35 * 35 - 15 * 15) / 2500, 9)), "b": (1.0, 1.0)}
    assert geometry.rectangle_coverage(places, boxes.limit(0), slides).collect() == []


def test_annotation_documents_and_faults(spark):
    def path(points):
        return [{"x": x, "y": y} for x, y in points]

    box, hole, bow = [(0, 0), (9, 0), (9, 9), (0, 9)], [(2, 2), (4, 2), (4, 4)], [(0, 0), (9, 9), (9, 0), (0, 9)]
    darwin = {"annotations": [
        {"name": "FAT", "polygon": {"path": path(box)}}, {"name": "nerve", "polygon": {"paths": [path(box), path(hole)]}}, {"name": "fat", "complex_polygon": {"path": [path(bow)]}},
        {"name": "other", "polygon": {"path": path(box)}}, {"name": "fat", "tag": {}}, {"name": "fat", "polygon": {"path": path(box[:2])}},
    ]}
    line = [*map(list, box), [0, 0]]
    geo = {"features": [{"properties": {"name": "Fat"}, "geometry": {"type": "MultiPolygon", "coordinates": [[line], [[[0, 0], [5, 5], [9, 9], [0, 0]]]]}}, {"properties": {"name": "Fat"}, "geometry": None}]}
    rows = [("d", json.dumps(darwin), "darwin"), ("g", json.dumps(geo), "geojson"), ("x", "{broken", "geojson"), ("y", None, "darwin")]
    mapping = spark.createDataFrame([("Fat", "fat", 1), ("Nerve", "Nerve", 0)], "class string, raw_name string, class_index int")
    flat = geometry.flatten_annotations(spark.createDataFrame(rows, "slide_id string, doc string, format string"), mapping)
    out = {(r.slide_id, r.polygon): (r["class"], len(r.rings), r.fault) for r in geometry.ring_faults(flat).collect()}
    assert out == {("d", 0): ("Fat", 1, None), ("d", 1 << 32): ("Nerve", 2, None), ("d", 2 << 32): ("Fat", 1, "area"), ("g", 0): ("Fat", 1, None), ("g", 1): ("Fat", 1, "area")}
    assert geometry._crosses(np.array([(0, 0), (9, 9), (9, 1), (0, 8)], float)) and not geometry._crosses(np.array(box, float))


def test_windows_over_the_edge(spark):
    t = spark.createDataFrame([("s", 672, 0)], "slide_id string, x int, y int")
    slides = spark.createDataFrame([("s", 784, 224, 224, 224)], "id string, extent_x int, extent_y int, tile_extent_x int, tile_extent_y int")
    sizes = spark.createDataFrame([("s", "m", 14, 4)], "slide_id string, mask string, mask_w int, mask_h int")
    cells = spark.createDataFrame([("s", "m", x, y, 1) for x in range(14) for y in range(4)], "slide_id string, mask string, cell_x int, cell_y int, value int")
    assert geometry.mask_coverage(t, slides, sizes, cells).first().tile_coverage == 0.5


def test_budget_and_split(spark):
    df = spark.createDataFrame([("a", i, 0) for i in range(5)] + [("b", i, 0) for i in range(3)], "slide_id string, x int, y int")
    assert [tuple(r) for r in folds.slide_budget(df, 2).collect()] == [("b", 3)]
    assert [tuple(r) for r in folds.slide_budget(df, 4, None).collect()] == [("b", 3)]
    with pytest.raises(ValueError):
        folds.slide_budget(df, 0)
    rows = spark.createDataFrame([(f"g{i % 7}", "t") for i in range(70)], "group_id string, stratify_target string")
    parted = catalogue.grouped_stratified_split(rows)
    assert parted.groupBy("group_id").agg(F.countDistinct("split").alias("k")).filter("k > 1").isEmpty()
    assert 0 < parted.filter("split = 'test'").count() <= 14


def test_hashed_folds(spark):
    df = spark.createDataFrame([(f"s{i % 9}", i, 0, "ab"[i % 2]) for i in range(300)], "slide_id string, x int, y int, label string")
    out = folds.stratified_folds(df, 4)
    counts = [r.n for r in out.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1
    whole = folds.stratified_group_folds(df, 4)
    assert whole.groupBy("slide_id").agg(F.countDistinct("fold").alias("k")).filter("k > 1").isEmpty()


def test_errors_and_retries(spark):
    df = spark.createDataFrame([("s", 1)], "slide_id string, tile int")
    with pytest.raises(Exception, match="unknown label"):
        tiles.map_class_index(df.withColumn("label", F.lit("z")), ["a"]).collect()
    with pytest.raises(Exception, match="unknown slide"):
        tiles.require_slides(df, spark.createDataFrame([("t",)], "id string")).collect()
    calls = []

    def flaky(batch):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("again")
        return [[1.0]] * len(batch)

    assert modelling.embed_tiles(df, flaky, pause=lambda s: None).first().embedding == [1.0]
    with pytest.raises(ValueError, match="fn or setup"):
        modelling.embed_tiles(df)


def test_checks_raise(spark):
    t = "slide_id string, x int, y int, roi_coverage_A double"
    some, none = spark.createDataFrame([("s", 0, 0, 0.5)], t), spark.createDataFrame([("s", 0, 0, 0.0)], t)
    tissue = spark.createDataFrame([("s", 0, 0, 0.0), ("s", 1, 0, 1.0)], "slide_id string, x int, y int, roi_tissue_coverage double")
    for args in ((none, tissue), (some, tissue)):
        with pytest.raises(ValueError, match="no rows left"):
            tiles.filter_tiles(*args)
    with pytest.raises(ValueError, match="no column"):
        tiles.filter_tiles(some, tissue.drop("roi_tissue_coverage"))
    with pytest.raises(ValueError, match="no column"):
        tiles.select_folds(some, [1])
    assert tiles.select_folds(some).count() == 1
    with pytest.raises(ValueError, match="empty"):
        tiles.check_slide_ids(some.limit(0))
    with pytest.raises(ValueError, match="1 null"):
        tiles.check_slide_ids(spark.createDataFrame([("s",), (None,)], "slide_id string"))
    with pytest.raises(ValueError, match="no rows left"):
        tiles.join_embeddings(some, some.withColumn("embedding", F.array(F.lit(1.0))).filter("x > 5"), check=True)
    labelled = some.withColumn("label", F.lit("a"))
    with pytest.raises(ValueError, match="no rows left"):
        folds.drop_rare_class_slides(labelled, 5, check=True)
    with pytest.raises(ValueError, match="no rows left"):
        tiles.slides_with_masks(spark.createDataFrame([("s",)], "id string"), spark.createDataFrame([("s", "a")], "slide_id string, mask string"), ["a", "b"], check=True)
    with pytest.raises(ValueError, match="no tiles to sample from"):
        folds.slide_budget(some.limit(0), 5)
    few = spark.createDataFrame([("a", "background")] * 2 + [("b", "b")] * 9, "label string, stratify_label string")
    with pytest.raises(ValueError, match="background has 2 rows"):
        folds.check_strata(few, 3)
    assert folds.check_strata(few, 2).count() == 11
    with pytest.raises(ValueError):
        geometry.grid_tiles(some, "both")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
def test_exact_quantiles(spark, n, monkeypatch):
    """Outliers, values of both signs and all sizes, alike large ones, one value, a null group."""
    rng = np.random.default_rng(n)
    values = {"a": rng.random(n), "b": np.round(rng.random(n), 1), "c": np.full(n, 0.25), "d": np.r_[rng.random(n), 1e6], "e": rng.normal(size=n) * 10.0 ** rng.integers(-12, 12, n), "f": 1e9 + rng.random(n), None: -rng.random(n), "g": np.zeros(n)}
    df = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v], "k string, value double")
    for buckets in (1, 1 << 16):
        monkeypatch.setattr(tiles, "_COARSE", buckets)
        got = {r.k: r.q for r in tiles.exact_quantiles(tiles.frequencies(df, "k"), "k").collect()}
        assert got.keys() == values.keys()
        for k, v in values.items():
            assert got[k] == pytest.approx(np.quantile(v, tiles.QUANTILES).tolist(), rel=1e-9, abs=1e-9), (k, buckets)
    for r in tiles.scalar_stats(df, "k").collect():
        v = values[r.k]
        assert (r.n, r.min, r.max) == (len(v), v.min(), v.max()) and (r["mean"], r["std"]) == pytest.approx((v.mean(), v.std()), rel=1e-9, abs=1e-6), r.k
    one = tiles.scalar_stats(df.filter("k = 'a'")).first()
    assert one.n == n and one.q50 == pytest.approx(np.median(values["a"]), abs=1e-6)
    assert tiles.scalar_stats(df.limit(0), "k").collect() == []


def test_files(spark, tmp_path):
    folder = tmp_path / "in" / "deep"
    folder.mkdir(parents=True)
    for name, text in {"a.svs": "image", "b.GEO.json": '{"features": []}', "c.json": '{"annotations": []}', "d.txt": "x"}.items():
        (folder / name).write_text(text)
    assert sorted(r.id_stem for r in files.scan_files(spark, str(tmp_path / "in")).collect()) == ["a", "b", "c", "d"]
    assert [r.id_stem for r in files.scan_files(spark, str(tmp_path / "in"), "*.svs").collect()] == ["a"]
    read = {r.path.rsplit("/", 1)[1]: (r.format, r.doc) for r in files.read_annotations(spark, str(folder)).collect()}
    assert read == {"b.GEO.json": ("geojson", '{"features": []}'), "c.json": ("darwin", '{"annotations": []}')}
    rows = [("i", "TCGA", "or,gan", 1, "/w", "/a", 0.25, None, 40, "v"), ("j", "MOU", None, None, None, None, None, 0.5, None, 'q"uote')]
    catalogue_ = spark.createDataFrame(rows, files.CATALOGUE)
    files.write_catalogue(catalogue_, str(tmp_path / "cat"))
    assert sorted(map(tuple, files.read_catalogue(spark, str(tmp_path / "cat")).collect())) == rows
    files.write_class_map(catalogue_.filter("label IS NOT NULL").union(catalogue_.filter("label = 1")), str(tmp_path / "map"))
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "map")).select("organ", "label").collect()] == [("or,gan", 1)]
    df = spark.range(0, 1000, 1, 7).withColumn("y", F.lit(1))
    schema = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("id", T.IntegerType())])
    files.write_tiles(df, str(tmp_path / "tiles"), schema)
    back = files.read_tiles(spark, str(tmp_path / "tiles"))
    assert back.dtypes == [("y", "double"), ("id", "int")] and back.count() == 1000
    assert files.read_tiles(spark, str(tmp_path / "tiles"), ["id"]).columns == ["id"]
    files.write_sized(df, str(tmp_path / "sized"), 300)
    assert len(list((tmp_path / "sized").glob("*.parquet"))) == 3 and spark.read.parquet(str(tmp_path / "sized")).count() == 1000
    assert files.file_count(5, 10) == 1 and files.resolve_template("{a}/{b}", a="x", b="y") == "x/y"


def test_linear_probe_by_its_gradient(spark):
    """At the fitted weights the gradient of the weighted loss with its penalty is zero, and predictions are their softmax."""
    rng = np.random.default_rng(5)
    target = rng.choice(3, 300, p=[0.6, 0.3, 0.1])
    x = rng.normal(size=(300, 4)) + np.eye(3, 4)[target]
    df = spark.createDataFrame([("s", i, 0, int(t), v.tolist()) for i, (t, v) in enumerate(zip(target, x, strict=True))], "slide_id string, x int, y int, target int, embedding array<double>")
    decay = 0.01
    model = modelling.fit_linear_probe(df, decay, 3, 500)
    w, b = model.coefficientMatrix.toArray(), np.array(model.interceptVector)
    weight = (300 / (3 * np.bincount(target)))[target]
    z = x @ w.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    error = (p - np.eye(3)[target]) * weight[:, None] / weight.sum()
    assert np.abs(error.T @ x + decay * w).max() < 1e-3 and np.abs(error.sum(0)).max() < 1e-3
    out = modelling.predict_probe(model, df, ["a", "b", "c"]).orderBy("x").collect()
    assert np.allclose([[r.prob_a, r.prob_b, r.prob_c] for r in out], p, atol=1e-9) and [r.pred for r in out] == p.argmax(1).tolist()
    numbered = modelling.predict_probe(model, df, ["a"])
    assert numbered.columns[-3:] == ["prob_0", "prob_1", "prob_2"]
    more = modelling.predict_probe(model, df, ["a", "b", "c", "d"]).first()
    assert more.prob_d == 0.0


def test_targets_count_over_spellings(spark):
    df = spark.createDataFrame([("S", "Liver")] * 3 + [("S", "liver")] * 3 + [("T", "liver")] * 2, "source string, organ string")
    out = {(r.source, r.organ): r.stratify_target for r in catalogue.merge_rare_strata(df, 5).collect()}
    # s_liver has six rows over both spellings; only t_liver is rare, and it takes the spelling liver with it.
    assert out == {("S", "Liver"): "other_rare_organs", ("S", "liver"): "s_t_liver", ("T", "liver"): "s_t_liver"}


def test_balanced_group_folds(spark):
    """Whole slides, and every label's tiles near a fold's share: nearer than a deal by majority label."""
    rng = np.random.default_rng(9)
    rows = [(f"s{i}", k, 0, None if j == 3 else "abcd"[j]) for i in range(120) for j in range(4) for k in range(int(rng.pareto(3) * 8 * (j == i % 4) + rng.integers(0, 4)))]
    df = spark.createDataFrame(rows, "slide_id string, x int, y int, label string")
    for block in (1024, 30):
        out = folds.balanced_group_folds(df, 5, block=block)
        assert out.count() == len(rows) and out.groupBy("slide_id").agg(F.countDistinct("fold").alias("k")).filter("k > 1").isEmpty()

        def spread(parted):
            table = parted.groupBy("label").pivot("fold", list(range(5))).count().fillna(0).toPandas().set_index("label")
            return (table.std(axis=1, ddof=0) / table.mean(axis=1)).mean()

        assert spread(out) < spread(folds.stratified_group_folds(df, 5)) and (block < 100 or spread(out) < 0.15)
    assert folds.balanced_group_folds(df.limit(0)).collect() == []
