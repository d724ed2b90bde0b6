"""Jobs with checks, resumed runs, stored buckets, calls in flight, all fits at once, budgets and rasters at larger sizes."""

from __future__ import annotations

import itertools
import math
import re
import threading
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilequery.operators import folds, geometry, groups, jobs, modelling, tiles
from tilequery.plans import registry
from tilequery.sources import files

TILES = "slide_id string, x int, y int, roi_coverage_A double, roi_coverage_B double"
TISSUE = "slide_id string, x int, y int, roi_tissue_coverage double"


def executions(spark, action):
    """SQL executions that wrote or computed something while ``action`` ran."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    action()
    time.sleep(1.0)
    return store.executionsCount() - before


def test_filter_job(spark, tmp_path):
    some = spark.createDataFrame([("s", 0, 0, 0.5, 0.0), ("s", 1, 0, 0.0, 0.0), ("t", 1, 0, None, 0.2)], TILES)
    tissue = spark.createDataFrame([("s", 0, 0, 0.7), ("t", 1, 0, 0.0)], TISSUE)
    path = str(tmp_path / "out")
    assert executions(spark, lambda: jobs.filter_job(some, tissue, path)) == 1
    assert [r.slide_id for r in spark.read.parquet(path).collect()] == ["s"]
    for args, what in (((some.filter("x > 5"), tissue), "annotation filter"), ((some.filter("x = 1"), tissue), "annotation filter: no rows left|tissue filter: no rows left"), ((some, tissue.filter("x > 5")), "tissue filter: no rows left")):
        with pytest.raises(ValueError, match=what):
            jobs.filter_job(*args, path)
    with pytest.raises(ValueError, match="no column"):
        jobs.filter_job(some, tissue.drop("roi_tissue_coverage"), path)
    # Failed jobs have left the first one's table, and nothing beside it.
    assert spark.read.parquet(path).count() == 1 and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_coverage_and_folds_jobs(spark, tmp_path):
    slides = spark.createDataFrame([("s", 900, 900, 224, 224, 112, 112, 1.0)], "id string, extent_x int, extent_y int, tile_extent_x int, tile_extent_y int, stride_x int, stride_y int, downsample double")
    places = geometry.grid_tiles(slides)
    sizes = spark.createDataFrame([("s", "m", 90, 90)], "slide_id string, mask string, mask_w int, mask_h int")
    cells = spark.createDataFrame([("s", "m", 3, 4, 255)], "slide_id string, mask string, cell_x int, cell_y int, value int")
    path = str(tmp_path / "coverage")
    jobs.coverage_job(places, slides, sizes, cells, path)
    assert spark.read.parquet(path).count() == places.count()
    for t, z, what in ((places.limit(0), sizes, "the table is empty"), (places.withColumn("slide_id", F.when(F.col("x") > 0, F.col("slide_id"))), sizes, "null slide ids"), (places, sizes.limit(0), "masks of slides: no rows left")):
        with pytest.raises(ValueError, match=what):
            jobs.coverage_job(t, slides, z, cells, path)
    rows = spark.createDataFrame([(f"s{i % 7}", i, 0, 0.5 * (i % 2), 0.5 * (1 - i % 2)) for i in range(140)], TILES)
    for strategy in jobs.STRATEGIES:
        jobs.folds_job(rows, str(tmp_path / strategy), strategy)
        assert {r.fold for r in spark.read.parquet(str(tmp_path / strategy)).select("fold").distinct().collect()} == set(range(5))
    with pytest.raises(ValueError, match="strategy random"):
        jobs.folds_job(rows, path, "random")
    with pytest.raises(ValueError, match="no rows left"):
        jobs.folds_job(rows.filter("slide_id < 's2'"), path, "stratified_group")
    with pytest.raises(ValueError, match="background has 2 rows"):
        jobs.folds_job(rows.limit(7).withColumn("roi_coverage_A", F.when(F.col("x") < 1, 0.0).otherwise(0.5)).withColumn("roi_coverage_B", F.when(F.col("x") == 2, 0.9).otherwise(0.0)), path, "stratified", 3)
    vectors = rows.select("slide_id", "x", "y", F.array(F.lit(1.0)).alias("embedding"))
    jobs.training_job(vectors, rows, ["A", "B"], {"A": 0.1, "B": 0.1}, str(tmp_path / "training"))
    assert spark.read.parquet(str(tmp_path / "training")).count() == 140
    with pytest.raises(ValueError, match="no rows left"):
        jobs.training_job(vectors.filter("x > 500"), rows, ["A", "B"], {"A": 0.1, "B": 0.1}, path)


def test_broken_run_is_resumed(spark, tmp_path):
    slides = spark.createDataFrame([(f"{i:03}", i) for i in range(40)] + [("003", 3), (None, 1)], "id string, n int")
    path, seen, worked = str(tmp_path / "tiles"), itertools.count(), []

    def work(some):
        if next(seen) == 3:
            raise RuntimeError("killed")
        worked.append(some.count())
        return some.filter("n <> 7").select(F.col("id").alias("slide_id"), F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") % 3).cast("long"))).alias("x"), "n")

    with pytest.raises(RuntimeError, match="killed"):
        jobs.resume_by_slide(slides, work, path, 8)
    half = sum(worked)
    assert 0 < half < 40 and jobs.read_by_slide(spark, path).select("slide_id").distinct().count() in (half, half - 1)
    # A run that died between its data and its note has left partitions that are written anew.
    done = {r.id for r in spark.read.parquet(f"{path}/_done").collect()}
    lost = next(i for i in (f"{i:03}" for i in range(40)) if i not in done and i != "007")
    spark.createDataFrame([(99, 1)], "x long, n int").write.parquet(f"{path}/slide_id={lost}")
    # The second run brings its columns in another order and type, and one more.
    again = lambda some: work(some).select("n", F.col("x").cast("int").alias("x"), F.lit(1).alias("more"), "slide_id")
    assert jobs.resume_by_slide(slides, again, path, 8) == 40 - half
    out = jobs.read_by_slide(spark, path)
    assert out.dtypes == [("slide_id", "string"), ("x", "bigint"), ("n", "int")]
    want = sorted((f"{i:03}", x, i) for i in range(40) if i != 7 for x in range(i % 3 + 1))
    assert sorted(map(tuple, out.collect())) == want
    assert jobs.resume_by_slide(slides, work, path, 8) == 0 and sum(worked) == 40
    with pytest.raises(ValueError, match="no column"):
        jobs.resume_by_slide(spark.createDataFrame([("900", 1)], "id string, n int"), lambda s: s.select(F.col("id").alias("slide_id")), path)


def test_joins_of_stored_buckets_shuffle_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i % 5}", i, 0, i % 3) for i in range(200)], "slide_id string, x int, y int, n int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vectors = files.store_bucketed(rows.select("slide_id", "x", "y", F.array(F.col("x").cast("float")).alias("embedding")), "vectors_b", 8, path=str(tmp_path / "v"))
        meta = files.store_bucketed(rows, "meta_b", 8, path=str(tmp_path / "m"))
        tissue = files.store_bucketed(rows.filter("n > 0").select("slide_id", "x", "y", F.lit(0.5).alias("roi_tissue_coverage")), "tissue_b", 8, path=str(tmp_path / "t"))
        both = tiles.join_embeddings(meta, vectors)
        assert both.count() == 200 and "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        three = modelling.prediction_set(vectors, tissue)
        assert three.count() == rows.filter("n > 0").count() and "Exchange" not in three._jdf.queryExecution().executedPlan().toString()
        # A side that is not stored moves to the buckets; the vectors stay.
        one = tiles.join_embeddings(rows, vectors)
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert one.count() == 200 and len(re.findall(r"(?<!\w)Exchange", plan)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in ("vectors_b", "meta_b", "tissue_b"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_calls_in_flight(spark):
    """At most four calls at once and often as many; the function is set up once in a worker; rows keep their order; a bad row is tried alone."""
    df = spark.range(0, 60, 1, 1).select(F.col("id"), F.col("id").alias("tile"))

    def setup():
        lock, state = threading.Lock(), {"now": 0, "tried": {}, "made": time.time()}

        def slow(rows):
            with lock:
                state["now"] += 1
                now = state["now"]
                tried = state["tried"].setdefault(tuple(rows["tile"]), 0)
                state["tried"][tuple(rows["tile"])] += 1
            time.sleep(0.05)
            with lock:
                state["now"] -= 1
            if 17 in set(rows["tile"]) and (len(rows) > 1 or tried < 2):
                raise RuntimeError("bad row")
            return [[float(t), float(now), state["made"]] for t in rows["tile"]]

        return slow

    out = modelling.embed_tiles(df, setup=setup, name="test", in_flight=4, rows_per_call=5, pause=lambda s: None).collect()
    assert [r.id for r in out] == list(range(60)) and [r.embedding[0] for r in out] == [float(i) for i in range(60)]
    assert max(r.embedding[1] for r in out) == 4.0 and len({r.embedding[2] for r in out}) == 1
    with pytest.raises(Exception, match="always"):
        modelling.embed_tiles(df, lambda rows: (_ for _ in ()).throw(RuntimeError("always")), attempts=2, pause=lambda s: None).collect()
    assert modelling.embed_tiles(df.limit(0), lambda rows: 1 / 0).collect() == []


def test_calls_come_back_by_batch():
    """Small calls, but a frame for each batch: one for each call takes longer to send back than the call."""

    class Batches:
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("tile", T.LongType())])

        def mapInPandas(self, run, schema):  # noqa: N802
            return list(run(pd.DataFrame({"id": range(n), "tile": range(n)}) for n in (50, 0, 33)))

    out = modelling.embed_tiles(Batches(), lambda rows: [[float(t)] for t in rows["tile"]], rows_per_call=4, in_flight=3)
    assert [len(f) for f in out] == [50, 33] and [v[0] for f in out for v in f["embedding"]] == [*range(50), *range(33)]


def test_all_fits_at_once(spark):
    """Each model is what it would be by itself, with balanced classes and free intercepts."""
    draw = np.random.default_rng(2)
    middle = draw.normal(size=(3, 5))
    rows = [(i % 4, i % 3 if i % 9 else 0, (middle[i % 3] + draw.normal(size=5)).tolist()) for i in range(400)] + [(None, 1, [0.0] * 5), (1, None, [0.0] * 5)]
    df = spark.createDataFrame(rows, "fold int, target int, embedding array<double>").repartition(3).cache()
    models = modelling.fit_linear_probes(df, [0.01, 0.1], [0, 1, 2, 3], 3, 200, 1e-10)
    assert len(models) == 8
    for wd, k in ((0.01, 0), (0.1, 3)):
        own = modelling.fit_linear_probe(df.dropna().filter(F.col("fold") != k), wd, 3, 500, 1e-12)
        w = models[wd, k]
        assert np.abs(own.coefficientMatrix.toArray() - w[:, :-1]).max() < 1e-4
        b = own.interceptVector.toArray()
        assert np.abs((b - b.mean()) - (w[:, -1] - w[:, -1].mean())).max() < 1e-4
    got = {(r.weight_decay, r.fold): (r.macro_accuracy, r.macro_f1) for r in modelling.cross_validate(df, ["a", "b", "c"], [0.1], [0, 3], 200).collect()}
    predicted = modelling.predict_linear(df, models).filter("weight_decay = 0.1 AND fold = 3")
    assert got[0.1, 3] == pytest.approx(tuple(modelling.macro_metrics(predicted, 3).first()), abs=1e-9)
    with pytest.raises(ValueError, match="no rows to fit"):
        modelling.fit_linear_probes(df.limit(0), [0.1], [0], 3)


@pytest.mark.parametrize("few", [0, 10, 10_000])
def test_budget_in_rounds(spark, few, monkeypatch):
    """Against a loop over all slides, with hardly any left to the driver: large slides, ties, a null slide, budgets of all sizes."""
    monkeypatch.setattr(folds, "_FEW", few)
    draw = np.random.default_rng(4)
    sizes = {f"s{i:03}": int(draw.choice([1, 2, 5, 40, 90])) for i in range(60)} | {None: 3}
    df = spark.createDataFrame([(s, i) for s, n in sizes.items() for i in range(n)], "slide_id string, x int").cache()
    order = sorted(sizes, key=lambda s: (s is not None, s))
    for budget in (1, 7, 100, 333, 5000):
        want, used = [], 0
        for s in order:
            if used + sizes[s] <= budget:
                want.append((s, sizes[s]))
                used += sizes[s]
        got = folds.slide_budget(df, budget, None).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str), budget
        hashed = folds.slide_budget(df, budget, 3).collect()
        assert sum(r.n for r in hashed) <= budget and len(hashed) == len({r.slide_id for r in hashed})
        left = [n for s, n in sizes.items() if s not in {r.slide_id for r in hashed}]
        assert not left or min(left) + sum(r.n for r in hashed) > budget


def test_budget_of_a_million_slides(spark, monkeypatch):
    """No row lists the slides: the driver sees a row for each range, and the last few."""
    monkeypatch.setattr(folds, "_FEW", 1000)
    monkeypatch.setattr(folds, "tiles_per_slide", lambda df: df)
    slides = spark.range(1_000_000).select(F.col("id").cast("string").alias("slide_id"), (F.pmod(F.xxhash64("id"), F.lit(97)) + 1).alias("n"))
    out = folds.slide_budget(slides, 20_000_000, 1)
    assert "collect_list" not in out._jdf.queryExecution().toString()
    row = out.agg(F.sum("n").alias("n"), F.countDistinct("slide_id").alias("k"), F.count("*").alias("rows")).first()
    assert row.k == row.rows and 20_000_000 - 97 < row.n <= 20_000_000


def test_label_runs_by_painting(spark):
    """Stars with holes drawn over each other, cell by cell; points, flat rings, and nulls draw nothing."""
    draw = np.random.default_rng(6)
    polygons, size = [], 200
    for i in range(30):
        turn = (np.arange(9) + draw.random(9)) / 9 * 2 * np.pi
        ring = draw.uniform(60, 130, 2) + np.c_[np.cos(turn), np.sin(turn)] * draw.uniform(5, 40, (9, 1))
        polygons.append(("s", i % 4, i, [ring.tolist(), *([(ring.mean(0) + (ring - ring.mean(0)) * 0.4).tolist()] if i % 3 == 0 else [])]))
    odd = [("s", 3, 90, [[[5.0, 5.0]]]), ("s", 3, 91, [[[1.0, 2.0], [9.0, 2.0]]]), ("s", 3, 92, None), ("s", 3, 93, [])]
    df = spark.createDataFrame(polygons + odd, "slide_id string, class_index int, polygon long, rings array<array<array<double>>>")
    want = np.full((size, size), -1)
    y, x = np.mgrid[0:size, 0:size] + 0.5
    for _, c, _, rings in sorted(polygons, key=lambda p: (p[1], p[2])):
        for k, r in enumerate(rings):
            odd_ = np.zeros(want.shape, bool)
            for (x0, y0), (x1, y1) in zip(r, r[1:] + r[:1], strict=True):
                if y0 != y1:
                    odd_ ^= ((y0 <= y) != (y1 <= y)) & (x0 + (y - y0) * (x1 - x0) / (y1 - y0) <= x)
            want[odd_] = geometry.NO_CLASS if k else c
    cells = {(r.cell_x, r.cell_y): r.value for r in geometry.rasterise_labels(df).collect()}
    assert cells == {(int(b), int(a)): int(want[a, b]) for a, b in zip(*np.nonzero(want >= 0), strict=True)}
    runs = sorted(geometry.label_runs(df).collect())
    assert len(runs) < len(cells) / 3
    assert all(not (a.cell_y == b.cell_y and a.last + 1 == b.first and a.value == b.value) for a, b in zip(runs, runs[1:], strict=False))
    assert geometry.label_runs(df.limit(0)).collect() == []


def test_rectangles_by_painting(spark):
    """Boxes over several bands, also left of and above the first cell; null sides and classes, flat and repeated boxes."""
    draw = np.random.default_rng(5)
    boxes = [("st"[i % 2], int(draw.integers(0, 4)), *(float(v) for v in (x, y, x + draw.integers(0, 300), y + draw.integers(0, 3000)))) for i, (x, y) in enumerate(draw.integers(-200, 900, (40, 2)))]
    boxes += [boxes[0], ("s", None, 5000.0, 0.0, 5020.0, 10.0), ("s", 2, 7000.0, 0.0, None, 10.0), ("s", 2, None, 0.0, 9.0, 9.0), (None, 1, 0.0, 0.0, 9.0, 9.0)]
    df = spark.createDataFrame(boxes, "slide_id string, class_index int, left double, top double, right double, bottom double")
    want = {}
    for s, c, left, top, right, bottom in boxes:
        if left is not None:
            x, y = int(left // 10), int(top // 10)
            for cx in range(x, max(x, math.ceil(right / 10) - 1 if right is not None else x) + 1):
                for cy in range(y, max(y, math.ceil(bottom / 10) - 1) + 1):
                    want[s, cx, cy] = c if want.get((s, cx, cy)) is None else max(want[s, cx, cy], -1 if c is None else c)
    out = geometry.rasterise_rectangles(df, 10.0)
    rows = out.collect()
    assert {(r.slide_id, r.cell_x, r.cell_y): r.value for r in rows} == want and len(rows) == len(want)
    assert dict(out.dtypes)["value"] == "int"


def test_many_groups_in_a_call(spark, monkeypatch):
    """Groups are whole wherever batches end, many small ones share a call, and spans of several slides and bands keep apart in it."""
    monkeypatch.setattr(groups, "ROWS", 100)
    df = spark.range(0, 3000, 1, 3).select((F.col("id") % 700).cast("string").alias("k"), F.when(F.col("id") % 3 > 0, 1).alias("j")).unionAll(spark.range(900).selectExpr("'x' AS k", "2 AS j"))
    least = 100

    def count(rows):
        new = np.flatnonzero(groups.starts(rows, ["k", "j"]))
        return pa.table({"k": rows.column("k").take(pa.array(new)), "n": pa.array(np.diff(np.r_[new, rows.num_rows])), "call": pa.array([min(rows.num_rows, least)] * len(new))})

    got = groups.in_groups(df.repartition(3), ["k", "j"], count, "k string, n long, call long").collect()
    want = df.groupBy("k", "j").count().collect()
    assert sorted((r.k, r.n) for r in got) == sorted((r.k, r["count"]) for r in want) and sum(r.call == least for r in got) > len(got) / 2
    ints = [pa.array(v, pa.int32()) for v in ([0, 0, 63, 64], [0, 0, 63, 64], [0, 0, 5, 5], [4, 4, 8, 8], [1, 2, 1, 1], [0] * 4, [0] * 4)]
    spans = pa.table([pa.array(["a", "b", "b", "b"]), pa.array([0, 0, 0, 1], pa.int32()), *ints[1:]], ["slide_id", "band", "cell_y", "first", "last", "class_index", "polygon", "hole"])
    assert [tuple(r.values()) for r in geometry._topmost(spans).to_pylist()] == [("a", 0, 0, 4, 1), ("b", 0, 0, 4, 2), ("b", 63, 5, 8, 1), ("b", 64, 5, 8, 1)]


def test_maps_and_windows_across_blocks(spark, monkeypatch):
    """Small blocks, so that tiles and windows cross them; nulls, repeated tiles, and cells that repeat."""
    monkeypatch.setattr(geometry, "SIDE", 5)
    slides = spark.createDataFrame([("s", 400, 300, 64, 48, 16, 12, 1.0)], "id string, extent_x int, extent_y int, tile_extent_x int, tile_extent_y int, stride_x int, stride_y int, downsample double")
    draw = np.random.default_rng(9)
    rows = [("s", int(x), int(y), None if i % 13 == 0 else float(draw.random()), float(draw.random())) for i, (x, y) in enumerate((x, y) for x in range(0, 400, 16) for y in range(0, 300, 12) if draw.random() < 0.5)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "slide_id string, x int, y int, prob_a double, prob_b double")
    held = {}
    for _, x, y, a, b in rows:
        for i in range(x // 16, min(x // 16 + 4, 25)):
            for j in range(y // 12, min(y // 12 + 4, 25)):
                held.setdefault((i, j), []).append((a, b))
    votes = {(r.cell_x, r.cell_y): r.value for r in geometry.vote_map(df, ["a", "b"], slides).collect()}
    assert votes.keys() == held.keys()
    for k, v in held.items():
        a, b = sum(p[0] or 0 for p in v), sum(p[1] for p in v)
        assert abs(a - b) < 1e-9 or votes[k] == (128 if a > b else 255)
    means = {(r.cell_x, r.cell_y): r.value for r in geometry.scalar_map(df, "prob_a", slides).collect()}
    levels = {(r.cell_x, r.cell_y): (r.map_a, r.map_b) for r in geometry.probability_map(df, ["a", "b"], slides).collect()}
    for k, v in held.items():
        known = [p[0] for p in v if p[0] is not None]
        assert means[k] == (pytest.approx(np.mean(known), abs=1e-8) if known else None)
        assert levels[k] == (int(np.mean(known) * 255) if known else None, int(np.mean([p[1] for p in v]) * 255))
    one = spark.createDataFrame([("s", 0, 0, 0.2, 1.0)], "slide_id string, x int, y int, prob_a double, prob_b double")
    assert {(r.map_a, r.map_b) for r in geometry.probability_map(one, ["a", "b"], slides).collect()} == {(51, 255)}
    sizes = spark.createDataFrame([("s", "m", 100, 100), ("s", "n", 13, 9)], "slide_id string, mask string, mask_w int, mask_h int")
    lit = [("s", m, int(draw.integers(0, w + 2)), int(draw.integers(0, h + 2)), int(draw.integers(0, 2))) for m, w, h in (("m", 100, 100), ("n", 13, 9)) for _ in range(3000)]
    cells = spark.createDataFrame(lit, "slide_id string, mask string, cell_x int, cell_y int, value int")
    places = geometry.grid_tiles(slides, "keep")
    for r in geometry.mask_coverage(places, slides, sizes, cells).collect():
        w, h = (100, 100) if r["mask"] == "m" else (13, 9)
        ox, oy, wx, wy = round(r.x * w / 400), round(r.y * h / 300), max(1, round(64 * w / 400)), max(1, round(48 * h / 300))
        own = [(x - ox, y - oy) for _, m, x, y, v in lit if m == r["mask"] and v and x < w and y < h]
        inside = sum(0 <= x < wx and 0 <= y < wy for x, y in own)
        hx, hy = max(1, wx // 2), max(1, wy // 2)
        middle = sum(wx // 4 <= x < wx // 4 + hx and wy // 4 <= y < wy // 4 + hy for x, y in own)
        assert (r.tile_coverage, r.roi_coverage) == pytest.approx((inside / (wx * wy), middle / (hx * hy)), abs=1e-12)


def test_flattening_keeps_partitions(spark):
    """Shapes meet the few names where they are, not in a task for each name."""
    doc = '{"features": [{"properties": {"name": "fat"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [9, 0], [9, 9]]]}}, 5]}'
    docs = spark.range(64).repartition(8).select(F.concat(F.lit("s"), "id").alias("slide_id"), F.lit(doc).alias("doc"))
    mapping = spark.createDataFrame([("Fat", "FAT", 0), ("Nerve", "nerve", 1)], "class string, raw_name string, class_index int")
    flat = geometry.flatten_annotations(docs, mapping)
    parts = flat.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and sum(r["count"] for r in parts) == 64


def test_tiles_meet_as_columns(spark):
    """Tiles of a block are a row for each column of grid places, up to the 64th bit, and need no sort by slide to find their scale."""
    slides = spark.createDataFrame([("s", 300, 9000, 20, 20, 10, 10, 1.0)], "id string, extent_x int, extent_y int, tile_extent_x int, tile_extent_y int, stride_x int, stride_y int, downsample double")
    places = geometry.grid_tiles(slides).filter("NOT (x = 10 AND y = 640)")
    places = places.unionAll(places).unionAll(spark.createDataFrame([("s", 11, 640), ("t", 0, 0), (None, 0, 0)], "slide_id string, x int, y int"))
    boxes = spark.createDataFrame([("s", "a", 15, 625, 25, 655), ("s", "a", 15, 640, 25, 645), ("s", "b", 295, 8995, 400, 9999)], "slide_id string, class string, left int, top int, right int, bottom int")
    rows = geometry._met(boxes, places, slides, ["left", "top", "right", "bottom"])
    assert rows.filter("tiles IS NOT NULL").count() == 29 * 15  # 29 columns of 899 places
    assert rows.filter("tiles IS NOT NULL").agg(F.sum(F.bit_count("tiles.places"))).first()[0] == 29 * 899 - 1
    assert "SortMergeJoin" not in rows._jdf.queryExecution().executedPlan().toString()
    got = {(r["class"], r.x, r.y): r.tile_coverage for r in geometry.rectangle_coverage(places, boxes, slides).collect()}
    sides = {"a": [(15, 625, 25, 655)], "b": [(295, 8995, 400, 9999)]}
    want = {}
    for k, own in sides.items():
        for left, top, right, bottom in own:
            for x in range(0, 281, 10):
                for y in range(0, 8981, 10):
                    w, h = min(right, x + 20) - max(left, x), min(bottom, y + 20) - max(top, y)
                    if w > 0 and h > 0 and (x, y) != (10, 640):
                        want[k, x, y] = w * h / 400
    assert got == want


def test_maps_need_no_order_by_slide(spark):
    slides = spark.createDataFrame([("s", 40, 20, 20, 20, 10, 10)], "id string, extent_x int, extent_y int, tile_extent_x int, tile_extent_y int, stride_x int, stride_y int")
    cells = geometry.scalar_map(geometry.grid_tiles(slides.withColumn("id", F.col("id"))).withColumn("v", F.col("x") / 10), "v", slides)
    assert "SortMergeJoin" not in cells._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.cell_x, r.value) for r in cells.filter("cell_y = 0").collect()) == [(0, 0.0), (1, 0.5), (2, 1.5), (3, 2.0)]


def test_documents_gather_sides(spark):
    """Squares are shuffled as their sides; the text is written where they have been gathered."""
    plan = registry._documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    gathered = plan[plan.index("collect_list(") :].split(", 0, 0)")[0]
    assert "Feature" not in gathered and "top" in gathered


def test_both_formats_gather_sides(spark):
    plan = registry.QUERIES["read_annotation_documents"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    gathered = [p.split(", 0, 0)")[0] for p in plan.split("collect_list(")[1:]]
    assert len(gathered) == 2 and not any("polygon" in g or "Feature" in g for g in gathered)
