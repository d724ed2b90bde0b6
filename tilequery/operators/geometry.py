"""Grids, polygons, rasters as cell tables, and maps of predictions.

Tile size, stride, extent and downsample come from each slide's row: ``slides`` has ``id, extent_x, extent_y, tile_extent_x,
tile_extent_y, stride_x, stride_y, downsample``, ids once and nothing null. Tiles of slides that are not there get nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  used as pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilequery.functions.columns import half_even

from .groups import in_groups, starts
from .tiles import KEY
from .union import edges_near, ranges, union_areas

#: Grid places along a side of the blocks whose shapes and tiles meet.
UNITED = 64
#: Rows of shapes and tiles that are looked at together: a shape meets ten tiles, and each of these several sides.
_TOGETHER = 1 << 14
#: Edges that are looked at together.
_EDGES = 1 << 21
#: Cells along a side of the blocks in which windows and maps are summed, and rows of a band of runs.
SIDE, BAND = 256, 64
NO_CLASS = 255


def grid_tiles(slides: DataFrame, last: str = "drop") -> DataFrame:
    """One row for each grid place; ``last`` says whether tiles that leave the slide are dropped or kept."""
    if last not in ("drop", "keep"):
        raise ValueError("last is drop or keep")

    def places(axis: str) -> Column:
        end = F.col(f"extent_{axis}") - (F.col(f"tile_extent_{axis}") if last == "drop" else F.lit(1))
        return F.explode(F.when(end >= 0, F.sequence(F.lit(0), end.cast("int"), F.col(f"stride_{axis}"))).otherwise(F.array().cast("array<int>")))

    return slides.withColumn("x", places("x")).withColumn("y", places("y")).select(F.col("id").alias("slide_id"), "x", "y")


def flatten_annotations(docs: DataFrame, mapping: DataFrame, name_path: str = "properties.name") -> DataFrame:
    """Documents ``(slide_id, doc)`` and ``(class, raw_name, class_index)`` -> ``(slide_id, class, class_index, polygon, rings)``.

    A document is GeoJSON, or Darwin JSON where a column ``format`` says so (see ``annotation_format``). Names match as whole
    strings in any case. A raw name of two classes gives two rows; null and empty shapes and broken documents are left out;
    multi-polygons give a row for each part; of a key that repeats in an object the last counts. ``polygon`` numbers the shapes of a document. Rings that are no
    simple outlines stay in; :func:`ring_faults` tells which. ``mapping`` is broadcast: it is a table of names that people write, and
    by name all shapes of a class would meet in one task.
    """
    shapes = _geojson_shapes(docs.filter("format = 'geojson'") if "format" in docs.columns else docs, name_path)
    if "format" in docs.columns:
        shapes = shapes.unionByName(_darwin_shapes(docs.filter("format = 'darwin'")))
    flat = shapes.filter("rings IS NOT NULL AND size(rings) > 0 AND size(rings[0]) > 2")
    names = F.broadcast(mapping.select("class", F.lower("raw_name").alias("_raw"), "class_index"))
    joined = flat.join(names, F.lower("name") == F.col("_raw"))
    number = F.shiftleft(F.col("feature").cast("long"), 32) + F.col("part")
    return joined.select("slide_id", "class", "class_index", number.alias("polygon"), "rings")


def _geojson_shapes(docs: DataFrame, name_path: str) -> DataFrame:
    """Names and rings of features. Outer generators read a text once: others put a filter with the whole expression below themselves."""
    collection = F.from_json("doc", "features array<string>")["features"]
    features = docs.select("slide_id", F.posexplode_outer(collection).alias("feature", "f"))
    field = "geometry struct<type: string, coordinates: string>"
    plain = re.fullmatch(r"(?!geometry\b)\w+(\.\w+)*", name_path)
    if plain:
        first, *rest = name_path.split(".")
        kind = "string"
        for k in reversed(rest):
            kind = f"struct<`{k}`: {kind}>"
        field += f", `{first}` {kind}"
    read = features.select("slide_id", "feature", "f", F.inline_outer(F.array(F.from_json("f", field))))
    name = F.col(name_path) if plain else F.get_json_object("f", f"$.{name_path}")
    kind, shape = F.col("geometry.type"), F.col("geometry.coordinates")
    rings = "array<array<array<double>>>"
    parts = F.when(kind == "Polygon", F.array(F.from_json(shape, rings))).when(kind == "MultiPolygon", F.from_json(shape, f"array<{rings}>"))
    return read.select("slide_id", "feature", name.alias("name"), F.posexplode_outer(parts).alias("part", "rings"))


def _darwin_shapes(docs: DataFrame) -> DataFrame:
    """Annotations with a name and a polygon, whose ``path`` is one outline or whose ``paths`` are an outline and its holes."""
    annotations = F.from_json("doc", "annotations array<string>")["annotations"]
    found = docs.select("slide_id", F.posexplode_outer(annotations).alias("feature", "f"))
    read = found.select("slide_id", "feature", F.inline_outer(F.array(F.from_json("f", "name string, polygon struct<path: string, paths: string>, complex_polygon struct<path: string>"))))
    line = "array<struct<x: double, y: double>>"
    many = F.coalesce(F.from_json("polygon.paths", f"array<{line}>"), F.from_json("complex_polygon.path", f"array<{line}>"))
    single = F.from_json("polygon.path", line)
    paths = F.coalesce(many, F.when(single.isNotNull(), F.array(single)))
    rings = F.transform(paths, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    return read.select("slide_id", "feature", "name", F.lit(0).alias("part"), F.explode_outer(F.array(rings)).alias("rings"))


def _crosses(ring: np.ndarray) -> bool:
    """Whether two edges of a closed ring that are not neighbours meet."""
    a, b = ring, np.roll(ring, -1, axis=0)
    n = len(ring)

    def side(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        return np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))

    for s in range(0, n, 256):  # so many edges at a time against all
        p, q = a[s : s + 256, None], b[s : s + 256, None]
        hit = (side(p, q, a[None]) * side(p, q, b[None]) <= 0) & (side(a[None], b[None], p) * side(a[None], b[None], q) <= 0)
        box = np.ones_like(hit)
        for k in (0, 1):
            box &= (np.minimum(p[..., k], q[..., k]) <= np.maximum(a[None, :, k], b[None, :, k])) & (np.maximum(p[..., k], q[..., k]) >= np.minimum(a[None, :, k], b[None, :, k]))
        i, j = np.nonzero(hit & box)
        apart = (i + s - j) % n
        if ((apart > 1) & (apart < n - 1)).any():
            return True
    return False


def ring_faults(polygons: DataFrame) -> DataFrame:
    """``polygons`` with ``fault``: ``points`` (a ring of fewer than three different points), ``area`` (an outline without area),
    ``crossing`` (a ring that meets itself), null where all rings are sound. Count it by slide to report, filter it to reject."""
    schema = polygons.withColumn("fault", F.lit(None).cast("string")).schema

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            faults = []
            for rings in batch["rings"]:
                found = None
                for k, r in enumerate(rings):
                    ring = np.array([list(p)[:2] for p in r], float).reshape(-1, 2)
                    if len(ring) > 1 and (ring[0] == ring[-1]).all():
                        ring = ring[:-1]
                    ring = ring[(ring != np.roll(ring, 1, axis=0)).any(1)] if len(ring) > 1 else ring
                    x, y = ring.T
                    if len(np.unique(ring, axis=0)) < 3:
                        found = "points"
                    elif k == 0 and x @ np.roll(y, -1) == y @ np.roll(x, -1):
                        found = "area"
                    elif _crosses(ring):
                        found = "crossing"
                    if found:
                        break
                faults.append(found)
            yield batch.assign(fault=faults)

    return polygons.mapInPandas(check, schema)


_SIDES = ("left", "top", "right", "bottom")
_SCALE = [f"{c}_{a}" for c in ("tile_extent", "stride") for a in ("x", "y")]
_PARTS = (0.0, 0.25)


def _met(shapes: DataFrame, tiles: DataFrame, slides: DataFrame, more: list[str]) -> DataFrame:
    """Shapes and tiles side by side: a row of ``shapes`` for each block of ``UNITED`` by ``UNITED`` grid places that its box touches, and one (with ``tiles``) for each column of a block that has tiles on the grid.

    ``first`` and ``last`` are the grid places whose tile meets the open box; sides are in the slide's tiling level. ``tiles.places`` has a bit for each
    place of the column, so that the tiles of a slide are a few rows, not thousands.
    """
    info = slides.select(F.col("id").alias("slide_id"), *_SCALE, "downsample").hint("shuffle_hash")  # a row for each slide; nothing else needs to be sorted by it
    boxed = shapes.join(info, "slide_id").withColumns({c: F.col(c) / F.col("downsample") for c in _SIDES})
    placed = tiles.select(*KEY).join(info, "slide_id")
    for a, low, high in (("x", "left", "right"), ("y", "top", "bottom")):
        stride = F.col(f"stride_{a}")
        boxed = boxed.withColumn(f"first_{a}", F.greatest(F.lit(0), F.floor((F.col(low) - F.col(f"tile_extent_{a}")) / stride) + 1).cast("int")).withColumn(f"last_{a}", (F.ceil(F.col(high) / stride) - 1).cast("int"))
        boxed = boxed.filter(F.col(f"last_{a}") >= F.col(f"first_{a}")).withColumn(f"b{a}", F.explode(F.sequence(*[F.floor(F.col(f"{k}_{a}") / UNITED).cast("int") for k in ("first", "last")])))
        place = F.ceil(F.col(a) / stride).cast("int")
        placed = placed.withColumn(f"first_{a}", place).filter((place >= 0) & ((place * stride).cast("int") == F.col(a))).withColumn(f"b{a}", F.floor(place / UNITED).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("first_y") % UNITED)
    columns = placed.groupBy(*_BLOCK, "first_x", *_SCALE).agg(F.bit_or(bit).alias("places"))
    column = F.struct("places", *_SCALE)
    column = column.cast(columns.select(column.alias("tiles")).schema["tiles"].dataType.simpleString())  # with fields that may be null, as in rows of shapes
    own = ["first_y", "last_x", "last_y", "class", *more]
    kinds = dict(boxed.select(*own).dtypes)
    no_tiles = F.lit(None).cast(columns.select(column.alias("tiles")).schema["tiles"].dataType).alias("tiles")
    shape_rows = boxed.select(*_BLOCK, "first_x", no_tiles, *own)
    return shape_rows.unionAll(columns.select(*_BLOCK, "first_x", column.alias("tiles"), *[F.lit(None).cast(kinds[c]).alias(c) for c in own]))


def _pairs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """(row of the shape, row in ``tiles``) wherever the box of a shape touches a tile, for the rows of some blocks, and the ``tiles`` that are touched, each once."""
    block = np.cumsum(starts(rows, _BLOCK)) - 1
    bx, by, first_x = (rows.column(c).to_numpy().astype(np.int64) for c in ("bx", "by", "first_x"))
    is_tile = rows.column("tiles").is_valid().to_numpy()
    column, shape = np.flatnonzero(is_tile), np.flatnonzero(~is_tile)
    known = block[column] * UNITED + first_x[column] % UNITED
    order = np.argsort(known)
    column, known = column[order], known[order]
    of = rows.column("tiles").combine_chunks().take(pa.array(column))
    places = of.field("places").to_numpy(zero_copy_only=False).astype(np.int64)
    first_y, last_x, last_y = (rows.column(c).take(pa.array(shape)).to_numpy().astype(np.int64) for c in ("first_y", "last_x", "last_y"))
    left, top = bx[shape] * UNITED, by[shape] * UNITED
    i, gx = ranges(np.maximum(first_x[shape], left), np.minimum(last_x, left + UNITED - 1) + 1)
    number = block[shape[i]] * UNITED + gx % UNITED
    at = np.searchsorted(known, number)
    there = np.r_[known, -1][at] == number
    i, at = i[there], at[there]
    j, gy = ranges(np.maximum(first_y, top)[i], np.minimum(last_y, top + UNITED - 1)[i] + 1)
    i, at = i[j], at[j]
    there = (places[at] >> gy % UNITED) & 1 == 1
    touched, tile = np.unique(at[there] * UNITED + gy[there] % UNITED, return_inverse=True)
    at = touched // UNITED
    row = column[at]
    grid = {"x": first_x[row], "y": by[row] * UNITED + touched % UNITED}
    of = {c: of.field(c).to_numpy(zero_copy_only=False)[at] for c in _SCALE}
    names = {a: pa.array(np.trunc(g * of[f"stride_{a}"].astype(float)).astype(np.int32)) for a, g in grid.items()} | {c: pa.array(of[c]) for c in _SCALE[:2]}
    return shape[i[there]], tile, pa.table({"slide_id": rows.column("slide_id").take(pa.array(row)), **names})


def _parts(tiles: pa.Table, tile: np.ndarray) -> list[np.ndarray]:
    """The whole of tiles and their central half, each as 4 x n: left, top, right, bottom."""
    x, y, w, h = (tiles.column(c).to_numpy().astype(float)[tile] for c in ("x", "y", *_SCALE[:2]))
    return [np.stack([x + w * part, y + h * part, x + w * (1 - part), y + h * (1 - part)]) for part in _PARTS]


def _unite(rows: pa.Table, tiles: pa.Table, shape: np.ndarray, tile: np.ndarray, own: list[np.ndarray], edges: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """``(*KEY, class, tile_extent_x, tile_extent_y, area, roi)`` of all shapes of a class together, from the pairs of shape and tile and their areas; ``edges`` gives (4 x m, pair) of some pairs."""
    kind = rows.column("class").combine_chunks().dictionary_encode().indices.fill_null(0).to_numpy().astype(np.int64)[shape]
    _, first, of = np.unique(kind * tiles.num_rows + tile, return_index=True, return_inverse=True)
    n, out = len(first), []
    for box, area in zip(_parts(tiles, tile[first]), own, strict=True):
        whole = (box[2] - box[0]) * (box[3] - box[1])
        most, several = np.zeros(n), np.bincount(of[area > 0], minlength=n) > 1
        np.maximum.at(most, of, area)
        open_ = several & (most < whole * (1 - 1e-12))  # a shape alone, or one that fills the box, is the union
        sides, pair = edges(np.flatnonzero(open_[of] & (area > 0)))
        found = union_areas(sides, pair, of[pair], box)
        out.append(np.where(open_, np.maximum(found, most), np.minimum(most, whole)))
    names = ["slide_id", "x", "y", *_SCALE[:2]]
    at = pa.array(tile[first])
    return pa.Table.from_arrays([*[tiles.column(c).take(at) for c in names], rows.column("class").take(pa.array(shape[first])), *[pa.array(v) for v in out]], [*names, "class", "area", "roi"])


def _unite_boxes(rows: pa.Table) -> pa.Table:
    shape, tile, tiles = _pairs(rows)
    side = np.stack([rows.column(c).take(pa.array(shape)).to_numpy().astype(float) for c in _SIDES])
    cut = [(np.maximum(side[:2], box[:2]), np.minimum(side[2:], box[2:])) for box in _parts(tiles, tile)]
    own = [np.maximum(0.0, high - low).prod(0) for low, high in cut]

    def edges(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, top, right, bottom = side[:, pairs]
        return np.stack([np.stack([left, y, right, y]) for y in (top, bottom)], 2).reshape(4, -1), np.repeat(pairs, 2)

    return _unite(rows, tiles, shape, tile, own, edges)


_BLOCK = ["slide_id", "bx", "by"]


def _shares(rows: DataFrame, unite: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Unite the shapes of each tile and class, as shares of the tile and of its central half."""
    united = in_groups(rows, _BLOCK, unite, "slide_id string, x int, y int, tile_extent_x int, tile_extent_y int, class string, area double, roi double", _TOGETHER)
    whole = F.col("tile_extent_x") * F.col("tile_extent_y")
    return united.filter("area > 0").select(*KEY, "class", F.round(F.col("area") / whole, 9).alias("tile_coverage"), F.round(4 * F.col("roi") / whole, 9).alias("roi_coverage"))


def rectangle_coverage(tiles: DataFrame, rectangles: DataFrame, slides: DataFrame) -> DataFrame:
    """``(slide_id, x, y, class, tile_coverage, roi_coverage)`` of axis-aligned rectangles ``(slide_id, class, left, top, right, bottom)`` at the slide's full resolution.

    The ROI is the central half of the tile. What several rectangles of a class cover counts once. Rectangles and tiles meet by
    blocks of ``UNITED`` by ``UNITED`` grid places, a rectangle once for each block its box touches; a task holds the shapes of one block, or of several small ones.
    Tiles off the slide's grid and those that nothing covers have no row. Repeated tiles count once; a null class or side covers nothing; no rectangles give no rows.
    """

    sound = F.col("class").isNotNull() & (F.col("left") < F.col("right")) & (F.col("top") < F.col("bottom"))
    return _shares(_met(rectangles.filter(sound).select("slide_id", "class", *_SIDES), tiles, slides, list(_SIDES)), _unite_boxes)


def _under(y: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Antiderivative of y cut to [low, high], above low."""
    cut = np.clip(y, low, high)
    return (cut - low) ** 2 / 2 + (high - low) * np.maximum(0.0, y - high)


def edge_areas(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, left: np.ndarray, top: np.ndarray, right: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """Signed area between each edge and the top of a rectangle, inside it: over a ring's edges they sum up to plus or minus the area of the ring in the rectangle."""
    dx = x1 - x0
    safe = np.where(dx == 0, 1.0, dx)
    xa, xb = np.clip(x0, left, right), np.clip(x1, left, right)
    ya, yb = y0 + (y1 - y0) * (xa - x0) / safe, y0 + (y1 - y0) * (xb - x0) / safe
    dy = yb - ya
    flat = np.abs(dy) < 1e-9
    mean = np.where(flat, np.clip((ya + yb) / 2, top, bottom) - top, (_under(yb, top, bottom) - _under(ya, top, bottom)) / np.where(flat, 1.0, dy))
    return np.where(dx == 0, 0.0, mean * (xb - xa))


def _points(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rings of each shape, points of each ring, 2 x n: x and y) of a column of rings; nulls hold nothing."""

    def split(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
        return pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()

    rings_of, rings = split(rings)
    points_of, points = split(rings)
    size, values = split(points)
    start = np.cumsum(size) - size
    values = values.to_numpy(zero_copy_only=False).astype(float)
    return rings_of, points_of, np.stack([values[start], values[start + 1]])


def _after(size: np.ndarray) -> np.ndarray:
    """The point that follows each in its closed ring."""
    start = np.cumsum(size) - size
    after = np.arange(size.sum()) + 1
    after[(start + size - 1)[size > 0]] = start[size > 0]
    return after


def _unite_polygons(rows: pa.Table) -> pa.Table:
    shape, tile, tiles = _pairs(rows)
    rings_of, points_of, xy = _points(rows.column("rings").combine_chunks())
    ring_row = np.repeat(np.arange(rows.num_rows), rings_of)
    row = np.repeat(ring_row, points_of)
    xy = xy / rows.column("downsample").combine_chunks().to_numpy(zero_copy_only=False).astype(float)[row]
    e = np.concatenate([xy, xy[:, _after(points_of)]])
    ring = np.repeat(np.arange(len(points_of)), points_of)
    outer = np.r_[True, np.diff(ring_row) != 0][: len(points_of)]
    size = np.bincount(row, minlength=rows.num_rows)
    end = np.cumsum(size)
    start, most = end - size, np.cumsum(size[shape])
    own = [np.zeros(len(shape)) for _ in _PARTS]
    boxes = _parts(tiles, tile)
    cuts = np.unique(np.r_[np.searchsorted(most, np.arange(0, most[-1] if len(most) else 0, _EDGES), side="left"), len(shape)])
    for s, t in zip(cuts[:-1], cuts[1:], strict=True):
        pair, k = ranges(start[shape[s:t]], end[shape[s:t]])
        pair += s
        new = np.flatnonzero(np.r_[True, (np.diff(pair) != 0) | (np.diff(ring[k]) != 0)][: len(pair)])
        for area, box in zip(own, boxes, strict=True):
            rings = np.add.reduceat(edge_areas(*e[:, k], *box[:, pair]), new) if len(new) else np.zeros(0)
            area += np.bincount(pair[new], np.abs(rings) * np.where(outer[ring[k[new]]], 1, -1), len(shape))
    own = [np.maximum(0.0, area) for area in own]

    def edges(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        large = size[shape[pairs]] > 32  # all edges of others are as good as those near the tile
        pair, k = ranges(start[shape[pairs[~large]]], end[shape[pairs[~large]]])
        found, of = [e[:, k]], [pairs[~large][pair]]
        for p in pairs[large]:
            i = shape[p]
            near = [edges_near(r, *boxes[0][:, p]) for r in np.split(xy[:, start[i] : end[i]].T, np.flatnonzero(np.diff(ring[start[i] : end[i]])) + 1)]
            found += near
            of += [np.full(n.shape[1], p) for n in near]
        return np.concatenate(found, 1), np.concatenate(of)

    return _unite(rows, tiles, shape, tile, own, edges)


def polygon_coverage(tiles: DataFrame, polygons: DataFrame, slides: DataFrame) -> DataFrame:
    """As :func:`rectangle_coverage`, for ``(slide_id, class, polygon, rings)`` with the outer ring first; holes are left out of their own polygon.

    A row is a shape: ``polygons`` is read once and never joined to itself, so its numbers may come out otherwise in another run. Rings go along
    to each block that the box touches. A polygon that is alone in a tile needs its area there only; where
    others of its class are, :func:`union_areas` sweeps over the edges near the tile. A ring that meets itself counts by how often it
    goes round where it is alone, and by even and odd among others.
    """
    outer = F.element_at("rings", 1)
    box = {"left": F.array_min(F.transform(outer, lambda p: p[0])), "right": F.array_max(F.transform(outer, lambda p: p[0])), "top": F.array_min(F.transform(outer, lambda p: p[1])), "bottom": F.array_max(F.transform(outer, lambda p: p[1]))}
    shapes = polygons.filter("class IS NOT NULL AND size(rings) > 0").select("slide_id", "class", "rings", *[v.alias(k) for k, v in box.items()])
    return _shares(_met(shapes, tiles, slides, ["rings", "downsample"]), _unite_polygons)


def _topmost_boxes(boxes: pa.Table) -> pa.Table:
    low, high, band = (boxes.column(c).to_numpy().astype(np.int64) for c in ("low", "high", "band"))
    of, row = ranges(np.maximum(low, band * BAND), np.minimum(high, band * BAND + BAND - 1) + 1)
    spans = boxes.select(["slide_id", "band", "class_index", "first", "last"]).take(pa.array(of))
    none = pa.array(np.zeros(len(of), np.int32))
    return _topmost(spans.append_column("cell_y", pa.array(row, pa.int32())).append_column("polygon", none).append_column("hole", none))


def rasterise_rectangles(rectangles: DataFrame, scale: float = 56.0) -> DataFrame:
    """``(slide_id, cell_x, cell_y, value)`` from ``(slide_id, class_index, left, top, right, bottom)``: the largest class index of a cell wins. A side that is null, or of no length, gives the one cell where it begins, or none; repeated rectangles change nothing.

    Rectangles meet by slide and band of ``BAND`` rows; cells are made of the runs that are seen at last, so that no task holds the cells of its rectangles."""
    begin = {c: F.floor(F.col(low) / scale).cast("int") for c, low in (("first", "left"), ("low", "top"))}
    end = {c: F.greatest(F.floor(F.col(low) / scale), F.ceil(F.col(high) / scale) - 1).cast("int") for c, low, high in (("last", "left", "right"), ("high", "top", "bottom"))}
    least, kind = -(2**63), rectangles.schema["class_index"].dataType
    sides = rectangles.select("slide_id", F.coalesce(F.col("class_index").cast("long"), F.lit(least)).alias("class_index"), *[v.alias(k) for k, v in (begin | end).items()]).dropna(subset=list(begin | end))
    banded = sides.withColumn("band", F.explode(F.sequence(F.floor(F.col("low") / BAND).cast("int"), F.floor(F.col("high") / BAND).cast("int"))))
    runs = in_groups(banded, ["slide_id", "band"], _topmost_boxes, "slide_id string, cell_y int, first int, last int, value long")
    return _cells(runs).withColumn("value", F.when(F.col("value") != least, F.col("value")).cast(kind))


def _cells(runs: DataFrame) -> DataFrame:
    return runs.select("slide_id", F.explode(F.sequence("first", "last")).alias("cell_x"), "cell_y", "value")


def _spans(size: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ring, row, first, last) of the cells whose centre lies inside each ring, for all rows of all rings at once; ``a`` has the points (n x 2) of rings of these sizes."""
    b, ring = a[_after(size)], np.repeat(np.arange(len(size)), size)
    low, high = np.minimum(a[:, 1], b[:, 1]), np.maximum(a[:, 1], b[:, 1])
    edge, row = ranges(np.ceil(low - 0.5).astype(np.int64), np.ceil(high - 0.5).astype(np.int64))  # rows whose middle is in [low, high)
    y = row + 0.5
    x = a[edge, 0] + (y - a[edge, 1]) * (b[edge, 0] - a[edge, 0]) / (b[edge, 1] - a[edge, 1])
    order = np.lexsort((x, row, ring[edge]))  # a ring meets a line an even number of times: from a crossing to the next is inside
    ring, row, x = ring[edge][order][::2], row[order][::2], x[order]
    first, last = np.ceil(x[::2] - 0.5).astype(np.int64), np.ceil(x[1::2] - 0.5).astype(np.int64) - 1
    some = last >= first
    return ring[some], row[some], first[some], last[some]


def _topmost(spans: pa.Table) -> pa.Table:
    """Of the spans of some slides and bands of rows the runs of cells with one value, where the span drawn last is seen."""
    names = ["slide_id", "cell_y", "first", "last", "value"]
    value_type = spans.schema.field("class_index").type
    if not spans.num_rows:
        return pa.table({c: pa.array([], t) for c, t in zip(names, (pa.string(), pa.int32(), pa.int32(), pa.int32(), value_type), strict=True)})
    band = np.cumsum(starts(spans, ["slide_id", "band"])) - 1
    row, first, last = (spans.column(c).to_numpy().astype(np.int64) for c in ("cell_y", "first", "last"))
    drawn = np.lexsort(tuple(spans.column(c).to_numpy() for c in ("hole", "polygon", "class_index")))
    rank = np.empty(len(drawn), np.int64)
    rank[drawn] = np.arange(len(drawn))
    # Between two neighbouring ends of spans in a row nothing changes; each span covers a range of these pieces.
    line = band * BAND + row % BAND
    lines, ends = np.tile(line, 2), np.r_[first, last + 1]
    order = np.lexsort((ends, lines))
    new = np.r_[True, (np.diff(lines[order]) != 0) | (np.diff(ends[order]) != 0)]
    place = np.empty(len(ends), np.int64)
    place[order] = np.cumsum(new) - 1
    source = order[new] % len(row)
    at, of = ends[order][new], lines[order][new]
    span, piece = ranges(place[: len(row)], place[len(row) :])
    top = np.full(len(at), -1)
    np.maximum.at(top, piece, rank[span])
    held = np.flatnonzero(top >= 0)
    value = np.where(spans.column("hole").to_numpy() == 1, NO_CLASS, spans.column("class_index").to_numpy())[drawn][top[held]]
    begin, end, of = at[held], at[held + 1], of[held]
    joint = np.r_[False, (of[1:] == of[:-1]) & (begin[1:] == end[:-1]) & (value[1:] == value[:-1])]
    s = np.flatnonzero(~joint)
    e = np.r_[s[1:], len(end)] - 1
    from_ = source[held][s]
    slide = spans.column("slide_id").take(pa.array(from_))
    return pa.Table.from_arrays([slide, *[pa.array(v, pa.int32()) for v in (row[from_], begin[s], end[e] - 1)], pa.array(value[s], value_type)], names)


def label_runs(polygons: DataFrame, scale: float = 1.0) -> DataFrame:
    """``(slide_id, cell_y, first, last, value)``: runs of cells of one value in a row, whose centres polygons hold.

    Classes are drawn by index, then by polygon, later over earlier; a hole sets its cells to ``NO_CLASS`` even over another
    class. Spans meet by slide and band of ``BAND`` rows, as spans: no cell is made. A shape without points, or of no
    height or width, has none; a null class or polygon is drawn first; equal shapes draw the same. No polygons give no rows.
    """
    names = ["slide_id", "class_index", "polygon", "hole", "cell_y", "first", "last"]

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings_of, points_of, xy = _points(batch.column("rings"))
            of = np.repeat(np.arange(len(rings_of)), rings_of)
            hole = np.minimum(np.arange(len(of)) - np.repeat(np.cumsum(rings_of) - rings_of, rings_of), 1)
            ring, *columns = _spans(points_of, xy.T / scale)
            own = pa.array(of[ring])
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(own) for c in names[:3]], pa.array(hole[ring], pa.int32()), *[pa.array(c, pa.int32()) for c in columns]], names)

    rows = polygons.select("slide_id", F.coalesce("class_index", F.lit(-1)).cast("int").alias("class_index"), F.coalesce("polygon", F.lit(-1)).cast("long").alias("polygon"), "rings")
    drawn = rows.mapInArrow(spans, "slide_id string, class_index int, polygon long, hole int, cell_y int, first int, last int")
    return in_groups(drawn.withColumn("band", F.floor(F.col("cell_y") / BAND).cast("int")), ["slide_id", "band"], _topmost, "slide_id string, cell_y int, first int, last int, value int")


def rasterise_labels(polygons: DataFrame, scale: float = 1.0) -> DataFrame:
    """:func:`label_runs` as cells ``(slide_id, cell_x, cell_y, value)``, each once."""
    return _cells(label_runs(polygons, scale))


def _summed(grid: np.ndarray) -> np.ndarray:
    """Summed-area table with a first row and column of zeros."""
    return np.pad(grid.cumsum(0).cumsum(1), ((1, 0), (1, 0)))


def _corners(table: np.ndarray, x: np.ndarray, y: np.ndarray, w: int, h: int) -> np.ndarray:
    return table[x + w, y + h] - table[x, y + h] - table[x + w, y] + table[x, y]


def _read_windows(rows: pa.Table) -> pa.Table:
    """Coverage of the windows that begin in some blocks, from four corners of a block's summed-area table each; ``at_x, at_y`` is where a window begins, or a cell."""
    begin = np.flatnonzero(starts(rows, _MASK_BLOCK))
    at = np.stack([rows.column(c).to_numpy() for c in ("at_x", "at_y")]).astype(np.int64)
    size, side, block = (np.stack([rows.column(f"{c}{a}").to_numpy() for a in "xy"]).astype(np.int64) for c in ("w", "side_", "b"))
    is_window = rows.column("window").to_numpy()
    at -= block * side
    found = np.zeros((2, rows.num_rows))
    for s, e in zip(begin, np.r_[begin[1:], rows.num_rows], strict=True):
        windows = s + np.flatnonzero(is_window[s:e])
        if not len(windows):
            continue
        (w, h), (x, y) = size[:, s], at[:, windows]
        cells = at[:, s:e][:, ~is_window[s:e]]
        end = x.max() + w, y.max() + h  # as far as windows reach
        cells = cells[:, (cells[0] < end[0]) & (cells[1] < end[1])]
        table = _summed(np.bincount(cells[0] * end[1] + cells[1], minlength=end[0] * end[1]).reshape(end))
        hw, hh = max(1, w // 2), max(1, h // 2)
        found[0, windows], found[1, windows] = _corners(table, x, y, w, h) / (w * h), _corners(table, x + w // 4, y + h // 4, hw, hh) / (hw * hh)
    out = rows.select([*KEY, "mask"]).append_column("tile_coverage", pa.array(found[0])).append_column("roi_coverage", pa.array(found[1]))
    return out.filter(pa.array(is_window))


_MASK_BLOCK = ["slide_id", "mask", "bx", "by"]


def mask_coverage(tiles: DataFrame, slides: DataFrame, sizes: DataFrame, cells: DataFrame) -> DataFrame:
    """``(slide_id, x, y, mask, tile_coverage, roi_coverage)``: share of a window's cells above 0, for each mask of the slide.

    Scale is mask size over slide extent, for each mask and axis. Windows are cut at the mask's edge but
    divided by their whole area. A block of the mask (``SIDE`` cells, or a window if that is larger) holds the windows that begin in it and the cells up to a
    window beyond it, so a window needs one block; there it reads four corners of a summed-area table. Tiles of slides without masks have no
    row; cells that repeat count as often, null cells never; repeated tiles stay repeated.
    """
    info = slides.select(F.col("id").alias("slide_id"), "extent_x", "extent_y", "tile_extent_x", "tile_extent_y").join(sizes, "slide_id")
    for a, m in (("x", "mask_w"), ("y", "mask_h")):
        info = info.withColumn(f"scale_{a}", F.col(m) / F.col(f"extent_{a}"))
        info = info.withColumn(f"w{a}", F.greatest(F.lit(1), half_even(F.col(f"tile_extent_{a}") * F.col(f"scale_{a}")).cast("int")))
        info = info.withColumn(f"side_{a}", F.greatest(F.lit(SIDE), F.col(f"w{a}")))
    info = info.select("slide_id", "mask", "mask_w", "mask_h", "scale_x", "scale_y", "wx", "wy", "side_x", "side_y")
    windows, lit = tiles.select(*KEY).join(info, "slide_id"), cells.filter("value > 0").join(info, ["slide_id", "mask"]).filter("cell_x BETWEEN 0 AND mask_w - 1 AND cell_y BETWEEN 0 AND mask_h - 1")
    for a in "xy":
        side, cell = F.col(f"side_{a}"), F.col(f"cell_{a}")
        windows = windows.withColumn(f"o{a}", half_even(F.col(a) * F.col(f"scale_{a}")).cast("int")).withColumn(f"b{a}", F.floor(F.col(f"o{a}") / side).cast("int"))
        lit = lit.withColumn(f"b{a}", F.explode(F.sequence(F.floor((cell - F.col(f"w{a}") + 1) / side).cast("int"), F.floor(cell / side).cast("int"))))
    sides = ["wx", "wy", "side_x", "side_y"]
    windows = windows.select(*_MASK_BLOCK, F.lit(True).alias("window"), "x", "y", F.col("ox").alias("at_x"), F.col("oy").alias("at_y"), *sides)
    lit = lit.select(*_MASK_BLOCK, F.lit(False).alias("window"), F.lit(None).cast("int").alias("x"), F.lit(None).cast("int").alias("y"), F.col("cell_x").alias("at_x"), F.col("cell_y").alias("at_y"), *sides)
    return in_groups(windows.unionAll(lit), _MASK_BLOCK, _read_windows, "slide_id string, x int, y int, mask string, tile_coverage double, roi_coverage double")


def mask_coverage_multi(coverage: DataFrame, masks: list[str]) -> DataFrame:
    """A pair of columns for each mask, from the long form; nulls where a tile has no row of a mask. Other masks and repeated rows (of which any is taken) add nothing; no rows give none."""
    wide = coverage.groupBy(*KEY).pivot("mask", masks).agg(F.first("tile_coverage").alias("t"), F.first("roi_coverage").alias("r"))
    return wide.select(*KEY, *[F.col(f"{m}_{k}").alias(f"{name}_{m}_coverage") for m in masks for k, name in (("t", "tile"), ("r", "roi"))])


def spread_lut(n: int) -> list[int]:
    """Class i of n -> half-even of 255 (i + 1) / n; all other values, 255 among them, -> 0."""
    return [round(255 * (i + 1) / n) if i < n else 0 for i in range(256)]


def remap_cells(cells: DataFrame, n: int) -> DataFrame:
    """Cell values mapped by :func:`spread_lut` for ``n`` classes; a null value stays null."""
    return cells.withColumn("value", F.element_at(F.array(*map(F.lit, spread_lut(n))), F.col("value") + 1))


def _gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor of whole numbers below 2**31, by at most 46 divisions."""
    pair = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(46)), pair, lambda acc, _: F.when(acc["b"] == 0, acc).otherwise(F.struct(acc["b"].alias("a"), (acc["a"] % F.nullif(acc["b"], F.lit(0))).alias("b"))))["a"].cast("int")


def _map_blocks(tiles: DataFrame, slides: DataFrame, columns: list[Column], names: list[str]) -> DataFrame:
    """Each tile once for each block of ``SIDE`` by ``SIDE`` map cells it touches, most often one: its range of cells there.

    A cell's sides are the gcd of the slide's stride and tile; a last strip of the extent that is narrower than a cell is left out.
    """
    sides = slides.select(F.col("id").alias("slide_id"), *[_gcd(F.col(f"stride_{a}"), F.col(f"tile_extent_{a}")).alias(f"_side_{a}") for a in "xy"], *[F.col(f"{c}_{a}").alias(f"_{c}_{a}") for c in ("tile_extent", "extent") for a in "xy"])
    out = tiles.select(*KEY, *[c.alias(n) for c, n in zip(columns, names, strict=True)]).join(sides.hint("shuffle_hash"), "slide_id")  # tiles are not sorted by slide: they are by block, afterwards
    for a in "xy":
        side = F.col(f"_side_{a}")
        first = F.greatest(F.lit(0), F.floor(F.col(a) / side)).cast("int")
        end = F.least(F.floor(F.col(a) / side) + F.col(f"_tile_extent_{a}") / side, F.floor(F.col(f"_extent_{a}") / side)).cast("int")
        out = out.withColumn(f"first_{a}", first).withColumn(f"end_{a}", end).filter(F.col(f"end_{a}") > F.col(f"first_{a}"))
    for a in "xy":
        out = out.withColumn(f"b{a}", F.explode(F.sequence(F.floor(F.col(f"first_{a}") / SIDE).cast("int"), F.floor((F.col(f"end_{a}") - 1) / SIDE).cast("int"))))
    return out.select("slide_id", "bx", "by", "first_x", "end_x", "first_y", "end_y", *names)


def _fused(rows: pa.Table, keys: tuple, names: list[str], side: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(cell_x, cell_y, sums of the columns) of a block's cells under a tile: a tile adds at its first corner and takes away behind its sides; running sums both ways give the cells."""
    corner = [int(k.as_py()) * side for k in keys[1:3]]
    at = [np.clip(rows.column(c).to_numpy() - corner[i], 0, side) for i, c in enumerate(("first_x", "first_y"))]
    to = [np.clip(rows.column(c).to_numpy() - corner[i], 0, side) for i, c in enumerate(("end_x", "end_y"))]

    def spread(v: np.ndarray) -> np.ndarray:
        d = np.zeros((side + 1, side + 1), v.dtype)
        for x, y, sign in ((at[0], at[1], 1), (to[0], at[1], -1), (at[0], to[1], -1), (to[0], to[1], 1)):
            np.add.at(d, (x, y), sign * v)
        return d.cumsum(0).cumsum(1)

    tiles = spread(np.ones(rows.num_rows, np.int64))
    x, y = np.nonzero(tiles[:side, :side] > 0)
    return x + corner[0], y + corner[1], [spread(rows.column(c).to_numpy())[x, y] for c in names]


#: Shares are added up as whole multiples of 2**-40: exact, whatever the order of tiles, and nothing is left over where they are taken away again.
_UNIT = 1 << 40


def _units(column: str) -> Column:
    return F.coalesce(F.round(F.nanvl(F.col(column).cast("double"), F.lit(0.0)) * _UNIT), F.lit(0)).cast("long")


def _present(column: str) -> Column:
    return (F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).cast("long")


def _cells_of(keys: tuple, x: np.ndarray, y: np.ndarray, **values: pa.Array) -> pa.Table:
    return pa.table({"slide_id": pa.array([keys[0].as_py()] * len(x), pa.string()), "cell_x": pa.array(x, pa.int32()), "cell_y": pa.array(y, pa.int32()), **values})


def vote_map(predictions: DataFrame, classes: list[str], slides: DataFrame) -> DataFrame:
    """Per cell the class whose summed probability is largest (first of equals), coded by :func:`spread_lut`; cells without a tile have no row.

    Probabilities count in units of 2**-40, null and NaN as 0; a cell whose sums are all 0 gets the first class. Repeated tiles vote as often. A tile is one row
    in the shuffle for each block of cells it touches, however many cells it has.
    """
    names, lut, side = [f"p{i}" for i in range(len(classes))], np.array(spread_lut(len(classes))), SIDE

    def fuse(keys: tuple, rows: pa.Table) -> pa.Table:
        x, y, sums = _fused(rows, keys, names, side)
        return _cells_of(keys, x, y, value=pa.array(lut[np.argmax(sums, 0)], pa.int32()))

    blocks = _map_blocks(predictions, slides, [_units(f"prob_{c}") for c in classes], names)
    return blocks.groupBy("slide_id", "bx", "by").applyInArrow(fuse, "slide_id string, cell_x int, cell_y int, value int")


def probability_map(predictions: DataFrame, classes: list[str], slides: DataFrame) -> DataFrame:
    """Per cell and class the mean probability of its tiles times 255, clipped and cut to a whole number; null and NaN are left out of the mean, which is null without others.

    Sums count in units of 2**-40 (half a unit above counts as reached), and cells have at most 2**15 tiles.
    """
    names, side = [f"{k}{i}" for i in range(len(classes)) for k in "pn"], SIDE

    def fuse(keys: tuple, rows: pa.Table) -> pa.Table:
        x, y, sums = _fused(rows, keys, names, side)
        levels = {}
        for c, total, n in zip(classes, sums[::2], sums[1::2], strict=True):
            some = np.maximum(n, 1)
            levels[f"map_{c}"] = pa.array(np.clip((255 * total + 128 * some) // (some * _UNIT), 0, 255), pa.int32(), mask=n == 0)
        return _cells_of(keys, x, y, **levels)

    blocks = _map_blocks(predictions, slides, [f(f"prob_{c}") for c in classes for f in (_units, _present)], names)
    return blocks.groupBy("slide_id", "bx", "by").applyInArrow(fuse, f"slide_id string, cell_x int, cell_y int, {', '.join(f'`map_{c}` int' for c in classes)}")


def scalar_map(tiles: DataFrame, column: str, slides: DataFrame) -> DataFrame:
    """Per cell the mean of a column over its tiles, to nine places; null and NaN are left out, and a cell without other values is null."""
    side = SIDE

    def fuse(keys: tuple, rows: pa.Table) -> pa.Table:
        x, y, (total, n) = _fused(rows, keys, ["v", "n"], side)
        return _cells_of(keys, x, y, value=pa.array(total / np.maximum(n, 1), pa.float64(), mask=n == 0))

    value = F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0))
    blocks = _map_blocks(tiles, slides, [value, _present(column)], ["v", "n"])
    cells = blocks.groupBy("slide_id", "bx", "by").applyInArrow(fuse, "slide_id string, cell_x int, cell_y int, value double")
    return cells.withColumn("value", F.round("value", 9))


def nearest_level(levels: DataFrame, target: float, doubled: DataFrame | None = None) -> DataFrame:
    """``(slide, level)``: the level whose mpp is nearest the target (the first of equals); twice the target for the slides in ``doubled``."""
    aim = F.lit(target)
    if doubled is not None:
        levels = levels.join(doubled.select("slide").distinct().withColumn("_double", F.lit(True)), "slide", "left")
        aim = F.when(F.col("_double"), 2 * target).otherwise(F.lit(target))
    return levels.withColumn("_far", F.abs(F.col("mpp") - aim)).groupBy("slide").agg(F.min_by("level", F.struct("_far", "level")).alias("level"))
