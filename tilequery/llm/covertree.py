"""Embedding near-duplicates by a dual traversal of cover trees.

Unit vectors at cosine c are at distance sqrt(2 - 2c). A cover tree nests levels of
centres with halving radii; each node knows the distance of its farthest point. Two trees are walked
down together: a pair of nodes goes on only if their centres are no farther apart than the
threshold and both covering radii. What is left at the leaves is compared exactly.

A label of many vectors gets the top of its tree first: nodes whose centres come from a sample of at most about ``SAMPLE`` vectors.
Every vector is assigned to the node of the nearest centre, every node learns its covering radius, and a vector visits another
node only if it is no farther from the centre than radius and threshold together, as angles, which are a metric too. Nodes and visitors
are compared by trees of their own. Vectors without any clusters leave little to prune: then most visits remain.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import broadcast_if_small, components, discard, written

#: Vectors of one block; a tree is built for each block. Vectors of a label that its top is fitted on (expected), and nodes at most.
BLOCK, SAMPLE, NODES = 4096, 4096, 512
#: Radii halve from one that covers the unit sphere; below the last one points are leaves.
_RADII = [2.0 / 2**i for i in range(5)]
#: Slack for rounding in distances; pairs are decided on their cosine, not on these.
_SLACK = 1e-6


class CoverTree:
    """Levels of centres (row numbers), coarse to fine; the last level holds every point."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        n = len(points)
        self.centres: list[np.ndarray] = []
        self.parent: list[np.ndarray] = []
        group = np.zeros(n, np.int64)  # node of the level above that holds each point
        for level, radius in enumerate(_RADII):
            centres, parent, inside = [], [], np.full(n, -1)
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), n], strict=True):
                left = order[s:e]
                # The parent's own centre comes first, so that levels are nested.
                if level:
                    own = self.centres[-1][group[left[0]]]
                    left = np.r_[own, left[left != own]]
                while len(left):
                    c = left[0]
                    near = np.square(points[left] - points[c]).sum(1) <= radius * radius
                    near[0] = True
                    inside[left[near]] = len(centres)
                    centres.append(c)
                    parent.append(group[c] if level else 0)
                    left = left[~near]
            self.centres.append(np.array(centres))
            self.parent.append(np.array(parent))
            group = inside
        self.centres.append(np.arange(n))
        self.parent.append(group)
        self.reach = [np.zeros(n)]
        owner = group
        for level in range(len(_RADII) - 1, -1, -1):
            far = np.zeros(len(self.centres[level]))
            np.maximum.at(far, owner, np.sqrt(np.square(points - points[self.centres[level]][owner]).sum(1)))
            self.reach.insert(0, far)
            owner = self.parent[level][owner]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, np.square(x).sum(1)[:, None] + np.square(y).sum(1) - 2 * (x @ y.T)))


def _children(parent: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(parent, kind="stable")
    count = np.bincount(parent, minlength=n)
    return order, np.cumsum(count) - count, count


def close_pairs(a: CoverTree, b: CoverTree, distance: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs that may be within ``distance``; none within it is missing."""
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(len(a.centres)):
        if level:
            (oa, sa, ca), (ob, sb, cb) = _children(a.parent[level], len(a.centres[level - 1])), _children(b.parent[level], len(b.centres[level - 1]))
            many = ca[i] * cb[j]
            pair = np.repeat(np.arange(len(i)), many)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
            i, j = oa[sa[i[pair]] + k // cb[j[pair]]], ob[sb[j[pair]] + k % cb[j[pair]]]
        else:
            i, j = (x.ravel() for x in np.indices((len(a.centres[0]), len(b.centres[0]))))
        ra, rb, pa_, pb = a.reach[level], b.reach[level], a.points[a.centres[level]], b.points[b.centres[level]]
        keep = np.zeros(len(i), bool)
        if len(i) * 4 > len(pa_) * len(pb):
            for s in range(0, len(pa_), 1024):  # most pairs are there: in blocks of a dense product
                here = np.flatnonzero((i >= s) & (i < s + 1024))
                keep[here] = _distances(pa_[s : s + 1024], pb)[i[here] - s, j[here]] <= distance + _SLACK + ra[i[here]] + rb[j[here]]
        else:
            for s in range(0, len(i), 1 << 16):
                x, y = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                keep[s : s + (1 << 16)] = np.sqrt(np.square(pa_[x] - pb[y]).sum(1)) <= distance + _SLACK + ra[x] + rb[y]
        i, j = i[keep], j[keep]
    return i, j


def _links(x: np.ndarray, y: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows of ``x`` and ``y`` (each pair of ``x`` once where ``y`` is None)."""
    norm = [np.sqrt(np.square(v).sum(1, keepdims=True)) for v in ((x,) if y is None else (x, y))]
    ta = CoverTree(x / norm[0])
    tb = ta if y is None else CoverTree(y / norm[1])
    i, j = close_pairs(ta, tb, math.sqrt(max(0.0, 2 - 2 * cosine)))
    if y is None:
        i, j = i[i < j], j[i < j]
    other, size = (x, norm[0]) if y is None else (y, norm[1])
    keep = np.zeros(len(i), bool)
    for s in range(0, len(i), 1 << 16):
        p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
        keep[s : s + (1 << 16)] = (x[p] * other[q]).sum(1) / (norm[0][p, 0] * size[q, 0]) >= cosine
    return i[keep], j[keep]


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt(np.square(v).sum(1, keepdims=True))


def _angles(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(v) @ centres.T, -1.0, 1.0))


_GROUP = ["label", "dims"]


def top_nodes(one: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(label, dims, node, centre)``, written: for each label of more than ``BLOCK`` vectors the centres of a cover tree's level, from a sample."""
    many = sizes.filter(F.col("n") > BLOCK)
    taken = F.pmod(F.xxhash64(F.lit(5), "h1", "h2"), F.lit(1 << 20)) < F.ceil(F.lit(float(SAMPLE << 20)) / F.col("n"))
    sample = one.join(broadcast_if_small(many), _GROUP).filter(taken).select(*_GROUP, "n", "v")

    def centres(table: pa.Table) -> pa.Table:
        points = _unit(_matrix(table.column("v"), table.num_rows))
        tree = CoverTree(points)
        most = min(NODES, -(-2 * table.column("n")[0].as_py() // BLOCK))
        # The first level that has enough centres; any of them will do as nodes, since each node learns its own radius.
        level = next((k for k, c in enumerate(tree.centres) if len(c) >= most), len(tree.centres) - 1)
        own = points[tree.centres[level][:most]]
        return pa.table({c: table.column(c)[: len(own)] for c in _GROUP} | {"node": pa.array(range(len(own)), pa.int32()), "centre": pa.array(list(own), pa.list_(pa.float64()))})

    label = one.schema["label"].dataType.simpleString()
    return written(sample.groupBy(*_GROUP).applyInArrow(centres, f"label {label}, dims int, node int, centre array<double>"), "centres")


def _by_chunk(one: DataFrame, sizes: DataFrame, nodes: DataFrame, work, kind: str) -> DataFrame:
    """``work`` on about ``BLOCK`` vectors of a label and all of its nodes, for labels that have nodes."""
    chunks = sizes.filter(F.col("n") > BLOCK).select(*_GROUP, F.ceil(F.col("n") / BLOCK).alias("chunks"))
    rows = one.join(broadcast_if_small(chunks), _GROUP).withColumn("chunk", F.pmod(F.xxhash64("h1"), F.col("chunks")))
    spread = nodes.join(broadcast_if_small(chunks), _GROUP).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    key = [*_GROUP, "chunk"]
    return rows.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(work, kind)


def visits(one: DataFrame, sizes: DataFrame, cosine: float) -> DataFrame:
    """``(label, dims, node, resident, h1, h2)``, written: for each vector its own node, and those of higher number that may hold a linked vector."""
    nodes = top_nodes(one, sizes)
    limit = math.acos(min(1.0, max(-1.0, cosine))) + 1e-6
    label = one.schema["label"].dataType.simpleString()
    kind = f"label {label}, dims int, node int, resident boolean, h1 long, h2 long"

    def sorted_nodes(table: pa.Table) -> pa.Table:
        return table.sort_by("node")

    def assign(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        nodes = sorted_nodes(nodes)
        angle = _angles(_matrix(rows.column("v"), rows.num_rows), _matrix(nodes.column("centre"), nodes.num_rows))
        near = angle.argmin(1)
        return pa.table({**{c: rows.column(c) for c in _GROUP}, "node": pa.array(near.astype(np.int32)), "angle": angle.min(1), "h1": rows.column("h1"), "h2": rows.column("h2")})

    assigned = written(_by_chunk(one, sizes, nodes, assign, f"label {label}, dims int, node int, angle double, h1 long, h2 long"), "assigned")
    reach = assigned.groupBy(*_GROUP, "node").agg(F.max("angle").alias("reach"))
    reached = written(nodes.join(reach, [*_GROUP, "node"]), "nodes")

    def visit(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        nodes = sorted_nodes(nodes)
        number, reach = nodes.column("node").to_numpy(), nodes.column("reach").to_numpy()
        angle = _angles(_matrix(rows.column("v"), rows.num_rows), _matrix(nodes.column("centre"), nodes.num_rows))
        own = number[angle.argmin(1)]  # the nearest centre of all has a vector, this one at least
        i, j = np.nonzero((angle <= reach + limit) & (number > own[:, None]))
        i, node = np.r_[np.arange(rows.num_rows), i], np.r_[own, number[j]]
        resident = np.arange(len(i)) < rows.num_rows
        return pa.table({**{c: rows.column(c).take(pa.array(i)) for c in _GROUP}, "node": pa.array(node.astype(np.int32)), "resident": pa.array(resident), "h1": rows.column("h1").take(pa.array(i)), "h2": rows.column("h2").take(pa.array(i))})

    found = _by_chunk(one, sizes, reached, visit, kind)
    few = one.join(broadcast_if_small(sizes.filter(F.col("n") <= BLOCK).select(*_GROUP)), _GROUP, "left_semi").select(*_GROUP, F.lit(0).alias("node"), F.lit(True).alias("resident"), "h1", "h2")
    out = written(found.unionByName(few), "visits")
    discard(nodes, assigned, reached)
    return out


def near_duplicates(df: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row.

    Vectors of one label (not null) and one length link where their cosine reaches the threshold. Null and zero vectors,
    those with null or non-finite components and those with a null id link with nothing; a
    null id has no component and is not kept. Equal vectors of a label are compared once and counted as often as they occur (they
    are told by 128 bits of hash). Rows that repeat an id share a component. Other columns play no part; an empty table gives no rows.

    Each node's vectors are dealt into blocks of about ``BLOCK``, its visitors too; pairs of blocks send on counts and a
    spanning forest of their links, not the links.
    """
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    sound = F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf')) AND exists(v, x -> x <> 0)")
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    keyed = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v"), "dims": F.size("v")})
    key = [*_GROUP, "h1", "h2"]
    first = keyed.filter("sound").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    one = keyed.filter("sound").join(first, key).filter("vec_id = rep").dropDuplicates(key).select(*key, "rep", "m", "v")
    one = written(one, "distinct")
    sizes = written(one.groupBy(*_GROUP).agg(F.count("*").alias("n")), "sizes")
    seen = visits(one, sizes, cosine)

    per = [*_GROUP, "node"]
    plan = seen.groupBy(*per).agg(F.ceil(F.count_if("resident") / BLOCK).alias("own"), F.ceil(F.count_if(~F.col("resident")) / BLOCK).alias("others"))
    dealt = seen.join(broadcast_if_small(plan), per)
    resident = dealt.filter("resident").withColumn("b", F.pmod(F.xxhash64("h2"), F.col("own")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("own") + F.col("others") - 1))
    resident = resident.withColumn("c", other).withColumn("i", F.when(F.col("c") < F.col("own"), F.least("b", "c")).otherwise(F.col("b"))).withColumn("j", F.when(F.col("c") < F.col("own"), F.greatest("b", "c")).otherwise(F.col("c")))
    visitor = dealt.filter("NOT resident").withColumn("b", F.col("own") + F.pmod(F.xxhash64("h2"), F.col("others")))
    visitor = visitor.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("own") - 1))).withColumn("j", F.col("b"))
    jobs = resident.select(*per, "i", "j", "b", "h1", "h2").unionByName(visitor.select(*per, "i", "j", "b", "h1", "h2")).join(one, key)

    def compare(table: pa.Table) -> pa.Table:
        rep, m, block = (table.column(c).to_numpy() for c in ("rep", "m", "b"))
        v = _matrix(table.column("v"), len(rep))
        first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        x, y = np.flatnonzero(block == first), np.flatnonzero(block == second)
        if not len(x) or not len(y):
            p = q = np.zeros(0, np.int64)
        else:
            p, q = _links(v[x], None if first == second else v[y], cosine)
            p, q = x[p], y[q]
        n = np.bincount(p, m[q], len(rep)) + np.bincount(q, m[p], len(rep))
        root = list(range(len(rep)))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for s, t in zip(p.tolist(), q.tolist(), strict=True):
            s, t = find(s), find(t)
            if s != t:
                root[max(s, t, key=lambda k: rep[k])] = min(s, t, key=lambda k: rep[k])
        some = np.flatnonzero(n > 0)
        roots = rep[np.array([find(k) for k in some.tolist()], np.int64)]
        return pa.table({**{c: table.column(c).take(pa.array(some)) for c in key}, "rep": pa.array(rep[some]), "n": pa.array(n[some].astype(np.int64)), "root": pa.array(roots)})

    names = {c: one.schema[c].dataType.simpleString() for c in [*key, "rep"]}
    kind = ", ".join(f"{c} {t}" for c, t in names.items()) + f", n long, root {names['rep']}"
    found = written(jobs.groupBy(*per, "i", "j").applyInArrow(compare, kind), "found")
    discard(seen)
    links = found.groupBy(*key).agg(F.sum("n").alias("n"))
    same = keyed.filter("sound").join(first, key).filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    reached = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(same))
    result = first.join(links, key, "left").select(*key, (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    out = keyed.select("vec_id", *[F.when(F.col("sound"), F.col(c)).alias(c) for c in key]).join(result, key, "left").join(reached, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))


def op5_cover_tree(spark, sf_dir: str) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``, cosine 0.93 within labels; edge rows as in :func:`near_duplicates`."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: Brute force over all pairs, for the sizes of the SQL check.
OP5_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v,
    label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS sound FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM (SELECT * FROM e WHERE sound) a JOIN (SELECT * FROM e WHERE sound) b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  AND list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT vec_id AS id, vec_id AS reached FROM e UNION SELECT r.id, l.b FROM r JOIN l ON r.reached = l.a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id)::BIGINT AS n_links, m.component_id, coalesce(m.component_id = e.vec_id, false) AS kept
FROM e LEFT JOIN (SELECT id, min(reached) AS component_id FROM r GROUP BY id) m ON m.id = e.vec_id
"""
