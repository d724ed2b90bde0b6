"""Exact k-means over whole numbers; bounds tell which vectors need no look at their centroids.

A vector keeps an upper bound of the distance to its own centroid and a lower bound of that to all others. When centroids move, the
upper bound is measured anew and the lower bound is loosened by what a moved centroid can come nearer to any vector of the cluster. That is
less than its drift: vectors lie in a sphere around the cluster's old centroid, and seen from the middle of the move a sphere that lies off
its axis is approached only by a part of it. Vectors whose bounds then leave a doubt are scanned against all centroids in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded, discard, written

SIZE, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Largest component: sums of squares of differences stay exact.
_LARGEST = 1 << 26
#: Doubt about a bound: relative, and absolute for distances near 0.
_SLACK = 1e-9


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``(id, v array<int>)``: floor(scale * x) of vectors with ``size`` components, none null or non-finite; other vectors go. A component beyond 2**26 raises when it is read."""
    x = F.col(vector_col).cast("array<double>")
    sound = (F.size(x) == size) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = F.array_max(F.transform(x, lambda c: F.abs(c) * scale))
    whole = F.when(most < _LARGEST, F.transform(x, lambda c: F.floor(c * scale).cast("int"))).otherwise(F.raise_error(F.lit("component too large")).cast("array<int>"))
    return df.filter(F.coalesce(sound, F.lit(False))).select(F.col(id_col), whole.alias("v"))


def first_centroids(vectors: DataFrame, id_col: str, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of smallest sha256 of ``seed:id`` (ties by components; a null id reads as empty); fewer where there are fewer."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = vectors.select(order.alias("_order"), "v").orderBy("_order", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def approach(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """``[i, j]``: the most by which centroid j's move brings it nearer to a vector within ``radius[i]`` of the old centroid i.

    In the plane of centroid i, and of j before and after, vectors nearer to j by d after a move of length m lie inside the cone around
    the move, from its middle, whose half angle has the cosine d / m (it holds the branch of the hyperbola). The sphere is outside all
    cones narrower than its own least angle from the axis, so the approach is at most m times the cosine of that angle.
    """
    move = new - old
    length = np.sqrt((move**2).sum(1))
    middle = (old + new) / 2
    to = old[:, None] - middle[None]
    far = np.sqrt((to**2).sum(2))
    safe = np.where(far * length[None] > 0, far * length[None], 1.0)
    angle = np.arccos(np.clip((to * move[None]).sum(2) / safe, -1, 1))
    half = np.arcsin(np.clip(radius[:, None] / np.where(far > 0, far, 1.0), 0, 1))
    least = np.where(far > radius[:, None], np.maximum(0.0, angle - half - _SLACK), 0.0)
    return length[None] * np.maximum(0.0, np.cos(least))


def scan(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, its squared distance, that of the next one) in whole numbers; of equals the smaller number."""
    far = np.stack([((v - c) ** 2).sum(1) for c in centroids], 1)
    own = far.argmin(1)
    at = np.arange(len(v))
    least = far[at, own]
    far[at, own] = np.iinfo(np.int64).max
    return own, least, far.min(1) if len(centroids) > 1 else far[at, own]


def assign(v: np.ndarray, own: np.ndarray, low: np.ndarray, centroids: np.ndarray, loosened: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, lower bound of the others, whether scanned) after a move; ``loosened[i]`` is what cluster i's lower bounds lose."""
    least = ((v - centroids[own]) ** 2).sum(1)
    low = low - loosened[own]
    doubt = np.sqrt(least) * (1 + _SLACK) + _SLACK >= low * (1 - _SLACK)
    own, low = own.copy(), low.copy()
    if doubt.any():
        own[doubt], least[doubt], second = scan(v[doubt], centroids)
        low[doubt] = np.sqrt(second)
    return own, least, low, doubt


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(``(id, cluster, distance)`` of every sound vector, the final centroids, how many vectors each pass scanned).

    Each round assigns all vectors, then moves every centroid to the floor of its vectors' mean; one without vectors stays. Then vectors are
    assigned once more. ``distance`` is squared. Vectors that :func:`whole_vectors` drops have no row; repeated rows and ids count each;
    without a sound vector there are no rows and no centroids. Vectors never leave their task: a pass writes them with cluster and bound,
    and only counts, sums and radii of ``k`` clusters come to the driver.
    """
    spark = df.sparkSession
    vectors = written(bounded(whole_vectors(df, id_col, vector_col, size, scale)), "vectors")
    centroids = first_centroids(vectors, id_col, k, seed)
    kind = vectors.schema[id_col]
    state = T.StructType([kind, T.StructField("v", T.ArrayType(T.IntegerType())), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()), T.StructField("low", T.DoubleType()), T.StructField("scanned", T.BooleanType())])
    if not len(centroids):
        return spark.createDataFrame([], T.StructType([kind, *state.fields[2:4]])), centroids, []

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, least, second = scan(_matrix(b.column("v"), size), start)
            yield _rows(b, own, least, np.sqrt(second), np.ones(len(own), bool))

    def later(centroids: np.ndarray, loosened: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own, low = b.column("cluster").to_numpy(), b.column("low").to_numpy()
                yield _rows(b, *assign(_matrix(b.column("v"), size), own, low, centroids, loosened))

        return run

    def _rows(b: pa.RecordBatch, own: np.ndarray, least: np.ndarray, low: np.ndarray, doubt: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(id_col), b.column("v"), pa.array(own, pa.int32()), pa.array(least, pa.int64()), pa.array(low, pa.float64()), pa.array(doubt)], state.names)

    start = centroids
    now, scanned = written(vectors.mapInArrow(first, state), "clusters"), []
    discard(vectors)
    for _ in range(rounds):
        sums, radius, count = _sums(now, len(centroids), size)
        scanned.append(count)
        filled = sums[:, 0] > 0
        moved = centroids.copy()
        moved[filled] = sums[filled, 1:] // sums[filled, :1]
        by = approach(centroids.astype(float), moved.astype(float), radius)
        np.fill_diagonal(by, 0.0)
        last, now = now, written(now.mapInArrow(later(moved, by.max(1) * (1 + _SLACK) + _SLACK), state), "clusters")
        discard(last)
        centroids = moved
    scanned.append(now.filter("scanned").count())
    return now.select(id_col, "cluster", "distance"), centroids, scanned


def _sums(now: DataFrame, k: int, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows and sums of components of each cluster, its radius, scanned vectors): tasks add up, then Spark; k * (size + 1) rows come back."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of one task stay within 64 bits up to 2**37 rows; Spark adds them as decimals.
        total, radius, scanned = np.zeros((k, size + 1), np.int64), np.zeros(k, np.int64), 0
        for b in batches:
            own, v = b.column("cluster").to_numpy(), _matrix(b.column("v"), size)
            np.add.at(total, own, np.concatenate([np.ones((len(v), 1), np.int64), v], 1))
            np.maximum.at(radius, own, b.column("distance").to_numpy())
            scanned += int(b.column("scanned").to_numpy(zero_copy_only=False).sum())
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel()), pa.array(radius[i]), pa.array(np.where(i + j == 0, scanned, 0), pa.int64())], ["i", "j", "s", "r", "scanned"])

    parts = now.select("v", "cluster", "distance", "scanned").mapInArrow(add, "i int, j int, s long, r long, scanned long")
    rows = parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("r").alias("r"), F.sum("scanned").alias("n")).collect()
    sums, radius = np.zeros((k, size + 1), object), np.zeros(k)
    for r in rows:
        sums[r.i, r.j], radius[r.i] = int(r.s), np.sqrt(float(r.r)) * (1 + _SLACK)
    return sums, radius, sum(r.n for r in rows)


def digest(centroid: np.ndarray) -> str:
    """SHA-256 of the components as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def op13_clusters(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every kept vector of ``embeddings``."""
    rows, centroids, _ = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    names = F.array(*[F.lit(digest(c)) for c in centroids]) if len(centroids) else F.array().cast("array<string>")
    by = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    by = by.crossJoin(F.broadcast(by.agg(F.sum("cluster_inertia").alias("inertia"))))  # one row on the right
    out = rows.join(F.broadcast(by), "cluster")  # a row for each of at most CLUSTERS clusters
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.element_at(names, F.col("cluster") + 1).alias("centroid_sha256"))


def _lists(values: str, n: int = SIZE) -> str:
    return ", ".join(values.format(i=i) for i in range(1, n + 1))


def _sql() -> str:
    """k-means in SQL: each round a table of assignments and one of centroids."""
    far = "CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT)"
    mean = _lists("CAST((sum(v[{i}]) - ((sum(v[{i}]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)")
    steps = ["""x AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)""",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, v AS c FROM x ORDER BY sha256('1:' || vec_id) LIMIT 16)"]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min({{'d': d, 'k': k}}) AS b FROM (SELECT vec_id, v, k, {far} AS d FROM x, c{r}) GROUP BY vec_id)")
        if r < ROUNDS:
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(m, c) AS c FROM c{r} LEFT JOIN (SELECT b.k AS k, [{mean}] AS m FROM a{r} GROUP BY b.k) n ON n.k = c{r}.k)")
    return f"""WITH {", ".join(steps)}, o AS (SELECT vec_id, b.k AS k, b.d AS d FROM a{ROUNDS})
SELECT vec_id, CAST(o.k AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY o.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM o JOIN c{ROUNDS} ON o.k = c{ROUNDS}.k"""


OP13_SQL = _sql()
