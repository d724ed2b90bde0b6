"""Training sets, linear probe and its metrics."""

from __future__ import annotations

import math
import time
from collections import deque
from collections.abc import Callable, Generator, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilequery.functions.columns import file_name

from .tiles import eligible_samples, join_embeddings, map_class_index, on_tissue, select_folds


def training_set(vectors: DataFrame, meta: DataFrame, classes: list[str], thresholds: dict[str, float], least: float = 0.0, include: list[int] | None = None, exclude: list[int] | None = None) -> DataFrame:
    """Eligible rows of the chosen folds with vector and class index ``target``."""
    rows = select_folds(eligible_samples(meta, thresholds, least), include, exclude)
    return map_class_index(join_embeddings(rows, vectors), classes)


def prediction_set(vectors: DataFrame, tissue: DataFrame, floor: float = 0.0) -> DataFrame:
    """Tiles above the tissue floor with their vector; ``target`` is -1 throughout. Tiles without a vector go."""
    return join_embeddings(on_tissue(tissue, floor=floor), vectors).withColumn("target", F.lit(-1))


def class_weights(df: DataFrame, n_classes: int) -> DataFrame:
    """``(target, n, weight)``: N / (K * max(n, 1)) for every class. Null targets and those beyond the classes count in N only; an empty table gives null weights."""
    grid = df.sparkSession.range(0, n_classes, 1, 1).select(F.col("id").cast("int").alias("target"))
    counts = df.groupBy("target").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    out = grid.join(F.broadcast(counts), "target", "left").fillna(0, ["n"]).crossJoin(F.broadcast(total))
    return out.select("target", "n", (F.col("total") / (n_classes * F.greatest("n", F.lit(1)))).alias("weight"))


def fit_linear_probe(train: DataFrame, weight_decay: float, n_classes: int, max_iter: int = 100, tolerance: float = 1e-6):
    """Multinomial logistic regression with balanced class weights; the penalty leaves intercepts alone."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    weights = class_weights(train, n_classes).select(F.col("target").alias("_t"), F.col("weight"))
    rows = train.join(F.broadcast(weights), F.col("target") == F.col("_t"))
    rows = rows.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.col("target").cast("double").alias("label"), "weight")
    return LogisticRegression(family="multinomial", regParam=weight_decay, elasticNetParam=0.0, standardization=False, weightCol="weight", maxIter=max_iter, tol=tolerance).fit(rows)


def predict_probe(model, df: DataFrame, classes: list[str]) -> DataFrame:
    """``slide_id, x, y, target, pred, prob_<class>``; classes behind the largest label seen have probability 0, of equals the first is predicted. A null vector raises; repeated rows stay repeated; no rows give none."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    out = model.transform(df.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>"))))
    return predictions_table(out.withColumn("probs", vector_to_array("probability")).withColumn("pred", F.col("prediction").cast("int")), classes, model.numClasses)


def predictions_table(df: DataFrame, classes: list[str], n: int) -> DataFrame:
    """Wide columns from ``probs``, named by class, or by number where the names do not fit."""
    names = [f"prob_{c}" for c in classes] if len(classes) >= n else [f"prob_{i}" for i in range(n)]
    return df.select("slide_id", "x", "y", "target", "pred", *[(F.col("probs")[i] if i < n else F.lit(0.0)).alias(c) for i, c in enumerate(names)])


def confusion_matrix(df: DataFrame, n_classes: int) -> DataFrame:
    """``(target, pred, n, share)`` of all K x K cells; shares are of the row, 0 in an empty row. Pairs with a null or another class are in no cell, but a null prediction counts in its row's share."""
    k = df.sparkSession.range(0, n_classes, 1, 1)
    grid = k.select(F.col("id").cast("int").alias("target")).withColumn("pred", F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))))
    counts = df.groupBy("target", "pred").agg(F.count("*").alias("n"))
    rows = df.groupBy("target").agg(F.count("*").alias("all"))
    out = grid.join(F.broadcast(counts), ["target", "pred"], "left").join(F.broadcast(rows), "target", "left").fillna(0, ["n", "all"])
    return out.select("target", "pred", "n", F.when(F.col("all") > 0, F.col("n") / F.col("all")).otherwise(0.0).alias("share"))


def per_class_metrics(df: DataFrame, n_classes: int) -> DataFrame:
    """``(class_index, accuracy, f1, support, predicted)``; accuracy is recall. Pairs with a null or another class play no part; a class without any has zeros."""
    m = confusion_matrix(df, n_classes)
    hit = F.sum(F.when(F.col("target") == F.col("pred"), F.col("n")).otherwise(0))
    rows = m.groupBy("target").agg(hit.alias("tp"), F.sum("n").alias("support"))
    columns = m.groupBy("pred").agg(F.sum("n").alias("predicted"))
    both = rows.join(columns, F.col("target") == F.col("pred"))
    f1 = F.when(F.col("support") + F.col("predicted") > 0, 2 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(0.0)
    return both.select(F.col("target").alias("class_index"), F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0).alias("accuracy"), f1.alias("f1"), "support", "predicted")


def macro_metrics(df: DataFrame, n_classes: int) -> DataFrame:
    """Means over the classes that have a target or a prediction."""
    return per_class_metrics(df, n_classes).filter("support + predicted > 0").agg(F.round(F.avg("accuracy"), 9).alias("macro_accuracy"), F.round(F.avg("f1"), 9).alias("macro_f1"))


def slide_accuracy(df: DataFrame, slides: DataFrame | None = None) -> DataFrame:
    """``(slide_id, accuracy, n[, file])``: share of right predictions, rows without target or prediction left out of the share."""
    out = df.groupBy("slide_id").agg(F.avg((F.col("pred") == F.col("target")).cast("double")).alias("accuracy"), F.count("*").alias("n"))
    return out if slides is None else out.join(slides.select(F.col("id").alias("slide_id"), file_name(F.col("path")).alias("file")), "slide_id", "left")


def slide_accuracy_summary(df: DataFrame) -> DataFrame:
    """Mean, median and least accuracy over slides; nulls for an empty table."""
    return slide_accuracy(df).agg(F.round(F.avg("accuracy"), 9).alias("mean"), F.round(F.median("accuracy"), 9).alias("median"), F.min("accuracy").alias("min"))


def weighted_log_loss(df: DataFrame, classes: list[str]) -> DataFrame:
    """Class-weighted cross-entropy over all rows: sum(w * loss) / sum(w). Rows without a target, or of another class, play no part; a probability of 0 or null leaves its loss out; an empty table gives null."""
    weights = class_weights(df, len(classes)).select(F.col("target").alias("_t"), "weight")
    p = F.element_at(F.array(*[F.col(f"prob_{c}") for c in classes]), F.col("target") + 1)
    rows = df.join(F.broadcast(weights), F.col("target") == F.col("_t"))
    return rows.agg(F.round(F.sum(F.col("weight") * -F.log(p)) / F.sum("weight"), 9).alias("loss"))


def _lbfgs(x: np.ndarray, max_iter: int, tolerance: float, memory: int = 10) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Minimise a smooth function: yields the points where it wants value and gradient, returns the best."""
    f, g = yield x
    steps: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=memory)
    for _ in range(max_iter):
        d = -g
        backward = []
        for s, y in reversed(steps):
            a = s @ d / (s @ y)
            d = d - a * y
            backward.append(a)
        if steps:
            s, y = steps[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(backward), strict=True):
            d = d + (a - y @ d / (s @ y)) * s
        slope, t = g @ d, 1.0 if steps else min(1.0, 1.0 / (np.abs(g).sum() + 1e-300))
        for _ in range(30):
            after, slopes = yield x + t * d
            if after <= f + 1e-4 * t * slope:
                break
            t /= 2
        else:
            return x
        s, y = t * d, slopes - g
        if s @ y > 1e-12 * (y @ y):
            steps.append((s, y))
        better = f - after
        x, f, g = x + s, after, slopes
        if better <= tolerance * max(abs(f), 1.0) and np.abs(g).max() < tolerance**0.5 or np.abs(g).max() < tolerance:
            return x
    return x


def _losses(rows: DataFrame, points: np.ndarray, held: np.ndarray, weights: np.ndarray, dim: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log losses of several linear models and their gradients, from one scan: model m leaves out fold ``held[m]``, and class weights are its own (``weights[m]``)."""
    m = len(points)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient = np.zeros(m), np.zeros((m, k, dim + 1))
        w = points.reshape(m * k, dim + 1)
        for b in batches:
            for s in range(0, b.num_rows, 2048):
                part = b.slice(s, 2048)
                n = part.num_rows
                x = np.ones((n, dim + 1))
                x[:, :dim] = part.column("embedding").flatten().to_numpy().reshape(n, dim)
                target, fold = part.column("target").to_numpy(), part.column("fold").to_numpy()
                z = (x @ w.T).reshape(n, m, k)
                z -= z.max(2, keepdims=True)
                p = np.exp(z)
                total = p.sum(2)
                p /= total[:, :, None]
                own = np.where(fold[:, None] != held[None], weights[:, target].T, 0.0)
                at = np.arange(n)
                loss += (own * (np.log(total) - z[at, :, target])).sum(0)
                p[at, :, target] -= 1.0
                gradient += ((p * own[:, :, None]).reshape(n, m * k).T @ x).reshape(m, k, dim + 1)
        yield pa.RecordBatch.from_arrays([pa.array([np.r_[loss, gradient.ravel()].tobytes()], pa.binary())], ["sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(m + m * k * (dim + 1))
        for b in batches:
            for s in b.column("sums").to_pylist():
                total += np.frombuffer(s)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = rows.mapInArrow(add, "sums binary")
    n = rows.rdd.getNumPartitions()
    if n > 64:  # so few results come to the driver that they fit there
        parts = parts.repartition(math.isqrt(n)).mapInArrow(merge, "sums binary")
    total = sum(np.frombuffer(r.sums) for r in parts.collect())
    return total[:m], total[m:].reshape(m, -1)


def fit_linear_probes(rows: DataFrame, weight_decays: list[float], folds: list[int], n_classes: int, max_iter: int = 50, tolerance: float = 1e-7) -> dict[tuple[float, int], np.ndarray]:
    """``{(weight decay, fold): coefficients and intercepts (classes x (size + 1))}``, each model fitted without its fold: the problem of :func:`fit_linear_probe`, all of them at once.

    The weights of all models stand side by side; each step scans ``rows`` (``fold``, ``target``, ``embedding``) once for all losses and gradients, and the models go their own ways from there.
    ``rows`` should be stored. Rows without fold, target or vector play no part; without any rows this raises.
    """
    rows = rows.select("fold", F.col("target").cast("int").alias("target"), F.col("embedding").cast("array<double>").alias("embedding")).dropna()
    counted = rows.groupBy("fold", "target").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).collect()  # folds times classes
    if not counted:
        raise ValueError("no rows to fit")
    dim = max(r.dim for r in counted)
    models = [(wd, k) for wd in weight_decays for k in folds]
    held = np.array([k for _, k in models])
    seen = np.array([[sum(r.n for r in counted if r.fold != k and r.target == c) for c in range(n_classes)] for k in held], float)
    sizes = seen.sum(1, keepdims=True)
    weights = sizes / (n_classes * np.maximum(seen, 1))
    norm = np.maximum((weights * seen).sum(1), 1e-300)
    going = {i: _lbfgs(np.zeros(n_classes * (dim + 1)), max_iter, tolerance) for i in range(len(models))}
    asked = {i: next(g) for i, g in going.items()}
    found: dict[tuple[float, int], np.ndarray] = {}
    while asked:
        some = list(asked)
        loss, gradient = _losses(rows, np.array([asked[i] for i in some]), held[some], weights[some], dim, n_classes)
        for i, f, g in zip(some, loss, gradient, strict=True):
            w = asked[i].reshape(n_classes, -1).copy()
            w[:, dim] = 0.0  # intercepts are not held back
            try:
                asked[i] = going[i].send((f / norm[i] + models[i][0] / 2 * (w**2).sum(), g / norm[i] + models[i][0] * w.ravel()))
            except StopIteration as done:
                found[models[i]] = done.value.reshape(n_classes, -1)
                del asked[i]
    return found


def predict_linear(rows: DataFrame, models: dict[tuple[float, int], np.ndarray]) -> DataFrame:
    """``(weight_decay, fold, target, pred)``: every row once for each model that its fold was kept from, in one scan; of equals the first class."""
    kinds = "weight_decay double, fold int, target int, pred int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fold, target = b.column("fold").to_numpy(), b.column("target").to_numpy()
            x = b.column("embedding").flatten().to_numpy().reshape(b.num_rows, -1)
            for (wd, k), w in models.items():
                own = fold == k
                pred = (x[own] @ w[:, :-1].T + w[:, -1]).argmax(1) if own.any() else np.zeros(0, int)
                n = int(own.sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, wd)), pa.array(np.full(n, k), pa.int32()), pa.array(target[own], pa.int32()), pa.array(pred, pa.int32())], ["weight_decay", "fold", "target", "pred"])

    sound = rows.select(F.col("fold").cast("int").alias("fold"), F.col("target").cast("int").alias("target"), F.col("embedding").cast("array<double>").alias("embedding")).dropna()
    return sound.mapInArrow(run, kinds)


def cross_validate(df: DataFrame, classes: list[str], weight_decays: list[float], folds: list[int], max_iter: int = 50) -> DataFrame:
    """``(weight_decay, fold, macro_accuracy, macro_f1)``: each fold once held out, for each weight decay. The rows are stored while all models are fitted, side by side, and judged in one scan."""
    rows = df.select("fold", "target", "embedding").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = fit_linear_probes(rows, weight_decays, folds, len(classes), max_iter)
        counts = predict_linear(rows, models).groupBy("weight_decay", "fold", "target", "pred").agg(F.count("*").alias("n")).collect()  # models times classes squared
    finally:
        rows.unpersist()
    out = []
    for wd, k in models:
        m = np.zeros((len(classes), len(classes)))
        for r in counts:
            if (r.weight_decay, r.fold) == (wd, k):
                m[r.target, r.pred] = r.n
        hit, support, predicted = np.diag(m), m.sum(1), m.sum(0)
        some = support + predicted > 0
        accuracy, f1 = hit / np.maximum(support, 1), 2 * hit / np.maximum(support + predicted, 1)
        out.append((float(wd), int(k), *(round(float(v[some].mean()), 9) if some.any() else None for v in (accuracy, f1))))
    return df.sparkSession.createDataFrame(out, "weight_decay double, fold int, macro_accuracy double, macro_f1 double")


def choose_weight_decay(results: DataFrame) -> DataFrame:
    """Results of ``cross_validate`` with ``mean_f1`` over the folds and ``chosen``: the weight decay of the largest mean, the smaller of equals."""
    means = results.groupBy("weight_decay").agg(F.round(F.avg("macro_f1"), 9).alias("mean_f1"))
    best = means.agg(F.max(F.struct("mean_f1", -F.col("weight_decay"))).alias("best")).select((-F.col("best.col2")).alias("best"))
    return results.join(F.broadcast(means), "weight_decay").join(F.broadcast(best)).withColumn("chosen", F.col("weight_decay") == F.col("best")).drop("best")


#: Functions that a worker has set up, by name: they outlive a task.
_SET_UP: dict[str, Callable[[pd.DataFrame], list]] = {}


def embed_tiles(
    df: DataFrame, fn: Callable[[pd.DataFrame], list] | None = None, drop: str = "tile", attempts: int = 6, pause: Callable[[float], None] = time.sleep,
    in_flight: int = 8, rows_per_call: int = 16, setup: Callable[[], Callable[[pd.DataFrame], list]] | None = None, name: str = "model",
) -> DataFrame:
    """``df`` without the input column and with ``embedding`` from ``fn``, which gets ``rows_per_call`` rows and returns as many vectors.

    A task keeps up to ``in_flight`` calls open side by side, also across Arrow batches, and gives rows out in their order, a batch at a time: a frame for each call would take far longer to send back than a small call. A call that fails is made again
    for each of its rows; a row's call is tried ``attempts`` times, after min(60, 2**attempt) seconds each time, and then raises. Instead of ``fn``, ``setup`` makes the function once in each worker
    process, which keeps it under ``name`` (a client, a loaded model). A null input is handed over as it is; no rows make no calls.
    """
    if (fn is None) == (setup is None):
        raise ValueError("give fn or setup")
    kept = [f for f in df.schema if f.name != drop]
    schema = T.StructType([*kept, T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if setup is not None and name not in _SET_UP:
            _SET_UP[name] = setup()
        call = fn or _SET_UP[name]

        def one(row: pd.DataFrame, tried: int) -> list:
            for attempt in range(tried, attempts):
                if attempt:
                    pause(min(60, 2 ** (attempt - 1)))
                try:
                    return list(call(row))
                except Exception:
                    if attempt == attempts - 1:
                        raise
            raise ValueError("attempts must be positive")

        def some(rows: pd.DataFrame) -> list:
            try:
                vectors = list(call(rows))
                if len(vectors) != len(rows):
                    raise ValueError(f"{len(vectors)} vectors for {len(rows)} rows")
            except Exception:
                if attempts == 1 and len(rows) == 1:
                    raise
                vectors = [v for i in range(len(rows)) for v in one(rows.iloc[i : i + 1], int(len(rows) == 1))]
            return vectors

        def whole(batch: pd.DataFrame, vectors: list) -> pd.DataFrame:
            return batch[[f.name for f in kept]].assign(embedding=vectors)

        with ThreadPoolExecutor(in_flight) as pool:
            calls: deque[Future] = deque()
            waiting: deque[tuple[pd.DataFrame, list]] = deque()  # batches with calls still open, and the vectors so far

            def take() -> Iterator[pd.DataFrame]:
                batch, vectors = waiting[0]
                vectors += calls.popleft().result()
                if len(vectors) == len(batch):
                    waiting.popleft()
                    yield whole(batch, vectors)

            for batch in batches:
                if len(batch):
                    waiting.append((batch, []))
                for s in range(0, len(batch), rows_per_call):
                    if len(calls) == in_flight:
                        yield from take()
                    calls.append(pool.submit(some, batch.iloc[s : s + rows_per_call]))
            while calls:
                yield from take()

    return df.mapInPandas(run, schema)
