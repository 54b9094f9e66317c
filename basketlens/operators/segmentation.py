"""Customer segmentation (ops 44-47): k-means whose starts, of all k, share their scans.

Documented deviation: silhouette uses squared Euclidean distance (linear in the data) instead of the all-pairs Euclidean version (quadratic).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .features import modes
from .ml import PopulationStandardScaler

CID = "customer_id"
# Columns never used as clustering features.
NON_FEATURES = ("churn_label", "customer_id", "customer_profile")


def numeric_feature_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, T.NumericType)
            and not isinstance(f.dataType, T.BooleanType)]


def clustering_features(master: DataFrame, id_col: str = CID):
    """Op 44: numeric non-boolean feature columns scaled by population std (zero variance ->
    0), plus a ``features`` vector. Returns (frame with id + scaled columns + features,
    feature names, fitted scaler)."""
    names = numeric_feature_columns(master)
    scaler = PopulationStandardScaler(inputCols=names, outputCols=names).fit(master)
    keep = [id_col] if id_col in master.columns else []
    scaled = scaler.transform(master.select(*keep, *names))
    vec = VectorAssembler(inputCols=names, outputCol="features").transform(scaled)
    return vec, names, scaler


SEED_ROWS = 4096  # rows (by a hash of their features) among which starting centres are drawn


class Clustering:
    """Centres of one k-means run; ``transform`` adds ``cluster``, the nearest centre (ties:
    the lowest)."""

    def __init__(self, centres: np.ndarray, cost: float):
        self.centres, self.cost = centres, cost

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.centres)

        @F.pandas_udf("int")
        def nearest(x):
            import pandas as pd
            return pd.Series(_distances(np.stack(x.to_numpy()), shared.value).argmin(1) if len(x) else [], dtype="int32")
        return df.withColumn("cluster", nearest(vector_to_array("features")))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, rows x centres."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


BLOCK_ROWS = 2048  # rows of one block of a matrix


def blocks(features: DataFrame) -> DataFrame:
    """The ``features`` vectors as (rows, block): matrices of up to BLOCK_ROWS rows, so that a
    scan hands tasks bytes instead of vectors that are unpacked again in every iteration."""
    if features.columns == ["rows", "block"]:
        return features

    def pack(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                x = np.ascontiguousarray(part.column(0).flatten().to_numpy(), dtype="<f8")
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["rows", "block"])
    return features.select(vector_to_array("features").alias("x")).mapInArrow(pack, "rows int, block binary")


def _totals(features: DataFrame, cells: int, add) -> np.ndarray:
    """Sums over all rows of what ``add(x, out)`` puts into ``cells`` numbers: one job, one
    partial sum per task."""
    def count(batches):
        out = np.zeros(cells)
        for batch in batches:
            for rows, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                add(np.frombuffer(block.as_buffer(), "<f8").reshape(rows, -1), out)
        used = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(out[used])], ["cell", "v"])
    got = (blocks(features).mapInArrow(count, "cell long, v double")
           .groupBy("cell").agg(F.sum("v").alias("v")).toPandas())
    out = np.zeros(cells)
    out[got["cell"].to_numpy(np.int64)] = got["v"].to_numpy()
    return out


def _pass(features: DataFrame, runs: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every run (its centres) the rows, vector sums, sums of squared lengths and costs of
    its clusters, all from one scan: the centres of all runs are stacked into one matrix."""
    d = runs[0].shape[1]
    bounds = np.cumsum([0, *(len(r) for r in runs)])
    shared = features.sparkSession.sparkContext.broadcast(np.concatenate(runs))
    width = d + 3

    def add(x, out):
        at = np.arange(len(x))
        square = (x * x).sum(1)
        all_ = shared.value @ x.T  # _distances, with a run's centres as rows next to each other
        all_ *= -2
        all_ += square
        all_ += (shared.value * shared.value).sum(1)[:, None]
        np.maximum(all_, 0, out=all_)
        columns = np.column_stack([np.ones(len(x)), square, np.zeros(len(x)), x])
        for a, b in zip(bounds[:-1], bounds[1:]):
            near = all_[a:b].argmin(0)
            columns[:, 2] = all_[a + near, at]
            member = np.zeros((b - a, len(x)))
            member[near, at] = 1.0
            out[a * width:b * width] += (member @ columns).ravel()
    got = _totals(features, int(bounds[-1]) * width, add).reshape(-1, width)
    return [(g[:, 0], g[:, 3:], g[:, 1], g[:, 2]) for g in np.split(got, bounds[1:-1])]


def starting_centres(features: DataFrame, sizes: Sequence[int], seed: int) -> list[np.ndarray]:
    """One start per entry of ``sizes``: distance-weighted draws (k-means++) from SEED_ROWS
    rows, the first in the order of a seeded hash. The bound only limits where runs start."""
    values = vector_to_array("features")
    rows = (features.select(values.alias("x")).orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(SEED_ROWS).collect())
    x = np.array([r["x"] for r in rows], float)
    out = []
    for i, k in enumerate(sizes):
        rng = np.random.default_rng([seed, i])
        chosen = [int(rng.integers(len(x)))]
        near = _distances(x, x[chosen]).min(1)
        while len(chosen) < min(k, len(x)):
            share = near / near.sum() if near.sum() > 0 else None
            chosen.append(int(rng.choice(len(x), p=share)))
            near = np.minimum(near, _distances(x, x[chosen[-1:]])[:, 0])
        out.append(x[chosen])
    return out


def kmeans_runs(features: DataFrame, sizes: Sequence[int], seed: int = 42, max_iter: int = 300, tol: float = 1e-4) -> list[tuple]:
    """Lloyd's iterations of all runs together, one job per iteration: each scan of the rows
    updates every run that still moves. A run ends when its centres move by at most ``tol``
    times the mean variance (squared), or after ``max_iter`` scans; an empty cluster keeps its
    centre. Returns per run (centres, cost, rows, vector sums, squared lengths), costs and sums
    taken at the final centres in one last scan."""
    runs = starting_centres(features, sizes, seed)
    features = blocks(features).persist()
    try:
        return _iterated(features, runs, max_iter, tol)
    finally:
        features.unpersist()


def _iterated(features: DataFrame, runs: list[np.ndarray], max_iter: int, tol: float) -> list[tuple]:
    n, sums, squares, _ = _pass(features, [np.zeros((1, runs[0].shape[1]))])[0]
    variance = (squares[0] - (sums[0] ** 2).sum() / n[0]) / n[0] / runs[0].shape[1] if n[0] else 0.0
    moving = list(range(len(runs)))
    for _ in range(max_iter):
        if not moving:
            break
        still = []
        for i, (rows, sums, _, _) in zip(moving, _pass(features, [runs[i] for i in moving])):
            new = np.where(rows[:, None] > 0, sums / np.maximum(rows, 1)[:, None], runs[i])
            if ((new - runs[i]) ** 2).sum() > tol * variance:
                still.append(i)
            runs[i] = new
        moving = still
    return [(centres, float(cost.sum()), rows, sums, squares) for centres, (rows, sums, squares, cost) in zip(runs, _pass(features, runs))]


def train_kmeans(features: DataFrame, k: int, seed: int = 42, n_init: int = 10, max_iter: int = 300):
    """Op 46: best (lowest cost; ties -> first) of ``n_init`` starts, all updated in the same
    scans. Returns (:class:`Clustering`, labelled)."""
    runs = kmeans_runs(features, [k] * n_init, seed, max_iter)
    best = min(runs, key=lambda r: r[1])
    model = Clustering(best[0], best[1])
    return model, model.transform(features)


def total_sum_of_squares(features: DataFrame, names: Sequence[str]) -> float:
    row = features.agg(*[(F.var_pop(c) * F.count(F.lit(1))).alias(c) for c in names]).first()
    return float(sum((row[c] or 0.0) for c in names))


def silhouettes(features: DataFrame, clusterings: list[tuple]) -> list[float]:
    """Mean silhouette (squared Euclidean) of each clustering, from the sums of its clusters
    and one scan for all of them; a row alone in its cluster counts 0."""
    shared = features.sparkSession.sparkContext.broadcast(clusterings)

    def add(x, out):
        square = (x * x).sum(1)[:, None]
        for i, (centres, _, rows, sums, squares) in enumerate(shared.value):
            near = _distances(x, centres).argmin(1)
            total = squares + rows * square - 2 * x @ sums.T  # to all rows of each cluster
            own = rows[near]
            at = np.arange(len(x))
            a = np.maximum(total[at, near], 0) / np.maximum(own - 1, 1)
            others = np.where(rows > 0, total / np.maximum(rows, 1), np.inf)
            others[at, near] = np.inf
            b = others.min(1)
            top = np.maximum(a, b)
            good = (own > 1) & np.isfinite(b) & (top > 0)
            out[i] += np.where(good, (b - a) / np.where(good, top, 1), 0).sum()
    n = max(float(clusterings[0][2].sum()), 1.0)
    return (_totals(features, len(clusterings), add) / n).tolist()


def choose_k(features: DataFrame, names: Sequence[str], k_values: Sequence[int] = range(2, 11),
             seed: int = 42, n_init: int = 10) -> DataFrame:
    """Op 45: per k, inertia, silhouette (squared Euclidean) and Calinski-Harabasz, with the
    argmax k of each score flagged. All starts of all k share every scan of the rows."""
    spark = features.sparkSession
    k_values = [int(k) for k in k_values]
    tss = total_sum_of_squares(features, names)
    runs = kmeans_runs(features, [k for k in k_values for _ in range(n_init)], seed)
    best = [min(runs[i * n_init:(i + 1) * n_init], key=lambda r: r[1]) for i in range(len(k_values))]
    sil = silhouettes(features, best)
    n, rows = float(best[0][2].sum()), []
    for k, (_, w, *_), s in zip(k_values, best, sil):
        rows.append((k, w, s, ((tss - w) / (k - 1)) / (w / (n - k)) if w > 0 and n > k else 0.0))
    best_sil = max(rows, key=lambda r: (r[2], -r[0]))[0]
    best_ch = max(rows, key=lambda r: (r[3], -r[0]))[0]
    return spark.createDataFrame(
        [(k, w, s, c, k == best_sil, k == best_ch) for k, w, s, c in rows],
        "k int, inertia double, silhouette double, calinski_harabasz double, "
        "best_silhouette boolean, best_calinski_harabasz boolean")


def profile_clusters(df: DataFrame, cluster_col: str = "cluster", label: str = "churn_label") -> DataFrame:
    """Op 47: per cluster: cluster_size, churn_rate (0.0 without a label column), the mean of
    every numeric non-boolean column and the mode (ties -> smallest) of every other column."""
    fields = [f for f in df.schema.fields if f.name not in (cluster_col, label)]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)
               and not isinstance(f.dataType, T.BooleanType)]
    other = [f.name for f in fields if f.name not in numeric]
    rate = (F.avg(F.col(label).cast("double")) if label in df.columns else F.lit(0.0)).alias("churn_rate")
    main = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("cluster_size"), rate,
                                       *[F.avg(F.col(c).cast("double")).alias(c) for c in numeric])
    if not other:
        return main
    mo = modes(df, cluster_col, {c: c for c in other})
    out = main.join(mo, cluster_col, "left")
    return out.select(cluster_col, "cluster_size", "churn_rate", *numeric,
                      *[F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in other])
