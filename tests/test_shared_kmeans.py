"""Shared scans against separate plain runs and against the library's own scores."""

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler

from basketlens.operators import segmentation as SG


def blobs(spark, n=300, seed=2):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.6, (n // 3, 2)) for c in ((0, 0), (5, 1), (2, 6))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double").repartition(4)
    return x, VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def plain(x, centres, tol, max_iter=300):
    for _ in range(max_iter):
        near = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
        new = np.array([x[near == k].mean(0) if (near == k).any() else c for k, c in enumerate(centres)])
        done = ((new - centres) ** 2).sum() <= tol
        centres = new
        if done:
            break
    return centres, ((x[:, None] - centres) ** 2).sum(2).min(1).sum()


def test_runs_that_share_scans_equal_separate_runs(spark):
    x, df = blobs(spark)
    sizes = [2, 3, 3, 5]
    got = SG.kmeans_runs(df, sizes, seed=7)
    for start, (centres, cost, rows, sums, squares) in zip(SG.starting_centres(df, sizes, 7), got):
        want, least = plain(x, start, 1e-4 * x.var(0).mean())
        assert np.allclose(centres, want) and abs(cost - least) < 1e-6
        assert rows.sum() == len(x) and np.allclose(sums.sum(0), x.sum(0)) and abs(squares.sum() - (x ** 2).sum()) < 1e-6


def test_one_job_per_iteration(spark, monkeypatch):
    _, df = blobs(spark)
    scans, real = [], SG._pass
    monkeypatch.setattr(SG, "_pass", lambda f, runs: scans.append(len(runs)) or real(f, runs))
    SG.kmeans_runs(df, [k for k in range(2, 6) for _ in range(4)])
    assert max(scans) == 16 and len(scans) < 60


def test_scores_equal_the_librarys(spark):
    x, df = blobs(spark)
    model, labelled = SG.train_kmeans(df, 3, n_init=3)
    own = SG.choose_k(df, ["a", "b"], [2, 3, 4], n_init=3).toPandas().set_index("k")
    assert own.loc[3, "best_silhouette"] and own.loc[3, "best_calinski_harabasz"] and abs(own.loc[3, "inertia"] - model.cost) < 1e-6
    want = ClusteringEvaluator(predictionCol="cluster").evaluate(labelled)
    assert abs(own.loc[3, "silhouette"] - want) < 1e-9


def test_fewer_rows_than_clusters_and_equal_rows(spark):
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "a double"))
    model, labelled = SG.train_kmeans(df, 2, n_init=2)
    assert model.cost == 0 and len({r["cluster"] for r in labelled.collect()}) == 2
    assert SG.train_kmeans(df, 5, n_init=1)[0].cost == 0
