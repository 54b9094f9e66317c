"""Leaf-wise boosting against a plain version that tries every split of every leaf in turn."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from basketlens.operators import boosting as B

NAMES = ["a", "b", "c"]


def table(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n).round(2), rng.integers(0, 5, n), rng.normal(size=n).round(1)], 1)
    y = ((x[:, 0] * x[:, 1] > 0.5) | (x[:, 2] > 1.2)).astype(float)
    return x, y, rng.integers(1, 3, n).astype(float)


def frame(spark, x, y, w):
    rows = [(*map(float, r), float(t), float(v)) for r, t, v in zip(x, y, w)]
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, c double, label double, weight double").repartition(4))


def plain_boosting(x, y, w, edges, trees, leaves, depth, lam, step):
    """Margins of rows: one split at a time, the leaf of the highest gain first."""
    share = (w * y).sum() / w.sum()
    margin = np.full(len(y), math.log(share / (1 - share)))
    shapes = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        score = lambda m: g[m].sum() ** 2 / (h[m].sum() + lam)
        parts, used = [(np.ones(len(y), bool), 0)], []
        while len(parts) < leaves:
            best = None
            for k, (m, d) in enumerate(parts):
                for f in range(x.shape[1]) if d < depth else ():
                    for e in edges[f]:
                        left = m & (x[:, f] <= e)
                        right = m & ~left
                        if left.any() and right.any() and min(h[left].sum(), h[right].sum()) >= 1e-3:
                            gain = 0.5 * (score(left) + score(right) - score(m))
                            if gain > 0 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, k, left, right, f, e)
            if best is None:
                break
            _, k, left, right, f, e = best
            d = parts.pop(k)[1]
            parts += [(left, d + 1), (right, d + 1)]
            used.append((f, round(float(e), 6)))
        shapes.append(sorted(used))
        for m, _ in parts:
            margin[m] += -step * g[m].sum() / (h[m].sum() + lam)
    return margin, shapes


@pytest.mark.parametrize("leaves,depth", [(4, 5), (7, 3), (2, 1)])
def test_trees_equal_splitting_one_by_one(spark, monkeypatch, leaves, depth):
    monkeypatch.setattr(B, "KEEP_TREES", 2)
    x, y, w = table()
    df = frame(spark, x, y, w)
    model = B.LeafwiseBoostedClassifier(weightCol="weight", maxIter=5, numLeaves=leaves, maxDepth=depth, maxBins=16, stepSize=0.3).fit(df)
    probs = F.array(*[F.lit(k / 16) for k in range(1, 16)])
    cut = df.agg(*[F.percentile_approx(c, probs, 10_000).alias(c) for c in NAMES]).first()
    edges = [np.unique([e for e in cut[c] if e < x[:, i].max()]) for i, c in enumerate(NAMES)]
    margin, shapes = plain_boosting(x, y, w, edges, 5, leaves, depth, 1.0, 0.3)
    _, _, trees = model.parsed
    assert [sorted((f, round(t, 6)) for f, t in zip(tree.feature, tree.threshold) if f >= 0) for tree in trees] == shapes
    got = {tuple(r["features"].toArray()): r["rawPrediction"][1] for r in model.transform(df).collect()}
    assert max(abs(got[tuple(r)] - m) for r, m in zip(x, margin)) < 1e-9


def test_model_is_saved_and_read_in_a_pipeline(spark, tmp_dir):
    x, y, w = table(200)
    df = frame(spark, x, y, w).drop("features")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), B.LeafwiseBoostedClassifier(maxIter=3, subsamplingRate=0.7)]).fit(df)
    fitted.write().overwrite().save(f"{tmp_dir}/m")
    again = PipelineModel.load(f"{tmp_dir}/m")
    score = lambda m: sorted((r["a"], r["b"], r["c"], tuple(r["probability"])) for r in m.transform(df).collect())
    assert score(again) == score(fitted)
    assert abs(sum(fitted.stages[-1].featureImportances) - 1) < 1e-9


def test_one_label_and_no_rows(spark):
    x, y, w = table(50)
    model = B.LeafwiseBoostedClassifier(maxIter=3).fit(frame(spark, x, y * 0, w))
    assert max(r["probability"][1] for r in model.transform(frame(spark, x, y, w)).collect()) < 1e-3
    with pytest.raises(ValueError, match="no rows"):
        B.LeafwiseBoostedClassifier().fit(frame(spark, x, y, w).where("a > 1000"))


def test_columns_of_bins_give_the_margins_of_rows():
    tree = B.Tree()
    left, right = tree.split(0, 1, 3, 0.0, 1.0)
    tree.split(right, 0, 5, 0.0, 1.0)
    tree.value = [0.0, -1.5, 0.0, 2.25, 0.1]
    x = np.random.default_rng(1).integers(0, 9, (500, 3)).astype(np.int8)
    columns = np.ascontiguousarray(x.T)
    assert (tree.margin_of_bins(columns) == tree.margin(x, True)).all()
    assert (B.Tree(value=[0.5]).margin_of_bins(columns) == 0.5).all() and left == 1


def test_a_pass_counts_all_nodes_of_a_feature_at_once(spark, monkeypatch):
    """Sums by node, feature and bin are those of a plain loop, and no pass counts per node."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (300, 2)).astype(np.int8)
    y, w, margin = rng.integers(0, 2, 300).astype(float), rng.integers(1, 3, 300).astype(float), rng.normal(size=300)
    rows = spark.createDataFrame([(bytearray(r.tobytes()), a, b, i, c) for i, (r, a, b, c) in enumerate(zip(x, y.tolist(), w.tolist(), margin.tolist()))],
                                 "bins binary, y double, w double, row long, margin double").repartition(3)
    paths = [[(0, 1, True)], [(0, 1, False), (1, 2, True)]]
    got = B.histograms(rows, [], paths, 2, 4, 1.0, 7)
    p = 1 / (1 + np.exp(-margin))
    inside = [x[:, 0] <= 1, (x[:, 0] > 1) & (x[:, 1] <= 2)]
    for k, here in enumerate(inside):
        for f in range(2):
            for b in range(4):
                use = here & (x[:, f] == b)
                assert np.allclose(got[k, f, b], [(w * (p - y))[use].sum(), (w * p * (1 - p))[use].sum(), use.sum()])


def test_families_share_one_preparation(spark, monkeypatch):
    from basketlens.operators import ml as ML
    rows = [(i, float(i % 7), "ab"[i % 2], i % 3 % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_id long, a double, c string, churn_label int")
    prep = ML.preprocessing_pipeline(["a"], ["c"]).fit(df)
    alone = ML.fit_churn_model(df, ["a"], ["c"], "logistic_regression")
    monkeypatch.setattr(ML, "preprocessing_stages", lambda *a: pytest.fail("prepared again"))
    shared = ML.fit_churn_model(df, ["a"], ["c"], "logistic_regression", prep=prep)
    score = lambda m: sorted(map(tuple, ML.score(m, df).collect()))
    assert score(shared) == score(alone)


def test_large_input_in_one_file_is_dealt_over_tasks(spark, monkeypatch):
    """Passes get tasks by the number of rows, not by the files that a shuffle left."""
    from basketlens.operators import ml as ML
    monkeypatch.setattr(B, "TASK_CELLS", 300)
    seen, histograms = [], B.histograms
    monkeypatch.setattr(B, "histograms", lambda rows, *a: seen.append(rows.inputFiles()) or histograms(rows, *a))
    x, y, w = table()
    df = frame(spark, x, y, w).coalesce(1)
    B.LeafwiseBoostedClassifier(weightCol="weight", maxIter=1, maxBins=16).fit(df)
    assert len(seen[0]) == 4
    monkeypatch.setattr(ML, "TASK_ROWS", 100)
    rows = spark.range(400).selectExpr("id as customer_id", "cast(id % 3 = 0 as int) as churn_label").coalesce(1)
    split = ML.written_split(rows)
    assert len(split.inputFiles()) == 4
    order = ["customer_id"]
    assert split.orderBy(order).collect() == ML.stratified_split(rows).orderBy(order).collect()
