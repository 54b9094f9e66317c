"""Evaluation metrics against brute force over pairs and thresholds."""

import numpy as np
import pandas as pd
import pytest

from basketlens.operators import metrics as M


def _scored(spark, n=300, seed=4, ties=True):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    s = np.clip(rng.normal(0.35 + 0.3 * y, 0.2), 0, 1)
    if ties:
        s = np.round(s, 2)
    pdf = pd.DataFrame({"customer_id": np.arange(n), "label": y, "score": s})
    return spark.createDataFrame(pdf), pdf


def _pr_auc_bruteforce(y, s):
    order = np.unique(s)[::-1]
    P = y.sum()
    pts = [(0.0, 1.0)]
    for t in order:
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        fp = (pred & (y == 0)).sum()
        pts.append((tp / P, tp / (tp + fp)))
    area = 0.0
    for (r0, p0), (r1, p1) in zip(pts, pts[1:]):
        area += (r1 - r0) * (p0 + p1) / 2
    return area


def test_auc_against_pairs(spark):
    df, pdf = _scored(spark)
    r = M.classification_metrics(df).first()
    pos = pdf[pdf.label == 1].score.to_numpy()
    neg = pdf[pdf.label == 0].score.to_numpy()
    diff = pos[:, None] - neg[None, :]
    auc = ((diff > 0).sum() + 0.5 * (diff == 0).sum()) / diff.size
    assert r["roc_auc"] == pytest.approx(auc)
    assert r["pr_auc"] == pytest.approx(_pr_auc_bruteforce(pdf.label.to_numpy(), pdf.score.to_numpy()))
    pred = pdf.score >= 0.5
    tp = int((pred & (pdf.label == 1)).sum())
    assert r["tp"] == tp and r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(pdf)


def test_mixed_top_block_pr_auc(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.2, 1), (0.1, 0)], "score double, label int")
    r = M.auc_scores(df).first()
    y, s = np.array([1, 0, 1, 0]), np.array([0.9, 0.9, 0.2, 0.1])
    assert r["pr_auc"] == pytest.approx(_pr_auc_bruteforce(y, s))


def test_threshold_curve_bruteforce(spark):
    df, pdf = _scored(spark, 400, 9)
    curve = M.threshold_curve(df).toPandas().sort_values("threshold").reset_index(drop=True)
    grid = np.arange(0.05, 0.96, 0.01)
    assert len(curve) == 91 and (curve["threshold"].to_numpy() == grid).all()
    y = pdf.label.to_numpy()
    for i, t in enumerate(grid):
        pred = pdf.score.to_numpy() >= t
        tp = (pred & (y == 1)).sum()
        fp = (pred & (y == 0)).sum()
        fn = (~pred & (y == 1)).sum()
        tn = (~pred & (y == 0)).sum()
        prec = tp / (tp + fp) if tp + fp else 0.0
        rec = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        assert curve.loc[i, "precision"] == pytest.approx(prec)
        assert curve.loc[i, "recall"] == pytest.approx(rec)
        assert curve.loc[i, "f1"] == pytest.approx(f1)
        assert curve.loc[i, "balanced_accuracy"] == pytest.approx((rec + tn / (tn + fp)) / 2)
    best = M.optimal_threshold(M.threshold_curve(df)).first()
    assert best["optimal_threshold"] == grid[int(np.argmax(curve["f1"].to_numpy()))]


def test_score_exactly_half_is_negative_at_grid_point(spark):
    df = spark.createDataFrame([(0.5, 1)], "score double, label int")
    curve = M.threshold_curve(df).toPandas().sort_values("threshold")
    row = curve[curve.threshold == np.arange(0.05, 0.96, 0.01)[45]].iloc[0]
    assert row["recall"] == 0.0


def test_compare_models_sorted(spark):
    df, pdf = _scored(spark)
    from pyspark.sql import functions as F
    both = df.withColumn("model_name", F.lit("a")).unionByName(
        df.withColumn("score", 1 - F.col("score")).withColumn("model_name", F.lit("b")))
    rows = M.compare_models(both).collect()
    assert [r["model_name"] for r in rows] == ["a", "b"]
    assert rows[0]["roc_auc"] == pytest.approx(1 - rows[1]["roc_auc"])


def test_forecast_accuracy_rules(spark):
    a = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, 20.0), (4, 5.0)], "t int, actual double")
    p = spark.createDataFrame([(1, 0.0), (2, 12.0), (3, 15.0), (9, 1.0)], "t int, predicted double")
    r = M.forecast_accuracy(a, p, ["t"]).first()
    act, pred = np.array([0.0, 10.0, 20.0]), np.array([0.0, 12.0, 15.0])
    assert r["mae"] == pytest.approx(np.mean(np.abs(act - pred)))
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean((act - pred) ** 2)))
    assert r["mape"] == pytest.approx(np.mean([2 / 10, 5 / 20]) * 100)
    assert r["smape"] == pytest.approx(np.mean([2 * 2 / 22, 2 * 5 / 35]) * 100)
    ss_res = ((act - pred) ** 2).sum()
    ss_tot = ((act - act.mean()) ** 2).sum()
    assert r["r2"] == pytest.approx(1 - ss_res / ss_tot)
    none = M.forecast_accuracy(a, p.where("t > 100"), ["t"]).first()
    assert none["n"] == 0 and none["mae"] == 0.0 and none["r2"] == 0.0


def test_bands_and_summary(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.3), (3, 0.6), (4, 0.61), (5, 0.5)],
                               "customer_id long, churn_probability double")
    b = {r["customer_id"]: (r["risk_level"], r["churn_prediction"]) for r in M.score_bands(df).collect()}
    assert b == {1: ("Low", 0), 2: ("Medium", 0), 3: ("Medium", 1), 4: ("High", 1), 5: ("Medium", 1)}
    s = M.band_summary(M.score_bands(df)).first()
    assert (s["total"], s["high_risk"], s["medium_risk"], s["low_risk"]) == (5, 1, 3, 1)


def test_quality_gates(spark):
    auc = spark.createDataFrame([(0.74,)], "roc_auc double")
    mape = spark.createDataFrame([(25.0,)], "mape double")
    got = {r["gate"]: r["status"] for r in M.quality_gates(auc, mape).collect()}
    assert got == {"churn_roc_auc": "WARNING", "forecast_mape": "PASS"}
