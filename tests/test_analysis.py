"""Descriptive analysis and statistical tests against pandas / closed forms."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from basketlens.functions import stats as ST
from basketlens.operators import eda as E
from basketlens.operators import stattests as S


def test_column_profile_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": rng.exponential(3.0, 37).round(2), "c": [3.0] * 37,
                        "s": rng.choice(["a", "b", None], 37), "b": rng.random(37) < 0.5})
    pdf.loc[[2, 9], "x"] = np.nan
    df = E.column_profile(__import__("pyspark").sql.SparkSession.getActiveSession()
                          .createDataFrame(pdf.astype({"s": object}), "x double, c double, s string, b boolean"),
                          ["x", "c", "s", "b"])
    got = df.toPandas().set_index("column")
    x = pdf["x"]
    assert got.loc["x", "mean"] == pytest.approx(x.mean())
    assert got.loc["x", "median"] == pytest.approx(x.median())
    assert got.loc["x", "std"] == pytest.approx(x.std())
    assert got.loc["x", "skewness"] == pytest.approx(x.skew())
    assert got.loc["x", "kurtosis"] == pytest.approx(x.kurtosis())
    assert got.loc["x", "missing_pct"] == pytest.approx(x.isnull().mean() * 100)
    assert got.loc["x", "unique_count"] == x.nunique()
    assert got.loc["c", "skewness"] == 0.0 and got.loc["c", "kurtosis"] == 0.0
    assert pd.isna(got.loc["s", "mean"]) and got.loc["s", "unique_count"] == pdf["s"].nunique()
    assert pd.isna(got.loc["b", "mean"]) and got.loc["b", "unique_count"] == 2


def test_iqr_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 100.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = E.iqr_outliers(df, "v").first()
    s = pd.Series([v for v in vals if v is not None])
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    assert r["q1"] == q1 and r["q3"] == q3
    assert r["outlier_count"] == 1 and r["outlier_pct"] == pytest.approx(1 / 8)
    empty = E.iqr_outliers(spark.createDataFrame([(None,)], "v double"), "v").first()
    assert empty["outlier_count"] == 0 and empty["q1"] == 0.0


def test_cohort_retention_gap_and_period_zero(spark):
    cust = spark.createDataFrame(
        [(1, dt.datetime(2023, 1, 5)), (2, dt.datetime(2023, 1, 20)), (3, dt.datetime(2023, 3, 1)),
         (4, None)], "customer_id long, signup_date timestamp_ntz")
    tx = spark.createDataFrame(
        [(1, dt.datetime(2023, 3, 2)), (2, dt.datetime(2023, 3, 9)), (2, dt.datetime(2023, 4, 1)),
         (4, dt.datetime(2023, 1, 1))], "customer_id long, transaction_date timestamp_ntz")
    got = {(r[0], r[1]): r[2] for r in E.cohort_retention(cust, tx).collect()}
    # January cohort (2 customers): nobody in period 0, both in period 2, one in period 3
    assert got == {("2023-01", 0): 1.0, ("2023-01", 2): 1.0, ("2023-01", 3): 0.5}


def test_monthly_revenue_no_gap_fill(spark):
    tx = spark.createDataFrame(
        [(1, dt.datetime(2023, 1, 5), 2.0, 10.0, 0.5, 0), (2, dt.datetime(2023, 3, 5), 1.0, 4.0, 0.0, 1)],
        "customer_id long, transaction_date timestamp_ntz, quantity double, unit_price double, "
        "discount_pct double, return_flag int")
    rows = E.monthly_revenue(tx).collect()
    assert [r["year_month"] for r in rows] == ["2023-01", "2023-03"]
    assert rows[1]["total_revenue"] == 4.0 and rows[1]["return_adjusted_revenue"] == 0.0


def test_churn_summary_grouping_sets(spark):
    cust = spark.createDataFrame(
        [("a", "M", True, 1, 30.0), ("a", "F", False, 0, 50.0), ("b", "M", False, 1, 40.0)],
        "acquisition_channel string, gender string, is_premium boolean, churn_label int, age double")
    got = {(r["dimension"], r["level"]): r for r in E.churn_summary(cust).collect()}
    assert got[("all", "all")]["customers"] == 3 and got[("all", "all")]["churned"] == 2
    assert got[("acquisition_channel", "a")]["churn_rate"] == 0.5
    assert got[("is_premium", "true")]["churn_rate"] == 1.0
    assert got[("churn_label", "1")]["mean_age"] == 35.0


# ----------------------------------------------------------------- tail probabilities

def test_tail_probabilities_closed_forms():
    for x in (0.5, 2.0, 7.3, 20.0):
        assert ST.chi2_sf(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-12)
        assert ST.chi2_sf(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-12)
    assert ST.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert ST.norm_sf(1.959963984540054) == pytest.approx(0.025, rel=1e-12)
    assert ST.kolmogorov_sf(1.3580986393225505) == pytest.approx(0.05, abs=1e-6)
    assert ST.kolmogorov_sf(1.17) == pytest.approx(ST.kolmogorov_sf(1.19) +
                                                   (ST.kolmogorov_sf(1.17) - ST.kolmogorov_sf(1.19)))


def test_mann_whitney_hand_computed(spark):
    # premium: 1, 2, 2 ; others: 2, 3 -> pooled ranks 1, 3, 3, 3, 5; R1 = 7, U1 = 7 - 6 = 1
    df = spark.createDataFrame([(1.0, True), (2.0, True), (2.0, True), (2.0, False), (3.0, False)],
                               "v double, g boolean")
    s = S.mann_whitney_pvalue(S.mann_whitney_statistics(df, "v", "g")).first()
    assert s["statistic"] == 1.0 and s["n1"] == 3 and s["n2"] == 2
    assert s["tie_term"] == 24.0
    n1, n2, n = 3, 2, 5
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - 24 / (n * (n - 1))))
    z = (max(1.0, 6 - 1.0) - 3 - 0.5) / sigma
    assert s["p_value"] == pytest.approx(2 * ST.norm_sf(z))


def test_chi_square_2x2_yates_and_rxc(spark):
    rows = [("x", "p")] * 10 + [("x", "q")] * 20 + [("y", "p")] * 30 + [("y", "q")] * 5
    df = spark.createDataFrame(rows, "a string, b string")
    r = S.chi_square_test(df, "a", "b").first()
    obs = np.array([[10, 20], [30, 5]], dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    corr = (np.abs(obs - exp) - 0.5) ** 2 / exp
    assert r["dof"] == 1 and r["statistic"] == pytest.approx(corr.sum())
    assert r["p_value"] == pytest.approx(ST.chi2_sf(corr.sum(), 1))
    # 3 x 2 with an empty cell: plain chi-square over the full grid
    rows = [("x", "p")] * 4 + [("y", "p")] * 6 + [("y", "q")] * 7 + [("z", "q")] * 3
    r = S.chi_square_test(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    obs = np.array([[4, 0], [6, 7], [0, 3]], dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    chi = ((obs - exp) ** 2 / exp).sum()
    assert r["dof"] == 2 and r["statistic"] == pytest.approx(chi)
    assert r["cramers_v"] == pytest.approx(math.sqrt(chi / (obs.sum() * 1)))


def test_kruskal_wallis_hand_computed(spark):
    vals = {1: [1.0, 2.0, 2.0], 2: [3.0, 4.0], 3: [2.0, 5.0, 6.0]}
    df = spark.createDataFrame([(g, v) for g, vs in vals.items() for v in vs], "g int, v double")
    h = S.kruskal_wallis_statistics(df, "v", "g").first()
    allv = pd.Series([v for vs in vals.values() for v in vs])
    ranks = allv.rank()
    n = len(allv)
    idx = 0
    q = 0.0
    for vs in vals.values():
        r = ranks[idx: idx + len(vs)].sum()
        q += r * r / len(vs)
        idx += len(vs)
    hh = 12 / (n * (n + 1)) * q - 3 * (n + 1)
    t = allv.value_counts()
    hh /= 1 - ((t ** 3 - t).sum()) / (n ** 3 - n)
    assert h["statistic"] == pytest.approx(hh) and h["groups"] == 3


def test_drift_ks_and_categorical(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(0, 1, 200).round(3)
    b = rng.normal(0.5, 1, 150).round(3)
    ref = spark.createDataFrame([(float(x), "u" if x > 0 else "v") for x in a], "x double, c string")
    cur = spark.createDataFrame([(float(x), "u" if x > 0.8 else "v") for x in b], "x double, c string")
    out = S.feature_drift(ref, cur, ["x"], ["c"]).toPandas().set_index("feature")
    grid = np.union1d(a, b)
    d = np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a)
                      - np.searchsorted(np.sort(b), grid, "right") / len(b)))
    assert out.loc["x", "statistic"] == pytest.approx(d)
    lam = math.sqrt(200 * 150 / 350) * d
    assert out.loc["x", "p_value"] == pytest.approx(ST.kolmogorov_sf(lam))
    ct = np.array([[np.sum(a > 0), np.sum(a <= 0)], [np.sum(b > 0.8), np.sum(b <= 0.8)]], float)
    exp = ct.sum(1, keepdims=True) * ct.sum(0, keepdims=True) / ct.sum()
    diff = np.abs(ct - exp)
    yates = ((diff - np.minimum(0.5, diff)) ** 2 / exp).sum()
    assert out.loc["c", "statistic"] == pytest.approx(yates)
    assert bool(out.loc["x", "drift_detected"]) == (out.loc["x", "p_value"] < 0.05)
    one = S.feature_drift(ref.selectExpr("'k' AS c"), cur.selectExpr("'k' AS c"), [], ["c"]).first()
    assert one["statistic"] == 0.0 and one["p_value"] == 1.0 and not one["drift_detected"]
