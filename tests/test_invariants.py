"""Invariants of the registered queries on the smallest given tables."""

import numpy as np
import pandas as pd
import pytest

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def q():
    import __spark_entry__ as entry
    return entry.queries()


def test_master_has_one_row_per_customer(spark, q):
    m = q["master_feature_table"](spark, SF_SMALL).toPandas()
    n = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert len(m) == n and m["customer_id"].is_unique


def test_segments_sum_to_customers(spark, q):
    seg = q["rfm_segment_counts"](spark, SF_SMALL).toPandas()
    rfm = q["rfm_base"](spark, SF_SMALL).count()
    assert seg["customers"].sum() == rfm


def test_retention_rates_bounded(spark, q):
    r = q["cohort_retention"](spark, SF_SMALL).toPandas()
    assert r["retention_rate"].between(0, 1).all()
    assert (r[r.period_idx == 0]["retention_rate"] == 1.0).all()


def test_threshold_curve_recall_monotone(spark, q):
    c = q["threshold_curve"](spark, SF_SMALL).toPandas().sort_values("threshold")
    assert len(c) == 91
    assert (np.diff(c["recall"].to_numpy()) <= 1e-12).all()


@pytest.mark.parametrize("name", ["premium_aov_test", "channel_churn_test",
                                  "revenue_seasonality_test", "feature_drift"])
def test_pvalues_bounded(spark, q, name):
    df = q[name](spark, SF_SMALL).toPandas()
    assert df["p_value"].between(0, 1).all()
    assert (df["reject_null" if "reject_null" in df else "drift_detected"]
            == (df["p_value"] < 0.05)).all()


def test_series_gap_free(spark, q):
    s = q["revenue_timeseries_by_category"](spark, SF_SMALL).toPandas()
    for _, g in s.groupby("category"):
        p = pd.to_datetime(g["period"]).sort_values()
        months = p.dt.year * 12 + p.dt.month
        assert (np.diff(months.to_numpy()) == 1).all()


def test_band_summary_adds_up(spark, q):
    s = q["score_band_summary"](spark, SF_SMALL).first()
    assert s["high_risk"] + s["medium_risk"] + s["low_risk"] == s["total"]
