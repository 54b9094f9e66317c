"""Spark ML operators, attributions, series, streaming and the driver contract."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketlens.operators import explain as X
from basketlens.operators import ml as ML
from basketlens.operators import segmentation as SG
from basketlens.operators import timeseries as TS

from conftest import SF_SMALL


def _model_frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 1, n)
    b = rng.normal(0, 1, n)
    cat = rng.choice(["p", "q", "r"], n)
    y = ((a + 0.5 * b + (cat == "p") * 0.8 + rng.normal(0, 0.7, n)) > 0.6).astype(int)
    a[::37] = np.nan
    pdf = pd.DataFrame({"customer_id": np.arange(n), "a": a, "b": b, "cat": cat, "churn_label": y})
    return spark.createDataFrame(pdf)


def test_stratified_split_keeps_shares(spark):
    df = _model_frame(spark)
    s = ML.stratified_split(df, test_size=0.2).toPandas()
    for y, g in s.groupby("churn_label"):
        assert (g.split == "test").sum() == math.floor(len(g) * 0.2 + 0.5)
    f = ML.stratified_folds(df, 5).toPandas()
    for y, g in f.groupby("churn_label"):
        counts = g.fold.value_counts()
        assert counts.max() - counts.min() <= 1 and set(counts.index) == set(range(5))


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0), (9.0, 7.0), (3.0, 7.0)], "x double, c double")
    tr, _, _ = ML.scale_features(df, df, ["x", "c"])
    got = [r["x"] for r in tr.collect()]
    x = np.array([1, 2, 4, 9, 3.0])
    assert np.allclose(got, (x - x.mean()) / x.std())
    assert all(r["c"] == 0.0 for r in tr.collect())


def test_pipeline_unknown_category_all_zero(spark):
    df = _model_frame(spark)
    model = ML.preprocessing_pipeline(["a", "b"], ["cat"]).fit(df)
    new = spark.createDataFrame([(1, 0.1, 0.2, "zzz"), (2, None, 0.0, None)], "customer_id long, a double, b double, cat string")
    vecs = [r["features"].toArray() for r in model.transform(new).orderBy("customer_id").collect()]
    assert len(vecs[0]) == 2 + 3
    assert list(vecs[0][2:]) == [0.0, 0.0, 0.0]      # unseen -> all zeros
    assert sum(vecs[1][2:]) == 1.0                    # missing -> most frequent category


def test_unknown_model_type_raises(spark):
    with pytest.raises(ValueError):
        ML.train_churn_model(_model_frame(spark), ["a"], [], "svm")


@pytest.mark.parametrize("model_type", ["logistic_regression", "random_forest"])
def test_train_and_validation_metrics(spark, model_type):
    model, metrics = ML.train_churn_model(_model_frame(spark), ["a", "b"], ["cat"], model_type,
                                          **({"numTrees": 10} if model_type == "random_forest" else {}))
    m = metrics.first()
    assert 0.6 < m["roc_auc"] <= 1.0
    s = ML.score(model, _model_frame(spark)).toPandas()
    assert s.score.between(0, 1).all() and len(s) == 400


def test_tree_shap_additivity_gbt(spark):
    df = _model_frame(spark)
    model = ML.fit_churn_model(df, ["a", "b"], ["cat"], "xgboost", maxIter=8, maxDepth=3)
    attr, base = X.tree_attributions(model, df, "customer_id")
    total = X.contribution_totals(attr, base, "customer_id")
    prob = ML.score(model, df)
    j = total.join(prob, "customer_id").toPandas()
    logit = np.log(j.score / (1 - j.score))
    assert np.allclose(j.explained_output, logit, atol=1e-6)


def test_tree_shap_additivity_random_forest(spark):
    df = _model_frame(spark)
    model = ML.fit_churn_model(df, ["a", "b"], ["cat"], "random_forest", numTrees=5, maxDepth=3)
    attr, base = X.tree_attributions(model, df, "customer_id")
    total = X.contribution_totals(attr, base, "customer_id")
    j = total.join(ML.score(model, df), "customer_id").toPandas()
    assert np.allclose(j.explained_output, j.score, atol=1e-6)


def test_linear_attributions_additivity(spark):
    df = _model_frame(spark)
    model = ML.fit_churn_model(df, ["a", "b"], ["cat"], "logistic_regression")
    attr, base = X.linear_model_attributions(model, df, "customer_id")
    total = X.contribution_totals(attr, base, "customer_id")
    j = total.join(ML.score(model, df), "customer_id").toPandas()
    assert np.allclose(j.explained_output, np.log(j.score / (1 - j.score)), atol=1e-6)
    top = X.top_contributions(attr, "customer_id", 2).toPandas()
    assert top.groupby("customer_id").size().max() == 2
    dep = X.dependence(attr, "a", "customer_id")
    assert dep.count() == 400


def test_segmentation(spark):
    df = _model_frame(spark).na.fill(0.0)
    vec, names, _ = SG.clustering_features(df.drop("cat"))
    assert names == ["a", "b"]
    ks = SG.choose_k(vec, names, [2, 3], n_init=1).toPandas()
    assert len(ks) == 2 and ks.best_silhouette.sum() == 1 and (ks.inertia > 0).all()
    _, labelled = SG.train_kmeans(vec, 2, n_init=2)
    prof = SG.profile_clusters(df.join(labelled.select("customer_id", "cluster"), "customer_id")
                               .drop("customer_id"), "cluster").toPandas()
    assert prof.cluster_size.sum() == 400 and set(prof.columns) >= {"churn_rate", "a", "cat"}


def test_series_gap_fill_adf_and_forecast(spark):
    rng = np.random.default_rng(2)
    rows = []
    for m in range(1, 49):
        if m == 7:
            continue  # a month without sales
        y, mo = 2019 + (m - 1) // 12, (m - 1) % 12 + 1
        rows.append(("s", pd.Timestamp(y, mo, 10).to_pydatetime(), float(100 + m + rng.normal(0, 3))))
    tx = spark.createDataFrame(rows, "k string, transaction_date timestamp_ntz, revenue double")
    s = TS.revenue_timeseries(tx, by=["k"], revenue="revenue")
    pdf = s.toPandas().sort_values("period")
    assert len(pdf) == 48 and pdf.iloc[6].revenue == 0.0
    assert pdf.period.iloc[0] == pd.Timestamp(2019, 1, 31)
    adf = TS.stationarity(s, by=["k"]).first()
    assert 0.0 <= adf["p_value"] <= 1.0 and adf["crit_1"] < adf["crit_5"] < adf["crit_10"] < 0
    fc = TS.seasonal_forecast(s, steps=3, by=["k"]).toPandas().sort_values("forecast_date")
    assert list(fc.forecast_date) == [pd.Timestamp(2023, 1, 31), pd.Timestamp(2023, 2, 28),
                                      pd.Timestamp(2023, 3, 31)]
    width = (fc.upper_ci_95 - fc.lower_ci_95).to_numpy()
    assert (np.diff(width) >= -1e-9).all()


def test_adf_random_walk_vs_white_noise():
    rng = np.random.default_rng(0)
    walk = np.cumsum(rng.normal(0, 1, 200))
    noise = rng.normal(0, 1, 200)
    assert TS.adf_test(walk)["p_value"] > 0.05
    assert TS.adf_test(noise)["p_value"] < 0.01
    assert TS.adf_test(noise[:4])["recommended_differencing"] == 1


def test_stream_equals_batch(spark, tmp_dir):
    from basketlens.streaming import scoring as STREAM
    df = _model_frame(spark)
    model = ML.fit_churn_model(df, ["a", "b"], ["cat"], "logistic_regression")
    feats = df.drop("churn_label")
    feats.repartition(3).write.parquet(os.path.join(tmp_dir, "src"))
    q = STREAM.start_scoring(spark, model, os.path.join(tmp_dir, "src"), feats.schema,
                             os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    streamed = spark.read.parquet(os.path.join(tmp_dir, "sink")).toPandas().set_index("customer_id")
    batch = ML.score(model, df).toPandas().set_index("customer_id")
    assert len(streamed) == 400
    assert np.allclose(streamed.loc[batch.index, "churn_probability"], batch.score)


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[-1] == "churn_label"
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 60


def test_flagship_partition_independence(spark):
    import __spark_entry__ as entry
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = entry.queries()["master_feature_table"](spark, SF_SMALL).toPandas()
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        b = entry.queries()["master_feature_table"](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    key = "customer_id"
    a = a.sort_values(key).reset_index(drop=True)
    b = b.sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_streaming_band_counts_match_batch(spark, tmp_dir):
    import datetime as dt
    from basketlens.streaming import scoring as STREAM
    df = _model_frame(spark)
    model = ML.fit_churn_model(df, ["a", "b"], ["cat"], "logistic_regression")
    day0 = dt.datetime(2024, 1, 1)
    feats = df.drop("churn_label").withColumn(
        "scored_at", (F.lit(day0) + F.expr("make_interval(0, 0, 0, CAST(customer_id % 5 AS INT))"))
        .cast("timestamp"))
    src = os.path.join(tmp_dir, "src2")
    feats.write.parquet(src)
    q = STREAM.start_band_counts(spark, model, src, feats.schema, "scored_at",
                                 os.path.join(tmp_dir, "bands"), os.path.join(tmp_dir, "ckpt2"),
                                 window="1 day", watermark="1 day")
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(tmp_dir, "bands")).toPandas()
    from basketlens.operators.metrics import score_bands
    batch = score_bands(ML.churn_probability(model.transform(feats), "churn_probability"))
    exp = (batch.groupBy(F.to_date("scored_at").alias("d"), "risk_level").count().toPandas())
    assert len(got) > 0
    for _, r in got.iterrows():
        d = pd.Timestamp(r["window_start"]).date()
        e = exp[(exp.d == d) & (exp.risk_level == r["risk_level"])]["count"].iloc[0]
        assert r["customers"] == e


def test_streaming_band_counts_read_all_files_in_one_batch(spark, monkeypatch):
    import datetime as dt
    from basketlens.plans import queries_contracts as Q
    from basketlens.session import ship_package
    ship_package(spark)
    data, files = [], []

    def several(df, name):
        data.append(whole := keep(df.repartitionByRange(4, F.col("signup_date").desc()), name))
        return whole

    def counted(spark, model, source, *rest):
        files.extend(spark.read.parquet(source).inputFiles())
        return start(spark, model, source, *rest)

    keep, start = Q.materialize, Q.STREAM.start_band_counts
    monkeypatch.setattr(Q, "materialize", several)
    monkeypatch.setattr(Q.STREAM, "start_band_counts", counted)
    got = {r.window_start.date(): r.customers for r in Q.q_stream_bands(spark, "/root/testdata/sf0.001").collect()}
    days = {r[0]: r[1] for r in data[0].groupBy(F.to_date("signup_date")).count().collect()}
    last = max(days) - dt.timedelta(days=1)
    assert len(files) > 1
    assert got == {d: n for d, n in days.items() if d < last}
