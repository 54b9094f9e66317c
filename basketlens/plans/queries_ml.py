"""Registered queries: model data preparation, classifiers, tuning, segmentation,
attributions and streaming scoring (ops 35-38, 42-47, 52-55, 58).

Fits are rows-only checks (pytest covers their invariants). Where the operator's output is
a deterministic function of the tables (scaling, profiles, attributions given
coefficients), the query is value-checked against SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import explain as X
from ..operators import features as FT
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import segmentation as SG
from ..session import app_folder, materialize, parallel_map
from ..sources import adapter as A
from ..streaming import scoring as STREAM
from .catalog import register
from .queries_features import (COMPACT_SQL, MASTER_DOUBLES, MASTER_SQL, compact_master,
                               master)
from .sqlkit import oracle

NUMERIC = ["age", "recency_days", "frequency", "monetary_total", "total_sessions",
           "avg_discount_received", "return_rate", "purchase_gap_mean",
           "peak_season_purchase_ratio", "category_diversity", "revenue_last_180d"]
CATEGORICAL = ["gender", "acquisition_channel", "preferred_payment"]


def model_frame(spark, sf):
    """Master feature table restricted to model inputs, materialised once per query."""
    m = master(spark, sf).select("customer_id", *NUMERIC, *CATEGORICAL, "churn_label")
    return materialize(m, "model-frame")


# ---------------------------------------------------------------- op 35: split

@register("stratified_split_counts", oracle("""
SELECT split, churn_label, CAST(n AS BIGINT) AS customers FROM (
  SELECT 'test' AS split, churn_label, floor(0.2 * count(*) + 0.5) AS n FROM master GROUP BY churn_label
  UNION ALL SELECT 'train', churn_label, count(*) - floor(0.2 * count(*) + 0.5) FROM master GROUP BY churn_label) s
WHERE n > 0""", ctes=MASTER_SQL))
def q_split(spark, sf):
    s = ML.stratified_split(model_frame(spark, sf))
    return s.groupBy("split", "churn_label").agg(F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- op 36: scaling

_SCALE_COLS = [c for c in FT.MODEL_FEATURES if c != "is_premium"]


@register("standard_scaled_model_data", oracle(
    "SELECT customer_id, " + ", ".join(
        f"CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL THEN CAST(0 AS DOUBLE) "
        f"ELSE (CAST({c} AS DOUBLE) - mu_{c}) / sd_{c} END AS {c}" for c in _SCALE_COLS)
    + " FROM c_master, (SELECT " + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS mu_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS sd_{c}" for c in _SCALE_COLS)
    + " FROM c_master) st", _SCALE_COLS, ctes=COMPACT_SQL))
def q_scaled(spark, sf):
    d = materialize(FT.model_data(compact_master(spark, sf)).select("customer_id", *_SCALE_COLS), "scale-input")
    scaled, _, _ = ML.scale_features(d, d, _SCALE_COLS)
    return scaled


# ---------------------------------------------------------------- ops 37-38, 41: models

@register("churn_model_validation_logistic", note="Spark ML fit; rows-only")
def q_model_lr(spark, sf):
    _, metrics = ML.train_churn_model(model_frame(spark, sf), NUMERIC, CATEGORICAL,
                                      "logistic_regression")
    return metrics


@register("churn_model_comparison", note="four Spark ML fits scored on a held-out split; rows-only")
def q_model_comparison(spark, sf):
    split = ML.written_split(model_frame(spark, sf), tag="model-split")
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    prep = ML.preprocessing_pipeline(NUMERIC, CATEGORICAL).fit(train)  # the same for all families
    models = parallel_map(lambda mt: ML.fit_churn_model(train, NUMERIC, CATEGORICAL, mt, prep=prep),
                          ML.MODEL_TYPES, len(ML.MODEL_TYPES))
    scored = None
    for mt, model in zip(ML.MODEL_TYPES, models):
        s = ML.score(model, test, keep=("customer_id", "churn_label")).select(
            F.lit(mt).alias("model_name"), F.col("churn_label").alias("label"), "score")
        scored = s if scored is None else scored.unionByName(s)
    return M.compare_models(scored)


@register("churn_threshold_curve_logistic", note="threshold search on a fitted model; rows-only")
def q_model_curve(spark, sf):
    data = model_frame(spark, sf)
    model, _ = ML.train_churn_model(data, NUMERIC, CATEGORICAL, "logistic_regression")
    scored = ML.score(model, data, keep=("churn_label",)).withColumnRenamed("churn_label", "label")
    return M.optimal_threshold(M.threshold_curve(scored))


# ---------------------------------------------------------------- ops 42-43: search

@register("churn_model_tuning_logistic", note="random search with stratified 5-fold CV; rows-only")
def q_tuning(spark, sf):
    res = ML.tune_churn_model(model_frame(spark, sf), NUMERIC, CATEGORICAL, "logistic_regression")
    rows = [(str(res["best_params"]), res["best_cv_score"], len(res["cv_scores"]))]
    return spark.createDataFrame(rows, "best_params string, best_cv_score double, trials int")


@register("rfe_feature_selection_logistic", note="recursive elimination, 5-fold AUC per size; rows-only")
def q_rfe(spark, sf):
    res = ML.recursive_feature_elimination(model_frame(spark, sf), NUMERIC, CATEGORICAL,
                                           model_type="logistic_regression")
    rows = [(n, m, s, n == res["optimal_n_features"]) for n, m, s in
            zip(res["n_features"], res["cv_scores_mean"], res["cv_scores_std"])]
    return spark.createDataFrame(rows, "n_features int, cv_score_mean double, cv_score_std double, "
                                       "selected boolean")


# ---------------------------------------------------------------- ops 44-47: segmentation

_CLUSTER_COLS = [c for c in ["age", "recency_days", "frequency", "monetary_total", "monetary_avg",
                             "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score",
                             "rfm_total_score", "total_sessions", "avg_session_duration",
                             "total_page_views", "cart_add_count", "cart_to_purchase_ratio",
                             "wishlist_count", "days_since_last_event", "event_recency_trend",
                             "category_diversity", "avg_discount_received", "return_rate",
                             "revenue_last_30d", "revenue_last_90d", "revenue_last_180d",
                             "purchase_gap_mean", "purchase_gap_std", "peak_season_purchase_ratio"]]


@register("clustering_features", oracle(
    "SELECT customer_id, " + ", ".join(
        f"CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL THEN CAST(0 AS DOUBLE) "
        f"ELSE (CAST({c} AS DOUBLE) - mu_{c}) / sd_{c} END AS {c}" for c in _CLUSTER_COLS)
    + " FROM master, (SELECT " + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS mu_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS sd_{c}" for c in _CLUSTER_COLS)
    + " FROM master) st", _CLUSTER_COLS, ctes=MASTER_SQL))
def q_clustering_features(spark, sf):
    vec, names, _ = SG.clustering_features(master(spark, sf))
    return vec.select("customer_id", *names)


def _segment_input(spark, sf):
    vec, names, _ = SG.clustering_features(materialize(master(spark, sf), "segment-master"))
    return materialize(vec.select("customer_id", *names, "features"), "cluster-input"), names


@register("kmeans_choose_k", note="k-means per k with inertia, silhouette, CH; rows-only")
def q_choose_k(spark, sf):
    vec, names = _segment_input(spark, sf)
    return SG.choose_k(vec, names, range(2, 11), n_init=10)


@register("kmeans_cluster_profile", note="best-of-10 k-means, k=3, then profile; rows-only")
def q_kmeans_profile(spark, sf):
    vec, _ = _segment_input(spark, sf)
    _, labelled = SG.train_kmeans(vec, 3, n_init=10)
    m = master(spark, sf).join(labelled.select("customer_id", "cluster"), "customer_id")
    return SG.profile_clusters(m.drop("customer_id"), "cluster")


_PROFILE_NUM = [c for c in MASTER_DOUBLES] + [
    "recency_days", "frequency", "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score",
    "rfm_total_score", "total_sessions", "total_page_views", "cart_add_count", "wishlist_count",
    "days_since_last_event", "category_diversity"]
_PROFILE_OTHER = ["signup_date", "gender", "city", "acquisition_channel", "is_premium",
                  "preferred_device", "preferred_category", "preferred_payment"]


def _mode_sql(col: str) -> str:
    return (f"(SELECT val FROM (SELECT CAST({col} AS VARCHAR) AS val, count(*) AS n FROM master m2 "
            f"WHERE m2.rfm_segment = m.rfm_segment AND {col} IS NOT NULL GROUP BY 1) x "
            f"ORDER BY n DESC, val LIMIT 1)")


@register("cluster_profile_by_segment", oracle(
    "SELECT rfm_segment, count(*) AS cluster_size, avg(CAST(churn_label AS DOUBLE)) AS churn_rate, "
    + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS {c}" for c in _PROFILE_NUM) + ", "
    + ", ".join(f"coalesce(any_value({_mode_sql(c)}), 'unknown') AS {c}" for c in _PROFILE_OTHER)
    + " FROM master m GROUP BY rfm_segment",
    ["churn_rate"] + _PROFILE_NUM, ctes=MASTER_SQL))
def q_profile_by_segment(spark, sf):
    m = master(spark, sf).drop("customer_id")
    m = m.select("rfm_segment", "churn_label", *_PROFILE_NUM, *_PROFILE_OTHER)
    return SG.profile_clusters(m, "rfm_segment")


# ---------------------------------------------------------------- ops 52-55: attributions

_ATTR_FEATURES = list(FT.MODEL_FEATURES)


def standardized_difference_coefficients(df, features, label="churn_label"):
    """A data-derived linear scorer: (mean | churner - mean | retained) / population std."""
    long = df.select(label, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features]))
        .alias("x")).select(label, "x.feature", "x.v")
    st = long.groupBy("feature").agg(
        F.avg(F.when(F.col(label) == 1, F.col("v"))).alias("m1"),
        F.avg(F.when(F.col(label) == 0, F.col("v"))).alias("m0"), F.stddev_pop("v").alias("sd"))
    coef = F.when((F.col("sd") == 0) | F.col("sd").isNull(), F.lit(0.0)).otherwise(
        (F.coalesce("m1", F.lit(0.0)) - F.coalesce("m0", F.lit(0.0))) / F.col("sd"))
    return st.select("feature", coef.alias("coefficient"))


def linear_attribution_frame(spark, sf):
    d = materialize(FT.model_data(compact_master(spark, sf)), "model-data")
    coef = standardized_difference_coefficients(d, _ATTR_FEATURES)
    return X.linear_attributions(d, "customer_id", coef, 0.0)


ATTR_SQL = COMPACT_SQL + ",\nalong AS (" + " UNION ALL ".join(
    f"SELECT customer_id, '{f}' AS feature, CAST({f} AS DOUBLE) AS feature_value, churn_label FROM c_master"
    for f in _ATTR_FEATURES) + """),
astats AS (SELECT feature, avg(feature_value) AS mean, stddev_pop(feature_value) AS sd,
                  avg(feature_value) FILTER (WHERE churn_label = 1) AS m1,
                  avg(feature_value) FILTER (WHERE churn_label = 0) AS m0 FROM along GROUP BY feature),
acoef AS (SELECT feature, mean, CASE WHEN sd = 0 OR sd IS NULL THEN CAST(0 AS DOUBLE)
                                     ELSE (coalesce(m1, 0) - coalesce(m0, 0)) / sd END AS coefficient FROM astats),
attr AS (SELECT customer_id, feature, feature_value, coefficient * (feature_value - mean) AS shap_value
         FROM along JOIN acoef USING (feature))"""


@register("linear_attributions", oracle("SELECT * FROM attr", ["feature_value", "shap_value"],
                                        ctes=ATTR_SQL))
def q_linear_attr(spark, sf):
    out, _ = linear_attribution_frame(spark, sf)
    return out


@register("attribution_importance", oracle(
    "SELECT feature, avg(abs(shap_value)) AS mean_abs_shap FROM attr GROUP BY feature",
    ["mean_abs_shap"], ctes=ATTR_SQL))
def q_attr_importance(spark, sf):
    out, _ = linear_attribution_frame(spark, sf)
    return X.mean_abs_attribution(out)


@register("top3_contributions", oracle(
    "SELECT customer_id, feature, feature_value, shap_value, CAST(rank AS INTEGER) AS rank FROM ("
    "SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(shap_value) DESC, feature) AS rank "
    "FROM attr) r WHERE rank <= 3", ["feature_value", "shap_value"], ctes=ATTR_SQL))
def q_top3(spark, sf):
    out, _ = linear_attribution_frame(spark, sf)
    return X.top_contributions(out, "customer_id", 3)


@register("dependence_recency", oracle(
    "SELECT customer_id, feature_value, shap_value FROM attr WHERE feature = 'recency_days'",
    ["feature_value", "shap_value"], ctes=ATTR_SQL))
def q_dependence(spark, sf):
    out, _ = linear_attribution_frame(spark, sf)  # contributions are columns of one written frame
    return X.dependence(out, "recency_days", "customer_id")


@register("logistic_model_attributions", note="attributions of a fitted Spark ML model; rows-only")
def q_lr_attr(spark, sf):
    data = model_frame(spark, sf)
    model, _ = ML.train_churn_model(data, NUMERIC, CATEGORICAL, "logistic_regression")
    out, _ = X.linear_model_attributions(model, data, "customer_id")
    return out


@register("tree_model_attributions", note="TreeSHAP on a GBT (100 trees, depth 5); rows-only")
def q_tree_attr(spark, sf):
    data = model_frame(spark, sf)
    model, _ = ML.train_churn_model(data, NUMERIC, CATEGORICAL, "xgboost")
    out, _ = X.tree_attributions(model, data, "customer_id")
    return out


# ---------------------------------------------------------------- op 58: streaming scoring

@register("streaming_scores", note="file-stream scoring run to completion; rows-only")
def q_streaming(spark, sf):
    data = model_frame(spark, sf)
    model, _ = ML.train_churn_model(data, NUMERIC, CATEGORICAL, "logistic_regression")
    root = f"{app_folder(spark)}/stream-{uuid.uuid4().hex}"
    data.drop("churn_label").write.parquet(f"{root}/source")
    q = STREAM.start_scoring(spark, model, f"{root}/source", data.drop("churn_label").schema,
                             f"{root}/sink", f"{root}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/sink")
