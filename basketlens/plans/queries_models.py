"""Registered queries: evaluation metrics, revenue series, impact, scoring and gates
(ops 39-41, 48-51, 56-57, 59), plus model fits and explanations (rows-only).

The SQL-checkable metric queries score customers with a data-derived heuristic, a rational
function of RFM recency and frequency (plain IEEE arithmetic, so Spark and the oracle get
bit-identical scores); model-based variants fit Spark ML models and are rows-only.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators import features as FT
from ..operators import metrics as M
from ..operators import timeseries as TS
from ..session import materialize
from ..sources import adapter as A
from .catalog import register
from .sqlkit import days, oracle, ts

TX_SNAP = A.TX_SNAPSHOT


def heuristic_scores(spark, sf):
    """customer_id, label (churn_label), score = r / (r + 180 + 30 f), score_b = 30 / (30 + f)
    with r = recency days and f = purchase count (0 for customers without purchases)."""
    cust = A.customers(spark, sf).select("customer_id", F.col("churn_label").alias("label"))
    rfm = FT.rfm_base(A.transactions(spark, sf, with_category=False), TX_SNAP)
    j = cust.join(rfm.select("customer_id", "recency_days", "frequency"), "customer_id", "left")
    r = F.coalesce("recency_days", F.lit(0)).cast("double")
    f = F.coalesce("frequency", F.lit(0)).cast("double")
    return j.select("customer_id", "label", (r / (r + 180.0 + 30.0 * f)).alias("score"),
                    (F.lit(30.0) / (F.lit(30.0) + f)).alias("score_b"))


HS_SQL = f"""hs_rfm AS (
  SELECT customer_id, {days(ts(TX_SNAP), 'max(transaction_date)')} AS recency_days,
         count(*) AS frequency FROM shop_tx GROUP BY 1),
hs AS (
  SELECT c.customer_id, c.churn_label AS label,
         CAST(coalesce(r.recency_days, 0) AS DOUBLE)
           / (CAST(coalesce(r.recency_days, 0) AS DOUBLE) + CAST(180 AS DOUBLE)
              + CAST(30 AS DOUBLE) * CAST(coalesce(r.frequency, 0) AS DOUBLE)) AS score,
         CAST(30 AS DOUBLE) / (CAST(30 AS DOUBLE) + CAST(coalesce(r.frequency, 0) AS DOUBLE)) AS score_b
  FROM shop_customers c LEFT JOIN hs_rfm r ON r.customer_id = c.customer_id)"""

_G = "CAST(0.05 AS DOUBLE)"
CURVE_SQL = HS_SQL + f""",
grid AS (SELECT {_G} + CAST(i AS DOUBLE) * (({_G} + CAST(0.01 AS DOUBLE)) - {_G}) AS threshold
         FROM range(91) t(i)),
cnt AS (
  SELECT g.threshold,
         count(*) FILTER (WHERE h.score >= g.threshold AND h.label = 1) AS tp,
         count(*) FILTER (WHERE h.score >= g.threshold AND h.label <> 1) AS fp,
         count(*) FILTER (WHERE h.score < g.threshold AND h.label = 1) AS fn,
         count(*) FILTER (WHERE h.score < g.threshold AND h.label <> 1) AS tn
  FROM grid g, hs h GROUP BY g.threshold),
curve AS (
  SELECT threshold,
         CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
         CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN (tp / (tp + fn) + tn / (tn + fp)) / 2
              WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE tn / (tn + fp) END AS balanced_accuracy
  FROM cnt)"""

CURVE_COLS = ["threshold", "precision", "recall", "f1", "balanced_accuracy"]


@register("threshold_curve", oracle(
    "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in CURVE_COLS) + " FROM curve",
    CURVE_COLS, ctes=CURVE_SQL))
def q_threshold_curve(spark, sf):
    return M.threshold_curve(heuristic_scores(spark, sf))


@register("optimal_threshold", oracle(
    "SELECT CAST(threshold AS DOUBLE) AS optimal_threshold, CAST(f1 AS DOUBLE) AS optimal_metric_value "
    "FROM curve ORDER BY f1 DESC, threshold LIMIT 1",
    ["optimal_threshold", "optimal_metric_value"], ctes=CURVE_SQL))
def q_optimal_threshold(spark, sf):
    return M.optimal_threshold(M.threshold_curve(heuristic_scores(spark, sf)))


def _metrics_sql(score: str, by: str = "") -> str:
    """Metrics at 0.5 for score column ``score``: AUC by the rank-sum identity, PR AUC by a
    window over distinct scores (an independent formulation of the Spark plan)."""
    return f"""pt AS (SELECT {by + ', ' if by else ''}{score} AS s, label FROM {('hs_long' if by else 'hs')}),
ranked AS (SELECT *, rank() OVER (PARTITION BY {by or 'NULL'} ORDER BY s)
                       + CAST(count(*) OVER (PARTITION BY {by + ', ' if by else ''}s) - 1 AS DOUBLE) / 2 AS ar
           FROM pt),
auc AS (SELECT {by + ', ' if by else ''}
          (sum(ar) FILTER (WHERE label = 1) - CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE)
             * (count(*) FILTER (WHERE label = 1) + 1) / 2)
          / (CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label <> 1)) AS roc_auc
        FROM ranked {('GROUP BY ' + by) if by else ''}),
ds AS (SELECT {by + ', ' if by else ''}s, count(*) FILTER (WHERE label = 1) AS pos,
              count(*) FILTER (WHERE label <> 1) AS neg FROM pt GROUP BY ALL),
dc AS (SELECT *, sum(pos) OVER (PARTITION BY {by or 'NULL'} ORDER BY s DESC) AS tp,
              sum(neg) OVER (PARTITION BY {by or 'NULL'} ORDER BY s DESC) AS fp,
              sum(pos) OVER (PARTITION BY {by or 'NULL'}) AS p_all FROM ds),
pr AS (SELECT {by + ', ' if by else ''}
         sum((tp - (tp - pos)) / p_all * (tp / (tp + fp)
             + CASE WHEN tp - pos + fp - neg = 0 THEN 1 ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2) AS pr_auc
       FROM dc {('GROUP BY ' + by) if by else ''}),
cm AS (SELECT {by + ', ' if by else ''}count(*) FILTER (WHERE s >= 0.5 AND label = 1) AS tp,
              count(*) FILTER (WHERE s >= 0.5 AND label <> 1) AS fp,
              count(*) FILTER (WHERE s < 0.5 AND label = 1) AS fn,
              count(*) FILTER (WHERE s < 0.5 AND label <> 1) AS tn FROM pt {('GROUP BY ' + by) if by else ''}),
mx AS (SELECT {('cm.' + by + ', ') if by else ''}auc.roc_auc, pr.pr_auc,
              CAST(cm.tp + cm.tn AS DOUBLE) / (cm.tp + cm.tn + cm.fp + cm.fn) AS accuracy,
              CASE WHEN cm.tp + cm.fp = 0 THEN 0 ELSE cm.tp / (cm.tp + cm.fp) END AS precision,
              CASE WHEN cm.tp + cm.fn = 0 THEN 0 ELSE cm.tp / (cm.tp + cm.fn) END AS recall,
              CASE WHEN 2 * cm.tp + cm.fp + cm.fn = 0 THEN 0 ELSE 2 * cm.tp / (2 * cm.tp + cm.fp + cm.fn) END AS f1,
              (cm.tp / (cm.tp + cm.fn) + cm.tn / (cm.tn + cm.fp)) / 2 AS balanced_accuracy,
              cm.tn, cm.fp, cm.fn, cm.tp
       FROM cm {('JOIN auc USING (' + by + ') JOIN pr USING (' + by + ')') if by else ', auc, pr'})"""


METRIC_DOUBLES = ["roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1", "balanced_accuracy"]


@register("classification_metrics", oracle(
    "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in METRIC_DOUBLES)
    + ", tn, fp, fn, tp FROM mx", METRIC_DOUBLES, ctes=HS_SQL + ",\n" + _metrics_sql("score")))
def q_classification_metrics(spark, sf):
    return M.classification_metrics(heuristic_scores(spark, sf))


@register("classification_report", oracle("""
SELECT 1 AS class, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
       CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
       CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, tp + fn AS support FROM cm
UNION ALL
SELECT 0, CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END,
       CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END,
       CASE WHEN 2 * tn + fn + fp = 0 THEN 0 ELSE 2 * tn / (2 * tn + fn + fp) END, tn + fp FROM cm""",
                                          ["precision", "recall", "f1"], ctes=HS_SQL + ",\n" + _metrics_sql("score")))
def q_classification_report(spark, sf):
    return M.classification_report(heuristic_scores(spark, sf))


def two_model_scores(spark, sf):
    h = heuristic_scores(spark, sf)
    a = h.select(F.lit("recency_ratio").alias("model_name"), "customer_id", "label", "score")
    b = h.select(F.lit("frequency_ratio").alias("model_name"), "customer_id", "label",
                 F.col("score_b").alias("score"))
    return a.unionByName(b)


@register("compare_models", oracle(
    "SELECT model_name, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in
                                      ["roc_auc", "pr_auc", "f1", "precision", "recall", "balanced_accuracy"])
    + " FROM mx ORDER BY roc_auc DESC, model_name",
    ["roc_auc", "pr_auc", "f1", "precision", "recall", "balanced_accuracy"],
    ctes=HS_SQL + """,
hs_long AS (SELECT 'recency_ratio' AS model_name, label, score FROM hs
            UNION ALL SELECT 'frequency_ratio', label, score_b FROM hs),
""" + _metrics_sql("score", by="model_name")))
def q_compare_models(spark, sf):
    return M.compare_models(two_model_scores(spark, sf))


# ---------------------------------------------------------------- op 48: series

TS_SQL = """mon AS (SELECT date_trunc('month', transaction_date) AS m, sum(revenue) AS revenue FROM shop_tx GROUP BY 1),
cal AS (SELECT unnest(generate_series((SELECT min(m) FROM mon), (SELECT max(m) FROM mon), INTERVAL 1 MONTH)) AS m),
series AS (SELECT CAST(last_day(cal.m) AS TIMESTAMP) AS period, coalesce(mon.revenue, 0) AS revenue
           FROM cal LEFT JOIN mon ON mon.m = cal.m)"""


@register("revenue_timeseries", oracle("SELECT period, CAST(revenue AS DOUBLE) AS revenue FROM series",
                                       ["revenue"], ctes=TS_SQL))
def q_revenue_ts(spark, sf):
    return TS.revenue_timeseries(A.transactions(spark, sf, with_category=False))


@register("revenue_timeseries_by_category", oracle("""
SELECT cal.category, CAST(last_day(cal.m) AS TIMESTAMP) AS period, CAST(coalesce(mc.revenue, 0) AS DOUBLE) AS revenue
FROM cal_c cal LEFT JOIN mc ON mc.category = cal.category AND mc.m = cal.m""", ["revenue"], ctes="""
mc AS (SELECT category, date_trunc('month', transaction_date) AS m, sum(revenue) AS revenue FROM shop_tx GROUP BY 1, 2),
cal_c AS (SELECT category, unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS m FROM mc GROUP BY category)"""))
def q_revenue_ts_cat(spark, sf):
    return TS.revenue_timeseries(A.transactions(spark, sf), by=["category"])


def _register_series(name: str, freq: str, unit: str, step: str, label: str) -> None:
    """Series of another period by category; the statement labels the period's last day."""
    statement = oracle(f"""
SELECT cal.category, CAST({label} AS TIMESTAMP) AS period, CAST(coalesce(mc.revenue, 0) AS DOUBLE) AS revenue
FROM cal_c cal LEFT JOIN mc ON mc.category = cal.category AND mc.m = cal.m""", ["revenue"], ctes=f"""
mc AS (SELECT category, CAST(date_trunc('{unit}', transaction_date) AS TIMESTAMP) AS m, sum(revenue) AS revenue FROM shop_tx GROUP BY 1, 2),
cal_c AS (SELECT category, unnest(generate_series(min(m), max(m), INTERVAL {step})) AS m FROM mc GROUP BY category)""")

    @register(name, statement)
    def build(spark, sf):
        return TS.revenue_timeseries(A.transactions(spark, sf), by=["category"], freq=freq)


_register_series("revenue_timeseries_daily", "D", "day", "1 DAY", "cal.m")
_register_series("revenue_timeseries_weekly", "W", "week", "7 DAY", "cal.m + INTERVAL 6 DAY")
_register_series("revenue_timeseries_quarterly", "Q", "quarter", "3 MONTH", "last_day(cal.m + INTERVAL 2 MONTH)")


@register("revenue_stationarity_by_category", note="ADF per series via applyInPandas; rows-only")
def q_stationarity(spark, sf):
    return TS.stationarity(TS.revenue_timeseries(A.transactions(spark, sf), by=["category"]),
                           by=["category"])


@register("revenue_forecast_by_category", note="seasonal AR on differenced series; rows-only")
def q_forecast(spark, sf):
    return TS.seasonal_forecast(TS.revenue_timeseries(A.transactions(spark, sf), by=["category"]),
                                steps=3, by=["category"])


# ---------------------------------------------------------------- op 51: forecast accuracy

def naive_predictions(series):
    """Previous month's revenue as the prediction of each month (calendar-bounded window)."""
    w = Window.orderBy("period")
    return series.select("period", F.lag("revenue").over(w).alias("predicted"))


@register("forecast_accuracy_naive", oracle("""
SELECT CAST(count(*) AS BIGINT) AS n, coalesce(avg(abs(a - p)), 0) AS mae, coalesce(sqrt(avg((a - p) * (a - p))), 0) AS rmse,
       coalesce(avg(abs((a - p) / a)) FILTER (WHERE a <> 0) * 100, 0) AS mape,
       coalesce(avg(2 * abs(a - p) / (abs(a) + abs(p))) FILTER (WHERE abs(a) + abs(p) <> 0) * 100, 0) AS smape,
       CASE WHEN count(*) < 2 THEN 0
            WHEN sum((a - ma) * (a - ma)) = 0 THEN CASE WHEN sum((a - p) * (a - p)) = 0 THEN 1 ELSE 0 END
            ELSE 1 - sum((a - p) * (a - p)) / sum((a - ma) * (a - ma)) END AS r2
FROM (SELECT a, p, avg(a) OVER () AS ma FROM
      (SELECT revenue AS a, lag(revenue) OVER (ORDER BY period) AS p FROM series) x WHERE p IS NOT NULL) y""",
                                              ["mae", "rmse", "mape", "smape", "r2"], ctes=TS_SQL))
def q_forecast_accuracy(spark, sf):
    s = materialize(TS.revenue_timeseries(A.transactions(spark, sf, with_category=False)), "series")
    return M.forecast_accuracy(s.withColumnRenamed("revenue", "actual"), naive_predictions(s),
                               on=["period"])


@register("forecast_accuracy_fitted_by_category", note="in-sample fit of op 50; rows-only")
def q_forecast_accuracy_fitted(spark, sf):
    s = materialize(TS.revenue_timeseries(A.transactions(spark, sf), by=["category"]), "series")
    fit = TS.fitted_values(s, by=["category"])
    return M.forecast_accuracy(s.withColumnRenamed("revenue", "actual"),
                               fit.withColumnRenamed("fitted", "predicted"),
                               on=["category", "period"], by=["category"])


# ---------------------------------------------------------------- op 56: revenue at risk

RISK_SQL = HS_SQL + """,
r12 AS (SELECT customer_id, sum(revenue) AS revenue_12m FROM shop_tx
        WHERE transaction_date >= (SELECT max(transaction_date) FROM shop_tx) - INTERVAL 365 DAY GROUP BY 1),
ch AS (SELECT h.customer_id, CAST(coalesce(r.revenue_12m, 0) AS DOUBLE) AS revenue_12m
       FROM hs h LEFT JOIN r12 r ON r.customer_id = h.customer_id WHERE h.score >= 0.5)"""


@register("revenue_at_risk", oracle("""
SELECT count(*) AS predicted_churners_count, coalesce(avg(revenue_12m), 0) AS avg_revenue_per_churner_12m,
       coalesce(sum(revenue_12m), 0) AS total_revenue_at_risk,
       coalesce(sum(revenue_12m), 0) * 0.30 AS potential_save_revenue_30pct,
       coalesce(sum(revenue_12m), 0) * 0.50 AS potential_save_revenue_50pct FROM ch""",
                                    ["avg_revenue_per_churner_12m", "total_revenue_at_risk",
                                     "potential_save_revenue_30pct", "potential_save_revenue_50pct"],
                                    ctes=RISK_SQL))
def q_revenue_at_risk(spark, sf):
    h = heuristic_scores(spark, sf)
    return M.revenue_at_risk(h, A.transactions(spark, sf, with_category=False))


@register("revenue_at_risk_top10", oracle(
    "SELECT customer_id, revenue_12m FROM ch ORDER BY revenue_12m DESC, customer_id LIMIT 10",
    ["revenue_12m"], ctes=RISK_SQL))
def q_revenue_at_risk_top10(spark, sf):
    h = heuristic_scores(spark, sf)
    return M.top_revenue_at_risk(h, A.transactions(spark, sf, with_category=False))


# ---------------------------------------------------------------- op 57: scoring bands

BAND_SQL = HS_SQL + """,
banded AS (SELECT customer_id, score AS churn_probability,
                  CAST(score >= 0.5 AS INTEGER) AS churn_prediction,
                  CASE WHEN score < 0.3 THEN 'Low' WHEN score <= 0.6 THEN 'Medium' ELSE 'High' END AS risk_level
           FROM hs)"""


def banded(spark, sf):
    h = heuristic_scores(spark, sf).select("customer_id", F.col("score").alias("churn_probability"))
    return M.score_bands(h)


@register("score_bands", oracle("SELECT * FROM banded", ["churn_probability"], ctes=BAND_SQL))
def q_score_bands(spark, sf):
    return banded(spark, sf)


@register("score_band_summary", oracle("""
SELECT count(*) AS total, count(*) FILTER (WHERE risk_level = 'High') AS high_risk,
       count(*) FILTER (WHERE risk_level = 'Medium') AS medium_risk,
       count(*) FILTER (WHERE risk_level = 'Low') AS low_risk,
       count(*) FILTER (WHERE risk_level IS NULL) AS not_scored FROM banded""", ctes=BAND_SQL))
def q_score_band_summary(spark, sf):
    return M.band_summary(banded(spark, sf))


# ---------------------------------------------------------------- op 59: quality gates

@register("quality_gates", oracle("""
SELECT 'churn_roc_auc' AS gate, CAST(roc_auc AS DOUBLE) AS value, CAST(0.75 AS DOUBLE) AS threshold,
       CASE WHEN coalesce(roc_auc, 0) < 0.75 THEN 'WARNING' ELSE 'PASS' END AS status FROM auc
UNION ALL
SELECT 'forecast_mape', CAST(mape AS DOUBLE), CAST(25 AS DOUBLE),
       CASE WHEN coalesce(mape, 100) > 25 THEN 'WARNING' ELSE 'PASS' END FROM fa""",
                                  ["value", "threshold"], ctes=HS_SQL + ",\n" + _metrics_sql("score") + ",\n" + TS_SQL + """,
fa AS (SELECT coalesce(avg(abs((a - p) / a)) FILTER (WHERE a <> 0) * 100, 0) AS mape
       FROM (SELECT revenue AS a, lag(revenue) OVER (ORDER BY period) AS p FROM series) x WHERE p IS NOT NULL)"""))
def q_quality_gates(spark, sf):
    h = heuristic_scores(spark, sf)
    s = materialize(TS.revenue_timeseries(A.transactions(spark, sf, with_category=False)), "series")
    acc = M.forecast_accuracy(s.withColumnRenamed("revenue", "actual"), naive_predictions(s),
                              on=["period"])
    return M.quality_gates(M.auc_scores(h), acc)
