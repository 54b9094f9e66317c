"""Model evaluation over (label, score) frames: threshold curve, classification metrics,
model comparison, forecast accuracy, revenue at risk, risk bands, quality gates
(ops 39-41, 51, 56, 57, 59).

Curves never enumerate pairs or thresholds x rows: AUCs come from running sums over the
distinct scores (exact, distributed ranking), the threshold grid from a 92-bin histogram.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_datetime, net_revenue, risk_band, ts_literal
from ..session import materialize, scalar
from .ranks import running_totals

CID = "customer_id"

# Threshold grid 0.05, 0.06, ..., 0.95 (91 points), generated like an
# arange: t_i = start + i * ((start + step) - start).
GRID_START = 0.05
GRID_STEP = 0.01
GRID_POINTS = 91
GRID_DELTA = (GRID_START + GRID_STEP) - GRID_START


def _div0(num, den):
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def _grid_t(i):
    return F.lit(GRID_START) + i.cast("double") * F.lit(GRID_DELTA)


# ---------------------------------------------------------------------------------------
# op 40: metrics at a threshold and AUCs


def score_counts(scored: DataFrame, label: str = "label", score: str = "score",
                 by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (one pass over the scored rows, written
    once; every curve and confusion count derives from it)."""
    per = scored.groupBy(*by, F.col(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    return materialize(per, "score-counts")


def _auc_from_counts(per: DataFrame, by: Sequence[str]) -> DataFrame:
    by = list(by)
    rt = running_totals(per, [F.col("_s").desc()], by, sums=["pos", "neg"], label="auc")
    tp, fp = F.col("_cum_pos"), F.col("_cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    P, N = F.col("_tot_pos"), F.col("_tot_neg")
    roc = (fp - fp0).cast("double") / N * (tp + tp0).cast("double") / P / 2.0
    prec = tp.cast("double") / (tp + fp)
    prec0 = F.when((tp0 + fp0) == 0, F.lit(1.0)).otherwise(tp0.cast("double") / (tp0 + fp0))
    pr = (tp - tp0).cast("double") / P * (prec + prec0) / 2.0
    out = rt.groupBy(*by).agg(F.sum(roc).alias("roc_auc"), F.sum(pr).alias("pr_auc"),
                              F.max(P).alias("_p"), F.max(N).alias("_n"))
    ok = (F.col("_p") > 0) & (F.col("_n") > 0)
    return out.select(*by, F.when(ok, F.col("roc_auc")).alias("roc_auc"),
                      F.when(ok, F.col("pr_auc")).alias("pr_auc"))


def auc_scores(scored: DataFrame, label: str = "label", score: str = "score",
               by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC and PR AUC (trapezoidal, PR curve starting at recall 0 / precision 1) per
    group; ties in the score form one curve step. Null when a class is absent."""
    return _auc_from_counts(score_counts(scored, label, score, by), by)


def _confusion_from_counts(per: DataFrame, threshold: float, by: Sequence[str]) -> DataFrame:
    pred = F.col("_s") >= F.lit(threshold)

    def s(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return per.groupBy(*by).agg(s(F.when(pred, F.col("pos"))).alias("tp"),
                                s(F.when(pred, F.col("neg"))).alias("fp"),
                                s(F.when(~pred | F.col("_s").isNull(), F.col("pos"))).alias("fn"),
                                s(F.when(~pred | F.col("_s").isNull(), F.col("neg"))).alias("tn"))


def confusion_counts(scored: DataFrame, label: str = "label", score: str = "score",
                     threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    pred = F.coalesce(F.col(score) >= F.lit(threshold), F.lit(False))
    y = F.col(label) == 1
    return scored.groupBy(*by).agg(F.count_if(y & pred).alias("tp"), F.count_if(~y & pred).alias("fp"),
                                   F.count_if(y & ~pred).alias("fn"), F.count_if(~y & ~pred).alias("tn"))


def _rates(tp, fp, fn, tn):
    p = tp + fn
    n = fp + tn
    recall = _div0(tp, p)
    spec = _div0(tn, n)
    bal = (F.when((p > 0) & (n > 0), (recall + spec) / 2.0)
           .when(p > 0, recall).otherwise(spec))
    return {
        "accuracy": _div0(tp + tn, p + n),
        "precision": _div0(tp, tp + fp),
        "recall": recall,
        "f1": _div0(2 * tp, 2 * tp + fp + fn),
        "balanced_accuracy": bal,
    }


def classification_metrics(scored: DataFrame, label: str = "label", score: str = "score",
                           threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """roc_auc, pr_auc, accuracy, precision, recall, f1, balanced_accuracy and the
    confusion matrix (tn, fp, fn, tp) at ``threshold`` (predict 1 when score >= threshold).
    One pass over the scored rows: everything derives from the per-score counts."""
    by = list(by)
    per = score_counts(scored, label, score, by)
    cm = _confusion_from_counts(per, threshold, by)
    r = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    cm = cm.select(*by, *[v.alias(k) for k, v in r.items()], "tn", "fp", "fn", "tp")
    aucs = _auc_from_counts(per, by)
    if by:
        return aucs.join(cm, by)
    from .stattests import _join_all
    return _join_all([aucs, cm], [])


def classification_report(scored: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = 0.5) -> DataFrame:
    """Per class (0 and 1): precision, recall, f1, support."""
    cm = confusion_counts(scored, label, score, threshold)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    one = cm.select(F.lit(1).alias("class"), _div0(tp, tp + fp).alias("precision"),
                    _div0(tp, tp + fn).alias("recall"), _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    (tp + fn).alias("support"))
    zero = cm.select(F.lit(0).alias("class"), _div0(tn, tn + fn).alias("precision"),
                     _div0(tn, tn + fp).alias("recall"), _div0(2 * tn, 2 * tn + fn + fp).alias("f1"),
                     (tn + fp).alias("support"))
    return one.unionByName(zero)


# ---------------------------------------------------------------------------------------
# op 39: threshold curve


def threshold_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """precision, recall, f1 and balanced accuracy at thresholds 0.05..0.95 (step 0.01).

    Each score is binned by how many grid thresholds it reaches (0..91); the 92-row
    histogram's suffix sums give the confusion counts of every threshold at once. A null
    score reaches no threshold: it is a predicted negative, as in the confusion counts.
    """
    spark = scored.sparkSession
    s = F.col(score).cast("double")
    k0 = F.floor((s - F.lit(GRID_START)) / F.lit(GRID_DELTA))
    c = F.least(F.greatest(k0 + 1, F.lit(0)), F.lit(GRID_POINTS))
    # exact correction against the generated grid values
    c = F.when((c < GRID_POINTS) & (_grid_t(c) <= s), c + 1).otherwise(c)
    c = F.when((c > 0) & (_grid_t(c - 1) > s), c - 1).otherwise(c)
    hist = scored.groupBy(F.when(s.isNull(), F.lit(0)).otherwise(c).alias("bin")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    bins = spark.range(GRID_POINTS + 1).select(F.col("id").alias("bin"))
    full = F.broadcast(bins).join(hist, "bin", "left").na.fill(0, ["pos", "neg"])
    suffix = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    total = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding,
                                                            Window.unboundedFollowing)
    full = full.select("bin", F.sum("pos").over(suffix).alias("tp"),
                       F.sum("neg").over(suffix).alias("fp"),
                       F.sum("pos").over(total).alias("P"), F.sum("neg").over(total).alias("N"))
    # threshold i predicts positive for bins >= i + 1
    curve = full.where(F.col("bin") >= 1).select(
        (F.col("bin") - 1).alias("i"), "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"),
        (F.col("N") - F.col("fp")).alias("tn"))
    r = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return curve.select(_grid_t(F.col("i")).alias("threshold"), r["precision"].alias("precision"),
                        r["recall"].alias("recall"), r["f1"].alias("f1"),
                        r["balanced_accuracy"].alias("balanced_accuracy"))


def optimal_threshold(curve: DataFrame, metric: str = "f1") -> DataFrame:
    """First (lowest) threshold reaching the maximum of ``metric``."""
    best = curve.agg(F.min(F.struct((-F.col(metric)).alias("neg"), F.col("threshold").alias("t")))
                     .alias("b"))
    return best.select(F.col("b.t").alias("optimal_threshold"),
                       (-F.col("b.neg")).alias("optimal_metric_value"))


# ---------------------------------------------------------------------------------------
# op 41: model comparison


def compare_models(scored: DataFrame, model_col: str = "model_name", label: str = "label",
                   score: str = "score", threshold: float = 0.5) -> DataFrame:
    """Metrics per model (scored frames unioned with a model name), best ROC AUC first."""
    m = classification_metrics(scored, label, score, threshold, by=[model_col])
    return m.select(model_col, "roc_auc", "pr_auc", "f1", "precision", "recall",
                    "balanced_accuracy").orderBy(F.col("roc_auc").desc_nulls_last(), model_col)


# ---------------------------------------------------------------------------------------
# op 51: forecast accuracy


def forecast_accuracy(actual: DataFrame, predicted: DataFrame, on: Sequence[str],
                      actual_col: str = "actual", predicted_col: str = "predicted",
                      by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, MAPE (%; zero actuals skipped), sMAPE (%; zero denominators skipped) and
    R^2 (0 for fewer than two points) on the keys present in both; zeros without overlap."""
    by = list(by)
    j = (actual.select(*on, F.col(actual_col).alias("_a"))
         .join(predicted.select(*on, F.col(predicted_col).alias("_p")), list(on))
         .where(F.col("_a").isNotNull() & F.col("_p").isNotNull()
                & ~F.isnan("_a") & ~F.isnan("_p")))
    err = F.col("_a") - F.col("_p")
    den = F.abs("_a") + F.abs("_p")
    agg = j.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.when(F.col("_a") != 0, F.abs(err / F.col("_a")))).alias("_mape"),
        F.avg(F.when(den != 0, 2.0 * F.abs(err) / den)).alias("_smape"),
        F.sum(err * err).alias("_ssr"), (F.var_pop("_a") * F.count(F.lit(1))).alias("_sst"))
    r2 = (F.when(F.col("n") < 2, F.lit(0.0))
          .when(F.col("_sst") == 0, F.when(F.col("_ssr") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(1.0 - F.col("_ssr") / F.col("_sst")))
    return agg.select(*by, F.col("n").cast("long"),
                      F.coalesce("mae", F.lit(0.0)).alias("mae"),
                      F.coalesce("rmse", F.lit(0.0)).alias("rmse"),
                      F.coalesce(F.col("_mape") * 100.0, F.lit(0.0)).alias("mape"),
                      F.coalesce(F.col("_smape") * 100.0, F.lit(0.0)).alias("smape"),
                      r2.alias("r2"))


# ---------------------------------------------------------------------------------------
# op 56: revenue at risk


def revenue_12m(tx: DataFrame, days: int = 365, date_col: str = "transaction_date",
                revenue: str | None = None) -> DataFrame:
    """Net revenue per customer since (latest transaction - ``days``), inclusive."""
    latest = as_datetime(scalar(tx.agg(F.max(date_col))))
    cutoff = latest - _dt.timedelta(days=days)
    rev = F.col(revenue) if revenue else net_revenue()
    return (tx.where(F.col(date_col) >= ts_literal(cutoff))
            .groupBy(CID).agg(F.sum(rev).alias("revenue_12m")))


def churn_candidates(scored: DataFrame, tx: DataFrame, threshold: float = 0.5,
                     score: str = "score") -> DataFrame:
    """Predicted churners (score >= threshold) with their 12-month net revenue (0 if none)."""
    churners = scored.where(F.col(score) >= F.lit(threshold)).select(CID)
    return (churners.join(revenue_12m(tx), CID, "left")
            .select(CID, F.coalesce("revenue_12m", F.lit(0.0)).alias("revenue_12m")))


def revenue_at_risk(scored: DataFrame, tx: DataFrame, threshold: float = 0.5,
                    score: str = "score") -> DataFrame:
    """One row: predicted_churners_count, avg_revenue_per_churner_12m,
    total_revenue_at_risk, potential_save_revenue_30pct, potential_save_revenue_50pct."""
    c = churn_candidates(scored, tx, threshold, score)
    agg = c.agg(F.count(F.lit(1)).alias("predicted_churners_count"),
                F.coalesce(F.avg("revenue_12m"), F.lit(0.0)).alias("avg_revenue_per_churner_12m"),
                F.coalesce(F.sum("revenue_12m"), F.lit(0.0)).alias("total_revenue_at_risk"))
    return agg.select("predicted_churners_count", "avg_revenue_per_churner_12m",
                      "total_revenue_at_risk",
                      (F.col("total_revenue_at_risk") * 0.30).alias("potential_save_revenue_30pct"),
                      (F.col("total_revenue_at_risk") * 0.50).alias("potential_save_revenue_50pct"))


def top_revenue_at_risk(scored: DataFrame, tx: DataFrame, threshold: float = 0.5, n: int = 10,
                        score: str = "score") -> DataFrame:
    """The ``n`` predicted churners with the most 12-month revenue (ties by customer_id)."""
    c = churn_candidates(scored, tx, threshold, score)
    return c.orderBy(F.col("revenue_12m").desc(), F.col(CID)).limit(n)


# ---------------------------------------------------------------------------------------
# op 57: batch scoring


def score_bands(scored: DataFrame, probability: str = "churn_probability",
                threshold: float = 0.5) -> DataFrame:
    """Add churn_prediction (probability >= threshold) and risk_level (Low/Medium/High)."""
    return (scored.withColumn("churn_prediction", (F.col(probability) >= F.lit(threshold)).cast("int"))
            .withColumn("risk_level", risk_band(probability)))


def band_summary(banded: DataFrame) -> DataFrame:
    """One row: total, high_risk, medium_risk, low_risk, not_scored (no probability)."""
    r = F.col("risk_level")
    return banded.agg(F.count(F.lit(1)).alias("total"), F.count_if(r == "High").alias("high_risk"),
                      F.count_if(r == "Medium").alias("medium_risk"),
                      F.count_if(r == "Low").alias("low_risk"), F.count_if(r.isNull()).alias("not_scored"))


# ---------------------------------------------------------------------------------------
# op 59: quality gates

# The gates of the model report.
AUC_GATE = 0.75
MAPE_GATE = 25.0


def quality_gates(roc_auc: DataFrame, mape: DataFrame) -> DataFrame:
    """Rows (gate, value, threshold, status): ROC AUC >= 0.75 and MAPE <= 25 pass, else WARNING.
    Inputs are one-row frames with columns ``roc_auc`` and ``mape``."""
    a = roc_auc.select(F.lit("churn_roc_auc").alias("gate"), F.col("roc_auc").alias("value"),
                       F.lit(AUC_GATE).alias("threshold"),
                       F.when(F.coalesce(F.col("roc_auc"), F.lit(0.0)) < AUC_GATE, "WARNING")
                       .otherwise("PASS").alias("status"))
    m = mape.select(F.lit("forecast_mape").alias("gate"), F.col("mape").alias("value"),
                    F.lit(MAPE_GATE).alias("threshold"),
                    F.when(F.coalesce(F.col("mape"), F.lit(100.0)) > MAPE_GATE, "WARNING")
                    .otherwise("PASS").alias("status"))
    return a.unionByName(m)
