"""Descriptive analysis: column profile, churn summary, monthly revenue, cohort retention,
IQR outliers (ops 25-29)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import gross_revenue, return_adjusted_revenue
from ..session import materialize
from .selection import exact_quantiles_of, extent, valid

CID = "customer_id"


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType) and not isinstance(dt, T.BooleanType)


# ---------------------------------------------------------------------------------------
# op 25: column profile


def distinct_counts(df: DataFrame, numeric: Sequence[str], other: Sequence[str] = ()) -> dict[str, int]:
    """Exact numbers of distinct values per column (nulls and, in ``numeric``, NaN are none), from
    one aggregate of (column, value) that combines before it shuffles: a row holds one value."""
    null = F.lit(None)
    items = [F.struct(F.lit(i).alias("k"), valid(c).alias("num"), null.cast("string").alias("str")) for i, c in enumerate(numeric)]
    items += [F.struct(F.lit(len(numeric) + i).alias("k"), null.cast("double").alias("num"), F.col(f"`{c}`").cast("string").alias("str"))
              for i, c in enumerate(other)]
    if not items:
        return {}
    got = {r["k"]: r["n"] for r in df.select(F.inline(F.array(*items))).where("num is not null or str is not null")
           .groupBy("k", "num", "str").agg(F.lit(1)).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: got.get(i, 0) for i, c in enumerate([*numeric, *other])}


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: mean, median, std (sample), skewness and excess kurtosis (both
    bias-corrected, G1 / G2), missing_pct, unique_count. Moments only for numeric,
    non-boolean columns; constant columns get skewness = kurtosis = 0.

    Counts, missing values, least, greatest and all moments come from one aggregate;
    medians by histogram refinement (``selection``), which shuffles bins; distinct counts
    from one aggregate of (column, value) that combines before it shuffles. No column is
    sorted. The profiled columns are written once, so that what ``df`` is made of (joins) runs
    once and not once per scan. The result has one row per column and is built from these
    few numbers.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if _is_numeric(fields[c])]
    other = [c for c in columns if c not in numeric]
    session = df.sparkSession
    df = materialize(df.select(*[valid(c).alias(f"n{i}") for i, c in enumerate(numeric)],
                               *[F.col(f"`{c}`").cast("string").alias(f"s{i}") for i, c in enumerate(other)]), "profile")
    names, numeric, other = [*numeric, *other], [f"n{i}" for i in range(len(numeric))], [f"s{i}" for i in range(len(other))]
    aggs = [F.count(F.lit(1)).alias("total"), *extent(numeric)]
    for i, c in enumerate(numeric):
        v = valid(c)
        aggs += [F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"), F.skewness(v).alias(f"skew{i}"), F.kurtosis(v).alias(f"kurt{i}")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"_s{i}") for i, c in enumerate(other)]
    row = df.agg(*aggs).first()
    distinct = distinct_counts(df, numeric, other)
    medians = exact_quantiles_of(df, numeric, [0.5], row)
    total, out = row["total"], []
    for i, c in enumerate(numeric):
        n, skew, kurt = row[f"_n{i}"], None, None
        constant = n and row[f"_lo{i}"] == row[f"_hi{i}"]
        if n >= 3:
            skew = 0.0 if constant else math.sqrt(n * (n - 1)) / (n - 2) * row[f"skew{i}"]
        if n >= 4:
            kurt = 0.0 if constant else (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * row[f"kurt{i}"] + 6)
        std = None if n < 2 else 0.0 if constant else row[f"std{i}"]
        out.append((names[i], row[f"mean{i}"], medians[c].values[0], std, skew, kurt, (total - n) * 100.0 / total if total else None, distinct[c]))
    for i, c in enumerate(other):
        out.append((names[len(numeric) + i], None, None, None, None, None, (total - row[f"_s{i}"]) * 100.0 / total if total else None, distinct[c]))
    return session.createDataFrame(out, "column string, mean double, median double, std double, skewness double, kurtosis double, "
                                                "missing_pct double, unique_count long")


# ---------------------------------------------------------------------------------------
# op 26: churn summary


def churn_summary(customers: DataFrame, dims: Sequence[str] = ("acquisition_channel", "gender",
                                                              "is_premium")) -> DataFrame:
    """Long summary in one GROUPING SETS pass: dimension ('all', each of ``dims``, and
    'churn_label'), level, customers, churned, churn_rate, mean_age."""
    cols = [F.col(d).cast("string").alias(d) for d in dims]
    base = customers.select(*cols, F.col("churn_label").cast("string").alias("label_level"),
                            F.col("churn_label").cast("long").alias("_y"),
                            F.col("age").cast("double").alias("_age"))
    keys = list(dims) + ["label_level"]
    sets = [[]] + [[F.col(k)] for k in keys]
    g = base.groupingSets(sets, *keys).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("_y").alias("churned"),
        F.avg("_y").alias("churn_rate"), F.avg("_age").alias("mean_age"),
        *[F.grouping(k).alias(f"_g_{k}") for k in keys])
    dim = F.lit("all")
    level = F.lit("all")
    for k in keys:
        name = "churn_label" if k == "label_level" else k
        dim = F.when(F.col(f"_g_{k}") == 0, F.lit(name)).otherwise(dim)
        level = F.when(F.col(f"_g_{k}") == 0, F.col(k)).otherwise(level)
    return g.select(dim.alias("dimension"), level.alias("level"), "customers",
                    F.col("churned").cast("long"), "churn_rate", "mean_age")


# ---------------------------------------------------------------------------------------
# op 27: monthly revenue


def monthly_revenue(tx: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """Per yyyy-MM: total_revenue (gross), transaction_count, unique_customers,
    avg_order_value, return_adjusted_revenue; sorted by month, no gap fill."""
    g = gross_revenue()
    out = tx.groupBy(F.date_format(date_col, "yyyy-MM").alias("year_month")).agg(
        F.sum(g).alias("total_revenue"), F.count(F.lit(1)).alias("transaction_count"),
        F.count_distinct(CID).alias("unique_customers"),
        F.sum(return_adjusted_revenue(g)).alias("return_adjusted_revenue"))
    return out.select("year_month", "total_revenue", "transaction_count", "unique_customers",
                      (F.col("total_revenue") / F.col("transaction_count")).alias("avg_order_value"),
                      "return_adjusted_revenue").orderBy("year_month")


# ---------------------------------------------------------------------------------------
# op 28: cohort retention


def cohort_retention(customers: DataFrame, tx: DataFrame, pivot: bool = False,
                     date_col: str = "transaction_date") -> DataFrame:
    """Long (cohort_month, period_idx, retention_rate): distinct active customers / cohort
    size by calendar-month offset from the signup month. Cohorts without transactions do not
    appear; period 0 is 1.0 for every cohort that appears. ``pivot=True`` returns the
    matrix (one column per period)."""
    c = customers.where(F.col("signup_date").isNotNull()).select(
        CID, F.date_format("signup_date", "yyyy-MM").alias("cohort_month"),
        (F.year("signup_date") * 12 + F.month("signup_date") - 1).alias("_c_ym")).distinct()
    sizes = c.groupBy("cohort_month").agg(F.count_distinct(CID).alias("_size"))
    # pre-aggregate to distinct (customer, month) before joining: a customer with a huge
    # share of the transactions shrinks to one row per active month
    d = F.col(date_col)
    active_months = tx.where(d.isNotNull()).select(CID, (F.year(d) * 12 + F.month(d) - 1).alias("_t_ym")).distinct()
    t = active_months.join(c, CID)
    active = t.groupBy("cohort_month", (F.col("_t_ym") - F.col("_c_ym")).alias("period_idx")).agg(
        F.count(F.lit(1)).alias("_active"))
    rates = active.join(sizes, "cohort_month").select(
        "cohort_month", "period_idx", (F.col("_active") / F.col("_size")).alias("retention_rate"))
    # every active row also emits (cohort, 0, 1.0); the max per cell forces period 0 to 1.0
    # and keeps each cohort that appears, in the same pass
    both = rates.select("cohort_month", F.explode(F.array(
        F.struct(F.col("period_idx").alias("p"), F.col("retention_rate").alias("r")),
        F.struct(F.lit(0).alias("p"), F.lit(1.0).alias("r")))).alias("x"))
    out = both.groupBy("cohort_month", F.col("x.p").alias("period_idx")).agg(
        F.max("x.r").alias("retention_rate"))
    if pivot:
        periods = sorted(r[0] for r in out.select("period_idx").distinct().collect())
        return out.groupBy("cohort_month").pivot("period_idx", periods).agg(
            F.first("retention_rate")).orderBy("cohort_month")
    return out


# ---------------------------------------------------------------------------------------
# op 29: IQR outliers


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """One row: q1, q3, iqr, lower_bound, upper_bound, outlier_count (strictly outside),
    outlier_pct (share of non-null values); all zero for an empty column.

    Exact quartiles by histogram refinement (``selection``); the outliers are counted by one
    further aggregate. Nothing is sorted; the one column is written once, so that what ``df``
    is made of (joins) runs once and not once per scan.
    """
    df, column = materialize(df.select(valid(column).alias("v")), "outliers"), "v"
    q = exact_quantiles_of(df, [column], [0.25, 0.75])[column]
    schema = ("q1 double, q3 double, iqr double, lower_bound double, upper_bound double, "
              "outlier_count long, outlier_pct double")
    if not q.n:
        return df.sparkSession.createDataFrame([(0.0, 0.0, 0.0, 0.0, 0.0, 0, 0.0)], schema)
    q1, q3 = q.values
    iqr = q3 - q1
    lo, hi = q1 - k * iqr, q3 + k * iqr
    v = valid(column)
    return df.agg(F.count_if((v < lo) | (v > hi)).alias("outlier_count")).select(
        F.lit(q1).alias("q1"), F.lit(q3).alias("q3"), F.lit(iqr).alias("iqr"), F.lit(lo).alias("lower_bound"), F.lit(hi).alias("upper_bound"),
        F.col("outlier_count").cast("long"), (F.col("outlier_count") / F.lit(q.n)).alias("outlier_pct"))
