"""Mergeable column profiles: sketch states per month, written once and merged on read.

A state holds counts, a sum, the extremes, a HyperLogLog sketch of the values and a KLL
sketch of their ranks. States of any months merge into the profile of all their rows, so a
profile of a new month range reads states of a few kilobytes per month and column instead
of the fact table, and a corrected month replaces only its own partition.

Stated errors: a distinct count is off by less than ``distinct_bound`` (three standard
errors of the HyperLogLog sketch), a quantile's rank by less than ``rank_bound``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .selection import valid

LG_K = 14    # 2^14 registers: one standard error is 1.04 / 128
RANK_K = 400  # KLL accuracy


def distinct_bound(lg_k: int = LG_K) -> float:
    """Relative error of a distinct count that three standard errors allow."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def rank_bound(k: int = RANK_K) -> float:
    """Error of a quantile's rank, as a share of the rows (99 percent confidence, doubled for
    ranks asked together)."""
    return 2 * 2.296 / k ** 0.9021


def _state(column: str, numeric: bool, lg_k: int, k: int) -> dict[str, Column]:
    value = valid(column) if numeric else F.col(f"`{column}`").cast("string")
    number = value if numeric else F.lit(None).cast("double")
    hashed = F.when(value.isNotNull(), F.xxhash64(value))
    return {"rows": F.count(F.lit(1)), "valid": F.count(value), "total": F.sum(number), "least": F.min(number), "greatest": F.max(number),
            "distinct": F.hll_sketch_agg(hashed, F.lit(lg_k)), "ranks": F.kll_sketch_agg_double(number, F.lit(k))}


def month_states(df: DataFrame, time_col: str, numeric: Sequence[str], other: Sequence[str] = (), lg_k: int = LG_K,
                 k: int = RANK_K) -> DataFrame:
    """(month, column, rows, valid, total, least, greatest, distinct, ranks): one row per month
    (``yyyy-MM``; rows without a time: ``none``) and column, from one aggregate over ``df``
    that combines before it shuffles. Nulls and NaN are rows, not values."""
    month = F.coalesce(F.date_format(F.col(f"`{time_col}`"), "yyyy-MM"), F.lit("none")).alias("month")
    columns = [*((c, True) for c in numeric), *((c, False) for c in other)]
    aggs, items = [], []
    for i, (c, is_numeric) in enumerate(columns):
        state = _state(c, is_numeric, lg_k, k)
        aggs += [a.alias(f"_{i}_{x}") for x, a in state.items()]
        items.append(F.struct(F.lit(c).alias("column"), *(F.col(f"_{i}_{x}").alias(x) for x in state)))
    return df.groupBy(month).agg(*aggs).select("month", F.inline(F.array(*items)))


def write_states(states: DataFrame, path: str) -> None:
    """Replace the months that ``states`` holds under ``path``; other months stay. The mode is
    the writer's own option, so no session setting changes."""
    (states.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").parquet(path))


def read_states(spark, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """States of the months from ``first`` to ``last`` (both included); other months'
    partitions are not read."""
    states = spark.read.option("basePath", path).schema(
        "column string, rows long, valid long, total double, least double, greatest double, distinct binary, ranks binary, month string").parquet(path)
    if first is not None:
        states = states.where(F.col("month") >= first)
    if last is not None:
        states = states.where(F.col("month") <= last)
    return states


def merged_profile(states: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column over all given states: rows, missing_pct, mean, least, greatest,
    approx_distinct and approx_q_<i> for each prob. Numbers that need values are null where
    there is none."""
    merged = states.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("valid").alias("valid"), F.sum("total").alias("total"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("ranks").alias("ranks"))
    some = F.col("greatest").isNotNull()
    return merged.select(
        "column", "rows", ((F.col("rows") - F.col("valid")) * 100.0 / F.col("rows")).alias("missing_pct"),
        F.when(some, F.col("total") / F.col("valid")).alias("mean"), "least", "greatest",
        F.hll_sketch_estimate("distinct").alias("approx_distinct"),
        *(F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(float(p)))).alias(f"approx_q_{i}") for i, p in enumerate(probs)))
