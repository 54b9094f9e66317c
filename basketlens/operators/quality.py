"""Integrity checks standing in for PK / FK / NOT NULL constraints, which Spark does not
enforce. Each check is one aggregate; the report is their union (rule, violations)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _row(rule: str, agg: DataFrame) -> DataFrame:
    return agg.select(F.lit(rule).alias("rule"), F.col("violations").cast("long"))


def unique(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return _row(f"{table}.{'+'.join(keys)} unique", dup.agg(F.count(F.lit(1)).alias("violations")))


def not_null(table: str, df: DataFrame, column: str) -> DataFrame:
    """Number of rows where ``column`` is null."""
    return _row(f"{table}.{column} not null",
                df.agg(F.count_if(F.col(column).isNull()).alias("violations")))


def references(table: str, df: DataFrame, column: str, parent: str, parent_df: DataFrame,
               parent_key: str) -> DataFrame:
    """Number of rows whose non-null ``column`` has no match in the parent key. Rows are
    counted per key first (map-side combine), so a key with many rows is one row in the
    anti join."""
    keys = parent_df.select(F.col(parent_key).alias("_k")).distinct()
    counts = (df.select(F.col(column).alias("_k")).where(F.col("_k").isNotNull())
              .groupBy("_k").agg(F.count(F.lit(1)).alias("_n")))
    orphans = counts.join(keys, "_k", "left_anti")
    return _row(f"{table}.{column} references {parent}",
                orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")))


def integrity_report(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
