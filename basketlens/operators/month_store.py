"""Customer month states in bucketed tables: RFM measures of any months without a shuffle.

The store holds one row per customer and month (lines, revenue, last purchase), partitioned by
month and bucketed by customer; customers are bucketed alike. A customer's states merge by
sums and maxima inside their bucket, and the join with customers reads both tables bucket by
bucket, so neither needs an exchange, and months outside the range are not read. A corrected
month replaces its own partition only.

A customer with a third of all lines has one row per month here, since lines are combined
before they are bucketed: no bucket holds more rows than its customers times months.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import elapsed_days, safe_ratio, ts_literal
from ..session import materialize

CID = "customer_id"
STATES = "customer_months"
CUSTOMERS = "month_store_customers"
NO_MONTH = "none"
_MONTH = re.compile(r"\d{4,}-\d{2}|none")
_COLUMNS = (CID, "lines", "revenue", "last_purchase")


def month_rows(tx: DataFrame, revenue: str = "revenue", date_col: str = "transaction_date") -> DataFrame:
    """(customer_id, lines, revenue, last_purchase, month) of transaction lines; lines without
    a date are of month ``none``, a missing revenue adds nothing. One aggregate, combined
    before it shuffles."""
    month = F.coalesce(F.date_format(F.col(date_col), "yyyy-MM"), F.lit(NO_MONTH)).alias("month")
    return (tx.groupBy(CID, month).agg(F.count(F.lit(1)).alias("lines"), F.sum(revenue).alias("revenue"),
                                       F.max(date_col).alias("last_purchase"))
            .select(*_COLUMNS, "month"))


def create_store(tx: DataFrame, customers: DataFrame, database: str, buckets: int = 64, location: str | None = None) -> None:
    """Write both tables of the store into ``database`` (created if absent): states of all
    months of ``tx`` and the customers. Each bucket is one file per month."""
    spark = tx.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for rows, table, parts in ((month_rows(tx), STATES, ["month"]), (customers, CUSTOMERS, [])):
        w = rows.repartition(buckets, CID).write.mode("overwrite").format("parquet").bucketBy(buckets, CID).sortBy(CID)
        (w.partitionBy(*parts) if parts else w).saveAsTable(f"{database}.{table}")


def replace_month(spark: SparkSession, database: str, month: str, tx: DataFrame) -> None:
    """Replace the states of one month (``yyyy-MM`` or ``none``) by those of ``tx``, of which only
    lines of that month count; no lines empty it. The new states are written aside
    first: if ``tx`` fails, the month stays as it was."""
    if not _MONTH.fullmatch(month):
        raise ValueError(f"not a month: {month!r}")
    rows = materialize(month_rows(tx).where(F.col("month") == month).select(*_COLUMNS), "month")
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {database}.{STATES}").where("col_name = 'Num Buckets'").first()["data_type"])
    view = f"month_{uuid.uuid4().hex}"
    rows.repartition(buckets, CID).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {database}.{STATES} PARTITION (month = '{month}') SELECT {', '.join(_COLUMNS)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    spark.catalog.refreshTable(f"{database}.{STATES}")


def rfm_of_months(spark: SparkSession, database: str, snapshot, first: str | None = None, last: str | None = None,
                  customer_columns: tuple[str, ...] = ()) -> DataFrame:
    """RFM base measures (customer_id, recency_days, frequency, monetary_total, monetary_avg) of
    the months from ``first`` to ``last`` (both included, default all; a bound leaves out
    month ``none``), with columns of the customers. Lines of unknown customers are left out
    when such columns are asked. The plan has no exchange."""
    states = spark.table(f"{database}.{STATES}")
    if first is not None:
        states = states.where(F.col("month") >= first)
    if last is not None:
        states = states.where(F.col("month") <= last)
    if first is not None or last is not None:
        states = states.where(F.col("month") != NO_MONTH)
    merged = states.groupBy(CID).agg(F.max("last_purchase").alias("_last"), F.sum("lines").alias("frequency"),
                                     F.sum("revenue").alias("monetary_total"))
    if customer_columns:
        # both sides lie in buckets: a merge of buckets, whatever the sizes of the tables
        merged = merged.join(spark.table(f"{database}.{CUSTOMERS}").select(CID, *customer_columns).hint("merge"), CID)
    return merged.select(CID, elapsed_days(ts_literal(snapshot), F.col("_last")).alias("recency_days"), "frequency",
                         "monetary_total", safe_ratio("monetary_total", "frequency").alias("monetary_avg"), *customer_columns)
