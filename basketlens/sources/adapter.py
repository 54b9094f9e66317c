"""View layer from the TPC-H-shaped test tables to the shop data model.

The operators take column names; this module only maps the given tables onto the
customers / transactions / events / products model (mapping in FIXTURES.md §2).
Everything is lazy except :func:`last_order_date`, a one-value aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import elapsed_days, net_revenue, ts_literal
from ..session import scalar

# Snapshots that fit the test tables (orders end 2001-08-01,
# events cover 2024-01-01..2024-01-30).
TX_SNAPSHOT = "2001-08-01"
EVENT_SNAPSHOT = "2024-01-31"

# Churn label rule (frequency below 8 and recency above 180 days).
LABEL_MAX_FREQUENCY = 8
LABEL_MIN_RECENCY_DAYS = 180

# Adapter code tables.
GENDERS = ["M", "F", "Other"]                      # by c_nationkey % 3
DEVICE_TYPES = ["mobile", "desktop", "tablet"]     # by props.k % 3
PAGE_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]  # by props.k % 6
EVENT_TYPES = {
    "view": "page_view",
    "click": "add_to_cart",
    "purchase": "purchase",
    "signup": "wishlist_add",
    "error": "search",
}
PREMIUM_MIN_BALANCE = 5000.0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(values: list[str], index) -> "F.Column":
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def last_order_date(spark: SparkSession, sf_dir: str):
    """Latest order timestamp (one value; the label rule measures recency from it)."""
    return scalar(read_table(spark, sf_dir, "orders").agg(F.max("o_orderdate")))


def order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: first and last order date and order count (one partial aggregate)."""
    return (read_table(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(F.min("o_orderdate").alias("signup_date"),
                 F.max("o_orderdate").alias("last_order"),
                 F.count(F.lit(1)).alias("n_orders")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, signup_date, age, gender, city, acquisition_channel, is_premium, churn_label.

    churn_label applies the label rule on order grain; customers without orders get 0.
    """
    latest = last_order_date(spark, sf_dir)
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    orders = order_summary(spark, sf_dir)
    c = read_table(spark, sf_dir, "customer")
    joined = (c.join(nation, c.c_nationkey == nation.n_nationkey, "left")
              .join(orders, c.c_custkey == orders.customer_id, "left"))
    recency = elapsed_days(ts_literal(latest), F.col("last_order"))
    label = F.coalesce(((F.col("n_orders") < LABEL_MAX_FREQUENCY)
                        & (recency > LABEL_MIN_RECENCY_DAYS)).cast("int"), F.lit(0))
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("signup_date"),
        F.col("c_acctbal").alias("age"),
        _lookup(GENDERS, F.col("c_nationkey") % 3).alias("gender"),
        F.col("city"),
        F.col("c_mktsegment").alias("acquisition_channel"),
        (F.col("c_acctbal") >= PREMIUM_MIN_BALANCE).alias("is_premium"),
        label.alias("churn_label"),
    )


def transactions(spark: SparkSession, sf_dir: str, with_category: bool = True) -> DataFrame:
    """One row per lineitem row.

    ``transaction_id`` is ``orderkey-linenumber`` and is NOT unique in the test data; the
    operators count rows and never deduplicate on it. The join to ``part`` is only planned
    when the category is needed.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if with_category:
        part = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("category"))
        # left: a line whose product is missing stays, as it does without the category. Before the
        # orders: lines of an order then lie together, so sums per order combine before they shuffle
        li = li.join(part, li.l_partkey == part.p_partkey, "left")
    tx = li.join(o, li.l_orderkey == o.o_orderkey)
    cols = [
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("l_partkey").alias("product_id"),
    ]
    if with_category:
        cols.append(F.col("category"))
    cols += [
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_discount").alias("discount_pct"),
        F.col("o_orderpriority").alias("payment_method"),
        (F.col("l_returnflag") == "R").cast("int").alias("return_flag"),
    ]
    out = tx.select(*cols)
    return out.withColumn("revenue", net_revenue())


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, customer_id, event_ts (untruncated), event_date (day), event_type,
    session_duration_sec, device_type, page_category."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    etype = None
    for src, dst in EVENT_TYPES.items():
        etype = (F.when(F.col("event_type") == src, dst) if etype is None
                 else etype.when(F.col("event_type") == src, dst))
    return e.select(
        F.col("event_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("event_ts"),
        F.to_date(F.col("ts")).cast("timestamp_ntz").alias("event_date"),
        etype.alias("event_type"),
        F.col("value").alias("session_duration_sec"),
        _lookup(DEVICE_TYPES, k % 3).alias("device_type"),
        _lookup(PAGE_CATEGORIES, k % 6).alias("page_category"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("base_price"),
        F.col("p_brand").alias("brand_tier"),
    )
