"""Declared schemas of the shop data model (op 3). NOT NULL becomes nullable=False; keys
are checked by ``operators.quality`` since Spark does not enforce them."""

from __future__ import annotations

from pyspark.sql import types as T

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("base_price", T.DoubleType(), False),
    T.StructField("brand_tier", T.StringType(), False),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("signup_date", T.TimestampNTZType(), True),
    T.StructField("age", T.DoubleType(), False),
    T.StructField("gender", T.StringType(), False),
    T.StructField("city", T.StringType(), False),
    T.StructField("acquisition_channel", T.StringType(), False),
    T.StructField("is_premium", T.BooleanType(), False),
    T.StructField("churn_label", T.IntegerType(), False),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("transaction_date", T.TimestampNTZType(), False),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("category", T.StringType(), False),
    T.StructField("quantity", T.DoubleType(), False),
    T.StructField("unit_price", T.DoubleType(), False),
    T.StructField("discount_pct", T.DoubleType(), False),
    T.StructField("payment_method", T.StringType(), False),
    T.StructField("return_flag", T.IntegerType(), False),
    T.StructField("revenue", T.DoubleType(), True),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("event_ts", T.TimestampNTZType(), True),
    T.StructField("event_date", T.TimestampNTZType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("session_duration_sec", T.DoubleType(), False),
    T.StructField("device_type", T.StringType(), False),
    T.StructField("page_category", T.StringType(), False),
])

SCHEMAS = {"products": PRODUCTS, "customers": CUSTOMERS, "transactions": TRANSACTIONS,
           "events": EVENTS}
