"""Registered queries: sources, derived measures and customer features (ops 1, 4-24, 34)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.columns import gross_revenue, return_adjusted_revenue
from ..operators import features as FT
from ..operators import quality as Q
from ..session import materialize
from ..sources import adapter as A
from .catalog import register
from .sqlkit import days, oracle, ts

TX_SNAP = A.TX_SNAPSHOT
EV_SNAP = A.EVENT_SNAPSHOT


def _minus_days(snapshot: str, n: int) -> str:
    return (_dt.datetime.fromisoformat(snapshot) - _dt.timedelta(days=n)).isoformat(sep=" ")


def mode_ctes(name: str, table: str, col: str, key: str = "customer_id") -> str:
    """CTE ``name`` (key, val): most frequent non-null value, ties -> smallest."""
    return f"""{name} AS (
  SELECT {key}, val FROM (
    SELECT {key}, val, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, val) AS rn
    FROM (SELECT {key}, CAST({col} AS VARCHAR) AS val, count(*) AS n FROM {table}
          WHERE {col} IS NOT NULL GROUP BY {key}, val) AS c) AS r
  WHERE rn = 1)"""


# ---------------------------------------------------------------- op 1: scans of the views

@register("shop_customers", oracle(
    "SELECT customer_id, signup_date, age, gender, city, acquisition_channel, is_premium, "
    "churn_label FROM shop_customers", ["age"]))
def q_shop_customers(spark, sf):
    return A.customers(spark, sf)


@register("shop_transactions", oracle(
    "SELECT transaction_id, customer_id, transaction_date, product_id, category, quantity, "
    "unit_price, discount_pct, payment_method, return_flag, revenue FROM shop_tx",
    ["quantity", "unit_price", "discount_pct", "revenue"]))
def q_shop_transactions(spark, sf):
    return A.transactions(spark, sf)


@register("shop_events", oracle(
    "SELECT event_id, customer_id, event_ts, event_date, event_type, session_duration_sec, "
    "device_type, page_category FROM shop_events", ["session_duration_sec"]))
def q_shop_events(spark, sf):
    return A.events(spark, sf)


# ---------------------------------------------------------------- op 2: sink round trip

@register("customers_sink_roundtrip", oracle(
    "SELECT customer_id, signup_date, age, gender, city, acquisition_channel, is_premium, "
    "churn_label, CAST(count(*) OVER () AS BIGINT) AS rows_written FROM shop_customers", ["age"]))
def q_sink_roundtrip(spark, sf):
    """Replace a table under this application's folder by a part of the customers, append
    the rest; the rows read back carry the number of rows written."""
    import uuid

    from ..session import app_folder
    from ..sources import io as IO
    path = f"{app_folder(spark)}/sink-{uuid.uuid4().hex}"
    cust = A.customers(spark, sf)
    even = F.coalesce(F.col("customer_id") % 2 == 0, F.lit(False))
    IO.write_table(cust, path, "overwrite")
    n = IO.write_table(cust.where(even), path, "overwrite") + IO.write_table(cust.where(~even), path, "append")
    return IO.scan(spark, path).withColumn("rows_written", F.lit(n).cast("long"))


# ---------------------------------------------------------------- op 4: integrity report

@register("integrity_report", oracle("""
SELECT 'customers.customer_id unique' AS rule, CAST(count(*) AS BIGINT) AS violations
  FROM (SELECT customer_id FROM shop_customers GROUP BY customer_id HAVING count(*) > 1) d
UNION ALL SELECT 'customers.customer_id not null', count(*) FILTER (WHERE customer_id IS NULL) FROM shop_customers
UNION ALL SELECT 'customers.signup_date not null', count(*) FILTER (WHERE signup_date IS NULL) FROM shop_customers
UNION ALL SELECT 'transactions.transaction_id unique', count(*)
  FROM (SELECT transaction_id FROM shop_tx GROUP BY transaction_id HAVING count(*) > 1) d
UNION ALL SELECT 'transactions.customer_id references customers', count(*)
  FROM shop_tx t WHERE t.customer_id IS NOT NULL
   AND NOT EXISTS (SELECT 1 FROM shop_customers c WHERE c.customer_id = t.customer_id)
UNION ALL SELECT 'transactions.product_id references products', count(*)
  FROM shop_tx t WHERE t.product_id IS NOT NULL
   AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = t.product_id)
UNION ALL SELECT 'transactions.transaction_date not null', count(*) FILTER (WHERE transaction_date IS NULL) FROM shop_tx
UNION ALL SELECT 'events.event_id unique', count(*)
  FROM (SELECT event_id FROM shop_events GROUP BY event_id HAVING count(*) > 1) d
UNION ALL SELECT 'events.customer_id references customers', count(*)
  FROM shop_events e WHERE e.customer_id IS NOT NULL
   AND NOT EXISTS (SELECT 1 FROM shop_customers c WHERE c.customer_id = e.customer_id)
UNION ALL SELECT 'events.event_date not null', count(*) FILTER (WHERE event_date IS NULL) FROM shop_events
"""))
def q_integrity(spark, sf):
    from ..session import materialize
    # each table's key / date columns are written once; the checks then read the narrow
    # copies instead of re-planning the fact join per check
    cust = materialize(A.customers(spark, sf).select("customer_id", "signup_date"), "chk-customers")
    tx = materialize(A.transactions(spark, sf, with_category=False).select(
        "transaction_id", "customer_id", "product_id", "transaction_date"), "chk-transactions")
    evt = materialize(A.events(spark, sf).select("event_id", "customer_id", "event_date"), "chk-events")
    prod = A.products(spark, sf).select("product_id")
    return Q.integrity_report([
        Q.unique("customers", cust, ["customer_id"]),
        Q.not_null("customers", cust, "customer_id"),
        Q.not_null("customers", cust, "signup_date"),
        Q.unique("transactions", tx, ["transaction_id"]),
        Q.references("transactions", tx, "customer_id", "customers", cust, "customer_id"),
        Q.references("transactions", tx, "product_id", "products", prod, "product_id"),
        Q.not_null("transactions", tx, "transaction_date"),
        Q.unique("events", evt, ["event_id"]),
        Q.references("events", evt, "customer_id", "customers", cust, "customer_id"),
        Q.not_null("events", evt, "event_date"),
    ])


# ---------------------------------------------------------------- ops 5-6: revenue measures

@register("revenue_measures", oracle("""
SELECT transaction_id, customer_id, transaction_date, revenue AS net_revenue,
       quantity * unit_price * (1 - discount_pct) AS gross_revenue,
       quantity * unit_price * (1 - discount_pct) * (1 - CAST(return_flag AS DOUBLE)) AS return_adjusted_revenue
FROM shop_tx""", ["net_revenue", "gross_revenue", "return_adjusted_revenue"]))
def q_revenue_measures(spark, sf):
    tx = A.transactions(spark, sf, with_category=False)
    g = gross_revenue()
    return tx.select("transaction_id", "customer_id", "transaction_date",
                     F.col("revenue").alias("net_revenue"), g.alias("gross_revenue"),
                     return_adjusted_revenue(g).alias("return_adjusted_revenue"))


# ---------------------------------------------------------------- op 7: churn label rule

@register("churn_labels_lineitem_grain", oracle(f"""
SELECT c.customer_id,
       CAST(CASE WHEN a.freq < 8 AND {days('(SELECT max(transaction_date) FROM shop_tx)', 'a.last_tx')} > 180
            THEN 1 ELSE 0 END AS INTEGER) AS churn_label
FROM shop_customers c LEFT JOIN
  (SELECT customer_id, count(*) AS freq, max(transaction_date) AS last_tx FROM shop_tx GROUP BY 1) a
  ON a.customer_id = c.customer_id"""))
def q_churn_labels(spark, sf):
    cust = A.customers(spark, sf).select("customer_id")
    tx = A.transactions(spark, sf, with_category=False)
    return FT.churn_labels(cust, tx)


# ---------------------------------------------------------------- ops 8-10: RFM

RFM_BASE_SQL = f"""rfm_base AS (
  SELECT customer_id, {days(ts(TX_SNAP), 'max(transaction_date)')} AS recency_days,
         count(*) AS frequency, sum(revenue) AS monetary_total,
         sum(revenue) / count(*) AS monetary_avg
  FROM shop_tx GROUP BY customer_id)"""

RFM_FULL_SQL = RFM_BASE_SQL + """,
rfm_ranked AS (
  SELECT *, row_number() OVER (ORDER BY recency_days, customer_id) AS rr,
         row_number() OVER (ORDER BY frequency, customer_id) AS fr,
         row_number() OVER (ORDER BY monetary_total, customer_id) AS mr,
         count(*) OVER () AS n
  FROM rfm_base),
rfm_scored AS (
  SELECT customer_id, recency_days, frequency, monetary_total, monetary_avg,
         CAST(6 - greatest(1, (5 * (rr - 1) + n - 2) // (n - 1)) AS INTEGER) AS rfm_recency_score,
         CAST(greatest(1, (5 * (fr - 1) + n - 2) // (n - 1)) AS INTEGER) AS rfm_frequency_score,
         CAST(greatest(1, (5 * (mr - 1) + n - 2) // (n - 1)) AS INTEGER) AS rfm_monetary_score
  FROM rfm_ranked),
rfm_full AS (
  SELECT *, rfm_recency_score + rfm_frequency_score + rfm_monetary_score AS rfm_total_score,
         CASE WHEN rfm_recency_score + rfm_frequency_score + rfm_monetary_score >= 13 THEN 'Champions'
              WHEN rfm_recency_score + rfm_frequency_score + rfm_monetary_score >= 10 THEN 'Loyal'
              WHEN rfm_recency_score + rfm_frequency_score + rfm_monetary_score >= 7 THEN 'At Risk'
              WHEN rfm_recency_score + rfm_frequency_score + rfm_monetary_score >= 4 THEN 'Hibernating'
              ELSE 'Lost' END AS rfm_segment
  FROM rfm_scored)"""


@register("rfm_base", oracle("SELECT * FROM rfm_base", ["monetary_total", "monetary_avg"],
                             ctes=RFM_BASE_SQL))
def q_rfm_base(spark, sf):
    return FT.rfm_base(A.transactions(spark, sf, with_category=False), TX_SNAP)


@register("rfm_scores", oracle("SELECT * FROM rfm_full", ["monetary_total", "monetary_avg"],
                               ctes=RFM_FULL_SQL))
def q_rfm_scores(spark, sf):
    return FT.rfm_features(A.transactions(spark, sf, with_category=False), TX_SNAP)


@register("rfm_segment_counts", oracle(
    "SELECT rfm_segment, CAST(count(*) AS BIGINT) AS customers FROM rfm_full GROUP BY rfm_segment",
    ctes=RFM_FULL_SQL))
def q_rfm_segment_counts(spark, sf):
    rfm = FT.rfm_features(A.transactions(spark, sf, with_category=False), TX_SNAP)
    return rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- ops 11-15: behaviour

_EV_START = _minus_days(EV_SNAP, 84)
BEH_SQL = f"""ev_w AS (
  SELECT *, CASE WHEN event_date > {ts(_EV_START)} AND event_date <= {ts(EV_SNAP)}
            THEN least(greatest(floor({days('event_date', ts(_EV_START))} / 7), 0), 11) END AS wk
  FROM shop_events),
beh_main AS (
  SELECT customer_id, count(DISTINCT event_date) AS total_sessions,
         avg(session_duration_sec) AS avg_session_duration,
         count(*) FILTER (WHERE event_type = 'page_view') AS total_page_views,
         count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_add_count,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
         count(*) FILTER (WHERE event_type = 'wishlist_add') AS wishlist_count,
         {days(ts(EV_SNAP), 'max(event_date)')} AS days_since_last_event,
         sum(wk - 5.5) / 143 AS event_recency_trend
  FROM ev_w GROUP BY customer_id),
{mode_ctes('dev_mode', 'shop_events', 'device_type')},
{mode_ctes('cat_mode', 'shop_events', 'page_category')},
beh AS (
  SELECT m.customer_id, total_sessions, avg_session_duration, total_page_views, cart_add_count,
         CASE WHEN cart_add_count = 0 THEN CAST(0 AS DOUBLE) ELSE purchases / cart_add_count END
           AS cart_to_purchase_ratio,
         wishlist_count, coalesce(d.val, 'unknown') AS preferred_device,
         coalesce(c.val, 'unknown') AS preferred_category, days_since_last_event,
         CAST(event_recency_trend AS DOUBLE) AS event_recency_trend
  FROM beh_main m LEFT JOIN dev_mode d ON d.customer_id = m.customer_id
  LEFT JOIN cat_mode c ON c.customer_id = m.customer_id)"""


@register("behavioral_features", oracle(
    "SELECT * FROM beh", ["avg_session_duration", "cart_to_purchase_ratio", "event_recency_trend"],
    ctes=BEH_SQL))
def q_behavioral(spark, sf):
    return FT.behavioral_features(A.events(spark, sf), EV_SNAP)


# ---------------------------------------------------------------- ops 16-19: transactions

TXF_SQL = f"""tx_gaps AS (
  SELECT customer_id,
         {days('transaction_date', 'lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date)')} AS gap
  FROM shop_tx),
gap_stats AS (
  SELECT customer_id,
         CASE WHEN count(*) >= 2 THEN avg(gap) END AS purchase_gap_mean,
         CASE WHEN count(*) >= 2 THEN stddev_pop(gap) END AS purchase_gap_std
  FROM tx_gaps GROUP BY customer_id),
{mode_ctes('pay_mode', 'shop_tx', 'payment_method')},
txf_main AS (
  SELECT customer_id, count(DISTINCT category) AS category_diversity,
         avg(discount_pct) AS avg_discount_received,
         avg(CAST(return_flag AS DOUBLE)) AS return_rate,
         coalesce(sum(revenue) FILTER (WHERE transaction_date >= {ts(_minus_days(TX_SNAP, 30))}), 0) AS revenue_last_30d,
         coalesce(sum(revenue) FILTER (WHERE transaction_date >= {ts(_minus_days(TX_SNAP, 90))}), 0) AS revenue_last_90d,
         coalesce(sum(revenue) FILTER (WHERE transaction_date >= {ts(_minus_days(TX_SNAP, 180))}), 0) AS revenue_last_180d,
         avg(CASE WHEN month(transaction_date) IN (10, 11, 12) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
           AS peak_season_purchase_ratio
  FROM shop_tx GROUP BY customer_id),
txf AS (
  SELECT m.customer_id, category_diversity, coalesce(p.val, 'unknown') AS preferred_payment,
         avg_discount_received, return_rate,
         CAST(revenue_last_30d AS DOUBLE) AS revenue_last_30d,
         CAST(revenue_last_90d AS DOUBLE) AS revenue_last_90d,
         CAST(revenue_last_180d AS DOUBLE) AS revenue_last_180d,
         g.purchase_gap_mean, g.purchase_gap_std, peak_season_purchase_ratio
  FROM txf_main m LEFT JOIN pay_mode p ON p.customer_id = m.customer_id
  LEFT JOIN gap_stats g ON g.customer_id = m.customer_id)"""

TXF_DOUBLES = ["avg_discount_received", "return_rate", "revenue_last_30d", "revenue_last_90d",
               "revenue_last_180d", "purchase_gap_mean", "purchase_gap_std",
               "peak_season_purchase_ratio"]


@register("transaction_features", oracle("SELECT * FROM txf", TXF_DOUBLES, ctes=TXF_SQL))
def q_transaction_features(spark, sf):
    return FT.transaction_features(A.transactions(spark, sf), TX_SNAP)


# ---------------------------------------------------------------- op 20: master table

MASTER_SQL = RFM_FULL_SQL + ",\n" + BEH_SQL + ",\n" + TXF_SQL + """,
master AS (
  SELECT c.customer_id, c.signup_date, c.age, c.gender, c.city, c.acquisition_channel,
         coalesce(c.is_premium, false) AS is_premium,
         coalesce(r.recency_days, 0) AS recency_days, coalesce(r.frequency, 0) AS frequency,
         coalesce(r.monetary_total, 0) AS monetary_total, coalesce(r.monetary_avg, 0) AS monetary_avg,
         coalesce(r.rfm_recency_score, 0) AS rfm_recency_score,
         coalesce(r.rfm_frequency_score, 0) AS rfm_frequency_score,
         coalesce(r.rfm_monetary_score, 0) AS rfm_monetary_score,
         coalesce(r.rfm_total_score, 0) AS rfm_total_score,
         coalesce(r.rfm_segment, 'unknown') AS rfm_segment,
         coalesce(b.total_sessions, 0) AS total_sessions,
         coalesce(b.avg_session_duration, 0) AS avg_session_duration,
         coalesce(b.total_page_views, 0) AS total_page_views,
         coalesce(b.cart_add_count, 0) AS cart_add_count,
         coalesce(b.cart_to_purchase_ratio, 0) AS cart_to_purchase_ratio,
         coalesce(b.wishlist_count, 0) AS wishlist_count,
         coalesce(b.preferred_device, 'unknown') AS preferred_device,
         coalesce(b.preferred_category, 'unknown') AS preferred_category,
         coalesce(b.days_since_last_event, 0) AS days_since_last_event,
         coalesce(b.event_recency_trend, 0) AS event_recency_trend,
         coalesce(t.category_diversity, 0) AS category_diversity,
         coalesce(t.preferred_payment, 'unknown') AS preferred_payment,
         coalesce(t.avg_discount_received, 0) AS avg_discount_received,
         coalesce(t.return_rate, 0) AS return_rate,
         coalesce(t.revenue_last_30d, 0) AS revenue_last_30d,
         coalesce(t.revenue_last_90d, 0) AS revenue_last_90d,
         coalesce(t.revenue_last_180d, 0) AS revenue_last_180d,
         coalesce(t.purchase_gap_mean, 0) AS purchase_gap_mean,
         coalesce(t.purchase_gap_std, 0) AS purchase_gap_std,
         coalesce(t.peak_season_purchase_ratio, 0) AS peak_season_purchase_ratio,
         c.churn_label
  FROM shop_customers c
  LEFT JOIN rfm_full r ON r.customer_id = c.customer_id
  LEFT JOIN beh b ON b.customer_id = c.customer_id
  LEFT JOIN txf t ON t.customer_id = c.customer_id)"""

MASTER_DOUBLES = (["age", "monetary_total", "monetary_avg", "avg_session_duration",
                   "cart_to_purchase_ratio", "event_recency_trend"] + TXF_DOUBLES)


def master(spark, sf):
    cust, tx, evt = A.customers(spark, sf), A.transactions(spark, sf), A.events(spark, sf)
    return FT.build_master(cust, tx, evt, TX_SNAP, EV_SNAP)


@register("master_feature_table", oracle("SELECT * FROM master", MASTER_DOUBLES, ctes=MASTER_SQL))
def q_master(spark, sf):
    return master(spark, sf)


# ---------------------------------------------------------------- ops 21-24, 34: compact forms

COMPACT_SQL = f"""c_rfm AS (
  SELECT customer_id,
         {days('(SELECT CAST(CAST(max(transaction_date) AS DATE) AS TIMESTAMP) FROM shop_tx)', 'max(transaction_date)')}
           AS recency_days,
         count(*) AS frequency, sum(revenue) AS monetary
  FROM shop_tx GROUP BY customer_id),
c_txf AS (
  SELECT customer_id, avg(discount_pct) AS avg_discount, avg(CAST(return_flag AS DOUBLE)) AS return_rate,
         avg(revenue) AS avg_order_value, sum(quantity) AS total_quantity
  FROM shop_tx GROUP BY customer_id),
c_evf AS (
  SELECT customer_id, count(event_id) AS total_events, avg(session_duration_sec) AS avg_session_duration
  FROM shop_events GROUP BY customer_id),
c_master AS (
  SELECT c.*, r.recency_days, r.frequency, r.monetary, t.avg_discount, t.return_rate,
         t.avg_order_value, t.total_quantity, e.total_events, e.avg_session_duration
  FROM shop_customers c JOIN c_rfm r ON r.customer_id = c.customer_id
  JOIN c_txf t ON t.customer_id = c.customer_id JOIN c_evf e ON e.customer_id = c.customer_id)"""


@register("compact_rfm", oracle("SELECT * FROM c_rfm", ["monetary"], ctes=COMPACT_SQL))
def q_compact_rfm(spark, sf):
    return FT.compact_rfm(A.transactions(spark, sf, with_category=False))


@register("compact_transaction_features", oracle(
    "SELECT * FROM c_txf", ["avg_discount", "return_rate", "avg_order_value", "total_quantity"],
    ctes=COMPACT_SQL))
def q_compact_txf(spark, sf):
    return FT.compact_transaction_features(A.transactions(spark, sf, with_category=False))


@register("compact_event_features", oracle(
    "SELECT * FROM c_evf", ["avg_session_duration"], ctes=COMPACT_SQL))
def q_compact_evf(spark, sf):
    return FT.compact_event_features(A.events(spark, sf))


def compact_master(spark, sf):
    # the fact join runs once: both per-customer aggregates read the written lines
    tx = materialize(A.transactions(spark, sf, with_category=False).select(
        "customer_id", "transaction_date", "quantity", "discount_pct", "return_flag", "revenue"), "compact-lines")
    return FT.compact_master(A.customers(spark, sf), FT.compact_rfm(tx, "revenue"),
                             FT.compact_transaction_features(tx),
                             FT.compact_event_features(A.events(spark, sf)))


COMPACT_MASTER_DOUBLES = ["age", "monetary", "avg_discount", "return_rate", "avg_order_value",
                          "total_quantity", "avg_session_duration"]


@register("compact_master", oracle("SELECT * FROM c_master", COMPACT_MASTER_DOUBLES,
                                   ctes=COMPACT_SQL))
def q_compact_master(spark, sf):
    return compact_master(spark, sf)


@register("model_data", oracle(
    "SELECT customer_id, " + ", ".join(FT.MODEL_FEATURES) + ", churn_label FROM c_master",
    COMPACT_MASTER_DOUBLES, ctes=COMPACT_SQL))
def q_model_data(spark, sf):
    return FT.model_data(compact_master(spark, sf))
