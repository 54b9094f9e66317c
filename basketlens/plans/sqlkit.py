"""SQL text helpers for the DuckDB oracle (independent re-statement of each query)."""

from __future__ import annotations

from collections.abc import Sequence

# The shop views over the test tables, restated in SQL (same mapping as sources.adapter).
SHOP_CTES = """
shop_order_summary AS (
  SELECT o_custkey AS customer_id, min(o_orderdate) AS signup_date,
         max(o_orderdate) AS last_order, count(*) AS n_orders
  FROM orders GROUP BY o_custkey
),
shop_customers AS (
  SELECT c.c_custkey AS customer_id, oa.signup_date, c.c_acctbal AS age,
         CASE c.c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
         n.n_name AS city, c.c_mktsegment AS acquisition_channel,
         c.c_acctbal >= 5000 AS is_premium,
         CAST(CASE WHEN oa.n_orders < 8 AND {label_days} > 180 THEN 1 ELSE 0 END AS INTEGER)
           AS churn_label
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN shop_order_summary oa ON oa.customer_id = c.c_custkey
),
shop_tx AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
         o.o_custkey AS customer_id, o.o_orderdate AS transaction_date,
         l.l_partkey AS product_id, p.p_type AS category, l.l_quantity AS quantity,
         l.l_extendedprice / l.l_quantity AS unit_price, l.l_discount AS discount_pct,
         o.o_orderpriority AS payment_method,
         CAST(l.l_returnflag = 'R' AS INTEGER) AS return_flag,
         CASE WHEN l.l_returnflag = 'R' THEN CAST(0 AS DOUBLE)
              ELSE l.l_quantity * (l.l_extendedprice / l.l_quantity) * (1 - l.l_discount) END
           AS revenue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
shop_events AS (
  SELECT event_id, user_id AS customer_id, ts AS event_ts,
         CAST(date_trunc('day', ts) AS TIMESTAMP) AS event_date,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
              WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'wishlist_add'
              WHEN 'error' THEN 'search' END AS event_type,
         value AS session_duration_sec,
         (['mobile', 'desktop', 'tablet'])[CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1]
           AS device_type,
         (['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])
           [CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 + 1] AS page_category
  FROM events
)"""


def days(later: str, earlier: str) -> str:
    """Floored whole days of elapsed time, as BIGINT."""
    return (f"CAST(floor(CAST(date_diff('microsecond', {earlier}, {later}) AS DOUBLE)"
            f" / 86400000000) AS BIGINT)")


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def comparable(col: str) -> str:
    """Same binary grid as functions.columns.comparable."""
    x = col
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN NULL "
            f"WHEN abs({x}) >= 134217728 THEN CAST(floor({x} + 0.5) AS DOUBLE) "
            f"WHEN abs({x}) >= 1048576 THEN floor({x} * 128 + 0.5) / 128 "
            f"WHEN abs({x}) >= 8192 THEN floor({x} * 16384 + 0.5) / 16384 "
            f"ELSE floor({x} * 1048576 + 0.5) / 1048576 END")


def oracle(body: str, doubles: Sequence[str] = (), ctes: str = "") -> str:
    """Full oracle statement: shop views (+ extra CTEs) + body; doubles snapped to the grid."""
    label_days = days("(SELECT max(o_orderdate) FROM orders)", "oa.last_order")
    head = "WITH " + SHOP_CTES.format(label_days=label_days)
    if ctes.strip():
        head += ",\n" + ctes
    inner = f"{head}\n{body}"
    if not doubles:
        return inner
    repl = ", ".join(f"CAST({comparable(c)} AS DOUBLE) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{inner}\n) AS oracle_q"
