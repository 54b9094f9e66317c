"""Customer features: churn label, RFM, behavioural, transaction and master tables.

Every function is DataFrame -> DataFrame and lazy, except where a snapshot must be read
from the data (one scalar aggregate). All per-customer aggregates are ``groupBy`` with
partial (map-side) aggregation, so a customer holding a large share of the rows does not
end up in a single task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (as_datetime, elapsed_days, net_revenue, rfm_segment,
                                 safe_ratio, ts_literal)
from ..session import materialize, scalar
from .ranks import running_totals

CID = "customer_id"

# Week grid of the activity trend (12 weeks, slope by least squares:
# x = week - 5.5, sum of x^2 = 143).
TREND_WEEKS = 12
TREND_CENTER = 5.5
TREND_SXX = 143.0
# Trailing revenue windows in days.
TRAILING_DAYS = (30, 90, 180)
# Peak season months.
PEAK_MONTHS = (10, 11, 12)


# ---------------------------------------------------------------------------------------
# helpers


def modes(df: DataFrame, key: str, columns: Mapping[str, str], weight: str | None = None) -> DataFrame:
    """Most frequent non-null value per ``key`` for each column, ties -> smallest value.

    Two partial aggregations: counts per (key, column, value), then the best value per key.
    With ``weight`` each row counts that many times (pre-aggregated input). Values come
    back as strings.
    """
    w = F.col(weight) if weight else F.lit(1)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(out).alias("attr"), F.col(src).cast("string").alias("val"))
        for out, src in columns.items()]))
    long = df.select(key, w.alias("_w"), pairs.alias("p")).select(key, "_w", "p.attr", "p.val").where(
        F.col("val").isNotNull())
    counts = long.groupBy(key, "attr", "val").agg(F.sum("_w").alias("n"))
    best = [F.min(F.when(F.col("attr") == out,
                         F.struct((-F.col("n")).alias("neg_n"), F.col("val").alias("val"))))
            .getField("val").alias(out) for out in columns]
    return counts.groupBy(key).agg(*best)


def _revenue_col(tx: DataFrame, revenue: str | None):
    return F.col(revenue) if revenue else net_revenue()


# ---------------------------------------------------------------------------------------
# op 7: churn label rule


def churn_labels(customers: DataFrame, purchases: DataFrame, max_frequency: int = 8,
                 min_recency_days: int = 180, date_col: str = "transaction_date") -> DataFrame:
    """Replace ``churn_label``: 1 iff fewer than ``max_frequency`` purchases and the last one
    more than ``min_recency_days`` before the latest purchase overall; no purchases -> 0."""
    # the latest purchase is the latest of the customers' latest: one pass over the fact
    per = materialize(purchases.groupBy(CID).agg(F.count(F.lit(1)).alias("_freq"),
                                                 F.max(date_col).alias("_last")), "purchases")
    latest = scalar(per.agg(F.max("_last")))
    rule = ((F.col("_freq") < max_frequency)
            & (elapsed_days(ts_literal(latest), F.col("_last")) > min_recency_days)).cast("int")
    per = per.select(CID, rule.alias("_label"))
    base = customers.drop("churn_label") if "churn_label" in customers.columns else customers
    return (base.join(per, CID, "left")
            .withColumn("churn_label", F.coalesce(F.col("_label"), F.lit(0)))
            .drop("_label"))


# ---------------------------------------------------------------------------------------
# ops 8-10: RFM


def _line_summary(tx: DataFrame, revenue: str | None, date_col: str) -> DataFrame:
    """Transactions in summary form without aggregating (one row per line, _n = 1)."""
    cols = [F.col(CID), F.col(date_col).alias("_t"), F.lit(1).cast("long").alias("_n"),
            _revenue_col(tx, revenue).alias("_rev")]
    if "discount_pct" in tx.columns:
        cols.append(F.col("discount_pct").alias("_disc"))
    if "return_flag" in tx.columns:
        cols.append(F.col("return_flag").cast("long").alias("_ret"))
    cols += [F.col(c) for c in ("payment_method", "category") if c in tx.columns]
    return tx.select(*cols)


def transaction_summary(tx: DataFrame, revenue: str | None = None,
                        date_col: str = "transaction_date") -> DataFrame:
    """Line count, net revenue, discount sum and return count per (customer, timestamp, payment
    method) and per (customer, category), in one pass over the fact table (grouping sets, so
    both shuffle their partial sums only). ``_of`` is ``_t`` or ``category``, the first column
    that a row is grouped by beside the customer. The lines of one purchase share time and payment
    method, so these need no grouping each.

    Every per-customer transaction feature follows from one of the two.
    """
    lines = _line_summary(tx, revenue, date_col)
    sets = [[c for c in names if c in lines.columns] for names in (("_t", "payment_method"), ("category",))]
    sets = [names for names in sets if names]
    of = F.coalesce(*[F.when(F.grouping(names[0]) == 0, F.lit(names[0])) for names in sets])
    sums = [F.sum(c).alias(c) for c in ("_n", "_rev", "_disc", "_ret") if c in lines.columns]
    return (lines.groupingSets([[F.col(CID), *[F.col(c) for c in names]] for names in sets], CID, *[c for names in sets for c in names])
            .agg(*sums, of.alias("_of")))


def _grouped_by(s: DataFrame, column: str) -> DataFrame:
    """The rows of a summary that are grouped by ``column`` (plain lines: all rows)."""
    return s.where(F.col("_of") == column) if "_of" in s.columns else s


def _per_customer(s: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    return _grouped_by(s, "_t").groupBy(CID).agg(F.max("_t").alias("_last"), F.sum("_n").alias("frequency"),
                                                 F.sum("_rev").alias("monetary_total"), *more)


def _rfm_from_aggregate(agg: DataFrame, snapshot) -> DataFrame:
    return agg.select(
        CID,
        elapsed_days(ts_literal(snapshot), F.col("_last")).alias("recency_days"),
        "frequency", "monetary_total",
        safe_ratio("monetary_total", "frequency").alias("monetary_avg"))


def _rfm_from_summary(s: DataFrame, snapshot) -> DataFrame:
    return _rfm_from_aggregate(_per_customer(s), snapshot)


def rfm_base(tx: DataFrame, snapshot, revenue: str | None = None,
             date_col: str = "transaction_date") -> DataFrame:
    """recency_days, frequency, monetary_total, monetary_avg per customer."""
    return _rfm_from_summary(_line_summary(tx, revenue, date_col), snapshot)


def quintile_bucket(rank, n) -> "F.Column":
    """Bucket 1..5 of a 1-based rank among n by equal-width cuts of the rank range.

    greatest(1, ceil(5 (r-1) / (n-1))); null when n < 2.
    """
    r, n = F.col(rank), F.col(n)
    return F.when(n < 2, F.lit(None).cast("int")).otherwise(
        F.greatest(F.lit(1), F.ceil(F.lit(5.0) * (r - 1) / (n - 1)).cast("int")))


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Add rfm_recency_score (reversed), rfm_frequency_score, rfm_monetary_score, total and
    segment. Ranks order by (value, customer_id), so ties break by customer id.

    One exact distributed ranking of the three measures at once (unpivoted, ranked per
    measure), then pivoted back with one aggregation.
    """
    long = rfm.select(CID, F.explode(F.array(
        F.struct(F.lit("r").alias("m"), F.col("recency_days").cast("double").alias("v")),
        F.struct(F.lit("f").alias("m"), F.col("frequency").cast("double").alias("v")),
        F.struct(F.lit("m").alias("m"), F.col("monetary_total").cast("double").alias("v")),
    )).alias("x")).select(CID, "x.m", "x.v")
    ranked = running_totals(long, ["v", CID], by=["m"], label="rfm")
    ranked = ranked.withColumn("_b", quintile_bucket("_rank", "_n"))

    def pick(m, c):
        return F.max(F.when(F.col("m") == m, F.col(c)))

    scores = ranked.groupBy(CID).agg(
        (6 - pick("r", "_b")).alias("rfm_recency_score"),
        pick("f", "_b").alias("rfm_frequency_score"),
        pick("m", "_b").alias("rfm_monetary_score"),
        pick("r", "v").alias("_r"), pick("f", "v").alias("_f"), pick("m", "v").alias("_mt"))
    if set(rfm.columns) <= {CID, "recency_days", "frequency", "monetary_total", "monetary_avg"}:
        # the measures travel through the (written) ranked table: no second pass over the
        # input that produced ``rfm``
        out = scores.select(
            CID, F.col("_r").cast("long").alias("recency_days"),
            F.col("_f").cast("long").alias("frequency"), F.col("_mt").alias("monetary_total"),
            safe_ratio("_mt", "_f").alias("monetary_avg"),
            "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score")
    else:
        out = rfm.join(scores.drop("_r", "_f", "_mt"), CID, "left")
    total = F.col("rfm_recency_score") + F.col("rfm_frequency_score") + F.col("rfm_monetary_score")
    return (out.withColumn("rfm_total_score", total)
            .withColumn("rfm_segment", F.when(total.isNull(), F.lit(None).cast("string"))
                        .otherwise(rfm_segment(total))))


def rfm_features(tx: DataFrame, snapshot, revenue: str | None = None) -> DataFrame:
    """Full RFM table: base measures, quintile scores, total and segment."""
    return rfm_scores(rfm_base(tx, snapshot, revenue))


# ---------------------------------------------------------------------------------------
# ops 11-15: behavioural features


def event_summary(evt: DataFrame, date_col: str = "event_date",
                  duration_col: str = "session_duration_sec") -> DataFrame:
    """One pre-aggregated pass over events at (customer, day, type, device, page category)
    grain: event count, duration sum and non-null duration count."""
    return evt.groupBy(CID, F.col(date_col).alias("_d"), "event_type", "device_type",
                       "page_category").agg(F.count(F.lit(1)).alias("_n"),
                                            F.sum(duration_col).alias("_dur"),
                                            F.count(duration_col).alias("_dur_n"))


def _behavioral_from_summary(s: DataFrame, snapshot) -> DataFrame:
    snap = as_datetime(snapshot)
    start = snap - _dt.timedelta(weeks=TREND_WEEKS)
    d = F.col("_d")
    in_window = (d > ts_literal(start)) & (d <= ts_literal(snap))
    week = F.least(F.greatest(F.floor(elapsed_days(d, ts_literal(start)) / 7), F.lit(0)),
                   F.lit(TREND_WEEKS - 1))
    et = F.col("event_type")
    n = F.col("_n")

    def count_type(t):
        return F.coalesce(F.sum(F.when(et == t, n)), F.lit(0)).cast("long")

    main = s.groupBy(CID).agg(
        F.count_distinct(d).alias("total_sessions"),
        (F.sum("_dur") / F.sum("_dur_n")).alias("avg_session_duration"),
        count_type("page_view").alias("total_page_views"),
        count_type("add_to_cart").alias("cart_add_count"),
        count_type("purchase").alias("_purchases"),
        count_type("wishlist_add").alias("wishlist_count"),
        F.max(d).alias("_last_event"),
        F.sum(F.when(in_window, (week - TREND_CENTER) * n)).alias("_trend_sum"))
    main = main.select(
        CID, "total_sessions", "avg_session_duration", "total_page_views", "cart_add_count",
        safe_ratio("_purchases", "cart_add_count").alias("cart_to_purchase_ratio"),
        "wishlist_count",
        elapsed_days(ts_literal(snap), F.col("_last_event")).alias("days_since_last_event"),
        (F.col("_trend_sum") / TREND_SXX).alias("event_recency_trend"))
    pref = modes(s, CID, {"preferred_device": "device_type",
                          "preferred_category": "page_category"}, weight="_n")
    out = main.join(pref, CID, "left")
    return out.select(
        CID, "total_sessions", "avg_session_duration", "total_page_views", "cart_add_count",
        "cart_to_purchase_ratio", "wishlist_count",
        F.coalesce("preferred_device", F.lit("unknown")).alias("preferred_device"),
        F.coalesce("preferred_category", F.lit("unknown")).alias("preferred_category"),
        "days_since_last_event", "event_recency_trend")


def behavioral_features(evt: DataFrame, snapshot, date_col: str = "event_date",
                        duration_col: str = "session_duration_sec") -> DataFrame:
    """Per customer with events: total_sessions, avg_session_duration, total_page_views,
    cart_add_count, cart_to_purchase_ratio, wishlist_count, preferred_device,
    preferred_category, days_since_last_event, event_recency_trend.

    The trend is the least-squares slope of weekly event counts over the 12 weeks before
    the snapshot (window (snapshot-84d, snapshot]); null when the customer has no event in
    that window.
    """
    return _behavioral_from_summary(event_summary(evt, date_col, duration_col), snapshot)


# ---------------------------------------------------------------------------------------
# ops 16-19: transaction features


def _gaps_from_summary(s: DataFrame) -> DataFrame:
    per_ts = _grouped_by(s, "_t").groupBy(CID, "_t").agg(F.sum("_n").alias("_c"))
    # order each customer's distinct purchase times by a range partitioning, so a customer
    # with a third of all rows is spread over many tasks; gaps inside a customer's segment
    # of a partition come from the row before, gaps between segments from their end times
    order = [F.col(CID).asc_nulls_first(), F.col("_t").asc_nulls_first()]
    tagged = materialize(per_ts.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), "gaps")
    before = Window.partitionBy("_pid", CID).orderBy("_t")
    gap = elapsed_days(F.col("_t"), F.lag("_t").over(before)).cast("long")
    segments = tagged.withColumn("_gap", gap).groupBy("_pid", CID).agg(
        F.sum("_c").alias("_nn"), F.coalesce(F.sum("_gap"), F.lit(0)).alias("_s1"),
        F.coalesce(F.sum(F.col("_gap") * F.col("_gap")), F.lit(0)).alias("_s2"),
        F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    between = elapsed_days(F.col("_first"), F.lag("_last").over(Window.partitionBy(CID).orderBy("_pid"))).cast("long")
    segments = segments.withColumn("_gap", F.coalesce(between, F.lit(0)))
    # (c - 1) zero gaps inside each timestamp plus one gap per transition; whole-day gaps
    # make every sum an exact integer, so the variance is exact: (n-1) S2 - S1^2
    agg = segments.groupBy(CID).agg(F.sum("_nn").alias("_nn"), F.sum(F.col("_s1") + F.col("_gap")).alias("_s1"),
                                    F.sum(F.col("_s2") + F.col("_gap") * F.col("_gap")).alias("_s2"))
    m = (F.col("_nn") - 1).cast("decimal(38,0)")
    s1, s2 = F.col("_s1").cast("decimal(38,0)"), F.col("_s2").cast("decimal(38,0)")
    var_num = (s2 * m - s1 * s1).cast("double")
    m_d = (F.col("_nn") - 1).cast("double")
    ok = F.col("_nn") >= 2
    return agg.select(CID, F.when(ok, F.col("_s1") / m_d).alias("purchase_gap_mean"),
                      F.when(ok, F.sqrt(F.greatest(var_num, F.lit(0.0)) / (m_d * m_d)))
                      .alias("purchase_gap_std"))


def purchase_gap_stats(tx: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """Mean and population std of whole days between consecutive purchases; null for
    customers with fewer than two purchases.

    Purchases are first counted per (customer, timestamp): equal timestamps are gaps of 0,
    so only distinct timestamps need ordering, and they are ordered by range partitions
    (windows inside a partition only), so a hot customer never sits in one task.
    """
    return _gaps_from_summary(tx.select(CID, F.col(date_col).alias("_t"),
                                        F.lit(1).cast("long").alias("_n")))


def _transaction_aggs(snapshot) -> list[Column]:
    snap = as_datetime(snapshot)
    d, n = F.col("_t"), F.col("_n")
    trailing = [F.coalesce(F.sum(F.when(d >= ts_literal(snap - _dt.timedelta(days=k)), F.col("_rev"))),
                           F.lit(0.0)).alias(f"revenue_last_{k}d") for k in TRAILING_DAYS]
    return [(F.sum("_disc") / F.sum("_n")).alias("avg_discount_received"),
            (F.sum("_ret") / F.sum("_n")).alias("return_rate"),
            *trailing,
            (F.sum(F.when(F.month(d).isin(*PEAK_MONTHS), n).otherwise(0)) / F.sum(n))
            .alias("peak_season_purchase_ratio")]


def _transaction_from_summary(s: DataFrame, main: DataFrame) -> DataFrame:
    """``main`` has the :func:`_transaction_aggs` per customer."""
    pay = modes(_grouped_by(s, "_t"), CID, {"preferred_payment": "payment_method"}, weight="_n")
    kinds = (_grouped_by(s, "category").where(F.col("category").isNotNull())
             .groupBy(CID).agg(F.count(F.lit(1)).alias("category_diversity")))
    out = (main.drop("_last", "frequency", "monetary_total").join(kinds, CID, "left").withColumn("category_diversity", F.coalesce("category_diversity", F.lit(0).cast("long")))
           .join(pay, CID, "left").join(_gaps_from_summary(s), CID, "left"))
    return out.select(
        CID, "category_diversity",
        F.coalesce("preferred_payment", F.lit("unknown")).alias("preferred_payment"),
        "avg_discount_received", "return_rate",
        *[f"revenue_last_{k}d" for k in TRAILING_DAYS],
        "purchase_gap_mean", "purchase_gap_std", "peak_season_purchase_ratio")


def transaction_features(tx: DataFrame, snapshot, revenue: str | None = None,
                         date_col: str = "transaction_date") -> DataFrame:
    """Per customer with transactions: category_diversity, preferred_payment,
    avg_discount_received, return_rate, revenue_last_30d/90d/180d (net revenue on or after
    snapshot - N days, no upper bound, 0 if none), purchase_gap_mean, purchase_gap_std,
    peak_season_purchase_ratio."""
    # three branches (aggregates, payment mode, gaps) read one written summary, so the fact
    # table is scanned and joined once
    summary = materialize(transaction_summary(tx, revenue, date_col), "tx-summary")
    return _transaction_from_summary(summary, _per_customer(summary, _transaction_aggs(snapshot)))


# ---------------------------------------------------------------------------------------
# op 20: master table


def master_feature_table(customers: DataFrame, rfm: DataFrame, behavioral: DataFrame,
                         txn: DataFrame, flag_missing: bool = False) -> DataFrame:
    """Customers left-joined with the three feature tables.

    Fill rules: numeric nulls -> 0 (except churn_label), boolean nulls -> false, string
    nulls -> "unknown"; timestamps stay null. Integer counts keep their integer type.
    ``churn_label`` is moved last. Column name clashes raise. With ``flag_missing`` a
    ``has_purchase`` flag separates "no purchase" from recency 0.
    """
    seen = set(customers.columns)
    for name, part in (("rfm", rfm), ("behavioral", behavioral), ("transaction", txn)):
        clash = (set(part.columns) - {CID}) & seen
        if clash:
            raise ValueError(f"{name} features clash with existing columns: {sorted(clash)}")
        seen |= set(part.columns)
    m = customers
    if flag_missing:
        rfm = rfm.withColumn("has_purchase", F.lit(True))
    m = m.join(rfm, CID, "left").join(behavioral, CID, "left").join(txn, CID, "left")
    cols = []
    for f in m.schema.fields:
        c = F.col(f.name)
        if f.name in (CID, "churn_label"):
            cols.append(c)
        elif isinstance(f.dataType, T.BooleanType):
            cols.append(F.coalesce(c, F.lit(False)).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            fill = F.lit(0.0) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.lit(0)
            cols.append(F.coalesce(c, fill.cast(f.dataType)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.coalesce(c, F.lit("unknown")).alias(f.name))
        else:
            cols.append(c)
    m = m.select(*cols)
    if "churn_label" in m.columns:
        m = m.select(*[c for c in m.columns if c != "churn_label"], "churn_label")
    return m


def build_master(customers: DataFrame, tx: DataFrame, evt: DataFrame, tx_snapshot,
                 event_snapshot=None, flag_missing: bool = False) -> DataFrame:
    """Ops 8-20 end to end with one pass per fact table.

    The transaction and event summaries are written once to the checkpoint folder; RFM,
    scores, transaction and behavioural features all read them, so the fact join and scans
    are not repeated per feature branch.
    """
    event_snapshot = event_snapshot or tx_snapshot
    ts_ = materialize(transaction_summary(tx), "tx-summary")
    es_ = materialize(event_summary(evt), "event-summary")
    # RFM and transaction measures are one aggregate, written once
    per = materialize(_per_customer(ts_, _transaction_aggs(tx_snapshot)), "per-customer")
    rfm = rfm_scores(_rfm_from_aggregate(per, tx_snapshot))
    return master_feature_table(customers, rfm, _behavioral_from_summary(es_, event_snapshot),
                                _transaction_from_summary(ts_, per), flag_missing)


# ---------------------------------------------------------------------------------------
# ops 21-24: compact forms


def compact_rfm(tx: DataFrame, revenue: str | None = None,
                date_col: str = "transaction_date") -> DataFrame:
    """customer_id, recency_days, frequency, monetary; snapshot = latest transaction day."""
    agg = materialize(_per_customer(_line_summary(tx, revenue, date_col)), "compact-rfm")
    snap = as_datetime(scalar(agg.agg(F.max("_last")))).date().isoformat()
    return _rfm_from_aggregate(agg, snap).select(
        CID, "recency_days", "frequency", F.col("monetary_total").alias("monetary"))


def compact_transaction_features(tx: DataFrame) -> DataFrame:
    """avg_discount, return_rate, avg_order_value (mean revenue), total_quantity."""
    rev = F.col("revenue") if "revenue" in tx.columns else net_revenue()
    return tx.groupBy(CID).agg(
        F.avg("discount_pct").alias("avg_discount"),
        F.avg(F.col("return_flag").cast("double")).alias("return_rate"),
        F.avg(rev).alias("avg_order_value"),
        F.sum("quantity").alias("total_quantity"))


def compact_event_features(evt: DataFrame) -> DataFrame:
    """total_events (non-null event ids), avg_session_duration."""
    return evt.groupBy(CID).agg(F.count("event_id").alias("total_events"),
                                F.avg("session_duration_sec").alias("avg_session_duration"))


def compact_master(customers: DataFrame, rfm: DataFrame, txf: DataFrame,
                   evf: DataFrame) -> DataFrame:
    """Inner joins on customer_id (customers without events drop out)."""
    return customers.join(rfm, CID).join(txf, CID).join(evf, CID)


# The 11 model features of the compact table.
MODEL_FEATURES = ["age", "is_premium", "recency_days", "frequency", "monetary",
                  "avg_discount", "return_rate", "avg_order_value", "total_quantity",
                  "total_events", "avg_session_duration"]


def model_data(master: DataFrame, features: Sequence[str] = tuple(MODEL_FEATURES),
               label: str = "churn_label", keep_id: bool = True) -> DataFrame:
    """Op 34: the model features and the label."""
    cols = ([CID] if keep_id and CID in master.columns else []) + list(features) + [label]
    return master.select(*cols)
