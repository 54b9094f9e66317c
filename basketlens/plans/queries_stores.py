"""Registered queries of stored month states in bucketed tables, of JSON request streams and of keyed stream state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import ml as ML
from ..operators import month_store as MS
from ..session import app_folder, materialize, scalar
from ..sources import adapter as A
from ..streaming import latest as LS
from ..streaming import requests as REQ
from .catalog import register
from .queries_features import MASTER_SQL, RFM_BASE_SQL, TX_SNAP
from .queries_ml import CATEGORICAL, NUMERIC, model_frame
from .sqlkit import oracle

# ---------------------------------------------------------------- ops 2, 3, 8: month states


def _store(spark, sf, spoiled: bool):
    """A store of all transactions; with ``spoiled``, its latest month holds doubled revenue."""
    name = f"months_{uuid.uuid4().hex}"
    tx = A.transactions(spark, sf, with_category=False)
    if spoiled:
        latest = scalar(tx.agg(F.date_format(F.max("transaction_date"), "yyyy-MM")))
        of_latest = F.date_format("transaction_date", "yyyy-MM") == F.lit(latest)
        wrong = tx.withColumn("revenue", F.when(of_latest, F.col("revenue") * 2 + 1).otherwise(F.col("revenue")))
        MS.create_store(wrong, A.customers(spark, sf), name, buckets=8, location=f"{app_folder(spark)}/{name}")
        MS.replace_month(spark, name, latest, tx)
    else:
        MS.create_store(tx, A.customers(spark, sf), name, buckets=8, location=f"{app_folder(spark)}/{name}")
    return name


@register("rfm_after_month_replace", oracle("SELECT * FROM rfm_base", ["monetary_total", "monetary_avg"], ctes=RFM_BASE_SQL),
          note="states of a wrong month are replaced; the measures are those of a full rebuild")
def q_rfm_replaced(spark, sf):
    return MS.rfm_of_months(spark, _store(spark, sf, True), TX_SNAP)


@register("rfm_of_months_bucketed", oracle(RFM_BASE_SQL.replace("rfm_base AS (", "SELECT r.*, c.is_premium FROM (", 1).replace(
    "GROUP BY customer_id)", "WHERE strftime(transaction_date, '%Y-%m') BETWEEN '1997-01' AND '1999-12' GROUP BY customer_id) r "
    "JOIN shop_customers c ON c.customer_id = r.customer_id"), ["monetary_total", "monetary_avg"]),
    note="two bucketed tables joined without an exchange, other months' partitions not read")
def q_rfm_bucketed(spark, sf):
    return MS.rfm_of_months(spark, _store(spark, sf, False), TX_SNAP, "1997-01", "1999-12", ("is_premium",))


# ---------------------------------------------------------------- op 58: JSON requests

@register("json_requests_scored_or_dead", oracle("""
SELECT CASE customer_id % 5 WHEN 0 THEN 'not_json' WHEN 1 THEN 'missing:customer_id' WHEN 2 THEN 'not_json' ELSE 'scored' END AS fate,
       count(*) AS requests, CAST(0 AS BIGINT) AS mismatches FROM master GROUP BY 1""", ctes=MASTER_SQL),
          note="every customer is one request line; some are cut, some lack the id, some have a text as id")
def q_json_requests(spark, sf):
    data = model_frame(spark, sf)
    model = ML.fit_churn_model(data, NUMERIC, CATEGORICAL, "logistic_regression")
    rows = data.drop("churn_label")
    line, kind = F.to_json(F.struct(*rows.columns)), F.pmod(F.col("customer_id"), F.lit(5))
    others = F.to_json(F.struct(*[c for c in rows.columns if c != "customer_id"]))
    wrong = F.to_json(F.struct(F.concat(F.lit("c"), F.col("customer_id").cast("string")).alias("customer_id"),
                               *[F.col(c) for c in rows.columns if c != "customer_id"]))
    sent = F.when(kind == 0, F.expr("substring(line, 1, length(line) - 1)")).when(kind == 1, F.col("others")).when(
        kind == 2, F.col("wrong")).otherwise(F.col("line"))
    root = f"{app_folder(spark)}/requests-{uuid.uuid4().hex}"
    (rows.select("customer_id", line.alias("line"), others.alias("others"), wrong.alias("wrong"))
     .select(sent.alias("value")).write.text(f"{root}/source"))
    for query in REQ.start_json_scoring(spark, model, f"{root}/source", rows.schema, f"{root}/scored", f"{root}/dead", f"{root}/checkpoint"):
        query.awaitTermination()
    scored = spark.read.parquet(f"{root}/scored").select("customer_id", "churn_probability")
    both = scored.join(ML.score(model, data), "customer_id", "left")
    differs = ~F.coalesce(F.abs(F.col("score") - F.col("churn_probability")) < 1e-9, F.lit(False))
    good = both.agg(F.count(F.lit(1)).alias("requests"), F.count_if(differs).alias("mismatches"))
    dead = spark.read.parquet(f"{root}/dead").groupBy("reason").agg(F.count(F.lit(1)).alias("requests"))
    return materialize(good.select(F.lit("scored").alias("fate"), "requests", "mismatches").unionByName(
        dead.select(F.col("reason").alias("fate"), "requests", F.lit(0).cast("long").alias("mismatches"))), "requests")


# ---------------------------------------------------------------- op 58: keyed state, files that come again

@register("latest_scores_replayed", oracle("""
SELECT customer_id, max(event_ts) AS last_time, arg_max(event_id, (event_ts, event_id)) AS last_id,
       arg_max(session_duration_sec / (session_duration_sec + 60), (event_ts, event_id)) AS score, count(*) AS n_rows
FROM shop_events WHERE event_id IS NOT NULL AND event_ts IS NOT NULL AND customer_id IS NOT NULL GROUP BY customer_id""", ["score"]),
          note="all events arrive in two halves, then both halves again: nothing counts twice")
def q_latest_replayed(spark, sf):
    events = materialize(A.events(spark, sf).select(
        "customer_id", "event_id", "event_ts", (F.col("session_duration_sec") / (F.col("session_duration_sec") + 60)).alias("score")), "events")
    ends = events.agg(F.min("event_ts").alias("a"), F.max("event_ts").alias("b")).first()
    arrivals = [F.lit(True)]  # a table without times
    if ends["a"] is not None:
        early = F.col("event_ts") < F.lit(ends["a"] + (ends["b"] - ends["a"]) / 2)
        arrivals = [early, ~early] * 2
    root = f"{app_folder(spark)}/latest-{uuid.uuid4().hex}"
    for rows in arrivals:
        events.where(rows).write.mode("append").parquet(f"{root}/source")
        LS.start_latest(spark, f"{root}/source", events.schema, f"{root}/log", f"{root}/checkpoint", "customer_id", "event_id",
                        "event_ts", "score", "12 hours").awaitTermination()
    log = spark.read.schema(LS.log_schema(events.schema, "customer_id", "event_id")).parquet(f"{root}/log")
    return materialize(LS.latest(log, "customer_id").drop("version"), "latest")
