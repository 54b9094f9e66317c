"""Sources, sinks, declared layout, integrity checks and skew robustness."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketlens.operators import features as FT
from basketlens.operators import quality as Q
from basketlens.sources import adapter as A
from basketlens.sources import io as IO
from basketlens.sources.schemas import SCHEMAS

from conftest import SF_SMALL


def test_write_table_counts_and_modes(spark, tmp_dir):
    df = spark.range(100).withColumn("m", (F.col("id") % 3).cast("string"))
    path = os.path.join(tmp_dir, "t")
    assert IO.write_table(df, path, "overwrite", partition_by=["m"]) == 100
    assert IO.write_table(df.limit(10), path, "append", partition_by=["m"]) == 10
    assert IO.scan(spark, path).count() == 110
    assert IO.write_table(df.limit(5), path, "overwrite") == 5
    assert IO.scan(spark, path).count() == 5
    with pytest.raises(ValueError):
        IO.write_table(df, path, "merge")


def test_sink_then_ml_scoring_in_one_session(spark, tmp_dir):
    # a counted write must leave the session usable for closures that capture it
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    df = spark.range(40).select(F.col("id").cast("double").alias("x"),
                                (F.col("id") % 2).cast("double").alias("label"))
    assert IO.write_table(df, os.path.join(tmp_dir, "s"), "overwrite") == 40
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression(maxIter=5)]).fit(df)
    scored = model.transform(df).select(vector_to_array("probability")[1].alias("score"), "label")
    per = scored.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("pos"))
    assert IO.write_table(per, os.path.join(tmp_dir, "s2"), "overwrite") == 40


def test_declared_tables_and_replace(spark, tmp_dir):
    db = "shop_test_" + os.path.basename(tmp_dir).replace("-", "_")
    names = IO.create_tables(spark, db, buckets=4, location=os.path.join(tmp_dir, "wh"))
    assert len(names) == 4
    cols = spark.table(f"{db}.customers").columns
    assert cols == [f.name for f in SCHEMAS["customers"].fields]
    cust = A.customers(spark, SF_SMALL)
    n = IO.replace_into(cust, f"{db}.customers")
    assert n == cust.count() == spark.table(f"{db}.customers").count()
    assert IO.replace_into(cust.limit(3), f"{db}.customers") == 3
    assert spark.table(f"{db}.customers").count() == 3


def test_integrity_report(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    child = spark.createDataFrame([(1,), (3,), (None,), (3,)], "pid long")
    rep = dict(Q.integrity_report([
        Q.unique("p", parent, ["id"]), Q.not_null("p", parent, "id"),
        Q.references("c", child, "pid", "p", parent, "id")]).collect())
    assert rep == {"p.id unique": 1, "p.id not null": 1, "c.pid references p": 2}


def test_adapter_views_shapes(spark):
    cust = A.customers(spark, SF_SMALL)
    tx = A.transactions(spark, SF_SMALL)
    ev = A.events(spark, SF_SMALL)
    assert cust.count() == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert tx.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert ev.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert set(r[0] for r in ev.select("event_type").distinct().collect()) <= {
        "page_view", "add_to_cart", "purchase", "wishlist_add", "search"}
    # transactions without category never plan the part join
    plan = A.transactions(spark, SF_SMALL, with_category=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan


def test_gaps_with_hot_customer_and_times_of_day(spark):
    rng = np.random.default_rng(8)
    n = 3000
    cust = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 50, n))
    base = dt.datetime(2023, 1, 1)
    secs = rng.integers(0, 200 * 86400, n)
    secs[rng.random(n) < 0.2] = 0  # repeated timestamps
    ts = [base + dt.timedelta(seconds=int(s)) for s in secs]
    pdf = pd.DataFrame({"customer_id": cust, "transaction_date": ts})
    got = FT.purchase_gap_stats(spark.createDataFrame(pdf)).toPandas().set_index("customer_id")
    for cid, g in pdf.groupby("customer_id"):
        t = np.sort(g["transaction_date"].to_numpy())
        if len(t) < 2:
            assert pd.isna(got.loc[cid, "purchase_gap_mean"])
            continue
        gaps = np.array([pd.Timedelta(b - a).days for a, b in zip(t[:-1], t[1:])], dtype=float)
        assert got.loc[cid, "purchase_gap_mean"] == pytest.approx(gaps.mean())
        assert got.loc[cid, "purchase_gap_std"] == pytest.approx(gaps.std(), abs=1e-9)


def test_registered_sink_then_model_queries_share_a_session(spark):
    # the driver runs every registered query in one session: a sink query must not break
    # the model queries that follow it
    import __spark_entry__ as entry
    qs = entry.queries()
    assert qs["customers_sink_roundtrip"](spark, SF_SMALL).count() > 0
    assert qs["churn_threshold_curve_logistic"](spark, SF_SMALL).count() == 1
    assert qs["score_band_summary"](spark, SF_SMALL).count() == 1


def test_replace_into_partitioned_table_is_a_full_replace(spark, tmp_dir):
    # a replace keeps static overwrite semantics even when the session asks for dynamic
    db = "replace_test_" + os.path.basename(tmp_dir).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp_dir, 'wh')}'")
    spark.sql(f"CREATE TABLE {db}.p (id BIGINT, m STRING) USING parquet PARTITIONED BY (m)")
    rows = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("m"))
    assert IO.replace_into(rows, f"{db}.p") == 100
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert IO.replace_into(rows.where(F.col("m") == "0").limit(5), f"{db}.p") == 5
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert spark.table(f"{db}.p").count() == 5
