"""Month states in bucketed tables and JSON request streams."""

import json
import os
import uuid
from datetime import datetime

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import types as T

from basketlens.operators import features as FT
from basketlens.operators import month_store as MS
from basketlens.streaming import requests as REQ

LINE = "customer_id long, transaction_date timestamp_ntz, revenue double"
SNAP = "2024-01-01"


def _lines(spark):
    rows = [(1, datetime(2023, m, d), float(m * d)) for m in (1, 2, 3) for d in range(1, 28)]
    rows += [(2, datetime(2023, 2, 9), 4.0), (2, datetime(2023, 3, 9), None), (3, datetime(2023, 1, 1), 1.5), (4, None, 2.0), (9, datetime(2023, 2, 1), 8.0)]
    return spark.createDataFrame(rows, LINE)


def _store(spark, tmp_dir, tx):
    db = "months_" + uuid.uuid4().hex
    customers = spark.createDataFrame([(c, c % 2 == 0) for c in range(1, 9)], "customer_id long, is_premium boolean")
    MS.create_store(tx, customers, db, buckets=4, location=os.path.join(tmp_dir, db))
    return db


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_states_of_all_months_are_the_rfm_base(spark, tmp_dir):
    tx = _lines(spark)
    got = MS.rfm_of_months(spark, _store(spark, tmp_dir, tx), SNAP)
    assert _rows(got.select("customer_id", "recency_days", "frequency", "monetary_total")) == _rows(
        FT.rfm_base(tx, SNAP, "revenue").select("customer_id", "recency_days", "frequency", "monetary_total"))


def test_bucketed_join_has_no_exchange_and_reads_only_its_months(spark, tmp_dir):
    db = _store(spark, tmp_dir, _lines(spark))
    got = MS.rfm_of_months(spark, db, SNAP, "2023-02", "2023-02", ("is_premium",))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert "2023-02" in plan[plan.index("PartitionFilters"):]
    # customer 9 is unknown, 3 bought in another month, 4 has no date
    assert [(r["customer_id"], r["frequency"], r["monetary_total"], r["is_premium"]) for r in got.orderBy("customer_id").collect()] == [
        (1, 27, float(2 * sum(range(1, 28))), False), (2, 1, 4.0, True)]


def test_replaced_month_equals_a_rebuild(spark, tmp_dir):
    tx = _lines(spark)
    db = _store(spark, tmp_dir, tx)
    changed = tx.where("month(transaction_date) <> 2 or transaction_date is null or customer_id = 9").union(
        spark.createDataFrame([(3, datetime(2023, 2, 20), 70.0), (5, datetime(2023, 2, 21), 7.0)], LINE))
    MS.replace_month(spark, db, "2023-02", changed)
    assert _rows(MS.rfm_of_months(spark, db, SNAP)) == _rows(FT.rfm_base(changed, SNAP, "revenue"))
    MS.replace_month(spark, db, "2023-02", changed.limit(0))
    assert _rows(MS.rfm_of_months(spark, db, SNAP, "2023-02", "2023-02")) == []
    assert MS.rfm_of_months(spark, db, SNAP, "2023-01").count() == 3  # customers 1, 2 and 3
    with pytest.raises(ValueError):
        MS.replace_month(spark, db, "2023-02' or '1' = '1", changed)


def test_empty_store(spark, tmp_dir):
    db = _store(spark, tmp_dir, _lines(spark).limit(0))
    assert MS.rfm_of_months(spark, db, SNAP, customer_columns=("is_premium",)).count() == 0


def test_json_requests_good_plus_bad_is_input(spark, tmp_dir):
    data = spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "x double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression(maxIter=3)]).fit(data)
    schema = T.StructType([T.StructField("customer_id", T.LongType(), False), T.StructField("x", T.DoubleType(), False)])
    lines = ['{"customer_id": 1, "x": 2.5}', '{"x": 1.0, "customer_id": 2, "more": [1]}', '{"customer_id": 3, "x": 1', '', '[]', 'null', '7',
             '[{"customer_id": 8, "x": 1.0}]', '{"customer_id": "four", "x": 1.0}', '{"x": 1.0}', '{"customer_id": null, "x": 1.0}', '{"customer_id": 5}', '{"customer_id": 1, "x": 2.5}', '{}']
    src, out, dead = (os.path.join(tmp_dir, x) for x in ("src", "out", "dead"))
    os.mkdir(src)

    def run():
        for q in REQ.start_json_scoring(spark, model, src, schema, out, dead, os.path.join(tmp_dir, "cp"), required=("customer_id", "x")):
            q.awaitTermination()
        return sorted(r["customer_id"] for r in spark.read.parquet(out).collect()), sorted((r["reason"], r["value"]) for r in spark.read.parquet(dead).collect())
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    good, bad = run()
    assert good == [1, 1, 2] and len(good) + len(bad) == len(lines)
    assert [v for r, v in bad if r == "missing:customer_id"] == ['{"customer_id": null, "x": 1.0}', '{"x": 1.0}', '{}']
    assert [v for r, v in bad if r == "missing:x"] == ['{"customer_id": 5}']
    assert sorted(v for r, v in bad if r == "not_json") == sorted(['{"customer_id": 3, "x": 1', '', '[]', 'null', '7', '[{"customer_id": 8, "x": 1.0}]', '{"customer_id": "four", "x": 1.0}'])
    assert run() == (good, bad)  # nothing new: nothing twice
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write(json.dumps({"customer_id": 6, "x": 0.0}) + "\nbroken\n")
    again, worse = run()
    assert again == [1, 1, 2, 6] and len(worse) == len(bad) + 1


def test_requests_need_their_required_fields_in_the_schema(spark):
    with pytest.raises(ValueError):
        REQ.parsed(spark.createDataFrame([("{}",)], "value string"), T.StructType([T.StructField("x", T.LongType())]), ["customer_id"])
