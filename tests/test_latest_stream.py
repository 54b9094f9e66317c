"""Last score per customer as keyed state: duplicates, late rows, replays, ties, nulls."""
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from basketlens.streaming import latest as LS

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, customer_id long, at timestamp, score double"


def hour(h):
    return START + timedelta(hours=h)


def test_replayed_files_change_nothing_and_all_rows_are_accounted_for(spark, tmp_dir):
    src, out, cp = (os.path.join(tmp_dir, x) for x in ("src", "out", "cp"))

    def arrive(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        df.coalesce(2).write.mode("append").parquet(src)
        query = LS.start_latest(spark, src, df.schema, out, cp, "customer_id", "event_id", "at", "score", "24 hours")
        query.awaitTermination()
        log = spark.read.parquet(out)
        got = {r["customer_id"]: (r["last_id"], r["last_time"], r["score"], r["n_rows"]) for r in LS.latest(log, "customer_id").collect()}
        return got, LS.dropped(query)

    first = [(1, 7, hour(0), 0.1), (2, 7, hour(5), 0.2), (3, 8, hour(5), None), (4, 8, hour(4), 0.4),
             (5, 7, hour(5), 0.5), (5, 7, hour(5), 0.5), (None, 7, hour(1), 0.9), (6, None, hour(1), 0.9), (7, 7, None, 0.9)]
    got, gone = arrive(first)
    want = {7: (5, hour(5), 0.5, 3), 8: (3, hour(5), None, 2)}  # of one time the largest id; no score is no score
    assert got == want and gone == {"late": 0, "duplicate": 1}
    assert arrive(first) == (want, {"late": 0, "duplicate": 6})  # inside the watermark: all seen
    second = [(10, 7, hour(100), 0.7), (11, 9, hour(90), 0.3), (12, 8, hour(3), 0.8)]  # an old row before the watermark moves counts
    got, gone = arrive(second)
    want = {7: (10, hour(100), 0.7, 4), 8: (3, hour(5), None, 3), 9: (11, hour(90), 0.3, 1)}
    assert got == want and gone == {"late": 0, "duplicate": 0}
    got, gone = arrive(first + second + [(13, 9, hour(20), 0.6)])  # behind hour 76
    assert got == want and gone == {"late": 8, "duplicate": 2}


def test_a_stream_without_usable_rows_has_an_empty_log(spark, tmp_dir):
    src, out, cp = (os.path.join(tmp_dir, x) for x in ("src", "out", "cp"))
    df = spark.createDataFrame([(1, None, hour(0), 0.5)], SCHEMA)
    df.write.parquet(src)
    LS.start_latest(spark, src, df.schema, out, cp, "customer_id", "event_id", "at", "score").awaitTermination()
    log = spark.read.schema(LS.log_schema(df.schema, "customer_id", "event_id")).parquet(out)
    assert LS.latest(log, "customer_id").count() == 0
    assert log.schema == LS.latest_stream(spark.readStream.schema(df.schema).parquet(src), "customer_id", "event_id", "at", "score", "1 day").schema


def test_one_customer_with_most_rows_sends_one_row_a_batch(spark):
    import pandas as pd
    rows = pd.DataFrame({"_key": [1] * 50 + [2], "_at": [*range(50), 3], "_id": range(51), "_score": 0.5})
    (part,) = LS.batch_latest([rows])
    assert sorted(part[["_key", "_at", "_id", "_n"]].itertuples(index=False, name=None)) == [(1, 49, 49, 50), (2, 3, 50, 1)]


def test_last_version_of_a_log(spark):
    log = spark.createDataFrame([(1, 0.1, 1), (1, 0.2, 2), (2, 0.3, 1)], "customer_id long, score double, version long")
    assert sorted(tuple(r) for r in LS.latest(log, "customer_id").select("customer_id", "score").collect()) == [(1, 0.2), (2, 0.3)]
    assert LS.latest(log.where(F.lit(False)), "customer_id").count() == 0
