"""Last score per customer as keyed state of a stream whose files may come again (op 58).

Rows have an event time and an id. Inside the watermark an id counts once; rows behind the
watermark are late. Both are dropped and counted. What is left updates one state row per
customer, and every batch appends the new version of each changed customer to a Parquet sink, so
the sink is a change log with exactly-once files; :func:`latest` reads the last versions.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

PARTIAL = "_key {key}, _at long, _id {id}, _score double, _n long"
LOG = "_key {key}, _at long, _id {id}, _score double, _n long, _version long"


def batch_latest(frames):
    """Per Arrow batch and customer the last row by (time, id) and the number of rows, so that a
    customer with a third of all rows sends one row per batch through the shuffle."""
    for rows in frames:
        rows = rows.sort_values(["_at", "_id"])
        rows["_n"] = rows.groupby("_key")["_at"].transform("size")
        yield rows.drop_duplicates("_key", keep="last")[["_key", "_at", "_id", "_score", "_n"]]


def update_latest(key, frames, state):
    """Fold a customer's partial rows into its state (time, id, score, rows, version)."""
    at, row_id, score, n, version = state.get if state.exists else (None, None, None, 0, 0)
    for rows in frames:
        n += int(rows["_n"].sum())
        rows = rows.sort_values(["_at", "_id"])
        last_at, last_id, last_score = (rows[c].tolist()[-1] for c in ("_at", "_id", "_score"))
        if at is None or (last_at, last_id) > (at, row_id):
            at, row_id, score = last_at, last_id, None if pd.isna(last_score) else last_score
    state.update((at, row_id, score, n, version + 1))
    yield pd.DataFrame({"_key": [key[0]], "_at": [at], "_id": [row_id], "_score": pd.Series([score], dtype="float64"),
                        "_n": [n], "_version": [version + 1]})


def latest_stream(rows: DataFrame, key_col: str, id_col: str, event_time: str, score_col: str, watermark: str) -> DataFrame:
    """Change log (key, last_time, last_id, score, n_rows, version) of a streaming frame. Of rows of one
    time the largest id is last. Rows without key, id or time are left out; a NaN score is null."""
    types = {"key": rows.schema[key_col].dataType.simpleString(), "id": rows.schema[id_col].dataType.simpleString()}
    once = (rows.where(F.col(key_col).isNotNull() & F.col(id_col).isNotNull() & F.col(event_time).isNotNull())
            .select(F.col(key_col).alias("_key"), F.col(id_col).alias("_id"), F.col(event_time).cast("timestamp").alias("_time"),
                    F.col(score_col).cast("double").alias("_score"))
            .withWatermark("_time", watermark).dropDuplicatesWithinWatermark(["_id"]))
    partial = (once.select("_key", F.unix_micros("_time").alias("_at"), "_id", "_score")
               .mapInPandas(batch_latest, PARTIAL.format(**types)))
    state = "_at long, _id {id}, _score double, _n long, _version long".format(**types)
    log = partial.groupBy("_key").applyInPandasWithState(update_latest, LOG.format(**types), state, "append", GroupStateTimeout.NoTimeout)
    return log.select(F.col("_key").alias(key_col), F.timestamp_micros("_at").alias("last_time"), F.col("_id").alias("last_id"),
                      F.col("_score").alias("score"), F.col("_n").alias("n_rows"), F.col("_version").alias("version"))


def log_schema(schema: T.StructType, key_col: str, id_col: str) -> T.StructType:
    """Schema of the change log; a log of no rows has no file to read it from."""
    return (T.StructType().add(key_col, schema[key_col].dataType).add("last_time", T.TimestampType())
            .add("last_id", schema[id_col].dataType).add("score", T.DoubleType()).add("n_rows", T.LongType()).add("version", T.LongType()))


def start_latest(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, checkpoint_dir: str, key_col: str,
                 id_col: str, event_time: str, score_col: str, watermark: str = "1 day", available_now: bool = True):
    """Start the stream over Parquet files into the change log; returns the StreamingQuery. A
    restart with the same checkpoint goes on where the last run ended."""
    rows = spark.readStream.schema(schema).parquet(source_dir)
    stream = latest_stream(rows, key_col, id_col, event_time, score_col, watermark)
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)


def latest(log: DataFrame, key_col: str) -> DataFrame:
    """The last version of each customer of a change log."""
    rest: Sequence[str] = [c for c in log.columns if c != key_col]
    return log.groupBy(key_col).agg(F.max_by(F.struct(*rest), "version").alias("s")).select(key_col, "s.*")


def dropped(query) -> dict[str, int]:
    """Rows that a query's batches dropped: ``late`` (behind the watermark) and ``duplicate`` (id seen
    inside it). Spark keeps the progress of spark.sql.streaming.numRecentProgressUpdates batches."""
    out = {"late": 0, "duplicate": 0}
    for progress in query.recentProgress:
        for operator in progress["stateOperators"]:
            if operator["operatorName"] == "dedupeWithinWatermark":
                out["late"] += operator["numRowsDroppedByWatermark"]
                out["duplicate"] += operator["customMetrics"].get("numDroppedDuplicateRows", 0)
    return out
