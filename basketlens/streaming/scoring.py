"""Streaming churn scoring (op 58): feature rows arriving as files are scored by a fitted
PipelineModel, banded, and written exactly once (checkpointed file sink); a watermarked
tumbling window counts customers per risk band.

The source is a file stream (Parquet); no sockets or servers are involved. ``availableNow``
processes everything present and stops, which is how batch backfills and tests run it.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.metrics import score_bands
from ..operators.ml import churn_probability


def scored_stream(spark: SparkSession, model: PipelineModel, source_dir: str, schema: StructType,
                  id_col: str = "customer_id", keep: tuple[str, ...] = (),
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame (id, keep..., churn_probability, churn_prediction, risk_level)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source_dir)
    scored = churn_probability(model.transform(rows), "churn_probability")
    return score_bands(scored.select(id_col, *keep, "churn_probability"))


def start_scoring(spark: SparkSession, model: PipelineModel, source_dir: str, schema: StructType,
                  sink_dir: str, checkpoint_dir: str, id_col: str = "customer_id",
                  available_now: bool = True):
    """Start the scoring stream into a Parquet sink; returns the StreamingQuery."""
    stream = scored_stream(spark, model, source_dir, schema, id_col)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)


def start_band_counts(spark: SparkSession, model: PipelineModel, source_dir: str, schema: StructType,
                      event_time: str, sink_dir: str, checkpoint_dir: str, window: str = "1 day",
                      watermark: str = "1 day", id_col: str = "customer_id",
                      available_now: bool = True):
    """Risk-band counts per tumbling ``window`` of ``event_time`` (late rows beyond the
    watermark are dropped; a window is emitted once the watermark passes its end)."""
    stream = scored_stream(spark, model, source_dir, schema, id_col, keep=(event_time,))
    counts = (stream.withWatermark(event_time, watermark)
              .groupBy(F.window(event_time, window).alias("window"), "risk_level")
              .agg(F.count(F.lit(1)).alias("customers"))
              .select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "risk_level", "customers"))
    writer = (counts.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)
