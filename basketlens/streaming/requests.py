"""Scoring of JSON requests that arrive as lines of text files, with dead letters (op 58).

A line is a request if it is a JSON object of the schema and has the required fields. All
other lines go, as they came and with a reason, to a second sink, so that scored and dead
lines together are the input. Two queries read the same files, each with its own checkpoint
and file sink, so each line is written exactly once to exactly one of the sinks; both decide
by the same expression, which depends on the line alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.metrics import score_bands
from ..operators.ml import churn_probability

BAD_LINE = "_bad_line"
NOT_JSON = "not_json"


def parsed(lines: DataFrame, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """(value, request, reason) of lines of text. ``reason`` is null for requests, ``not_json``
    for lines that are empty, no JSON object or have a field of another type, and
    ``missing:<field>`` for the first required field that is absent or null. Unknown fields
    are ignored, absent ones that are not required are null."""
    absent = [c for c in required if c not in schema.names]
    if BAD_LINE in schema.names or absent:
        raise ValueError(f"schema must not have {BAD_LINE}, but all required fields (absent: {absent})")
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    whole = T.StructType([*fields, T.StructField(BAD_LINE, T.StringType(), True)])
    out = lines.select("value", F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}).alias("request"))
    bad = F.col("request").isNull() | F.col(f"request.{BAD_LINE}").isNotNull() | ~F.ltrim("value").startswith("{")
    reason: Column = F.when(F.coalesce(bad, F.lit(True)), F.lit(NOT_JSON))
    for c in required:
        reason = reason.when(F.col(f"request.`{c}`").isNull(), F.lit(f"missing:{c}"))
    return out.select("value", F.col("request").dropFields(BAD_LINE).alias("request"), reason.alias("reason"))


def _started(stream: DataFrame, sink_dir: str, checkpoint_dir: str, available_now: bool):
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)


def start_json_scoring(spark: SparkSession, model: PipelineModel, source_dir: str, schema: T.StructType, sink_dir: str,
                       dead_dir: str, checkpoint_dir: str, id_col: str = "customer_id", required: Sequence[str] | None = None,
                       available_now: bool = True):
    """Start both queries; returns (scored, dead) StreamingQuery objects. Scores have the columns
    of :func:`scoring.scored_stream`; dead letters (value, reason). ``required`` is the id unless given."""
    lines = parsed(spark.readStream.text(source_dir), schema, [id_col] if required is None else required)
    requests = lines.where("reason is null").select("request.*")
    scored = score_bands(churn_probability(model.transform(requests), "churn_probability").select(id_col, "churn_probability"))
    dead = lines.where("reason is not null").select("value", "reason")
    return (_started(scored, sink_dir, f"{checkpoint_dir}/scored", available_now),
            _started(dead, dead_dir, f"{checkpoint_dir}/dead", available_now))
