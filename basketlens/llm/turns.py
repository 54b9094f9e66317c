"""Turns of conversations in order, without one task per conversation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import running_totals

#: characters of role and text that order rows of one turn; digests decide beyond them
HEAD = 256


def turn_order() -> list[Column]:
    """Sort keys inside a conversation: turn (null first), then role and text (their first
    HEAD characters, then a digest), so that the order is defined for repeated turns too.
    Keys are of bounded length, since range partitioning takes samples of them."""
    return [F.col("turn").asc_nulls_first(), F.substring("role", 1, HEAD), F.substring("text", 1, HEAD),
            F.md5(F.concat_ws(":", F.length("role"), F.col("role"), F.col("text"))), F.col("_spread")]


def placed(rows: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """``rows`` (columns of ``by``, turn, role, text, ...) with ``pos`` (from 1) and ``n``, the
    conversation's number of rows. Range partitions cut even a single conversation that
    holds a third of all rows, or equal rows of one turn (spread by their row number)."""
    spread = rows.withColumn("_spread", F.monotonically_increasing_id())
    ranked = running_totals(spread, turn_order(), by, label=label)
    return ranked.withColumnRenamed("_rank", "pos").withColumnRenamed("_n", "n").drop("_spread")
