"""Joins and membership tests whose hot keys neither meet in one task nor grow a broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scalar

HOT = 1 << 16   # most keys that count as hot (bounds the broadcast)
BITS = 1 << 26  # of a bitmap of hashed values (8 MB)


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Left join with a table that is unique in ``keys``; its column ``weight`` (dropped) says
    how many rows of ``left`` have the key, at least. Keys that hold one in HOT rows or more,
    of which there are HOT at most, are broadcast; the others are joined by a shuffle. Both
    frames are read twice, so they should be written ones; keys must not be null."""
    total = scalar(right.agg(F.sum(F.col(weight).cast("long")))) or 0
    hot = F.col(weight).cast("long") * HOT >= F.lit(total)
    first = right.where(hot).drop(weight).withColumn("__hot", F.lit(True))
    met = left.join(F.broadcast(first), list(keys), "left")
    added = [c for c in right.columns if c not in (*keys, weight)]
    rest = met.where("__hot is null").drop("__hot", *added)
    return met.where("__hot").drop("__hot").unionByName(rest.join(right.where(~hot).drop(weight), list(keys), "left"))


def place(value: Column) -> Column:
    """A value's bit, from 1."""
    return F.pmod(F.xxhash64(value), F.lit(BITS)) + 1


def bitmap(values: DataFrame, label: str) -> DataFrame:
    """The bits of a frame's one column, as at most BITS / 32768 written rows of 4 KB."""
    at = place(F.col(values.columns[0]))
    return materialize(values.groupBy(F.bitmap_bucket_number(at).alias("__map"))
                       .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits")), label)


def listed(df: DataFrame, maps: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with a column ``name``: whether the value may be among the bitmap's values
    (always true if it is; a crowded bitmap only says so more often)."""
    at = place(value)
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    inside = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) > 0, F.lit(False))
    return df.join(F.broadcast(maps), F.bitmap_bucket_number(at) == F.col("__map"), "left").withColumn(name, inside).drop("__map", "__bits")
