"""Registered queries: one Spark plan per operator over the test tables, each paired with
an independent SQL statement for the DuckDB oracle (None where only rows can be checked).

Every query reads whole tables through the adapter; nothing is subset or capped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import comparable

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn: Builder) -> Builder:
        # re-importing a module (e.g. a reload) replaces its entries
        REGISTRY[name] = Query(name, fn, sql, note)
        return fn
    return deco


def comparable_frame(df: DataFrame) -> DataFrame:
    """Snap double columns to the comparison grid (see functions.columns.comparable)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(comparable(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from . import queries_features, queries_analysis, queries_models, queries_ml, queries_contracts, queries_scale, queries_stores  # noqa: F401
    return REGISTRY
