"""Exact quantiles of many columns without a sort: selection by histogram refinement.

Every round counts all columns at once into a bounded number of bins (map-side combined, so
a round shuffles bins, not values) and narrows each asked rank to the one bin that holds it.
A bin knows its least and greatest value, so a rank is found as soon as its bin holds one
distinct value or the rank is the bin's first or last. Each round divides the range by BINS:
usual columns take two rounds, whatever the number of rows; a column whose values
span many orders of magnitude takes more, never a sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1 << 14  # of one range in one round: what a column sends to the driver at most


@dataclass
class Quantiles:
    """Of one column: ``n`` values (neither null nor NaN), least, greatest, and the asked
    quantiles in order (None if there is no value)."""
    n: int
    least: float | None
    greatest: float | None
    values: list[float | None]


@dataclass
class _Range:
    """Values of one column from ``low`` to ``high``: ``before`` values are less; ``ranks``
    (0-based) lie in it."""
    column: str
    low: float
    high: float
    before: int
    ranks: set[int] = field(default_factory=set)

    def bin_of(self, v: Column) -> Column:
        """Monotone in ``v``: halves keep the width finite; infinities have bins of their own."""
        if math.isinf(self.low) or math.isinf(self.high):
            return F.when(v == -math.inf, 0).when(v == math.inf, BINS - 1).otherwise(1)
        width = self.high / 2 - self.low / 2
        if width == 0:  # neighbouring numbers
            return F.when(v == self.low, 0).otherwise(BINS - 1)
        share = (v / 2 - F.lit(self.low / 2)) / F.lit(width)
        return F.least(F.floor(share * BINS).cast("int"), F.lit(BINS - 1))


def valid(column: str) -> Column:
    """The column as double, null where it is NaN."""
    v = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(v), v)


def extent(columns: Sequence[str]) -> list[Column]:
    """Aggregates that :func:`exact_quantiles_of` starts from, to be put beside others."""
    return [a for i, c in enumerate(columns) for a in (
        F.count(valid(c)).alias(f"_n{i}"), F.min(valid(c)).alias(f"_lo{i}"), F.max(valid(c)).alias(f"_hi{i}"))]


def _count(df: DataFrame, ranges: list[_Range]) -> dict[int, list[tuple[int, float, float]]]:
    """Per range, (count, least, greatest) of its bins in order; one job for all ranges."""
    by_column: dict[str, list[int]] = {}
    for k, r in enumerate(ranges):
        by_column.setdefault(r.column, []).append(k)
    items = []
    for column, mine in by_column.items():
        v = valid(column)
        bin_ = F.lit(None).cast("int")
        for k in mine:
            r = ranges[k]
            bin_ = F.when((v >= F.lit(r.low)) & (v <= F.lit(r.high)), F.lit(k * BINS) + r.bin_of(v)).otherwise(bin_)
        items.append(F.struct(bin_.alias("bin"), v.alias("v")))
    rows = df.select(F.inline(F.array(*items))).where("bin is not null")
    out: dict[int, list[tuple[int, float, float]]] = {k: [] for k in range(len(ranges))}
    counted = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    got = counted.toPandas().sort_values("bin")  # at most BINS rows of each range
    for bin_, n, low, high in zip(*(got[c].tolist() for c in ("bin", "n", "lo", "hi"))):
        out[bin_ // BINS].append((n, low, high))
    return out


def exact_quantiles_of(df: DataFrame, columns: Sequence[str], probs: Sequence[float], start=None) -> dict[str, Quantiles]:
    """Exact quantiles with linear interpolation (position (n - 1) q), nulls and NaN ignored,
    of all ``columns`` at once. ``start`` is a row with :func:`extent` of the columns if the
    caller has one. ``df`` is read once for that and once a round."""
    columns = list(columns)
    if not columns:
        return {}
    if start is None:
        start = df.agg(*extent(columns)).first()
    found: dict[tuple[str, int], float] = {}
    open_: list[_Range] = []
    for i, c in enumerate(columns):
        n, low, high = start[f"_n{i}"], start[f"_lo{i}"], start[f"_hi{i}"]
        if not n:
            continue
        asked = {rank for q in probs for rank in (math.floor((n - 1) * q), math.ceil((n - 1) * q))}
        _settle(found, open_, _Range(c, low, high, 0, asked), n)
    while open_:
        ranges, open_ = open_, []
        for k, bins in _count(df, ranges).items():
            before = ranges[k].before
            for n, low, high in bins:
                inside = {r for r in ranges[k].ranks if before <= r < before + n}
                if inside:
                    _settle(found, open_, _Range(ranges[k].column, low, high, before, inside), n)
                before += n
    out = {}
    for i, c in enumerate(columns):
        n, values = start[f"_n{i}"], []
        for q in probs:
            h = (n - 1) * q
            if n:
                a, b = found[c, math.floor(h)], found[c, math.ceil(h)]
                values.append(a + (b - a) * (h - math.floor(h)))
            else:
                values.append(None)
        out[c] = Quantiles(n, start[f"_lo{i}"], start[f"_hi{i}"], values)
    return out


def _settle(found: dict, open_: list[_Range], r: _Range, n: int) -> None:
    """Ranks of a range of n values that are known by its ends; the others stay open."""
    for rank in sorted(r.ranks):
        if r.low == r.high or rank == r.before:
            found[r.column, rank] = r.low
        elif rank == r.before + n - 1:
            found[r.column, rank] = r.high
    r.ranks = {k for k in r.ranks if (r.column, k) not in found}
    if r.ranks:
        open_.append(r)
