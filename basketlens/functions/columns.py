"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A timestamp-without-time-zone literal from 'YYYY-MM-DD[ HH:MM:SS]' or a datetime."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def as_datetime(value) -> _dt.datetime:
    if isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    return _dt.datetime.fromisoformat(str(value))


def elapsed_days(later, earlier) -> Column:
    """Whole days of elapsed time, floored (negative when ``later`` precedes ``earlier``).

    This is timedelta ``.days`` semantics, not calendar ``datediff``: 1 day 23 h is 1 day,
    and -1 h is -1 day.
    """
    micros = F.timestamp_diff("MICROSECOND", col(earlier).cast("timestamp_ntz"),
                              col(later).cast("timestamp_ntz"))
    return F.floor(micros.cast("double") / F.lit(float(MICROS_PER_DAY)))


def gross_revenue(quantity="quantity", unit_price="unit_price", discount="discount_pct") -> Column:
    """quantity * unit_price * (1 - discount), returns ignored."""
    return col(quantity) * col(unit_price) * (F.lit(1.0) - col(discount))


def net_revenue(quantity="quantity", unit_price="unit_price", discount="discount_pct",
                return_flag="return_flag") -> Column:
    """Gross revenue, forced to 0.0 for returned lines."""
    return F.when(col(return_flag) == 1, F.lit(0.0)).otherwise(
        gross_revenue(quantity, unit_price, discount))


def return_adjusted_revenue(gross: Column, return_flag="return_flag") -> Column:
    """gross * (1 - return_flag)."""
    return gross * (F.lit(1.0) - col(return_flag).cast("double"))


# RFM segment cut-offs on the 3..15 total score.
SEGMENT_RULES = [(13, "Champions"), (10, "Loyal"), (7, "At Risk"), (4, "Hibernating")]
SEGMENT_OTHERWISE = "Lost"


def rfm_segment(total) -> Column:
    expr = None
    for cut, name in SEGMENT_RULES:
        cond = col(total) >= cut
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(SEGMENT_OTHERWISE)


# Churn risk bands on a probability (Low < 0.3, Medium <= 0.6, High above).
RISK_LOW_BELOW = 0.3
RISK_MEDIUM_UP_TO = 0.6


def risk_band(probability) -> Column:
    """Low, Medium or High; null for a null or NaN probability."""
    p = col(probability)
    return (F.when(p.isNull() | F.isnan(p.cast("double")), F.lit(None).cast("string"))
            .when(p < RISK_LOW_BELOW, "Low")
            .when(p <= RISK_MEDIUM_UP_TO, "Medium")
            .otherwise("High"))


def safe_ratio(num, den, default: float = 0.0) -> Column:
    """num / den, ``default`` when the denominator is 0 or null (never NaN or infinity)."""
    return F.when(col(den).isNull() | (col(den) == 0), F.lit(default)).otherwise(
        col(num).cast("double") / col(den))


def comparable(c) -> Column:
    """Snap a double to a magnitude-dependent binary grid, NaN/inf to null.

    Used only by the registered queries so that Spark and the SQL oracle agree despite
    different float summation orders. Scaling by powers of two is exact, so both engines
    produce bit-identical results from identical inputs, and decimal-clean values (such as
    1.49 / 32 = 0.0465625) never sit on a rounding tie as they would on a decimal grid.
    """
    x = col(c)
    a = F.abs(x)
    return (F.when(x.isNull() | F.isnan(x) | (a == F.lit(float("inf"))), F.lit(None).cast("double"))
            .when(a >= 134217728.0, F.floor(x + 0.5).cast("double"))
            .when(a >= 1048576.0, F.floor(x * 128.0 + 0.5) / 128.0)
            .when(a >= 8192.0, F.floor(x * 16384.0 + 0.5) / 16384.0)
            .otherwise(F.floor(x * 1048576.0 + 0.5) / 1048576.0))
