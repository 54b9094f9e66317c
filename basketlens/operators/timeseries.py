"""Revenue series (ops 48-50), re-aimed from one series to many: every function takes
optional key columns, the calendar and aggregation run as Spark jobs, and the per-series
fits run in ``applyInPandas`` (one group = one series, whose length is bounded by the
calendar, not by the number of transactions).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import net_revenue

# ---------------------------------------------------------------------------------------
# op 48: resampled revenue


# Period codes -> (truncation, step between starts).
FREQUENCIES = {
    "D": ("day", "INTERVAL 1 DAY"),
    "W": ("week", "INTERVAL 7 DAYS"),      # Monday to Sunday, labelled by the Sunday
    "M": ("month", "INTERVAL 1 MONTH"),    # labelled by the last day
    "Q": ("quarter", "INTERVAL 3 MONTHS"),  # labelled by the last day
}


def _check_frequency(freq: str) -> None:
    if freq not in FREQUENCIES:
        raise ValueError(f"no period {freq!r}; there are {', '.join(FREQUENCIES)}")


def period_label(start, freq: str):
    """The label of the period that starts at the date ``start``: its last day."""
    if freq == "D":
        return start
    if freq == "W":
        return F.date_add(start, 6)
    return F.last_day(F.add_months(start, 2 if freq == "Q" else 0))


def revenue_timeseries(tx: DataFrame, by: Sequence[str] = (), date_col: str = "transaction_date",
                       revenue: str | None = None, freq: str = "M") -> DataFrame:
    """Net revenue per day, week, month or quarter (``freq`` D, W, M or Q), labelled by the
    period's last day (``period``, midnight), gap-free from each series' first to last
    period (empty periods are 0.0). Rows without a date are in no period."""
    _check_frequency(freq)
    by = list(by)
    rev = F.col(revenue) if revenue else net_revenue()
    unit, step = FREQUENCIES[freq]
    day = F.col(date_col).cast("date")
    start = day if freq == "D" else F.trunc(day, unit)
    sums = (tx.where(F.col(date_col).isNotNull()).groupBy(*by, start.alias("_m"))
            .agg(F.sum(rev).alias("revenue")))
    span = sums.groupBy(*by).agg(F.min("_m").alias("_lo"), F.max("_m").alias("_hi"))
    calendar = span.where("_lo is not null").select(
        *by, F.explode(F.sequence("_lo", "_hi", F.expr(step))).alias("_m"))
    c, r = calendar.alias("c"), sums.alias("r")
    match = F.col("c._m") == F.col("r._m")
    for k in by:
        match = match & F.col(f"c.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    return c.join(r, match, "left").select(
        *[F.col(f"c.`{k}`").alias(k) for k in by], period_label(F.col("c._m"), freq).cast("timestamp_ntz").alias("period"),
        F.coalesce(F.col("r.revenue"), F.lit(0.0)).alias("revenue"))


# ---------------------------------------------------------------------------------------
# op 49: augmented Dickey-Fuller per series

# MacKinnon response-surface constants for the constant-only regression with
# one variable (MacKinnon 1994 p-value surface; MacKinnon 2010 critical values).
ADF_TAU_MAX = 2.74
ADF_TAU_MIN = -18.83
ADF_TAU_STAR = -1.61
ADF_SMALLP = [2.1659, 1.4412, 0.038269]
ADF_LARGEP = [1.7339, 0.93202, -0.12745, -0.010368]
ADF_CRIT = {  # level: coefficients of 1, 1/T, 1/T^2, 1/T^3
    "1%": [-3.43035, -6.5393, -16.786, -79.433],
    "5%": [-2.86154, -2.8903, -4.234, -40.040],
    "10%": [-2.56677, -1.5384, -2.809, 0.0],
}


def _ols(y: np.ndarray, x: np.ndarray):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    ssr = float(resid @ resid)
    return beta, resid, ssr


def _norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def adf_test(values: np.ndarray) -> dict:
    """ADF with a constant, lag order chosen by AIC up to 12 (n/100)^(1/4)."""
    x = np.asarray(values, dtype=float)
    n = len(x)
    default = {"adf_statistic": 0.0, "p_value": 1.0, "is_stationary": False, "crit_1": 0.0,
               "crit_5": 0.0, "crit_10": 0.0, "recommended_differencing": 1, "used_lag": 0,
               "nobs": n}
    if n < 5:
        return default
    maxlag = int(math.ceil(12.0 * (n / 100.0) ** 0.25))
    maxlag = min(n // 2 - 2, maxlag)
    if maxlag < 0:
        return default
    dx = np.diff(x)

    def design(lag):
        rows = len(dx) - lag
        cols = [x[lag:lag + rows]]                      # level x_{t-1}
        cols += [dx[lag - j:lag - j + rows] for j in range(1, lag + 1)]
        return np.column_stack(cols), dx[lag:]

    # lag search on the common sample of the largest lag
    full, y_full = design(maxlag)
    nobs = len(y_full)
    best = None
    for lag in range(0, maxlag + 1):
        xs = np.column_stack([np.ones(nobs), full[:, :1 + lag]])
        _, _, ssr = _ols(y_full, xs)
        if ssr <= 0:
            continue
        aic = nobs * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1) + 2 * xs.shape[1]
        if best is None or aic < best[0]:
            best = (aic, lag)
    lag = 0 if best is None else best[1]
    xd, y = design(lag)
    nobs = len(y)
    xs = np.column_stack([xd, np.ones(nobs)])
    beta, resid, ssr = _ols(y, xs)
    dof = nobs - xs.shape[1]
    if dof <= 0 or ssr <= 0:
        return default
    sigma2 = ssr / dof
    cov = sigma2 * np.linalg.pinv(xs.T @ xs)
    stat = float(beta[0] / math.sqrt(cov[0, 0]))
    if stat > ADF_TAU_MAX:
        p = 1.0
    elif stat < ADF_TAU_MIN:
        p = 0.0
    else:
        coef = ADF_SMALLP if stat <= ADF_TAU_STAR else ADF_LARGEP
        p = _norm_cdf(sum(c * stat ** i for i, c in enumerate(coef)))
    crit = {k: sum(c / nobs ** i for i, c in enumerate(v)) for k, v in ADF_CRIT.items()}
    return {"adf_statistic": stat, "p_value": p, "is_stationary": p < 0.05,
            "crit_1": crit["1%"], "crit_5": crit["5%"], "crit_10": crit["10%"],
            "recommended_differencing": 0 if p < 0.05 else 1, "used_lag": lag, "nobs": nobs}


ADF_FIELDS = [("adf_statistic", T.DoubleType()), ("p_value", T.DoubleType()),
              ("is_stationary", T.BooleanType()), ("crit_1", T.DoubleType()),
              ("crit_5", T.DoubleType()), ("crit_10", T.DoubleType()),
              ("recommended_differencing", T.IntegerType()), ("used_lag", T.IntegerType()),
              ("nobs", T.IntegerType())]


def stationarity(series: DataFrame, by: Sequence[str] = (), value: str = "revenue",
                 period: str = "period") -> DataFrame:
    """One ADF result row per series (fewer than 5 points -> fixed non-stationary default)."""
    by = list(by)
    src, keys = _key_frame(series, by)
    schema = T.StructType([src.schema[k] for k in keys] + [T.StructField(n, t) for n, t in ADF_FIELDS])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(period)
        row = {k: pdf[k].iloc[0] for k in keys}
        row.update(adf_test(pdf[value].to_numpy(dtype=float)))
        return pd.DataFrame([row], columns=[f.name for f in schema.fields])

    out = src.groupBy(*keys).applyInPandas(run, schema)
    return out if by else out.drop("_all")


# ---------------------------------------------------------------------------------------
# op 50: seasonal forecast per series

Z95 = 1.959963984540054


def differencing(y: np.ndarray, d: int | None) -> int:
    """``d``, or what the stationarity test recommends for the series if it is None; never
    more than leaves one difference."""
    if d is None:
        d = adf_test(y)["recommended_differencing"]
    if d not in (0, 1, 2):
        raise ValueError("the differencing is 0, 1 or 2")
    return min(d, max(len(y) - 1, 0))


def seasonal_ar_fit(y: np.ndarray, season: int = 12, d: int = 1):
    """Fit z_t = c + a z_{t-1} + b z_{t-s} on the d-th difference z of y, without the
    seasonal term if the series has at most season + 3 differences or season is 0, and with
    the constant alone if there are too few for a slope. Returns (coefficients (c, a, b),
    sigma^2, fitted y, whether the seasonal term is in)."""
    y = np.asarray(y, dtype=float)
    n = len(y)
    fitted = np.full(n, np.nan)
    z = np.diff(y, n=d)
    if n < 3 or len(z) < 2:
        return (float(np.mean(z)) if len(z) else 0.0, 0.0, 0.0), 0.0, fitted, False
    use_season = season > 0 and len(z) > season + 3
    start = season if use_season else 1
    rows = len(z) - start
    if rows < 2:
        c = float(np.mean(z))
        resid = z - c
        fitted[d:] = y[d:] - resid
        return (c, 0.0, 0.0), float(resid @ resid / max(len(z) - 1, 1)), fitted, False
    cols = [np.ones(rows), z[start - 1:start - 1 + rows]]
    if use_season:
        cols.append(z[0:rows])
    xs = np.column_stack(cols)
    beta, resid, ssr = _ols(z[start:], xs)
    fitted[d + start:] = y[d + start:] - resid
    b = float(beta[2]) if use_season else 0.0
    return (float(beta[0]), float(beta[1]), b), ssr / max(rows - xs.shape[1], 1), fitted, use_season


def seasonal_ar_forecast(y: np.ndarray, steps: int, season: int = 12, d: int | None = 1):
    """h-step means and 95% intervals (psi-weights of (1 - aB - bB^s)(1 - B)^d). Returns
    (rows of (mean, low, high), fitted y, used d, whether the seasonal term is in)."""
    y = np.asarray(y, dtype=float)
    d = differencing(y, d)
    (c, a, b), sigma2, fitted, seasonal = seasonal_ar_fit(y, season, d)
    z = list(np.diff(y, n=d))
    lasts = [float(np.diff(y, n=k)[-1]) for k in range(d)]  # of the levels below z
    means = []
    for _ in range(steps):
        value = c + a * (z[-1] if z else 0.0) + b * (z[-season] if season and len(z) >= season else 0.0)
        z.append(value)
        for k in range(d - 1, -1, -1):
            lasts[k] += value
            value = lasts[k]
        means.append(value)
    poly = np.zeros(max(season, 1) + 1)
    poly[0] = 1.0
    poly[1] -= a
    if season:
        poly[season] -= b
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    psi = [1.0]
    for j in range(1, steps):
        psi.append(-sum(poly[k] * psi[j - k] for k in range(1, min(j, len(poly) - 1) + 1)))
    out = []
    for h, m in enumerate(means, start=1):
        se = math.sqrt(max(sigma2, 0.0) * sum(p * p for p in psi[:h]))
        out.append((m, m - Z95 * se, m + Z95 * se))
    return out, fitted, d, seasonal


def _key_frame(series: DataFrame, by: list[str]):
    if by:
        return series, by
    return series.withColumn("_all", F.lit(0)), ["_all"]


def _ahead(last: pd.Timestamp, h: int, freq: str) -> pd.Timestamp:
    if freq in "DW":
        return last + pd.Timedelta(days=h * (7 if freq == "W" else 1))
    return last + (pd.offsets.MonthEnd(h) if freq == "M" else pd.offsets.QuarterEnd(h))


def seasonal_forecast(series: DataFrame, steps: int = 3, by: Sequence[str] = (), season: int = 12,
                      value: str = "revenue", period: str = "period", d: int | None = None,
                      freq: str = "M") -> DataFrame:
    """(key..., forecast_date, predicted_revenue, lower_ci_95, upper_ci_95, used_d,
    seasonal) for the next ``steps`` periods of every series. ``d`` is the differencing;
    None takes the stationarity test's recommendation for each series. ``season`` is the
    seasonal lag in periods (0: none); ``seasonal`` says whether its term is in the fit
    (series of at most season + 3 differences are too short for it)."""
    _check_frequency(freq)
    by = list(by)
    src, keys = _key_frame(series, by)
    schema = T.StructType([src.schema[k] for k in keys] + [
        T.StructField("forecast_date", T.TimestampNTZType()), T.StructField("predicted_revenue", T.DoubleType()),
        T.StructField("lower_ci_95", T.DoubleType()), T.StructField("upper_ci_95", T.DoubleType()),
        T.StructField("used_d", T.IntegerType()), T.StructField("seasonal", T.BooleanType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(period)
        fc, _, used, seasonal = seasonal_ar_forecast(pdf[value].to_numpy(dtype=float), steps, season, d)
        last = pd.Timestamp(pdf[period].iloc[-1])
        rows = []
        for h, (m, lo, hi) in enumerate(fc, start=1):
            row = {k: pdf[k].iloc[0] for k in keys}
            row.update(forecast_date=_ahead(last, h, freq).to_pydatetime(), predicted_revenue=m, lower_ci_95=lo,
                       upper_ci_95=hi, used_d=used, seasonal=seasonal)
            rows.append(row)
        return pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    out = src.groupBy(*keys).applyInPandas(run, schema)
    return out if by else out.drop("_all")


def fitted_values(series: DataFrame, by: Sequence[str] = (), season: int = 12,
                  value: str = "revenue", period: str = "period", d: int | None = None) -> DataFrame:
    """In-sample one-step fitted values (key..., period, fitted); null where no fit exists.
    ``season`` and ``d`` as in :func:`seasonal_forecast`."""
    by = list(by)
    src, keys = _key_frame(series, by)
    schema = T.StructType([src.schema[k] for k in keys] + [
        T.StructField(period, T.TimestampNTZType()), T.StructField("fitted", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(period)
        y = pdf[value].to_numpy(dtype=float)
        out = pdf[keys + [period]].copy()
        out["fitted"] = seasonal_ar_fit(y, season, differencing(y, d))[2]
        return out

    out = src.groupBy(*keys).applyInPandas(run, schema)
    return out if by else out.drop("_all")
