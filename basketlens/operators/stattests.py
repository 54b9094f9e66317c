"""Rank and count tests (ops 30-33). Ranks and counts are computed in Spark; only the final
tail probability runs in a pandas UDF over a one-row (or one-row-per-feature) frame.

Small samples have exact p-values: Mann-Whitney where the smaller one has at most
``exact_rows`` values and none is tied (and n1 * n2 stays within ``exact_cells``; the normal
approximation, tie- and continuity-corrected, holds elsewhere), the two-sample KS where the
larger one has at most ``exact_rows`` values. KS takes that as an option: by default its
p-value is the asymptotic Kolmogorov distribution at sqrt(n m / (n + m)) * D.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import gross_revenue
from ..functions.stats import chi2_sf_udf, kolmogorov_exact_udf, kolmogorov_sf_udf, mann_whitney_exact_udf, norm_sf_udf
from ..session import materialize
from .ranks import exact_quantiles, running_totals, tie_average_ranks

CID = "customer_id"
ALPHA = 0.05
#: fixed values: the usual switch-over of the exact tests to their approximations
EXACT_U_ROWS = 8
EXACT_KS_ROWS = 10_000


# ---------------------------------------------------------------------------------------
# op 30: Mann-Whitney U


def mann_whitney_statistics(values: DataFrame, value: str, group: str) -> DataFrame:
    """U of the ``group == true`` sample against the rest, with n1, n2, the tie term
    sum(t^3 - t) and both sample means. One row."""
    counted = values.select(F.col(value).cast("double").alias("_v"),
                            F.col(group).cast("boolean").alias("_g")).where(
        F.col("_v").isNotNull() & F.col("_g").isNotNull())
    per_value = counted.groupBy("_v").agg(F.count_if(F.col("_g")).alias("_n1"),
                                          F.count_if(~F.col("_g")).alias("_n2"),
                                          F.sum(F.when(F.col("_g"), F.col("_v"))).alias("_s1"),
                                          F.sum(F.when(~F.col("_g"), F.col("_v"))).alias("_s2"))
    per_value = per_value.withColumn("_t", F.col("_n1") + F.col("_n2"))
    ranked = running_totals(per_value, ["_v"], sums=["_t"], label="mwu")
    avg_rank = (F.col("_cum__t") - F.col("_t")).cast("double") + (F.col("_t") + 1) / 2.0
    agg = ranked.agg(F.sum(F.col("_n1") * avg_rank).alias("_r1"),
                     F.sum("_n1").alias("n1"), F.sum("_n2").alias("n2"),
                     F.sum(F.col("_t").cast("double") ** 3 - F.col("_t")).alias("tie_term"),
                     F.try_divide(F.sum("_s1"), F.sum("_n1")).alias("mean_1"),
                     F.try_divide(F.sum("_s2"), F.sum("_n2")).alias("mean_2"))
    n1 = F.col("n1").cast("double")
    return agg.select((F.col("_r1") - n1 * (n1 + 1) / 2.0).alias("statistic"),
                      F.col("n1").cast("long"), F.col("n2").cast("long"), "tie_term",
                      F.coalesce("mean_1", F.lit(0.0)).alias("mean_1"),
                      F.coalesce("mean_2", F.lit(0.0)).alias("mean_2"))


def mann_whitney_pvalue(stats: DataFrame, exact_rows: int = EXACT_U_ROWS, exact_cells: int = 100_000) -> DataFrame:
    """Two-sided p-value: exact where no values are tied, the smaller sample has at most
    ``exact_rows`` and n1 * n2 is at most ``exact_cells`` (0 for none); else the normal
    approximation with tie and continuity correction. Any number of rows, one per test."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u = F.col("statistic")
    big_u = F.greatest(u, n1 * n2 - u)
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    z = F.try_divide(big_u - n1 * n2 / 2.0 - 0.5, sigma)
    exact = (F.least(n1, n2) <= exact_rows) & (n1 * n2 <= exact_cells) & (n1 > 0) & (n2 > 0) & (F.col("tie_term") == 0)
    # a function over Arrow sees all rows whatever the branch: others get nulls
    small = [F.when(exact, x) for x in (u, n1, n2)]
    p = F.when(exact, mann_whitney_exact_udf(*small)).when(
        (n1 == 0) | (n2 == 0) | (sigma == 0) | sigma.isNull(), F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), 2.0 * norm_sf_udf(z)))
    return stats.withColumn("p_value", p)


def premium_aov_test(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Premium vs other customers' average order value (gross), two-sided U test."""
    aov = tx.groupBy(CID).agg(F.avg(gross_revenue()).alias("aov"))
    merged = aov.join(customers.select(CID, "is_premium"), CID)
    s = mann_whitney_pvalue(mann_whitney_statistics(merged, "aov", "is_premium"))
    reject = F.col("p_value") < ALPHA
    text = F.when(reject & (F.col("mean_1") > F.col("mean_2")), F.format_string(
        "Premium AOV %.2f exceeds other customers' %.2f; significant at 5%% (p=%.4e).",
        "mean_1", "mean_2", "p_value")).otherwise(F.format_string(
            "No significant AOV difference at 5%%: premium %.2f vs other %.2f (p=%.4f).",
            "mean_1", "mean_2", "p_value"))
    return s.select(F.lit("Mann-Whitney U").alias("test_name"), "statistic", "p_value",
                    F.col("mean_1").alias("premium_mean_aov"),
                    F.col("mean_2").alias("nonpremium_mean_aov"),
                    reject.alias("reject_null"), text.alias("interpretation"), "n1", "n2")


# ---------------------------------------------------------------------------------------
# op 31: chi-square test of independence


def chi_square_statistics(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square of the a x b contingency table (Yates-corrected when it is 2 x 2), dof,
    n and Cramer's V. One row.

    Needs only the observed cells and the margins: sum over cells of (o - e)^2 / e equals
    sum over observed cells of o^2 / e - n, so absent (zero) cells never have to be built.
    """
    cells = (df.select(F.col(a).cast("string").alias("_a"), F.col(b).cast("string").alias("_b"))
             .where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
             .groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_o")))
    return _chi_square_from_cells(cells, [])


def _chi_square_from_cells(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """cells: (by..., _a, _b, _o) -> (by..., statistic, dof, n, cramers_v)."""
    by = list(by)
    rows = cells.groupBy(*by, "_a").agg(F.sum("_o").alias("_r"))
    cols = cells.groupBy(*by, "_b").agg(F.sum("_o").alias("_c"))
    full = cells.join(rows, by + ["_a"]).join(cols, by + ["_b"])
    agg = full.groupBy(*by).agg(
        F.sum(F.col("_o").cast("double") ** 2 / (F.col("_r") * F.col("_c"))).alias("_s"),
        # |o - e| is the same for all four cells of a 2x2 table: keep any observed cell
        F.max(F.struct("_a", "_b", "_o", "_r", "_c")).alias("_cell"))
    inv_r = rows.groupBy(*by).agg(F.sum(1.0 / F.col("_r")).alias("_ir"),
                                  F.sum("_r").alias("_n"), F.count(F.lit(1)).alias("_R"))
    inv_c = cols.groupBy(*by).agg(F.sum(1.0 / F.col("_c")).alias("_ic"),
                                  F.count(F.lit(1)).alias("_C"))
    stats = _join_all([agg, inv_r, inv_c], by)
    n = F.col("_n").cast("double")
    R, C = F.col("_R"), F.col("_C")
    dof = (R - 1) * (C - 1)
    plain = n * F.col("_s") - n
    e11 = F.col("_cell._r") * F.col("_cell._c") / n
    d = F.abs(F.col("_cell._o") - e11)
    yates = F.greatest(d - 0.5, F.lit(0.0)) ** 2 * n * F.col("_ir") * F.col("_ic")
    chi2 = F.when(dof == 0, F.lit(0.0)).when(dof == 1, yates).otherwise(plain)
    k = F.least(R, C)
    v = F.when((n > 0) & (k > 1), F.sqrt(chi2 / (n * (k - 1)))).otherwise(F.lit(0.0))
    return stats.select(*by, chi2.alias("statistic"), dof.cast("long").alias("dof"),
                        F.col("_n").cast("long").alias("n"), v.alias("cramers_v"))


def _join_all(frames, by):
    """Join one-row-per-group aggregates. Without groups every frame is a single row: they
    are combined by a union and one aggregate instead of a cross join."""
    if by:
        out = frames[0]
        for f in frames[1:]:
            out = out.join(f, by)
        return out
    names = [(i, f.schema[c]) for i, f in enumerate(frames) for c in f.columns]
    union = None
    for i, f in enumerate(frames):
        sel = [(F.col(fld.name) if j == i else F.lit(None).cast(fld.dataType)).alias(fld.name)
               for j, fld in names]
        part = f.select(*sel)
        union = part if union is None else union.unionByName(part)
    return union.agg(*[F.max(fld.name).alias(fld.name) for _, fld in names])


def chi_square_test(df: DataFrame, a: str, b: str) -> DataFrame:
    s = chi_square_statistics(df, a, b)
    p = F.when(F.col("dof") <= 0, F.lit(1.0)).otherwise(chi2_sf_udf("statistic", F.col("dof").cast("double")))
    return s.withColumn("p_value", p)


def channel_churn_test(customers: DataFrame) -> DataFrame:
    s = chi_square_test(customers, "acquisition_channel", "churn_label")
    reject = F.col("p_value") < ALPHA
    text = F.when(reject, F.format_string(
        "Channel and churn are associated; significant at 5%% (p=%.4e, V=%.4f).",
        "p_value", "cramers_v")).otherwise(F.format_string(
            "No significant channel-churn association at 5%% (p=%.4f).", "p_value"))
    return s.select(F.lit("Chi-Square").alias("test_name"), "statistic", "p_value",
                    F.col("dof").alias("degrees_of_freedom"), "cramers_v",
                    reject.alias("reject_null"), text.alias("interpretation"), "n")


# ---------------------------------------------------------------------------------------
# op 32: Kruskal-Wallis


def kruskal_wallis_statistics(df: DataFrame, value: str, group: str) -> DataFrame:
    """Tie-corrected H over groups, with N and the number of groups. One row."""
    x = df.select(F.col(value).cast("double").alias("_v"), F.col(group).alias("_grp")).where(
        F.col("_v").isNotNull() & F.col("_grp").isNotNull())
    ranks = tie_average_ranks(x, "_v", label="kw")
    per = x.join(ranks.select("_v", "avg_rank", "count"), "_v")
    groups = per.groupBy("_grp").agg(F.sum("avg_rank").alias("_rs"), F.count(F.lit(1)).alias("_nj"))
    g = groups.agg(F.sum(F.col("_rs") ** 2 / F.col("_nj")).alias("_q"), F.sum("_nj").alias("N"),
                   F.count(F.lit(1)).alias("k"))
    t = ranks.agg(F.sum(F.col("count").cast("double") ** 3 - F.col("count")).alias("_ties"))
    s = _join_all([g, t], [])
    n = F.col("N").cast("double")
    h = 12.0 / (n * (n + 1)) * F.col("_q") - 3.0 * (n + 1)
    corr = 1.0 - F.col("_ties") / (n ** 3 - n)
    stat = F.when(F.col("k") < 2, F.lit(0.0)).otherwise(h / corr)
    return s.select(stat.alias("statistic"), F.col("N").cast("long").alias("n"),
                    F.col("k").cast("long").alias("groups"))


def revenue_seasonality_test(tx: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """Daily gross revenue compared across calendar months; peak and trough month by the
    median daily revenue (ties -> smallest month)."""
    daily = tx.groupBy(F.to_date(date_col).alias("_day")).agg(F.sum(gross_revenue()).alias("revenue"))
    # ranks, join and medians read the written days (bounded by the calendar), not the fact
    daily = materialize(daily.withColumn("month", F.month("_day")), "daily-revenue")
    kw = kruskal_wallis_statistics(daily, "revenue", "month")
    p = F.when(F.col("groups") < 2, F.lit(1.0)).otherwise(
        chi2_sf_udf("statistic", (F.col("groups") - 1).cast("double")))
    kw = kw.withColumn("p_value", p)
    med = exact_quantiles(daily, "revenue", [0.5], by=["month"], label="kwmed")
    pk = med.agg(F.min(F.struct((-F.col("q_0")).alias("m"), F.col("month").alias("month")))
                 .getField("month").alias("peak_month"),
                 F.min(F.struct(F.col("q_0").alias("m"), F.col("month").alias("month")))
                 .getField("month").alias("trough_month"))
    s = _join_all([kw, pk], [])
    reject = F.col("p_value") < ALPHA
    text = F.when(reject, F.format_string(
        "Daily revenue differs by month; significant at 5%% (p=%.4e). Highest median in "
        "month %d, lowest in month %d.", "p_value", "peak_month", "trough_month")).otherwise(
            F.format_string("No significant month-to-month difference in daily revenue at 5%% "
                            "(p=%.4f).", "p_value"))
    return s.select(F.lit("Kruskal-Wallis").alias("test_name"), "statistic", "p_value",
                    reject.alias("reject_null"), F.col("peak_month").cast("long"),
                    F.col("trough_month").cast("long"), text.alias("interpretation"),
                    "n", "groups")


# ---------------------------------------------------------------------------------------
# op 33: feature drift


def drift_counts(df: DataFrame, side: str, numeric: Sequence[str],
                 categorical: Sequence[str]) -> DataFrame:
    """One pass: (feature, kind, num, cat, c0, c1) = per-value counts on the reference
    (side 0) and current (side 1) rows, nulls / NaN dropped. Written once (it is small:
    distinct values per feature), then read by both tests."""
    items = [F.struct(F.lit(c).alias("feature"), F.lit("numeric").alias("kind"),
                      F.col(c).cast("double").alias("num"), F.lit(None).cast("string").alias("cat"))
             for c in numeric]
    items += [F.struct(F.lit(c).alias("feature"), F.lit("categorical").alias("kind"),
                       F.lit(None).cast("double").alias("num"), F.col(c).cast("string").alias("cat"))
              for c in categorical]
    long = df.select(F.col(side).cast("int").alias("_s"), F.explode(F.array(*items)).alias("x")).select(
        "_s", "x.*")
    valid = F.when(F.col("kind") == "numeric", F.col("num").isNotNull() & ~F.isnan("num")).otherwise(
        F.col("cat").isNotNull())
    counts = long.where(valid).groupBy("feature", "kind", "num", "cat").agg(
        F.count_if(F.col("_s") == 0).alias("c0"), F.count_if(F.col("_s") == 1).alias("c1"))
    return materialize(counts, "drift-counts")


def drift_statistics_split(df: DataFrame, side: str, numeric: Sequence[str],
                           categorical: Sequence[str]) -> DataFrame:
    """Per feature: two-sample KS statistic (numeric) or chi-square over category counts
    (categorical, Yates for two categories), with sample sizes and dof. ``side`` is 0 for
    reference rows and 1 for current rows of the one input frame."""
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    counts = drift_counts(df, side, numeric, categorical)
    parts = []
    if numeric:
        num = counts.where(F.col("kind") == "numeric").select("feature", F.col("num").alias("value"),
                                                              "c0", "c1")
        rt = running_totals(num, ["value"], by=["feature"], sums=["c0", "c1"], label="ks")
        gap = F.abs(F.try_divide("_cum_c0", "_tot_c0") - F.try_divide("_cum_c1", "_tot_c1"))
        ks = rt.groupBy("feature").agg(F.max(gap).alias("_d"), F.max("_tot_c0").alias("n_ref"),
                                       F.max("_tot_c1").alias("n_cur"))
        ok = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
        parts.append(ks.select("feature", F.lit("numeric").alias("feature_type"),
                               F.lit("Kolmogorov-Smirnov").alias("test_name"),
                               F.when(ok, F.col("_d")).otherwise(F.lit(0.0)).alias("statistic"),
                               F.col("n_ref").cast("long"), F.col("n_cur").cast("long"),
                               F.lit(None).cast("long").alias("dof")))
    if categorical:
        cat = counts.where(F.col("kind") == "categorical")
        cells = cat.select("feature", F.explode(F.array(
            F.struct(F.lit("0").alias("_a"), F.col("cat").alias("_b"), F.col("c0").alias("_o")),
            F.struct(F.lit("1").alias("_a"), F.col("cat").alias("_b"), F.col("c1").alias("_o"))))
            .alias("x")).select("feature", "x.*").where(F.col("_o") > 0)
        chi = _chi_square_from_cells(cells, ["feature"])
        sides = cat.groupBy("feature").agg(F.sum("c0").alias("n_ref"), F.sum("c1").alias("n_cur"),
                                           F.count(F.lit(1)).alias("_k"))
        j = sides.join(chi, "feature")
        valid = (F.col("_k") > 1) & (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
        parts.append(j.select("feature", F.lit("categorical").alias("feature_type"),
                              F.lit("Chi-Square").alias("test_name"),
                              F.when(valid, F.col("statistic")).otherwise(F.lit(0.0)).alias("statistic"),
                              F.col("n_ref").cast("long"), F.col("n_cur").cast("long"),
                              F.when(valid, F.col("dof")).otherwise(F.lit(0)).cast("long").alias("dof")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_statistics(ref: DataFrame, cur: DataFrame, numeric: Sequence[str],
                     categorical: Sequence[str]) -> DataFrame:
    """Same as :func:`drift_statistics_split` for two separate frames."""
    numeric = [c for c in numeric if c in ref.columns and c in cur.columns]
    categorical = [c for c in categorical if c in ref.columns and c in cur.columns]
    cols = list(numeric) + list(categorical)
    both = (ref.select(*cols, F.lit(0).alias("_side"))
            .unionByName(cur.select(*cols, F.lit(1).alias("_side"))))
    return drift_statistics_split(both, "_side", numeric, categorical)


def _with_pvalues(s: DataFrame, exact_rows: int = 0) -> DataFrame:
    n, m = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    lam = F.sqrt(F.try_divide(n * m, n + m)) * F.col("statistic")
    exact = (F.greatest(n, m) <= exact_rows) & (n > 0) & (m > 0) & (F.col("feature_type") == "numeric")
    p_ks = F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0), F.lit(1.0))
    if exact_rows:
        p_ks = p_ks.when(exact, kolmogorov_exact_udf(*[F.when(exact, x) for x in (F.col("statistic"), n, m)]))
    p_ks = p_ks.otherwise(kolmogorov_sf_udf(lam))
    p_chi = F.when(F.col("dof") <= 0, F.lit(1.0)).otherwise(
        chi2_sf_udf("statistic", F.col("dof").cast("double")))
    p = F.when(F.col("feature_type") == "numeric", p_ks).otherwise(p_chi)
    return (s.withColumn("p_value", p)
            .select("feature", "feature_type", "test_name", "statistic", "p_value",
                    (F.col("p_value") < ALPHA).alias("drift_detected"))
            .orderBy("p_value", "feature"))


def feature_drift_split(df: DataFrame, side: str, numeric: Sequence[str],
                        categorical: Sequence[str], exact_rows: int = 0) -> DataFrame:
    """Drift table from one frame with a 0/1 ``side`` column (e.g. a period flag)."""
    return _with_pvalues(drift_statistics_split(df, side, numeric, categorical), exact_rows)


def feature_drift(ref: DataFrame, cur: DataFrame, numeric: Sequence[str],
                  categorical: Sequence[str], exact_rows: int = 0) -> DataFrame:
    """Drift table: feature, feature_type, test_name, statistic, p_value, drift_detected,
    sorted by p_value. ``exact_rows`` (usually EXACT_KS_ROWS; 0: never): KS p-values are exact
    while neither side has more values."""
    return _with_pvalues(drift_statistics(ref, cur, numeric, categorical), exact_rows)
