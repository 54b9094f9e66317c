"""Exact global ranks, running sums and quantiles without a single-partition window.

Plan: range-partition on (group, order) so that even a group holding a third of all rows
is split across many tasks, sort within partitions, tag each row with its partition id and
position, and write the tagged frame to the checkpoint folder (the tags are then frozen).
Per (partition, group) segment we aggregate counts/sums; a window over the segments (at
most one row per range partition per group) turns them into offsets, and each row's rank
is its offset plus its position inside its segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _sort_orders(order_by: Sequence) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def running_totals(df: DataFrame, order_by: Sequence, by: Sequence[str] = (),
                   sums: Sequence[str] = (), partitions: int | None = None,
                   label: str = "ranks") -> DataFrame:
    """Add ``_rank`` (1-based running row count within ``by`` in ``order_by`` order) and
    ``_n`` (rows in the group); for each column ``c`` in ``sums`` add ``_cum_c`` (inclusive
    running sum) and ``_tot_c`` (group total).

    Ties in ``order_by`` are ranked in an arbitrary but fixed order; callers that need a
    stable tie-break add a unique column to ``order_by``.
    """
    spark = df.sparkSession
    by = list(by)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(b).asc_nulls_first() for b in by] + _sort_orders(order_by)
    tagged = (df.repartitionByRange(n_parts, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    tagged = materialize(tagged, label)

    seg_aggs = [F.count(F.lit(1)).alias("_seg_n"), F.min("_pos").alias("_seg_first")]
    seg_aggs += [F.sum(c).alias(f"_seg_{c}") for c in sums]
    seg = tagged.groupBy("_pid", *by).agg(*seg_aggs)
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    seg_cols = [F.col("_pid"), *[F.col(b) for b in by], F.col("_seg_first"),
                F.coalesce(F.sum("_seg_n").over(before), F.lit(0)).alias("_off_n"),
                F.sum("_seg_n").over(whole).alias("_n")]
    for c in sums:
        seg_cols.append(F.coalesce(F.sum(f"_seg_{c}").over(before), F.lit(0)).alias(f"_off_{c}"))
        seg_cols.append(F.sum(f"_seg_{c}").over(whole).alias(f"_tot_{c}"))
    seg = seg.select(*seg_cols)
    if not by:
        seg = F.broadcast(seg)  # at most one row per range partition

    if sums:
        w = (Window.partitionBy("_pid", *by).orderBy("_pos")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        for c in sums:
            tagged = tagged.withColumn(f"_lcum_{c}", F.sum(c).over(w))
    out = tagged.join(seg, on=["_pid", *by])
    out = out.withColumn("_rank", F.col("_off_n") + (F.col("_pos") - F.col("_seg_first")) + 1)
    for c in sums:
        out = out.withColumn(f"_cum_{c}", F.col(f"_off_{c}") + F.col(f"_lcum_{c}"))
    drop = ["_pid", "_pos", "_seg_first", "_off_n"]
    drop += [f"_off_{c}" for c in sums] + [f"_lcum_{c}" for c in sums]
    return out.drop(*drop)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    label: str = "quantiles", weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (h = (n-1)q), nulls and NaN ignored.

    Values are first counted (partial aggregation collapses repeats, including a value that
    holds a large share of the rows), then only the distinct values are ranked by running
    count. The value at 0-based position p is the one whose count block covers p. Returns
    one row per group with ``q_<i>`` for each prob (in order) and ``n``. With ``weight``
    the input is already counted (each row stands for ``weight`` identical values).
    """
    by = list(by)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    counted = (df.select(*by, F.col(value).cast("double").alias("_v"), w.alias("_w"))
               .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
               .groupBy(*by, "_v").agg(F.sum("_w").alias("_c")))
    ranked = running_totals(counted, ["_v"], by, sums=["_c"], label=label)
    n = F.col("_tot__c")
    hi_pos = F.col("_cum__c")             # positions [hi_pos - _c, hi_pos) hold this value
    lo_pos = hi_pos - F.col("_c")
    conds, aggs = [], []
    for i, q in enumerate(probs):
        h = (n - 1).cast("double") * F.lit(float(q))
        ranked = ranked.withColumn(f"_h{i}", h)
        lo, hi = F.floor(F.col(f"_h{i}")), F.ceil(F.col(f"_h{i}"))
        has_lo = (lo >= lo_pos) & (lo < hi_pos)
        has_hi = (hi >= lo_pos) & (hi < hi_pos)
        conds.append(has_lo | has_hi)
        aggs.append(F.max(F.when(has_lo, F.col("_v"))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when(has_hi, F.col("_v"))).alias(f"_hi{i}"))
        aggs.append(F.max(F.col(f"_h{i}") - lo).alias(f"_f{i}"))
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    picked = ranked.where(cond).groupBy(*by).agg(F.max(n).alias("n"), *aggs)
    out = [F.col(b) for b in by]
    for i, _ in enumerate(probs):
        lo, hi, f = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_f{i}")
        out.append((lo + (hi - lo) * f).alias(f"q_{i}"))
    out.append(F.col("n"))
    return picked.select(*out)


def tie_average_ranks(df: DataFrame, value: str, by: Sequence[str] = (), count_col: str | None = None,
                      label: str = "avgrank") -> DataFrame:
    """Average rank of each distinct value (ties share the mean of their positions).

    Input may be raw rows or pre-counted rows (``count_col``). Output: ``by``, ``value``,
    ``count``, ``avg_rank`` with one row per distinct value per group.
    """
    by = list(by)
    cnt = F.sum(F.col(count_col)) if count_col else F.count(F.lit(1))
    distinct = df.groupBy(*by, value).agg(cnt.cast("long").alias("count"))
    ranked = running_totals(distinct, [value], by, sums=["count"], label=label)
    avg_rank = (F.col("_cum_count") - F.col("count")).cast("double") + (F.col("count") + 1) / 2.0
    return ranked.select(*by, value, "count", avg_rank.alias("avg_rank"),
                         F.col("_tot_count").alias("group_n"))
