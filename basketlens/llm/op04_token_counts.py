"""Token counts from an exact length histogram.

Documents are aggregated by their encoded length; suffix sums over the distinct lengths
then answer, for any context limit, how many documents and tokens are longer, the total
after truncation to the limit, and exact quantiles, without looking at documents again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .encoding import encoded_blocks

#: lengths per step of the two-level running sums
SPAN = 1024


def lengths(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: n_tokens of the whole text (null and empty: 0)."""
    def count(batches):
        for batch in batches:
            for _, _, _, offsets in encoded_blocks(batch.column(0), tokenizer):
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(offsets))], ["n_tokens"])
    return docs.select(F.col(text_col).alias("text")).mapInArrow(count, "n_tokens long")


def histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Per distinct length ``n_tokens``, ascending in meaning: n_docs; docs_longer and
    tokens_longer (documents with more tokens and their tokens); docs_to and tokens_to
    (documents with at most as many); truncated_tokens (all documents cut to this limit);
    total_docs and total_tokens.

    Null and empty texts have length 0 and count. Repeated rows count each. Other columns
    are not read. An empty table gives no rows.
    """
    counted = lengths(docs, tokenizer, text_col).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    # written: both uses below read the histogram, and texts are encoded once
    counted = materialize(counted.withColumn("_span", F.floor(F.col("n_tokens") / SPAN)), "lengths")
    tokens = F.col("n_tokens") * F.col("n_docs")
    # running sums inside spans of lengths, plus the (few) spans' own totals before them
    spans = counted.groupBy("_span").agg(F.sum("n_docs").alias("_docs"), F.sum(tokens).alias("_tokens"))
    up = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    spans = spans.select(
        "_span", F.coalesce(F.sum("_docs").over(up), F.lit(0)).alias("_docs0"),
        F.coalesce(F.sum("_tokens").over(up), F.lit(0)).alias("_tokens0"),
        F.sum("_docs").over(whole).alias("total_docs"), F.sum("_tokens").over(whole).alias("total_tokens"))
    inside = Window.partitionBy("_span").orderBy("n_tokens")
    return (counted.join(spans, "_span")
            .withColumn("docs_to", F.col("_docs0") + F.sum("n_docs").over(inside))
            .withColumn("tokens_to", F.col("_tokens0") + F.sum(tokens).over(inside))
            .withColumn("docs_longer", F.col("total_docs") - F.col("docs_to"))
            .withColumn("tokens_longer", F.col("total_tokens") - F.col("tokens_to"))
            .withColumn("truncated_tokens", F.col("tokens_to") + F.col("docs_longer") * F.col("n_tokens"))
            .select("n_tokens", "n_docs", "docs_to", "tokens_to", "docs_longer", "tokens_longer",
                    "truncated_tokens", "total_docs", "total_tokens"))


def totals_at(counts: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit, answered from a histogram: total_docs, total_tokens,
    docs_longer (than the limit) and truncated_tokens. No rows for an empty histogram."""
    over = F.col("n_tokens") > F.col("context_limit")
    spread = counted_limits(counts, limits)
    return (spread.groupBy("context_limit")
            .agg(F.sum("n_docs").alias("total_docs"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total_tokens"),
                 F.sum(F.when(over, F.col("n_docs")).otherwise(0)).alias("docs_longer"),
                 F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("truncated_tokens")))


def counted_limits(counts: DataFrame, limits: list[int]) -> DataFrame:
    """Each histogram row with each of the (given, few) limits."""
    return counts.select("n_tokens", "n_docs", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context_limit"))


def quantiles(counts: DataFrame, probabilities: list[float]) -> DataFrame:
    """Exact quantiles: the smallest length with at least ceil(p * documents) documents of
    at most that length (p = 0: the shortest length)."""
    asked = counts.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    need = F.greatest(F.lit(1), F.ceil(F.col("probability") * F.col("total_docs")))
    return asked.where(F.col("docs_to") >= need).groupBy("probability").agg(F.min("n_tokens").alias("n_tokens"))
