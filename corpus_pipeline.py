"""The corpus pipeline: documents through quality classifier, near-duplicate removal,
substring dedup, benchmark decontamination and packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the
columns of ``documents``. A runner writes each stage as Parquet and rereads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import op03_jaccard, op07_decontaminate, op08_packing, op09_classifier, op10_substring
from basketlens.llm.queries import table, tokenizer_path
from basketlens.session import materialize, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score >= 0.3). It is trained on the
    labelled documents that reached this stage."""
    ship_package(spark)
    net = op09_classifier.train(docs, table(spark, sf_dir, "labels"))
    return op09_classifier.score(docs, net).where("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (5-word shingles, similarity 0.8 or more):
    the one with the smallest id."""
    ship_package(spark)
    return op03_jaccard.keep_one(docs, k=5, threshold_pct=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their later copies of lines and of repeated passages; n_chars follows the text, and
    documents of which nothing is left go."""
    ship_package(spark)
    cut = op10_substring.dedup(docs, whole_lines=True)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return (cut.where(left)
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage to the stated share of their words."""
    ship_package(spark)
    return op07_decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of power-of-two lengths, each from one document."""
    ship_package(spark)
    return op08_packing.pieces(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier's scores cannot be stated in SQL; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
