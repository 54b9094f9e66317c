"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def stars(links: DataFrame) -> bool:
    """Whether each node of links (a > b, without repeats) has either one link down or only
    links from above; then each component is one star around its smallest node."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    inner = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 and down > 0")
    return inner.agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b, long); the component is
    the smallest node that its links reach.

    Alternating large-star and small-star steps: each links nodes straight to the smallest
    neighbour, so long chains shrink geometrically. Neighbour minima are aggregated with
    map-side combine, a hub's links are never gathered, and each step is written to the
    checkpoint folder. Ends when every link leads straight to a component's smallest node.
    """
    links = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    while not stars(links):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours above a node go to the smallest of its neighbourhood
        large = (links.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        large = materialize(large, label)
        # small star: neighbours below a node and the node itself go to the smallest of them
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lower.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        links = materialize(small, label)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
