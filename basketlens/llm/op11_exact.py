"""Exact dedup by an extendible-hash index on shared files, in DataFrame functions only.

A text's key is a 64-bit hash. The index has a directory and buckets. A bucket owns a range
of keys (all that start with its bits); while a bucket holds more distinct keys than its
capacity, the directory doubles and the bucket splits by one further bit. Copies do not
fill a bucket, so a text that a third of all rows share splits nothing. At the greatest
depth (which bounds the directory, the one thing that is broadcast) buckets grow instead.

1. One pass counts keys. A key found once needs no comparison: its row stays.
2. A second pass writes the entries to the index's shared files: id, bucket, key, digest,
   and the bytes of those texts whose key occurs again.
3. Entries meet by their whole bytes: first within salted groups, so that copies in one task
   combine before they move, then at the task that owns their bucket. Texts of equal keys
   and different bytes become a chain under that key.
4. Every entry takes its class from the chain; classes of many copies are broadcast (their
   number is bounded), the others joined by key.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scalar
from . import skew

CAPACITY = 1 << 13   # distinct keys of a bucket before it splits
MAX_DEPTH = 18       # bits of the directory at most (2^18 entries)
SALTS = 8            # tasks among which one text's copies combine first
NO_ID = -(1 << 63)   # stands for a null id where ids are compared

Normalise = Callable[[Column], Column]


@dataclass
class Index:
    """Written tables. ``directory``: slot (of MAX_DEPTH bits), bucket, depth. ``entries``: one
    per row. ``chains``: one per distinct text whose key is shared."""
    directory: DataFrame
    entries: DataFrame
    chains: DataFrame


def slot(key: Column) -> Column:
    """The leading MAX_DEPTH bits of a key."""
    return F.shiftrightunsigned(key, 64 - MAX_DEPTH).cast("int")


def directory(keys: DataFrame, capacity: int = CAPACITY, label: str = "exact") -> DataFrame:
    """(slot, bucket, depth) of every slot in use; ``keys`` has one row per distinct key.

    Loading starts at the depth that even splitting would need; then each round doubles the
    directory and splits what is overfull, until nothing is or the bits end. A bucket is
    named by its first slot. The table has 2^MAX_DEPTH rows at most."""
    cells = materialize(keys.groupBy(slot(F.col("key")).alias("slot")).agg(F.count(F.lit(1)).alias("n")), label)
    total = scalar(cells.agg(F.sum("n"))) or 0
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, total) / capacity)))) if total > capacity else 0
    cells = cells.withColumn("depth", F.lit(depth))
    unused = F.lit(MAX_DEPTH) - F.col("depth")
    first = F.expr(f"shiftleft(shiftright(slot, {MAX_DEPTH} - depth), {MAX_DEPTH} - depth)")
    while True:
        cells = cells.withColumn("bucket", first)
        over = (cells.where(unused > 0).groupBy("bucket", "depth").agg(F.sum("n").alias("held"))
                .where(F.col("held") > capacity).select("bucket", "depth", F.lit(1).alias("more")))
        split = materialize(cells.join(F.broadcast(over), ["bucket", "depth"], "left")
                            .select("slot", "n", (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                    F.col("more").isNotNull().alias("split")), label)
        cells = split.drop("split")
        if not split.where("split").limit(1).count():
            return split.select("slot", first.alias("bucket"), "depth")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Normalise | None = None,
                capacity: int = CAPACITY, label: str = "exact") -> Index:
    """The index of all rows of ``docs``; see the module's text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    text = normalise(text) if normalise else text
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("bytes")).withColumn("key", F.xxhash64("bytes"))
    keys = materialize(texts.groupBy("key").agg(F.count(F.lit(1)).alias("n")), label)
    found = directory(keys, capacity, label)
    again = skew.bitmap(keys.where("n > 1").select("key"), label)
    entries = (skew.listed(texts, again, F.col("key"), "again").withColumn("slot", slot(F.col("key")))
               .join(F.broadcast(found.drop("depth")), "slot", "left")
               .select("doc_id", F.monotonically_increasing_id().alias("row"), "bucket", "key", F.sha2("bytes", 256).alias("sha256"),
                       F.when(F.col("again"), F.col("bytes")).alias("bytes")))
    entries = materialize(entries, label)
    return Index(found, entries, materialize(chains(entries), label))


def chains(entries: DataFrame) -> DataFrame:
    """(bucket, key, chain, sha256, n, keep_id, keep_row): one row per distinct text of the
    entries that carry bytes; texts of one key are numbered along its chain."""
    text = ["bucket", "key", "sha256", "bytes"]
    held = (entries.where(F.col("bytes").isNotNull()).withColumn("salt", F.spark_partition_id() % SALTS)
            .withColumn("rank", F.coalesce("doc_id", F.lit(NO_ID))))
    some = held.groupBy(*text, "salt").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("rank"), F.max_by("row", "rank").alias("row"))
    owned = some.repartition("bucket").groupBy(*text).agg(F.sum("n").alias("n"), F.max("rank").alias("rank"), F.max_by("row", "rank").alias("row"))
    along = Window.partitionBy("bucket", "key").orderBy("bytes")
    same = F.count(F.lit(1)).over(Window.partitionBy("bucket", "key", "sha256"))
    return (owned.withColumn("chain", F.row_number().over(along)).withColumn("same", same)
            .select("bucket", "key", "chain",
                    F.when(F.col("same") > 1, F.raise_error(F.lit("two texts share a SHA-256 digest"))).otherwise(F.col("sha256")).alias("sha256"),
                    "n", F.when(F.col("rank") != NO_ID, F.col("rank")).alias("keep_id"), F.col("row").alias("keep_row")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Normalise | None = None,
                capacity: int = CAPACITY, label: str = "exact") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (of the row that stays), group_size, kept,
    text_sha256 (of the normalised text in UTF-8).

    Texts are equal when their normalised bytes are (``normalise``: Column -> Column, none by
    default); a null text counts as empty. The row with the largest id of equal texts stays;
    a null id is below all others, and keep_id is null only if all ids of a group are null.
    Of rows equal in text that share the largest id exactly one is kept. Other columns are
    not read; an empty table gives no rows.
    """
    index = build_index(docs, id_col, text_col, normalise, capacity, label)
    copies = index.chains.where("n > 1").select("key", "sha256", F.col("n").alias("group_size"), "keep_id", "keep_row", F.col("n").alias("rows"))
    found = skew.join_unique(index.entries.select("doc_id", "row", "key", "sha256"), copies, ["key", "sha256"], "rows")
    alone = F.col("group_size").isNull()
    return found.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.col("sha256").alias("text_sha256"))


def remove_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Normalise | None = None,
                  label: str = "exact") -> DataFrame:
    """The rows of ``docs``, all columns, without the copies that :func:`exact_dedup` does not
    keep. Of rows that share id and text with the kept one all stay. Texts are not shuffled:
    rows whose (id, digest) is in no bitmap of dropped ones pass at once."""
    found = materialize(exact_dedup(docs, id_col, text_col, normalise, label=label), label)
    pair = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_sha256")
    gone = found.where("not kept and not (doc_id <=> keep_id)").select(pair.alias("__gone")).distinct()
    gone = materialize(gone, label)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    text = normalise(text) if normalise else text
    own = F.concat_ws(":", F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("null")), F.sha2(text, 256))
    names = [F.col(f"`{c}`") for c in docs.columns]
    marked = skew.listed(docs.withColumn("__gone", own), skew.bitmap(gone, label), F.col("__gone"), "__listed")
    checked = marked.where("__listed").join(gone, "__gone", "left_anti")
    return marked.where("not __listed").select(*names).union(checked.select(*names))


#: DuckDB statement for :func:`exact_dedup` over ``documents``
SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST, r) AS k FROM t)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(text) AS text_sha256 FROM g
"""
