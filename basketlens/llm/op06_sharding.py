"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A row's place on the ring is the hash of its text, so equal texts lie together; each shard
owns many virtual nodes, and a row belongs to the first virtual node clockwise. A shard is
full at its bound; rows beyond it continue clockwise to the next shard with room. Only
counts per arc (a fixed number of arcs) reach the driver, which turns them into ranges of
the ring order; rows are ranked by one range-partitioned sort of narrow rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import textbytes as tb

LOCAL_BITS = 33  # of monotonically_increasing_id


def ring(n_shards: int, nodes: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all virtual nodes in ring order, and their shards. A shard's nodes do
    not depend on how many shards there are."""
    number = np.arange(n_shards * nodes, dtype=np.uint64)
    places = tb.mix(tb.mix(number) ^ np.uint64(seed)).view(np.int64)
    order = np.argsort(places, kind="stable")
    return places[order], (number[order] // np.uint64(nodes)).astype(np.int64)


def bounds_of(total: int, n_shards: int, load_factor: float) -> np.ndarray:
    """Most rows of each shard: with factor 1 the counts come out at most one apart."""
    if load_factor <= 1:
        return np.full(n_shards, total // n_shards) + (np.arange(n_shards) < total % n_shards)
    return np.full(n_shards, int(np.ceil(load_factor * total / n_shards)))


def assign_ranges(arc_rows: np.ndarray, owners: np.ndarray, limits: np.ndarray) -> list[tuple[int, int, int]]:
    """(first rank, end rank, shard) ranges of the ring order. ``arc_rows`` has the rows of
    each arc in ring order, the last being those after the last node (they belong to the
    first). Each shard first takes its own arcs, in ring order, up to its limit."""
    ends = np.cumsum(arc_rows)
    room = limits.astype(np.int64).copy()
    placed, left = [], []
    for arc, (end, rows) in enumerate(zip(ends.tolist(), arc_rows.tolist())):
        shard = int(owners[arc % len(owners)])
        take = min(rows, int(room[shard]))
        if take:
            placed.append((end - rows, end - rows + take, shard))
            room[shard] -= take
        if take < rows:
            left.append((arc, end - rows + take, end))
    for arc, first, end in left:
        node = arc
        while first < end:
            node += 1
            shard = int(owners[node % len(owners)])
            take = min(end - first, int(room[shard]))
            if take:
                placed.append((first, first + take, shard))
                room[shard] -= take
                first += take
    return sorted(placed)


def shard(docs: DataFrame, n_shards: int = 8, nodes: int = 128, load_factor: float = 1.0, id_col: str = "doc_id",
          text_col: str = "text", seed: int = 0, label: str = "shards") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text plus 1),
    text_crc32, law ("rows"), shard, slot (gapless from 0 in each shard), grown_shard (null:
    under this law places depend on the other rows).

    Bounds count rows: ``load_factor`` 1 makes shards at most one row apart, more leaves
    room (and moves fewer rows when a shard is added). Rows of equal text share a place and
    stay together up to a shard's bound, in the order of their ids (nulls first), repeated
    rows in input order. Null texts count as empty. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_place"),
                         F.monotonically_increasing_id().alias("_row"))
    order = ["_place", "doc_id", "_row"]
    sorted_ = materialize(narrow.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("_at", F.monotonically_increasing_id()).drop("_row"), label)
    places, owners = ring(n_shards, nodes, seed)

    def arcs(batches):
        for batch in batches:
            arc = np.searchsorted(places, batch.column(0).to_numpy(), side="left")
            part = batch.column(1).to_numpy() >> LOCAL_BITS
            # rows are in ring order, so a batch gives one count per arc and part it meets
            pairs, n = np.unique(np.stack([part, arc]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (*pairs, n)], ["part", "arc", "n"])

    counts = (sorted_.select("_place", "_at").mapInArrow(arcs, "part long, arc long, n long")
              .groupBy("part", "arc").agg(F.sum("n").alias("n")).toPandas())
    total = int(counts["n"].sum())
    arc_rows = np.bincount(counts["arc"], weights=counts["n"], minlength=len(places) + 1).astype(np.int64)
    parts = counts.groupby("part")["n"].sum().sort_index()
    part_ids = parts.index.to_numpy(np.int64)
    part_first = np.concatenate([[0], np.cumsum(parts.to_numpy(np.int64))])
    ranges = assign_ranges(arc_rows, owners, bounds_of(total, n_shards, load_factor))
    first = np.array([r[0] for r in ranges], np.int64)
    to = np.array([r[2] for r in ranges], np.int64)
    slot0 = np.zeros(len(ranges), np.int64)
    used = np.zeros(n_shards, np.int64)
    for k, (a, b, s) in enumerate(ranges):
        slot0[k] = used[s]
        used[s] += b - a
    shared = spark.sparkContext.broadcast((part_ids, part_first, first, to, slot0))  # arcs and partitions only

    def place(batches):
        part_ids, part_first, first, to, slot0 = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(3).to_numpy()
            rank = part_first[np.searchsorted(part_ids, at >> LOCAL_BITS)] + (at & ((1 << LOCAL_BITS) - 1))
            k = np.searchsorted(first, rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(to[k].astype(np.int32)), pa.array(slot0[k] + rank - first[k])],
                ["doc_id", "size", "text_crc32", "shard", "slot"])

    placed = sorted_.select("doc_id", "size", "text_crc32", "_at").mapInArrow(
        place, "doc_id long, size long, text_crc32 long, shard int, slot long")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
