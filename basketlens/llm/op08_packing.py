"""Packing by power-of-two decomposition.

A document of n ids is split into pieces whose lengths are the powers of two of n's binary
form (pieces of the longest length repeat), longest first. Each piece is a sequence of its
own and sequences of equal length form a bucket, so a sequence never crosses documents and
no sequence needs padding. One narrow pass, no shuffle.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches
from .encoding import encoded_blocks

END_ID = 1
MAX_TOKENS = 2048
SCHEMA = "doc_id long, start long, length long, ids array<int>, doc_tokens long"
DIGEST_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def binary_pieces(n_tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and lengths of all pieces of documents with these token counts (at
    least 1 each); ``longest`` is a power of two."""
    bits = longest.bit_length() - 1
    whole = n_tokens >> bits
    low = (n_tokens[:, None] >> np.arange(bits - 1, -1, -1)) & 1
    number = whole + low.sum(axis=1)
    rows = np.repeat(np.arange(len(n_tokens)), number)
    at = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    lengths = np.full(len(rows), longest, np.int64)
    lengths[at >= whole[rows]] = (low * (1 << np.arange(bits - 1, -1, -1)))[low.astype(bool)]
    ends = np.cumsum(lengths)
    first = np.concatenate([[0], np.cumsum(n_tokens)])[:-1]
    return rows, ends - lengths - first[rows], lengths


def with_end(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with END_ID after each row's, and the new offsets."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, END_ID, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
    return out, offsets + np.arange(n + 1)


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, id_col: str = "doc_id",
           text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, ids (or,
    with ``digest``, their CRC-32 as little-endian 32-bit values), doc_tokens, sequence_id
    (unique; a piece is its sequence), offset (0) and bucket (the sequences' length).

    A document is its ids, then id 1; null and empty texts are that id alone. Rows with
    equal or null ids are documents of their own. Very long texts give more pieces of
    ``max_tokens``, which must be a power of two. An empty table gives no rows.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")

    def cut(batches):
        for batch in batches:
            doc_ids = batch.column(0)
            for i, j, ids, offsets in encoded_blocks(batch.column(1), tokenizer):
                ids, offsets = with_end(ids, offsets)
                counts = np.diff(offsets)
                rows, starts, lengths = binary_pieces(counts, max_tokens)
                ends = np.cumsum(lengths)
                bounds = np.concatenate([[0], ends])
                if digest:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    out = pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(bounds[:-1].tolist(), ends.tolist())], pa.int64())
                else:
                    out = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(i, j - i).take(pa.array(rows)), pa.array(starts), pa.array(lengths), out, pa.array(counts[rows])],
                    ["doc_id", "start", "length", "ids_crc32" if digest else "ids", "doc_tokens"])

    bound_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # the scan's splits are fixed, so a lost task makes the same ids again
    return (narrow.mapInArrow(cut, DIGEST_SCHEMA if digest else SCHEMA)
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long"))
            .withColumn("bucket", F.col("length")))


def write_buckets(packed: DataFrame, path: str, files_per_bucket: int = 64) -> None:
    """Write the sequences in one folder per length. Rows are spread by a salt as well, so
    the most frequent length does not meet in one task."""
    (packed.withColumn("_salt", F.pmod(F.xxhash64("sequence_id"), F.lit(files_per_bucket)))
     .repartition("bucket", "_salt").drop("_salt").write.mode("overwrite").partitionBy("bucket").parquet(path))
