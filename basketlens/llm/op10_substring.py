"""Substring dedup by line and sentence hashing.

Texts are split into units at line ends and, inside a line, after a sentence's end. Units
are normalised (ASCII lower case, white space collapsed) and hashed to 128 bits; digests are
grouped over all documents, and the earliest ranked document keeps a unit. Every later copy
of a line goes, whatever its length. Inside lines that are not copies, sentences go where
consecutive copied ones add up to ``min_words`` words, so short everyday sentences stay
(without ``whole_lines`` that rule alone holds). Removed spans keep their offsets in the
original text.

Three shuffles: one narrow row per distinct unit of a document (counted with map-side
combine), the same rows joined with the digests that repeat, and the documents joined with
their few removed digests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches
from . import textbytes as tb

_END = np.zeros(256, bool)
_END[np.frombuffer(b".!?", np.uint8)] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
NO_RANK = 1 << 62  # rows without a rank come from here on, by a hash of their text
#: keeps digests of lines apart from those of units
_LINE = np.uint64(0x6C696E65)


def digests_of(hashes: list[np.ndarray], at: np.ndarray) -> list[np.ndarray]:
    """The two halves of the digests of consecutive runs of words with offsets ``at``."""
    words = np.diff(at)
    place = np.arange(at[-1]) - np.repeat(at[:-1], words)
    out = []
    for h in hashes:
        value = tb.mix(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        out.append(tb.mix(total[at[1:]] - total[at[:-1]] + words.astype(np.uint64)))
    return out


def again(rows: np.ndarray, digests: list[np.ndarray]) -> np.ndarray:
    """Entries that repeat an earlier entry of their row."""
    order = np.lexsort((np.arange(len(rows)), digests[1], digests[0], rows))
    out = np.zeros(len(order), bool)
    same = np.ones(max(len(order) - 1, 0), bool)
    for key in (rows, *digests):
        same &= key[order][1:] == key[order][:-1]
    out[order[1:][same]] = True
    return out


class Units:
    """The units of a block of rows: byte starts and ends (white space after a unit belongs
    to it), rows, number of words and digests. Units without words have count 0.

    Lines with words, but fewer than ``line_words``, have rows and digests too; ``line`` is
    the place of a unit's line among them, -1 if it is not there. A copied line of more
    words needs none: all its units are copied, in one run."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, line_words: int = 0):
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        if n:
            cut[1:] |= data == 0x0A
        lines = np.flatnonzero(cut)[:-1]
        if n:
            cut[2:] |= _BLANK[data[1:]] & _END[data[:-1]]
        places = np.flatnonzero(cut)
        self.starts, self.ends = places[:-1], places[1:]
        self.rows = np.searchsorted(bounds, self.starts, side="right") - 1
        low = tb.LOWER[data]
        w_starts, w_ends, _ = tb.word_spans(low, bounds, tb.NON_SPACE)
        unit = np.searchsorted(self.starts, w_starts, side="right") - 1
        at = tb.row_starts(unit, len(self.starts))
        self.words = np.diff(at)
        hashes = [tb.word_hashes(low, w_starts, w_ends, seed) for seed in (1, 2)]
        self.digests = [d.view(np.int64) for d in digests_of(hashes, at)]
        w_line = np.searchsorted(lines, w_starts, side="right") - 1
        count = np.bincount(w_line, minlength=len(lines))
        short = (count > 0) & (count < line_words)
        self.line_rows = np.searchsorted(bounds, lines[short], side="right") - 1
        self.line = np.where(short, np.cumsum(short) - 1, -1)[np.searchsorted(lines, self.starts, side="right") - 1]
        used = short[w_line]
        self.line_digests = [tb.mix(d ^ _LINE).view(np.int64) for d in digests_of(
            [h[used] for h in hashes], np.concatenate([[0], np.cumsum(count[short])]))]

    def again_in_row(self) -> np.ndarray:
        """Units that repeat an earlier unit of their row."""
        return again(self.rows, self.digests) & (self.words > 0)


def unit_digests(batches, line_words: int = 0):
    """(rank, d1, d2) for every distinct unit with words and every distinct line with words,
    but fewer than ``line_words``, of every row."""
    for batch in batches:
        ranks = batch.column(0)
        for i, j, data, bounds in tb.text_blocks(batch.column(1)):
            units = Units(data, bounds, line_words)
            for rows, digests, use in (
                    (units.rows, units.digests, (units.words > 0) & ~units.again_in_row()),
                    (units.line_rows, units.line_digests, ~again(units.line_rows, units.line_digests))):
                use = np.flatnonzero(use)
                yield pa.RecordBatch.from_arrays(
                    [ranks.slice(i, j - i).take(pa.array(rows[use])), *(pa.array(d[use]) for d in digests)],
                    ["_rank", "d1", "d2"])


def copied_runs(units: Units, copied: np.ndarray, min_words: int) -> np.ndarray:
    """Units of runs of consecutive copied units (units without words neither break nor
    join a run) with at least ``min_words`` words together."""
    solid = np.flatnonzero(units.words > 0)
    out = np.zeros(len(copied), bool)
    if not len(solid):
        return out
    flag, rows = copied[solid], units.rows[solid]
    new = np.ones(len(solid), bool)
    new[1:] = (flag[1:] != flag[:-1]) | (rows[1:] != rows[:-1])
    firsts = np.flatnonzero(new)
    total = np.add.reduceat(units.words[solid], firsts)
    run = np.cumsum(new) - 1
    out[solid] = flag & (total[run] >= min_words)
    return out


def cut_texts(column: pa.Array, copies: pa.Array, min_words: int, whole_lines: bool = False):
    """New texts and, per row, flat code-point offsets of the removed spans and the counts
    of units, removed units and removed words, block by block. Only one row's copies are
    Python objects at a time: a whole batch of them would stay with the worker."""
    for i, j, data, bounds in tb.text_blocks(column):
        n = j - i
        units = Units(data, bounds, min_words if whole_lines else 0)
        copied, lines = units.again_in_row(), again(units.line_rows, units.line_digests)
        both = [(copied, tb.row_starts(units.rows, n), units.digests), (lines, tb.row_starts(units.line_rows, n), units.line_digests)]
        ours = copies.slice(i, n)
        listed = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ours), 0).to_numpy(zero_copy_only=False))])
        copy_digests = [pc.struct_field(ours.flatten(), d).to_numpy(zero_copy_only=False) for d in ("d1", "d2")]
        for r in range(n):
            if listed[r] < listed[r + 1]:
                pairs = set(zip(*(d[listed[r]:listed[r + 1]].tolist() for d in copy_digests)))
                for found, at, digests in both:
                    ours = slice(at[r], at[r + 1])
                    found[ours] |= np.array([p in pairs for p in zip(*(d[ours].tolist() for d in digests))], bool)
        gone = copied_runs(units, copied, min_words)
        gone |= (units.words > 0) & (units.line >= 0) & np.append(lines, False)[units.line]
        stays = np.repeat(~gone, units.ends - units.starts)
        sizes = np.concatenate([[0], np.cumsum(stays)])[bounds]
        text = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(data[stays].tobytes())])
        point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        spans: list[list[int]] = [[] for _ in range(n)]
        for u in np.flatnonzero(gone).tolist():
            r = int(units.rows[u])
            a, b = (int(point[x] - point[bounds[r]]) for x in (units.starts[u], units.ends[u]))
            if spans[r] and spans[r][-1] == a:
                spans[r][-1] = b
            else:
                spans[r] += [a, b]
        solid = units.words > 0
        counts = [np.bincount(units.rows[m], weights=w, minlength=n).astype(np.int64) for m, w in (
            (solid, None), (gone, None), (gone, units.words[gone]))]
        yield text, pa.array(spans, pa.list_(pa.int64())), counts


def dedup(docs: DataFrame, min_words: int = 8, id_col: str = "doc_id", text_col: str = "text",
          rank_col: str | None = None, whole_lines: bool = True) -> DataFrame:
    """``docs`` with its text cut and with ``n_units``, ``n_removed``, ``removed_words`` and
    ``removed_spans`` appended (flat code-point offsets [start, end, ...) in the original).

    The lowest ``rank_col`` (default: the id) keeps a unit, inside a document its first
    place. Rows with a null rank come last (after all ranks below 2^62), one by one in the
    order of a hash of their text; of these only rows of equal text count as one document.
    Rows that share a rank count as one document and keep the same units.
    With ``whole_lines``, every later copy of a line goes; ``min_words`` then only bounds runs
    of sentences inside lines that are not copies themselves. Null texts stay null, empty
    ones empty; a document may become empty but no row is lost. Other columns pass unread, whatever their names. An empty table gives none.
    """
    bound_batches(docs.sparkSession)
    said = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), 2)
    rank = F.coalesce(F.col(f"`{rank_col or id_col}`").cast("long"), F.lit(NO_RANK) + said)
    line_words = min_words if whole_lines else 0
    units = docs.select(rank.alias("_rank"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        lambda batches: unit_digests(batches, line_words), "_rank long, d1 long, d2 long")
    repeated = (units.groupBy("d1", "d2").agg(F.min("_rank").alias("_keeper"), F.max("_rank").alias("_last"))
                .where(F.col("_keeper") < F.col("_last")).drop("_last"))
    copies = (units.join(repeated, ["d1", "d2"]).where(F.col("_rank") > F.col("_keeper"))
              .groupBy("_rank").agg(F.collect_set(F.struct("d1", "d2")).alias("_copies")))
    others = [c for c in docs.columns if c != text_col]
    packed = docs.select(rank.alias("_rank"), F.col(f"`{text_col}`").alias("text"),
                         F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)] or [F.lit(0).alias("c0")]).alias("rest"))
    joined = packed.join(copies, "_rank", "left").select("rest", "text", "_copies")
    schema = joined.select("rest", "text", F.lit(0).cast("long").alias("n_units"), F.lit(0).cast("long").alias("n_removed"),
                           F.lit(0).cast("long").alias("removed_words"), F.array().cast("array<long>").alias("removed_spans")).schema

    def cut(batches):
        for batch in batches:
            at = 0
            for text, spans, counts in cut_texts(batch.column(1), batch.column(2), min_words, whole_lines):
                part = batch.slice(at, len(text))
                at += len(text)
                text = pc.if_else(pc.is_null(part.column(1)), pa.scalar(None, pa.large_string()), text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), text.cast(part.column(1).type), *(pa.array(c) for c in counts), spans],
                    ["rest", "text", "n_units", "n_removed", "removed_words", "removed_spans"])

    kept = [F.col("text").alias(c) if c == text_col else F.col("rest").getField(f"c{others.index(c)}").alias(c)
            for c in docs.columns]
    return joined.mapInArrow(cut, schema).select(*kept, "n_units", "n_removed", "removed_words", "removed_spans")


#: DuckDB statement for the query's columns with the default number of words and whole lines;
#: chr(1) marks the ends of units
SQL = r"""
WITH parts AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '([.!?][ \t])', '\1' || chr(1), 'g'),
    '\n', chr(10) || chr(1), 'g'), chr(1)) AS u FROM documents WHERE text IS NOT NULL),
units AS (SELECT doc_id, i, u[i] AS u, array_to_string(regexp_extract_all(
    translate(u[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS norm
  FROM (SELECT doc_id, u, unnest(range(1, len(u) + 1)) AS i FROM parts) x WHERE u[i] <> ''),
solid AS (SELECT doc_id, i, len(string_split(norm, ' ')) AS words, min(doc_id) OVER (PARTITION BY norm) < doc_id
    OR row_number() OVER (PARTITION BY doc_id, norm ORDER BY i) > 1 AS copied FROM units WHERE norm <> ''),
runs AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - row_number() OVER (PARTITION BY doc_id, copied ORDER BY i) AS r FROM solid),
lined AS (SELECT *, coalesce(sum(CASE WHEN suffix(u, chr(10)) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM units),
lines AS (SELECT doc_id, line, string_agg(norm, ' ' ORDER BY i) FILTER (norm <> '') AS norm FROM lined GROUP BY doc_id, line),
later AS (SELECT * FROM (SELECT doc_id, line, min(doc_id) OVER (PARTITION BY norm) < doc_id
    OR row_number() OVER (PARTITION BY doc_id, norm ORDER BY line) > 1 AS copied FROM lines WHERE norm IS NOT NULL) x WHERE copied),
gone AS (SELECT doc_id, i, words FROM (SELECT *, sum(words) OVER (PARTITION BY doc_id, copied, r) AS s FROM runs) x
  JOIN lined USING (doc_id, i) LEFT JOIN later USING (doc_id, line) WHERE (x.copied AND s >= 8) OR later.copied),
placed AS (SELECT units.doc_id, units.i, u, norm, gone.words, gone.i IS NOT NULL AS off,
    coalesce(sum(length(u)) OVER (PARTITION BY units.doc_id ORDER BY units.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a,
    row_number() OVER (PARTITION BY units.doc_id ORDER BY units.i) - row_number() OVER (PARTITION BY units.doc_id, gone.i IS NOT NULL ORDER BY units.i) AS r
  FROM units LEFT JOIN gone ON gone.doc_id = units.doc_id AND gone.i = units.i),
spans AS (SELECT doc_id, string_agg(s, ',' ORDER BY a) AS s FROM (SELECT doc_id, min(a) AS a, CAST(min(a) AS VARCHAR) || ':' || CAST(max(a + length(u)) AS VARCHAR) AS s
  FROM placed WHERE off GROUP BY doc_id, r) x GROUP BY doc_id),
sums AS (SELECT doc_id, count(*) FILTER (norm <> '') AS n_units, count(*) FILTER (off) AS n_removed, coalesce(sum(words), 0) AS removed_words,
    coalesce(string_agg(u, '' ORDER BY i) FILTER (NOT off), '') AS text FROM placed GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words, coalesce(s, '') AS removed_spans, coalesce(sums.text, d.text) AS text
FROM documents d LEFT JOIN sums USING (doc_id) LEFT JOIN spans USING (doc_id)
"""
