"""Benchmark decontamination with suffix arrays of the training shards.

Every block of documents (a shard) gets a suffix array over its words; all suffixes of the
benchmark items are binary-searched in it at once. That yields each test suffix's longest
verbatim match and the place of every occurrence of a test window (13 consecutive words; a
shorter item is one window). Documents whose words are hit to the stated share go.

The benchmark is broadcast in blocks of at most ``block_words`` words (a documented bound;
a longer item is a block of its own); each block is one narrow pass over the documents, so
documents are never shuffled and no document is compared with another.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches, materialize
from . import suffixes as sx
from . import textbytes as tb

#: what a pass adds to each row: flat offsets of the hit words, items with occurring windows,
#: the number of words, and the longest match of a test suffix with its item and word offset
FOUND = [("hit_spans", "array<long>"), ("item_ids", "array<long>"), ("n_words", "long"), ("longest_match", "long"),
         ("longest_item", "long"), ("longest_word", "long")]


@dataclass(frozen=True)
class Tests:
    """Words of some benchmark items: hashes, item offsets and ids; and every suffix."""
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    widths: np.ndarray
    items: np.ndarray


def encode_tests(ids: list, texts: list, window: int) -> Tests:
    """All suffixes of the items; ``widths`` is the window's length, 0 if none starts there."""
    data, bounds = tb.text_bytes(pa.array(texts, pa.string()))
    data = tb.LOWER[data[bounds[0]:bounds[-1]]]
    bounds = bounds - bounds[0]
    starts, ends, rows = tb.word_spans(data, bounds, tb.ALNUM)
    hashes = tb.word_hashes(data, starts, ends)
    at = tb.row_starts(rows, len(ids))
    count = np.diff(at)
    place = np.arange(len(hashes))
    left = at[1:][rows] - place
    widths = np.where(left >= window, window, np.where((count[rows] < window) & (place == at[:-1][rows]), left, 0))
    return Tests(hashes, place, at[1:][rows], widths, np.asarray(ids, np.int64)[rows])


def test_blocks(benchmark: DataFrame, window: int, block_words: int, id_col: str, text_col: str):
    """Encoded blocks of the benchmark, streamed to the driver item by item."""
    ids, texts, held = [], [], 0
    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).where(
        F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    for item, text in rows.toLocalIterator():
        words = len(text) // 2 + 1  # no text has more words
        if ids and held + words > block_words:
            yield encode_tests(ids, texts, window)
            ids, texts, held = [], [], 0
        ids.append(item)
        texts.append(text)
        held += words
    yield encode_tests(ids, texts, window)


def match_block(data: np.ndarray, bounds: np.ndarray, tests: Tests):
    """Search one shard. Returns words per row, hit positions with their widths, (row, item)
    pairs, and per row the longest match."""
    n = len(bounds) - 1
    data = tb.LOWER[data]
    starts, ends, rows = tb.word_spans(data, bounds, tb.ALNUM)
    at = tb.row_starts(rows, n)
    vocabulary, word = np.unique(tb.word_hashes(data, starts, ends), return_inverse=True)
    # after each row stands a symbol of its own, which ends all matches
    symbols = np.empty(len(word) + n, np.int64)
    place = np.arange(len(word)) + rows
    symbols[place] = word
    symbols[at[1:] + np.arange(n)] = len(vocabulary) + np.arange(n)
    row_of = np.empty(len(symbols), np.int64)
    row_of[place] = rows
    row_of[at[1:] + np.arange(n)] = np.arange(n)
    if len(vocabulary):
        known = np.searchsorted(vocabulary, tests.hashes)
        known = np.minimum(known, len(vocabulary) - 1)
        coded = np.where(vocabulary[known] == tests.hashes, known, -1)
    else:
        coded = np.full(len(tests.hashes), -1)
    index = sx.SuffixIndex(symbols)
    got = index.search(coded, tests.starts, tests.ends, tests.widths)
    use = np.flatnonzero(got["hi"] > got["lo"])
    # tests with equal windows have one range; ranges of one width are disjoint, so hits grow with the shard
    ranges, of = np.unique(np.stack([got["lo"][use], got["hi"][use], tests.widths[use]]), axis=1, return_inverse=True)
    number = ranges[1] - ranges[0]
    flat = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number) + np.repeat(ranges[0], number)
    spot = index.sa[flat]
    row = row_of[spot]
    which = np.repeat(np.arange(len(number)), number)
    # items by range, then by (row, range) without repeats
    held = np.unique(np.stack([of.reshape(-1), tests.items[use]]), axis=1)
    met = np.unique(np.stack([row, which]), axis=1)
    first = tb.row_starts(held[0], len(number) + 1)
    items = first[met[1] + 1] - first[met[1]]
    taken = np.arange(int(items.sum())) - np.repeat(np.cumsum(items) - items, items) + np.repeat(first[met[1]], items)
    return {"n_words": np.diff(at), "at": at, "row": row, "word": spot - row - at[:-1][row], "width": ranges[2][which],
            "item_row": np.repeat(met[0], items), "item": held[1][taken], **_longest(index, got, row_of, at)}


def _longest(index: sx.SuffixIndex, got: dict, row_of: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Each matching row's longest match: of its first test suffix, at its leftmost place."""
    sa = index.sa
    match, order = np.empty_like(got["match"]), np.empty_like(sa)
    match[sa], order[sa] = got["match"], np.arange(len(sa))
    best = np.maximum.reduceat(match, at[:-1] + np.arange(len(at) - 1)) if len(sa) else match
    spot = np.flatnonzero((match > 0) & (match == best[row_of]))
    which = index.first_test(got["ranges"], order[spot], match[spot])
    sort = np.lexsort((spot, which, row_of[spot]))
    spot, which = spot[sort], which[sort]
    row, first = np.unique(row_of[spot], return_index=True)
    spot = spot[first]
    return {"longest": match[spot], "longest_test": which[first], "longest_row": row, "longest_word": spot - row - at[row]}


def _merge(old: np.ndarray, starts: np.ndarray, widths: np.ndarray, n: int) -> np.ndarray:
    """Union of spans, as flat [start, end, start, end, ...]; ``old`` has that form."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + widths, -1)
    np.add.at(change, old[0::2], 1)
    np.add.at(change, old[1::2], -1)
    inside = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    return np.flatnonzero(inside[1:] != inside[:-1])


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 4_000_000,
            text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
            keep_text: bool = False, label: str = "decontam") -> DataFrame:
    """Per row of ``docs``: ``rest`` (a struct of its other columns, in order, named c0,
    c1, ...), ``hit_spans`` (flat word offsets [start, end, ...) of the hit words),
    ``item_ids`` (sorted items with occurring windows), ``n_words``, the row's longest
    verbatim match (of equal ones the first in the benchmark, at its leftmost place), and
    with ``keep_text`` the text."""
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)] or [F.lit(0).alias("c0")])
    zero = {"array<long>": F.array(), "long": F.lit(None)}
    state = docs.select(rest.alias("rest"), F.col(f"`{text_col}`").alias("text"),
                        *[zero[kind].cast(kind).alias(name) for name, kind in FOUND])
    bound_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    blocks = test_blocks(benchmark, window, block_words, item_col, item_text_col)
    tests = next(blocks)
    while tests is not None:
        following = next(blocks, None)
        names = [c for c in state.columns if c != "text" or keep_text or following is not None]
        state = state.mapInArrow(_searcher(sc.broadcast(tests), names), state.select(*names).schema)
        if following is not None:
            state = materialize(state, label)
        tests = following
    return state


def _searcher(shared, names: list[str]):
    def search(batches):
        for batch in batches:
            text = batch.schema.get_field_index("text")
            for i, j, data, bounds in tb.text_blocks(batch.column(text), 2 * tb.BLOCK_BYTES):
                part = batch.slice(i, j - i)
                found = _rows(part, data, bounds, shared.value)
                columns = [found.get(c, part.column(k)) for k, c in enumerate(part.schema.names) if c in names]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return search


def _rows(part: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray, tests: Tests) -> dict[str, pa.Array]:
    n = part.num_rows
    got = match_block(data, bounds, tests)
    before = {c: part.column(part.schema.get_field_index(c)).to_pylist() for c, _ in FOUND}
    spans, items = before["hit_spans"], before["item_ids"]
    best = [[a or 0, b, c] for a, b, c in zip(*(before[c] for c in ("longest_match", "longest_item", "longest_word")))]
    order = np.argsort(got["row"], kind="stable")
    row, word, width = (got[k][order] for k in ("row", "word", "width"))
    item_order = np.argsort(got["item_row"], kind="stable")
    item_at, item = tb.row_starts(got["item_row"][item_order], n), got["item"][item_order]
    at = tb.row_starts(row, n)
    for r in np.unique(row):
        cut = slice(at[r], at[r + 1])
        spans[r] = _merge(np.asarray(spans[r], np.int64), word[cut], width[cut], int(got["n_words"][r])).tolist()
        items[r] = np.union1d(np.asarray(items[r], np.int64), item[item_at[r]:item_at[r + 1]]).tolist()
    for r, length, item, at_word in zip(*(x.tolist() for x in (
            got["longest_row"], got["longest"], tests.items[got["longest_test"]], got["longest_word"]))):
        if length > best[r][0]:
            best[r] = [length, item, at_word]
    longs = pa.list_(pa.int64())
    return {"hit_spans": pa.array(spans, longs), "item_ids": pa.array(items, longs), "n_words": pa.array(got["n_words"]),
            **{c: pa.array([b[k] for b in best], pa.int64())
               for k, c in enumerate(("longest_match", "longest_item", "longest_word"))}}


def report(found: DataFrame, min_share_pct: int = 5) -> DataFrame:
    """Counts per row of :func:`matches`. Contaminated: some word is hit and at least
    ``min_share_pct`` percent of the words are."""
    hit = F.aggregate(F.sequence(F.lit(0), F.size("hit_spans") - 1), F.lit(0).cast("long"),
                      lambda total, k: total + F.when(k % 2 == 1, F.element_at("hit_spans", k + 1))
                      .otherwise(-F.element_at("hit_spans", k + 1)))
    n_hit = F.when(F.size("hit_spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    ids = F.array_join(F.array_sort(F.col("item_ids").cast("array<string>")), ",")
    return (found.withColumn("n_hit", n_hit)
            .withColumn("n_items", F.size("item_ids").cast("long"))
            .withColumn("items_sha256", F.sha2(ids, 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_share_pct * F.col("n_words"))))


def decontamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, min_share_pct: int = 5,
                    id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, item_ids, hit_spans and the longest match (words, item, word offset).

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters. Null or
    empty texts have no words and are never contaminated; items without words or id match
    nothing; rows with equal ids are judged one by one; equal items count under each id.
    Other columns are not read. An empty benchmark hits nothing.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return report(matches(narrow, benchmark, window, **options), min_share_pct).select(
        F.col("rest.c0").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
        "item_ids", "hit_spans", "longest_match", "longest_item", "longest_word")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, min_share_pct: int = 5,
                        text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns kept, that are not contaminated (one pass: the
    verdict travels with the row, nothing is joined)."""
    found = report(matches(docs, benchmark, window, text_col=text_col, keep_text=True, **options), min_share_pct)
    others = [c for c in docs.columns if c != text_col]
    return found.where(~F.col("contaminated")).select(
        *[F.col("text").alias(c) if c == text_col else F.col("rest").getField(f"c{others.index(c)}").alias(c)
          for c in docs.columns])


_LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWERED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: DuckDB statement for the contract's columns
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0) x),
found AS (SELECT x.doc_id, x.i, x.n, v.item_id
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) s WHERE len(w) >= n) x
  JOIN windows v ON v.n = x.n AND v.g = array_to_string(x.w[x.i:x.i + x.n - 1], ' ')),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
