"""Quality rules with suffix-array repetition.

Per document a suffix array over its words gives, through the longest common prefixes of
neighbouring suffixes, the maximal repeated word sequences; the union of their spans is the
repeated part. Base rules (too few words, too many repeated words) come first, then the
limits on the covered share and on the longest repeat. One narrow pass, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import suffixes as sx
from . import textbytes as tb


@dataclass(frozen=True)
class RuleLimits:
    """Limits of the rules; lengths are in words, shares in percent of the words."""
    window: int = 8            # shortest sequence that counts as repeated
    min_words: int = 20        # base rule
    max_repeat_pct: int = 30   # base rule
    max_covered_pct: int = 20  # method: share covered by repeated sequences
    max_longest: int = 100     # method: longest repeated sequence


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, longest_repeat long, covered_share double")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    seen: set[bytes] = set()
    number = 0
    for line in text.split(b"\n"):
        if line in seen:
            number += 1
        elif line.strip(b" \t\n\r\x0b\x0c"):
            seen.add(line)
    return number


def measure(data: np.ndarray, bounds: np.ndarray, limits: RuleLimits) -> dict[str, np.ndarray]:
    """All measures and verdicts for the rows of one block of bytes."""
    n = len(bounds) - 1
    starts, ends, rows = tb.word_spans(data, bounds, tb.NON_SPACE)
    at = tb.row_starts(rows, n)
    n_words = np.diff(at)
    # code points: bytes that do not continue a character
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_chars = _sums(point[ends] - point[starts], at)
    symbol = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    n_symbols = symbol[bounds[1:]] - symbol[bounds[:-1]]
    _, word = np.unique(tb.word_hashes(data, starts, ends), return_inverse=True)
    # the row is part of each symbol, so no match leaves its document
    sa, levels = sx.suffix_array(rows * (len(word) + 1) + word, keep_levels=True)
    length = sx.repeat_lengths(sa, levels, limits.window)
    inside = np.flatnonzero(length)
    repeated = sx.covered(len(word), inside, length[inside])
    n_repeat = _sums(repeated, at)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows[inside], length[inside])
    raw = data.tobytes()
    dup = np.array([repeated_lines(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], np.int64)
    failed = (n_words < limits.min_words) | (100 * n_repeat > limits.max_repeat_pct * n_words)
    kept = ~failed & (100 * n_repeat <= limits.max_covered_pct * n_words) & (longest <= limits.max_longest)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": dup,
            "n_repeat_words": n_repeat, "base_failed": failed, "kept": kept, "longest_repeat": longest,
            "covered_share": n_repeat / np.maximum(n_words, 1)}


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values.astype(np.int64))])
    return total[at[1:]] - total[at[:-1]]


def quality_rules(docs: DataFrame, limits: RuleLimits = RuleLimits(), id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the measures, ``base_failed`` and ``kept``.

    Words are maximal runs of non-white-space; the whole text counts. Null and empty texts
    have no words and fail the base rule. Ids may be null or repeat (each row is judged by
    itself); other columns are not read. An empty table gives no rows.
    """
    def judge(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, bounds in tb.text_blocks(batch.column(1)):
                m = measure(data, bounds, limits)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), *(pa.array(v) for v in m.values())], ["doc_id", *m])
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return narrow.mapInArrow(judge, SCHEMA)


#: DuckDB statement for the contract's columns with the default limits. The longest repeat
#: is the longest run of equal 8-word windows along one distance; only documents that pass
#: the base rules need it.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w) x),
twice AS (SELECT doc_id, i, g FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) x WHERE c > 1),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) x GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) x
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (SELECT w.doc_id, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(h.n, 0) AS n_repeat_words
  FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN hit h USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS apart FROM twice a JOIN twice b ON a.doc_id = b.doc_id AND a.g = b.g AND a.i < b.i
  WHERE a.doc_id IN (SELECT doc_id FROM judged WHERE NOT base_failed)),
runs AS (SELECT doc_id, apart, i - row_number() OVER (PARTITION BY doc_id, apart ORDER BY i) AS r FROM pairs),
longest AS (SELECT doc_id, max(n) + 7 AS n FROM (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id, apart, r) x GROUP BY doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  base_failed, NOT base_failed AND 100 * n_repeat_words <= 20 * n_words AND coalesce(l.n, 0) <= 100 AS kept
FROM judged LEFT JOIN longest l USING (doc_id)
"""
