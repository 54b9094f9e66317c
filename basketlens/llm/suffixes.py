"""Suffix arrays over word symbols, in numpy, by prefix doubling."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray, keep_levels: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes of ``symbols`` and, if asked for, the rank arrays by level.

    Level i ranks the suffixes by their first 2**i symbols; equal ranks mean equal
    prefixes. Each doubling sorts only the suffixes that are still tied, so texts without
    long repeats stop early and long repeats cost log2(length) rounds of their own part.
    """
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64), []
    sa = np.argsort(symbols, kind="stable")
    ordered = symbols[sa]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[sa] = first
    levels = [rank.copy()] if keep_levels else []
    alone = new & np.append(new[1:], True)
    active = sa[~alone]
    step = 1
    while len(active):
        after = active + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        key = rank[active].astype(np.int64) * (n + 1) + second
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        at = np.arange(len(active))
        group = np.ones(len(active), bool)
        group[1:] = old[1:] != old[:-1]
        part = np.ones(len(active), bool)
        part[1:] = key[1:] != key[:-1]
        group_at = np.maximum.accumulate(np.where(group, at, 0))
        part_at = np.maximum.accumulate(np.where(part, at, 0))
        sa[old + (at - group_at)] = active
        rank[active] = old + (part_at - group_at)
        if keep_levels:
            levels.append(rank.copy())
        alone = part & np.append(part[1:], True)
        active = active[~alone]
        step *= 2
    return sa, levels


def common_prefix(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``i`` and at ``j``."""
    n = len(levels[0]) if levels else 0
    length = np.zeros(len(i), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = i + length, j + length
        ok = (a < n) & (b < n)
        same = np.zeros(len(i), bool)
        same[ok] = levels[level][a[ok]] == levels[level][b[ok]]
        length += same.astype(np.int64) << level
    return length


def repeat_lengths(sa: np.ndarray, levels: list[np.ndarray], at_least: int) -> np.ndarray:
    """For each position the longest match of its suffix with any other suffix, 0 where
    it is shorter than ``at_least``. The longest one is with a neighbour in the order."""
    n = len(sa)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    level = max(at_least, 1).bit_length() - 1
    if level >= len(levels):  # no two suffixes share so long a prefix
        return longest
    near = np.flatnonzero(levels[level][sa[1:]] == levels[level][sa[:-1]])
    i, j = sa[near], sa[near + 1]
    length = common_prefix(levels, i, j)
    length[length < at_least] = 0
    np.maximum.at(longest, i, length)
    np.maximum.at(longest, j, length)
    return longest


def covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of n positions lie in the union of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + lengths, n), -1)
    return np.cumsum(change[:-1]) > 0


class SuffixIndex:
    """A suffix array of one shard, searched with many test suffixes at once."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.sa, _ = suffix_array(symbols)

    def _bound(self, lo: np.ndarray, hi: np.ndarray, depth: int, symbol: np.ndarray) -> np.ndarray:
        """First place in [lo, hi) whose suffix has a symbol >= ``symbol`` at ``depth``."""
        lo, hi = lo.copy(), hi.copy()
        n = len(self.symbols)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            at = self.sa[mid] + depth
            here = np.where(at < n, self.symbols[np.minimum(at, n - 1)], -1)
            less = here < symbol[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def search(self, tests: np.ndarray, starts: np.ndarray, ends: np.ndarray, widths: np.ndarray) -> dict[str, np.ndarray]:
        """Binary-search the suffixes tests[start:end]; a negative symbol is not in the shard.

        Returns per suffix ``longest`` (words of its longest verbatim match), ``place`` (a
        position of one, -1 if none) and the range ``lo``, ``hi`` in the order of all
        occurrences of its first ``widths`` words (empty if there is none); and per place of
        the order ``match``, the longest prefix that its suffix shares with a test suffix
        that was followed so deep (see below), and ``ranges`` for :meth:`first_test`.

        Ranges of one depth are equal or disjoint and lie inside ranges of the depth before,
        so a place's match is the number of ranges over it, which differences count. A suffix
        whose occurrences all follow occurrences of the suffix one word before it is not
        followed beyond its window: it ends where that one ends, and never matches longer.
        So an item found verbatim takes steps in proportion to its length, not its square.
        """
        m, n = len(starts), len(self.sa)
        longest, place = np.zeros(m, np.int64), np.full(m, -1, np.int64)
        lo_w, hi_w = np.zeros(m, np.int64), np.zeros(m, np.int64)
        lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
        change, ranges = np.zeros(n + 1, np.int64), []
        led = np.zeros(m, bool)  # ends where the suffix before it ends
        follows = np.zeros(m, bool)
        follows[1:] = (starts[1:] == starts[:-1] + 1) & (ends[1:] == ends[:-1])
        widest = int(widths.max(initial=0))
        alive, depth = np.arange(m), 0
        alive = alive[(starts < ends) & (n > 0)]
        while len(alive):
            symbol = tests[starts[alive] + depth]
            a = self._bound(lo[alive], hi[alive], depth, symbol)
            b = self._bound(a, hi[alive], depth, symbol + 1)
            found = (symbol >= 0) & (a < b)
            if depth >= widest:  # alive suffixes whose neighbour before found as many places, one word deeper
                number = np.full(m, -1, np.int64)
                number[alive[found]] = (b - a)[found]
                before = follows[alive] & (number[alive - 1] == hi[alive] - lo[alive])
                led[alive[before]] = True
                found &= ~before
            alive, a, b = alive[found], a[found], b[found]
            lo[alive], hi[alive] = a, b
            depth += 1
            longest[alive], place[alive] = depth, self.sa[a]
            at, one = np.unique(a, return_index=True)
            np.add.at(change, at, 1)
            np.add.at(change, b[one], -1)
            ranges.append((at, alive[one]))
            full = widths[alive] == depth
            lo_w[alive[full]], hi_w[alive[full]] = a[full], b[full]
            alive = alive[starts[alive] + depth < ends[alive]]
        root = np.maximum.accumulate(np.where(led, -1, np.arange(m)))  # the nearest suffix before that is not led
        longest[led] = longest[root[led]] - (np.flatnonzero(led) - root[led])
        place[led] = place[root[led]] + (np.flatnonzero(led) - root[led])
        return {"longest": longest, "place": place, "lo": lo_w, "hi": hi_w, "match": np.cumsum(change[:-1]), "ranges": ranges}

    @staticmethod
    def first_test(ranges: list[tuple[np.ndarray, np.ndarray]], places: np.ndarray, depths: np.ndarray) -> np.ndarray:
        """The first test suffix that shares ``depths`` words with the suffix at each place."""
        out = np.full(len(places), -1, np.int64)
        for depth in np.unique(depths[depths > 0]).tolist():
            at, first = ranges[depth - 1]
            use = depths == depth
            out[use] = first[np.searchsorted(at, places[use], side="right") - 1]
        return out
