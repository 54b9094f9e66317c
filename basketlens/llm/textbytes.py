"""Numpy helpers over Arrow text columns: byte blocks, words, hashes.

Texts stay UTF-8 bytes. All separators used here are ASCII, so working on bytes gives the
same words as working on code points. Every helper handles empty texts; a null text counts
as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 512 << 10  # arrays with eight bytes for each byte of text are some ten at a time

try:  # only where the C library has it
    _LIBC = ctypes.CDLL(None)
    _LIBC.malloc_trim
except (OSError, AttributeError):
    _LIBC = None

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: bytes of words that any white space separates
NON_SPACE = ~_SPACE
#: bytes of words made of ASCII lower-case letters, digits and all non-ASCII characters
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: A-Z to a-z, other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values that spreads every bit."""
    x = x.astype(_U, copy=True)
    x += _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_POSITIONS = 64
_TABLE = mix(np.arange(_POSITIONS * 256, dtype=_U))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, bounds


def row_blocks(bounds: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of whole rows with at most ``limit`` bytes (a longer row is alone)."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def release_memory() -> None:
    """Give freed memory back to the system. Python workers live on between tasks, and what
    their allocators hold back counts against the executor while other stages run."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, bytes, bounds) for every block of rows; bounds start at 0."""
    raw, bounds = text_bytes(column)
    for i, j in row_blocks(bounds, limit):
        yield i, j, raw[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
    del raw
    release_memory()


def word_spans(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray,
               cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words: maximal runs of bytes in ``is_word``
    that lie in one row. ``cuts`` are further places before which a word ends."""
    inside = is_word[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    if cuts is not None:
        edges = np.concatenate([edges, cuts])
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit tabulation hash of each word: the sum of one random value per (position,
    byte), mixed again. Long words are hashed whole."""
    out = np.zeros(len(starts), _U)
    i = 0
    while i < len(starts):  # pieces bound the memory for the per-byte arrays
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES, side="right")))
        lengths = ends[i:j] - starts[i:j]
        firsts = np.cumsum(lengths) - lengths
        position = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(firsts, lengths)
        byte = data[position + np.repeat(starts[i:j], lengths)]
        key = (position << 8) | byte
        if position.max() < _POSITIONS:
            values = _TABLE[key]
        else:
            values = mix(key)
        out[i:j] = np.add.reduceat(values, firsts)
        i = j
    return mix(out ^ _U(seed))


def row_starts(rows: np.ndarray, n: int) -> np.ndarray:
    """For sorted row numbers, the n + 1 offsets at which each row's entries start."""
    return np.searchsorted(rows, np.arange(n + 1))


def shingles(hashes: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the distinct hashes of its k-word shingles, sorted, and the rows' offsets.

    ``starts`` are the rows' n + 1 offsets into ``hashes``. A row of 1 to k - 1 words has
    its whole sequence as the only shingle; a row without words has none.
    """
    n = len(starts) - 1
    count = np.diff(starts)
    number = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    rows = np.repeat(np.arange(n), number)
    firsts = np.cumsum(number) - number
    at = np.arange(int(number.sum())) - np.repeat(firsts, number) + np.repeat(starts[:-1], number)
    width = np.minimum(count, k)[rows]
    value = np.zeros(len(at), _U)
    for step in range(k):
        use = width > step
        value[use] = mix(value[use] * _U(0x9E3779B97F4A7C15) + hashes[at[use] + step])
    order = np.lexsort((value, rows))
    value = value[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    return value[keep], row_starts(rows[keep], n)


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow list column from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def groups(batches, keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal ``keys`` from a stream of batches that is
    sorted by them (groups may span batches). Memory of groups that are done goes back to the
    system after each batch."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.zeros(batch.num_rows, bool)
        same[1:] = True
        for k in keys:
            col = batch.column(batch.schema.get_field_index(k))
            values = np.asarray(col.to_numpy(zero_copy_only=False))
            same[1:] &= values[1:] == values[:-1]
        cuts = [*np.flatnonzero(~same).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(batch.column(batch.schema.get_field_index(k))[a].as_py() for k in keys)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            held_key = key
        del batch
        release_memory()
    if held:
        table = pa.Table.from_batches(held)
        held = []
        yield table
        del table
        release_memory()
