"""Token ids of whole text columns with a public tokenizer file.

Made for ``word_bpe_49k.json``, whose normaliser composes characters, lower-cases and drops
white space, and whose pre-tokeniser keeps letters apart from punctuation. So a text can be
cut, without changing its ids, at white space and between an ASCII letter and an ASCII
punctuation mark (other than ``'`` and ``|``, which contractions and special tokens hold).
Each distinct part is encoded once per worker by the ``tokenizers`` library and kept; a
text's ids are its parts' ids in order. At most ``KEEP_WORDS`` parts are kept: beyond it the
memory starts empty again, and results do not change.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

from . import textbytes as tb

KEEP_WORDS = 1_000_000
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[np.frombuffer(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~", np.uint8)] = True
#: parts that the normaliser only lower-cases and the pre-tokeniser leaves whole
_PLAIN = re.compile("[a-zà-öø-ÿ]+|[" + re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~") + "]+")
_ENCODERS: dict[str, "WordEncoder"] = {}


def encoder(path: str) -> "WordEncoder":
    """The worker's encoder for a tokenizer file (loaded once per Python worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def byte_characters() -> list[str]:
    """The characters by which byte-level vocabularies write the 256 bytes: printable ones
    stand for themselves, the others follow from U+0100 on."""
    itself = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in itself]
    names = {b: chr(b) for b in itself} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [names[b] for b in range(256)]


class WordEncoder:
    """Encodes parts of texts. Plain parts go to the vocabulary model alone, many at once
    with a separating id between them; all others through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for k, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))
                 for x in (form.get(k) or {}).get(inner, [])]
        self.bare = None
        if steps == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]:
            form |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
            self.bare = Tokenizer.from_str(json.dumps(form))
            names = byte_characters()
            self.names = {b: name for b, name in enumerate(names)}
            self.between = f" {names[1]} "
            self.between_id = self.bare.encode(names[1], add_special_tokens=False).ids
        self._forget()

    def _encode_parts(self, words: list[str]) -> list:
        plain = [k for k, w in enumerate(words) if _PLAIN.fullmatch(w)] if self.bare and len(self.between_id) == 1 else []
        out: list = [None] * len(words)
        if plain:
            # latin-1 gives each byte a character of its own, which is then renamed
            text = self.between.join(words[k].encode().decode("latin-1").translate(self.names) for k in plain)
            ids = np.asarray(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.between_id[0]), len(ids))
            starts = np.append(0, ends[:-1] + 1)
            for k, a, b in zip(plain, starts.tolist(), ends.tolist()):
                out[k] = ids[a:b]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast([words[k] for k in rest], add_special_tokens=False)):
            out[k] = np.asarray(e.ids, np.uint32)
        return out

    def _forget(self) -> None:
        self.ids = np.zeros(0, np.uint32)
        self.used = 0
        #: (hashes in order, offset and length of their ids), each part at least twice as
        #: long as the next, so that adding words costs few merges
        self.known: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]
        coded = self._encode_parts(words)
        length = np.array([len(c) for c in coded], np.int32)
        total = int(length.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used // 2 + 2 * total, np.uint32)])
        self.ids[self.used:self.used + total] = np.concatenate(coded)
        offset = (self.used + np.cumsum(length) - length).astype(np.int32)
        self.used += total
        part = (hashes, offset, length)
        while self.known and len(self.known[-1][0]) < 2 * len(part[0]):
            both = [np.concatenate(x) for x in zip(self.known.pop(), part)]
            order = np.argsort(both[0])
            part = tuple(x[order] for x in both)
        self.known.append(part)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset (-1: not known) and length of the ids of each hash."""
        offset, length = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for known, at, size in self.known:
            k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[k] == hashes
            offset[hit], length[hit] = at[k[hit]], size[k[hit]]
        return offset, length

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a block of bytes, end to end, and the rows' n + 1 offsets."""
        n = len(bounds) - 1
        cuts = None
        if b"<|" not in memoryview(data).tobytes():  # a special token's text counts as written
            data = tb.LOWER[data]
            letter, mark = _LETTER[data], _MARK[data]
            cuts = np.flatnonzero((letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])) + 1
        starts, ends, rows = tb.word_spans(data, bounds, tb.NON_SPACE, cuts)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        distinct, first, word = np.unique(tb.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if sum(len(k[0]) for k in self.known) + len(distinct) > KEEP_WORDS:
            self._forget()
        new = np.flatnonzero(self._find(distinct)[0] < 0)
        if len(new):
            self._learn(data, distinct[new], starts[first[new]], ends[first[new]])
        offset, length = (x[word] for x in self._find(distinct))
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.repeat(offset - total[:-1], length) + np.arange(int(total[-1]))]
        return ids, total[tb.row_starts(rows, n)]


def encoded_blocks(column: pa.Array, path: str):
    """(i, j, ids, offsets) for each block of rows of a text column."""
    coder = encoder(path)
    for i, j, data, bounds in tb.text_blocks(column):
        yield (i, j, *coder.encode(data, bounds))
