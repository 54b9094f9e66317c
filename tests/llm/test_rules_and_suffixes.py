"""Quality rules and benchmark decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from basketlens.llm import op02_rules, op07_decontaminate as o7, suffixes as sx, textbytes as tb

from .conftest import CLASHING, EDGE_ROWS

SPACE_WORD = re.compile("[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def random_texts(n, seed, vocabulary=6, longest=120):
    rng = random.Random(seed)
    words = ["a", "Bb", "cé", "d#", "e.", "|", "中文"][:vocabulary]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, longest)))
        out.append(text + (text[: rng.randint(0, len(text))] if rng.random() < 0.5 else ""))
    return out


def brute_rules(text):
    words = SPACE_WORD.findall(text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    repeat = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(repeat) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeat), failed)


def longest_repeat(words):
    best = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
    return best if best >= 8 else 0


def test_suffix_array_and_prefixes_match_sorting():
    rng = np.random.default_rng(3)
    for n, letters in ((0, 1), (1, 1), (2, 1), (50, 1), (200, 2), (300, 4), (400, 100)):
        s = rng.integers(0, letters, n)
        sa, levels = sx.suffix_array(s, keep_levels=True)
        assert sa.tolist() == sorted(range(n), key=lambda i: s[i:].tolist())
        i, j = rng.integers(0, max(n, 1), (2, 40)) if n else (np.zeros(0, int), np.zeros(0, int))
        for a, b, got in zip(i, j, sx.common_prefix(levels, i, j)):
            if a != b:
                k = 0
                while max(a, b) + k < n and s[a + k] == s[b + k]:
                    k += 1
                assert got == k


def test_rules_match_brute_force(make_docs):
    rows = list(enumerate(random_texts(60, 1))) + [(i + 100, t) for i, t in EDGE_ROWS if i is not None] + [(None, "a b")]
    got = op02_rules.quality_rules(make_docs(rows, CLASHING)).collect()
    assert len(got) == len(rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id,) + tuple(r[1:7]) for r in got) == \
        sorted((-1 if i is None else i,) + brute_rules(t) for i, t in rows)
    by_id = {r.doc_id: r for r in got}
    for i, text in enumerate(random_texts(60, 1)):
        words = SPACE_WORD.findall(text)
        r = by_id[i]
        assert r.longest_repeat == longest_repeat(words)
        assert r.kept == (not r.base_failed and 100 * r.n_repeat_words <= 20 * r.n_words and r.longest_repeat <= 100)


def test_rules_limits_decide(make_docs):
    words = [f"w{i}" for i in range(400)]
    long_copy = " ".join(words + words[:110] + [f"v{i}" for i in range(600)])
    short_copy = " ".join(words + words[:90] + [f"v{i}" for i in range(600)])
    got = {r.doc_id: r for r in op02_rules.quality_rules(make_docs([(1, long_copy), (2, short_copy)])).collect()}
    assert (got[1].longest_repeat, got[1].base_failed, got[1].kept) == (110, False, False)
    assert (got[2].longest_repeat, got[2].kept) == (90, True)


def brute_hits(text, items, window=13):
    words = ALNUM_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, item_text in items:
        w = ALNUM_WORD.findall((item_text or "").translate(LOWER))
        if item is None or not w:
            continue
        size = min(window, len(w))
        for a in range(len(w) - size + 1):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == w[a:a + size]:
                    hit.update(range(i, i + size))
                    found.add(item)
    ids = ",".join(sorted(map(str, found)))
    return (len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words))


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs away from all of the hounds"), (22, "short item"),
         (3, None), (4, "..."), (None, "lazy dog"), (22, "short item"), (5, "É à quoi")]


@pytest.mark.parametrize("block_words", [4_000_000, 20])
def test_decontamination_matches_brute_force(shipped, make_docs, block_words):
    rng = random.Random(5)
    words = ITEMS[0][1].split() + ["short", "item", "é", "À", "x-y", "É à quoi"]
    rows = []
    for i in range(40):
        cut = sorted(rng.sample(range(18), 2))
        rows.append((i, " ".join([rng.choice(words) for _ in range(rng.randint(0, 30))] + words[cut[0]:cut[1]] + ["SHORT", "Item"] * (i % 3))))
    rows += [(100 + i, t) for i, t in EDGE_ROWS if i is not None] + [(None, ITEMS[0][1])]
    bench = shipped.createDataFrame(ITEMS, "item_id long, text string")
    got = o7.decontamination(make_docs(rows, CLASHING), bench, block_words=block_words).collect()
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted(key(r[:6]) for r in got) == sorted(key((i, *brute_hits(t, ITEMS))) for i, t in rows)
    whole = next(r for r in got if r.doc_id is None)
    assert (whole.longest_match, whole.longest_item, whole.longest_word, whole.hit_spans) == (17, 1, 0, [0, 17])


@pytest.mark.parametrize("block_words", [4_000_000, 20])
def test_every_row_has_its_own_longest_match(shipped, make_docs, block_words):
    rng = random.Random(6)
    words = ITEMS[0][1].split()
    rows = [(1, "so " + ITEMS[0][1]), (2, "so " + ITEMS[0][1]), (3, " ".join(words[4:11])), (4, "none here"), (5, None)]
    rows += [(10 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(30)]
    items = [(i, ALNUM_WORD.findall(t.translate(LOWER))) for i, t in ITEMS if i is not None and t]
    bench = shipped.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.doc_id: r for r in o7.decontamination(make_docs(rows).coalesce(1), bench, block_words=block_words).collect()}
    for d, text in rows:
        mine = ALNUM_WORD.findall((text or "").translate(LOWER))
        longest = max((n for _, w in items for i in range(len(mine)) for n in range(1, len(mine) - i + 1)
                       for a in range(len(w) - n + 1) if w[a:a + n] == mine[i:i + n]), default=0)
        r = got[d]
        assert r.longest_match == longest
        if longest:
            part, w = mine[r.longest_word:r.longest_word + longest], next(w for i, w in items if i == r.longest_item)
            assert len(part) == longest and any(w[a:a + longest] == part for a in range(len(w)))
    assert [(got[d].longest_match, got[d].longest_item, got[d].longest_word) for d in (1, 2, 3)] == [(17, 1, 1), (17, 1, 1), (7, 1, 0)]


def test_remove_contaminated_keeps_columns(shipped, make_docs):
    docs = make_docs([(1, ITEMS[0][1]), (2, "clean text"), (3, None), (None, "")], CLASHING)
    bench = shipped.createDataFrame(ITEMS, "item_id long, text string")
    left = o7.remove_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.where("doc_id <> 1 or doc_id is null").collect()))


def test_empty_tables(shipped, make_docs):
    none = make_docs([(1, "x")]).where("doc_id < 0")
    bench = shipped.createDataFrame(ITEMS, "item_id long, text string")
    assert op02_rules.quality_rules(none).count() == 0
    assert o7.decontamination(none, bench).count() == 0
    got = o7.decontamination(make_docs([(1, "short item")]), bench.where("item_id < 0")).collect()
    assert (got[0].n_hit, got[0].contaminated) == (0, False)


def test_words_cross_pieces():
    data = np.frombuffer(("ab " * 5 + "x" * 100).encode(), np.uint8)
    starts, ends, rows = tb.word_spans(data, np.array([0, 5, len(data)]), tb.NON_SPACE)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == ["ab", "ab", "ab", "ab", "ab", "x" * 100]
    assert rows.tolist() == [0, 0, 1, 1, 1, 1]
    hashes = tb.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == 2


def test_long_verbatim_items_and_repetitive_texts_stay_cheap():
    import time
    import tracemalloc

    from basketlens.llm import op07_decontaminate as o7
    from basketlens.llm import textbytes as tb
    import pyarrow as pa

    def run(text, item):
        data, bounds = tb.text_bytes(pa.array([text], pa.string()))
        return o7.match_block(data, bounds, o7.encode_tests([5], [item], 13))
    words = [f"w{i}" for i in range(16_000)]
    begun = time.time()
    got = run("x " + " ".join(words) + " y", " ".join(words))
    assert got["longest"].tolist() == [16_000] and got["longest_word"].tolist() == [1] and time.time() - begun < 5
    tracemalloc.start()
    got = run("a " * 200_000, "a " * 800)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["longest"].tolist() == [800] and set(got["item"].tolist()) == {5} and len(got["word"]) == 200_000 - 12
    assert peak < 200e6


def test_search_finds_every_longest_match():
    import random

    import numpy as np

    from basketlens.llm import suffixes as sx
    rng = random.Random(8)
    for trial in range(60):
        alphabet = rng.choice([1, 2, 5])
        shard = [rng.randrange(alphabet) for _ in range(rng.randint(1, 60))]
        items = [[rng.randrange(alphabet) for _ in range(rng.randint(1, 30))] for _ in range(3)]
        if rng.random() < .5:
            items[0] = shard[5:25] or [0]
        flat = np.array([x for i in items for x in i])
        ends = np.repeat(np.cumsum([len(i) for i in items]), [len(i) for i in items])
        starts, widths = np.arange(len(flat)), np.minimum(3, ends - np.arange(len(flat)))
        index = sx.SuffixIndex(np.array(shard))
        got = index.search(flat, starts, ends, widths)

        def shared(i, j, end):
            k = 0
            while i + k < len(shard) and j + k < end and shard[i + k] == flat[j + k]:
                k += 1
            return k
        table = np.array([[shared(i, j, ends[j]) for j in starts] for i in range(len(shard))])
        assert got["longest"].tolist() == table.max(0).tolist()
        for j, p in enumerate(got["place"].tolist()):
            assert p < 0 or table[p, j] == got["longest"][j]
        assert [int((table[:, j] >= widths[j]).sum()) for j in starts] == (got["hi"] - got["lo"]).tolist()
        best = got["match"].max()
        assert best == table.max()  # the row's longest match
        at = np.flatnonzero(got["match"] == best)
        first = index.first_test(got["ranges"], at, got["match"][at]) if best else []
        for place, test in zip(at, first):
            assert test == np.flatnonzero(table[index.sa[place]] == best)[0]
