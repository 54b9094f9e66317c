"""The Jaccard join and substring dedup against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from basketlens.llm import op03_jaccard as o3, op10_substring as o10
from basketlens.llm.graph import components

from .conftest import CLASHING, EDGE_ROWS

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute_components(rows, k, pct):
    sets = [shingle_set(t, k) for _, t in rows]
    low = list(range(len(rows)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                low[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), None if d is None else least[root(i)]) for i, (d, _) in enumerate(rows)]


def near_copies(seed, families=12, size=9):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [rng.choice("abcdefghij") + str(rng.randint(0, 400)) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = "edit" + str(rng.randint(0, 50))
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
    rng.shuffle(rows)
    return rows


def key(r):
    return tuple(-1 if x is None else x for x in r)


@pytest.mark.parametrize("k,pct", [(3, 90), (5, 80)])
def test_components_match_brute_force(make_docs, k, pct):
    edges = [(2000 + i if i else None, t) for i, t in EDGE_ROWS if i != 5] + [(2005, "one"), (2006, "One")]
    rows = near_copies(4) + edges
    got = o3.similar_components(make_docs(rows, CLASHING), k, pct).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute_components(rows, k, pct)))


def test_large_family_splits_into_chunks(make_docs, monkeypatch):
    monkeypatch.setattr(o3, "CHUNK", 4)
    monkeypatch.setattr(o3, "BLOCK", 3)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):  # links between two copies need few edits, so many go through others
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            words[rng.randrange(150)] = f"e{i}"
        rows.append((i + 10, " ".join(words)))
    got = o3.similar_components(make_docs(rows), 3, 90).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute_components(rows, 3, 90)))


def test_keep_one_keeps_one_of_each_group(make_docs):
    rows = near_copies(6) + [(None, "x y"), (5000, None), (5001, "")]
    docs = make_docs(rows, CLASHING)
    left = o3.keep_one(docs, 5, 80)
    assert left.columns == docs.columns
    want = [d for (d, _, c) in brute_components(rows, 5, 80) if d is None or c == d]
    assert sorted(key(r) for r in left.select("doc_id").collect()) == sorted(key((d,)) for d in want)


def test_prefixes_of_linked_sets_share_enough():
    rng = random.Random(1)
    for pct, share in ((80, 20), (90, 10), (100, 10)):
        for _ in range(400):
            both, a, b = rng.randint(1, 120), rng.randint(0, 12), rng.randint(0, 12)
            if 100 * both < pct * (both + a + b):
                continue
            order = rng.sample(range(both + a + b), both + a + b)  # token -> place in the order
            sets = [range(both + a), [*range(both), *range(both + a, both + a + b)]]
            heads = [set(sorted(s, key=order.__getitem__)[:int(o3.prefix_length(np.array([len(s)]), pct, share)[0])]) for s in sets]
            for s in sets:
                least = o3.shared_prefix(o3.need(np.array([len(s)]), pct), pct, share)[0]
                assert 1 <= least <= len(heads[0] & heads[1])


def test_shared_tokens_counts_other_nodes(shipped):
    pairs = [(t, n) for t in range(50) for n in range(t % 4)] + [(7, 0), (7, 0), (99, 5), (99, 5)]
    before = shipped.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    shipped.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = o3.shared_tokens(shipped.createDataFrame(pairs, "token long, nid long")).collect()
    finally:
        shipped.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, got)) == sorted({p for p in pairs if len({n for t, n in pairs if t == p[0]}) > 1})


def test_bitmap_holds_every_id(shipped):
    ids = shipped.range(0, 3000, 7)
    bits = o3.id_bitmap(ids)
    hashed = shipped.range(3000).select("id", o3.hashed_id(F.col("id")).alias("h")).toArrow()
    inside = o3.in_bitmap(bits, hashed.column("h").combine_chunks())
    found = set(hashed.column("id").to_numpy()[inside].tolist())
    assert set(range(0, 3000, 7)) <= found and len(found) < 440


def test_empty_table(make_docs):
    none = make_docs([(1, "x")]).where("doc_id < 0")
    assert o3.similar_components(none).count() == 0
    assert o10.dedup(none).count() == 0


def test_components_of_a_chain_and_a_star(shipped):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200)]
    got = dict(components(shipped.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, 200: 200, 300: 200}


# --- substring dedup --------------------------------------------------------------------------

def spans_of(text):
    out, a = [], 0
    for m in re.finditer(r"\n|(?<=[.!?])[ \t]", text):
        out.append((a, m.end()))
        a = m.end()
    return out + ([(a, len(text))] if a < len(text) else [])


def rank(d, text):
    return (1 << 62) + (xxhash.xxh64((text or "").encode(), seed=42).intdigest() >> 2) if d is None else d


def brute_dedup(rows, min_words):
    """Documents in rank order, those without an id by a hash of their text; rows of one rank
    keep the same units."""
    first = {}
    for d, text in rows:
        for a, b in spans_of(text or ""):
            words = tuple(WORD.findall(text[a:b].translate(LOWER)))
            first[words] = min(first.get(words, rank(d, text)), rank(d, text))
    out = []
    for d, text in rows:
        units = [(a, b, tuple(WORD.findall(text[a:b].translate(LOWER)))) for a, b in spans_of(text or "")]
        solid = [u for u in units if u[2]]
        mine, copied = set(), []
        for _, _, w in solid:
            copied.append(first[w] < rank(d, text) or w in mine)
            mine.add(w)
        gone, k = set(), 0
        while k < len(solid):
            e = k
            while e < len(solid) and copied[e] == copied[k]:
                e += 1
            if copied[k] and sum(len(u[2]) for u in solid[k:e]) >= min_words:
                gone |= {u[:2] for u in solid[k:e]}
            k = e
        left = None if text is None else "".join(text[a:b] for a, b, _ in units if (a, b) not in gone)
        out.append((d, left, len(solid), len(gone)))
    return out


def passages(seed):
    rng = random.Random(seed)
    shared = [" ".join(f"s{rng.randint(0, 5)}x{i}" for i in range(rng.randint(1, 9))) + rng.choice([".", "!", ""]) for _ in range(8)]
    rows = []
    for i in range(30):
        parts = []
        for _ in range(rng.randint(0, 8)):
            own = f"own {i} " + " ".join(f"é{rng.randint(0, 10 ** 6)}" for _ in range(4)) + "."
            parts.append(rng.choice([*shared, *(s.upper() for s in shared[:2]), own, "", "  "]))
        rows.append((rng.choice([i, i, i, 3, None]), "".join(p + rng.choice([" ", "\n", "\n\n", "  "]) for p in parts)))
    return rows


@pytest.mark.parametrize("min_words", [1, 8])
def test_dedup_matches_brute_force(make_docs, min_words):
    rows = passages(2) + EDGE_ROWS
    docs = make_docs(rows, CLASHING)
    got = o10.dedup(docs, min_words, whole_lines=False)
    assert got.columns[: len(docs.columns)] == docs.columns
    full = got.collect()
    assert sorted(str((r.doc_id, r.text, r.n_units, r.n_removed)) for r in full) == sorted(map(str, brute_dedup(rows, min_words)))
    before = {}
    for d, t in rows:
        before.setdefault(d, []).append(t or "")
    for r in full:  # the removed spans are offsets in the original text
        cut = []
        for t in before[r.doc_id]:
            kept, at = "", 0
            for a, b in zip(r.removed_spans[0::2], r.removed_spans[1::2]):
                kept, at = kept + t[at:a], b
            cut.append(kept + t[at:])
        assert (r.text or "") in cut


def test_long_shared_passage_goes_everywhere_but_first(make_docs):
    passage = " ".join(f"p{i}" for i in range(60)) + "."
    rows = [(i, f"Own start {i} here. {passage} Own end {i} there.") for i in range(1, 40)] + [(99, "Clean text of its own. No copy.")]
    got = {r.doc_id: r for r in o10.dedup(make_docs(rows)).collect()}
    assert got[1].n_removed == 0 and got[99].n_removed == 0
    assert all(got[i].text == f"Own start {i} here. Own end {i} there." and got[i].removed_words == 60 for i in range(2, 40))


def brute_whole_lines(rows, min_words):
    """Texts left when, besides the runs of brute_dedup, every later copy of a line goes."""
    words_of = lambda t: tuple(WORD.findall(t.translate(LOWER)))
    first_unit, first_line = {}, {}
    for d, text in rows:
        for first, parts in ((first_unit, [text[a:b] for a, b in spans_of(text or "")]), (first_line, (text or "").split("\n"))):
            for w in map(words_of, parts):
                first[w] = min(first.get(w, rank(d, text)), rank(d, text))
    out = []
    for d, text in rows:
        mine, lines, flags, at_line = set(), set(), [], 0
        for line in re.findall(r"[^\n]*\n|[^\n]+$", text or ""):
            w = words_of(line)
            line_copied = bool(w) and (first_line[w] < rank(d, text) or w in lines)
            lines.add(w)
            for a, b in spans_of(line):
                u = words_of(line[a:b])
                flags.append([line[a:b], u, bool(u) and (first_unit[u] < rank(d, text) or u in mine), line_copied and bool(u)])
                mine.add(u)
        solid = [f for f in flags if f[1]]
        for copied, run in itertools.groupby(solid, key=lambda f: f[2]):
            run = list(run)
            if copied and sum(len(f[1]) for f in run) >= min_words:
                for f in run:
                    f[3] = True
        left = None if text is None else "".join(f[0] for f in flags if not f[3])
        out.append((d, left, len(solid), sum(f[3] for f in flags)))
    return out


def test_later_copies_of_whole_lines_go_whatever_their_length(make_docs):
    rows = [(1, "Yes.\nOwn words of one here. All the best."), (2, "YES.  \nOther own words. Yes.\nAll the best.\nLast own."),
            (3, "all  the best.\nSome more here. All the best. And then on."), (4, "Mine.\nMine.\nyes")]
    got = {r.doc_id: r.text for r in o10.dedup(make_docs(rows), whole_lines=True).collect()}
    assert got == {1: rows[0][1], 2: " \nOther own words. Yes.\nAll the best.\nLast own.",
                   3: "Some more here. All the best. And then on.", 4: "Mine.\nyes"}


@pytest.mark.parametrize("seed", [2, 3])
def test_dedup_of_whole_lines_matches_brute_force(make_docs, seed):
    rows = passages(seed) + EDGE_ROWS
    got = o10.dedup(make_docs(rows, CLASHING), whole_lines=True).collect()
    want = brute_whole_lines(rows, 8)
    assert sorted(str((r.doc_id, r.text, r.n_units, r.n_removed)) for r in got) == sorted(map(str, want))
    assert sum(w[3] for w in want) > sum(w[3] for w in brute_dedup(rows, 8))


def test_copies_among_rows_without_ids_go(make_docs):
    passage = " ".join(f"p{i}" for i in range(30)) + "."
    rows = [(None, f"Own one. {passage}"), (None, f"Own two. {passage}"), (7, "Else."), (7, "Buy now here."), (None, "Buy now here.")]
    got = [r.text for r in o10.dedup(make_docs(rows)).collect()]
    assert sum(passage in t for t in got) == 1 and sum("Buy now here." in t for t in got) == 1
    assert sorted(map(str, got)) == sorted(str(w[1]) for w in brute_whole_lines(rows, 8))


def test_group_tasks_give_memory_back(monkeypatch):
    """Workers live on after tasks on groups; what the groups took goes back, batch by batch."""
    import pyarrow as pa
    from basketlens.llm import textbytes
    calls = []
    monkeypatch.setattr(textbytes, "release_memory", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_arrays([pa.array(k), pa.array(v)], ["k", "v"]) for k, v in (([1, 1, 2], [0, 1, 2]), ([2, 3], [3, 4]), ([3], [5]))]
    assert [(t["k"][0].as_py(), t["v"].to_pylist()) for t in textbytes.groups(iter(batches), ["k"])] == [(1, [0, 1]), (2, [2, 3]), (3, [4, 5])]
    assert len(calls) == 4
    from basketlens.llm.op03_jaccard import partial_unions
    sets = pa.RecordBatch.from_arrays([pa.array([7, 7]), pa.array([[1, 2], [2, 3]], pa.list_(pa.int64()))], ["family", "tokens"])
    assert [b.to_pydict() for b in partial_unions(iter([sets]))] == [{"family": [7, 7, 7], "token": [1, 2, 3], "times": [1, 2, 1]}]
    assert len(calls) == 5


def test_cut_texts_holds_one_block(monkeypatch):
    """Blocks come one by one, and no batch of copies becomes Python objects at once."""
    import pyarrow as pa
    from basketlens.llm import textbytes
    texts = ["one two three. one two three. end here", None, "", "one two three. end here", "four five"]
    units = o10.Units(*[(np.frombuffer(b"end here", np.uint8), np.array([0, 8]))][0])
    pair = {"d1": int(units.digests[0][0]), "d2": int(units.digests[1][0])}
    kind = pa.list_(pa.struct([("d1", pa.int64()), ("d2", pa.int64())]))
    copies = pa.array([None, [pair], [], [pair], None], kind)
    monkeypatch.setattr(textbytes, "row_blocks", lambda bounds, limit=0: iter([(0, 3), (3, 5)]))
    blocks = o10.cut_texts(pa.array(["x", *texts])[1:], pa.concat_arrays([pa.array([[pair]], kind), copies])[1:], 1)
    assert not isinstance(blocks, list)
    first, second = blocks
    assert first[0].to_pylist() == ["one two three. end here", "", ""] and second[0].to_pylist() == ["one two three. ", "four five"]
    assert first[1].to_pylist() == [[15, 30], [], []] and second[1].to_pylist() == [[15, 23], []]


def test_texts_go_to_workers_in_bounded_batches(shipped):
    """Operators on texts bound the bytes of a batch, and leave a bound that the session has."""
    import pyarrow as pa
    from basketlens.llm import op08_packing, op09_classifier
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = shipped.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
    operators = [lambda: o10.dedup(docs), lambda: op08_packing.pieces(docs, ""), lambda: o3.keep_one(docs.limit(5)),
                 lambda: op09_classifier.score(docs, op09_classifier.Network.fresh(0))]
    try:
        for operator in operators:
            shipped.conf.unset(name)
            operator()
            assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 6 << 20
        shipped.conf.set(name, "1m")
        o10.dedup(docs)
        assert shipped.conf.get(name) == "1m"
    finally:
        shipped.conf.unset(name)


def test_counts_and_unions_hang_on_tasks_not_on_batches():
    """Batches of one row give the same counts of buckets and the same unions as one batch."""
    import pyarrow as pa
    from basketlens.llm.op03_jaccard import partial_unions

    class Docs:  # a task's function, as mapInArrow gets it
        def mapInArrow(self, f, schema):
            return f
    sign = o3.first_pass(Docs(), 1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["same words", "same", "other", "same", "same", "same"])], ["doc_id", "text"])
    counted = [[r for b in sign(iter(x)) for r in b.to_pylist() if r["kind"] == o3.COUNT] for x in ([batch], [batch.slice(k, 1) for k in range(6)])]
    assert counted[0] == counted[1] and [r["n"] for r in counted[1]] == [5]
    sets = pa.RecordBatch.from_arrays([pa.array([7, 8, 7]), pa.array([[1, 2], [2], [2, 3]], pa.list_(pa.int64()))], ["family", "tokens"])
    whole = [{"family": [7, 7, 7, 8], "token": [1, 2, 3, 2], "times": [1, 2, 1, 1]}]
    assert [b.to_pydict() for b in partial_unions(iter([sets.slice(k, 1) for k in range(3)]))] == whole
    assert not list(partial_unions(iter([sets.slice(0, 0)])))


def test_full_unions_leave_the_task(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(o3, "UNITED", 2)
    sets = [pa.RecordBatch.from_arrays([pa.array([7]), pa.array([t], pa.list_(pa.int64()))], ["family", "tokens"]) for t in ([1, 2, 3], [3], [3, 4])]
    got = [b.to_pydict() for b in o3.partial_unions(iter(sets))]
    assert [g["token"] for g in got] == [[1, 2, 3], [3, 4]] and [g["times"] for g in got] == [[1, 1, 1], [2, 1]]


def test_a_block_takes_little_memory():
    """What a worker needs for the units of a few MB of texts stays near what it needs for one block."""
    import tracemalloc
    import pyarrow as pa
    texts = pa.array([" ".join(f"w{k}x{i}" for i in range(300)) + ".\n" for k in range(1500)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), texts], ["_rank", "text"])
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in o10.unit_digests(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 1500 and peak < 64 << 20, peak
