"""Exact dedup, the prefix trie and structure repair against brute force."""

import hashlib

import pytest
from pyspark.sql import functions as F

from basketlens.llm import op11_exact as o11, skew

from .conftest import CLASHING, EDGE_ROWS


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out, done = [], set()
    for i, t in rows:
        g = groups[t or ""]
        known = [x for x in g if x is not None]
        best = max(known) if known else None
        first = i == best and (t or "") not in done
        if first:
            done.add(t or "")
        out.append((i, best, len(g), first, hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("capacity", [1, 4, 1 << 13])
def test_exact_dedup_matches_brute_force(make_docs, capacity):
    rows = EDGE_ROWS + [(100 + i, f"text {i % 17}") for i in range(80)] + [(300, "text 3"), (300, "text 3"), (None, "only null"), (None, "only null")]
    got = o11.exact_dedup(make_docs(rows, CLASHING), capacity=capacity).collect()
    assert order(got) == order(brute_exact(rows))


def test_equal_keys_chain_and_bytes_decide(make_docs, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.pmod(F.hash(*c), F.lit(3)).cast("long"))  # every key collides
    rows = [(i, f"t{i % 11}") for i in range(60)]
    index = o11.build_index(make_docs(rows), capacity=2)
    assert order(o11.exact_dedup(make_docs(rows)).collect()) == order(brute_exact(rows))
    longest = index.chains.groupBy("bucket", "key").agg(F.max("chain").alias("m"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in longest) == 11 and all(r["m"] == r["n"] for r in longest) and max(r["n"] for r in longest) > 1


def test_directory_splits_overfull_buckets_only(shipped):
    low = shipped.range(400).select((F.col("id") * (1 << 40)).alias("key"))           # all in the first slots
    high = shipped.range(5).select((F.lit(-1).cast("long") - F.col("id")).alias("key"))  # all in the last slot
    found = o11.directory(low.union(high), capacity=16).collect()
    assert len({r["slot"] for r in found}) == len(found)
    deep = max(r["depth"] for r in found)
    last = [r for r in found if r["slot"] == (1 << o11.MAX_DEPTH) - 1]
    assert deep > last[0]["depth"] and deep <= o11.MAX_DEPTH
    for r in found:  # a bucket is the range of slots that share its leading bits
        assert r["bucket"] == r["slot"] >> (o11.MAX_DEPTH - r["depth"]) << (o11.MAX_DEPTH - r["depth"])


def test_exact_dedup_of_empty_table_and_normalised_texts(make_docs):
    none = make_docs([(1, "x")]).where("doc_id < 0")
    assert o11.exact_dedup(none).count() == 0 and o11.remove_copies(none).count() == 0
    got = o11.exact_dedup(make_docs([(1, "A b"), (2, "a B"), (3, "c")]), normalise=F.lower).collect()
    assert order(r[:4] for r in got) == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]


def test_remove_copies_keeps_all_columns(make_docs):
    rows = EDGE_ROWS + [(20, "one"), (21, "two"), (22, "two")]
    docs = make_docs(rows, CLASHING)
    left = o11.remove_copies(docs)
    assert left.columns == docs.columns
    kept = {(i, t or "") for (i, t), r in zip(rows, brute_exact(rows)) if r[3] or i == r[1]}
    assert {(r["doc_id"], r["text"] or "") for r in left.collect()} == kept


def test_exact_dedup_plan_has_no_python(make_docs):
    plan = o11.exact_dedup(make_docs([(1, "x"), (2, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_join_unique_splits_hot_and_cold_keys(shipped, monkeypatch):
    monkeypatch.setattr(skew, "HOT", 4)
    left = shipped.range(100).select((F.when(F.col("id") < 40, 0).otherwise(F.col("id"))).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("w"), F.max("id").alias("top")).where("k % 2 = 0")
    got = {(r["id"], r["top"]) for r in skew.join_unique(left, right, ["k"], "w").collect()}
    assert got == {(i, 39 if i < 40 else i if i % 2 == 0 else None) for i in range(100)}


CHATS = "conv_id long, turn long, role string, text string"


def chat_order(r):
    return (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")


def chats_by_id(rows):
    chats = {}
    for r in sorted((r for r in rows if r[0] is not None), key=chat_order):
        chats.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return chats


def brute_trie(chats):
    nodes = {}
    for c, turns in chats.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, who in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(who) if len(chats[c]) == len(path))
        out.append((min(who), len(path), min(nodes[path[:-1]]) if path else None, len(who), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def brute_rebuilt(chats):
    import zlib
    out = {}
    for c, turns in chats.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = chats.get(c - c % 100, [])[:h] + turns[h:]
    return out


def some_chats(seed=3):
    import random
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 30), *range(95, 140), *range(250, 262), 1000001]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"say {rng.randint(0, 1 + t)}"))
    rows += [(400, t, "user", "same") for t in range(40)] + [(401, t, "user", "same") for t in range(70)]
    rows += [(402, None, None, None), (402, None, "user", "b"), (402, 1, "user", ""), (402, 1, "user", ""), (403, 0, "user", "ü" * 5000)]
    rows += [(None, 0, "user", "nobody"), (404, 3, "user:", "x"), (404, 3, "user", ":x")]
    return rows


@pytest.mark.parametrize("lead,width", [(True, 1 << 22), (False, 1 << 22), (True, 1 << 5), (False, 1 << 9)])
def test_trie_matches_brute_force(shipped, lead, width):
    from basketlens.llm import op12_trie as o12
    rows = some_chats()
    chats = chats_by_id(rows)
    df = shipped.createDataFrame(rows, CHATS).repartition(4)
    for name in ("n", "pos", "digest", "depth", "parent"):  # names that could clash
        df = df.withColumn(name, F.lit("x"))
    got = o12.prefix_trie(df, lead=lead, width=width).collect()
    assert order(got) == order(brute_trie(brute_rebuilt(chats) if lead else chats))


def test_trie_of_empty_tables_and_turnless_conversations(shipped):
    from basketlens.llm import op12_trie as o12
    for lead in (True, False):
        assert o12.prefix_trie(shipped.createDataFrame([], CHATS), lead=lead).count() == 0
        assert o12.prefix_trie(shipped.createDataFrame([(None, 0, "user", "x")], CHATS), lead=lead).count() == 0
    import zlib
    c = next(c for c in range(501, 599) if zlib.crc32(str(c).encode()) % 6 >= 2)  # no donor: all its turns go
    got = o12.prefix_trie(shipped.createDataFrame([(c, 0, "user", "x")], CHATS), lead=True).collect()
    assert [tuple(r)[:7] for r in got] == [(c, 0, None, 1, 0, 1, 0)] and got[0][7] == hashlib.sha256(str(c).encode()).hexdigest()


def test_end_lists_stream_pieces_in_order(shipped, monkeypatch):
    from basketlens.llm import op12_trie as o12
    monkeypatch.setattr(o12, "PIECE", 4)
    ids = [-9, -1, 0, 3, 4, 5, 17, 100, 1000]
    got = dict(map(tuple, o12.end_lists(shipped.createDataFrame([(k, i) for k in "ab" for i in ids], "digest string, conv_id long")).collect()))
    assert got == {k: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() for k in "ab"}
