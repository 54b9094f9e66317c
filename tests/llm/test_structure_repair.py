"""Structure repair against a plain search over all edits."""

import functools
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import op13_repair as o13

CHATS = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate({ord(x): None for x in ".!?"}) if fault == 2 else text
        out += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        said = text.rstrip(BLANK)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(turns):
    """(cost, audit, lines), the least of all edit sequences; written over prefixes of roles."""
    marks = faults(turns)

    @functools.cache
    def best(i, state, inserts):
        found = []
        if i == len(turns) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            role = {"": "user", "s": "user", "a": "user", "u": "assistant"}[state]
            cost, audit, lines = best(i, role[0], inserts + 1)
            found.append((cost + 2, "I" + audit, (f"{role}:",) + lines))
        if i < len(turns):
            role, text = turns[i]
            cost, audit, lines = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, lines))
            if marks[i] not in ("blank", "duplicate"):
                for letter, said, paid in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if said and state + said[0] in ("s", "u", "su", "au", "ua"):
                        cost, audit, lines = best(i + 1, said[0], 0)
                        found.append((cost + paid + (marks[i] == "truncated"), letter + audit, (f"{said}:{text}",) + lines))
        return min(found, default=(10 ** 9, "", ()))
    return best(0, "", 0)


def brute_summary(rows, ids):
    out = []
    for c in ids:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [(r[2], r[3]) for r in mine]
        known = [r[1] for r in mine if r[1] is not None]
        marks = faults(turns)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = brute_repair(turns)
        out.append((c, max(known) - min(known) + 1 - len(set(known)) if known else 0, *(marks.count(f) for f in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def some_rows(seed=5):
    rng = random.Random(seed)
    rows = []
    for c in [*range(60), -4]:
        for t in range(rng.randint(1, 11)):
            if rng.random() < .9:
                role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sUser", "Assistant"])
                rows.append((c, t if rng.random() < .95 else None, role, rng.choice(["Yes.", "no", "What?\n ", "", "\t", "ok!", f"n{t}.", "ü…"])))
    rows += [(500, 0, None, None), (500, 1, "user", None), (500, 1, None, "x."), (None, None, "user", "hm."), (None, 3, "assistant", "hm")]
    rows += [(600, 1, "user", "same."), (600, 1, "user", "same."), (601, 2 ** 40, "user", "far."), (602, 0, "user", "y." * 200_000)]
    rows += [(700, t, rng.choice(["user", "assistant", "system"]), f"t{t % 60}" + rng.choice([".", ""])) for t in range(90)]
    return rows


@pytest.mark.parametrize("segment,damage", [(4096, True), (8, True), (8, False)])
def test_repair_matches_brute_force(shipped, monkeypatch, segment, damage):
    monkeypatch.setattr(o13, "SEGMENT", segment)
    rows = some_rows()
    df = shipped.createDataFrame(rows, CHATS).repartition(4)
    for name in ("n", "pos", "fault", "symbol", "cost", "audit", "known"):
        df = df.withColumn(name, F.lit("x"))
    plain = brute_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    got = o13.repair_summary(df, damage=damage).collect()
    assert order(got) == order(brute_summary(plain, {r[0] for r in rows}))


def test_empty_tables_and_conversations_without_rows(shipped):
    none = shipped.createDataFrame([], CHATS)
    assert o13.repair_summary(none).count() == 0 and o13.repair_summary(none, damage=True).count() == 0
    c = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = o13.repair_summary(shipped.createDataFrame([(c, 0, "user", "x.")], CHATS), damage=True).collect()
    assert [tuple(r) for r in got] == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_lines_are_the_text_behind_the_digest(shipped):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b"), (2, 0, "system", "s."), (2, 5, "user", "c.")]
    summary, lines = o13.repair(shipped.createDataFrame(rows, CHATS))
    text = {}
    for r in sorted(lines.collect()):
        text.setdefault(r["conv_id"], []).extend([r["lines"]] if r["lines"] is not None else [])
    got = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in summary.collect()}
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in text.items()} == {c: s for c, (_, s) in got.items()}
    assert got[2][0] == "KKI" and "\n".join(text[2]) == "system:s.\nuser:c.\nassistant:"


def test_block_tables_equal_single_steps():
    t = o13.tables()
    rng = np.random.default_rng(2)
    for _ in range(300):
        block, v = rng.integers(0, o13.SYMBOLS, o13.BLOCK), int(rng.integers(len(t.vectors)))
        code, at, paid = int(o13._code(block[None])[0]), v, 0
        for symbol in block[::-1]:
            paid += t.cost[at, symbol]
            at = t.step[at, symbol]
        assert (t.block[v, code], t.block_cost[v, code]) == (at, paid)
    assert all(min(v) == 0 and max(v) <= 8 for v in t.vectors) and len(t.vectors) < 200
