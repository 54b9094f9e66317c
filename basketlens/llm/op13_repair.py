"""Conversation structure repair by four-Russians block tables.

The edits that turn a conversation's roles into ``(s?(ua)+)?`` at least cost come from a
dynamic program over rows with four states: what has been kept so far ends with nothing, a
system, a user or an assistant turn. Its column of costs-to-go, less its minimum, takes
only a few different values, so for every fixed-length block of row symbols and every such
vector the next vector and the cost are computed beforehand. Conversations are processed
block by block, from the last to the first, by lookup. Tracing expands the blocks again,
from the vectors kept at their ends, in the opposite order: at each row the first edit in
ASCII order that keeps the least cost is taken, so ties are decided by whole audit strings.

Rows are placed by range partitions and cut into segments of SEGMENT rows, so that no task
gathers a conversation. A segment of a longer conversation is first a function from vectors
to vectors (and from entry states to exit states); these small functions are chained in
streams. Only the digest of a repaired text, which is sequential by nature, has a task
stream a conversation's rows in order; it holds one batch of them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import skew
from .turns import placed

START, SYSTEM, USER, ASSISTANT = range(4)  # states, and classes of role initials (START: any other)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
TRUNCATED, DROP, PAD, SYMBOLS = 4, 8, 9, 10  # symbols: class, class + TRUNCATED, DROP, PAD
DELETE, INSERT, REROLE, PENALTY = 3, 2, 2, 1
BLOCK = 4          # symbols of a block
SEGMENT = 4096     # rows of a segment
NEVER = 1 << 20
NEXT = np.array([USER, USER, ASSISTANT, USER])  # the state after a given user or assistant turn
ROLE = {USER: "user", ASSISTANT: "assistant"}


def _closed(costs: np.ndarray) -> np.ndarray:
    """Costs-to-go after any inserts that help."""
    for _ in range(3):
        costs = np.minimum(costs, INSERT + costs[NEXT])
    return costs


def _kept(state: int, symbol: int) -> int | None:
    """The state after a row is kept, None if it may not be."""
    role = symbol % TRUNCATED
    if role == SYSTEM:
        return SYSTEM if state == START else None
    return role if role in ROLE and NEXT[state] == role else None


class Tables:
    """``vectors``: normalised columns of costs-to-go; number 0 is the end's. ``step``, ``cost``:
    by (vector, symbol). ``block``, ``block_cost``: by (vector, code of BLOCK symbols, the first
    most significant). ``inserts``, ``edit``, ``leave``: by (vector after the row, symbol, state):
    inserts before the row, the edit's letter, the state after it."""

    def __init__(self):
        end = np.array([0, NEVER, NEVER, 0])
        self.vectors = [tuple(_closed(end).tolist())]
        number = {self.vectors[0]: 0}
        step, cost, inserts, edit, leave = [], [], [], [], []
        for v, vector in enumerate(self.vectors):  # grows while it is walked
            after = np.array(vector)
            for out in (step, cost, inserts, edit, leave):
                out.append([])
            for symbol in range(SYMBOLS):
                if symbol == PAD:
                    step[v].append(v)
                    cost[v].append(0)
                    inserts[v].append([0] * 4)
                    edit[v].append([0] * 4)
                    leave[v].append(list(range(4)))
                    continue
                choices = [self._choices(q, symbol, after) for q in range(4)]
                before = _closed(np.array([min(c for c, _, _ in options) for options in choices]))
                least = int(before.min())
                key = tuple((before - least).tolist())
                if key not in number:
                    number[key] = len(self.vectors)
                    self.vectors.append(key)
                step[v].append(number[key])
                cost[v].append(least)
                traced = [self._trace(q, before, choices) for q in range(4)]
                for out, column in zip((inserts, edit, leave), zip(*traced)):
                    out[v].append(list(column))
        self.step, self.cost, self.inserts, self.edit, self.leave = (np.array(x) for x in (step, cost, inserts, edit, leave))
        self.block, self.block_cost = self.step, self.cost
        for _ in range(BLOCK - 1):  # one more symbol in front: it is applied last
            rest, paid = self.block, self.block_cost
            self.block = self.step[rest].transpose(0, 2, 1).reshape(len(rest), -1)
            self.block_cost = (paid[:, :, None] + self.cost[rest]).transpose(0, 2, 1).reshape(len(rest), -1)

    @staticmethod
    def _choices(state: int, symbol: int, after: np.ndarray) -> list[tuple[int, int, int]]:
        """(cost-to-go, letter, next state) of the edits of one row, in ASCII order."""
        options = [(DELETE + int(after[state]), ord("D"), state)]
        if symbol < DROP:
            more = PENALTY * (symbol >= TRUNCATED)
            kept = _kept(state, symbol)
            if kept is not None:
                options.append((more + int(after[kept]), ord("K"), kept))
            options.append((REROLE + more + int(after[NEXT[state]]), ord("R"), int(NEXT[state])))
        return options

    @staticmethod
    def _trace(state: int, before: np.ndarray, choices) -> tuple[int, int, int]:
        """Inserts, letter and next state: at each point D, then I, then K, then R."""
        inserted = 0
        while True:
            best = [(letter, after) for cost, letter, after in choices[state] if cost == before[state]]
            if best and best[0][0] == ord("D") or before[state] != INSERT + before[NEXT[state]]:
                return inserted, *best[0]
            state, inserted = int(NEXT[state]), inserted + 1


@functools.cache
def tables() -> Tables:
    """Built once per process; some 10^5 entries, whatever the data."""
    return Tables()


def final_inserts(state: int) -> int:
    return {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}[state]


def inserted_lines(state: int, count: int) -> tuple[list[str], int]:
    """Lines of inserted turns from a state, and the state after them."""
    lines = []
    for _ in range(count):
        state = int(NEXT[state])
        lines.append(f"{ROLE[state]}:")
    return lines, state


# --- segments inside tasks -----------------------------------------------------------------

def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of each segment padded at the end to whole blocks (blocks x BLOCK), the
    segments' block offsets, and their numbers of rows."""
    at = column.offsets.to_numpy()
    flat, at = column.values.to_numpy()[at[0]:at[-1]], at - at[0]
    rows = np.diff(at)
    blocks = -(-rows // BLOCK)
    offsets = np.concatenate([[0], np.cumsum(blocks)])
    out = np.full(int(offsets[-1]) * BLOCK, PAD)
    out[np.arange(len(flat)) + np.repeat(offsets[:-1] * BLOCK - at[:-1], rows)] = flat
    return out.reshape(-1, BLOCK), offsets, rows


def _code(blocks: np.ndarray) -> np.ndarray:
    return blocks @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)


def look_up(blocks: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in front of each segment, from those behind it, by block lookups from the last
    block to the first; and the vector behind each block (first column only)."""
    t, code, count = tables(), _code(blocks), np.diff(offsets)
    behind = np.zeros(len(blocks), np.int64)
    vectors = vectors.copy()
    for r in range(int(count.max(initial=0))):
        on = np.flatnonzero(count > r)
        at = offsets[on + 1] - 1 - r
        behind[at] = vectors[on, 0]
        vectors[on] = t.block[vectors[on], code[at][:, None]]
    return vectors, behind


def trace(blocks: np.ndarray, offsets: np.ndarray, behind: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per symbol (flat, pads included) the inserts before it, its edit's letter and the state
    before it; and the states after the segments. Blocks are expanded by single steps."""
    t, count = tables(), np.diff(offsets)
    inserts, letters, came = (np.zeros(blocks.shape, np.int64) for _ in range(3))
    after = np.zeros((len(blocks), BLOCK), np.int64)
    held = behind
    for k in range(BLOCK - 1, -1, -1):
        after[:, k] = held
        held = t.step[held, blocks[:, k]]
    states = states.copy()
    for r in range(int(count.max(initial=0))):
        on = np.flatnonzero(count > r)
        at = offsets[on] + r
        for k in range(BLOCK):
            where = after[at, k], blocks[at, k], states[on]
            came[at, k], inserts[at, k], letters[at, k] = states[on], t.inserts[where], t.edit[where]
            states[on] = t.leave[where]
    return inserts, letters, came, states


KEY = ["known", "conv", "segment"]
KEY_SCHEMA = "known boolean, conv long, segment long"


def _slices(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 2048):
            yield batch.slice(i, 2048)


def vector_functions(segments: DataFrame) -> DataFrame:
    """Per segment, ``ahead``: the vector in front of it for every vector behind it."""
    def run(batches):
        for batch in _slices(batches):
            blocks, offsets, _ = _codes(batch.column("symbols"))
            all_ = np.tile(np.arange(len(tables().vectors)), (batch.num_rows, 1))
            ahead, _ = look_up(blocks, offsets, all_)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEY), pa.array(ahead.tolist(), pa.list_(pa.int64()))], [*KEY, "links"])
    return segments.select(*KEY, "symbols").mapInArrow(run, f"{KEY_SCHEMA}, links array<long>")


def state_functions(segments: DataFrame) -> DataFrame:
    """Per segment (with the vector behind it) the state after it for each state before it."""
    def run(batches):
        for batch in _slices(batches):
            blocks, offsets, _ = _codes(batch.column("symbols"))
            _, behind = look_up(blocks, offsets, batch.column("vector").to_numpy()[:, None])
            out = [trace(blocks, offsets, behind, np.full(batch.num_rows, q))[3] for q in range(4)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEY), pa.array(np.stack(out, 1).tolist(), pa.list_(pa.int64()))], [*KEY, "links"])
    return segments.select(*KEY, "symbols", "vector").mapInArrow(run, f"{KEY_SCHEMA}, links array<long>")


def chained(functions: DataFrame, name: str, first: int, backward: bool) -> DataFrame:
    """What enters each segment when its conversation's functions are applied in order from
    ``first``. A task streams through its conversations' segments and holds one number."""
    def run(batches):
        held, value = None, first
        for batch in batches:
            entered = []
            for known, conv, links in zip(*(batch.column(c).to_pylist() for c in ("known", "conv", "links"))):
                if (known, conv) != held:
                    held, value = (known, conv), first
                entered.append(value)
                value = links[value]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEY), pa.array(entered, pa.int64())], [*KEY, name])
    order = F.col("segment").desc() if backward else F.col("segment")
    return (functions.repartition("known", "conv").sortWithinPartitions("known", "conv", order)
            .mapInArrow(run, f"{KEY_SCHEMA}, {name} long"))


def edited(segments: DataFrame) -> DataFrame:
    """Per segment: ``audit`` (letters), ``cost``, and per row ``edits`` (letter, before, role,
    after): lines inserted before it, its new role if it has one, lines after the last row."""
    def run(batches):
        for batch in _slices(batches):
            blocks, offsets, rows = _codes(batch.column("symbols"))
            _, behind = look_up(blocks, offsets, batch.column("vector").to_numpy()[:, None])
            inserts, letters, came, left = trace(blocks, offsets, behind, batch.column("state").to_numpy())
            last = batch.column("last").to_pylist()
            audits, costs, edits = [], [], []
            for i in range(batch.num_rows):
                here = slice(int(offsets[i]) * BLOCK, int(offsets[i]) * BLOCK + int(rows[i]))
                audit, cost, row_edits = [], 0, []
                for symbol, n, letter, q in zip(*(x.reshape(-1)[here].tolist() for x in (blocks, inserts, letters, came))):
                    lines, q = inserted_lines(q, n)
                    letter = chr(letter)
                    audit.append("I" * n + letter)
                    cost += INSERT * n + {"D": DELETE, "K": 0, "R": REROLE}[letter] + (PENALTY if letter != "D" and TRUNCATED <= symbol < DROP else 0)
                    row_edits.append({"letter": letter, "before": "\n".join(lines) if lines else None,
                                      "role": ROLE[int(NEXT[q])] if letter == "R" else None, "after": None})
                if last[i]:
                    more = final_inserts(int(left[i]))
                    lines, _ = inserted_lines(int(left[i]), more)
                    audit.append("I" * more)
                    cost += INSERT * more
                    row_edits[-1]["after"] = "\n".join(lines) if lines else None
                audits.append("".join(audit))
                costs.append(cost)
                edits.append(row_edits)
            item = pa.struct([(n, pa.string()) for n in ("letter", "before", "role", "after")])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEY), pa.array(audits, pa.string()), pa.array(costs, pa.int64()),
                                              pa.array(edits, pa.list_(item))], [*KEY, "audit", "cost", "edits"])
    return segments.select(*KEY, "symbols", "vector", "state", "last").mapInArrow(
        run, f"{KEY_SCHEMA}, audit string, cost long, edits array<struct<letter: string, before: string, role: string, after: string>>")


def digested(lines: DataFrame) -> DataFrame:
    """(known, conv, illegal, repaired_sha256) from rows (known, conv, pos, initial, lines)."""
    def run(batches):
        import hashlib
        held, state, started, illegal, before = None, None, False, 0, None

        def done():
            return held[0], held[1], illegal, state.hexdigest()
        for batch in batches:
            out = []
            for known, conv, initial, text in zip(*(batch.column(c).to_pylist() for c in ("known", "conv", "initial", "lines"))):
                if (known, conv) != held:
                    if held is not None:
                        out.append(done())
                    held, state, started, illegal, before = (known, conv), hashlib.sha256(), False, 0, None
                if before is not None and before + initial not in ("su", "ua", "au"):
                    illegal += 1
                before = initial
                if text is not None:
                    state.update((b"\n" if started else b"") + text.encode())
                    started = True
            if out:
                yield rows(out)
        if held is not None:
            yield rows([done()])

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.bool_(), pa.int64(), pa.int64(), pa.string()))],
                                          ["known", "conv", "illegal", "repaired_sha256"])
    return (lines.repartition("known", "conv").sortWithinPartitions("known", "conv", "pos").select("known", "conv", "initial", "lines")
            .mapInArrow(run, "known boolean, conv long, illegal long, repaired_sha256 string"))


# --- the operator ----------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, decided by CRC-32 of ``conv_id:turn`` modulo 20 (nulls count as one
    space): 0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it a user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                                 text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault")).where("fault <> 0")
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy"))


def marked(rows: DataFrame, label: str = "repair") -> DataFrame:
    """``rows`` (conv_id, turn, role, text) in order, written: known, conv, pos, n, turn, role,
    text, initial, fault (blank, duplicate, truncated or null: its first one) and symbol."""
    space = F.lit(" ")
    keyed = rows.select(F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv"),
                        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), space).alias("role"),
                        F.coalesce(F.col("text"), space).alias("text"))
    said = F.md5(F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text")))
    ordered = materialize(placed(keyed, ["known", "conv"], label).withColumn("said", said), label)
    again = (ordered.groupBy("known", "conv", "said").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"))
    met = skew.join_unique(ordered, materialize(again, label), ["known", "conv", "said"], "times")
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = (F.when(last == "", "blank").when(F.col("pos") > F.col("first"), "duplicate")
             .when(~last.isin(".", "!", "?"), "truncated"))
    initial = F.substring("role", 1, 1)
    role = functools.reduce(lambda w, x: w.when(initial == x[0], x[1]), INITIALS.items(), F.when(F.lit(False), START)).otherwise(START)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), DROP).otherwise(role + F.when(F.col("fault") == "truncated", TRUNCATED).otherwise(0))
    return materialize(met.withColumn("fault", fault).withColumn("initial", initial).withColumn("symbol", symbol.cast("long"))
                       .drop("first", "said"), label)


def segment_edits(rows: DataFrame, label: str = "repair") -> DataFrame:
    """:func:`edited` over the segments of marked rows, written."""
    cut = (rows.groupBy("known", "conv", F.expr(f"(pos - 1) div {SEGMENT}").alias("segment"))
           .agg(F.array_sort(F.collect_list(F.struct("pos", "symbol"))).alias("s"), F.max("n").alias("n")))
    cut = cut.select(*KEY, F.col("s.symbol").alias("symbols"), ((F.col("segment") + 1) * SEGMENT >= F.col("n")).alias("last"), "n")
    cut = materialize(cut, label)
    start = F.lit(0).cast("long")
    short = cut.where(F.col("n") <= SEGMENT).select(*KEY, "symbols", start.alias("vector"), start.alias("state"), "last")
    long_ = cut.where(F.col("n") > SEGMENT)
    long_ = materialize(long_.join(chained(vector_functions(long_), "vector", 0, backward=True), KEY), label)
    long_ = long_.join(chained(state_functions(long_), "state", START, backward=False), KEY)
    return materialize(edited(short.unionByName(long_.select(*short.columns))), label)


def edited_rows(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Marked rows with their edits: letter, before, new_role, after."""
    each = segments.select("known", "conv", "segment", F.posexplode("edits").alias("i", "e")).select(
        "known", "conv", (F.col("segment") * SEGMENT + F.col("i") + 1).alias("pos"), F.col("e.letter").alias("letter"),
        F.col("e.before").alias("before"), F.col("e.role").alias("new_role"), F.col("e.after").alias("after"))
    return rows.join(each, ["known", "conv", "pos"])


def repair(rows: DataFrame, label: str = "repair") -> tuple[DataFrame, DataFrame]:
    """(summary, repaired lines) of rows (conv_id, turn, role, text).

    The summary has one row per conversation that has rows: see :func:`repair_summary`. The
    lines are (conv_id, pos, lines): per row of the input, in order of ``pos``, the repaired
    ``role:text`` lines that stand at its place, null if none.
    """
    rows = marked(rows, label)
    segments = segment_edits(rows, label)
    own = F.when(F.col("letter") == "K", F.concat_ws(":", "role", "text")).when(F.col("letter") == "R", F.concat_ws(":", "new_role", "text"))
    parts = F.filter(F.array("before", own, "after"), lambda x: x.isNotNull())
    lines = materialize(edited_rows(rows, segments).select(
        "known", "conv", "pos", "initial", F.when(F.size(parts) > 0, F.array_join(parts, "\n")).alias("lines")), label)
    turns = (rows.where("turn is not null").groupBy("known", "conv", "turn").agg(F.lit(1)).groupBy("known", "conv")
             .agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps")))
    faults = rows.groupBy("known", "conv").agg(*(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")))
    joined = segments.groupBy("known", "conv").agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    key = ["known", "conv"]
    summary = faults.join(turns, key, "left").join(joined, key).join(digested(lines), key)
    conv = F.when(F.col("known"), F.col("conv")).alias("conv_id")
    return (summary.select(conv, F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                           "cost", "audit", "repaired_sha256"), lines.select(conv, "pos", "lines"))


def repair_summary(conversations: DataFrame, damage: bool = False, label: str = "repair") -> DataFrame:
    """One row per conv_id: gaps (turn numbers missing between the least and the largest),
    blank, duplicate, truncated (rows by their first fault), illegal (adjacent role initials
    other than su, ua, au), cost, audit (letters of the cheapest edits in order, ties by
    ASCII), repaired_sha256 (of the repaired ``role:text`` lines, newline-joined).

    Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only one for blank and
    duplicate rows), Insert an empty user or assistant turn 2; a truncated row that stays
    costs 1 more. Rows are ordered by turn (null first), then role and text; a null role or
    text counts as one space; a null conv_id is a conversation of its own. With ``damage``
    rows are first damaged (:func:`damaged`); conversations left without rows get zeros, an
    empty audit and the empty string's digest. Other columns are not read; an empty table
    gives no rows.
    """
    summary, _ = repair(damaged(conversations) if damage else conversations, label)
    if not damage:
        return summary
    everyone = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.lit(1).alias("seen"))
    zero = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return (everyone.alias("e").join(summary.alias("s"), F.col("e.conv_id").eqNullSafe(F.col("s.conv_id")), "left")
            .select("e.conv_id", *(F.coalesce(F.col(f"s.{c}"), v).alias(c) for c, v in (zero | empty).items())))


def _sql_walk() -> str:
    """One step of the recursion: per state the least (cost, audit, lines) as a struct."""
    def put(cost, letter, line, state):
        return f"{{'c': {cost} + {state}.c, 'a': '{letter}' || {state}.a, 't': {line} || {state}.t}}"

    def insert(state, role):
        return put(2, "I", f"'{role}:' || chr(10)", state)
    nothing, own, new = "''", "role || ':' || text || chr(10)", "'{}:' || text || chr(10)"
    live = "(CASE WHEN gone THEN 1000000 WHEN cut THEN 1 ELSE 0 END)"
    follow = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    row = []
    for q, (to, role) in follow.items():
        keep = f"CASE WHEN i = '{role[0]}' THEN {live} ELSE 1000000 END"
        options = [put(3, "D", nothing, f"w{q}"), put(f"({keep})", "K", own, f"w{to}"), put(f"(2 + {live})", "R", new.format(role), f"w{to}")]
        if q == 0:
            options.append(put(f"(CASE WHEN i = 's' THEN {live} ELSE 1000000 END)", "K", own, "w1"))
        row.append(f"least({', '.join(options)}) AS x{q}")
    return f"""SELECT conv, k, least(x0, {insert('y2', 'user')}) AS w0, least(x1, {insert('y2', 'user')}) AS w1, y2 AS w2, y3 AS w3 FROM (
      SELECT *, least(x2, {insert('x3', 'assistant')}) AS y2, least(x3, {insert('x2', 'user')}) AS y3 FROM (
        SELECT w.conv, w.k - 1 AS k, {', '.join(row)}
        FROM walk w JOIN f ON f.conv = w.conv AND f.k = w.k - 1) x) y"""


#: DuckDB statement for :func:`repair_summary` over ``conversations`` with ``damage``; CRC-32 is spelled out
SQL = f"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
x AS (SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) % 20 AS fault
  FROM conversations, crc),
d AS (SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy FROM x WHERE fault <> 0),
o AS (SELECT *, left(role, 1) AS i, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS k,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 AS again,
    lag(i) OVER (PARTITION BY conv ORDER BY k) || i AS pair FROM o),
f AS (SELECT *, said = '' AS blank, said <> '' AND again AS twice, said = '' OR again AS gone,
    said <> '' AND NOT again AND right(said, 1) NOT IN ('.', '!', '?') AS cut FROM p),
walk AS (
  SELECT conv, max(k) + 1 AS k, {{'c': 0, 'a': '', 't': ''}} AS w0, {{'c': 4, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS w1,
    {{'c': 2, 'a': 'I', 't': 'assistant:' || chr(10)}} AS w2, {{'c': 0, 'a': '', 't': ''}} AS w3 FROM f GROUP BY conv
  UNION ALL {_sql_walk()}),
s AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (twice) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv),
e AS (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv FROM conversations)
SELECT CAST(e.conv_id AS BIGINT) AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w0.c, 0) AS BIGINT) AS cost, coalesce(w0.a, '') AS audit,
  sha256(coalesce(left(w0.t, length(w0.t) - 1), '')) AS repaired_sha256
FROM e LEFT JOIN s USING (conv) LEFT JOIN walk ON walk.conv = e.conv AND walk.k = 1
"""
