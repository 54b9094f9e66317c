"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles; two link when 100 * |A and B| >= threshold_pct *
|A or B|. Equal sets collapse to one node first. Similar nodes are partitioned into groups;
the token-group matrix holds, for each group, the union of its members' tokens. A node asks
only groups with which it shares a token of its prefix, and a group is opened (its members
compared exactly) only if |query and union| leaves the threshold within reach for the
group's sizes. The result is exact: every link between different sets is found or is
already implied by links found before.

Shape of the job, for millions of near copies as well as for none:

1. One pass writes each row's set size and digest, and counts tokens in a fixed number of
   hash buckets; the most frequent buckets (a bounded table) order tokens from rare to
   frequent, which only steers the work. Equal sets collapse to one node.
2. One pass writes each node's prefix: its first n - need + l tokens in that order. Two
   linked sets share at least l tokens of their prefixes, so a node fewer of whose tokens
   occur in any other prefix is done; that is the bound against the union of all groups.
3. The other nodes' sets are written once. First partition: groups by min-hash, in chunks of
   bounded size with the family's most common member in each chunk; a task links its chunk.
4. Second partition: families of components. A node queries groups with which it shares l
   prefix tokens: of two groups the smaller one asks, and inside a group all but its largest
   component. For groups of several chunks the bound is first taken against the union of the
   whole group, as counts; what passes opens the chunks, which bound and then compare. Hot
   groups are split by members and by queries: no task holds more than chunk x block sets.
5. Components of all links.

Texts are never shuffled: passes choose rows by a bitmap of hashed ids of fixed size; where
it is crowded more rows pass, and exact joins on narrow rows decide.

64-bit tokens stand for shingles; a set's digest has 128 bits. (With 10**12 distinct
shingles, two of one document would meet by chance with a probability near 10**-8.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches, materialize
from . import skew
from . import textbytes as tb
from .graph import components

BUCKETS = 1 << 22      # of the frequency table
FREQUENT = 1 << 18     # most buckets that count as frequent (bounds the broadcast)
CHUNK = 64             # members of a group that one task opens
BLOCK = 512            # queries that one task asks of a chunk
UNION = 1 << 15        # tokens of a large group's union in one bucket, about
UNITED = 1 << 20       # tokens of families' unions that a task holds, about
BITS = 1 << 26         # of a bitmap of ids (8 MB)
SMALL_ROWS = 1_000_000  # narrow rows that may be broadcast to the sets (some 40 MB)
CANDIDATE = np.uint64((1 << 48) - 1)  # prefixes carry 48 bits of a token; sets carry all


def need(n, pct: int):
    """Fewest tokens that a set of n shares with a linked set (numpy or Column)."""
    return F.ceil(n * pct / 100).cast("long") if isinstance(n, Column) else (pct * n + 99) // 100


def shared_prefix(n, pct: int, share: int):
    """l: how many tokens the prefixes of two linked sets share at least, if n is the size
    of the smaller one: one in ``share`` of them. It does not fall with n."""
    if isinstance(n, Column):
        return F.least(need(n, pct), F.floor(n / share) + 1)
    return np.minimum(need(n, pct), n // share + 1)


def prefix_length(n: np.ndarray, pct: int, share: int) -> np.ndarray:
    """A set's prefix must miss at most the tokens that a linked set may lack, and show l."""
    return n - need(n, pct) + shared_prefix(n, pct, share)


def row_sets(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle tokens of each row, end to end, and their offsets."""
    data = tb.LOWER[data]
    starts, ends, rows = tb.word_spans(data, bounds, tb.NON_SPACE)
    return tb.shingles(tb.word_hashes(data, starts, ends), tb.row_starts(rows, len(bounds) - 1), k)


ROW, COUNT = 0, 1  # kinds of rows of the first pass


def first_pass(docs: DataFrame, k: int) -> DataFrame:
    """Rows of kind ROW: doc_id, n (set size), digest d1, d2, min-hash. Rows of kind COUNT:
    a hash bucket in doc_id that at least 4 sets of a task use, and their number in n."""
    def sign(batches):
        used = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            for i, j, data, bounds in tb.text_blocks(batch.column(1), tb.BLOCK_BYTES // 2):
                tokens, at = row_sets(data, bounds, k)
                n = np.diff(at)
                at_bucket, times = np.unique(tokens & np.uint64(BUCKETS - 1), return_counts=True)
                used[at_bucket.astype(np.int64)] += times.astype(np.int32)
                least = np.zeros(j - i, np.uint64)
                if len(tokens):
                    least[n > 0] = np.minimum.reduceat(tb.mix(tokens ^ np.uint64(13)), at[:-1][n > 0])
                yield _pass_batch(ROW, batch.column(0).slice(i, j - i), n, *digests(tokens, at), least)
        most = np.flatnonzero(used >= max(4, 4 * used.mean()))
        none = np.zeros(len(most), np.uint64)
        yield _pass_batch(COUNT, pa.array(most), used[most].astype(np.int64), none, none, none)
    return docs.mapInArrow(sign, "kind int, doc_id long, n long, d1 long, d2 long, least long")


def _pass_batch(kind: int, ids: pa.Array, n: np.ndarray, *unsigned: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), kind, np.int32)), ids, pa.array(n), *(_signed(x) for x in unsigned)],
        ["kind", "doc_id", "n", "d1", "d2", "least"])


def digests(tokens: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set, independent of order."""
    out = []
    for seed in (11, 12):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tb.mix(tokens ^ np.uint64(seed)), dtype=np.uint64)])
        out.append(total[at[1:]] - total[at[:-1]])
    return out


def frequent_buckets(passed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(buckets in order, level): at most FREQUENT hash buckets that most sets use."""
    counted = passed.where(F.col("kind") == COUNT).groupBy(F.col("doc_id").alias("bucket")).agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "bucket").limit(FREQUENT).toPandas().sort_values("bucket")
    return top["bucket"].to_numpy(np.int64), np.log2(np.maximum(top["n"].to_numpy(np.float64), 1)).astype(np.int64)


def hashed_id(col: Column) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(BITS)) + 1


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """Bits of the hashed ids of a frame with one column, as bytes (BITS / 8 of them)."""
    at = hashed_id(F.col(ids.columns[0]))
    found = ids.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    width = 4096  # bytes of one of Spark's bitmaps
    out = np.zeros(max(BITS // 8, width), np.uint8)
    for r in found.collect():  # at most BITS / 32768 rows, by one job whatever the partitions
        out[(r["k"] - 1) * width:r["k"] * width] = np.frombuffer(r["bits"], np.uint8)
    return out


def in_bitmap(bits: np.ndarray, hashed: pa.Array) -> np.ndarray:
    at = hashed.to_numpy() - 1
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def rare_first(tokens: np.ndarray, rows: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Order of the tokens of each row: by frequency level, then by value. Any order that is
    the same for all sets is right; this one keeps frequent tokens out of the prefixes."""
    buckets, level = frequent
    mine = np.zeros(len(tokens), np.int64)
    if len(buckets):
        bucket = (tokens & np.uint64(BUCKETS - 1)).astype(np.int64)
        at = np.minimum(np.searchsorted(buckets, bucket), len(buckets) - 1)
        mine = np.where(buckets[at] == bucket, level[at], 0)
    return np.lexsort((tokens, mine, rows))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def prefixes(docs: DataFrame, k: int, pct: int, share: int, frequent, copies: np.ndarray) -> DataFrame:
    """Per row with an id and a set: doc_id, its digest, ``prefix`` (48 bits of each token)
    and ``copy``: the id may be one whose set another row stands for."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, copies))

    def make(batches):
        frequent, copies = shared.value
        for batch in batches:
            copy = in_bitmap(copies, batch.column(2))
            for i, j, data, bounds in tb.text_blocks(batch.column(1), tb.BLOCK_BYTES // 2):
                tokens, at = row_sets(data, bounds, k)
                n = np.diff(at)
                rows = np.repeat(np.arange(j - i), n)
                size = np.where(n > 0, prefix_length(n, pct, share), 0)
                place = np.arange(len(tokens)) - at[:-1][rows]
                first = tokens[rare_first(tokens, rows, frequent)][place < size[rows]] & CANDIDATE
                d1, d2 = digests(tokens, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), _signed(d1), _signed(d2), pa.array(copy[i:j]),
                     tb.list_array(first.view(np.int64), np.concatenate([[0], np.cumsum(size)]))],
                    ["doc_id", "d1", "d2", "copy", "prefix"])
    schema = "doc_id long, d1 long, d2 long, copy boolean, prefix array<long>"
    return docs.where("doc_id is not null").withColumn("_at", hashed_id(F.col("doc_id"))).mapInArrow(make, schema).where(F.size("prefix") > 0)


def shared_tokens(posted: DataFrame) -> DataFrame:
    """Of (token, nid), without repeats, those whose token another nid has too. One shuffle
    by token; a task streams through its tokens in order and holds one row."""
    def only(batches):
        t0, n0, emitted = None, None, False  # the last pair, and whether it is out already
        for batch in batches:
            if not batch.num_rows:
                continue
            t, n = (batch.column(c).to_numpy() for c in (0, 1))
            if t0 is not None:
                t, n = np.append(t0, t), np.append(n0, n)
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (n[1:] != n[:-1])
            t, n = t[new], n[new]
            same = t[1:] == t[:-1]
            out = np.append(same, False) | np.append(False, same)
            was, emitted = emitted, bool(out[-1]) or (emitted and len(t) == 1)
            if was:
                out[0] = False
            yield pa.RecordBatch.from_arrays([pa.array(t[out]), pa.array(n[out])], ["token", "nid"])
            t0, n0 = t[-1:], n[-1:]
    return posted.repartition("token").sortWithinPartitions("token", "nid").mapInArrow(only, "token long, nid long")


def full_sets(docs: DataFrame, k: int, wanted: np.ndarray) -> DataFrame:
    """(nid, tokens) of the rows whose id is in the bitmap (and of some others)."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def make(batches):
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(shared.value, batch.column(2))))
            for i, j, data, bounds in tb.text_blocks(batch.column(1), tb.BLOCK_BYTES // 2):
                tokens, at = row_sets(data, bounds, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), tb.list_array(tokens.view(np.int64), at)], ["nid", "tokens"])
    return docs.where("doc_id is not null").withColumn("_at", hashed_id(F.col("doc_id"))).mapInArrow(make, "nid long, tokens array<long>")


# --- inside one task: a chunk of members, and the sets that ask it -------------------------

class Chunk:
    """Members of a group: their sets end to end, and the union of their tokens (sorted)
    with, for each union token, the members that have it."""

    def __init__(self, tokens: np.ndarray, offsets: np.ndarray):
        self.sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        self.owner = owner[order]
        first = np.ones(len(ordered), bool)
        first[1:] = ordered[1:] != ordered[:-1]
        self.union = ordered[first]
        self.at = np.append(np.flatnonzero(first), len(ordered))
        self.smallest = int(self.sizes.min()) if len(self.sizes) else 0

    def ask(self, query: np.ndarray, pct: int) -> np.ndarray:
        """Members that link with the query set; empty at once if the bound forbids it."""
        if not len(self.union) or not len(query):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        at = at[self.union[at] == query]
        bound, n = len(at), len(query)
        # a member shares at most `bound` tokens and has at least max(smallest, shared) ones
        if 100 * bound < pct * (n + max(self.smallest, bound) - bound):
            return np.zeros(0, np.int64)
        number = self.at[at + 1] - self.at[at]
        flat = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number) + np.repeat(self.at[at], number)
        common = np.bincount(self.owner[flat], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= pct * (n + self.sizes - common))


def _sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node ids, flat tokens and offsets of the rows of a table with nid and tokens."""
    ids = table.column("nid").to_numpy()
    column = table.column("tokens").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    offsets = column.offsets.to_numpy()
    return ids, column.values.to_numpy()[offsets[0]:offsets[-1]], offsets - offsets[0]


def link_chunks(pct: int):
    """Tasks of the first partition: links inside each chunk (rows in order of the key)."""
    def link(batches):
        for table in tb.groups(batches, ["least", "part"]):
            ids, tokens, offsets = _sets(table)
            chunk = Chunk(tokens, offsets)
            low = np.arange(len(ids))

            def root(x):
                while low[x] != x:
                    low[x] = low[low[x]]
                    x = low[x]
                return x
            for q in range(len(ids)):
                if len(ids) > 1:
                    for m in chunk.ask(tokens[offsets[q]:offsets[q + 1]], pct).tolist():
                        a, b = root(q), root(m)
                        if a != b:
                            low[max(a, b)] = min(a, b)
            roots = np.array([root(x) for x in range(len(ids))])
            moved = np.flatnonzero(ids != ids[roots])
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[roots[moved]])], ["a", "b"])
    return link


def ask_chunks(pct: int):
    """Tasks of the second partition: for each query set, one link to each other component
    that it reaches in the chunk."""
    def ask(batches):
        for table in tb.groups(batches, ["family", "part", "block"]):
            asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            members, queries = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
            if not members.num_rows or not queries.num_rows:
                continue
            ids, tokens, offsets = _sets(members)
            inside = members.column("component").to_numpy()
            chunk = Chunk(tokens, offsets)
            q_ids, q_tokens, q_offsets = _sets(queries)
            q_inside = queries.column("component").to_numpy()
            a, b = [], []
            for q in range(len(q_ids)):
                got = chunk.ask(q_tokens[q_offsets[q]:q_offsets[q + 1]], pct)
                got = got[inside[got] != q_inside[q]]
                if len(got):
                    first = got[np.unique(inside[got], return_index=True)[1]]
                    a += [int(q_ids[q])] * len(first)
                    b += ids[first].tolist()
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return ask


def reach_of_union(pct: int):
    """Tasks of the bound against whole groups: a row with tokens of the union and, per query,
    how many of its tokens are among them (in its own family only those of other members)."""
    def ask(batches):
        for table in tb.groups(batches, ["family", "bucket", "block"]):
            asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            union, queries = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
            if not union.num_rows or not queries.num_rows:
                continue
            _, tokens, _ = _sets(union)
            order = np.argsort(tokens)
            tokens, several = tokens[order], np.concatenate([np.asarray(x) for x in union.column("several").to_pylist()])[order]
            ids, asked, at = _sets(queries)
            place = np.minimum(np.searchsorted(tokens, asked), len(tokens) - 1)
            own = np.repeat(queries.column("own").to_numpy(zero_copy_only=False).astype(bool), np.diff(at))
            met = np.concatenate([[0], np.cumsum((tokens[place] == asked) & (several[place] | ~own))])
            yield pa.RecordBatch.from_arrays([pa.array(ids), queries.column("family").combine_chunks(), pa.array(met[at[1:]] - met[at[:-1]])],
                                             ["nid", "family", "o"])
    return ask


def partial_unions(batches):
    """(family, token, times) of rows (family, tokens): each token of a family once a task, or
    once per UNITED of them, so that the many equal tokens of near copies never become rows."""
    names = ["family", "token", "times"]
    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        tokens = batch.column(1)
        offsets = tokens.offsets.to_numpy()
        flat = tokens.values.to_numpy()[offsets[0]:offsets[-1]]
        family = np.repeat(batch.column(0).to_numpy(), np.diff(offsets))
        held = united(*(np.concatenate(x) for x in zip(held, (family, flat, np.ones(len(flat), np.int64)))))
        del batch, tokens, offsets, flat, family
        if len(held[0]) > UNITED:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)
            held = [np.zeros(0, np.int64)] * 3
        tb.release_memory()
    if len(held[0]):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)


def united(family: np.ndarray, token: np.ndarray, times: np.ndarray) -> list[np.ndarray]:
    """Each (family, token) once, in order, with the sum of its times."""
    order = np.lexsort((token, family))
    family, token = family[order], token[order]
    first = np.ones(len(token), bool)
    first[1:] = (token[1:] != token[:-1]) | (family[1:] != family[:-1])
    at = np.flatnonzero(first)
    return [family[at], token[at], np.add.reduceat(times[order], at) if len(at) else times]


def within_reach(asked: DataFrame, members: DataFrame, sets: DataFrame, pct: int, label: str) -> DataFrame:
    """Of queries (nid, n, home, family) those that the token counts of a whole family leave
    in reach: |query and union| tokens at most can be common with a member, which has at
    least need(n) and the family's least tokens. In its own family a query's tokens count
    only if another member has them.

    A family's union is stored in buckets of about UNION tokens, by token; a query sends one
    part of its set to each bucket, and a task asks one bucket for BLOCK queries."""
    inside = placed_sets(members, sets, label)
    union = materialize(inside.select("family", "tokens").mapInArrow(partial_unions, "family long, token long, times long")
                        .groupBy("family", "token").agg((F.sum("times") > 1).alias("several")), label)
    size = union.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / UNION).cast("long").alias("buckets"))
    load = asked.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    shape = materialize(size.join(load, "family"), label)
    zero, bucket = F.lit(0).cast("long"), F.pmod(F.col("token"), F.col("buckets"))
    stored = (union.join(shape, "family").groupBy("family", bucket.alias("bucket"), "blocks")
              .agg(F.collect_list("token").alias("tokens"), F.collect_list("several").alias("several"))
              .select(zero.alias("nid"), "tokens", "several", "family", "bucket", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"),
                      F.lit(0).alias("asks"), F.lit(False).alias("own")))
    to = (asked.join(shape, "family")
          .select("nid", "family", "buckets", F.explode(F.sequence(zero, F.col("buckets") - 1)).alias("bucket"),
                  F.pmod(F.xxhash64("nid", F.lit(2)), F.col("blocks")).alias("block"), (F.col("home") == F.col("family")).alias("own")))
    part = F.when(F.col("buckets") == 1, F.col("tokens")).otherwise(F.filter("tokens", lambda x: F.pmod(x, F.col("buckets")) == F.col("bucket")))
    sent = (placed_sets(to, sets, label)
            .select("nid", part.alias("tokens"), F.array().cast("array<boolean>").alias("several"), "family", "bucket", "block", F.lit(1).alias("asks"), "own"))
    met = (_in_order(stored.union(sent), ["family", "bucket", "block"]).mapInArrow(reach_of_union(pct), "nid long, family long, o long")
           .groupBy("nid", "family").agg(F.sum("o").alias("o")))
    least = inside.groupBy("family").agg(F.min(F.size("tokens")).alias("least_size"))
    held = asked.join(met, ["nid", "family"]).join(least, "family")
    size = F.greatest(need(F.col("n"), pct), F.col("least_size"), F.col("o"))
    return held.where(100 * F.col("o") >= pct * (F.col("n") + size - F.col("o"))).select("nid", "n", "home", "family")


def placed_sets(places: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """Sets with the places (narrow rows by nid) that they are sent to. The places are
    written and counted: up to SMALL_ROWS of them are broadcast, so the sets move once, to
    their places; more are joined by a shuffle of both."""
    places = materialize(places, label)
    return sets.join(F.broadcast(places) if places.count() <= SMALL_ROWS else places, "nid")


def _in_order(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def similar_components(docs: DataFrame, k: int = 5, threshold_pct: int = 80, id_col: str = "doc_id",
                       text_col: str = "text", label: str = "jaccard", share: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id that links
    reach, itself included).

    Words are maximal runs of non-white-space, A-Z lower-cased; a text of 1 to k - 1 words
    has its whole sequence as its one shingle. Null and empty texts have no shingles and
    link with nothing. An id should name one text: if rows with different texts share an id,
    links of any of them may join their components. A row with a null id takes part in no
    component and gets a null one. Other columns are not read; an empty table gives no rows.

    ``share`` (see :func:`shared_prefix`) trades longer prefixes for fewer nodes that pass by
    chance; it never changes results. Short shingles meet by chance more often, so they show
    more by default.
    """
    bound_batches(docs.sparkSession)
    pct = threshold_pct
    share = share or (20 if k >= 5 else 10)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    passed = materialize(first_pass(docs, k), label)
    rows = passed.where(F.col("kind") == ROW).drop("kind")
    digest = ["d1", "d2", "n"]
    nodes = materialize(rows.where("n > 0 and doc_id is not null").groupBy(*digest)
                        .agg(F.min("doc_id").alias("nid"), F.max("doc_id").alias("last"), F.min("least").alias("least"),
                             F.count(F.lit(1)).alias("times")), label)
    filled = rows.where("n > 0 and doc_id is not null")
    copied = nodes.where("nid < last").select(*digest, "nid", "times")
    copies = skew.join_unique(filled, copied, digest, "times").where("doc_id > nid").select("doc_id").distinct()
    ahead = prefixes(docs, k, pct, share, frequent_buckets(passed), id_bitmap(copies))
    ahead = materialize(ahead, label)
    # rows that may be copies are looked up; all others are their sets' nodes
    looked = ahead.where("copy").join(nodes.select("d1", "d2", F.col("nid").alias("doc_id")), ["doc_id", "d1", "d2"], "left_semi")
    posted = ahead.where("not copy").select("doc_id", "prefix").union(looked.select("doc_id", "prefix"))
    shared = shared_tokens(posted.select(F.explode("prefix").alias("token"), F.col("doc_id").alias("nid")))
    enough = F.col("common") >= shared_prefix(need(F.col("n"), pct), pct, share)
    for _ in range(2):  # a node that falls away may leave others below the bound
        shared = materialize(shared, label)
        active = (shared.groupBy("nid").agg(F.count(F.lit(1)).alias("common"))
                  .join(nodes.select("nid", "least", "n"), "nid").where(enough))
        shared = shared_tokens(shared.join(active.select("nid").distinct(), "nid", "left_semi").select("token", "nid"))
    shared, active = materialize(shared, label), materialize(active, label)

    # first partition: chunks of one min-hash family, each with the family's commonest node
    rarest = F.col("n") - need(F.col("n"), pct) + shared_prefix(F.col("n"), pct, share) - F.col("common")
    family = active.groupBy("least").agg(F.count(F.lit(1)).alias("members"),
                                         F.min(F.struct(rarest.alias("r"), F.col("nid"))).alias("hub"))
    parts = F.ceil(F.col("members") / CHUNK).cast("long")
    plan = (active.join(family.where("members > 1"), "least", "left")
            .select("nid", "least", F.coalesce("members", F.lit(1)).alias("members"), F.col("hub.nid").alias("hub")))
    sets = materialize(full_sets(docs, k, id_bitmap(active.select("nid"))), label)
    placed = (plan.where("members > 1").withColumn("parts", parts)
              .withColumn("part", F.when(F.col("nid") == F.col("hub"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
                          .otherwise(F.array(F.pmod(F.xxhash64("nid"), F.col("parts")))))
              .select("nid", "least", F.explode("part").alias("part")))
    chunks = _in_order(placed_sets(placed, sets, label), ["least", "part"])
    first = components(chunks.mapInArrow(link_chunks(pct), "a long, b long"), label)

    # second partition: families of components (home: a node's own family)
    of = (active.groupBy("nid").agg(F.min("least").alias("least"), F.max("n").alias("n"))
          .join(first.withColumnRenamed("node", "nid"), "nid", "left")
          .select("nid", "n", "least", F.coalesce("component", "nid").alias("component")))
    whole = of.groupBy("component").agg(F.min("least").alias("home"), F.count(F.lit(1)).alias("size"))
    homes = whole.groupBy("home").agg(F.sum("size").alias("members"), F.max(F.struct("size", "component")).alias("largest"))
    of = materialize(of.join(whole, "component").join(homes, "home").select(
        "nid", "n", "component", "home", "members", (F.col("component") == F.col("largest.component")).alias("main")), label)
    tagged = shared.join(of, "nid")
    matrix = tagged.groupBy("token", F.col("home").alias("family"), "members").agg(
        F.count(F.lit(1)).alias("nodes"), F.min("n").alias("n_min"), F.max("n").alias("n_max"))
    q, g = tagged.alias("q"), matrix.alias("g")
    inside = (F.col("q.home") == F.col("g.family")) & ~F.col("q.main") & (F.col("g.nodes") > 1)
    smaller = (F.col("q.home") != F.col("g.family")) & (
        (F.col("q.members") < F.col("g.members")) | ((F.col("q.members") == F.col("g.members")) & (F.col("q.home") > F.col("g.family"))))
    sized = (F.col("g.n_max") * 100 >= F.col("q.n") * pct) & (F.col("g.n_min") * pct <= F.col("q.n") * 100)
    # per query and group, the common tokens of query prefix and union of prefixes
    asked = (q.join(g, (F.col("q.token") == F.col("g.token")) & (inside | smaller) & sized)
             .groupBy("q.nid", "q.n", "q.home", "g.family", "g.members").agg(F.count(F.lit(1)).alias("common")).where(enough)
             .select("nid", "n", "home", "family", "members"))
    asked = materialize(asked, label)
    member = of.select("nid", F.col("home").alias("family"), "members")
    large = asked.where(F.col("members") > CHUNK)
    asked = asked.where(F.col("members") <= CHUNK).drop("members").union(within_reach(
        large.drop("members"), member.where(F.col("members") > CHUNK)
        .join(large.select("family").distinct(), "family", "left_semi").select("nid", "family"), sets, pct, label))
    asked = materialize(asked.select("nid", "family"), label)
    load = (asked.groupBy("family").agg(F.count(F.lit(1)).alias("queries"))
            .join(homes.withColumnRenamed("home", "family"), "family")
            .select("family", parts.alias("parts"), F.ceil(F.col("queries") / BLOCK).cast("long").alias("blocks")))
    zero = F.lit(0).cast("long")
    members = (member.join(load, "family")
               .select("nid", "family", F.pmod(F.xxhash64("nid"), F.col("parts")).alias("part"),
                       F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"), F.lit(0).alias("asks")))
    queries = (asked.join(load, "family")
               .select("nid", "family", F.explode(F.sequence(zero, F.col("parts") - 1)).alias("part"),
                       F.pmod(F.xxhash64("nid", F.lit(1)), F.col("blocks")).alias("block"), F.lit(1).alias("asks")))
    places = members.union(queries).join(of.select("nid", "component"), "nid")
    opened = _in_order(placed_sets(places, sets, label), ["family", "part", "block"])
    links = materialize(opened.mapInArrow(ask_chunks(pct), "a long, b long"), label)
    # links between first components, then the components of those
    quotient = (links.join(of.select(F.col("nid").alias("a"), F.col("component").alias("ca")), "a")
                .join(of.select(F.col("nid").alias("b"), F.col("component").alias("cb")), "b")
                .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    second = components(quotient, label)
    final = (of.join(second.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left")
             .select("nid", F.coalesce("whole", "component").alias("component_id")))
    named = nodes.join(final, "nid", "left").select(*digest, F.coalesce("component_id", "nid").alias("component_id"), "times")
    placed_rows = skew.join_unique(filled, materialize(named, label), digest, "times").select("doc_id", "n", "component_id")
    others = rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.when(F.col("n") == 0, F.col("doc_id")).alias("component_id"))
    return placed_rows.unionByName(others).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, k: int = 5, threshold_pct: int = 80, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose id is their component's id, i.e. one
    document of each group. Rows with a null id stay; of rows that repeat an id all stay.

    Texts are not shuffled to remove the others: rows whose id is not in a bitmap of the
    removed ids (of fixed size) stay at once, and only the few others are joined."""
    found = similar_components(docs, k, threshold_pct, id_col, **options)
    gone = materialize(found.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("c"))
                       .where("c < doc_id").select("doc_id"), "removed")
    at = hashed_id(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0).cast("long")))
    removed_at = hashed_id(F.col("doc_id"))
    # at most BITS / 32768 bitmaps of 4 KB
    maps = materialize(gone.groupBy(F.bitmap_bucket_number(removed_at).alias("__map"))
                       .agg(F.bitmap_construct_agg(F.bitmap_bit_position(removed_at)).alias("__bits")), "removed-map")
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    listed = F.coalesce(F.pow(F.lit(2), bit % 8).cast("int").bitwiseAND(byte) > 0, F.lit(False))
    marked = docs.join(F.broadcast(maps), F.bitmap_bucket_number(at) == F.col("__map"), "left").withColumn("__listed", listed)
    checked = marked.where("__listed").alias("d").join(
        gone.select(F.col("doc_id").alias("__removed")), F.col(f"d.`{id_col}`").cast("long") == F.col("__removed"), "left_anti")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where("not __listed").select(*names).union(checked.select(*names))


#: DuckDB statement for 3-word shingles and 90 percent
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 90 * (p.n + q.n - o)),
pairs AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x AS doc_id, x AS r FROM pairs UNION SELECT b.y, reach.r FROM reach JOIN pairs b ON b.x = reach.doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.r, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id) m USING (doc_id)
"""
