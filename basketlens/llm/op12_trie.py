"""Conversation prefix trie with count-min screening of prefix digests.

A node is a distinct sequence of the first d turns (role, text) of a conversation. Every
conversation has one prefix digest per depth; a digest is 128 bits over running sums of
turn hashes, so a long conversation is cut into ranges like any other rows.

1. A count-min sketch of all prefix digests is counted with map-side combine. Its cells
   that count two or more, as bits, are of fixed size.
2. Screening: a digest with a cell that counts one was seen once, which proves a singleton:
   its node has one member and a tail without branches, and its row is emitted where it
   is. A crowded sketch only lets more digests through; it never errs the other way.
3. Only possibly shared prefixes shuffle, to be grouped exactly with map-side combine.
   Groups of one are tails after all.
4. Sums over subtrees by doubling: after round k a node holds the sums of its descendants
   less than 2^k below. The ancestor 2^k above a node is found in the rows of the node's
   smallest member, so no join meets a hot key; rounds grow with the logarithm of depth.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import running_totals
from ..session import materialize, scalar
from . import skew
from .turns import placed

WIDTH = 1 << 22   # cells of one row of the sketch
ROWS = 3          # rows of the sketch (WIDTH * ROWS / 8 bytes are broadcast)
PIECE = 1 << 12   # ids in one piece of an end list
MAP = 1 << 15     # bits of one of Spark's bitmaps
MAX_LEAD = 5      # most turns taken from another conversation


def ordered_turns(conversations: DataFrame, label: str = "trie") -> DataFrame:
    """(conv_id, pos, n, turn_hash, chars) of every turn, written. Rows without a conv_id belong
    to no conversation and are left out; null roles and texts count as empty."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    said = F.md5(F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text")))
    return materialize(placed(rows, ["conv_id"], label).select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "n", said.alias("turn_hash"), F.length("text").cast("long").alias("chars")), label)


def members(turns: DataFrame) -> DataFrame:
    """(conv_id, n) of every conversation."""
    return turns.where("pos = 1").select("conv_id", "n")


def rebuilt(turns: DataFrame, label: str = "trie") -> tuple[DataFrame, DataFrame]:
    """Turns and members after every conversation c takes its first h turns from conversation
    c - c % 100 (all if that has fewer, none if it does not exist), h = crc32(c) % 6, followed
    by its own turns after the first h. At most 100 conversations (199 about zero) take from one."""
    lead = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MAX_LEAD + 1)
    own = members(turns)
    from_ = own.select(F.col("conv_id").alias("donor"), F.col("n").alias("given"))
    plan = (own.withColumn("h", lead).withColumn("donor", F.col("conv_id") - F.col("conv_id") % 100).join(from_, "donor", "left")
            .select("conv_id", "donor", "h", F.least("h", F.coalesce("given", F.lit(0))).alias("led"), "n"))
    plan = materialize(plan, label)
    kept = turns.drop("n").where(F.col("pos") > lead)
    tails = (skew.join_unique(kept, plan.select("conv_id", "h", "led", "n"), ["conv_id"], "n")
             .select("conv_id", (F.col("pos") - F.col("h") + F.col("led")).alias("pos"), "turn_hash", "chars"))
    given = turns.where(F.col("pos") <= MAX_LEAD).select(F.col("conv_id").alias("donor"), "pos", "turn_hash", "chars")
    heads = plan.select("conv_id", "donor", "led").join(given, "donor").where("pos <= led").select("conv_id", "pos", "turn_hash", "chars")
    after = plan.select("conv_id", (F.col("led") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return materialize(tails.unionByName(heads), label), materialize(after, label)


def prefixes(turns: DataFrame, convs: DataFrame, label: str = "trie") -> DataFrame:
    """(conv_id, depth, digest, parent, chars, ended): one row per conversation and depth, the
    root included, written. ``parent`` is the digest one turn shorter."""
    hashed = turns.select("conv_id", "pos", "chars", *(
        F.xxhash64("pos", "turn_hash", F.lit(seed)).cast("decimal(20,0)").alias(f"h{seed}") for seed in (1, 2)))
    summed = running_totals(hashed, ["pos"], ["conv_id"], sums=["h1", "h2"], label=label)

    def digest(depth, *sums):
        return F.md5(F.concat_ws(":", depth.cast("string"), *(s.cast("string") for s in sums)))
    depth = F.col("pos")
    below = summed.select(
        "conv_id", depth.alias("depth"), digest(depth, F.col("_cum_h1"), F.col("_cum_h2")).alias("digest"),
        F.when(depth > 1, digest(depth - 1, F.col("_cum_h1") - F.col("h1"), F.col("_cum_h2") - F.col("h2"))).otherwise("root").alias("parent"),
        "chars", (depth == F.col("_n")).alias("ended"))
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("root").alias("digest"),
                        F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("chars"), (F.col("n") == 0).alias("ended"))
    return materialize(below.unionByName(root), label)


def cells(digest: str, width: int):
    """The digest's cell in each row of the sketch, numbered through."""
    return [F.pmod(F.xxhash64(digest, F.lit(r)), F.lit(width)) + r * width for r in range(ROWS)]


def sketch(rows: DataFrame, width: int, label: str) -> np.ndarray:
    """The bits of the cells that count two or more prefixes, WIDTH * ROWS / 8 bytes."""
    counted = rows.select(F.explode(F.array(*cells("digest", width))).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    at = F.col("cell") + 1
    found = (counted.where("n > 1").groupBy(F.bitmap_bucket_number(at).alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")))
    out = np.zeros(-(-ROWS * width // MAP) * MAP // 8, np.uint8)
    for r in materialize(found, label).collect():  # at most as many bytes as the sketch, by one job
        out[(r["k"] - 1) * (MAP // 8):r["k"] * (MAP // 8)] = np.frombuffer(r["bits"], np.uint8)
    return out


def screened(rows: DataFrame, bits: np.ndarray, width: int) -> DataFrame:
    """``rows`` with ``alone`` (the estimate is one) and ``parent_alone``; the root never is."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def screen(batches):
        bits = shared.value
        for batch in batches:
            alone = []
            for side in ("own", "up"):
                many = np.ones(batch.num_rows, bool)
                for r in range(ROWS):
                    at = batch.column(batch.schema.get_field_index(f"{side}{r}")).to_numpy()
                    many &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                alone.append(pa.array(~many & (batch.column("depth").to_numpy() > (0 if side == "own" else 1))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *alone], [*names, "alone", "parent_alone"])
    names = rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    up = F.coalesce("parent", F.lit("root"))
    return (rows.withColumn("_up", up).select(*names, *(c.alias(f"own{r}") for r, c in enumerate(cells("digest", width))),
                                              *(c.alias(f"up{r}") for r, c in enumerate(cells("_up", width))))
            .mapInArrow(screen, f"{schema}, alone boolean, parent_alone boolean"))


def end_lists(rows: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of (digest, conv_id): SHA-256 over the ids in numeric order, joined
    by commas. Ids of one range of PIECE are joined first; a task then streams the pieces of
    its digests in order and holds one piece."""
    def digested(batches):
        import hashlib
        held, state = None, None
        for batch in batches:
            done = []
            for key, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != held:
                    if held is not None:
                        done.append((held, state.hexdigest()))
                    held, state = key, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)], ["digest", "ends_sha256"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([state.hexdigest()])], ["digest", "ends_sha256"])
    pieces = (rows.groupBy("digest", F.floor(F.col("conv_id") / PIECE).alias("piece"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))
    return (pieces.repartition("digest").sortWithinPartitions("digest", "piece").select("digest", "piece", "ids")
            .mapInArrow(digested, "digest string, ends_sha256 string"))


def subtree_sums(nodes: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """(digest, leaves, saved): sums of the columns of those names over each node's subtree;
    ``nodes`` has digest, conv_id (smallest member), depth, leaves, saved and all ancestors."""
    deepest = scalar(nodes.agg(F.max("depth"))) or 0
    paths = rows.select("conv_id", F.col("depth").alias("_at"), F.col("digest").alias("up"))
    step = 1
    while step <= deepest:
        lifted = nodes.where(F.col("depth") >= step).withColumn("_at", F.col("depth") - step).join(paths, ["conv_id", "_at"])
        more = lifted.groupBy(F.col("up").alias("digest")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        nodes = materialize(nodes.join(more, "digest", "left").select(
            "digest", "conv_id", "depth", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), label)
        step *= 2
    return nodes.select("digest", "leaves", "saved")


def trie(turns: DataFrame, convs: DataFrame, width: int = WIDTH, label: str = "trie") -> DataFrame:
    """One row per node of the conversations ``convs`` (conv_id, n) with the given ``turns``
    (conv_id, pos, turn_hash, chars); see :func:`prefix_trie`."""
    rows = prefixes(turns, convs, label)
    rows = materialize(screened(rows, sketch(rows.where("depth > 0"), width, label), width), label)
    nothing = F.sha2(F.lit("").cast("binary"), 256)

    # exact grouping of what may be shared
    grouped = materialize(rows.where("not alone").groupBy("digest", "depth", "parent", "chars", "parent_alone")
                          .agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("ended").alias("ended")), label)
    shared = grouped.where("n_convs > 1 or depth = 0")
    single = ["conv_id", "depth", "parent", "ended", "parent_alone"]
    tails = rows.where("alone").select(*single).unionByName(grouped.where("n_convs = 1 and depth > 0").select(*single))

    # tails whose parent may be shared look it up; the others hang below themselves
    known = shared.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_convs")
    heads = materialize(skew.join_unique(tails.where("not parent_alone"), known, ["parent"], "n_convs"), label)
    tail_rows = tails.where("parent_alone").withColumn("parent_conv_id", F.lit(None).cast("long")).unionByName(heads)
    emitted = tail_rows.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("ended"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("ended"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nothing).alias("ends_sha256"))

    # shared nodes: children, ends, sums over subtrees
    hung = heads.where("parent_conv_id is not null").select("parent", F.lit(1).alias("tail"))
    below = (shared.where("depth > 0").select("parent", F.lit(0).alias("tail")).unionByName(hung)
             .groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"), F.sum("tail").cast("long").alias("n_tails")))
    zero = F.lit(0).cast("long")
    nodes = materialize(shared.join(below, "digest", "left").select(
        "digest", "depth", "parent", "n_convs", "conv_id", "ended", F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("n_tails")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), label)
    sums = subtree_sums(nodes.select("digest", "conv_id", "depth", "leaves", "saved"), rows, label)
    ended = rows.where("ended and not alone").select("digest", "conv_id")
    ends = end_lists(ended.join(nodes.where("ended").select("digest"), "digest", "left_semi"))
    # a node's parent is the prefix one shorter of the node's smallest member
    up = nodes.select("digest", "conv_id").withColumnRenamed("conv_id", "parent_conv_id").join(
        nodes.groupBy("digest").agg(F.max("n_convs").alias("n_convs")), "digest")
    placed_nodes = skew.join_unique(nodes.withColumn("parent", F.coalesce("parent", F.lit("none"))),
                                    up.withColumnRenamed("digest", "parent"), ["parent"], "n_convs")
    inner = (placed_nodes.drop("leaves", "saved").join(sums, "digest").join(ends, "digest", "left")
             .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                     F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256")))
    return inner.unionByName(emitted)


def prefix_trie(conversations: DataFrame, lead: bool = False, width: int = WIDTH, label: str = "trie") -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id;
    null for the root), n_convs, n_children, n_leaves (childless nodes of the subtree, itself
    included), saved_tokens (over the subtree, (n_convs - 1) times the characters of a node's
    last text), ends_sha256 (of the members that end there, ids ascending, comma-joined).

    Turns are ordered by turn number (null first), then role and text; repeated rows stay as
    turns of their own. Null roles and texts count as empty. Rows with a null conv_id are
    left out; a table without any other row gives no node, not even the root. Other columns
    are not read. With ``lead`` conversations are first rebuilt (see :func:`rebuilt`).
    ``width`` is the sketch's; it changes what shuffles, never a result.
    """
    turns = ordered_turns(conversations, label)
    turns, convs = rebuilt(turns, label) if lead else (turns, members(turns))
    return trie(turns, convs, width, label)


#: DuckDB statement for :func:`prefix_trie` over ``conversations`` with ``lead``; CRC-32 is spelled out
SQL = """
WITH RECURSIVE bits AS (
  SELECT i AS byte, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
o AS (SELECT CAST(conv_id AS BIGINT) AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
f AS (SELECT c, n, c - c % 100 AS donor,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) % 6 AS h
  FROM (SELECT c, count(*) AS n FROM o GROUP BY c) x, crc),
led AS (SELECT f.c, f.h, f.donor, least(f.h, coalesce(d.n, 0)) AS led FROM f LEFT JOIN f d ON d.c = f.donor),
turns AS (
  SELECT l.c, o.k, o.role, o.text FROM led l JOIN o ON o.c = l.donor AND o.k <= l.led
  UNION ALL SELECT l.c, o.k - l.h + l.led, o.role, o.text FROM led l JOIN o ON o.c = l.c AND o.k > l.h),
p AS (SELECT c, 0 AS d, '' AS path, 0 AS chars FROM f
  UNION ALL SELECT c, k, string_agg(md5(length(role) || ':' || role || ':' || text), ' ') OVER (PARTITION BY c ORDER BY k), length(text) FROM turns),
sized AS (SELECT *, max(d) OVER (PARTITION BY c) AS n, lag(path) OVER (PARTITION BY c ORDER BY d) AS up FROM p),
node AS (SELECT path, d, min(c) AS conv_id, min(up) AS up, count(*) AS n_convs, max(chars) AS chars,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = n), '')) AS ends FROM sized GROUP BY path, d),
kids AS (SELECT up AS path, count(*) AS k FROM node WHERE d > 0 GROUP BY up),
sums AS (SELECT a.path, sum((v.n_convs - 1) * v.chars) AS saved, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM node v LEFT JOIN kids ON kids.path = v.path JOIN sized a ON a.c = v.conv_id AND a.d <= v.d GROUP BY a.path)
SELECT CAST(v.conv_id AS BIGINT) AS conv_id, CAST(v.d AS BIGINT) AS depth, CAST(u.conv_id AS BIGINT) AS parent_conv_id,
  v.n_convs, coalesce(kids.k, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM node v LEFT JOIN node u ON u.path = v.up AND v.d > 0 LEFT JOIN kids ON kids.path = v.path JOIN sums s ON s.path = v.path
"""
