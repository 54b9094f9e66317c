"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters run over windows of 8 bytes (step 4), the responses are
max-pooled inside overlapping chunks that cover the whole document, and the chunks' maxima
and means are combined into one probability. Training runs on the driver over a bounded
sample of labelled rows (``sample_rows`` of each label and ``sample_bytes`` in all, both
documented parameters); scoring is one narrow pass over whole texts.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches, materialize
from . import textbytes as tb

STEP = 4              # bytes between windows; a window is two steps
POOL = 16             # windows of a pooling block
CHUNK, HOP = 4, 3     # a chunk is 4 blocks (256 bytes); the next starts 3 blocks later
PAD = STEP * POOL


@dataclass
class Network:
    """Parameters, all float32."""
    embed: np.ndarray
    first: np.ndarray
    second: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    NAMES = ("embed", "first", "second", "bias", "out", "out_bias")

    @staticmethod
    def fresh(seed: int, width: int = 8, filters: int = 16) -> "Network":
        rng = np.random.default_rng(seed)
        f = lambda scale, *shape: (scale * rng.standard_normal(shape)).astype(np.float32)
        return Network(f(0.5, 256, width), f(0.2, STEP * width, filters), f(0.2, STEP * width, filters),
                       np.zeros(filters, np.float32), f(0.1, 2 * filters), np.zeros(1, np.float32))


def padded(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows laid out with STEP zero bytes before each (no window reaches the next row's
    text) and zeros after it up to whole pooling blocks; and the rows' block offsets."""
    lengths = np.diff(bounds)
    blocks = (lengths + STEP + PAD - 1) // PAD
    offsets = np.concatenate([[0], np.cumsum(blocks)])
    out = np.zeros(int(offsets[-1]) * PAD + STEP, np.uint8)
    shift = offsets[:-1] * PAD + STEP - bounds[:-1]
    out[np.arange(len(data)) + np.repeat(shift, lengths)] = data
    return out, offsets


def chunk_ranges(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First block, end block and row of every chunk of the rows with these block offsets."""
    blocks = np.diff(offsets)
    number = np.maximum((blocks - CHUNK + HOP - 1) // HOP, 0) + 1
    rows = np.repeat(np.arange(len(blocks)), number)
    at = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    first = offsets[:-1][rows] + at * HOP
    return first, np.minimum(first + CHUNK, offsets[1:][rows]), rows


def responses(net: Network, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedded steps and the filters' responses (after ReLU) at every window."""
    steps = np.take(net.embed, data, axis=0).reshape(len(data) // STEP, -1)
    got = steps[:-1] @ net.first
    got += steps[1:] @ net.second
    got += net.bias
    return steps, np.maximum(got, 0, out=got)


def features(net: Network, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row, the maximum and the mean of the chunks' max-pooled responses."""
    flat, offsets = padded(data, bounds)
    _, got = responses(net, flat)
    pooled = got.reshape(-1, POOL, got.shape[1]).max(axis=1)
    first, end, rows = chunk_ranges(offsets)
    ends = np.concatenate([pooled, np.zeros((1, pooled.shape[1]), np.float32)])
    chunks = np.maximum.reduceat(ends, np.stack([first, end], axis=1).ravel(), axis=0)[::2]
    starts = tb.row_starts(rows, len(bounds) - 1)
    most = np.maximum.reduceat(chunks, starts[:-1], axis=0)
    mean = np.add.reduceat(chunks.astype(np.float64), starts[:-1], axis=0) / np.diff(starts)[:, None]
    return np.concatenate([most, mean.astype(np.float32)], axis=1)


def probability(net: Network, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if len(bounds) < 2:
        return np.zeros(0)
    # summed row by row, so a score does not depend on the rows beside it
    logit = (features(net, data, bounds).astype(np.float64) * net.out).sum(axis=1) + net.out_bias[0]
    return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def _gradient(net: Network, text: np.ndarray, target: float, weight: float, grad: dict[str, np.ndarray]) -> float:
    """Adds one document's gradient (through the windows that won a maximum)."""
    flat, offsets = padded(text, np.array([0, len(text)]))
    steps, got = responses(net, flat)
    n_filters = got.shape[1]
    first, end, _ = chunk_ranges(offsets)
    blocks = got.reshape(-1, POOL, n_filters)
    top = blocks.argmax(axis=1) + (np.arange(len(blocks)) * POOL)[:, None]
    columns = np.arange(n_filters)
    pooled = got[top, columns]
    winner = np.empty((len(first), n_filters), np.int64)
    for c, (a, b) in enumerate(zip(first.tolist(), end.tolist())):
        best = pooled[a:b].argmax(axis=0) + a
        winner[c] = top[best, columns]
    chunks = got[winner, columns]
    which = chunks.argmax(axis=0)
    feats = np.concatenate([chunks[which, columns], chunks.mean(axis=0)])
    p = 1 / (1 + np.exp(-np.clip(float(feats @ net.out + net.out_bias[0]), -60, 60)))
    err = np.float32(weight * (p - target))
    grad["out"] += err * feats
    grad["out_bias"] += err
    back = np.repeat((err * net.out[n_filters:] / len(chunks))[None, :], len(chunks), axis=0)
    back[which, columns] += err * net.out[:n_filters]
    back *= chunks > 0
    grad["bias"] += back.sum(axis=0)
    live = np.flatnonzero(back.any(axis=1))
    at, g = winner[live], back[live]
    for f in range(n_filters):
        grad["first"][:, f] += g[:, f] @ steps[at[:, f]]
        grad["second"][:, f] += g[:, f] @ steps[at[:, f] + 1]
    width = net.embed.shape[1]
    for half, weights in ((0, net.first), (1, net.second)):
        bytes_ = flat[((at + half) * STEP)[:, :, None] + np.arange(STEP)].ravel()
        by_place = weights.T.reshape(n_filters, STEP, width)
        for k in range(width):
            values = g[:, :, None] * by_place[None, :, :, k]
            grad["embed"][:, k] += np.bincount(bytes_, weights=values.ravel(), minlength=256)
    q = min(max(p, 1e-7), 1 - 1e-7)
    return -weight * (target * np.log(q) + (1 - target) * np.log(1 - q))


def fit(texts: list[bytes], targets: np.ndarray, weights: np.ndarray, steps: int = 600, batch: int = 16,
        rate: float = 0.01, seed: int = 7) -> Network:
    """``steps`` steps of Adam on the weighted log loss, over the sample in a new order each
    time it is used up; the same sample and seed give the same network."""
    net = Network.fresh(seed)
    rng = np.random.default_rng(seed)
    raw = [np.frombuffer(t, np.uint8) for t in texts]
    mean = {k: np.zeros_like(getattr(net, k)) for k in Network.NAMES}
    square = {k: np.zeros_like(getattr(net, k)) for k in Network.NAMES}
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(raw)):
            order = np.append(order, rng.permutation(len(raw)))
        rows, order = order[:batch], order[batch:]
        grad = {k: np.zeros_like(getattr(net, k)) for k in Network.NAMES}
        for i in rows:
            _gradient(net, raw[i], float(targets[i]), float(weights[i]) / len(rows), grad)
        now = rate * (1 - (step - 1) / steps)
        for k in Network.NAMES:
            mean[k] += 0.1 * (grad[k] - mean[k])
            square[k] += 0.01 * (grad[k] ** 2 - square[k])
            update = (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
            setattr(net, k, (getattr(net, k) - now * update).astype(np.float32))
    return net


def held_out(id_col) -> "F.Column":
    """crc32 of the id as text, mod 5, is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, sample_rows: int, sample_bytes: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Whole texts, targets and weights of at most ``sample_rows`` rows and ``sample_bytes / 2``
    bytes of each label, in the order of a hash of the id; a text that would pass the bytes is
    passed over. Both bounds are applied to ids and lengths, before any text is fetched.
    Weights restore the labels' shares over all rows. A doc_id that several documents or
    labels name counts once: its shortest text (of those the first in order) and its lower label. A label of which no text
    fits raises an error; there is no other bound on a text's length."""
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sizes = texts.select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    found = materialize(sizes.join(usable, "doc_id").groupBy("doc_id", "quality").agg(F.min("bytes").alias("bytes"))
                        .withColumn("h", F.xxhash64("doc_id")), "labelled")
    chosen = []
    for label in (0, 1):  # at most sample_rows narrow rows each
        rows, held = found.where(F.col("quality") == label).orderBy("h", "doc_id").limit(sample_rows).collect(), 0
        for r in rows:
            if held + r["bytes"] <= sample_bytes // 2:
                chosen.append(r)
                held += r["bytes"]
        if rows and not any(r["quality"] == label for r in chosen):
            raise ValueError(f"no text of label {label} among the first {sample_rows} fits sample_bytes / 2 = {sample_bytes // 2}")
    if not chosen:
        return [], np.zeros(0), np.zeros(0)
    ids = F.broadcast(docs.sparkSession.createDataFrame([(r["doc_id"], r["bytes"]) for r in chosen], "doc_id long, bytes long"))
    fetched = (texts.join(ids, "doc_id").where(F.octet_length("text") == F.col("bytes"))
               .groupBy("doc_id").agg(F.min("text").alias("text")))
    raw = {r["doc_id"]: r["text"].encode("utf-8", "replace") for r in fetched.toLocalIterator()}
    chosen.sort(key=lambda r: (r["h"], r["doc_id"]))
    y = np.array([r["quality"] for r in chosen], np.float64)
    n = sum(counts.values())
    share = {q: counts.get(q, 0) / n * len(y) / max(1, int((y == q).sum())) for q in (0, 1)}
    return [raw[r["doc_id"]] for r in chosen], y, np.where(y == 1, share[1], share[0])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 1500, sample_bytes: int = 8 << 20, **options) -> Network:
    """A network fitted on rows that are not held out. Without usable labels of both kinds
    there is nothing to tell apart: a warning says so and every text scores 0.5."""
    texts, y, w = training_sample(docs, labels, sample_rows, sample_bytes)
    if len(set(y.tolist())) < 2:
        warnings.warn("no usable labels of both kinds; every text scores 0.5", stacklevel=2)
        net = Network.fresh(0)
        net.out[:] = 0
        return net
    return fit(texts, y, w, **options)


def score(docs: DataFrame, net: Network, threshold: float = 0.3, text_col: str = "text",
          keep_text: bool = True) -> DataFrame:
    """``docs`` (with ``keep_text``, its text too) with ``score`` (probability of label 1) and ``predicted`` (1 from the
    threshold on) appended; only the text enters the score. Null texts score as empty ones;
    equal texts score alike; every other column passes unread, whatever its name."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)] or [F.lit(0).alias("c0")])
    narrow = docs.select(rest.alias("rest"), F.col(f"`{text_col}`").alias("text"))
    names = ["rest", "text", "score"] if keep_text else ["rest", "score"]
    schema = narrow.withColumn("score", F.lit(0.0)).select(*names).schema

    def judge(batches):
        for batch in batches:
            for i, j, data, bounds in tb.text_blocks(batch.column(1), tb.BLOCK_BYTES // 2):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(names) - 1], pa.array(probability(shared.value, data, bounds))], names)

    scored = narrow.mapInArrow(judge, schema)
    kept = [F.col("text").alias(c) if c == text_col else F.col("rest").getField(f"c{others.index(c)}").alias(c)
            for c in docs.columns if keep_text or c != text_col]
    return scored.select(*kept, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Trains on rows that are not held out, then scores all. Null and empty texts get the
    score of an empty document; rows with equal or null ids are scored one by one; labels
    that are null, not 0 or 1, or without a document are not used. An empty table gives no
    rows.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    scored = score(narrow, train(docs, labels, **options), threshold, keep_text=False)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
