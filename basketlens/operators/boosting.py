"""Second-order gradient boosting with leaf-wise growth, on distributed histograms.

Features are cut into bins once. For every tree, tasks sum gradients and hessians of the
logistic loss into histograms (node x feature x bin); the sums combine before they shuffle,
and only histograms reach the driver, whose size does not depend on the rows. A split's
gain is the L2-regularised one, G^2 / (H + lambda). Growth is best leaf first: the open leaf
of the highest gain splits next until there are ``numLeaves`` leaves.

One pass serves many splits: it sums the left children of all nodes that best-first growth
would split by what is known so far (right children are differences), so a tree takes about
as many passes as it is deep, not as many as it has leaves. A node's gain does not depend
on the order of splits, so the tree is the one that splitting one by one gives.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasProbabilityCol, HasRawPredictionCol, HasSeed, HasStepSize, HasWeightCol
from pyspark.ml.param.shared import HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

TASK_CELLS = 4_000_000  # feature values that one task of a pass reads, about
KEEP_TREES = 10  # trees that tasks apply on the fly before margins are written again


@dataclass
class Tree:
    """Arrays by node; ``feature`` is -1 at a leaf. A row goes left if its bin is ``bin`` or
    less, that is if its value is ``threshold`` or less."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, threshold: float, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.threshold[node], self.gain[node] = feature, bin_, threshold, gain
        for side in (self.left, self.right):
            side[node] = len(self.feature)
            for column, empty in ((self.feature, -1), (self.bin, 0), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.gain, 0.0)):
                column.append(empty)
        return self.left[node], self.right[node]

    def leaf_of(self, x: np.ndarray, binned: bool) -> np.ndarray:
        """The leaf of each row of ``x`` (bins or values)."""
        cut = np.array(self.bin if binned else self.threshold)
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                return at
            f = np.where(inner, feature[at], 0)
            go = x[rows, f] <= cut[at]
            at = np.where(inner, np.where(go, left[at], right[at]), at)

    def margin(self, x: np.ndarray, binned: bool) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(x, binned)]

    def margin_of_bins(self, columns: np.ndarray) -> np.ndarray:
        """Margins of rows whose bins come feature by feature: one comparison of a whole
        feature per split, and the leaves' numbers put together from below."""
        def leaf(node: int):
            if self.feature[node] < 0:
                return np.int32(node)
            left, right = leaf(self.left[node]), leaf(self.right[node])
            return right + (columns[self.feature[node]] <= self.bin[node]) * (left - right)
        return np.array(self.value)[np.broadcast_to(leaf(0), columns.shape[1])]


@dataclass
class Node:
    """A node of the explored tree: sums by (feature, bin), and its best split."""
    path: list[tuple[int, int, bool]]  # (feature, bin, went left) from the root
    hist: np.ndarray                   # features x bins x (gradient, hessian, rows)
    gain: float = 0.0
    feature: int = -1
    bin: int = 0
    children: tuple["Node", "Node"] | None = None

    def find_split(self, lam: float, min_child: float, min_gain: float) -> "Node":
        """The split of the highest gain; ties: the first feature, then the first bin."""
        left = np.cumsum(self.hist, axis=1)
        total = left[:, -1:, :]
        right = total - left
        score = lambda s: s[..., 0] ** 2 / (s[..., 1] + lam)
        gain = 0.5 * (score(left) + score(right) - score(total))
        legal = (left[..., 2] > 0) & (right[..., 2] > 0.5) & (left[..., 1] >= min_child) & (right[..., 1] >= min_child)
        gain = np.where(legal, gain, -np.inf)
        at = int(np.argmax(gain))
        best = float(gain.flat[at])
        if best > min_gain:
            self.gain, (self.feature, self.bin) = best, divmod(at, gain.shape[1])
        return self


def best_first(root: Node, leaves: int, depth: int) -> list[Node]:
    """Nodes that growth splits, in order, as far as gains are known: an unexplored node is
    split too, but nothing below it."""
    open_, chosen = [root], []
    while len(chosen) < leaves - 1:
        able = [n for n in open_ if n.feature >= 0 and len(n.path) < depth]
        if not able:
            break
        node = max(able, key=lambda n: n.gain)  # ties: the one that came first
        open_.remove(node)
        chosen.append(node)
        open_ += node.children or ()
    return chosen


def _in_node(columns: np.ndarray, path: list[tuple[int, int, bool]]) -> np.ndarray:
    out = np.ones(columns.shape[1], bool)
    for feature, cut, left in path:
        out &= (columns[feature] <= cut) == left
    return out


def _columns(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The bins of a batch, one contiguous array per feature."""
    column = batch.column(batch.schema.get_field_index("bins"))
    _, offsets, data = column.buffers()
    start = int(np.frombuffer(offsets, np.int32)[column.offset])
    return np.ascontiguousarray(np.frombuffer(data, np.int8, len(column) * size, start).reshape(-1, size).T)


def histograms(rows: DataFrame, trees: list[Tree], paths: list, size: int, bins: int, share: float, salt: int) -> np.ndarray:
    """Sums of (gradient, hessian, rows) for each path's node, feature and bin, in one job. No
    row may be in two of the nodes: a row's node is found once, and each feature counted once
    for all nodes. With ``share`` below 1 a tree sees the rows that a hash of (row, salt) picks."""
    shared = rows.sparkSession.sparkContext.broadcast((trees, paths))
    cells = size * bins

    def count(batches):
        trees, paths = shared.value
        out = np.zeros((3, len(paths), size, bins))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _columns(batch, size)
            y, w, margin = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("y", "w", "margin"))
            for tree in trees:
                margin = margin + tree.margin_of_bins(x)
            seen = batch.column(batch.schema.get_field_index("pick")).to_numpy() < share
            node = np.full(len(y), -1)
            for k, path in enumerate(paths):
                node[_in_node(x, path) & seen] = k
            use = np.flatnonzero(node >= 0)
            y, w, margin, first = y[use], w[use], margin[use], node[use] * bins
            p = 1 / (1 + np.exp(-margin))
            g, h = w * (p - y), w * p * (1 - p)
            for f in range(size):
                at = first + x[f][use]
                for s, weights in enumerate((g, h, None)):
                    out[s, :, f] += np.bincount(at, weights=weights, minlength=len(paths) * bins).reshape(-1, bins)
        out = out.reshape(3, -1)
        used = np.flatnonzero(out[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(out[s][used]) for s in range(3))], ["cell", "g", "h", "n"])
    picked = rows.withColumn("pick", F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(1 << 20)) / F.lit(float(1 << 20)))
    got = (picked.mapInArrow(count, "cell long, g double, h double, n double").groupBy("cell")
           .agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toPandas())
    out = np.zeros((len(paths) * cells, 3))
    out[got["cell"].to_numpy(np.int64)] = got[["g", "h", "n"]].to_numpy()
    return out.reshape(len(paths), size, bins, 3)


def grow(hist_of, edges: list[np.ndarray], leaves: int, depth: int, lam: float, min_child: float, min_gain: float, step: float) -> Tree:
    """One tree; ``hist_of(paths)`` gives histograms of nodes."""
    split = lambda path, hist: Node(path, hist).find_split(lam, min_child, min_gain)
    root = split([], hist_of([[]])[0])
    while True:
        chosen = best_first(root, leaves, depth)
        # children at the last depth need no histogram of their own, only their sums
        unknown = [n for n in chosen if n.children is None]
        deeper = [n for n in unknown if len(n.path) + 1 < depth]
        if not deeper:
            break
        got = hist_of([n.path + [(n.feature, n.bin, True)] for n in deeper])
        for n, left in zip(deeper, got):
            right = n.hist - left
            right[..., 2] = np.round(right[..., 2])
            n.children = tuple(split(n.path + [(n.feature, n.bin, went)], hist) for went, hist in ((True, left), (False, right)))
    tree, place = Tree(), {id(root): 0}
    value = lambda s: float(-step * s[0] / (s[1] + lam))
    tree.value[0] = value(root.hist[0].sum(0))
    for n in chosen:
        at = place[id(n)]
        a, b = tree.split(at, n.feature, n.bin, float(edges[n.feature][n.bin]), n.gain)
        left = n.hist[n.feature, :n.bin + 1].sum(0)
        tree.value[a], tree.value[b] = value(left), value(n.hist[n.feature].sum(0) - left)
        for child, where in zip(n.children or (), (a, b)):
            place[id(child)] = where
    return tree


class _Boosting(HasFeaturesCol, HasLabelCol, HasWeightCol, HasProbabilityCol, HasRawPredictionCol, HasPredictionCol, HasMaxIter, HasStepSize, HasSeed):
    numLeaves = Param(Params._dummy(), "numLeaves", "most leaves of a tree", typeConverter=TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "most splits above a leaf", typeConverter=TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature (at most 127)", typeConverter=TypeConverters.toInt)
    regLambda = Param(Params._dummy(), "regLambda", "L2 penalty of leaf values", typeConverter=TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least hessian of a child", typeConverter=TypeConverters.toFloat)
    minGain = Param(Params._dummy(), "minGain", "gain that a split must exceed", typeConverter=TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows that a tree is grown on", typeConverter=TypeConverters.toFloat)
    model = Param(Params._dummy(), "model", "trees as JSON", typeConverter=TypeConverters.toString)


class LeafwiseBoostedClassifier(Estimator, _Boosting, DefaultParamsReadable, DefaultParamsWritable):
    """Binary classifier, labels 0 and 1; see the module's text. Bins end at approximate
    quantiles of each feature (relative rank error 1/10000) and at every value of a feature
    with fewer values than bins."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, maxIter=100, numLeaves=31, maxDepth=5, stepSize=0.1,
                 maxBins=64, regLambda=1.0, minChildWeight=1e-3, minGain=0.0, subsamplingRate=1.0, seed=42, probabilityCol="probability",
                 rawPredictionCol="rawPrediction", predictionCol="prediction"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        for name, value in dict(featuresCol="features", labelCol="label", maxIter=100, numLeaves=31, maxDepth=5, stepSize=0.1, maxBins=64,
                                regLambda=1.0, minChildWeight=1e-3, minGain=0.0, subsamplingRate=1.0, seed=42, probabilityCol="probability",
                                rawPredictionCol="rawPrediction", predictionCol="prediction").items():
            self._setDefault(**{name: value})

    def setFeaturesCol(self, value: str) -> "LeafwiseBoostedClassifier":
        return self._set(featuresCol=value)

    def _fit(self, df: DataFrame) -> "LeafwiseBoostedModel":
        get = self.getOrDefault
        bins = get("maxBins")
        if not 2 <= bins <= 127:
            raise ValueError("maxBins must be between 2 and 127")
        weight = F.col(get("weightCol")).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        data = df.select(vector_to_array(get("featuresCol")).alias("x"), F.col(get("labelCol")).cast("double").alias("y"), weight.alias("w"))
        first = data.agg(F.max(F.size("x")).alias("size"), F.sum(F.col("w") * F.col("y")).alias("pos"), F.sum("w").alias("all"), F.count(F.lit(1)).alias("n")).first()
        size, total = first["size"], first["all"] or 0.0
        if not size or not total:
            raise ValueError("no rows to fit")
        share = min(max(first["pos"] / total, 1e-6), 1 - 1e-6)
        base = math.log(share / (1 - share))
        probs = F.array(*[F.lit(k / bins) for k in range(1, bins)])
        cut = data.agg(*[F.percentile_approx(F.col("x")[i], probs, 10_000).alias(f"e{i}") for i in range(size)],
                       *[F.max(F.col("x")[i]).alias(f"m{i}") for i in range(size)]).first()
        edges = [np.unique([e for e in cut[f"e{i}"] if e < cut[f"m{i}"]]) for i in range(size)]
        tasks = -(-first["n"] * size // TASK_CELLS)  # from the data, not from how it was laid out
        numbered = data.withColumn("row", F.monotonically_increasing_id()).withColumn("margin", F.lit(base))
        # few files would leave every pass to as few tasks, however many rows they hold
        rows = self._binned(numbered.repartition(tasks, "row") if tasks > 1 else numbered, edges, size).coalesce(tasks)
        trees: list[Tree] = []
        fresh: list[Tree] = []
        for k in range(get("maxIter")):
            if len(fresh) >= KEEP_TREES:
                rows, fresh = materialize(apply_trees(rows, fresh, size), "boost-margins").coalesce(tasks), []
            tree = grow(lambda paths, salt=get("seed") * 100_003 + k: histograms(
                rows, fresh, paths, size, bins, get("subsamplingRate"), salt), edges, get("numLeaves"), get("maxDepth"),
                get("regLambda"), get("minChildWeight"), get("minGain"), get("stepSize"))
            trees.append(tree)
            fresh.append(tree)
            if len(tree.feature) == 1:  # nothing left to split
                break
        text = json.dumps({"base": base, "size": size, "trees": [vars(t) for t in trees]})
        return self._copyValues(LeafwiseBoostedModel(model=text))

    @staticmethod
    def _binned(data: DataFrame, edges: list[np.ndarray], size: int) -> DataFrame:
        def cut(batches):
            for batch in batches:
                x = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, size)
                out = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], 1).astype(np.int8)
                at = (np.arange(len(x) + 1) * size).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(at), pa.py_buffer(out)]),
                                                  *(batch.column(batch.schema.get_field_index(c)) for c in ("y", "w", "row", "margin"))],
                                                 ["bins", "y", "w", "row", "margin"])
        return materialize(data.mapInArrow(cut, "bins binary, y double, w double, row long, margin double"), "boost-rows")


def apply_trees(rows: DataFrame, trees: list[Tree], size: int) -> DataFrame:
    """``rows`` with the trees' margins added."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def add(batches):
        for batch in batches:
            at = batch.schema.get_field_index("margin")
            margin = batch.column(at).to_numpy()
            columns = _columns(batch, size) if batch.num_rows else None
            for tree in shared.value if batch.num_rows else ():
                margin = margin + tree.margin_of_bins(columns)
            yield batch.set_column(at, "margin", pa.array(margin))
    return rows.mapInArrow(add, rows.schema)


class LeafwiseBoostedModel(Model, _Boosting, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, model=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def parsed(self) -> tuple[float, int, list[Tree]]:
        found = json.loads(self.getOrDefault("model"))
        return found["base"], found["size"], [Tree(**t) for t in found["trees"]]

    @property
    def featureImportances(self) -> DenseVector:
        """Gains by feature, summing to one."""
        _, size, trees = self.parsed
        out = np.zeros(size)
        for tree in trees:
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    out[f] += gain
        return DenseVector(out / out.sum() if out.sum() else out)

    def _transform(self, df: DataFrame) -> DataFrame:
        base, size, trees = self.parsed
        shared = df.sparkSession.sparkContext.broadcast(trees)

        @F.pandas_udf("double")
        def margin(x):
            import pandas as pd
            out = np.full(len(x), base)
            if len(x):
                values = np.stack(x.to_numpy())
                for tree in shared.value:
                    out += tree.margin(values, False)
            return pd.Series(out)
        get = self.getOrDefault
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return (df.withColumn("_margin", margin(vector_to_array(get("featuresCol"))))
                .withColumn(get("rawPredictionCol"), array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))))
                .withColumn(get("probabilityCol"), array_to_vector(F.array(1 - p, p)))
                .withColumn(get("predictionCol"), (F.col("_margin") > 0).cast("double")).drop("_margin"))
