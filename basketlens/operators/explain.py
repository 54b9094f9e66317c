"""Feature attributions (ops 52-55).

* Linear models: contribution_j = coef_j * (x_j - mean_j) over the explained sample, base =
  intercept + sum coef_j mean_j (log-odds).
* Tree ensembles (MLlib GBT / random forest): path-dependent TreeSHAP (Lundberg, Erion &
  Lee 2018, Algorithm 2). The trees are read from the model's own persisted node table,
  flattened to root-to-leaf paths (bounded by numTrees x 2^depth) and broadcast into
  ``mapInPandas``; a batch of rows is explained at once in numpy, where the rows live. GBT attributions are on the
  log-odds scale (2 x margin), random-forest ones on the probability of class 1.

Output is long: (id, feature, feature_value, shap_value), one row per id and feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import app_folder, materialize


def _quoted(name: str):
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


# ---------------------------------------------------------------------------------------
# op 52: linear attributions


def linear_attributions(df: DataFrame, id_col: str, coefficients: DataFrame,
                        intercept: float = 0.0):
    """``coefficients``: (feature, coefficient). Returns (long attributions, one-row base).

    The id and the features are written once; the means are one aggregate of that copy, and
    contributions are computed as columns before the frame is made long."""
    spark = df.sparkSession
    coef = {r["feature"]: float(r["coefficient"]) for r in coefficients.collect()}
    if len(coef) == 0:
        raise ValueError("no features to explain")
    names = list(coef)
    rows = materialize(df.select(F.col(id_col).alias("_id"), *[
        _quoted(f).cast("double").alias(f"x{i}") for i, f in enumerate(names)]), "attributions")
    means = rows.agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(len(names))]).first()
    mean = [0.0 if m is None else m for m in means]
    parts = [F.struct(F.lit(f).alias("feature"), F.col(f"x{i}").alias("feature_value"),
                      (F.lit(coef[f]) * (F.col(f"x{i}") - F.lit(mean[i]))).alias("shap_value"))
             for i, f in enumerate(names)]
    out = rows.select(F.col("_id").alias(id_col), F.explode(F.array(*parts)).alias("x")).select(id_col, "x.*")
    base = float(intercept) + sum(coef[f] * mean[i] for i, f in enumerate(names))
    return out, spark.createDataFrame([(base,)], "expected_value double")


PREPARED = ("_sca_", "_ohe_", "_imp_")


def _features_frame(model, df: DataFrame, id_col: str):
    """Apply all stages but the last (the assembled 'features' vector) and read the slot names."""
    from pyspark.ml import PipelineModel
    prep = PipelineModel(model.stages[:-1]).transform(df)
    meta = prep.schema["features"].metadata.get("ml_attr", {})
    n = meta.get("num_attrs")
    names = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a["name"]
    if n is None:
        n = len(prep.select("features").first()[0])
    cleaned = []
    for i in range(n):
        nm = names.get(i, f"f{i}")
        while nm.startswith(PREPARED):  # the preparation's own prefixes, outermost first
            nm = next(nm[len(p):] for p in PREPARED if nm.startswith(p))
        cleaned.append(nm)
    repeated = sorted({c for c in cleaned if cleaned.count(c) > 1})
    if repeated:
        raise ValueError(f"features share a name: {', '.join(repeated)}")
    arr = prep.select(id_col, vector_to_array("features").alias("_x"))
    return arr, cleaned


def linear_model_attributions(model, df: DataFrame, id_col: str):
    """Attributions of a pipeline ending in LogisticRegression, on its assembled features."""
    arr, names = _features_frame(model, df, id_col)
    lr = model.stages[-1]
    spark = df.sparkSession
    coef = spark.createDataFrame([(n, float(c)) for n, c in zip(names, lr.coefficients.toArray())],
                                 "feature string, coefficient double")
    wide = arr.select(id_col, *[F.col("_x").getItem(i).alias(n) for i, n in enumerate(names)])
    return linear_attributions(wide, id_col, coef, float(lr.intercept))


def mean_abs_attribution(attributions: DataFrame) -> DataFrame:
    """(feature, mean_abs_shap), largest first."""
    return (attributions.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))
            .orderBy(F.col("mean_abs_shap").desc(), "feature"))


# ---------------------------------------------------------------------------------------
# op 53: tree attributions

EXPLAIN_ROWS = 4096  # rows explained together by a worker


def flatten_ensemble(tree_model) -> list[dict]:
    """Node arrays per tree from the model's persisted form: left, right, feature,
    threshold (or left category set), value, cover, and the tree weight."""
    spark = SparkSession.getActiveSession()
    path = f"{app_folder(spark)}/model-{uuid.uuid4().hex}"
    tree_model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "treeID" not in nodes.columns:
        nodes = nodes.withColumn("treeID", F.lit(0))
    nodes = nodes.select("treeID", "nodeData.*").collect()
    # a single tree has no weights; an ensemble's are in the order of its tree ids
    weights = dict(enumerate(map(float, getattr(tree_model, "treeWeights", [1.0]))))
    trees: dict[int, list] = {}
    for r in nodes:
        trees.setdefault(r["treeID"], []).append(r)
    is_classifier = type(tree_model).__name__.startswith("RandomForestClassification")
    out = []
    for tid in sorted(trees):
        rows = sorted(trees[tid], key=lambda r: r["id"])
        idx = {r["id"]: i for i, r in enumerate(rows)}
        n = len(rows)
        left = np.full(n, -1)
        right = np.full(n, -1)
        feat = np.full(n, -1)
        thr = np.zeros(n)
        cats: list = [None] * n
        value = np.zeros(n)
        cover = np.zeros(n)
        for i, r in enumerate(rows):
            stats = list(r["impurityStats"] or [])
            if is_classifier:
                tot = sum(stats)
                value[i] = (stats[1] / tot) if tot > 0 and len(stats) > 1 else 0.0
                cover[i] = tot
            else:
                value[i] = r["prediction"]
                cover[i] = stats[0] if stats else float(r["rawCount"])
            if r["leftChild"] >= 0:
                left[i], right[i] = idx[r["leftChild"]], idx[r["rightChild"]]
                sp = r["split"]
                feat[i] = sp["featureIndex"]
                if sp["numCategories"] < 0:
                    thr[i] = sp["leftCategoriesOrThreshold"][0]
                else:
                    cats[i] = set(sp["leftCategoriesOrThreshold"])
        root = idx[0] if 0 in idx else 0
        out.append({"left": left, "right": right, "feature": feat, "threshold": thr,
                    "categories": cats, "value": value, "cover": cover, "root": root,
                    "weight": weights[tid]})
    return out


def leaf_paths(tree: dict) -> list[tuple[float, list[tuple]]]:
    """(leaf value, conditions) of each root-to-leaf path. A condition stands for all splits
    of the path on one feature: (feature, share, above, upto, category sets), where share is
    the product of the cover ratios, a row passes the numeric splits if not x <= above and
    x <= upto, and each (set, inside) asks whether x is in the set."""
    out = []

    def walk(node: int, conditions: dict):
        if tree["left"][node] < 0:
            out.append((float(tree["value"][node]), [(f, *c) for f, c in conditions.items()]))
            return
        f, cats = int(tree["feature"][node]), tree["categories"][node]
        cover = tree["cover"][node] if tree["cover"][node] > 0 else 1.0
        for child, left in ((tree["left"][node], True), (tree["right"][node], False)):
            share, above, upto, sets = conditions.get(f, (1.0, None, None, ()))
            share *= tree["cover"][child] / cover
            if cats is not None:
                sets = (*sets, (tuple(sorted(cats)), left))
            elif left:
                upto = tree["threshold"][node] if upto is None else min(upto, tree["threshold"][node])
            else:
                above = tree["threshold"][node] if above is None else max(above, tree["threshold"][node])
            walk(child, {**conditions, f: (share, above, upto, sets)})

    walk(tree["root"], {})
    return out


def _passes(x: np.ndarray, above, upto, sets) -> np.ndarray:
    ok = np.ones(len(x), bool)
    if upto is not None:
        ok &= x <= upto
    if above is not None:
        ok &= ~(x <= above)  # a missing value goes right
    for values, inside in sets:
        ok &= np.isin(x, values) == inside
    return ok


def path_shap(x: np.ndarray, paths: list[tuple[float, list[tuple]]], phi: np.ndarray, scale: float) -> None:
    """Add the path-dependent Shapley values of one tree (times ``scale``) for a batch of
    rows: x and phi are (rows, features).

    For a path on m features the weights of Algorithm 2's subsets are built by extending with
    each feature (share z if it is absent, o if the row passes its splits) and summed with
    one feature unwound at a time, over the row axis."""
    for value, conditions in paths:
        m = len(conditions)
        if not m or value == 0.0:
            continue
        o = np.stack([_passes(x[:, f], *rest) for f, _, *rest in conditions]).astype(float)
        z = [c[1] for c in conditions]
        w = np.zeros((m + 1, len(x)))
        w[0] = 1.0
        for d in range(1, m + 1):
            for i in range(d - 1, -1, -1):
                w[i + 1] += o[d - 1] * w[i] * ((i + 1) / (d + 1))
                w[i] *= z[d - 1] * ((d - i) / (d + 1))
        for k, (f, share, *_) in enumerate(conditions):
            hit = o[k] > 0
            following, inside, outside = w[m].copy(), np.zeros(len(x)), np.zeros(len(x))
            for i in range(m - 1, -1, -1):
                part = following / (i + 1)
                inside += part
                following = w[i] - part * share * (m - i)
                if share > 0:
                    outside += w[i] / (share * (m - i))
            total = np.where(hit, inside, outside) * (m + 1)
            phi[:, f] += total * (o[k] - share) * (value * scale)


def expected_value(tree: dict) -> float:
    """Cover-weighted mean of the leaf values."""
    leaves = tree["left"] < 0
    c = tree["cover"][leaves]
    return float((tree["value"][leaves] * c).sum() / c.sum()) if c.sum() > 0 else 0.0


def _scales(tree_model, trees):
    if type(tree_model).__name__.startswith("RandomForestClassification"):
        return [1.0 / len(trees)] * len(trees)
    return [2.0 * t["weight"] for t in trees]  # GBT: log-odds = 2 * sum w_t f_t(x)


def tree_attributions(model, df: DataFrame, id_col: str):
    """TreeSHAP for a pipeline ending in a GBT or random-forest classifier.

    Returns (long attributions, one-row base value).
    """
    spark = df.sparkSession
    tree_model = model.stages[-1]
    trees = flatten_ensemble(tree_model)
    scales = _scales(tree_model, trees)
    base = float(sum(s * expected_value(t) for s, t in zip(scales, trees)))
    arr, names = _features_frame(model, df, id_col)
    bc = spark.sparkContext.broadcast(([leaf_paths(t) for t in trees], scales, names))
    id_type = arr.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("feature", T.StringType()),
                           T.StructField("feature_value", T.DoubleType()),
                           T.StructField("shap_value", T.DoubleType())])

    def explain(batches):
        paths, sc, nm = bc.value
        for pdf in batches:
            for a in range(0, len(pdf), EXPLAIN_ROWS):
                part = pdf.iloc[a:a + EXPLAIN_ROWS]
                x = np.stack(part["_x"].to_list()).astype(float)
                phi = np.zeros_like(x)
                for p, s in zip(paths, sc):
                    path_shap(x, p, phi, s)
                yield pd.DataFrame({id_col: np.repeat(part[id_col].to_numpy(), len(nm)),
                                    "feature": nm * len(part), "feature_value": x.ravel(),
                                    "shap_value": phi.ravel()})

    out = arr.mapInPandas(explain, schema)
    base_df = spark.createDataFrame([(base,)], "expected_value double")
    return out, base_df


# ---------------------------------------------------------------------------------------
# ops 54-55: local explanations and dependence


def top_contributions(attributions: DataFrame, id_col: str, n: int = 10) -> DataFrame:
    """Top ``n`` features of every row by |contribution| (ties by feature name); groups are
    one row's features, so the window is bounded by the feature count."""
    w = Window.partitionBy(id_col).orderBy(F.abs("shap_value").desc(), "feature")
    return (attributions.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n))


def dependence(attributions: DataFrame, feature: str, id_col: str) -> DataFrame:
    """(id, feature_value, shap_value) of one feature."""
    return attributions.where(F.col("feature") == feature).select(id_col, "feature_value", "shap_value")


def contribution_totals(attributions: DataFrame, base: DataFrame, id_col: str) -> DataFrame:
    """Per row: base + sum of contributions (equals the explained model output)."""
    b = base.first()["expected_value"]
    return attributions.groupBy(id_col).agg((F.lit(b) + F.sum("shap_value")).alias("explained_output"))

