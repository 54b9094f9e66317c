"""Model preparation, training and tuning on Spark ML (ops 35-38, 42-43).

* Stratified split and folds: per-label exact ranks of a seeded hash (distributed ranking,
  no single-partition window), so class shares are kept exactly.
* Scaling divides by the population standard deviation (zero variance -> 0), as the
  original does; MLlib's StandardScaler uses the sample one, so a small Estimator is used.
* MLlib GBT stands in for one boosted-tree library of the original, the leaf-wise
  second-order boosting of ``boosting`` for the other; scores differ.
* Class weights are a parameter: "ratio" (positives count n_neg / n_pos), "balanced"
  (n / (2 n_class)) or None; each function's default is the original's choice.
* ROC AUC in searches is exact (no score bins).
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, parallel_map
from .boosting import LeafwiseBoostedClassifier
from .metrics import classification_metrics
from .ranks import running_totals
from .selection import exact_quantiles_of

CID = "customer_id"
LABEL = "churn_label"

TASK_ROWS = 50_000  # rows that one task of a fit's pass reads, about

MODEL_TYPES = ("xgboost", "lightgbm", "random_forest", "logistic_regression")


# ---------------------------------------------------------------------------------------
# op 35: stratified split / folds


def _hash_rank(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    h = F.xxhash64(F.col(id_col).cast("string"), F.lit(seed))
    return running_totals(df.withColumn("_h", h), ["_h", id_col], by=[label], label="strat")


def stratified_split(df: DataFrame, label: str = LABEL, test_size: float = 0.2, seed: int = 42,
                     id_col: str = CID) -> DataFrame:
    """Add ``split`` ('train' / 'test'): per label class the round(test_size * n_c) rows with
    the smallest seeded hash go to test, so both sides keep the class shares."""
    r = _hash_rank(df, label, id_col, seed)
    n_test = F.floor(F.col("_n") * F.lit(float(test_size)) + 0.5)
    out = r.withColumn("split", F.when(F.col("_rank") <= n_test, "test").otherwise("train"))
    return out.drop("_h", "_rank", "_n")


def stratified_folds(df: DataFrame, k: int = 5, label: str = LABEL, seed: int = 42,
                     id_col: str = CID, fold_col: str = "fold") -> DataFrame:
    """Add an integer ``fold`` in [0, k) dealt round-robin in hash order within each class."""
    r = _hash_rank(df, label, id_col, seed)
    return r.withColumn(fold_col, ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank", "_n")


def written_split(df: DataFrame, label: str = LABEL, test_size: float = 0.2, seed: int = 42, id_col: str = CID,
                  tag: str = "split") -> DataFrame:
    """The stratified split, written once for fits that read it many times. A table of more
    than TASK_ROWS rows is dealt by id over tasks of about that size: the few files that a
    coalesced shuffle leaves would give every pass as few tasks."""
    tasks = -(-df.count() // TASK_ROWS)
    split = stratified_split(df, label, test_size, seed, id_col)
    return materialize(split.repartition(tasks, id_col) if tasks > 1 else split, tag)


# ---------------------------------------------------------------------------------------
# op 36: population standard scaling


class _ScalerParams(HasInputCols, HasOutputCols):
    pass


class PopulationStandardScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std per column; zero variance -> 0. Fit is one aggregate."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationStandardScalerModel":
        cols = self.getInputCols()
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        means = [float(row[f"m{i}"] or 0.0) for i in range(len(cols))]
        stds = [float(row[f"s{i}"] or 0.0) for i in range(len(cols))]
        m = PopulationStandardScalerModel(inputCols=cols, outputCols=self.getOutputCols(),
                                          means=means, stds=stds)
        return self._copyValues(m)


class PopulationStandardScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", typeConverter=TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population stds", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, outs = self.getInputCols(), self.getOutputCols()
        means, stds = self.getOrDefault(self.means), self.getOrDefault(self.stds)
        new = {}
        for c, o, m, s in zip(cols, outs, means, stds):
            x = F.col(c).cast("double")
            new[o] = F.lit(0.0) if s == 0 else (x - F.lit(m)) / F.lit(s)
        return df.withColumns(new)


def scale_features(train: DataFrame, test: DataFrame, columns: Sequence[str]):
    """Fit on ``train``, apply to both; returns (train_scaled, test_scaled, model)."""
    model = PopulationStandardScaler(inputCols=list(columns), outputCols=list(columns)).fit(train)
    return model.transform(train), model.transform(test), model


# ---------------------------------------------------------------------------------------
# op 37: preprocessing pipeline


class MedianImputer(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls and NaN with the column's exact median (even count: the midpoint; a column
    without values: 0). All medians come from one selection by histogram refinement."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        cols = self.getInputCols()
        found = exact_quantiles_of(df, cols, [0.5])
        fills = [float(found[c].values[0] or 0.0) for c in cols]
        return self._copyValues(MedianImputerModel(inputCols=cols, outputCols=self.getOutputCols(), fills=fills))


class MedianImputerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "fill values", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({o: F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(v))
                               .otherwise(F.col(c).cast("double"))
                               for c, o, v in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.fills))})


class ModeImputer(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls with the most frequent value (ties -> smallest), per string column."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ModeImputerModel":
        from .features import modes
        cols = self.getInputCols()
        keyed = df.select(F.lit(0).alias("_k"), *cols)
        row = modes(keyed, "_k", {c: c for c in cols}).first()
        fills = [(row[c] if row is not None and row[c] is not None else "unknown") for c in cols]
        return self._copyValues(ModeImputerModel(inputCols=cols, outputCols=self.getOutputCols(),
                                                 fills=fills))


class ModeImputerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "fill values", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.getOrDefault(self.fills)
        return df.withColumns({o: F.coalesce(F.col(c).cast("string"), F.lit(v))
                               for c, o, v in zip(self.getInputCols(), self.getOutputCols(), fills)})


def preprocessing_stages(numeric: Sequence[str], categorical: Sequence[str],
                         features_col: str = "features") -> list:
    """Median impute + population scaling for numerics; most-frequent impute + one-hot for
    categoricals (unseen categories encode as all zeros); assembled into ``features_col``."""
    numeric, categorical = list(numeric), list(categorical)
    stages = []
    assembled = []
    if numeric:
        imp = [f"_imp_{c}" for c in numeric]
        sca = [f"_sca_{c}" for c in numeric]
        stages.append(MedianImputer(inputCols=numeric, outputCols=imp))
        stages.append(PopulationStandardScaler(inputCols=imp, outputCols=sca))
        assembled += sca
    if categorical:
        fil = [f"_fil_{c}" for c in categorical]
        idx = [f"_idx_{c}" for c in categorical]
        ohe = [f"_ohe_{c}" for c in categorical]
        stages.append(ModeImputer(inputCols=categorical, outputCols=fil))
        stages.append(StringIndexer(inputCols=fil, outputCols=idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
        assembled += ohe
    stages.append(VectorAssembler(inputCols=assembled, outputCol=features_col))
    return stages


def preprocessing_pipeline(numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    return Pipeline(stages=preprocessing_stages(numeric, categorical))


# ---------------------------------------------------------------------------------------
# op 38: churn classifier


# Class weighting of a training run by family.
DEFAULT_WEIGHTING = {"xgboost": "ratio", "lightgbm": "balanced", "random_forest": "balanced",
                     "logistic_regression": "balanced"}
BY_FAMILY = "by family"  # marks a weighting that follows the family's default


def _check_family(model_type: str) -> None:
    if model_type not in MODEL_TYPES:
        raise ValueError(f"no classifier family {model_type!r}; there are {', '.join(MODEL_TYPES)}")


def class_weights(df: DataFrame, weighting: str | None, label: str = LABEL) -> DataFrame:
    """Add ``weight`` by the given weighting. Counts are two scalars from one aggregate."""
    return _weighted(df, weighting, label)[0]


def _weighted(df: DataFrame, weighting: str | None, label: str = LABEL):
    row = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count(F.lit(1)).alias("n")).first()
    pos, n = int(row["p"]), int(row["n"])
    neg = n - pos
    if weighting is None:
        w_pos = w_neg = 1.0
    elif weighting == "ratio":
        w_pos, w_neg = (neg / pos if pos else 1.0), 1.0
    elif weighting == "balanced":
        w_pos = n / (2.0 * pos) if pos else 1.0
        w_neg = n / (2.0 * neg) if neg else 1.0
    else:
        raise ValueError("weighting must be None, 'ratio' or 'balanced'")
    total = w_pos * pos + w_neg * neg
    out = df.withColumn("weight", F.when(F.col(label) == 1, F.lit(w_pos)).otherwise(F.lit(w_neg)))
    return out, total


def _weighting(weighting: str | None, model_type: str) -> str | None:
    return DEFAULT_WEIGHTING[model_type] if weighting == BY_FAMILY else weighting


def inverse_c_to_reg(c: float, total_weight: float) -> float:
    """L2 strength C (loss summed, 0.5 ||w||^2 penalty) as Spark's regParam (loss averaged)."""
    return 1.0 / (c * max(total_weight, 1.0))


def classifier(model_type: str, label: str = LABEL, seed: int = 42, total_weight: float = 1.0,
               **overrides):
    """Spark ML classifier for a model family (100 trees, depth 5, step 0.1 for boosting;
    logistic regression with L2 strength C = 1 on the already scaled features)."""
    _check_family(model_type)
    common = dict(featuresCol="features", labelCol=label, weightCol="weight")
    if model_type == "xgboost":
        params = dict(maxIter=100, maxDepth=5, stepSize=0.1, seed=seed)
        params.update(overrides)
        return GBTClassifier(**common, **params)
    if model_type == "lightgbm":
        params = dict(maxIter=100, maxDepth=5, numLeaves=31, stepSize=0.1, seed=seed)
        params.update(overrides)
        return LeafwiseBoostedClassifier(**common, **params)
    if model_type == "random_forest":
        params = dict(numTrees=100, maxDepth=5, seed=seed)
        params.update(overrides)
        return RandomForestClassifier(**common, **params)
    if model_type == "logistic_regression":
        c = overrides.pop("C", 1.0)
        params = dict(maxIter=1000, tol=1e-4, regParam=inverse_c_to_reg(c, total_weight), elasticNetParam=0.0,
                      standardization=False)
        params.update(overrides)
        return LogisticRegression(**common, **params)
    raise AssertionError(model_type)


def churn_probability(scored: DataFrame, out: str = "score") -> DataFrame:
    return scored.withColumn(out, vector_to_array("probability").getItem(1))


def train_churn_model(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                      model_type: str = "xgboost", label: str = LABEL, seed: int = 42,
                      id_col: str = CID, weighting: str | None = BY_FAMILY, **overrides):
    """Inner stratified 80/20 validation fit and metrics, then a refit on all rows. The
    split is written once and every stage reads the copy.

    Returns (PipelineModel fitted on all rows, one-row validation metrics DataFrame).
    """
    _check_family(model_type)
    split = written_split(df, label, 0.2, seed, id_col)
    fit = dict(model_type=model_type, label=label, seed=seed, weighting=weighting, **overrides)
    val_model = fit_churn_model(split.where(F.col("split") == "train"), numeric, categorical, **fit)
    scored = churn_probability(val_model.transform(split.where(F.col("split") == "test"))).select(
        F.col(label).alias("label"), "score")
    val_metrics = classification_metrics(scored)
    return fit_churn_model(split.drop("split"), numeric, categorical, **fit), val_metrics


def fit_churn_model(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                    model_type: str = "xgboost", label: str = LABEL, seed: int = 42,
                    weighting: str | None = BY_FAMILY, prep: PipelineModel | None = None, **overrides):
    """One fit of preprocessing + classifier on ``df`` (no inner validation);
    ``weighting=None`` is the plain unweighted fit. ``prep`` is a preparation already fitted
    on ``df`` (weights do not enter it), so that fits of several families share one."""
    _check_family(model_type)
    data, w = _weighted(df, _weighting(weighting, model_type), label)
    return Pipeline(stages=([prep] if prep else preprocessing_stages(numeric, categorical))
                    + [classifier(model_type, label, seed, w, **dict(overrides))]).fit(data)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (CID,)) -> DataFrame:
    """Probability of class 1 as ``score`` next to the kept columns."""
    return churn_probability(model.transform(df)).select(*keep, "score")


# ---------------------------------------------------------------------------------------
# op 42: randomized hyper-parameter search

# Search grids per family (Spark ML parameter names).
SEARCH_GRIDS = {
    "xgboost": {"maxIter": [50, 100, 150, 200], "maxDepth": [3, 5, 7, 9],
                "stepSize": [0.01, 0.05, 0.1, 0.2], "subsamplingRate": [0.6, 0.8, 1.0],
                "featureSubsetStrategy": ["0.6", "0.8", "all"]},
    "lightgbm": {"maxIter": [50, 100, 150, 200], "maxDepth": [3, 5, 7, 9],
                 "stepSize": [0.01, 0.05, 0.1, 0.2], "subsamplingRate": [0.6, 0.8, 1.0]},
    "random_forest": {"numTrees": [50, 100, 150, 200], "maxDepth": [3, 5, 7, 10],
                      # stands for the least rows to split a node (2, 5, 10): MLlib bounds
                      # the rows of each child instead
                      "minInstancesPerNode": [1, 2, 5]},
    "logistic_regression": {"C": [0.01, 0.1, 1.0, 10.0]},
}


def _auc(label: str) -> BinaryClassificationEvaluator:
    """Exact ROC AUC: no binning of the scores."""
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)


def _prepared(data: DataFrame, numeric, categorical, label: str, tag: str, prep: PipelineModel | None = None):
    """Features, label and weight of ``data``, written once; fits the preparation if none is
    given. Returns (frame, preparation)."""
    prep = prep or preprocessing_pipeline(numeric, categorical).fit(data)
    keep = [c for c in (label, "weight", "fold") if c in data.columns]
    return materialize(prep.transform(data).select("features", *keep), tag), prep


def tune_churn_model(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                     model_type: str = "xgboost", n_trials: int = 30, folds: int = 5,
                     label: str = LABEL, seed: int = 42, id_col: str = CID, parallelism: int = 4,
                     grid: dict | None = None, weighting: str | None = None) -> dict:
    """Random search: ``n_trials`` seeded draws from the grid, k-fold ROC AUC on stratified
    folds, best model refit on all rows. Without ``weighting`` the fits are unweighted.

    Preparation and class weights are fitted on each fold's training rows only, once per
    fold; all draws then fit the prepared rows. Returns {best_params, best_cv_score,
    best_model, cv_scores, params}.
    """
    _check_family(model_type)
    weighting = _weighting(weighting, model_type)
    space = dict(grid or SEARCH_GRIDS[model_type])
    names = list(space)
    draws = [dict(zip(names, values)) for values in itertools.product(*space.values())]
    if n_trials < len(draws):
        draws = random.Random(seed).sample(draws, n_trials)
    data = materialize(stratified_folds(df, folds, label, seed, id_col), "folds")
    evaluator = _auc(label)
    sums = [0.0] * len(draws)
    for k in range(folds):
        train, total = _weighted(data.where(F.col("fold") != k), weighting, label)
        train, prep = _prepared(train, numeric, categorical, label, "tune-train")
        test, _ = _prepared(data.where(F.col("fold") == k), numeric, categorical, label, "tune-test", prep)

        def draw_score(draw, train=train, test=test, total=total):
            model = classifier(model_type, label, seed, total, **draw).fit(train)
            return evaluator.evaluate(model.transform(test))

        for i, auc in enumerate(parallel_map(draw_score, draws, parallelism)):
            sums[i] += auc / folds
    best = max(range(len(draws)), key=lambda i: (sums[i], -i))
    model = fit_churn_model(data.drop("fold"), numeric, categorical, model_type, label, seed, weighting, **draws[best])
    return {"best_params": draws[best], "best_cv_score": float(sums[best]), "best_model": model,
            "cv_scores": sums, "params": draws}


# ---------------------------------------------------------------------------------------
# op 43: recursive feature elimination


def slot_names(frame: DataFrame, column: str = "features") -> list[str]:
    """Names of an assembled vector's slots, in order."""
    attributes = frame.schema[column].metadata["ml_attr"]
    named = {a["idx"]: a["name"] for group in attributes["attrs"].values() for a in group}
    return [named.get(i, f"f{i}") for i in range(attributes["num_attrs"])]


def _eliminate(train: DataFrame, size: int, until: int, make, score=None) -> tuple[list[list[int]], list[float]]:
    """Fit, score, drop the least important slot, and again, down to ``until`` slots.
    Returns the slots kept at each size (largest first) and the scores."""
    current, kept, scores = list(range(size)), [], []
    while True:
        slicer = VectorSlicer(inputCol="features", outputCol="_kept", indices=current)
        model = make().setFeaturesCol("_kept").fit(slicer.transform(train))
        kept.append(list(current))
        if score:
            scores.append(score(model, slicer))
        if len(current) <= until:
            return kept, scores
        if hasattr(model, "featureImportances"):
            weight = list(model.featureImportances.toArray())
        else:
            weight = [abs(v) for v in model.coefficients.toArray()]
        current.pop(min(range(len(current)), key=lambda i: (weight[i], i)))


def recursive_feature_elimination(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                                  min_features: int = 20, model_type: str = "xgboost", folds: int = 5,
                                  label: str = LABEL, seed: int = 42, id_col: str = CID, parallelism: int = 5,
                                  weighting: str | None = None, **overrides) -> dict:
    """Eliminate slots of the prepared matrix (scaled numerics and one-hot columns) one at a
    time, least important first (tree importances or |coefficients|).

    Every fold runs its own elimination on its training rows and scores its own test rows;
    scores are averaged by size. The best size is the smallest with the highest mean, and a
    last elimination on all rows down to that size names the features. Boosted families
    default to 50 trees of depth 3.

    Returns {selected_features, optimal_n_features, n_features, cv_scores_mean, cv_scores_std}.
    """
    _check_family(model_type)
    weighting = _weighting(weighting, model_type)
    if model_type in ("xgboost", "lightgbm"):
        overrides = {"maxIter": 50, "maxDepth": 3, **overrides}
    folded, _ = _weighted(stratified_folds(df, folds, label, seed, id_col), None, label)
    data, prep = _prepared(folded, numeric, categorical, label, "rfe")
    names = slot_names(prep.transform(folded))
    until = max(1, min(min_features, len(names)))
    evaluator = _auc(label)

    def run(rows: DataFrame, until: int, score=None):
        rows, total = _weighted(rows.drop("weight"), weighting, label)
        return _eliminate(rows, len(names), until, lambda: classifier(model_type, label, seed, total, **overrides), score)

    def fold_scores(k):
        test = data.where(F.col("fold") == k)
        return run(data.where(F.col("fold") != k), until,
                   lambda model, slicer: evaluator.evaluate(model.transform(slicer.transform(test))))[1]

    by_fold = parallel_map(fold_scores, range(folds), parallelism)
    sizes = list(range(len(names), until - 1, -1))
    table = []
    for i, size in enumerate(sizes):
        aucs = [scores[i] for scores in by_fold]
        mean = sum(aucs) / folds
        table.append((size, mean, (sum((a - mean) ** 2 for a in aucs) / folds) ** 0.5))
    table.reverse()  # ascending feature count
    best = max(table, key=lambda r: (r[1], -r[0]))[0]
    selected = run(data, best)[0][-1]
    return {"selected_features": [names[i] for i in selected], "optimal_n_features": best,
            "n_features": [r[0] for r in table], "cv_scores_mean": [r[1] for r in table],
            "cv_scores_std": [r[2] for r in table]}
