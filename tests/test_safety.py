"""Sinks that must not lose rows, sessions on a cluster, nulls, and exactness switches."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from basketlens.functions import stats
from basketlens.functions.columns import risk_band
from basketlens.operators import explain as X, metrics as M, ml as ML, quality as Q
from basketlens.session import get_spark
from basketlens.sources import adapter as A, io as IO

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def table(spark, tmp_dir):
    name = "keep_" + os.path.basename(tmp_dir).replace("-", "_")
    spark.range(100).withColumn("p", F.col("id") % 3).write.partitionBy("p").option("path", f"{tmp_dir}/t").saveAsTable(name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_replace_may_read_its_own_target(spark, table):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert IO.replace_into(spark.table(table).where("id < 60 and p <> 2"), table) == 40
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert sorted(r.id for r in spark.table(table).collect()) == [i for i in range(60) if i % 3 != 2]


def test_failing_replace_keeps_the_rows(spark, table):
    broken = spark.table(table).withColumn("id", F.when(F.col("id") > 70, F.raise_error(F.lit("half way"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="half way"):
        IO.replace_into(broken, table)
    assert spark.table(table).count() == 100


def test_get_spark_keeps_what_the_session_has(spark):
    again = get_spark()
    assert again.sparkContext.master == "local[4]"
    assert again.conf.get("spark.sql.shuffle.partitions") == "8"


def test_submit_settings_survive(tmp_dir):
    script = f"{tmp_dir}/job.py"
    with open(script, "w") as f:
        f.write(f"import sys; sys.path.insert(0, {ROOT!r})\n"
                "from basketlens.session import get_spark\ns = get_spark()\n"
                "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.adaptive.enabled'))\n")
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_SUBMIT")}
    out = subprocess.run([sys.executable, "-m", "pyspark.find_spark_home"], capture_output=True, text=True, env=env).stdout.strip()
    got = subprocess.run([f"{out}/bin/spark-submit", "--master", "local[2]", "--conf", "spark.sql.shuffle.partitions=4000",
                          "--conf", "spark.ui.enabled=false", "--conf", "spark.sql.adaptive.enabled=false", script],
                         capture_output=True, text=True, cwd=tmp_dir, env=env | {"PYSPARK_PYTHON": sys.executable}, timeout=180)
    assert "GOT local[2] 4000 false" in got.stdout, got.stderr[-2000:]


def test_python_stages_run_from_another_folder(tmp_dir):
    script = f"{tmp_dir}/elsewhere.py"
    names = ["premium_aov_test", "revenue_seasonality_test", "revenue_stationarity_by_category"]
    with open(script, "w") as f:
        f.write(f"import sys; sys.path.insert(0, {ROOT!r})\n"
                "from pyspark.sql import SparkSession\nimport __spark_entry__ as e\n"
                "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
                f"q = e.queries()\nfor n in {names!r}: print('ROWS', n, q[n](s, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    got = subprocess.run([sys.executable, script], capture_output=True, text=True, cwd=tmp_dir, env=env, timeout=300)
    assert got.stdout.count("ROWS") == len(names), got.stderr[-2000:]


def test_null_scores_and_bands(spark):
    df = spark.createDataFrame([(1, 0.9), (1, None), (0, None), (0, 0.1)], "label int, score double")
    for r in M.threshold_curve(df).where("threshold > 0.4 and threshold < 0.6").collect():
        assert (r.precision, r.recall) == (1.0, 0.5)
    c = M.confusion_counts(df).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (1, 0, 1, 2)
    bands = M.score_bands(df.withColumnRenamed("score", "churn_probability"))
    assert {r.risk_level for r in bands.collect()} == {"High", "Low", None}
    s = M.band_summary(bands).first()
    assert (s.total, s.high_risk, s.low_risk, s.not_scored) == (4, 1, 1, 2)
    nan = spark.range(1).select(risk_band(F.lit(float("nan"))).alias("b")).first()
    assert nan.b is None


def test_line_without_product_stays(spark, tmp_dir):
    src = "/root/testdata/sf0.001"
    for t in ("lineitem", "orders", "part"):
        df = spark.read.parquet(f"{src}/{t}.parquet")
        (df.where("p_partkey > 20") if t == "part" else df).write.parquet(f"{tmp_dir}/{t}.parquet")
    with_, without = A.transactions(spark, tmp_dir), A.transactions(spark, tmp_dir, with_category=False)
    assert with_.count() == without.count()
    assert with_.where("category is null").count() == without.where("product_id <= 20").count() > 0


def test_orphans_count_rows_of_hot_keys(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,)] * 3 + [(None,)] * 4, "k int")
    parent = spark.createDataFrame([(2,)], "id int")
    assert Q.references("c", child, "k", "p", parent, "id").first().violations == 50
    assert Q.references("c", child.where("k = 2"), "k", "p", parent, "id").first().violations == 0


def test_median_of_an_even_count(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (3.0, None), (4.0, 7), (None, 9), (float("nan"), 9)], "a double, b int")
    out = ML.MedianImputer(inputCols=["a", "b"], outputCols=["x", "y"]).fit(df).transform(df).collect()
    assert [r.x for r in out] == [1, 2, 3, 4, 2.5, 2.5] and out[2].y == 7


def test_auc_is_exact_beyond_a_thousand_scores(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 5000)
    s = rng.normal(y * 0.3, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "churn_label int, rawPrediction double")
    rank = np.argsort(np.argsort(s)) + 1
    pos = y.sum()
    exact = (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (5000 - pos))
    assert abs(ML._auc("churn_label").evaluate(df) - exact) < 1e-9
    assert ML._auc("churn_label").getNumBins() == 0
    assert BinaryClassificationEvaluator().getNumBins() > 0


def test_incomplete_gamma_says_when_it_fails():
    with pytest.raises(ArithmeticError):
        stats._gamma_p_series(1e12, 1e12)


def test_weighting_is_a_choice(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(0,)] * 30, "churn_label int")
    for weighting, want in ((None, (1.0, 1.0)), ("ratio", (3.0, 1.0)), ("balanced", (2.0, 40 / 60))):
        got = {r.churn_label: r.weight for r in ML.class_weights(df, weighting).collect()}
        assert np.allclose((got[1], got[0]), want)
    with pytest.raises(ValueError):
        ML.class_weights(df, "other")
    with pytest.raises(ValueError, match="random_forest"):
        ML.classifier("forest")


def test_elimination_covers_one_hot_columns(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(rng.normal()), float(rng.normal()), str(rng.choice(["x.y", "z"]))) for i in range(300)]
    rows = [(*r, int(r[1] + (r[3] == "z") * 2 + rng.normal() * 0.3 > 1)) for r in rows]
    df = spark.createDataFrame(rows, "customer_id int, a double, b double, cat string, churn_label int")
    got = ML.recursive_feature_elimination(df, ["a", "b"], ["cat"], 1, "logistic_regression", folds=3)
    assert got["n_features"] == [1, 2, 3, 4][: len(got["n_features"])] and "_sca_b" not in got["selected_features"][:1]
    assert any("cat" in f for f in got["selected_features"]) and max(got["cv_scores_mean"]) > 0.9
    tuned = ML.tune_churn_model(df, ["a", "b"], ["cat"], "logistic_regression", n_trials=2, folds=3)
    assert len(tuned["cv_scores"]) == 2 and tuned["best_params"] in tuned["params"]


def test_attributions_with_dotted_categories(spark):
    rows = [(i, float(i % 7), "x.y" if i % 2 else "_imp_", i % 3 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_id int, a double, cat string, l boolean").withColumn("churn_label", F.col("l").cast("int")).drop("l")
    model = ML.fit_churn_model(df, ["a"], ["cat"], "logistic_regression")
    attr, base = X.linear_model_attributions(model, df, "customer_id")
    total = X.contribution_totals(attr, base, "customer_id").join(ML.score(model, df), "customer_id").toPandas()
    assert np.allclose(total.explained_output, np.log(total.score / (1 - total.score)), atol=1e-6)


def brute_shap(tree, x):
    """Shapley values by subsets: a split on an absent feature averages by cover."""
    import itertools
    import math
    features = sorted({int(f) for f in tree["feature"] if f >= 0})

    def value(node, known):
        if tree["left"][node] < 0:
            return tree["value"][node]
        f, (a, b) = int(tree["feature"][node]), (tree["left"][node], tree["right"][node])
        if f in known:
            cats = tree["categories"][node]
            left = x[f] in cats if cats is not None else x[f] <= tree["threshold"][node]
            return value(a if left else b, known)
        return (tree["cover"][a] * value(a, known) + tree["cover"][b] * value(b, known)) / tree["cover"][node]

    phi = np.zeros(len(x))
    for f in features:
        rest = [g for g in features if g != f]
        for size in range(len(rest) + 1):
            for subset in itertools.combinations(rest, size):
                weight = math.factorial(size) * math.factorial(len(features) - size - 1) / math.factorial(len(features))
                phi[f] += weight * (value(0, {*subset, f}) - value(0, set(subset)))
    return phi


def random_tree(rng, depth, n_features):
    t = {k: [] for k in ("left", "right", "feature", "threshold", "categories", "value", "cover")}

    def make(d, cover):
        i = len(t["left"])
        for k in t:
            t[k].append(None)
        t["cover"][i], t["value"][i], t["threshold"][i] = cover, rng.normal(), rng.normal()
        if d == 0 or cover < 2:
            t["left"][i] = t["right"][i] = t["feature"][i] = -1
            return i
        t["feature"][i] = int(rng.integers(n_features))
        t["categories"][i] = {float(c) for c in rng.integers(0, 4, 2)} if t["feature"][i] == 0 else None
        part = float(max(1, int(cover * rng.uniform(0.1, 0.9))))
        t["left"][i] = make(d - 1, part)
        t["right"][i] = make(d - 1, cover - part)
        return i

    make(depth, 1000.0)
    return {**{k: v if k == "categories" else np.array(v) for k, v in t.items()}, "root": 0}


def test_tree_attributions_equal_subset_enumeration():
    rng = np.random.default_rng(2)
    for _ in range(12):
        tree = random_tree(rng, int(rng.integers(1, 6)), 5)
        x = rng.normal(size=(8, 5))
        x[:, 0] = rng.integers(0, 4, 8)
        phi = np.zeros_like(x)
        X.path_shap(x, X.leaf_paths(tree), phi, 1.0)
        assert np.allclose(phi, [brute_shap(tree, r) for r in x], atol=1e-10)
