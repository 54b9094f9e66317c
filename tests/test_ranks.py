"""Distributed ranks, running sums and quantiles against brute force, including a key that
holds a third of all rows and different partition counts."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from basketlens.operators.ranks import exact_quantiles, running_totals, tie_average_ranks


def _skewed(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))
    val = rng.integers(0, 200, n).astype(float)
    w = rng.integers(0, 5, n)
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": val, "w": w})
    return spark.createDataFrame(pdf), pdf


def test_running_totals_match_bruteforce(spark):
    df, pdf = _skewed(spark)
    out = running_totals(df, ["v", "id"], by=["k"], sums=["w"]).toPandas().sort_values("id")
    exp = pdf.sort_values(["k", "v", "id"]).copy()
    exp["rank"] = exp.groupby("k").cumcount() + 1
    exp["cum"] = exp.groupby("k")["w"].cumsum()
    exp["n"] = exp.groupby("k")["v"].transform("size")
    exp = exp.sort_values("id")
    assert (out["_rank"].to_numpy() == exp["rank"].to_numpy()).all()
    assert (out["_cum_w"].to_numpy() == exp["cum"].to_numpy()).all()
    assert (out["_n"].to_numpy() == exp["n"].to_numpy()).all()


def test_partition_count_independence(spark):
    df, _ = _skewed(spark, 2000, 3)
    a = running_totals(df, ["v", "id"], partitions=1).select("id", "_rank").toPandas()
    b = running_totals(df, ["v", "id"], partitions=16).select("id", "_rank").toPandas()
    m = a.merge(b, on="id")
    assert (m["_rank_x"] == m["_rank_y"]).all()
    assert sorted(m["_rank_x"]) == list(range(1, 2001))


def test_exact_quantiles_linear(spark):
    df, pdf = _skewed(spark)
    q = exact_quantiles(df, "v", [0.25, 0.5, 0.75], by=["k"]).toPandas().set_index("k")
    for k, g in pdf.groupby("k"):
        exp = np.percentile(g["v"], [25, 50, 75])
        got = q.loc[k, ["q_0", "q_1", "q_2"]].to_numpy(dtype=float)
        assert np.allclose(got, exp)


def test_quantile_example_from_survey(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "v double")
    q = exact_quantiles(df, "v", [0.25]).first()
    assert q["q_0"] == 1.75


def test_tie_average_ranks(spark):
    df, pdf = _skewed(spark, 500, 11)
    r = tie_average_ranks(df, "v").toPandas().set_index("v")["avg_rank"]
    exp = pdf["v"].rank(method="average")
    for v, ar in zip(pdf["v"], exp):
        assert r.loc[v] == ar
