"""Selection by histogram refinement against numpy and against itself in parts."""

import math
import random

import numpy as np
import pytest

from basketlens.operators import selection as S
from basketlens.operators.eda import column_profile, iqr_outliers

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns(n=1500, seed=4):
    rng = random.Random(seed)
    return {
        "normal": [rng.gauss(0, 1) for _ in range(n)],
        "lognormal": [math.exp(rng.gauss(0, 6)) for _ in range(n)],
        "ties": [float(rng.choice([1, 1, 1, 2, 9])) for _ in range(n)],
        "huge": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-30, 30) for _ in range(n)],
        "extreme": [rng.choice([-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324]) for _ in range(n)],
        "gaps": [None if i % 3 == 0 else float("nan") if i % 5 == 0 else float(i) for i in range(n)],
        "constant": [7.5] * n,
        "empty": [None] * n,
        "whole": [float(rng.randint(0, 50)) for _ in range(n)],
    }


def test_quantiles_of_all_columns_match_numpy(spark):
    data = columns()
    names = list(data)
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"`{c}` double" for c in names)).repartition(5)
    got = S.exact_quantiles_of(df, names, PROBS)
    for c in names:
        v = np.array([x for x in data[c] if x is not None and not math.isnan(x)])
        assert got[c].n == len(v)
        if len(v):
            v.sort()
            for q, x in zip(PROBS, got[c].values):
                h = (len(v) - 1) * q
                a, b = v[math.floor(h)], v[math.ceil(h)]
                assert x == a + (b - a) * (h - math.floor(h))
        else:
            assert got[c].values == [None] * len(PROBS)


@pytest.mark.parametrize("bins", [2, 3, 64])
def test_fewer_bins_take_more_rounds_to_the_same_numbers(spark, monkeypatch, bins):
    monkeypatch.setattr(S, "BINS", bins)
    rows = [(float(i * i % 101), float(-i)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = S.exact_quantiles_of(df, ["a", "b"], [0.25, 0.5])
    assert got["a"].values == np.percentile([r[0] for r in rows], [25, 50]).tolist()
    assert got["b"].values == np.percentile([r[1] for r in rows], [25, 50]).tolist()


def test_infinite_values_have_ranks(spark):
    df = spark.createDataFrame([(x,) for x in (float("-inf"), 1.0, 2.0, 3.0, float("inf"))], "a double")
    assert S.exact_quantiles_of(df, ["a"], [0.25, 0.5, 0.75])["a"].values == [1.0, 2.0, 3.0]


def test_rounds_are_few_and_shuffle_bins(spark, monkeypatch):
    rounds = []
    real = S._count
    monkeypatch.setattr(S, "_count", lambda df, ranges: rounds.append(len(ranges)) or real(df, ranges))
    df = spark.range(200_000).selectExpr("cast(id as double) * 1.5 as a", "cast(hash(id) as double) as b")
    S.exact_quantiles_of(df, ["a", "b"], [0.25, 0.5, 0.75])
    assert len(rounds) <= 2 and max(rounds) <= 6 * 2


def test_profile_of_an_empty_table_and_odd_names(spark):
    none = spark.createDataFrame([], "`a.b` double, s string")
    got = {r["column"]: r for r in column_profile(none, ["a.b", "s"]).collect()}
    assert got["a.b"]["median"] is None and got["s"]["unique_count"] == 0 and got["s"]["missing_pct"] is None
    some = spark.createDataFrame([(1.0, "x"), (None, None), (3.0, "x")], "`a.b` double, s string")
    got = {r["column"]: r for r in column_profile(some, ["a.b", "s"]).collect()}
    assert got["a.b"]["median"] == 2.0 and got["a.b"]["unique_count"] == 2 and got["s"]["unique_count"] == 1
    assert iqr_outliers(some, "a.b").first()["q1"] == 1.5
