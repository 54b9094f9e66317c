"""Exact small-sample p-values against enumeration of all orders."""

from itertools import combinations

import pytest

from basketlens.functions import stats as ST
from basketlens.operators import stattests as S


def _orders(n, m):
    """Of every order of n and m distinct values: U of the first sample and the two-sample D
    (in units of 1 / (n m))."""
    for first in combinations(range(n + m), n):
        u = sum(p - k for k, p in enumerate(first))
        gap, a = 0, 0
        for p in range(n + m):
            a += p in first
            gap = max(gap, abs(a * m - (p + 1 - a) * n))
        yield u, gap


@pytest.mark.parametrize("n, m", [(1, 1), (1, 6), (2, 3), (4, 4), (3, 7), (5, 6)])
def test_p_values_equal_enumeration(n, m):
    told = list(_orders(n, m))
    assert ST.mann_whitney_counts(n, m) == [sum(u == x for u, _ in told) for x in range(n * m + 1)]
    for x in range(n * m + 1):
        upper = sum(u >= max(x, n * m - x) for u, _ in told)
        assert ST.mann_whitney_exact(float(x), n, m) == pytest.approx(min(1.0, 2 * upper / len(told)), abs=1e-14)
    for x in range(n * m + 1):
        share = sum(g >= x for _, g in told) / len(told)
        assert ST.kolmogorov_exact(x / (n * m), n, m) == pytest.approx(share, abs=1e-12)
        assert ST.kolmogorov_exact(x / (n * m), m, n) == pytest.approx(share, abs=1e-12)


def test_exact_values_meet_the_approximations():
    assert ST.kolmogorov_exact(0.05, 1500, 2100) == pytest.approx(ST.kolmogorov_sf((1500 * 2100 / 3600) ** 0.5 * 0.05), rel=0.1)
    assert ST.kolmogorov_exact(0.9, 400, 300) < 1e-100  # tiny tails keep their size
    assert 0 < ST.mann_whitney_exact(0.0, 8, 1000) < 1e-15


def test_switch_over_by_size_and_ties(spark):
    def p(rows, **options):
        df = spark.createDataFrame(rows, "v double, g boolean")
        return S.mann_whitney_pvalue(S.mann_whitney_statistics(df, "v", "g"), **options).first()["p_value"]
    plain = [(float(v), v in (1, 2, 4)) for v in range(1, 10)]
    assert p(plain) == pytest.approx(2 * 2 / 84)  # U = 1: {1,2,3} and {1,2,4} of 84 choices
    assert p(plain, exact_rows=2) == p(plain, exact_cells=17) == p(plain, exact_rows=0) != p(plain)
    tied = [(v if v < 9 else 8.0, g) for v, g in plain]
    assert p(tied) == p(tied, exact_rows=0)
    assert p([(1.0, True)]) == 1.0  # one side is empty
    assert p([(1.0, i < 3) for i in range(30)]) == 1.0  # all are tied


def test_drift_takes_exact_p_values_by_option(spark):
    ref = spark.createDataFrame([(float(v), "a") for v in range(6)], "x double, c string")
    cur = spark.createDataFrame([(v + 3.5, "a") for v in range(5)], "x double, c string")
    told = [{r["feature"]: r for r in S.feature_drift(ref, cur, ["x"], ["c"], exact_rows=e).collect()} for e in (0, 5, S.EXACT_KS_ROWS)]
    d = told[0]["x"]["statistic"]
    exact = sum(g >= round(d * 30) for _, g in _orders(6, 5)) / 462
    assert told[0]["x"]["p_value"] == told[1]["x"]["p_value"] == pytest.approx(ST.kolmogorov_sf((30 / 11) ** 0.5 * d))
    assert told[2]["x"]["p_value"] == pytest.approx(exact)
    assert told[2]["c"]["p_value"] == told[0]["c"]["p_value"]
