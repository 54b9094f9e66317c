"""Month states: merged profiles against exact numbers, replaced months, pruned months."""

import random

from pyspark.sql import functions as F

from basketlens.operators import sketches as SK


def rows(months, n=4000, seed=1):
    rng = random.Random(seed)
    return [(f"2024-{m:02d}-{1 + i % 28:02d} 10:00:00", rng.gauss(m, 2) if i % 10 else None, f"c{rng.randint(0, 900)}") for m in months for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "t string, x double, s string").withColumn("t", F.col("t").cast("timestamp"))


def test_any_month_range_merges_within_the_stated_errors(spark, tmp_dir):
    data = rows(range(1, 7))
    SK.write_states(SK.month_states(frame(spark, data), "t", ["x"], ["s"]), f"{tmp_dir}/st")
    for first, last in (("2024-01", "2024-06"), ("2024-02", "2024-03"), ("2024-05", None)):
        got = {r["column"]: r for r in SK.merged_profile(SK.read_states(spark, f"{tmp_dir}/st", first, last), [0.1, 0.5, 0.9]).collect()}
        mine = [r for r in data if first <= r[0][:7] <= (last or "9")]
        xs = sorted(r[1] for r in mine if r[1] is not None)
        assert got["x"]["rows"] == len(mine) and abs(got["x"]["missing_pct"] - 10) < 1e-9
        assert (got["x"]["least"], got["x"]["greatest"]) == (xs[0], xs[-1]) and abs(got["x"]["mean"] - sum(xs) / len(xs)) < 1e-9
        for i, p in enumerate((0.1, 0.5, 0.9)):
            rank = sum(x <= got["x"][f"approx_q_{i}"] for x in xs) / len(xs)
            assert abs(rank - p) <= SK.rank_bound()
        for c, exact in (("x", len(set(xs))), ("s", len({r[2] for r in mine}))):
            assert abs(got[c]["approx_distinct"] - exact) <= SK.distinct_bound() * exact
        assert got["s"]["mean"] is None and got["s"]["approx_q_0"] is None


def test_replacing_one_month_equals_a_rebuild(spark, tmp_dir):
    old, new = rows([1, 2, 3], 300), rows([2], 500, seed=9)
    SK.write_states(SK.month_states(frame(spark, old), "t", ["x"], ["s"]), f"{tmp_dir}/a")
    SK.write_states(SK.month_states(frame(spark, new), "t", ["x"], ["s"]), f"{tmp_dir}/a")
    whole = [r for r in old if r[0][:7] != "2024-02"] + new
    SK.write_states(SK.month_states(frame(spark, whole), "t", ["x"], ["s"]), f"{tmp_dir}/b")
    a, b = (sorted((r["column"], r["month"], r["rows"], r["valid"], r["least"], r["greatest"]) for r in SK.read_states(spark, f"{tmp_dir}/{p}").collect()) for p in "ab")
    assert a == b and len(a) == 6
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_months_outside_the_range_are_not_read(spark, tmp_dir):
    SK.write_states(SK.month_states(frame(spark, rows([1, 2, 3], 50)), "t", ["x"]), f"{tmp_dir}/c")
    plan = SK.read_states(spark, f"{tmp_dir}/c", "2024-03", "2024-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_states_without_values_or_rows(spark, tmp_dir):
    empty = SK.month_states(frame(spark, []), "t", ["x"], ["s"])
    assert SK.merged_profile(empty).count() == 0
    nothing = frame(spark, [(None, None, None), (None, float("nan"), None)])
    got = {r["column"]: r for r in SK.merged_profile(SK.month_states(nothing, "t", ["x"], ["s"])).collect()}
    assert got["x"]["rows"] == 2 and got["x"]["missing_pct"] == 100 and got["x"]["mean"] is None and got["x"]["approx_q_0"] is None
    assert got["s"]["approx_distinct"] == 0
