"""What a frame is made of (joins) runs once, however many scans an operator needs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from basketlens.operators import eda as E
from basketlens.operators import features as FT
from basketlens.plans.catalog import load_all
from basketlens.sources import adapter as A


@pytest.fixture()
def counted(spark):
    """Frames that count how many rows are computed from them."""
    seen = spark.sparkContext.accumulator(0)

    def count(df):
        def add(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        return df.mapInArrow(add, df.schema)
    return count, seen


def shop(spark, path, customers=12, orders=60):
    """The tables of a small shop; some lines are returned, some parts are missing."""
    day = dt.datetime(2000, 1, 1)
    tables = {
        "nation": ([(0, "A"), (1, "B")], "n_nationkey int, n_name string"),
        "customer": ([(i, i % 2, 800.0 * i, "AUTO" if i % 3 else "HOME") for i in range(customers)],
                     "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(i, f"T{i % 3}") for i in range(5)], "p_partkey long, p_type string"),
        "orders": ([(i, i % (customers - 1), day + dt.timedelta(days=7 * i), f"{i % 4}-P") for i in range(orders)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(i, j, (i + j) % 6, 1.0 + (i + j) % 7, 10.0 + 3.5 * i, 0.05 * j, "R" if i % 5 == 0 else "N")
                      for i in range(orders) for j in range(1, 3)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string"),
        "events": ([(i, i % customers, day + dt.timedelta(hours=i), "view" if i % 2 else "click", 5.0 * i, f'{{"k": {i}}}') for i in range(50)],
                   "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path, 2 * orders


def numbers(spark, n=300):
    return spark.createDataFrame([(float(i * i % 97), f"s{i % 7}", None if i % 4 else i) for i in range(n)], "a double, s string, c long")


def test_a_profile_computes_its_input_once(spark, counted):
    count, seen = counted
    got = {r["column"]: r for r in E.column_profile(count(numbers(spark)), ["s", "a", "c"]).collect()}
    assert seen.value == 300
    assert [got[c]["unique_count"] for c in ("a", "s", "c")] == [49, 7, 75]
    assert got["c"]["missing_pct"] == 75 and got["s"]["mean"] is None and got["a"]["median"] is not None


def test_outliers_compute_their_input_once(spark, counted):
    count, seen = counted
    got = E.iqr_outliers(count(numbers(spark)), "a").first()
    assert seen.value == 300 and got["q1"] < got["q3"] and got["outlier_count"] == 0


@pytest.mark.parametrize("name", ["sketched_profile_within_bounds", "standard_scaled_model_data"])
def test_queries_join_the_lines_once(spark, counted, tmp_dir, monkeypatch, name):
    sf, lines = shop(spark, tmp_dir)
    count, seen = counted
    real = A.transactions
    monkeypatch.setattr(A, "transactions", lambda *a, **b: count(real(*a, **b)))
    rows = load_all()[name].build(spark, sf).collect()
    assert seen.value == lines
    if name.startswith("sketched"):
        assert all(r["rows"] == lines and r["distinct_within_bound"] and r["quartiles_within_bound"] for r in rows)
    else:
        assert len(rows) == 11 and abs(sum(r["monetary"] for r in rows)) < 1e-6


def test_segments_compute_the_master_table_once(spark, counted, monkeypatch):
    from basketlens.plans import queries_ml as Q
    count, seen = counted
    rows = spark.createDataFrame([(i, float(i % 3), float(i % 3 * 7 + i % 2)) for i in range(90)], "customer_id long, a double, b double")
    monkeypatch.setattr(Q, "master", lambda spark, sf: count(rows))
    assert load_all()["kmeans_cluster_sizes"].build(spark, "").first() == (3, 90) and seen.value == 90


def test_iterations_scan_blocks_of_rows(spark):
    from basketlens.operators import segmentation as SG
    rows = spark.range(5000).selectExpr("array(id % 7.0D, id * 0.5D) AS x").select(array_to_vector("x").alias("features")).coalesce(2)
    made = SG.blocks(rows)
    assert made.count() < 12 and made.agg(F.sum("rows")).first()[0] == 5000 and SG.blocks(made) is made
    (n, sums, squares, costs), = SG._pass(rows, [np.array([[0.0, 0.0], [3.0, 1e9]])])
    assert n.tolist() == [5000, 0] and np.allclose(sums[0], [sum(i % 7 for i in range(5000)), 0.5 * 4999 * 2500])
    assert np.isclose(squares[0], costs[0]) and sums[1].tolist() == [0, 0]


def test_purchases_are_summed_with_their_payment_method(spark):
    day = dt.datetime(2000, 1, 1)
    lines = [(1, day, "card", "x", 1.0), (1, day, "card", "y", 2.0), (1, day, "cash", "x", 4.0), (1, day + dt.timedelta(days=3), None, None, 8.0), (None, day, "cash", "x", 16.0)]
    tx = spark.createDataFrame(lines, "customer_id long, transaction_date timestamp_ntz, payment_method string, category string, revenue double")
    tx = tx.withColumns({"discount_pct": F.lit(0.5), "return_flag": F.lit(1)})
    got = FT.transaction_summary(tx, "revenue").collect()
    by = lambda of, *names: sorted(((*(str(r[c]) for c in names), r["_n"], r["_rev"]) for r in got if r["_of"] == of))
    assert {r["_of"] for r in got} == {"_t", "category"}
    assert by("_t", "customer_id", "payment_method") == [("1", "None", 1, 8.0), ("1", "card", 2, 3.0), ("1", "cash", 1, 4.0), ("None", "cash", 1, 16.0)]
    assert by("category", "customer_id", "category") == [("1", "None", 1, 8.0), ("1", "x", 2, 5.0), ("1", "y", 1, 2.0), ("None", "x", 1, 16.0)]
    row = {r["customer_id"]: r for r in FT.transaction_features(tx, "2000-01-05", "revenue").collect()}[1]
    assert (row["preferred_payment"], row["category_diversity"], row["purchase_gap_mean"], row["revenue_last_30d"]) == ("card", 2, 1.0, 15.0)
