"""Registered queries of mechanisms for very large tables: mergeable profile states, leaf-wise
boosting, shared-scan clustering."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import eda as E
from ..operators import ml as ML
from ..operators import segmentation as SG
from ..operators import sketches as SK
from ..operators.selection import valid
from ..session import app_folder, materialize
from ..sources import adapter as A
from .catalog import register
from .queries_analysis import PROFILE_NUMERIC, PROFILE_OTHER
from .queries_features import MASTER_SQL
from .queries_ml import CATEGORICAL, NUMERIC, _segment_input, model_frame
from .sqlkit import oracle

# ---------------------------------------------------------------- ops 25, 29: mergeable states

_EACH = [(c, True) for c in PROFILE_NUMERIC] + [(c, False) for c in PROFILE_OTHER]


@register("sketched_profile_within_bounds", oracle("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(DISTINCT {c}) AS distinct_count, TRUE AS distinct_within_bound, "
    f"TRUE AS quartiles_within_bound FROM shop_tx" for c, _ in _EACH)),
          note="profile merged from written month states, held against exact counts within the stated errors")
def q_sketched_profile(spark, sf):
    tx = materialize(A.transactions(spark, sf).select(*PROFILE_NUMERIC, *PROFILE_OTHER), "profile")  # joined once
    path = f"{app_folder(spark)}/states-{uuid.uuid4().hex}"
    SK.write_states(SK.month_states(tx, "transaction_date", PROFILE_NUMERIC, PROFILE_OTHER), path)
    probs = (0.25, 0.5, 0.75)
    told = {r["column"]: r for r in SK.merged_profile(SK.read_states(spark, path), probs).collect()}
    aggs = []
    for i, c in enumerate(PROFILE_NUMERIC):
        v = valid(c)
        for j in range(len(probs)):
            q = F.lit(told[c][f"approx_q_{j}"])
            aggs += [F.count_if(v < q).alias(f"lt{i}_{j}"), F.count_if(v <= q).alias(f"le{i}_{j}")]
    exact = tx.agg(F.count(F.lit(1)).alias("rows"), *aggs).first()
    distinct = E.distinct_counts(tx, PROFILE_NUMERIC, PROFILE_OTHER)
    off, out = SK.rank_bound(), []
    for i, (c, numeric) in enumerate(_EACH):
        n, r = distinct[c], told[c]
        near = abs(r["approx_distinct"] - n) <= SK.distinct_bound() * n
        inside = all(exact[f"lt{i}_{j}"] <= (p + off) * exact["rows"] and exact[f"le{i}_{j}"] >= (p - off) * exact["rows"]
                     for j, p in enumerate(probs)) if numeric else True
        out.append((c, r["rows"], n, near, inside))
    return spark.createDataFrame(out, "column_name string, rows long, distinct_count long, distinct_within_bound boolean, "
                                      "quartiles_within_bound boolean")


# ---------------------------------------------------------------- ops 45, 46: shared scans

@register("kmeans_shared_scan_identity", oracle(
    "SELECT CAST(k AS INT) AS k, (SELECT count(*) FROM master) AS customers, TRUE AS inertia_is_sum_of_squares, "
    "TRUE AS all_at_nearest_centre, TRUE AS best_of_its_starts FROM range(2, 11) t(k)", ctes=MASTER_SQL),
          note="all starts of all k in shared scans; inertia and assignment are computed again from the centres")
def q_shared_kmeans(spark, sf):
    features, _ = _segment_input(spark, sf)
    ks, starts = list(range(2, 11)), 10
    runs = SG.kmeans_runs(features, [k for k in ks for _ in range(starts)])
    x, aggs = vector_to_array("features"), [F.count(F.lit(1)).alias("customers")]
    frame = features.select(x.alias("x"), "features")
    for k in ks:
        best = min(runs[(k - 2) * starts:(k - 1) * starts], key=lambda r: r[1])
        model = SG.Clustering(best[0], best[1])
        frame = model.transform(frame).withColumnRenamed("cluster", f"c{k}")
        gaps = [F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
                for c in best[0]]
        own = F.element_at(F.array(*gaps), F.col(f"c{k}") + 1)
        aggs += [F.sum(own).alias(f"cost{k}"), F.count_if(own > F.least(*gaps) + 1e-6).alias(f"off{k}")]
    told = frame.agg(*aggs).first()
    rows = []
    for k in ks:
        costs = [r[1] for r in runs[(k - 2) * starts:(k - 1) * starts]]
        rows.append((k, told["customers"], abs(told[f"cost{k}"] - min(costs)) <= 1e-6 * max(1.0, min(costs)), told[f"off{k}"] == 0,
                     min(costs) <= sum(costs) / starts + 1e-9))
    return spark.createDataFrame(rows, "k int, customers long, inertia_is_sum_of_squares boolean, all_at_nearest_centre boolean, best_of_its_starts boolean")


# ---------------------------------------------------------------- op 38: leaf-wise boosting

@register("leafwise_growth_identity", oracle(
    "SELECT count(*) AS customers, CAST(20 AS BIGINT) AS trees, TRUE AS leaves_within_bound, TRUE AS loss_falls_every_tree, "
    "TRUE AS scores_add_up FROM master", ctes=MASTER_SQL), note="facts of a fit of 20 trees on all customers")
def q_leafwise(spark, sf):
    data = model_frame(spark, sf)
    fitted = ML.fit_churn_model(data, NUMERIC, CATEGORICAL, "lightgbm", maxIter=20, numLeaves=8, weighting=None)
    base, _, trees = fitted.stages[-1].parsed
    x, y = vector_to_array("features"), F.col("churn_label").cast("double")
    shared = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("array<double>")
    def margins(features):
        import numpy as np
        import pandas as pd
        rows = np.stack(features.to_numpy())
        steps = [np.full(len(rows), base)] + [t.margin(rows, False) for t in shared.value]
        return pd.Series(list(np.cumsum(np.stack(steps, 1), 1)))
    scored = fitted.transform(data).select(y.alias("y"), margins(x).alias("m"), vector_to_array("probability")[1].alias("p"))
    loss = lambda m: F.avg(F.log1p(F.exp(F.when(F.col("y") == 1, -m).otherwise(m))))
    last = F.col("m")[len(trees)]
    told = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("p") - 1 / (1 + F.exp(-last))) > 1e-9).alias("off"),
                      *[loss(F.col("m")[i]).alias(f"l{i}") for i in range(len(trees) + 1)]).first()
    falls = all(told[f"l{i + 1}"] < told[f"l{i}"] for i in range(len(trees)))
    leaves = all(sum(f < 0 for f in t.feature) <= 8 for t in trees)
    return spark.createDataFrame([(told["n"], len(trees), leaves, falls, told["off"] == 0)],
                                 "customers long, trees long, leaves_within_bound boolean, loss_falls_every_tree boolean, scores_add_up boolean")
