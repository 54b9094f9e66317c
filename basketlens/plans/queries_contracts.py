"""Registered queries whose results are exact facts about fitted models, sinks, layouts and
streams (ops 2, 3, 28, 31, 33, 35, 37, 46, 52, 53, 57, 58): identities and counts that SQL
can state although the fit itself cannot be."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import eda as E
from ..operators import explain as X
from ..operators import ml as ML
from ..operators import segmentation as SG
from ..operators import stattests as S
from ..session import app_folder, materialize
from ..sources import adapter as A
from ..sources import io as IO
from ..sources import schemas
from ..streaming import scoring as STREAM
from .catalog import REGISTRY, register
from .queries_analysis import (DRIFT_CATEGORICAL, DRIFT_NUMERIC, DRIFT_SQL, drift_frame)
from .queries_features import MASTER_SQL, master
from .queries_ml import CATEGORICAL, NUMERIC, _segment_input, model_frame
from .sqlkit import oracle

# ---------------------------------------------------------------- op 3: declared tables

_TX_COLUMNS = [f.name for f in schemas.TRANSACTIONS.fields]


@register("declared_transactions_by_month", oracle("""
SELECT strftime(transaction_date, '%Y-%m') AS transaction_month, count(*) AS rows,
       CAST(sum(quantity) AS DOUBLE) AS quantity
FROM shop_tx GROUP BY 1""", ["quantity"]))
def q_declared(spark, sf):
    """Creates the declared tables, replaces the transactions (partitioned by month) and
    reads them back by partition."""
    name = f"shop_{uuid.uuid4().hex}"
    IO.create_tables(spark, name, buckets=4, location=f"{app_folder(spark)}/{name}")
    tx = A.transactions(spark, sf).withColumn("category", F.coalesce("category", F.lit("unknown")))
    IO.replace_into(IO.with_month(tx.select(*_TX_COLUMNS), "transaction_date", "transaction_month"), f"{name}.transactions")
    return spark.table(f"{name}.transactions").groupBy("transaction_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("quantity"))


# ---------------------------------------------------------------- op 28: retention matrix

@register("cohort_retention_matrix", REGISTRY["cohort_retention"].sql,
          note="the pivoted matrix, made long again so that its columns need not be known")
def q_retention_matrix(spark, sf):
    wide = materialize(E.cohort_retention(A.customers(spark, sf), A.transactions(spark, sf, with_category=False),
                                          pivot=True), "retention-matrix")
    periods = [c for c in wide.columns if c != "cohort_month"]
    cells = F.array(*[F.struct(F.lit(int(c)).alias("period_idx"), F.col(f"`{c}`").alias("retention_rate")) for c in periods])
    return (wide.select("cohort_month", F.explode(cells).alias("x")).select("cohort_month", "x.*")
            .where("retention_rate is not null"))


# ---------------------------------------------------------------- ops 31, 33: p-values

def _sql_chi_tail(x: str, dof: str) -> str:
    """-log10 of the chi-square upper tail for even degrees of freedom (closed form)."""
    return (f"-log10(exp(-({x}) / 2) * list_sum(list_transform(range(0, CAST({dof} AS BIGINT) // 2), "
            f"lambda i: power(({x}) / 2, i) / factorial(CAST(i AS INTEGER)))))")


@register("channel_churn_p_value", f"SELECT dof, {_sql_chi_tail('statistic', 'dof')} AS neg_log10_p FROM ("
          + REGISTRY["chi_square_channel_churn_statistics"].sql + ") s")
def q_chi_p(spark, sf):
    s = S.chi_square_test(A.customers(spark, sf), "acquisition_channel", "churn_label")
    return s.select("dof", (-F.log10("p_value")).alias("neg_log10_p"))


_LAMBDA = "sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * statistic"


@register("feature_drift_p_values", oracle(f"""
SELECT feature, CASE WHEN n_ref = 0 OR n_cur = 0 OR {_LAMBDA} <= 0 THEN CAST(1 AS DOUBLE) ELSE
  greatest(0, least(1, 2 * list_sum(list_transform(range(1, 2001),
    lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * CAST(k * k AS DOUBLE) * power({_LAMBDA}, 2)))))) END AS p_value
FROM (SELECT feature, CAST(statistic AS DOUBLE) AS statistic, n_ref, n_cur FROM ks) d""", ["p_value"], ctes=DRIFT_SQL))
def q_drift_p(spark, sf):
    t = S.feature_drift_split(drift_frame(spark, sf), "period", DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    return t.where("feature_type = 'numeric'").select("feature", "p_value")


# ---------------------------------------------------------------- op 37: prepared matrix

_FILLED = ", ".join([f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM master)) AS {c}" for c in NUMERIC]
                    + [f"coalesce({c}, (SELECT {c} FROM master WHERE {c} IS NOT NULL GROUP BY {c} "
                       f"ORDER BY count(*) DESC, {c} LIMIT 1), 'unknown') AS {c}" for c in CATEGORICAL])


@register("prepared_model_matrix", oracle(
    "SELECT customer_id, " + ", ".join(
        f"CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL THEN CAST(0 AS DOUBLE) ELSE ({c} - mu_{c}) / sd_{c} END AS {c}" for c in NUMERIC)
    + ", " + ", ".join(CATEGORICAL) + " FROM filled, (SELECT " + ", ".join(
        f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in NUMERIC) + " FROM filled) st",
    NUMERIC, ctes=MASTER_SQL + f",\nfilled AS (SELECT customer_id, {_FILLED} FROM master)"))
def q_prepared(spark, sf):
    """The fitted preparation's vector, read back: scaled numerics, and for each categorical
    the category whose one-hot slot is set."""
    frame = model_frame(spark, sf)
    made = ML.preprocessing_pipeline(NUMERIC, CATEGORICAL).fit(frame).transform(frame)
    names = ML.slot_names(made)
    slot = vector_to_array("features")
    columns = [F.element_at("_x", names.index(f"_sca_{c}") + 1).alias(c) for c in NUMERIC]
    for c in CATEGORICAL:
        prefix = f"_ohe_{c}_"
        columns.append(F.coalesce(*[F.when(F.element_at("_x", i + 1) == 1, F.lit(n[len(prefix):]))
                                    for i, n in enumerate(names) if n.startswith(prefix)]).alias(c))
    return made.select("customer_id", slot.alias("_x")).select("customer_id", *columns)


# ---------------------------------------------------------------- op 46: segments

@register("kmeans_cluster_sizes", oracle(
    "SELECT CAST(3 AS BIGINT) AS clusters, count(*) AS customers FROM master", ctes=MASTER_SQL))
def q_cluster_sizes(spark, sf):
    vec, _ = _segment_input(spark, sf)
    _, labelled = SG.train_kmeans(vec, 3, n_init=10)
    return labelled.agg(F.count_distinct("cluster").alias("clusters"), F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- ops 52, 53: identities

_SLOTS = f"{len(NUMERIC)} + " + " + ".join(f"(SELECT count(DISTINCT {c}) FROM master)" for c in CATEGORICAL)
_IDENTITY_SQL = oracle(f"SELECT customer_id, CAST({_SLOTS} AS BIGINT) AS features, true AS adds_up FROM master", ctes=MASTER_SQL)


def _adds_up(model, data, explain):
    """Per customer, whether base plus contributions, as log-odds, is the model's
    probability (compared there: the log-odds of a saturated probability are not exact)."""
    attributions, base = explain(model, data, "customer_id")
    offset = base.first()["expected_value"]
    totals = attributions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("features"), (F.sum("shap_value") + F.lit(offset)).alias("t"))
    scored = ML.score(model, data)
    explained = 1 / (1 + F.exp(-F.col("t")))
    return totals.join(scored, "customer_id").select(
        "customer_id", "features", (F.abs(explained - F.col("score")) < 1e-9).alias("adds_up"))


@register("logistic_attributions_add_up", _IDENTITY_SQL)
def q_logistic_identity(spark, sf):
    data = model_frame(spark, sf)
    return _adds_up(ML.fit_churn_model(data, NUMERIC, CATEGORICAL, "logistic_regression"), data, X.linear_model_attributions)


@register("tree_attributions_add_up", _IDENTITY_SQL, note="boosted trees at full size: 100 of depth 5")
def q_tree_identity(spark, sf):
    data = model_frame(spark, sf)
    return _adds_up(ML.fit_churn_model(data, NUMERIC, CATEGORICAL, "xgboost"), data, X.tree_attributions)


# ---------------------------------------------------------------- ops 57, 58: one model, three ways

_SAME_SQL = oracle("SELECT count(*) AS customers, CAST(0 AS BIGINT) AS mismatches FROM master", ctes=MASTER_SQL)


def _compared(batch, other, column):
    both = batch.join(other, "customer_id", "full_outer")
    differs = ~F.coalesce(F.abs(F.col("score") - F.col(column)) < 1e-9, F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("customers"), F.count_if(differs).alias("mismatches"))


@register("reloaded_model_scores", _SAME_SQL)
def q_reloaded(spark, sf):
    """Batch scores of a model that was saved and loaded again."""
    data = model_frame(spark, sf)
    model = ML.fit_churn_model(data, NUMERIC, CATEGORICAL, "logistic_regression")
    path = f"{app_folder(spark)}/saved-{uuid.uuid4().hex}"
    model.write().save(path)
    again = ML.score(PipelineModel.load(path), data).withColumnRenamed("score", "again")
    return _compared(ML.score(model, data), again, "again")


@register("streaming_scores_match_batch", _SAME_SQL)
def q_stream_matches(spark, sf):
    data = model_frame(spark, sf)
    model = ML.fit_churn_model(data, NUMERIC, CATEGORICAL, "logistic_regression")
    root = f"{app_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = data.drop("churn_label")
    rows.write.parquet(f"{root}/source")
    STREAM.start_scoring(spark, model, f"{root}/source", rows.schema, f"{root}/sink", f"{root}/checkpoint").awaitTermination()
    return _compared(ML.score(model, data), spark.read.parquet(f"{root}/sink").select("customer_id", "churn_probability"), "churn_probability")


@register("streaming_band_counts", oracle(
    "SELECT CAST(date_trunc('day', signup_date) AS TIMESTAMP) AS window_start, count(*) AS customers FROM master "
    "WHERE signup_date < date_trunc('day', (SELECT max(signup_date) FROM master) - INTERVAL 1 DAY) GROUP BY 1", ctes=MASTER_SQL))
def q_stream_bands(spark, sf):
    """Watermarked counts per day of sign-up, over all bands: one micro-batch reads all
    files before the watermark moves, so no row is late, and a day is out once the watermark (a day behind the latest) has passed its end."""
    data = materialize(master(spark, sf).select("customer_id", "signup_date", *[c for c in (*NUMERIC, *CATEGORICAL) if c != "signup_date"],
                                                "churn_label").where("signup_date is not null")
                       .withColumn("signup_date", F.col("signup_date").cast("timestamp")), "band-input")
    model = ML.fit_churn_model(data, NUMERIC, CATEGORICAL, "logistic_regression")
    root = f"{app_folder(spark)}/bands-{uuid.uuid4().hex}"
    data.write.parquet(f"{root}/source")
    STREAM.start_band_counts(spark, model, f"{root}/source", data.schema, "signup_date",
                             f"{root}/sink", f"{root}/checkpoint").awaitTermination()
    return (spark.read.parquet(f"{root}/sink").groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"))
            .agg(F.sum("customers").alias("customers")))
