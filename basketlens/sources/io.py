"""Table scan, table sink and declared layouts (ops 1-3).

Spark does not enforce keys; integrity is checked by ``operators.quality``. Indexes of the
original become layout: facts are partitioned by month and bucketed by customer so that
per-customer aggregates and joins of two bucketed tables avoid a shuffle.

Row counts of writes are read back from the sink (Parquet counts come from file footers,
not a rescan): the table's rows after a replace, or after minus before an append (one
writer per table). ``DataFrame.observe`` with an ``Observation`` is not used: on Spark 4.1
it leaves the session holding a non-serializable observation manager, after which closures
that capture the session (e.g. ML's ``vector_to_array``) fail with "Task not serializable".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .schemas import SCHEMAS


def scan(spark: SparkSession, path_or_table: str, fmt: str = "parquet") -> DataFrame:
    """Op 1: a table by path (Parquet by default) or by catalog name."""
    if "/" in path_or_table:
        return spark.read.format(fmt).load(path_or_table)
    return spark.table(path_or_table)


def query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Op 1: any SELECT over registered views (temp views are session-scoped)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Op 2: write ``df`` (replace or append) and return the number of rows written."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    spark = df.sparkSession
    before = _path_rows(spark, path, fmt) if mode == "append" else 0
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return _path_rows(spark, path, fmt) - before


def _path_rows(spark: SparkSession, path: str, fmt: str) -> int:
    """Rows stored under ``path`` (0 when nothing is there yet)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return 0
    return spark.read.format(fmt).load(path).count()


def replace_into(df: DataFrame, table: str) -> int:
    """Op 2 ('replace' keeping the declared table): overwrite the rows of an existing
    catalog table; its schema, partitioning and bucketing stay as declared.

    ``df`` may read the table itself: it is first written to the checkpoint folder, and only
    that copy replaces the rows, by one overwrite of all partitions (static, whatever the
    session's partition overwrite mode). If ``df`` fails, the table is untouched. Raises if
    the table then holds another number of rows than were written; returns that number."""
    spark = df.sparkSession
    copy = materialize(df.select(*[F.col(f"`{c}`") for c in spark.table(table).columns]), "replace")
    expected = copy.count()
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        copy.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(table)
    rows = spark.table(table).count()
    if rows != expected:
        raise RuntimeError(f"{table} holds {rows} rows after a replace by {expected}")
    return rows


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Op 1 against a database: a table name or ``(SELECT ...) AS q``; with a numeric
    ``partition_column`` the read is split into ``num_partitions`` parallel range queries."""
    opts = dict(properties or {})
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table_or_query)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               properties: dict | None = None, batch_size: int = 5000) -> int:
    """Op 2 into a database: 'overwrite' truncates the existing table (keeping its declared
    schema, keys and indexes) and appends; 'append' appends. Rows go in ``batch_size``
    batches per task. A replace writes ``df`` to the checkpoint folder first, so it may read
    the table itself and a failing ``df`` leaves the rows. Returns the number of rows
    written: the table's count after a replace, after minus before an append (one writer
    per table)."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    spark = df.sparkSession
    if mode == "overwrite":
        df = materialize(df, "replace")

    def rows() -> int:
        q = f"(SELECT count(*) AS n FROM {table}) AS c"
        return int(read_jdbc(spark, url, q, properties).first()[0])

    before = rows() if mode == "append" else 0
    w = (df.write.format("jdbc").mode(mode)
         .option("url", url).option("dbtable", table).option("batchsize", batch_size)
         .option("truncate", "true"))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
    return rows() - before


# Declared layout per table (partition column expression, bucket key).
LAYOUT = {
    "products": {"partition": None, "bucket": "product_id"},
    "customers": {"partition": None, "bucket": "customer_id"},
    "transactions": {"partition": "transaction_month", "bucket": "customer_id"},
    "events": {"partition": "event_month", "bucket": "customer_id"},
}


def create_tables(spark: SparkSession, database: str = "shop", buckets: int = 64,
                  location: str | None = None) -> list[str]:
    """Op 3: create the four declared tables (Parquet, month partitions for facts, buckets
    on the join key). Returns the table names."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    names = []
    for name, schema in SCHEMAS.items():
        lay = LAYOUT[name]
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        if lay["partition"]:
            cols += f", {lay['partition']} string"
        part = f" PARTITIONED BY ({lay['partition']})" if lay["partition"] else ""
        bucket = f" CLUSTERED BY ({lay['bucket']}) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet"
                  f"{part}{bucket}")
        names.append(f"{database}.{name}")
    return names


def with_month(df: DataFrame, date_col: str, out: str) -> DataFrame:
    """Partition value yyyy-MM for a fact table."""
    return df.withColumn(out, F.date_format(date_col, "yyyy-MM"))
