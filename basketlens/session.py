"""Session helpers: building a session, shipping the package to the workers, the shared
checkpoint folder and materialising intermediate frames."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


#: settings this library is tuned for; a value that the submit or the session has stays
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "basketlens") -> SparkSession:
    """Session with DEFAULTS filled in where the submitted configuration says nothing (AQE
    on, UTC, Arrow, no UI). ``master`` and ``shuffle_partitions`` are set only if given:
    spark-submit's values hold otherwise, and without any master it is local[*]."""
    from pyspark import SparkConf, SparkContext

    active = SparkContext._active_spark_context
    if active is None:
        SparkContext._ensure_initialized()  # the gateway carries what spark-submit was given
    conf = active.getConf() if active is not None else SparkConf()
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    elif not conf.contains("spark.master"):
        builder = builder.master("local[*]")
    if not conf.contains("spark.app.name"):
        builder = builder.appName(app_name)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in DEFAULTS.items():
        if not conf.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application, as a zip
    through ``SparkContext.addPyFile`` (executors fetch it from the driver). Without it the
    workers find the package only if their own working folder or path happens to hold it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="basketlens-ship-"), "basketlens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    _SHIPPED[sc.applicationId] = path


#: most bytes of a batch that goes to a Python worker
BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Batches of rows go to Python workers in at most BATCH_BYTES, where the session does not
    say otherwise. By Spark's own bounds (10,000 rows, 64 MB) a batch of texts takes tens of
    MB, several times in the worker and once more beside the executor's heap."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_BYTES)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode (tests) a private temporary
    folder is created and registered; on a cluster an unset folder is an error, so jobs
    never write intermediates to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(intermediates are written there)")
        configured = tempfile.mkdtemp(prefix="basketlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of recomputing the plan) and
    freezes any partition-dependent tags computed before the write.
    """
    spark = df.sparkSession
    path = f"{app_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def app_folder(spark: SparkSession) -> str:
    """This application's folder for intermediates under the checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/basketlens/{spark.sparkContext.applicationId}"


def release_intermediates(spark: SparkSession) -> None:
    """Delete this application's written intermediates (call when its results are no
    longer read). Other applications' folders are untouched."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(app_folder(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def scalar(df: DataFrame):
    """First column of the single row of a one-row aggregate (e.g. a global max)."""
    row = df.first()
    return None if row is None else row[0]


def parallel_map(fn, items, max_workers: int = 4) -> list:
    """Run independent Spark actions (e.g. model fits) from a small thread pool; Spark
    schedules their jobs concurrently. Results keep the input order."""
    from concurrent.futures import ThreadPoolExecutor
    items = list(items)
    if max_workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(items))) as pool:
        return list(pool.map(fn, items))
