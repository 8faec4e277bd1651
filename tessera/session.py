"""A session with what the engine relies on: UTC, ANSI arithmetic, adaptive execution."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a task of ``spread``: some tens of seconds at a millisecond a row.
TASK_ROWS = 25_000


def session(name: str = "tessera", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**fixed, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder that driver and executors share, under ``spark.checkpoint.dir``. Only a local session may go without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/') if base else 'file://' + tempfile.mkdtemp(prefix='tessera-')}/{tag}-{uuid.uuid4().hex}"


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """A scanned table dealt by its keys to all cores and to tasks of about ``TASK_ROWS`` rows, as it is if it has as many splits.

    For work on a row that costs far more than to shuffle it, such as extraction: splits are cut by bytes, and
    narrow rows fill one by the million. Rows are counted first, from the footers of Parquet files.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    return rows if rows.rdd.getNumPartitions() >= tasks else rows.repartition(tasks, *keys)


def bounded_batches(spark: SparkSession, most: int = 1 << 20) -> None:
    """Bounds Arrow batches by bytes: texts may be long, and a batch is held whole by a Python worker.

    The setting stays, as results are run later than they are declared; the number of rows a batch is the user's.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))
