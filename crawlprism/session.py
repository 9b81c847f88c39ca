"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table (rows) that may be broadcast; anything bigger takes the shuffle path.
BROADCAST_ROWS = 200_000


def build_session(app: str = "crawlprism", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster the master, memory and shuffle width come from spark-submit;
    AQE then resizes partitions and splits skewed joins at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join even where a later step then needs one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Plans of many expressions are built in half the time when no call site is kept for each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster shares (``spark.checkpoint.dir``).

    A machine-local folder is used only under a local master, where driver and
    executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="crawlprism-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a size check; a larger side joins by shuffle instead."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def repartition_bounded(df: DataFrame, key: str, amount: int, most: int) -> DataFrame:
    """Rows by key, in tasks that hold about ``most`` of the ``amount`` there is; a small amount is left to Spark.

    Spark deals an exchange of its own to about as many tasks as there are cores, so their memory would grow with the input.
    """
    n = -(-amount // most)
    return df.repartition(key) if n <= 1 else df.repartition(max(n, df.sparkSession.sparkContext.defaultParallelism), key)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a reused result to the shared folder and reads it back.

    Cuts the lineage and survives the loss of any executor.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Most bytes of stored pages that one task reads where it sorts what it reads.
SPLIT_BYTES = 32 << 20


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """File reads that begin inside take at most ``SPLIT_BYTES`` a task. Splits otherwise grow with the input up to
    Spark's 128 MB, of which nested pages unfold to gigabytes."""
    key = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(key)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(usual)
    spark.conf.set(key, str(min(size, SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def drop_dir(spark: SparkSession, path: str) -> None:
    """Removes a folder of any store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
