"""Session settings and two small helpers shared by the operators."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table that may be copied to every executor.
BROADCAST_ROWS = 200_000
#: Shuffle partitions before adaptive execution merges the small ones.
INITIAL_PARTITIONS = 8192


def build_session(app: str = "trackline", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators assume; a cluster passes its own on top.

    Adaptive execution merges small shuffle partitions, so on a cluster their initial number is set high
    (INITIAL_PARTITIONS): a window's partition can't be split afterwards. Local runs start from `shuffle_partitions`.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if not (master or "").startswith("local"):
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(INITIAL_PARTITIONS))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trackline-"))
    return spark.sparkContext.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder inside the shared one, removed when the driver ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended before
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded_broadcast(table: DataFrame, limit: int = BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """Hint a broadcast only when the table is measured (or known) to hold at most `limit` rows.

    A larger table comes back without a hint: the join then shuffles both sides and
    adaptive execution splits its skewed partitions.
    """
    if rows is None:
        rows = table.limit(limit + 1).count()
    return F.broadcast(table) if rows <= limit else table
