"""Tables written per micro-batch, and rows shaped as outgoing messages.

Each batch owns one folder per table and overwrites it, so a repeated batch replaces its own
rows and nothing else. A batch is committed when all its tables are written; `read_committed` shows committed batches
only, so a failure between two writes is never seen as half a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The topics of the outgoing feeds.
ALERT_TOPIC = "machine-alerts"
INCOMPLETE_TOPIC = "machine-incomplete-track"
DEAD_LETTER_TOPIC = "machine-DLQ"

#: Rows of one bucket of stored readings; a task reads and sorts a whole bucket.
BUCKET_ROWS = 250_000

#: Columns kept as folder names.
TEXT_FOLDERS = ("machine_type",)


def batch_folder(table: str, batch_id: int) -> str:
    return f"{table}/batch={batch_id}"


def write_batch(rows: DataFrame, table: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(batch_folder(table, batch_id))


def buckets_for(rows: DataFrame, least: int) -> int:
    """As many buckets as keep each at about BUCKET_ROWS rows, at least `least`; the rows are counted."""
    return max(least, -(-rows.count() // BUCKET_ROWS))


def store_by_device(rows: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Rows as a table in buckets of devices, each sorted by device and time; returns the table.

    Windows and joins by device over the table need no exchange: cycle tracking and zone rules on stored readings read each
    bucket where it lies. One shuffle while writing puts each bucket into one file.
    """
    spark = rows.sparkSession
    order = [c for c in ("device_id", "timestamp", "kind_rank", "seq") if c in rows.columns]
    (rows.repartition(buckets, "device_id").write.bucketBy(buckets, "device_id").sortBy(*order)
     .mode("overwrite").option("path", path).saveAsTable(table))
    return spark.table(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """All batches of a table. Folder names are text, so a machine type 007 does not come back as the number 7."""
    rows = spark.read.option("mergeSchema", "true").parquet(table)
    folders = {name: "string" for name in TEXT_FOLDERS if name in rows.columns}
    if not folders:
        return rows
    kinds = [T.StructField(f.name, T.StringType() if f.name in folders else f.dataType) for f in rows.schema.fields]
    return spark.read.schema(T.StructType(kinds)).parquet(table)


def _commits(spark: SparkSession, out_dir: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/_commits")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _marker(spark: SparkSession, out_dir: str, batch_id: int):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/_commits/{batch_id}")


def begin_batch(spark: SparkSession, out_dir: str, batch_id: int) -> None:
    """Take the marker of a batch back that is about to be written, again or for the first time."""
    files, _ = _commits(spark, out_dir)
    files.delete(_marker(spark, out_dir, batch_id), False)


def commit_batch(spark: SparkSession, out_dir: str, batch_id: int) -> None:
    """Mark a batch as written. Batches run one after the other, so markers before the last two say nothing more."""
    files, _ = _commits(spark, out_dir)
    files.create(_marker(spark, out_dir, batch_id), True).close()
    if batch_id > 1:
        files.delete(_marker(spark, out_dir, batch_id - 2), False)


def last_committed(spark: SparkSession, out_dir: str) -> int:
    """The latest batch of which every table is written; -1 for none."""
    files, path = _commits(spark, out_dir)
    return max((int(f.getPath().getName()) for f in files.listStatus(path)), default=-1) if files.exists(path) else -1


def read_committed(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A table as of the latest committed batch; folders of later batches are not read."""
    return read_table(spark, f"{out_dir}/{name}").filter(F.col("batch") <= last_committed(spark, out_dir))


def as_messages(rows: DataFrame, topic: str, value: Column, key: Column | None = None) -> DataFrame:
    """Rows in the layout a broker sink takes."""
    return rows.select((key if key is not None else F.lit(None)).cast("string").alias("key"),
                       value.cast("string").alias("value"), F.lit(topic).alias("topic"))


def outgoing(incomplete: DataFrame, alerts: DataFrame, letters: DataFrame) -> DataFrame:
    """The three outgoing feeds as broker messages: faults and alerts by device, dead letters without a key."""
    return (as_messages(incomplete, INCOMPLETE_TOPIC, F.col("document"), F.col("device_id"))
            .unionByName(as_messages(alerts, ALERT_TOPIC, F.col("document"), F.col("device_id")))
            .unionByName(as_messages(letters, DEAD_LETTER_TOPIC, F.col("raw_text"))))


def send(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Hand messages to a broker, which delivers them at least once."""
    messages.write.format(fmt).options(**options).mode("append").save()


def write_text(lines: DataFrame, table: str, batch_id: int) -> None:
    """One text column, one line per row."""
    lines.select("value").write.mode("overwrite").text(batch_folder(table, batch_id))
