"""Message sources: a broker, or files with the same columns."""

from __future__ import annotations

import json
import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.operators.metrics import parse_documents

MESSAGE_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")

EARLIEST = "earliest"
LATEST = "latest"


def starting_offsets(covered: DataFrame, topics: list[str]) -> str:
    """The broker's text for: from the message after the covered one on. `covered` has one row per topic and partition."""
    places: dict[str, dict[str, int]] = {}
    for row in covered.filter(F.col("topic").isin(topics)).collect():
        places.setdefault(row.topic, {})[str(row.partition)] = row.offset + 1
    return json.dumps(places)


def _configured(reader, topics: list[str], fmt: str, starting: str, options: dict[str, str]):
    if fmt == "kafka":
        reader = reader.option("subscribe", ",".join(topics)).option("startingOffsets", starting)
    else:
        reader = reader.schema(MESSAGE_SCHEMA)
    return reader.format(fmt).options(**options)


def message_stream(spark: SparkSession, topics: list[str], starting: str, *, fmt: str = "kafka", path: str | None = None,
                   since: datetime | None = None, started: str | None = None, covered: DataFrame | None = None,
                   **options: str) -> DataFrame:
    """Messages of some topics as a stream.

    `covered` (topic, partition, offset: the last message a snapshot knows) wins over `starting`: what follows is read.

    Sensor feeds start at the latest message; feeds that hold state (events, rules) at the
    earliest one, so that a cycle opened before the start is known. A broker keeps its place in
    the checkpoint. Files have no such place: `latest` drops messages older than `since`, or than the
    first start of the feed, which the folder `started` remembers for restarts (see `feed_start`).
    """
    place = starting_offsets(covered, topics) if covered is not None and fmt == "kafka" else starting
    reader = _configured(spark.readStream, topics, fmt, place, options)
    rows = (reader.load(path) if path else reader.load()).filter(F.col("topic").isin(topics))
    if covered is not None and fmt != "kafka":
        known = covered.select("topic", "partition", F.col("offset").alias("_covered"))
        rows = rows.join(F.broadcast(known), ["topic", "partition"], "left").filter(
            F.col("_covered").isNull() | (F.col("offset") > F.col("_covered")))
    elif fmt != "kafka" and starting == LATEST:
        start = since or (feed_start(spark, started) if started else datetime.now(UTC))
        rows = rows.filter(F.col("timestamp") >= F.timestamp_micros(F.lit(int(start.timestamp() * 1_000_000))))
    return rows.select(*COLUMNS)


def feed_start(spark: SparkSession, folder: str) -> datetime:
    """When a feed was first started: now on the first call, and the same time on every later one.

    The folder lies beside the stream's checkpoint, so a restarted stream drops nothing that came while it was down.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        now = int(datetime.now(UTC).timestamp() * 1_000_000)
        spark.createDataFrame([(now,)], "micros bigint").coalesce(1).write.parquet(folder)
    micros = spark.read.schema("micros bigint").parquet(folder).first().micros
    return datetime.fromtimestamp(micros / 1_000_000, UTC)


def _documents(files: DataFrame) -> DataFrame:
    return files.select(
        F.element_at(F.split("path", "/"), -2).alias("subject"),
        F.unix_millis("modificationTime").alias("timestamp"),
        F.lit(0).cast("long").alias("seq"),
        F.col("content").cast("string").alias("raw_text"))


def document_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Control documents kept as files: the folder is the subject, the change time the order."""
    return _documents(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))


def document_stream(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream of whole files, `<path>/<subject>/<file>`: each new file is a new version of its subject."""
    files = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary")
    return _documents(files.load(f"{path}/*/*"))


class PolledDocuments:
    """Control documents that are overwritten in place, read again at most every `every` seconds.

    Calling it gives one row per subject: the latest version that can be read. A malformed version changes nothing. The
    last ones are kept in the folder `state`, so a restart knows them too. There is one small document per subject.
    """

    def __init__(self, path: str, state: str, every: float = 10.0, clock=time.monotonic):
        self.path, self.state, self.every, self.clock = path, state, every, clock
        self.read_at: float | None = None

    def __call__(self, spark: SparkSession) -> DataFrame:
        now = self.clock()
        if self.read_at is None or now - self.read_at >= self.every:
            self._read(spark)
            self.read_at = now
        return spark.read.parquet(self._version(spark))

    def _version(self, spark: SparkSession) -> str | None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.state)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        known = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        return f"{self.state}/{max(known)}" if known else None

    def _read(self, spark: SparkSession) -> None:
        columns = ("subject", "timestamp", "seq", "raw_text")
        found = parse_documents(document_snapshots(spark, self.path)).filter("valid").select(*columns)
        before = self._version(spark)
        if before is not None:
            found = found.unionByName(spark.read.parquet(before))
        newest = found.groupBy("subject").agg(F.max_by(F.struct("timestamp", "seq", "raw_text"), "timestamp").alias("d"))
        number = int(before.rsplit("-", 1)[1]) + 1 if before else 0
        newest.select("subject", "d.*").coalesce(1).write.mode("overwrite").parquet(f"{self.state}/version-{number:09d}")
