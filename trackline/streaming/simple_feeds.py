"""Smaller streams: the simple metric monitor, the user feed and the feed of control documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackline.operators import metrics
from trackline.operators.decode import (
    dead_letters,
    decode,
    error_headers,
    good_records,
    reject_implausible_metrics,
)
from trackline.sources import contracts
from trackline.sources.sinks import batch_folder, begin_batch, commit_batch, last_committed, write_batch, write_text
from trackline.streaming.state import StateTable


@dataclass(frozen=True)
class MetricMonitor:
    """Checks metrics against the control document, which is read again in each micro-batch.

    Outputs: metric_log, line_protocol (text), metric_dead_letters, and latest: the newest `shown` log lines so far.
    """

    out_dir: str
    documents: Callable[[SparkSession], DataFrame]
    avsc: str | None = None
    shown: int = 30

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest lines as of the last whole batch."""
        return spark.read.parquet(batch_folder(f"{self.out_dir}/latest", last_committed(spark, self.out_dir)))

    def _keep_latest(self, spark: SparkSession, log: DataFrame, batch_id: int) -> None:
        """The top of the carried lines and those of this batch; each task hands on `shown` lines at most."""
        lines = log.select("timestamp", "seq", "line")
        if batch_id:
            lines = lines.unionByName(spark.read.parquet(batch_folder(f"{self.out_dir}/latest", batch_id - 1)))
        newest = lines.orderBy(F.desc("timestamp"), F.desc("seq")).limit(self.shown)
        write_batch(newest, f"{self.out_dir}/latest", batch_id)

    def process(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        begin_batch(spark, self.out_dir, batch_id)
        decoded = decode(messages, contracts.METRIC, ["mc_name", "temp", "pressure"], avsc=self.avsc)
        decoded = reject_implausible_metrics(decoded).persist()
        try:
            records = decoded.filter("error IS NULL").select(
                "record.*", F.col("offset").alias("seq"), F.unix_millis("timestamp").alias("timestamp"))
            checked = metrics.check_metrics(records, metrics.current_limits(self.documents(spark)))
            log = metrics.metric_log(checked, clock=F.timestamp_millis("timestamp"))
            rejected = metrics.rejected_log(decoded, clock=F.col("timestamp"))
            log = log.unionByName(rejected, allowMissingColumns=True)
            write_batch(log, f"{self.out_dir}/metric_log", batch_id)
            self._keep_latest(spark, log, batch_id)
            write_text(metrics.line_protocol(checked), f"{self.out_dir}/line_protocol", batch_id)
            write_batch(dead_letters(decoded, "machine-events"), f"{self.out_dir}/metric_dead_letters", batch_id)
        finally:
            decoded.unpersist()
        commit_batch(spark, self.out_dir, batch_id)

    def start(self, messages: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        writer = messages.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()


@dataclass(frozen=True)
class UserFeed:
    """Keeps good user records and sends bad ones on with the reason in a header."""

    out_dir: str
    avsc: str | None = None

    def process(self, messages: DataFrame, batch_id: int) -> None:
        begin_batch(messages.sparkSession, self.out_dir, batch_id)
        decoded = decode(messages, contracts.USER, ["id", "name"], avsc=self.avsc, strict=True).persist()
        try:
            write_batch(good_records(decoded), f"{self.out_dir}/user_records", batch_id)
            write_batch(error_headers(decoded), f"{self.out_dir}/user_dead_letters", batch_id)
        finally:
            decoded.unpersist()
        commit_batch(messages.sparkSession, self.out_dir, batch_id)

    def start(self, messages: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        writer = messages.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()


@dataclass(frozen=True)
class DocumentFeed:
    """Finds the changes in a stream of control documents (see `messages.document_stream`).

    The last valid version of each subject is carried from batch to batch; a version that can't be read is kept apart
    and changes nothing, one with the same text as before is no change.

    Outputs: control_changes, document_dead_letters.
    """

    out_dir: str
    state_dir: str

    def process(self, documents: DataFrame, batch_id: int) -> None:
        spark = documents.sparkSession
        begin_batch(spark, self.out_dir, batch_id)
        parsed = metrics.parse_documents(documents).persist()
        try:
            bad = parsed.filter("NOT valid").select("subject", "timestamp", "raw_text")
            write_batch(bad, f"{self.out_dir}/document_dead_letters", batch_id)
            state = StateTable(f"{self.state_dir}/documents", ("subject",))
            columns = ("subject", "timestamp", "seq", "fingerprint", "temp_max", "pressure_max")
            rows = parsed.filter("valid").select(*columns, F.lit(1).alias("phase"))
            known = state.before(spark, batch_id, rows.select("subject").distinct())
            if known is not None:
                rows = rows.unionByName(known.withColumn("phase", F.lit(0)))
            arrival = Window.partitionBy("subject").orderBy("phase", "timestamp", "seq")
            rows = rows.withColumn("previous_fingerprint", F.lag("fingerprint").over(arrival))
            unlike = F.col("previous_fingerprint").isNull() | (F.col("previous_fingerprint") != F.col("fingerprint"))
            write_batch(rows.filter((F.col("phase") == 1) & unlike).drop("phase"), f"{self.out_dir}/control_changes",
                        batch_id)
            newest = rows.groupBy("subject").agg(F.max_by(
                F.struct(*columns[1:]), F.struct("phase", "timestamp", "seq")).alias("d"))
            state.write(batch_id, newest.select("subject", "d.*"))
        finally:
            parsed.unpersist()
        commit_batch(spark, self.out_dir, batch_id)

    def start(self, documents: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        writer = documents.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()
