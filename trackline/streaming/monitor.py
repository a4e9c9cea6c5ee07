"""The telemetry monitor as a stream.

Each micro-batch runs the batch operators on its messages, started from the state of the batch
before. Inside a batch rows are ordered by event time; across batches arrival decides, and rows
older than what their device already showed are marked `is_late`.

Outputs, one folder per batch: readings, incomplete, alerts, dead_letters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trackline.functions.encode import encoded_rows, incomplete_document
from trackline.functions.names import machine_type
from trackline.operators import cycles, spc
from trackline.operators.alerts import alerts, by_device
from trackline.operators.decode import (dead_letters, decode, decode_by_schema, good_records, rule_records,
                                        union_families)
from trackline.operators.rules import attach_latest, checked_values, latest_rules
from trackline.operators.slices import MAX_ROWS, plan_slices
from trackline.sources import contracts
from trackline.sources.messages import EARLIEST, LATEST, message_stream
from trackline.sources.sinks import batch_folder, begin_batch, commit_batch, outgoing, write_batch
from trackline.streaming.state import StateTable

RuleLog = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class Monitor:
    """Where things are, and which feeds there are.

    rule_log   reads a rule log kept as a table; called in each micro-batch, so rules change without a restart
    control    contract of the control topic; limit records then come with the stream: a micro-batch reads the new ones
               only and merges them into the latest ones per machine type, which are carried. Unusable ones are dead letters
    families   contract per telemetry topic; a new machine family is one more entry
    avsc       Avro schema per topic, for feeds with Avro bodies
    schemas    Avro schemas by id per topic, and under None the one to read them as (see `decode.decode_by_schema`)
    snapshot   a folder of `write_snapshot` to start from: what it covers is not read again
    encoded    also writes encoded rows; outgoing: also writes alerts, faults and dead letters as broker messages
    """

    out_dir: str
    state_dir: str
    rule_log: RuleLog | None = None
    families: dict[str, T.StructType] = field(default_factory=lambda: {"machine-telemetry": contracts.TELEMETRY})
    context_topic: str = "machine-context-events"
    max_rows: int = MAX_ROWS
    full_every: int = 20
    avsc: dict[str, str] = field(default_factory=dict)
    control: T.StructType | None = None
    control_topic: str = "machine-control"
    schemas: dict[str, dict[int | None, str]] = field(default_factory=dict)
    snapshot: str | None = None
    encoded: bool = False
    outgoing: bool = False

    @property
    def topics(self) -> list[str]:
        return [*self.families, self.context_topic, *([self.control_topic] if self.control else [])]

    def _state(self, name: str) -> StateTable:
        keys = {"devices": ("device_id",), "series": spc.SERIES, "rules": ("machine_type",),
                "offsets": ("topic", "partition")}[name]
        return StateTable(f"{self.state_dir}/{name}", keys, self.full_every,
                          f"{self.snapshot}/{name}" if self.snapshot else None)

    def write_snapshot(self, spark: SparkSession, batch_id: int, folder: str) -> None:
        """The state after a batch and the last offset it covers of each topic, for a monitor that starts from there."""
        for name in ("devices", "series", "offsets", *(["rules"] if self.control else [])):
            self._state(name).before(spark, batch_id + 1).write.mode("overwrite").parquet(f"{folder}/{name}")

    def process(self, messages: DataFrame, batch_id: int) -> None:
        """One micro-batch; readers see it (see `sinks.read_committed`) when all its tables are written."""
        spark = messages.sparkSession
        begin_batch(spark, self.out_dir, batch_id)
        held = messages.persist()
        try:
            self._process(spark, held, batch_id)
            self._covers(spark, held, batch_id)
        finally:
            held.unpersist()
        commit_batch(spark, self.out_dir, batch_id)

    def _covers(self, spark: SparkSession, messages: DataFrame, batch_id: int) -> None:
        state = self._state("offsets")
        seen = messages.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
        known = state.before(spark, batch_id)
        if known is not None:
            seen = seen.join(known.withColumnRenamed("offset", "_known"), ["topic", "partition"], "left").select(
                "topic", "partition", F.greatest("offset", "_known").alias("offset"))
        state.write(batch_id, seen)

    def _decode(self, messages: DataFrame, topic: str, contract: T.StructType, required: list[str]) -> DataFrame:
        """The decoded messages of a topic, to be held: only bad ones keep their bytes, which dead letters need."""
        own = messages.filter(F.col("topic") == topic)
        if topic in self.schemas:
            writers = {number: avsc for number, avsc in self.schemas[topic].items() if number is not None}
            decoded = decode_by_schema(own, writers, self.schemas[topic][None], avro=topic in self.avsc)
        else:
            decoded = decode(own, contract, required, avsc=self.avsc.get(topic))
        bad = F.when(F.col("error").isNotNull(), F.col("value"))
        return decoded.select("timestamp", "offset", bad.alias("value"), "record", "error")

    def _process(self, spark: SparkSession, messages: DataFrame, batch_id: int) -> None:
        decoded = {topic: self._decode(messages, topic, contract, ["device_id", "timestamp"]).persist()
                   for topic, contract in self.families.items()}
        context = self._decode(messages, self.context_topic, contracts.CONTEXT,
                               contracts.required_fields(contracts.CONTEXT)).persist()
        try:
            rules = self._rules(spark, messages, batch_id) if self.control else self.rule_log(spark)
            self._decoded(spark, decoded, context, rules, batch_id)
        finally:
            for frame in (*decoded.values(), context):
                frame.unpersist()

    def _rules(self, spark, messages, batch_id) -> DataFrame:
        """The latest rule per machine type: the carried ones and those of this batch, which alone are read and written."""
        decoded = self._decode(messages, self.control_topic, self.control, ["machine_type"]).persist()
        try:
            write_batch(dead_letters(decoded, self.control_topic), f"{self.out_dir}/control_dead_letters", batch_id)
            state, new = self._state("rules"), latest_rules(rule_records(decoded))
            known = state.before(spark, batch_id)
            if known is not None:
                touched = known.join(new.select("machine_type"), "machine_type", "left_semi")
                new = latest_rules(touched.unionByName(new, allowMissingColumns=True))
            state.write(batch_id, new)
        finally:
            decoded.unpersist()
        return state.before(spark, batch_id + 1)

    def _decoded(self, spark, decoded, context, rules, batch_id) -> None:
        bad = [dead_letters(d, topic) for topic, d in {**decoded, self.context_topic: context}.items()]
        write_batch(union_families(*bad), f"{self.out_dir}/dead_letters", batch_id)

        readings = union_families(*[good_records(d) for d in decoded.values()])
        timeline = cycles.build_timeline(readings, good_records(context)).persist()
        plan = None
        try:
            touched = timeline.select("device_id").distinct()
            plan = plan_slices(timeline, self.max_rows)
            self._cycles(spark, timeline, touched, plan, batch_id)
            self._alerts(spark, timeline, touched, plan, rules, batch_id)
            if self.outgoing:
                names = ("incomplete", "alerts", "dead_letters")
                feeds = [spark.read.parquet(batch_folder(f"{self.out_dir}/{name}", batch_id)) for name in names]
                write_batch(outgoing(*feeds), f"{self.out_dir}/outgoing", batch_id)
        finally:
            if plan is not None:
                plan.release()
            timeline.unpersist()

    def _cycles(self, spark, timeline, touched, plan, batch_id) -> None:
        state = self._state("devices")
        carry = state.before(spark, batch_id, touched)
        carry = carry.persist() if carry is not None else None
        tracked = cycles.track(timeline, plan, carry.drop("last_timestamp") if carry is not None else None).persist()
        try:
            rows = cycles.enriched_rows(tracked)
            after = cycles.closing_state(tracked)
            if carry is None:
                rows = rows.withColumn("is_late", F.lit(False))
            else:
                shown = carry.select("device_id", F.col("last_timestamp").alias("_shown"))
                rows = rows.join(shown, "device_id", "left").withColumn(
                    "is_late", F.coalesce(F.col("timestamp") < F.col("_shown"), F.lit(False))).drop("_shown")
                after = after.join(shown, "device_id", "left").withColumn(
                    "last_timestamp", F.greatest("last_timestamp", "_shown")).drop("_shown")
            typed = rows.withColumn("machine_type", machine_type(F.col("device_id")))
            write_batch(typed.hint("rebalance", "machine_type"), f"{self.out_dir}/readings", batch_id, ["machine_type"])
            if self.encoded:
                write_batch(encoded_rows(rows), f"{self.out_dir}/encoded", batch_id)
            faults = cycles.incomplete_tracks(tracked).withColumn("document", incomplete_document())
            write_batch(faults, f"{self.out_dir}/incomplete", batch_id)
            state.write(batch_id, after)
        finally:
            tracked.unpersist()
            if carry is not None:
                carry.unpersist()

    def _alerts(self, spark, timeline, touched, plan, rules, batch_id) -> None:
        state = self._state("series")
        packed = state.before(spark, batch_id, touched)
        carry = spc.unpack_tails(packed) if packed is not None else None
        readings = timeline.filter("ev IS NULL").drop("ev", "kind_rank")
        checked = checked_values(attach_latest(by_device(readings, plan), rules, plan is not None)).persist()
        try:
            write_batch(alerts(checked, plan, carry), f"{self.out_dir}/alerts", batch_id)
            tails = spc.pack_tails(spc.closing_tail(checked, carry))
            state.write(batch_id, tails)
        finally:
            checked.unpersist()

    def messages(self, spark: SparkSession, since: datetime | None = None, **source: str) -> DataFrame:
        """The feeds as one stream: readings from the first start on (for files: or `since`), others from the beginning.

        Events and limit records are read from the earliest one, so that a cycle opened before the start is known. With
        a snapshot every feed is read from the message after the covered ones on.
        """
        covered = spark.read.parquet(f"{self.snapshot}/offsets") if self.snapshot else None
        telemetry = message_stream(spark, list(self.families), LATEST, since=since, started=f"{self.state_dir}/started",
                                   covered=covered, **source)
        return telemetry.unionByName(message_stream(
            spark, [t for t in self.topics if t not in self.families], EARLIEST, covered=covered, **source))

    def start(self, messages: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        """Run on a stream of messages, e.g. `availableNow=True` or `processingTime="10 seconds"`."""
        writer = messages.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()
