"""Feeds that change while they run: control topic, schema versions, open fields, documents, snapshots, commits, storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.functions.encode import encoded_rows
from trackline.operators import cycles, spc
from trackline.operators.decode import decode, decode_by_schema, good_records, with_open_fields
from trackline.operators.slices import plan_slices
from trackline.plans.registry import Catalogue
from trackline.plans.rule_queries import LATHES, violations_sql
from trackline.plans.sql_views import PRESS, RULE_LOG, TRACKED, tracked, zone_rules
from trackline.plans.stream_queries import GOOD_READING, LONG_AGO, press_feeds, press_slices, run_stream
from trackline.session import work_dir
from trackline.sources import contracts, fleet, sinks
from trackline.sources.messages import LATEST, document_stream, message_stream
from trackline.streaming.monitor import Monitor
from trackline.streaming.simple_feeds import DocumentFeed, MetricMonitor

CATALOGUE = Catalogue()

_BAD_RECORD = "CASE WHEN s_nationkey IN (20, 21) THEN 'undecodable' WHEN s_nationkey = 22 THEN 'missing_required_field' END"

_CONTROLLED = f"""
{PRESS}, {RULE_LOG},
usable AS (SELECT s_suppkey AS "offset" FROM supplier WHERE ({_BAD_RECORD}) IS NULL),
line AS (SELECT *, seq % 2 AS part FROM press WHERE event_type IN ('click', 'view') AND ({GOOD_READING})),
versions AS (
  SELECT part, machine_type, MAX("offset") AS "offset"
  FROM rule_log JOIN usable USING ("offset"), (VALUES (0), (1)) AS parts(part)
  WHERE part = 1 OR "offset" % 3 = 0 GROUP BY part, machine_type),
long_values AS (
  SELECT part, device_id, timestamp, machine_type, seq, 'vibration' AS measurement, value FROM line
  UNION ALL SELECT part, device_id, timestamp, machine_type, seq, 'temperature', k FROM line
  UNION ALL SELECT part, device_id, timestamp, machine_type, seq, 'pressure', 65.5 FROM line),
checked AS (  -- the second part arrives after the first, whatever its times
  SELECT v.device_id, v.timestamp + part * 100000000000000 AS timestamp, v.seq, v.measurement, v.value, r.upper, r.lower,
         r.rule_profile, r.version AS rule_version
  FROM long_values v JOIN versions USING (part, machine_type)
  JOIN rule_long r USING (machine_type, "offset", measurement) WHERE r.upper IS NOT NULL OR r.lower IS NOT NULL),
{zone_rules("checked")}, fired AS ({violations_sql("scored")})"""


def _control_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Readings of even number and every third limit record first, then all others."""
    feeds, control = press_feeds(spark, sf_dir), fleet.control_messages(spark, sf_dir)
    return [feeds.filter("offset % 2 = 0").unionByName(control.filter("offset % 3 = 0")),
            feeds.filter("offset % 2 = 1").unionByName(control.filter("offset % 3 <> 0"))]


def controlled_monitor(spark: SparkSession, parts: list[DataFrame]) -> str:
    """The monitor with the control topic among its feeds, stopped and started between the parts."""
    folder = work_dir(spark, "controlled")
    monitor = Monitor(f"{folder}/out", f"{folder}/state", control=contracts.CONTROL)
    run_stream(spark, parts, folder, lambda path, checkpoint: monitor.start(
        monitor.messages(spark, since=LONG_AGO, fmt="parquet", path=path), checkpoint, availableNow=True))
    return f"{folder}/out"


@CATALOGUE.add("stream_control", f"""
WITH {_CONTROLLED}
SELECT 'limit_breach' AS alert_type, seq, measurement, value, 'upper' AS limit_type, upper AS limit_value, rule_profile,
       rule_version, CAST(NULL AS INTEGER) AS rule_number FROM checked WHERE value > upper
UNION ALL SELECT 'limit_breach', seq, measurement, value, 'lower', lower, rule_profile, rule_version, NULL
FROM checked WHERE value < lower
UNION ALL SELECT 'spc_rule', seq, measurement, value, NULL, NULL, NULL, NULL, rule_number FROM fired""")
def stream_control(spark, sf_dir):
    """All alerts, with the limit records as a feed of the stream: some are broken, more come with the second part."""
    out = controlled_monitor(spark, _control_parts(spark, sf_dir))
    return sinks.read_committed(spark, out, "alerts").select(
        "alert_type", "seq", "measurement", "value", "limit_type", "limit_value", "rule_profile", "rule_version",
        "rule_number")


@CATALOGUE.add("stream_control_letters", f"""
SELECT CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 1 END AS batch, s_suppkey AS "offset", 'machine-control' AS source,
       {_BAD_RECORD} AS error
FROM supplier WHERE s_nationkey IN (20, 21, 22)""")
def stream_control_letters(spark, sf_dir):
    """Unusable limit records, each in the batch that brought it and in no later one."""
    control = fleet.control_messages(spark, sf_dir)
    parts = [control.filter("offset % 3 = 0"), control.filter("offset % 3 <> 0")]
    rows = sinks.read_committed(spark, controlled_monitor(spark, parts), "control_dead_letters")
    return rows.select("batch", "offset", "source", "error")


@CATALOGUE.add("decoded_versions", f"""
WITH {PRESS}, kinds AS (SELECT *, seq % 6 AS kind FROM press)
SELECT seq,
  CASE kind WHEN 3 THEN 'unknown_schema' WHEN 4 THEN 'incompatible_schema' END AS error,
  CASE WHEN kind IN (0, 1, 2, 5) THEN device_id END AS device_id,
  CASE WHEN kind IN (0, 1, 5) THEN timestamp WHEN kind = 2 THEN seq END AS timestamp,
  CASE WHEN kind IN (0, 5) THEN value WHEN kind = 1 THEN floor(value) WHEN kind = 2 THEN floor(value) + 0.5 END AS vibration,
  CASE WHEN kind IN (0, 1, 5) THEN k END AS temperature,
  CASE WHEN kind IN (0, 2) THEN 65.5 WHEN kind = 1 THEN value END::DOUBLE AS pressure,
  CASE WHEN kind IN (0, 5) THEN event_type WHEN kind IN (1, 2) THEN 'UNKNOWN' END AS status
FROM kinds WHERE kind <> 5
UNION ALL  -- without a header: the reader's own schema, whose pressure this body lacks
SELECT seq, 'missing_required_field', device_id, timestamp, value, k, NULL, event_type FROM kinds WHERE kind = 5""")
def decoded_versions(spark, sf_dir):
    """A topic written under three schema versions reads as one frame; unknown and unfit schemas are dead letters."""
    decoded = decode_by_schema(fleet.versioned_messages(spark, sf_dir), fleet.VERSIONS, fleet.READER)
    return decoded.select(F.col("offset").alias("seq"), "error", "record.*")


@CATALOGUE.add("open_fields", f"""
WITH {PRESS}
SELECT seq, 'device_id,timestamp,vibration' || CASE WHEN seq % 2 = 0 THEN ',armed' ELSE '' END || ',humidity'
         || CASE WHEN seq % 2 = 1 THEN ',mode' ELSE '' END || CASE WHEN seq % 3 = 0 THEN ',probe' ELSE '' END AS names,
       'DOUBLE' || CASE WHEN seq % 2 = 0 THEN ',BOOLEAN' ELSE '' END || ',DOUBLE'
         || CASE WHEN seq % 2 = 1 THEN ',TEXT' ELSE '' END || CASE WHEN seq % 3 = 0 THEN ',TEXT' ELSE '' END AS types,
       CAST(value AS VARCHAR) || CASE WHEN seq % 2 = 0 THEN CASE WHEN k > 50 THEN ',true' ELSE ',false' END ELSE '' END
         || ',' || CASE WHEN seq % 2 = 1 THEN k ELSE k + 0.5 END::DOUBLE
         || CASE WHEN seq % 2 = 1 THEN ',' || event_type ELSE '' END
         || CASE WHEN seq % 3 = 0 THEN ',{{"id":' || seq || '}}' ELSE '' END AS "values"
FROM press WHERE k >= 5""")
def open_fields(spark, sf_dir):
    """Sensors that no contract names are kept, with the types found in the messages."""
    contract = contracts.struct_from_avsc(contracts.record_schema(
        "Telemetry", device_id="string", timestamp="long", vibration="double"))
    decoded = decode(fleet.open_messages(spark, sf_dir), contract, ["device_id", "timestamp"])
    rows = encoded_rows(good_records(with_open_fields(decoded)), keep=("seq",))
    return rows.select("seq", F.concat(F.lit("device_id,timestamp,"), "measurements").alias("names"), "types", "values")


_ARRIVED = tracked(f"event_type NOT IN ('click', 'view') OR ({GOOD_READING})")


@CATALOGUE.add("stream_cold_start", f"""
WITH {_ARRIVED}
SELECT device_id, timestamp, seq, vibration, temperature, CASE WHEN kr = 1 THEN CAST(65.5 AS DOUBLE) END AS pressure,
       status || ',x' AS status, context_complete, run_id, part_no, recipe_name, track_in, track_out, context_event,
       data_point_count, last_track_out, FALSE AS is_late
FROM enriched""")
def stream_cold_start(spark, sf_dir):
    """A new monitor starts from a snapshot and reads what it does not cover: together as one replay of everything."""
    folder = work_dir(spark, "cold")
    parts = press_slices(spark, sf_dir, 3)
    rules = lambda s: fleet.rule_log(s, sf_dir)
    old = Monitor(f"{folder}/old", f"{folder}/old-state", rules)
    new = Monitor(f"{folder}/new", f"{folder}/new-state", rules, snapshot=f"{folder}/snapshot")
    # offsets grow from part to part in each topic, so what the first two parts hold is what the snapshot covers
    span = 1 + (fleet.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0)
    by_time = [part.withColumn("offset", F.lit(k * span) + F.col("offset")) for k, part in enumerate(parts)]
    for batch_id, part in enumerate(by_time[:2]):
        old.process(part, batch_id)
    old.write_snapshot(spark, 1, f"{folder}/snapshot")
    for part in by_time:
        part.write.mode("append").parquet(f"{folder}/in")
    stream = new.messages(spark, fmt="parquet", path=f"{folder}/in")
    new.start(stream, f"{folder}/checkpoint", availableNow=True).awaitTermination()
    rows = sinks.read_committed(spark, f"{folder}/old", "readings").unionByName(
        sinks.read_committed(spark, f"{folder}/new", "readings"))
    return rows.withColumn("seq", F.col("seq") % span).drop("batch", "kind_rank", "machine_type")


class _Breaks:
    """A rule log that can't be read when its second batch asks for it, once."""

    def __init__(self, sf_dir: str):
        self.sf_dir, self.asked = sf_dir, 0

    def __call__(self, spark: SparkSession) -> DataFrame:
        self.asked += 1
        if self.asked == 2:
            raise ConnectionError("the rule log can't be reached")
        return fleet.rule_log(spark, self.sf_dir)


@CATALOGUE.add("stream_commits", f"""
WITH {_ARRIVED},
cut AS (SELECT MIN(timestamp) + (MAX(timestamp) - MIN(timestamp) + 2) // 2 AS cut_at FROM press)
SELECT 'after the failure' AS phase, device_id, seq FROM enriched, cut WHERE timestamp < cut_at
UNION ALL SELECT 'after the repetition', device_id, seq FROM enriched""")
def stream_commits(spark, sf_dir):
    """The second batch fails half-way: readers see the first batch only, and all of both after the repetition."""
    folder = work_dir(spark, "commits")
    monitor = Monitor(f"{folder}/out", f"{folder}/state", _Breaks(sf_dir))
    first, second = press_slices(spark, sf_dir, 2)
    monitor.process(first, 0)
    try:
        monitor.process(second, 1)
    except ConnectionError:
        pass
    columns = ("phase", "device_id", "seq")
    seen = sinks.read_committed(spark, f"{folder}/out", "readings").withColumn("phase", F.lit("after the failure"))
    kept = f"{folder}/seen"
    seen.select(*columns).write.parquet(kept)
    monitor.process(second, 1)
    whole = sinks.read_committed(spark, f"{folder}/out", "readings").withColumn("phase", F.lit("after the repetition"))
    return spark.read.parquet(kept).unionByName(whole.select(*columns))


_PRESS_LINES = f"""
WITH {PRESS},
documents_log AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, o_orderdate, o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
limits AS (
  SELECT level * 100 + 50.5 AS temp_max, level * 10 + 90.0 AS pressure_max,
         substr(sha256('{{"version": ' || level || ', "rules": {{"max_safe_temp": ' || (level * 100 + 50)
           || '.5, "max_safe_pressure": ' || (level * 10 + 90) || '.0}}}}'), 1, 8) AS version
  FROM documents_log ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1),
checked AS (
  SELECT seq, timestamp, k < 3 OR value * 4 > 1000 AS odd, device_id AS name,
         CAST(printf('%.1f', value * 4) AS DOUBLE) AS temp, CAST(printf('%.1f', value + 100) AS DOUBLE) AS pressure, limits.*
  FROM press, limits),
lines AS (
  SELECT seq, timestamp, odd, temp, pressure, '[' || strftime(make_timestamp(timestamp * 1000), '%H:%M:%S') || '] ' ||
    CASE WHEN odd THEN '⚠️ Caught Poison Pill at Offset ' || seq || ': implausible -> Routing to DLQ.'
    WHEN temp > temp_max OR pressure > pressure_max THEN
      '🚨 ALARM [Config v.' || version || ']: Machine ''' || name || ''' Breached Safe Operations! -> '
      || concat_ws(' | ', CASE WHEN temp > temp_max THEN 'Temperature: ' || temp || '°C (Limit: ' || temp_max || '°C)' END,
                   CASE WHEN pressure > pressure_max THEN 'Pressure: ' || pressure || ' PSI (Limit: ' || pressure_max || ' PSI)' END)
      || CASE WHEN temp > temp_max AND pressure > pressure_max THEN ''
              WHEN temp > temp_max THEN ' | [Pressure: ' || pressure || ' PSI]' ELSE ' | [Temperature: ' || temp || '°C]' END
    ELSE '📥 Telemetry Logged [Offset ' || seq || '][Config v.' || version || ']: ' || name || ' is normal (' || temp || '°C, '
      || pressure || ' PSI).' END AS line
  FROM checked)"""


def streamed_metrics(spark: SparkSession, sf_dir: str) -> MetricMonitor:
    """The metric monitor over a file stream that is started twice."""
    folder = work_dir(spark, "metrics")
    messages = fleet.metric_messages(spark, sf_dir)
    monitor = MetricMonitor(f"{folder}/out", lambda s: fleet.control_documents(s, sf_dir))
    run_stream(spark, [messages.filter(F.col("offset") % 2 == k) for k in (0, 1)], folder,
               lambda path, checkpoint: monitor.start(message_stream(
                   spark, ["machine-events"], LATEST, fmt="parquet", path=path, since=LONG_AGO), checkpoint,
                   availableNow=True))
    return monitor


@CATALOGUE.add("metric_stream_lines", f"""{_PRESS_LINES}
SELECT seq, line, CASE WHEN NOT odd THEN temp END AS temp, CASE WHEN NOT odd THEN pressure END AS pressure FROM lines""")
def metric_stream_lines(spark, sf_dir):
    """Every log line of the streamed monitor, word by word."""
    out = streamed_metrics(spark, sf_dir).out_dir
    return sinks.read_committed(spark, out, "metric_log").select("seq", "line", "temp", "pressure")


@CATALOGUE.add("metric_stream_latest30", f"""{_PRESS_LINES}
SELECT timestamp, seq, line FROM lines ORDER BY timestamp DESC, seq DESC LIMIT 30""")
def metric_stream_latest30(spark, sf_dir):
    """The newest 30 lines, carried from batch to batch and over a restart."""
    return streamed_metrics(spark, sf_dir).latest(spark).select("timestamp", "seq", "line")


@CATALOGUE.add("document_changes_stream", """
WITH versions AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS line, (year(o_orderdate) - 1990) // 2 AS period,
         COUNT(*) AS orders, MAX(o_orderkey) AS last
  FROM orders GROUP BY 1, 2),
valid AS (
  SELECT 'line-' || line AS subject, period, CASE WHEN line = 3 THEN 7 ELSE orders END + 0.5 AS temp_max,
         CASE WHEN line = 3 THEN 7 ELSE last END::DOUBLE AS pressure_max,
         sha256('{"version": ' || line || ', "rules": {"max_safe_temp": ' || CASE WHEN line = 3 THEN 7 ELSE orders END
           || '.5, "max_safe_pressure": ' || CASE WHEN line = 3 THEN 7 ELSE last END || '.0}}') AS fingerprint
  FROM versions WHERE NOT (line IN (2, 4) AND period % 4 = 0)),
ordered AS (SELECT *, LAG(fingerprint) OVER (PARTITION BY subject ORDER BY period) AS previous_fingerprint FROM valid)
SELECT subject, CAST(temp_max AS DOUBLE) AS temp_max, pressure_max, fingerprint, previous_fingerprint FROM ordered
WHERE previous_fingerprint IS NULL OR previous_fingerprint <> fingerprint""")
def document_changes_stream(spark, sf_dir):
    """Control documents as a stream of files that is started anew for each period; some files are broken."""
    folder = work_dir(spark, "documents")
    feed = DocumentFeed(f"{folder}/out", f"{folder}/state")
    versions = fleet.control_versions(spark, sf_dir)
    for period in sorted(row.period for row in versions.select("period").distinct().collect()):
        found = versions.filter(F.col("period") == period).select(
            F.concat(F.lit("line-"), "line").alias("subject"), F.col("raw_text").alias("value"))
        found.repartition("subject").write.partitionBy("subject").mode("overwrite").text(f"{folder}/written-{period}")
        for row in found.select("subject").distinct().collect():
            _publish(spark, f"{folder}/written-{period}/subject={row.subject}", f"{folder}/in/{row.subject}", period)
        feed.start(document_stream(spark, f"{folder}/in"), f"{folder}/checkpoint", availableNow=True).awaitTermination()
    return sinks.read_committed(spark, f"{folder}/out", "control_changes").select(
        "subject", "temp_max", "pressure_max", "fingerprint", "previous_fingerprint")


def _publish(spark: SparkSession, written: str, folder: str, period: int) -> None:
    """Put the one line of a text file under a name of its own, without the line's end, as an editor of the document would."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = files.create(path(f"{folder}/version-{period}.json"), True)
    stream.write(bytearray(spark.read.text(written).first().value.encode()))
    stream.close()


def stored(spark: SparkSession, rows: DataFrame, buckets: int = 8) -> DataFrame:
    name, buckets = f"readings_{uuid.uuid4().hex}", sinks.buckets_for(rows, buckets)
    return sinks.store_by_device(rows, name, f"{work_dir(spark, 'stored')}/{name}", buckets)


@CATALOGUE.add("stored_cycles", f"""
WITH {TRACKED}
SELECT device_id, timestamp, seq, context_complete, run_id, track_in, track_out, context_event, data_point_count,
       last_track_out FROM enriched""")
def stored_cycles(spark, sf_dir):
    """Cycle tracking over readings and events stored by device: no row is exchanged."""
    timeline = stored(spark, fleet.press_timeline(spark, sf_dir))
    return cycles.enriched_rows(cycles.track(timeline, plan_slices(timeline))).select(
        "device_id", "timestamp", "seq", "context_complete", "run_id", "track_in", "track_out", "context_event",
        "data_point_count", "last_track_out")


@CATALOGUE.add("stored_zone_rules", f"WITH {LATHES}, {zone_rules('lathe_values')} {violations_sql('scored')}")
def stored_zone_rules(spark, sf_dir):
    """Zone rules over readings stored by device: no row is exchanged."""
    names = ("spindle_rpm", "cutting_force", "coolant_pressure")
    readings = stored(spark, fleet.lathe_readings(spark, sf_dir).select("device_id", "timestamp", "seq", *names))
    plan = plan_slices(readings)
    rows = plan.assign(readings) if plan else readings
    return spc.violations(spc.evaluate_fields(rows, list(names), plan))
