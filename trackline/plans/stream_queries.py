"""The stream monitor over the press feeds, folded in time slices.

Each query runs the whole monitor: messages are decoded, joined to cycles, checked and written
per micro-batch, with state carried from one batch to the next. Results must equal those of
one batch run, which is what the SQL computes.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.plans.registry import Catalogue
from trackline.plans.rule_queries import ALERT_VIEWS
from trackline.plans.sql_views import (ALERT_DOCUMENT, INCOMPLETE_DOCUMENT, PRESS, RAW_TEXT_HEX, RULE_LOG, TELEMETRY_RAW,
                                       checked,
                                       tracked)
from trackline.session import work_dir
from trackline.sources import fleet, sinks
from trackline.sources.messages import EARLIEST, LATEST, message_stream
from trackline.streaming.monitor import Monitor
from trackline.streaming.simple_feeds import MetricMonitor, UserFeed

CATALOGUE = Catalogue()
SLICES = 3

GOOD_READING = "event_type IN ('click', 'view') AND (k >= 23 OR (k >= 5 AND k < 10))"


def time_slices(messages: DataFrame, times: DataFrame, parts: int = SLICES) -> list[DataFrame]:
    """The messages cut at fixed points of their time span. `times` holds the `timestamp` of each, in milliseconds: it is
    known from the rows the messages are built from, so no body is built for it.
    """
    first, last = times.agg(F.min("timestamp"), F.max("timestamp")).first()
    width = -(-(last - first + 1) // parts)
    cuts = [F.timestamp_millis(F.lit(first + i * width)) for i in range(parts + 1)]
    return [messages.filter((F.col("timestamp") >= a) & (F.col("timestamp") < b)) for a, b in zip(cuts, cuts[1:])]


def press_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry of clicks and views, broken messages included, and all context events."""
    telemetry = fleet.telemetry_messages(spark, sf_dir, fleet.READINGS)
    return telemetry.unionByName(fleet.context_messages(spark, sf_dir))


def press_slices(spark: SparkSession, sf_dir: str, parts: int = SLICES) -> list[DataFrame]:
    """The press feeds cut at fixed points of their time span."""
    times = fleet.press_messages(spark, sf_dir).filter(F.col("event_type").isin(*fleet.READINGS, *fleet.TURNS))
    return time_slices(press_feeds(spark, sf_dir), times, parts)


def run_monitor(spark: SparkSession, sf_dir: str) -> str:
    """Fold the feeds; returns the folder of the output tables."""
    folder = work_dir(spark, "monitor")
    monitor = Monitor(f"{folder}/out", f"{folder}/state", lambda s: fleet.rule_log(s, sf_dir))
    for batch_id, messages in enumerate(press_slices(spark, sf_dir)):
        monitor.process(messages, batch_id)
    return f"{folder}/out"


@CATALOGUE.add("stream_readings", f"""
WITH {tracked(f"event_type NOT IN ('click', 'view') OR ({GOOD_READING})")}
SELECT device_id, timestamp, seq, vibration, temperature,
       CASE WHEN kr = 1 THEN CAST(65.5 AS DOUBLE) END AS pressure, status || ',x' AS status, context_complete, run_id,
       part_no, recipe_name, track_in, track_out, context_event, data_point_count, last_track_out, FALSE AS is_late,
       regexp_replace(device_id, '-[0-9]+$', '') AS machine_type
FROM enriched""")
def stream_readings(spark, sf_dir):
    return sinks.read_table(spark, f"{run_monitor(spark, sf_dir)}/readings").drop("batch", "kind_rank")


@CATALOGUE.add("stream_incomplete", f"""
WITH {tracked(f"event_type NOT IN ('click', 'view') OR ({GOOD_READING})")}
SELECT *, {INCOMPLETE_DOCUMENT} AS document FROM incomplete""")
def stream_incomplete(spark, sf_dir):
    return sinks.read_table(spark, f"{run_monitor(spark, sf_dir)}/incomplete").drop("batch")


@CATALOGUE.add("stream_alerts", f"""
WITH {checked(GOOD_READING)}, {ALERT_VIEWS} SELECT *, {ALERT_DOCUMENT} AS document FROM alerts""")
def stream_alerts(spark, sf_dir):
    return sinks.read_table(spark, f"{run_monitor(spark, sf_dir)}/alerts").drop("batch")


_BAD = f"""{TELEMETRY_RAW},
bad AS (
  SELECT seq, CASE WHEN k >= 13 AND k < 19 THEN 'missing_required_field' ELSE 'undecodable' END AS error, raw_hex,
         {RAW_TEXT_HEX} AS text_hex
  FROM raw WHERE event_type IN ('click', 'view') AND (k < 5 OR (k >= 13 AND k < 23)))"""


@CATALOGUE.add("stream_dead_letters", f"""
WITH {PRESS}, {_BAD}
SELECT seq AS "offset", 'machine-telemetry' AS source, error, raw_hex, text_hex FROM bad""")
def stream_dead_letters(spark, sf_dir):
    rows = sinks.read_table(spark, f"{run_monitor(spark, sf_dir)}/dead_letters")
    return rows.select("offset", "source", "error", F.lower(F.hex("raw")).alias("raw_hex"),
                       F.lower(F.hex(F.encode("raw_text", "UTF-8"))).alias("text_hex"))


@CATALOGUE.add("outgoing_messages", f"""
WITH {tracked(f"event_type NOT IN ('click', 'view') OR ({GOOD_READING})")},
{checked(GOOD_READING).removeprefix(PRESS + ",")}, {ALERT_VIEWS}, {_BAD}
SELECT 'machine-incomplete-track' AS topic, device_id AS key, lower(hex(encode({INCOMPLETE_DOCUMENT}))) AS value_hex
FROM incomplete
UNION ALL SELECT 'machine-alerts', device_id, lower(hex(encode({ALERT_DOCUMENT}))) FROM alerts
UNION ALL SELECT 'machine-DLQ', NULL, text_hex FROM bad""")
def outgoing_messages(spark, sf_dir):
    """Incomplete tracks, alerts and dead letters as broker messages, with key and value."""
    out = run_monitor(spark, sf_dir)
    found = {name: sinks.read_table(spark, f"{out}/{name}") for name in ("incomplete", "alerts", "dead_letters")}
    messages = sinks.outgoing(found["incomplete"], found["alerts"], found["dead_letters"])
    return messages.select("topic", "key", F.lower(F.hex(F.encode("value", "UTF-8"))).alias("value_hex"))


LONG_AGO = datetime(1970, 1, 1, tzinfo=UTC)


def run_stream(spark: SparkSession, parts: list[DataFrame], folder: str, start) -> None:
    """Write the feed part by part as files; after each, start the stream anew and let it read what is there."""
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        start(f"{folder}/in", f"{folder}/checkpoint").awaitTermination()


def restarted_monitor(spark: SparkSession, parts: list[DataFrame], rule_logs: list) -> str:
    """The monitor as a stream that is stopped and started between the parts; returns the folder of its tables."""
    folder = work_dir(spark, "monitor")
    logs = iter(rule_logs)

    def start(path: str, checkpoint: str):
        monitor = Monitor(f"{folder}/out", f"{folder}/state", next(logs))
        stream = monitor.messages(spark, since=LONG_AGO, fmt="parquet", path=path)
        return monitor.start(stream, checkpoint, availableNow=True)

    run_stream(spark, parts, folder, start)
    return f"{folder}/out"


@CATALOGUE.add("stream_restart", f"""
WITH {tracked(f"event_type NOT IN ('click', 'view') OR ({GOOD_READING})")}
SELECT device_id, timestamp, seq, vibration, temperature, context_complete, run_id, part_no, recipe_name, track_in,
       track_out, context_event, data_point_count, last_track_out, FALSE AS is_late
FROM enriched""")
def stream_restart(spark, sf_dir):
    """A file stream stopped and started in the middle gives what one run over all messages gives."""
    parts = press_slices(spark, sf_dir, 2)
    rules = [lambda s: fleet.rule_log(s, sf_dir)] * 2
    return sinks.read_table(spark, f"{restarted_monitor(spark, parts, rules)}/readings").select(
        "device_id", "timestamp", "seq", "vibration", "temperature", "context_complete", "run_id", "part_no",
        "recipe_name", "track_in", "track_out", "context_event", "data_point_count", "last_track_out", "is_late")


@CATALOGUE.add("stream_late", f"""
WITH {PRESS}, line AS (
  SELECT *, seq % 2 AS part FROM press
  WHERE event_type IN ('signup', 'purchase') OR (event_type IN ('click', 'view') AND ({GOOD_READING}))),
shown AS (SELECT device_id, MAX(timestamp) AS newest FROM line WHERE part = 0 GROUP BY device_id)
SELECT device_id, seq, part = 1 AND COALESCE(timestamp < newest, FALSE) AS is_late
FROM line LEFT JOIN shown USING (device_id)""")
def stream_late(spark, sf_dir):
    """Messages of odd number arrive after all others; rows older than what their device has shown are marked."""
    feeds = press_feeds(spark, sf_dir)
    parts = [feeds.filter(F.col("offset") % 2 == k) for k in (0, 1)]
    rules = [lambda s: fleet.rule_log(s, sf_dir)] * 2
    return sinks.read_table(spark, f"{restarted_monitor(spark, parts, rules)}/readings").select(
        "device_id", "seq", "is_late")


@CATALOGUE.add("stream_rule_change", f"""
WITH {PRESS}, {RULE_LOG}, line AS (
  SELECT *, seq % 2 AS part FROM press WHERE event_type IN ('click', 'view') AND ({GOOD_READING})),
versions AS (
  SELECT part, machine_type, MAX("offset") AS "offset" FROM rule_log, (VALUES (0), (1)) AS parts(part)
  WHERE part = 1 OR "offset" % 3 = 0 GROUP BY part, machine_type),
long_values AS (
  SELECT part, machine_type, seq, 'vibration' AS measurement, value FROM line
  UNION ALL SELECT part, machine_type, seq, 'temperature', k FROM line
  UNION ALL SELECT part, machine_type, seq, 'pressure', 65.5 FROM line),
checked AS (
  SELECT v.seq, v.measurement, v.value, r.upper, r.lower, r.version AS rule_version
  FROM long_values v JOIN versions USING (part, machine_type)
  JOIN rule_long r USING (machine_type, "offset", measurement))
SELECT seq, measurement, 'upper' AS limit_type, upper AS limit_value, rule_version FROM checked WHERE value > upper
UNION ALL SELECT seq, measurement, 'lower', lower, rule_version FROM checked WHERE value < lower""")
def stream_rule_change(spark, sf_dir):
    """Limit breaches of two batches, between which two thirds of the limit records are published."""
    feeds = press_feeds(spark, sf_dir)
    parts = [feeds.filter(F.col("offset") % 2 == k) for k in (0, 1)]
    rules = [lambda s: fleet.rule_log(s, sf_dir).filter("offset % 3 = 0"), lambda s: fleet.rule_log(s, sf_dir)]
    found = sinks.read_table(spark, f"{restarted_monitor(spark, parts, rules)}/alerts")
    return found.filter("alert_type = 'limit_breach'").select(
        "seq", "measurement", "limit_type", "limit_value", "rule_version")


@CATALOGUE.add("user_stream", """
SELECT 'U' || c_custkey AS id, c_name AS name,
       CASE WHEN c_acctbal >= 0 THEN c_name || '@example.com' END AS email, c_custkey AS seq
FROM customer WHERE c_nationkey >= 7""")
def user_stream(spark, sf_dir):
    """User records from a file stream that is started twice."""
    folder = work_dir(spark, "users")
    messages = fleet.user_messages(spark, sf_dir)
    feed = UserFeed(f"{folder}/out")
    run_stream(spark, [messages.filter(F.col("offset") % 2 == k) for k in (0, 1)], folder, lambda path, checkpoint: feed.start(
        message_stream(spark, ["user-events"], EARLIEST, fmt="parquet", path=path), checkpoint, availableNow=True))
    return sinks.read_table(spark, f"{folder}/out/user_records").drop("batch")


@CATALOGUE.add("metric_stream", f"""
WITH {PRESS}
SELECT seq, k >= 3 AND value * 4 <= 1000 AS checked,
       CASE WHEN k < 3 OR value * 4 > 1000 THEN '⚠️ Caught Poison Pill at Offset ' || seq
         || ': implausible -> Routing to DLQ.' END AS rejected_line,
       strftime(make_timestamp(timestamp * 1000), '%H:%M:%S') AS clock,
       CASE WHEN k >= 3 AND value * 4 <= 1000 THEN CAST(printf('%.1f', value * 4) AS DOUBLE) END AS temp
FROM press""")
def metric_stream(spark, sf_dir):
    """Metrics from a file stream that is started twice: one log line per message, with its time of day."""
    folder = work_dir(spark, "metrics")
    messages = fleet.metric_messages(spark, sf_dir)
    monitor = MetricMonitor(f"{folder}/out", lambda s: fleet.control_documents(s, sf_dir))
    run_stream(spark, [messages.filter(F.col("offset") % 2 == k) for k in (0, 1)], folder,
               lambda path, checkpoint: monitor.start(message_stream(
                   spark, ["machine-events"], LATEST, fmt="parquet", path=path, since=LONG_AGO), checkpoint,
                   availableNow=True))
    log = sinks.read_table(spark, f"{folder}/out/metric_log")
    checked = F.col("mc_name").isNotNull()
    return log.select("seq", checked.alias("checked"), F.when(~checked, F.expr("substring(line, 12)")).alias("rejected_line"),
                      F.expr("substring(line, 2, 8)").alias("clock"), "temp")
