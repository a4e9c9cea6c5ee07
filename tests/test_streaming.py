from __future__ import annotations

import json
from collections import Counter
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from fixtures import event_frame, golden_messages, random_messages, reading_frame, rule_frame
from test_cycles import expected, faults_of, rows_of
from trackline.functions.wire import add_header
from trackline.operators import alerts, rules
from trackline.plans import stream_queries
from trackline.sources import contracts, fleet, messages as sources, sinks
from trackline.streaming.monitor import Monitor
from trackline.streaming.simple_feeds import MetricMonitor, UserFeed


def as_feed(spark, items):
    """Fixture messages in the layout of a message source, both topics."""
    readings = reading_frame(spark, items)
    telemetry = fleet.raw_messages(
        readings, add_header(F.to_json(F.struct(*[c for c in readings.columns if c != "seq"])).cast("binary"),
                             F.lit(1).cast("long")),
        "machine-telemetry", F.col("seq"), F.timestamp_millis("timestamp"))
    events = event_frame(spark, items)
    context = fleet.raw_messages(
        events, F.to_json(F.struct(*[c for c in events.columns if c != "seq"])).cast("binary"),
        "machine-context-events", F.col("seq"), F.timestamp_millis("event_timestamp"))
    return telemetry.unionByName(context)


def fresh_monitor(spark, folder, **options):
    return Monitor(out_dir=f"{folder}/out", state_dir=f"{folder}/state", rule_log=rule_frame, **options)


def run_in_slices(spark, monitor, items, parts):
    size = -(-len(items) // parts)
    for batch_id, start in enumerate(range(0, len(items), size)):
        monitor.process(as_feed(spark, items[start:start + size]), batch_id)


def alert_set(frame):
    return Counter((r.seq, r.measurement, r.alert_type, r.limit_type, r.rule_number) for r in frame.collect())


@pytest.mark.parametrize("parts,max_rows,full_every", [(1, 10**6, 20), (3, 10**6, 20), (3, 15, 2), (7, 10**6, 2)])
def test_stream_equals_batch(spark, tmp_path, parts, max_rows, full_every):
    items = random_messages(seed=3, count=420, devices=4)
    monitor = fresh_monitor(spark, tmp_path, max_rows=max_rows, full_every=full_every)
    run_in_slices(spark, monitor, items, parts)
    rows, faults = expected(items)
    written = sinks.read_table(spark, f"{tmp_path}/out/readings")
    assert rows_of(written) == rows
    assert written.filter("is_late").count() == 0
    assert faults_of(sinks.read_table(spark, f"{tmp_path}/out/incomplete")) == faults
    whole = alerts.alerts_for(reading_frame(spark, items), rule_frame(spark))
    assert alert_set(sinks.read_table(spark, f"{tmp_path}/out/alerts")) == alert_set(whole)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    items = golden_messages()
    monitor = fresh_monitor(spark, tmp_path)
    run_in_slices(spark, monitor, items, 2)
    monitor.process(as_feed(spark, items[13:]), 1)
    assert rows_of(sinks.read_table(spark, f"{tmp_path}/out/readings")) == expected(items)[0]
    assert sinks.read_table(spark, f"{tmp_path}/out/alerts").count() == 2


def test_late_rows_are_marked_and_follow_arrival(spark, tmp_path):
    items = golden_messages()
    monitor = fresh_monitor(spark, tmp_path)
    monitor.process(as_feed(spark, items[:8]), 0)
    late = dict(items[1], seq=100)
    monitor.process(as_feed(spark, [late]), 1)
    row = sinks.read_table(spark, f"{tmp_path}/out/readings").filter("seq = 100").first()
    assert row.is_late
    # RUN-1 was closed by then: the late reading arrives between cycles
    assert not row.context_complete and row.last_track_out == items[7]["timestamp"]


def test_file_stream_with_dead_letters_and_rule_change(spark, tmp_path):
    feed, log = f"{tmp_path}/feed", f"{tmp_path}/rules"
    items = golden_messages()
    first = [(0, 0, "v1", "Press-A", 2.0, None, None, None, None, None, "P")]
    rule_frame(spark, first).write.parquet(log)
    monitor = Monitor(out_dir=f"{tmp_path}/out", state_dir=f"{tmp_path}/state",
                      rule_log=lambda s: s.read.parquet(log))

    def run():
        stream = sources.message_stream(spark, monitor.topics, sources.EARLIEST, fmt="parquet", path=feed)
        query = monitor.start(stream, f"{tmp_path}/checkpoint", availableNow=True)
        query.awaitTermination(120)
        assert query.exception() is None

    broken = spark.createDataFrame([(None, b"\x00\x00\x00\x00\x01no record", "machine-telemetry", 0, 500, None),
                                    (None, None, "machine-telemetry", 0, 501, None),
                                    (None, b"{}", "machine-context-events", 0, 502, None)], sources.MESSAGE_SCHEMA)
    as_feed(spark, items[:8]).unionByName(broken).coalesce(1).write.mode("append").parquet(feed)
    run()
    second = [(1, 0, "v2", "Press-A", 6.0, None, None, None, None, None, "P")]
    rule_frame(spark, second).write.mode("append").parquet(log)
    as_feed(spark, items[8:]).coalesce(1).write.mode("append").parquet(feed)
    run()

    assert rows_of(sinks.read_table(spark, f"{tmp_path}/out/readings")) == expected(items)[0]
    found = sinks.read_table(spark, f"{tmp_path}/out/alerts").filter("alert_type = 'limit_breach'")
    # six readings of 3.0 under the first rule, then only the 7.0 under the second
    assert Counter((r.value, r.rule_version) for r in found.collect()) == {(3.0, "v1"): 6, (7.0, "v2"): 1}
    bad = sinks.read_table(spark, f"{tmp_path}/out/dead_letters").collect()
    assert Counter((r.source, r.offset, r.error) for r in bad) == {
        ("machine-telemetry", 500, "undecodable"): 1, ("machine-context-events", 502, "missing_required_field"): 1}
    assert next(r for r in bad if r.offset == 500).raw == b"\x00\x00\x00\x00\x01no record"


def test_new_family_is_one_more_topic(spark, tmp_path):
    lathe = contracts.struct_from_avsc(json.dumps({"type": "record", "name": "Lathe", "fields": [
        {"name": "device_id", "type": "string"}, {"name": "timestamp", "type": "long"},
        {"name": "spindle_rpm", "type": "float"}]}))
    monitor = Monitor(out_dir=f"{tmp_path}/out", state_dir=f"{tmp_path}/state", rule_log=rule_frame,
                      families={"machine-telemetry": contracts.TELEMETRY, "lathe-telemetry": lathe})
    body = b'{"device_id": "Lathe-07", "timestamp": 5, "spindle_rpm": 900.5}'
    extra = spark.createDataFrame([(None, body, "lathe-telemetry", 0, 900, None)], sources.MESSAGE_SCHEMA)
    monitor.process(as_feed(spark, golden_messages()).unionByName(extra), 0)
    rows = sinks.read_table(spark, f"{tmp_path}/out/readings")
    assert rows.count() == 26
    row = rows.filter("machine_type = 'Lathe'").first()
    assert (row.device_id, row.spindle_rpm, row.vibration) == ("Lathe-07", 900.5, None)


def test_metric_stream(spark, tmp_path):
    folder = tmp_path / "documents" / "machine-control"
    folder.mkdir(parents=True)
    (folder / "v4.json").write_text('{"version": 4, "rules": {"max_safe_temp": 55.0, "max_safe_pressure": 145.0}}')
    monitor = MetricMonitor(f"{tmp_path}/out", lambda s: sources.document_snapshots(s, f"{tmp_path}/documents"))
    values = [("Press-01", 75.0, 150.0), ("Press-02", 42.5, 115.0), ("Press-03", 60.0, 115.0), ("Press-04", 55.0, 145.0),
              ("", 50.0, 100.0), ("Press-05", 1000.1, 100.0)]
    frame = spark.createDataFrame([(i, *v) for i, v in enumerate(values)],
                                  "seq long, mc_name string, temp double, pressure double")
    feed = fleet.raw_messages(frame, F.to_json(F.struct("mc_name", "temp", "pressure")).cast("binary"),
                              "machine-events", F.col("seq"), F.timestamp_millis(F.lit(0).cast("long")))
    monitor.process(feed, 0)
    log = {r.mc_name: r for r in sinks.read_table(spark, f"{tmp_path}/out/metric_log").collect()}
    version = log["Press-01"].config_version
    assert len(version) == 8
    assert log["Press-01"].line.endswith(
        "-> Temperature: 75.0°C (Limit: 55.0°C) | Pressure: 150.0 PSI (Limit: 145.0 PSI)")
    assert log["Press-01"].line.startswith("[00:00:00] \U0001F6A8 ALARM [Config v." + version + "]: Machine 'Press-01'")
    assert log["Press-03"].line.endswith("-> Temperature: 60.0°C (Limit: 55.0°C) | [Pressure: 115.0 PSI]")
    assert log["Press-02"].line.endswith(": Press-02 is normal (42.5°C, 115.0 PSI).")
    assert not log["Press-04"].temp_breached and not log["Press-04"].pressure_breached
    bad = sinks.read_table(spark, f"{tmp_path}/out/metric_dead_letters").collect()
    assert Counter(r.error for r in bad) == {"implausible": 2}
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out/line_protocol").collect()]
    assert "telemetry,machine_id=Press-02 temp=42.5,pressure=115.0" in lines and len(lines) == 4


def test_user_feed(spark, tmp_path, sf_dir):
    UserFeed(f"{tmp_path}/out").process(fleet.user_messages(spark, sf_dir), 0)
    good = sinks.read_table(spark, f"{tmp_path}/out/user_records").count()
    bad = sinks.read_table(spark, f"{tmp_path}/out/user_dead_letters")
    assert good + bad.count() == fleet.table(spark, sf_dir, "customer").count()
    row = bad.first()
    assert row.headers[0].key == "error_message" and row.value[:1] == b"\x00"


def test_as_of_rules_follow_log_time(spark):
    log = [(0, 100, "v1", "Press-A", 2.0, None, None, None, None, None, "P"),
           (1, 200, "v2", "Press-A", 9.0, None, None, None, None, None, "P")]
    readings = spark.createDataFrame([("Press-A-1", t, t, 3.0) for t in (50, 100, 150, 200, 250)],
                                     "device_id string, timestamp long, seq long, vibration double")
    for max_rows in (10**6, 2):
        ruled = rules.attach_as_of(readings, rule_frame(spark, log), max_rows)
        assert sorted((r.timestamp, r.rule.version) for r in ruled.collect()) == [
            (100, "v1"), (150, "v1"), (200, "v2"), (250, "v2")]


def test_a_batch_without_good_messages(spark, tmp_path):
    monitor = fresh_monitor(spark, tmp_path)
    bad = spark.createDataFrame([(None, b"no record", "machine-telemetry", 0, 900, None)], sources.MESSAGE_SCHEMA)
    monitor.process(bad, 0)
    items = golden_messages()
    monitor.process(as_feed(spark, items), 1)
    assert rows_of(sinks.read_table(spark, f"{tmp_path}/out/readings")) == expected(items)[0]
    assert sinks.read_table(spark, f"{tmp_path}/out/dead_letters").count() == 1


def test_readings_start_at_the_latest_message_and_events_at_the_earliest(spark, tmp_path):
    """A cycle opened before the start is known; readings sent before it are not read."""
    feed = f"{tmp_path}/feed"
    items = golden_messages()
    as_feed(spark, items[:7]).coalesce(1).write.parquet(feed)  # three readings, TRACK_IN, three readings
    monitor = fresh_monitor(spark, tmp_path)
    start = datetime.fromtimestamp(items[5]["timestamp"] / 1000, UTC)
    stream = monitor.messages(spark, since=start, fmt="parquet", path=feed)
    query = monitor.start(stream, f"{tmp_path}/checkpoint", availableNow=True)
    query.awaitTermination(120)
    assert query.exception() is None
    rows = sinks.read_table(spark, f"{tmp_path}/out/readings").orderBy("timestamp").collect()
    assert [(r.context_event, r.run_id, r.data_point_count) for r in rows] == [
        ("TRACK_IN", "RUN-1", 0), (None, "RUN-1", 1), (None, "RUN-1", 2)]


def test_outgoing_message_columns(spark, tmp_path):
    rows = spark.createDataFrame([("d-1", "{}")], "device_id string, document string")
    out = sinks.as_messages(rows, sinks.ALERT_TOPIC, F.col("document"), F.col("device_id"))
    assert out.columns == ["key", "value", "topic"] and tuple(out.first()) == ("d-1", "{}", "machine-alerts")
    sinks.send(out, fmt="json", path=f"{tmp_path}/sent")
    assert spark.read.json(f"{tmp_path}/sent").count() == 1


def test_feeds_are_cut_without_building_their_messages(spark, sf_dir, monkeypatch):
    """The bounds of the time slices come from the rows, not from the messages built from them."""
    rows = fleet.press_messages(spark, sf_dir)
    unbuilt = fleet.raw_messages(rows, F.raise_error(F.lit("built")).cast("binary"), "machine-telemetry", F.col("seq"),
                                 F.timestamp_millis("timestamp"))
    monkeypatch.setattr(stream_queries, "press_feeds", lambda *given: unbuilt)
    assert len(stream_queries.press_slices(spark, sf_dir)) == stream_queries.SLICES


def test_good_messages_are_held_without_their_bytes(spark, sf_dir, tmp_path):
    """The record of a good message is held; its bytes beside it would be held twice. Bad ones keep theirs."""
    from trackline.sources import contracts, fleet
    from trackline.streaming.monitor import Monitor

    messages = fleet.telemetry_messages(spark, sf_dir)
    monitor = Monitor(f"{tmp_path}/out", f"{tmp_path}/state")
    held = monitor._decode(messages, "machine-telemetry", contracts.TELEMETRY, ["device_id", "timestamp"])
    assert held.filter("error IS NULL").count() > 0
    assert held.filter("error IS NULL AND value IS NOT NULL").count() == 0
    raw = messages.filter("value IS NOT NULL").select("offset", "value")
    bad = held.filter("error IS NOT NULL").select("offset", "value")
    assert bad.count() > 0 and bad.exceptAll(raw).count() == 0
