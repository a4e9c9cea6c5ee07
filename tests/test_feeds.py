"""Feeds that change while they run: control topic, schemas, open fields, documents, snapshots, commits, stored readings."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from fixtures import golden_messages, random_messages, reading_frame, rule_frame
from test_cycles import expected, faults_of, rows_of
from test_streaming import alert_set, as_feed, fresh_monitor
from trackline.functions.encode import encoded_rows
from trackline.functions.wire import add_header
from trackline.operators import alerts, cycles, decode as dec, spc
from trackline.plans.catalogue import catalogue
from trackline.sources import contracts, fleet, messages as sources, sinks
from trackline.streaming import monitor as monitor_module
from trackline.streaming.monitor import Monitor
from trackline.streaming.simple_feeds import DocumentFeed, MetricMonitor


def control_feed(spark, records):
    """(offset, body) as messages of the control topic."""
    rows = spark.createDataFrame([(offset, json.dumps(body) if isinstance(body, dict) else body) for offset, body in records],
                                 "offset long, body string")
    return fleet.raw_messages(rows, add_header(F.col("body").cast("binary"), F.lit(3).cast("long")), "machine-control",
                              F.col("offset"), F.timestamp_millis("offset"))


def rule(version, machine_type, **limits):
    return {"version": version, "machine_type": machine_type, "rule_profile": "P", **limits}


def readings(spark, *rows):
    """(device, seq, vibration) as telemetry."""
    frame = spark.createDataFrame([(d, s * 10, s, float(v)) for d, s, v in rows],
                                  "device_id string, timestamp long, seq long, vibration double")
    body = F.to_json(F.struct("device_id", "timestamp", "vibration")).cast("binary")
    return fleet.raw_messages(frame, body, "machine-telemetry", F.col("seq"), F.timestamp_millis("timestamp"))


def test_control_batches_read_their_own_offsets_only(spark, tmp_path):
    monitor = Monitor(f"{tmp_path}/out", f"{tmp_path}/state", control=contracts.CONTROL)
    monitor.process(control_feed(spark, [(0, rule("a1", "Press-A", max_vibration=5.0)), (1, "no record"),
                                         (2, rule("b1", "Press-B", max_vibration=3.0))])
                    .unionByName(readings(spark, ("Press-A-1", 0, 6), ("Press-B-1", 1, 4))), 0)
    monitor.process(control_feed(spark, [(3, rule("a2", "Press-A", max_vibration=9.0)), (4, rule("none", None))])
                    .unionByName(readings(spark, ("Press-A-1", 2, 6), ("Press-B-1", 3, 4))), 1)
    monitor.process(readings(spark, ("Press-A-1", 4, 10), ("Press-B-1", 5, 4), ("Press-C-1", 6, 99)), 2)
    found = sinks.read_committed(spark, monitor.out_dir, "alerts").filter("alert_type = 'limit_breach'")
    assert sorted((r.seq, r.rule_version) for r in found.collect()) == [(0, "a1"), (1, "b1"), (3, "b1"), (4, "a2"), (5, "b1")]
    bad = sinks.read_committed(spark, monitor.out_dir, "control_dead_letters")
    assert sorted((r.batch, r.offset, r.error) for r in bad.collect()) == [
        (0, 1, "undecodable"), (1, 4, "missing_required_field")]
    stored = {n: {r.machine_type for r in spark.read.parquet(f"{tmp_path}/state/rules/batch={n}").collect()} for n in range(3)}
    assert stored == {0: {"Press-A", "Press-B"}, 1: {"Press-A"}, 2: set()}
    assert {(r.machine_type, r.version) for r in monitor._state("rules").before(spark, 3).collect()} == {
        ("Press-A", "a2"), ("Press-B", "b1")}


def test_older_records_do_not_replace_newer_ones(spark, tmp_path):
    monitor = Monitor(f"{tmp_path}/out", f"{tmp_path}/state", control=contracts.CONTROL, full_every=2)
    for batch_id, offset in enumerate((5, 3, 9, 7, 8)):
        monitor.process(control_feed(spark, [(offset, rule(f"v{offset}", "Press-A", max_vibration=1.0))]), batch_id)
    assert [r.version for r in monitor._state("rules").before(spark, 5).collect()] == ["v9"]


WRITER = contracts.record_schema("R", id="string", n="int", gone="double")


@pytest.mark.parametrize("reader, found", [
    (contracts.record_schema("R", id="string", n="long"), [("id", None), ("n", None)]),
    (contracts.record_schema("R", id="string", n="double"), [("id", None), ("n", None)]),
    (contracts.record_schema("R", key={"type": "string", "aliases": ["id"]}), [("id", None)]),
    (contracts.record_schema("R", id="string", more={"type": "double", "default": 2.5}), [("id", None), (None, 2.5)]),
    (contracts.record_schema("R", id="string", more=["null", "string"]), [("id", None), (None, None)]),
    (contracts.record_schema("R", id="string", more="double"), None),
    (contracts.record_schema("R", id="int"), None),
    (contracts.record_schema("R", gone="int"), None),
])
def test_schemas_resolve(reader, found):
    sources_found = contracts.resolve(WRITER, reader)
    assert (sources_found and [(s.writer, s.default) for s in sources_found]) == found


def test_messages_decode_by_their_own_schema(spark):
    def message(number, body):
        return (b"\x00" + number.to_bytes(4, "big") + body.encode()) if number else body.encode()

    reader = contracts.record_schema("R", id="string", n="long", more={"type": "string", "default": "new"})
    rows = [message(1, '{"id":"a","n":1,"gone":2.5}'), message(2, '{"id":"b","n":5000000000,"more":"x"}'),
            message(1, '{"id":"c","n":5000000000}'), message(1, '{"n":1}'), message(7, '{"id":"d","n":1}'), None,
            message(0, '{"id":"e","n":3,"more":"y"}'), message(3, '{"id":"f"}'), message(2, "no record")]
    writers = {1: WRITER, 2: contracts.record_schema("R", id="string", n="long", more="string"),
               3: contracts.record_schema("R", id="string")}
    frame = spark.createDataFrame([(k, m) for k, m in enumerate(rows)], "offset long, value binary")
    decoded = dec.decode_by_schema(frame, writers, reader)
    found = {r.offset: (r.error, *r.record) for r in decoded.collect()}
    assert found[0] == (None, "a", 1, "new") and found[1] == (None, "b", 5000000000, "x") and found[6] == (None, "e", 3, "y")
    assert {k: found[k][0] for k in (2, 3, 4, 7, 8)} == {
        2: dec.UNDECODABLE, 3: dec.MISSING_FIELD, 4: dec.UNKNOWN_SCHEMA, 7: dec.INCOMPATIBLE_SCHEMA, 8: dec.UNDECODABLE}
    assert 5 not in found and {r.seq for r in dec.good_records(decoded).collect()} == {0, 1, 6}
    assert dec.dead_letters(decoded, "t").filter("raw IS NULL").count() == 0


def test_monitor_reads_schema_versions(spark, tmp_path):
    frame = spark.createDataFrame([(0, 1, '{"device_id":"Press-A-1","timestamp":1,"vibration":7}'),
                                   (1, 2, '{"machine":"Press-A-1","timestamp":2,"vibration":7.5}'),
                                   (2, 9, "{}")], "offset long, number long, body string")
    feed = fleet.raw_messages(frame, add_header(F.col("body").cast("binary"), F.col("number")), "machine-telemetry",
                              F.col("offset"), F.timestamp_millis("offset"))
    schemas = {1: contracts.record_schema("T", device_id="string", timestamp="long", vibration="int"),
               2: contracts.record_schema("T", machine="string", timestamp="int", vibration="double"),
               None: contracts.record_schema("T", device_id={"type": "string", "aliases": ["machine"]}, timestamp="long",
                                             vibration="double")}
    monitor = fresh_monitor(spark, tmp_path, schemas={"machine-telemetry": schemas})
    monitor.process(feed, 0)
    rows = sinks.read_committed(spark, monitor.out_dir, "readings").collect()
    assert sorted((r.seq, r.device_id, r.vibration) for r in rows) == [(0, "Press-A-1", 7.0), (1, "Press-A-1", 7.5)]
    letter = sinks.read_committed(spark, monitor.out_dir, "dead_letters").first()
    assert (letter.offset, letter.error) == (2, "unknown_schema")


OPEN = contracts.struct_from_avsc(contracts.record_schema("T", device_id="string", timestamp="long"))


def opened(spark, *bodies):
    frame = spark.createDataFrame([(k, b.encode()) for k, b in enumerate(bodies)], "offset long, value binary")
    return dec.with_open_fields(dec.decode(frame, OPEN, ["device_id", "timestamp"]))


def test_fields_beside_the_contract_are_kept(spark):
    head = '{"device_id":"d","timestamp":1,'
    decoded = opened(spark, head + '"a":1,"it\'s":"x","seq":4}', head + '"a":1.5,"b":true,"say \\"so\\"":2}',
                     head + '"m":1,"deep":{"k":[1,2]}}', head + '"m":"text","a":null}', '{"device_id":"d","lost":1}', "no record")
    fields = {f.name: f.dataType.simpleString() for f in decoded.schema["record"].dataType.fields}
    assert fields == {"device_id": "string", "timestamp": "bigint", "a": "double", "b": "boolean", "deep": "string",
                      "it's": "string", "m": "string", 'say "so"': "bigint", "seq": "bigint"}
    rows = {r.offset: r.record.asDict() if r.error is None else r.error for r in decoded.collect()}
    assert (rows[0]["a"], rows[0]["it's"], rows[0]["seq"], rows[1]["a"], rows[1]["b"], rows[1]['say "so"']) == (
        1.0, "x", 4, 1.5, True, 2)
    assert rows[2]["deep"] == '{"k":[1,2]}' and (rows[2]["m"], rows[3]["m"]) == ("1", '"text"') and rows[3]["a"] is None
    assert rows[4] == dec.MISSING_FIELD and rows[5] == dec.UNDECODABLE
    encoded = encoded_rows(dec.good_records(decoded), keep=()).collect()
    assert any("seq" in r.measurements.split(",") and "INT64" in r.types for r in encoded)
    assert opened(spark).count() == 0 and opened(spark, head[:-1] + "}").schema["record"].dataType.fieldNames() == [
        "device_id", "timestamp"]


def test_open_fields_have_limits(spark, monkeypatch):
    head = '{"device_id":"d","timestamp":1,'
    with pytest.raises(ValueError, match="case"):
        opened(spark, head + '"a":1,"A":2}')
    monkeypatch.setattr(dec, "MOST_FIELDS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        opened(spark, head + ",".join(f'"f{k}":{k}' for k in range(4)) + "}")


def write_document(folder, subject, name, text, at=None):
    os.makedirs(f"{folder}/{subject}", exist_ok=True)
    with open(f"{folder}/{subject}/{name}", "w") as file:
        file.write(text)
    if at is not None:
        os.utime(f"{folder}/{subject}/{name}", (at, at))


def document(temp, pressure=100.0):
    return json.dumps({"version": 1, "rules": {"max_safe_temp": temp, "max_safe_pressure": pressure}})


def test_documents_in_place_are_polled(spark, tmp_path):
    """Read again after ten seconds at the earliest; a malformed version keeps the limits, over a restart too."""
    now = [100.0]
    polled = sources.PolledDocuments(f"{tmp_path}/in", f"{tmp_path}/state", clock=lambda: now[0])

    def limit(documents):
        return monitor_limits(spark, documents)

    write_document(f"{tmp_path}/in", "line", "control.json", document(50.0), 1000)
    assert limit(polled) == 50.0
    write_document(f"{tmp_path}/in", "line", "control.json", document(60.0), 2000)
    now[0] += 9.9
    assert limit(polled) == 50.0
    now[0] += 0.1
    assert limit(polled) == 60.0
    write_document(f"{tmp_path}/in", "line", "control.json", '{"version": 1, "rules": {', 3000)
    now[0] += 10
    assert limit(polled) == 60.0
    again = sources.PolledDocuments(f"{tmp_path}/in", f"{tmp_path}/state", clock=lambda: now[0])
    assert limit(again) == 60.0
    write_document(f"{tmp_path}/in", "line", "control.json", document(70.0), 4000)
    now[0] += 10
    assert (limit(again), limit(polled)) == (70.0, 70.0)


def monitor_limits(spark, documents):
    from trackline.operators.metrics import current_limits

    return current_limits(documents(spark)).first().temp_max


def test_document_files_are_a_stream(spark, tmp_path):
    """Changes twice with a malformed version between, once to the same text, and one batch is repeated."""
    feed = DocumentFeed(f"{tmp_path}/out", f"{tmp_path}/state")

    def publish(name, text):
        write_document(f"{tmp_path}/in", "line", name, text)
        query = feed.start(sources.document_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/checkpoint", availableNow=True)
        query.awaitTermination(60)
        assert query.exception() is None

    for name, text in (("1.json", document(50.0)), ("2.json", "{"), ("3.json", document(50.0)), ("4.json", document(60.0))):
        publish(name, text)
    changes = sinks.read_committed(spark, feed.out_dir, "control_changes").orderBy("batch").collect()
    assert [(r.batch, r.subject, r.temp_max) for r in changes] == [(0, "line", 50.0), (3, "line", 60.0)]
    assert changes[1].previous_fingerprint == changes[0].fingerprint and changes[0].previous_fingerprint is None
    assert [r.raw_text for r in sinks.read_committed(spark, feed.out_dir, "document_dead_letters").collect()] == ["{"]
    feed.process(sources.document_snapshots(spark, f"{tmp_path}/in").filter("raw_text LIKE '%60.0%'"), 3)
    assert sinks.read_committed(spark, feed.out_dir, "control_changes").count() == 2


def test_latest_lines_are_carried(spark, tmp_path):
    rows = spark.createDataFrame([(f"m{k}", float(k % 50), 100.0, k, k * 37 % 101) for k in range(100)],
                                 "mc_name string, temp double, pressure double, offset long, timestamp long")
    feed = fleet.raw_messages(rows, F.to_json(F.struct("mc_name", "temp", "pressure")).cast("binary"), "machine-events",
                              F.col("offset"), F.timestamp_millis("timestamp"))
    monitor = MetricMonitor(f"{tmp_path}/out", lambda s: s.createDataFrame(
        [], "subject string, timestamp long, seq long, raw_text string"), shown=7)
    newest = []
    for batch_id in range(4):
        part = feed.filter(F.col("offset") % 4 == batch_id)
        monitor.process(part, batch_id)
        if batch_id == 2:
            monitor.process(part, batch_id)  # repeated: nothing is counted twice
        newest += [(k * 37 % 101, k) for k in range(100) if k % 4 == batch_id]
        shown = [(r.timestamp, r.seq) for r in monitor.latest(spark).collect()]
        assert sorted(shown, reverse=True) == sorted(newest, reverse=True)[:7]


@pytest.mark.parametrize("full_every", [20, 2])
def test_a_snapshot_stands_for_all_before(spark, tmp_path, full_every):
    items = random_messages(seed=5, count=300, devices=4)
    old = fresh_monitor(spark, tmp_path / "old", full_every=full_every)
    for batch_id, start in enumerate((0, 60, 120)):
        old.process(as_feed(spark, items[start:start + 60]), batch_id)
    old.write_snapshot(spark, 2, f"{tmp_path}/snapshot")
    new = fresh_monitor(spark, tmp_path / "new", full_every=full_every, snapshot=f"{tmp_path}/snapshot")
    as_feed(spark, items).coalesce(1).write.parquet(f"{tmp_path}/feed")
    covered = spark.read.parquet(f"{tmp_path}/snapshot/offsets")
    stream = new.messages(spark, fmt="parquet", path=f"{tmp_path}/feed")
    taken = stream.writeStream.format("memory").queryName("taken").trigger(availableNow=True).start()
    taken.awaitTermination(60)
    assert {r.offset for r in spark.table("taken").collect()} == set(range(180, 300))  # what is covered is left out
    for batch_id, start in enumerate((180, 220, 260)):
        new.process(as_feed(spark, items[start:start + 40]), batch_id)
    rows, faults = expected(items)
    both = [sinks.read_committed(spark, m.out_dir, "readings") for m in (old, new)]
    assert rows_of(both[0].unionByName(both[1])) == rows
    assert faults_of(sinks.read_table(spark, f"{old.out_dir}/incomplete").unionByName(
        sinks.read_table(spark, f"{new.out_dir}/incomplete"))) == faults
    found = [sinks.read_table(spark, f"{m.out_dir}/alerts") for m in (old, new)]
    whole = alerts.alerts_for(reading_frame(spark, items), rule_frame(spark))
    assert alert_set(found[0].unionByName(found[1])) == alert_set(whole)
    text = json.loads(sources.starting_offsets(covered, ["machine-telemetry"]))
    assert text == {"machine-telemetry": {"0": 1 + max(i["seq"] for i in items[:180] if i["kind"] == "reading")}}


def test_readers_never_see_half_a_batch(spark, tmp_path, monkeypatch):
    """The batch fails after the second of its writes: nothing of it is read, and all of it after the repetition."""
    items = golden_messages()
    monitor = fresh_monitor(spark, tmp_path)
    monitor.process(as_feed(spark, items[:10]), 0)
    tables = ("readings", "incomplete", "dead_letters", "alerts")

    def shown():
        return {name: sorted(map(str, sinks.read_committed(spark, monitor.out_dir, name).collect())) for name in tables}

    before, writes, plain = shown(), [], monitor_module.write_batch

    def breaks(rows, table, batch_id, *rest):
        if len(writes) == 2:
            raise OSError("the store is gone")
        writes.append(table)
        plain(rows, table, batch_id, *rest)

    monkeypatch.setattr(monitor_module, "write_batch", breaks)
    with pytest.raises(OSError):
        monitor.process(as_feed(spark, items[10:]), 1)
    assert len(writes) == 2 and sinks.read_table(spark, f"{monitor.out_dir}/readings").filter("batch = 1").count() > 0
    assert shown() == before and sinks.last_committed(spark, monitor.out_dir) == 0
    monkeypatch.setattr(monitor_module, "write_batch", plain)
    monitor.process(as_feed(spark, items[10:]), 1)
    assert rows_of(sinks.read_committed(spark, monitor.out_dir, "readings")) == expected(items)[0]
    monkeypatch.setattr(monitor_module, "write_batch", breaks)
    writes.clear()
    with pytest.raises(OSError):  # a whole batch that is repeated and fails is taken back
        monitor.process(as_feed(spark, items[10:]), 1)
    assert shown() == before
    assert sinks.last_committed(spark, f"{tmp_path}/nowhere") == -1


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_stored_readings_need_no_exchange(spark, tmp_path, sf_dir):
    timeline = sinks.store_by_device(fleet.press_timeline(spark, sf_dir), "stored_timeline", f"{tmp_path}/timeline", 4)
    tracked = cycles.enriched_rows(cycles.track(timeline, None))
    assert "Window" in plan_of(tracked) and "Exchange" not in plan_of(tracked)
    again = cycles.enriched_rows(cycles.track(fleet.press_timeline(spark, sf_dir), None))
    assert sorted(map(str, tracked.collect())) == sorted(map(str, again.select(*tracked.columns).collect()))
    values = timeline.filter("vibration IS NOT NULL").select(
        "device_id", F.lit("vibration").alias("measurement"), "timestamp", "seq", F.col("vibration").alias("value"))
    assert "Exchange" not in plan_of(spc.violations(spc.evaluate(values)))
    spark.sql("DROP TABLE stored_timeline")


def test_cold_start_knows_event_numbers_of_any_size(spark, sf_dir, tmp_path):
    """Numbers above a million come back as they are."""
    shift = 3_000_000_000
    events = fleet.table(spark, sf_dir, "events")
    events.withColumn("event_id", F.col("event_id") * 1_000 + shift).write.parquet(f"{tmp_path}/events.parquet")
    fleet.table(spark, sf_dir, "supplier").write.parquet(f"{tmp_path}/supplier.parquet")
    build = catalogue()["stream_cold_start"].build
    columns = ("device_id", "timestamp", "run_id", "track_in", "data_point_count", "last_track_out", "seq")
    moved = [tuple(r) for r in build(spark, str(tmp_path)).select(*columns).collect()]
    plain = [(*r[:2], r[2] and f"RUN-{int(r[2][4:]) * 1_000 + shift}", *r[3:6], r[6] * 1_000 + shift)
             for r in build(spark, sf_dir).select(*columns).collect()]
    assert len(moved) > 100 and sorted(moved, key=repr) == sorted(plain, key=repr)


def test_stored_buckets_follow_the_rows(spark, sf_dir, monkeypatch):
    """More rows take more buckets, so what one task sorts stays alike."""
    from trackline.plans import feed_queries

    monkeypatch.setattr(sinks, "BUCKET_ROWS", 50)
    rows = spark.range(1000).select(F.concat(F.lit("d"), F.col("id") % 200).alias("device_id"),
                                    F.col("id").alias("timestamp"), F.col("id").alias("seq"))
    kept = feed_queries.stored(spark, rows)
    assert 8 < len(kept.inputFiles()) <= 20 and kept.count() == 1000
    assert sinks.buckets_for(rows.limit(1), 8) == 8
