from __future__ import annotations

import bisect
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import reading_frame, rule_frame, random_messages
from trackline.functions import names, wire
from trackline.functions.encode import type_tag
from trackline.functions.numbers import decimal_text, round_one_decimal
from trackline.operators import decode as dec
from trackline.operators import limits, metrics, rules
from trackline.operators.slices import carry_forward, plan_slices
from trackline.session import bounded_broadcast
from trackline.sources import contracts, messages


def column_of(frame, column):
    return [r[0] for r in frame.select(column).collect()]


# names and numbers

def test_names(spark):
    ids = spark.createDataFrame([("Press-A-01",), ("CNC-07",), ("Oven",), ("A-1-2",)], "d string")
    assert column_of(ids, names.machine_type(F.col("d"))) == ["Press-A", "CNC", "Oven", "A-1"]
    assert column_of(ids, names.device_path(F.col("d")))[0] == "root.local.home.arpa.Press_A.Press_A_01"
    assert column_of(spark.createDataFrame([(None,)], "d string"), names.routing_key(F.col("d"))) == ["__unrouted__"]


def test_rounding_equals_exact_rounding(spark):
    rng = random.Random(4)
    values = [k / 100 for k in range(-2000, 12000, 5)] + [rng.uniform(-1e6, 1e6) for _ in range(2000)]
    values += [40.15, 0.25, 0.35, 0.05, 1e12 + 0.25, 123456.75, 2.675, float("inf")]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    got = column_of(frame, round_one_decimal(F.col("x")))
    assert got == [round(v, 1) for v in values]


def test_decimal_text(spark):
    frame = spark.createDataFrame([(75.0,), (12345678.5,), (0.1,)], "x double")
    assert column_of(frame, decimal_text(F.col("x"))) == ["75.0", "12345678.5", "0.1"]


# wire and decode

REQUIRED = ["device_id", "timestamp"]


def feed(spark, *values):
    return spark.createDataFrame([(None, v, "t", 0, i, None) for i, v in enumerate(values)], messages.MESSAGE_SCHEMA)


def test_header(spark):
    frame = feed(spark, b"\x00\x00\x00\x01\x02{}", b"{}", b"\x00abcd", b"\x00abcde")
    assert column_of(frame, wire.schema_id(F.col("value"))) == [258, None, None, 0x61626364]
    bodies = [bytes(b) for b in column_of(frame, wire.message_body(F.col("value")))]
    assert bodies == [b"{}", b"{}", b"\x00abcd", b"e"]
    again = column_of(frame, wire.message_body(wire.add_header(F.col("value"), F.lit(7).cast("long"))))
    assert [bytes(b) for b in again][1] == b"{}"


def test_decode_outcomes(spark):
    good = {"device_id": "d", "timestamp": 1, "vibration": 2.5, "status": "a,b"}
    frame = feed(
        spark,
        json.dumps(good).encode(),
        b"\x00\x00\x00\x00\x01" + json.dumps(good).encode(),
        b"\x00\x00\x00\x00\x01This is a completely invalid raw text packet string!",
        None,
        json.dumps({**good, "device_id": None}).encode(),
        json.dumps({"device_id": "d"}).encode(),
        b"\xc3\x28",
        json.dumps({**good, "vibration": "high"}).encode(),
        json.dumps({**good, "extra": 1}).encode(),
        b"",
    )
    decoded = dec.decode(frame, contracts.TELEMETRY, REQUIRED)
    errors = {r.offset: r.error for r in decoded.collect()}
    assert errors == {0: None, 1: None, 2: "undecodable", 4: "missing_required_field", 5: "missing_required_field",
                      6: "undecodable", 7: "undecodable", 8: None, 9: "undecodable"}
    letters = {r.offset: r for r in dec.dead_letters(decoded, "t").collect()}
    assert bytes(letters[6].raw) == b"\xc3\x28" and letters[6].raw_text == "�("
    assert bytes(letters[2].raw).startswith(b"\x00\x00\x00\x00\x01This is")
    first = dec.good_records(decoded).filter("seq = 0").first()
    assert (first.vibration, first.temperature, first.status) == (2.5, None, "a,b")


def test_one_parse_per_message(spark):
    decoded = dec.decode(feed(spark, b"{}"), contracts.TELEMETRY, REQUIRED)
    plan = dec.good_records(decoded)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_strict_contract(spark):
    body = {"id": "2009", "name": "A"}
    frame = feed(spark, json.dumps(body).encode(), json.dumps({**body, "id": 2009, "phone": "1"}).encode(),
                 json.dumps({**body, "email": None}).encode(), json.dumps({**body, "phone": "1"}).encode())
    errors = column_of(dec.decode(frame, contracts.USER, ["id", "name"], strict=True), "error")
    assert errors == [None, "contract_violation", None, None]


def test_numeric_fields_and_tags(spark):
    record = spark.createDataFrame([("d", 1, 2.5, None, 3, True, "x")],
                                   "device_id string, timestamp long, a double, b double, c int, e boolean, f string")
    assert column_of(record, dec.numeric_fields(record)) == [{"a": 2.5, "c": 3.0}]
    tags = [type_tag(f.dataType) for f in record.schema.fields]
    assert tags == ["TEXT", "INT64", "DOUBLE", "DOUBLE", "INT32", "BOOLEAN", "TEXT"]
    assert type_tag(T.BinaryType()) is None and type_tag(T.ArrayType(T.LongType())) is None


def test_unusable_rules_go_to_the_dead_letters(spark):
    rule = {"machine_type": "Press-A", "version": "v1", "max_vibration": 5.5}
    frame = feed(spark, json.dumps(rule).encode(), b"no rule", json.dumps({**rule, "machine_type": None}).encode(),
                 None, json.dumps({**rule, "version": "v2"}).encode())
    decoded = dec.decode_rule_log(frame, contracts.CONTROL)
    latest = rules.latest_rules(dec.rule_records(decoded)).collect()
    assert [(r.version, r.offset) for r in latest] == [("v2", 4)]
    assert {(r.offset, r.error) for r in dec.dead_letters(decoded, "c").collect()} == {
        (1, "undecodable"), (2, "missing_required_field")}


def test_results_do_not_depend_on_the_session_zone(spark, sf_dir):
    from trackline.sources import fleet

    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    ours = fleet.press_messages(spark, sf_dir).agg(F.sum("timestamp")).first()
    assert fleet.press_messages(other, sf_dir).agg(F.sum("timestamp")).first() == ours


def test_shared_folder_comes_from_the_session(spark):
    from trackline.session import shared_dir

    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert folder == (configured or spark.sparkContext.getCheckpointDir())
    assert shared_dir(spark) == folder


def test_contract_from_avro_schema():
    text = json.dumps({"type": "record", "name": "X", "fields": [
        {"name": "a", "type": "string"}, {"name": "b", "type": ["null", "long"]},
        {"name": "c", "type": ["null", "string", "double"]}, {"name": "d", "type": "bytes"},
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["P"]}},
        {"name": "f", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "g", "type": {"type": "array", "items": "int"}}]})
    schema = contracts.struct_from_avsc(text)
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields] == [
        ("a", "string", False), ("b", "bigint", True), ("c", "double", True), ("f", "bigint", False)]
    assert contracts.required_fields(schema) == ["a", "f"]
    with pytest.raises(ValueError):
        contracts.struct_from_avsc('{"type": "enum", "name": "E", "symbols": []}')


# rules and limits

def test_new_limit_fields_need_no_change(spark):
    log = spark.createDataFrame(
        [("Lathe", "v1", "p", 0, 900.0, None, 4), ("Lathe", "v2", "p", 1, 1000.0, 0.5, None)],
        "machine_type string, version string, rule_profile string, offset long, max_spindle_rpm double, "
        "min_tool_life double, max_count int")
    long = rules.rules_long(rules.latest_rules(log)).collect()
    assert {(r.measurement, r.upper, r.lower) for r in long} == {
        ("spindle_rpm", 1000.0, None), ("tool_life", None, 0.5)}
    maps = rules.limit_maps(log).filter("version = 'v1'").first()
    assert maps.upper == {"spindle_rpm": 900.0, "count": 4.0} and maps.lower == {}
    assert rules.limited_measurements(log.schema) == ["spindle_rpm", "tool_life", "count"]


def test_breaches_are_strict_and_skip_missing_values(spark):
    readings = spark.createDataFrame(
        [("Press-A-1", i, i, v, 80.0) for i, v in enumerate([5.5, 5.6, 1.5, 1.4, None, float("nan")])]
        + [("Oven-1", 9, 9, 99.0, 80.0)],
        "device_id string, timestamp long, seq long, vibration double, temperature double")
    checked = rules.checked_values(rules.attach_latest(readings, rule_frame(spark)))
    found = limits.limit_breaches(checked).collect()
    assert {(r.seq, r.limit_type, r.limit_value) for r in found} == {(1, "upper", 5.5), (3, "lower", 1.5)}
    assert checked.filter("measurement = 'vibration'").count() == 4
    both = spark.createDataFrame([(0, -1, "v", "Press-A", 1.0, 9.0, None, None, None, None, "p")],
                                 rule_frame(spark).schema)
    checked = rules.checked_values(rules.attach_latest(readings.filter("seq = 0"), both))
    assert limits.limit_breaches(checked).count() == 2


# slices

def test_slices_cover_a_burst(spark):
    """A third of all rows of the hot key within one second of a year, and some at one millisecond."""
    rng = random.Random(8)
    year = 365 * 86_400_000
    times = [rng.randrange(year) for _ in range(600)] + [7_000_000 + rng.randrange(1000) for _ in range(300)]
    rows = [("hot", t) for t in times] + [("hot", 9_000_000)] * 120 + [("cold", 1)]
    frame = spark.createDataFrame(rows, "device_id string, timestamp long")
    plan = plan_slices(frame, 50)
    assert plan.hot_keys == 1 and len(plan.grids) > 1
    placed = [(r.device_id, r.timestamp, r.slice) for r in plan.assign(frame).collect()]
    assert len(placed) == len(rows)
    assert [s for d, _, s in placed if d == "cold"] == [0]
    hot = sorted((t, s) for d, t, s in placed if d == "hot")
    assert [s for _, s in hot] == sorted(s for _, s in hot)  # slices follow time
    sizes: dict[int, int] = {}
    for t, s in hot:
        if t != 9_000_000:  # rows of one millisecond stay together
            sizes[s] = sizes.get(s, 0) + 1
    assert max(sizes.values()) <= 50 + 10
    listed = {r.slice for r in plan.slice_list().collect()}
    assert {s for _, s in hot} <= listed
    assert plan_slices(frame, 10_000) is None


def test_bursts_do_not_change_results(spark):
    from fixtures import event_frame
    from trackline.operators import cycles

    items = random_messages(12, 300, 2)
    for m in items:
        if 100 <= m["seq"] < 250:
            m["timestamp"] = items[100]["timestamp"] + (m["seq"] - 100) // 3
        elif m["seq"] >= 250:
            m["timestamp"] += 10_000_000
    line = cycles.build_timeline(reading_frame(spark, items), event_frame(spark, items))
    plan = plan_slices(line, 12)
    assert len(plan.grids) > 1
    whole, sliced = (cycles.enriched_rows(cycles.track(line, p)) for p in (None, plan))
    assert whole.exceptAll(sliced).count() == 0 and whole.count() == sliced.count()
    values = reading_frame(spark, items).select(
        "device_id", F.lit("m").alias("measurement"), "timestamp", "seq", F.col("vibration").alias("value"))
    from trackline.operators import spc

    whole, sliced = spc.evaluate(values), spc.evaluate(plan.assign(values), plan)
    assert whole.exceptAll(sliced).count() == 0 and whole.count() == sliced.count()


def test_grids_have_no_more_cells_than_rows(spark):
    """Many small hot keys, half of their rows in a burst: counting costs what the rows cost, on every grid."""
    number = F.col("id")
    time = F.when(number % 200 < 100, number * 7919 % 2_700_000_000).otherwise(F.lit(1_000_000_000) + number % 997)
    rows = spark.range(2000).select(F.concat(F.lit("k"), number % 100).alias("k"), time.alias("timestamp"))
    plan = plan_slices(rows, 4, key="k")
    assert len(plan.grids) > 1
    for grid in plan.grids:
        assert grid.table.agg(F.sum(F.size("_slice_of"))).first()[0] <= 2000
    slices = plan.assign(rows).groupBy("k", "slice").count()
    assert slices.agg(F.sum("count")).first()[0] == 2000 and slices.agg(F.max("count")).first()[0] <= 2 * 4


@pytest.mark.parametrize("max_rows", [3, 20, 10_000])
def test_carry_forward(spark, max_rows):
    rng = random.Random(6)
    rows = [(f"k{rng.choice([0, 0, 1, 2])}", t, t, str(t) if rng.random() < 0.1 else None) for t in range(200)]
    frame = spark.createDataFrame(rows, "k string, timestamp long, seq long, v string")
    plan = plan_slices(frame, max_rows, key="k")
    got = {r.seq: r.carried for r in carry_forward(frame, "v", "k", ["timestamp", "seq"], plan).collect()}
    last: dict[str, str | None] = {}
    for key, _, seq, value in rows:
        assert got[seq] == last.get(key)
        last[key] = value or last.get(key)


def test_broadcast_is_bounded(spark):
    assert "broadcast" in bounded_broadcast(spark.range(10), 10)._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in bounded_broadcast(spark.range(11), 10)._jdf.queryExecution().logical().toString().lower()


# simple monitor

DOCUMENTS = "subject string, timestamp long, seq long, raw_text string"


def document(temp, pressure):
    return json.dumps({"version": 4, "rules": {"max_safe_temp": temp, "max_safe_pressure": pressure}})


@pytest.mark.parametrize("max_rows", [2, 10_000])
def test_control_changes(spark, max_rows):
    texts = [document(40.0, 120.0), document(40.0, 120.0), '{"version": ', document(40.0, 120.0),
             document(55.0, 145.0), '{"rules": {"max_safe_temp": 1}}', document(55.0, 145.0)]
    frame = spark.createDataFrame([("s", i, i, t) for i, t in enumerate(texts)], DOCUMENTS)
    changes = metrics.control_changes(frame, max_rows).orderBy("seq").collect()
    assert [r.seq for r in changes] == [0, 4]
    limits_now = metrics.current_limits(frame).first()
    assert (limits_now.temp_max, limits_now.pressure_max) == (55.0, 145.0)


def test_defaults_without_a_document(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    rows = spark.createDataFrame([(None, 40.0, None, 0, 0), ("m", 40.1, 120.1, 1, 1)],
                                 "mc_name string, temp double, pressure double, seq long, timestamp long")
    checked = metrics.check_metrics(rows, metrics.current_limits(empty))
    log = metrics.latest_lines(checked).collect()
    assert [r.seq for r in log] == [1, 0]
    assert log[1].line == ("\U0001F4E5 Telemetry Logged [Offset 0][Config v.unknown]: Unknown-Machine is normal "
                           "(40.0°C, 0.0 PSI).")
    assert log[0].temp_breached and log[0].pressure_breached


def test_readings_of_a_random_feed_keep_their_number(spark):
    items = random_messages(1, 50, 3)
    frame = reading_frame(spark, items)
    assert dec.union_families(frame, frame.drop("status")).count() == 2 * frame.count()


@pytest.mark.parametrize("crowd", [3, 16])
def test_rules_in_force_by_time_cells(spark, crowd):
    """Bursts, equal times, rules before and after all readings: the index finds what a scan of the log finds."""
    rng = random.Random(4)
    times = [rng.randrange(10 ** 9) for _ in range(200)] + [5 * 10 ** 8 + rng.randrange(40) for _ in range(300)] + [7] * 5
    log = [(k, t, f"v{k}", rng.choice(["Press-A", "Press-B"]), 1.0, "p") for k, t in enumerate(times)]
    log += [(900, None, "no time", "Press-A", 1.0, "p"), (901, 3, "no type", None, 1.0, "p"),
            (902, 50, "alone", "Press-C", 1.0, "p")]
    frame = spark.createDataFrame(log, "offset long, log_time long, version string, machine_type string, max_x double, "
                                       "rule_profile string")
    asked = sorted({0, 6, 7, 8, 49, 50, 2 * 10 ** 9, *(t + d for t in times for d in (-1, 0, 1))})
    readings = spark.createDataFrame([(f"Press-{m}-1", t, t, 2.0) for m in "ABCD" for t in asked],
                                     "device_id string, timestamp long, seq long, x double")
    index = rules.rule_index(frame, crowd)
    found = {(r.machine_type, r.timestamp): r.version for r in index.attach(readings.withColumn(
        "machine_type", F.regexp_extract("device_id", "^[^-]+-[A-Z]", 0))).select(
        "machine_type", "timestamp", "rule.version").collect()}
    expected = {}
    for m in ("Press-A", "Press-B", "Press-C"):
        for t in asked:
            past = [(at, k, v) for k, at, v, kind, *_ in log if kind == m and at is not None and at <= t]
            if past:
                expected[m, t] = max(past)[2]
    assert found == expected
    crowds = index.spans.groupBy("machine_type", "_start").count().agg(F.max("count"), F.sum("count")).first()
    assert crowds[0] <= crowd + 1 and crowds[1] <= 8 * len(log)
    assert rules.rule_index(frame.limit(0)).attach(readings.withColumn("machine_type", F.lit("Press-A"))).count() == 0


def test_long_rule_log(spark):
    """100,000 rules: every reading meets a few of them, and none is shuffled."""
    n = F.col("id")
    log = spark.range(100_000).select(
        n.alias("offset"), (n * 7919 % 10 ** 8).alias("log_time"), F.concat(F.lit("v"), n).alias("version"),
        F.concat(F.lit("Press-"), F.when(n % 2 == 0, "A").otherwise("B")).alias("machine_type"), F.lit(1.0).alias("max_x"),
        F.lit("p").alias("rule_profile"))
    readings = spark.range(2000).select(F.lit("Press-A-1").alias("device_id"), (n * 50_000 + 100_000).alias("timestamp"),
                                        n.alias("seq"), F.lit(2.0).alias("x"))
    found = {r.timestamp: r.version for r in rules.attach_as_of(readings, log).select("timestamp", "rule.version").collect()}
    starts = sorted((k * 7919 % 10 ** 8, k) for k in range(0, 100_000, 2))
    assert found == {t: f"v{starts[bisect.bisect_right(starts, (t, 10 ** 9)) - 1][1]}"
                     for t in range(100_000, 100_100_000, 50_000)}
    most = rules.rule_index(log).spans.groupBy("machine_type", "_start").count().agg(F.max("count")).first()
    assert most[0] <= rules.CROWD + 1
