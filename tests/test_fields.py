"""Any field name and type is kept; numbers that are not finite raise no false alarms; feeds lose nothing on restart."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.functions.encode import encoded_rows
from trackline.functions.fields import field_name, held
from trackline.operators import cycles, decode, rules, spc
from trackline.operators.limits import limit_breaches
from trackline.operators.slices import plan_slices
from trackline.session import build_session
from trackline.sources import sinks
from trackline.sources.messages import LATEST, feed_start, message_stream

ODD = ("phase", "open", "slice", "prev", "machine_type", "ev", "limit", "rule", "run_id")
EVENTS = "device_id string, event_type string, event_timestamp long, run_id string, part_no string, recipe_name string, seq long"


@pytest.fixture
def odd_readings(spark):
    rows = [("M-1", k, k, *[float(k * 10 + i) for i in range(len(ODD))]) for k in range(60)]
    return spark.createDataFrame(rows, "device_id string, timestamp long, seq long, "
                                 + ", ".join(f"{name} double" for name in ODD))


@pytest.mark.parametrize("max_rows", [None, 10])
def test_reserved_names_survive_tracking(spark, odd_readings, max_rows):
    events = spark.createDataFrame([("M-1", "TRACK_IN", 5, "R", "P", "X", 0)], EVENTS)
    timeline = cycles.build_timeline(odd_readings, events)
    plan = plan_slices(timeline, max_rows) if max_rows else None
    rows = encoded_rows(cycles.enriched_rows(cycles.track(timeline, plan)).filter("kind_rank = 1")).collect()
    assert len(rows) == 60
    for row in rows:
        names, values = row.measurements.split(","), row["values"].split(",")
        assert names[:len(ODD)] == list(ODD)
        assert values[:len(ODD)] == [str(float(int(row.timestamp) * 10 + i)) for i in range(len(ODD))]


def test_reserved_names_are_checked(spark, odd_readings):
    log = spark.createDataFrame([("M", "v1", "p", 0, 0, 100.0, 5.0)],
                                "machine_type string, version string, rule_profile string, offset long, log_time long, "
                                "max_phase double, min_slice double")
    checked = rules.checked_values(rules.attach_latest(odd_readings, log))
    assert {row.measurement for row in checked.collect()} == {"phase", "slice"}
    assert limit_breaches(checked).filter("measurement = 'phase'").count() == 49
    small = rules.checked_values(rules.attach_as_of(odd_readings, log, small_log=True))
    large = rules.checked_values(rules.attach_as_of(odd_readings, log, 10, small_log=False))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_reserved_prefix_is_refused(spark):
    contract = T.StructType.fromDDL("device_id string, timestamp bigint, field__x double")
    messages = spark.createDataFrame([(b"{}", 1)], "value binary, offset long")
    with pytest.raises(ValueError, match="field__"):
        decode.good_records(decode.decode(messages, contract, ["device_id"]))


def test_families_keep_their_types(spark):
    a = spark.createDataFrame([("A-1", 1, 1, "RUNNING", 1.5)], "device_id string, timestamp long, seq long, status string, x double")
    b = spark.createDataFrame([("B-1", 1, 2, 7, 1.1)], "device_id string, timestamp long, seq long, status int, x float")
    both = decode.union_families(a, b)
    rows = {row.device: (row.measurements, row.types, row["values"]) for row in encoded_rows(both).collect()}
    assert list(rows.values()) == [("status,x", "TEXT,DOUBLE", "RUNNING,1.5"), ("status,x", "INT32,FLOAT", "7,1.1")]
    assert {field_name(c) for c in both.columns} == {"device_id", "timestamp", "seq", "status", "x"}
    assert held(held(both)).columns == held(both).columns


def test_infinity_raises_no_false_alarm(spark):
    values = [50 + (k * 7919 % 11) / 10 for k in range(60)]
    values[20] = math.inf
    frame = spark.createDataFrame([("d", "m", k, k, v) for k, v in enumerate(values)],
                                  "device_id string, measurement string, timestamp long, seq long, value double")
    rows = {row.seq: row for row in spc.evaluate(frame).collect()}
    fired = {n: {seq for seq, row in rows.items() if row[f"rule_{n}"]} for n in spc.RULES}
    wild = set(range(20, 45))
    assert not wild & (fired[1] | fired[5] | fired[6] | fired[7])
    assert fired[8] >= wild and fired[2] & wild == set(range(29, 45))


def test_limits_that_are_no_numbers(spark):
    log = spark.createDataFrame([("M", "v", "p", 0, math.nan, 3.0)], "machine_type string, version string, "
                                "rule_profile string, offset long, min_x double, max_x double")
    readings = spark.createDataFrame([("M-1", k, k, float(k)) for k in range(6)] + [("M-1", 9, 9, math.nan)],
                                     "device_id string, timestamp long, seq long, x double")
    found = limit_breaches(rules.checked_values(rules.attach_latest(readings, log))).collect()
    assert sorted((row.seq, row.limit_type) for row in found) == [(4, "upper"), (5, "upper")]


def test_machine_types_stay_text(spark, tmp_path):
    rows = spark.createDataFrame([("007", 1), ("A", 2)], "machine_type string, v int")
    sinks.write_batch(rows.filter("v = 1"), f"{tmp_path}/t", 0, ["machine_type"])
    assert sinks.read_table(spark, f"{tmp_path}/t").first().machine_type == "007"


def test_file_feed_restarts_where_it_began(spark, tmp_path):
    def put(name, offset):
        frame = spark.range(1).select(
            F.lit(None).cast("binary").alias("key"), F.lit(b"x").alias("value"), F.lit("t").alias("topic"),
            F.lit(0).alias("partition"), F.lit(offset).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    seen = []

    def run():
        stream = message_stream(spark, ["t"], LATEST, fmt="parquet", path=f"{tmp_path}/in", started=f"{tmp_path}/started")
        query = stream.writeStream.foreachBatch(lambda rows, _: seen.extend(r.offset for r in rows.collect())).option(
            "checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        query.awaitTermination()

    put("old", 0)
    first = feed_start(spark, f"{tmp_path}/started")
    assert feed_start(spark, f"{tmp_path}/started") == first
    put("a", 1)
    run()
    put("while it was down", 2)
    run()
    assert sorted(seen) == [1, 2]


def test_partitions_follow_the_data(spark):
    """Adaptive execution starts from many partitions and merges them by size."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "64")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    try:
        def parts(rows):
            frame = spark.range(rows).select(F.concat(F.lit("d-"), F.col("id") % 100).alias("device_id"),
                                             F.col("id").alias("timestamp"), F.col("id").alias("seq"),
                                             F.rand(1).alias("value"), F.lit("m").alias("measurement"))
            return spc.evaluate(frame).rdd.getNumPartitions()

        assert parts(1000) < parts(200_000) <= 64
    finally:
        for name in ("coalescePartitions.initialPartitionNum", "advisoryPartitionSizeInBytes",
                     "coalescePartitions.minPartitionSize"):
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert build_session is not None


def test_small_rule_logs_move_no_reading(spark, odd_readings):
    log = spark.createDataFrame([("M", "v1", "p", 0, 0, 100.0)], "machine_type string, version string, "
                                "rule_profile string, offset long, log_time long, max_phase double")
    plan = rules.attach_as_of(odd_readings, log)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert "device_id" not in " ".join(line for line in plan.split("\n") if "hashpartitioning" in line)


def test_long_time_lines_are_cut(spark, monkeypatch):
    """The time line of one machine type is spread over tasks long before it is too large for one."""
    plans = []
    monkeypatch.setattr(rules, "plan_slices", lambda *given, **named: plans.append(plan_slices(*given, **named)) or plans[-1])
    readings = spark.range(300_000).select(F.lit("Press-A-1").alias("device_id"), F.col("id").alias("timestamp"),
                                           F.col("id").alias("seq"), F.lit(1.0).alias("vibration"))
    log = spark.range(0, 300_000, 1000).select(
        F.lit("Press-A").alias("machine_type"), F.col("id").alias("offset"), F.col("id").alias("log_time"),
        F.col("id").cast("string").alias("version"), F.lit("P").alias("rule_profile"), F.lit(0.5).alias("max_vibration"))
    ruled = rules.attach_as_of(readings, log, small_log=False)
    assert plans[0] is not None and plans[0].slices > 1
    assert ruled.filter("rule.version <> string(timestamp - timestamp % 1000)").count() == 0 and ruled.count() == 300_000
