"""The driver tables read as a machine fleet.

events    presses: clicks and views are readings, sign-ups open a cycle, purchases close one
lineitem  lathes: one series per supplier
supplier  limit records for the two press types, in supplier order
orders    snapshots of a control document, one subject per customer
customer  user records
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.functions.wire import add_header
from trackline.operators.cycles import EVENT, event_struct
from trackline.sources import contracts

# Timestamps are declared as plain UTC instants, so results do not depend on the session zone.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}

# How event types of the driver table read as machine activity.
TURNS = ("signup", "purchase", "error")
READINGS = ("click", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def press_id(user_id: Column) -> Column:
    family = F.when(user_id % 2 == 0, "Press-A-").otherwise("Press-B-")
    return F.concat(family, F.lpad(user_id.cast("string"), 10, "0"))


def props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def press_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event row with its device, millisecond and sequence number."""
    return table(spark, sf_dir, "events").select(
        press_id(F.col("user_id")).alias("device_id"),
        F.unix_millis("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
        "event_type", "value", "props",
    )


def press_readings(spark: SparkSession, sf_dir: str, all_types: bool = False) -> DataFrame:
    """Telemetry; with `all_types` every row counts as a reading (long series for zone rules)."""
    rows = press_messages(spark, sf_dir)
    if not all_types:
        rows = rows.filter(F.col("event_type").isin(*READINGS))
    return rows.select("device_id", "timestamp", "seq", F.col("value").alias("vibration"),
                       props_k().alias("temperature"), F.col("event_type").alias("status"))


def press_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context events, unrecognised ones included."""
    rows = press_messages(spark, sf_dir).filter(F.col("event_type").isin(*TURNS))
    kind = F.when(F.col("event_type") == "signup", "TRACK_IN").when(
        F.col("event_type") == "purchase", "TRACK_OUT").otherwise("PAUSE")
    opened = F.col("event_type") == "signup"
    return rows.select(
        "device_id", "seq", kind.alias("event_type"), F.col("timestamp").alias("event_timestamp"),
        F.when(opened, F.concat(F.lit("RUN-"), "seq")).alias("run_id"),
        F.when(opened, F.concat(F.lit("PART-"), "seq")).alias("part_no"),
        F.when(opened, F.concat(F.lit("RECIPE_"), F.get_json_object("props", "$.k"))).alias("recipe_name"),
    )


def press_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and recognised events from one scan of the event table."""
    reading = F.col("event_type").isin(*READINGS)
    opened = F.col("event_type") == "signup"
    ev = event_struct(
        F.when(opened, "TRACK_IN").otherwise("TRACK_OUT"), F.col("timestamp"),
        F.when(opened, F.concat(F.lit("RUN-"), "seq")), F.when(opened, F.concat(F.lit("PART-"), "seq")),
        F.when(opened, F.concat(F.lit("RECIPE_"), F.get_json_object("props", "$.k"))))
    return press_messages(spark, sf_dir).filter(F.col("event_type").isin(*READINGS, "signup", "purchase")).select(
        "device_id", "timestamp", F.when(reading, 1).otherwise(0).alias("kind_rank"), "seq",
        F.when(~reading, ev).cast(EVENT).alias("ev"),
        F.when(reading, F.col("value")).alias("vibration"),
        F.when(reading, props_k()).alias("temperature"),
        F.when(reading, F.col("event_type")).alias("status"),
    )


def lathe_readings(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Telemetry of the lathes: ship date plus an order-based time of day, in milliseconds; `extra` adds table columns."""
    position = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("Lathe-"), F.lpad(F.col("l_suppkey").cast("string"), 10, "0")).alias("device_id"),
        (F.unix_millis("l_shipdate") + position % 86_400_000).alias("timestamp"),
        (position * 1_048_576 + F.col("l_partkey") % 1_048_576).alias("seq"),
        F.col("l_quantity").alias("spindle_rpm"),
        F.col("l_extendedprice").alias("cutting_force"),
        F.col("l_discount").alias("coolant_pressure"),
        F.col("l_linestatus").alias("status"),
        *extra,
    )


def rule_log(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Published limit records of the two press types, one every six hours; `extra` adds table columns."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("offset"),
        (F.lit(1_704_067_200_000) + key * 21_600_000).alias("log_time"),
        F.concat(F.lit("v"), key).alias("version"),
        F.when(key % 2 == 0, "Press-A").otherwise("Press-B").alias("machine_type"),
        (F.lit(100.0) + F.col("s_nationkey")).alias("max_vibration"),
        (F.col("s_nationkey") / 10.0).alias("min_vibration"),
        (F.lit(60.0) + F.col("s_nationkey")).alias("max_temperature"),
        F.when(F.col("s_acctbal") >= 0, F.lit(5.0)).alias("min_temperature"),
        F.lit(75.0).alias("max_pressure"),
        F.when(F.col("s_nationkey") % 2 == 0, "HIGH_PRECISION_STRICT")
        .otherwise("STANDARD_HEAVY_DUTY").alias("rule_profile"),
        *extra,
    )


def long_rule_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long rule log: one record per order, spread over a month, but every third one within a single second."""
    key = F.col("o_orderkey")
    spread = F.when(key % 3 == 0, F.lit(1_000_000_000) + key % 1000).otherwise(key * 7_919_317 % F.lit(2_700_000_000))
    return table(spark, sf_dir, "orders").select(
        key.alias("offset"), (F.lit(1_704_067_200_000) + spread).alias("log_time"),
        F.concat(F.lit("o"), key).alias("version"), F.when(key % 2 == 0, "Press-A").otherwise("Press-B").alias("machine_type"),
        (F.lit(40.0) + key % 60).alias("max_vibration"), F.lit("STANDARD_HEAVY_DUTY").alias("rule_profile"))


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields)).cast("binary")


def raw_messages(rows: DataFrame, value: Column, topic: str, offset: Column, time: Column) -> DataFrame:
    """Rows in the layout of a message source.

    The generator keeps later uses of `value` from building the body again each time.
    """
    return rows.select(
        F.lit(None).cast("binary").alias("key"), F.explode(F.array(value)).alias("value"), F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"), offset.alias("offset"), time.alias("timestamp"))


def telemetry_messages(spark: SparkSession, sf_dir: str, event_types: tuple[str, ...] = ()) -> DataFrame:
    """One telemetry message per event row (of the given types). The number in `props` decides what is wrong with it:
    below 5 random text, below 10 no header, below 13 no value, below 16 no device, below 19 no
    timestamp, below 21 bytes that are not UTF-8, below 23 text in a numeric field.
    """
    rows = press_messages(spark, sf_dir).withColumn("k", props_k())
    if event_types:
        rows = rows.filter(F.col("event_type").isin(*event_types))
    k = F.col("k")
    device = F.when((k < 13) | (k >= 16), F.col("device_id")).alias("device_id")
    time = F.when((k < 16) | (k >= 19), F.col("timestamp")).alias("timestamp")
    rest = [F.col("value").alias("vibration"), k.alias("temperature"), F.lit(65.5).alias("pressure"),
            F.concat(F.col("event_type"), F.lit(",x")).alias("status")]
    good = _json(device, time, *rest)
    text_in_number = _json(device, time, F.lit("n/a").alias("vibration"), *rest[1:])
    number = (F.lit(1) + F.col("seq") % 3).cast("long")
    value = (
        F.when(k < 5, add_header(F.lit(b"This is not a record"), number))
        .when(k < 10, good)
        .when(k < 13, F.lit(None).cast("binary"))
        .when((k >= 19) & (k < 21), add_header(F.unhex(F.lit("C328FF")), number))
        .when((k >= 21) & (k < 23), add_header(text_in_number, number))
        .otherwise(add_header(good, number))
    )
    return raw_messages(rows, value, "machine-telemetry", F.col("seq"), F.timestamp_millis("timestamp"))


#: Three versions of the telemetry contract, by schema id, and the one all are read as.
VERSIONS = {
    1: contracts.record_schema("Telemetry", device_id="string", timestamp="long", vibration="double",
                               temperature="double", status="string"),
    2: contracts.record_schema("Telemetry", device_id="string", timestamp="long", vibration="int", temperature="int",
                               pressure="double"),
    3: contracts.record_schema("Telemetry", machine="string", timestamp="int", vibration="float", humidity="double"),
    5: contracts.record_schema("Telemetry", device_id="string", timestamp="long", vibration="string"),
}
READER = contracts.record_schema(
    "Telemetry", device_id={"type": "string", "aliases": ["machine"]}, timestamp="long", vibration="double",
    temperature={"type": ["null", "double"], "default": None}, pressure={"type": "double", "default": 65.5},
    status={"type": "string", "default": "UNKNOWN"})


def versioned_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One telemetry message per event row, of six kinds in turn: the three versions, one with an id that nobody knows, one
    whose schema does not fit, and one without a header in the reader's own schema.
    """
    rows = press_messages(spark, sf_dir).withColumn("k", props_k())
    kind, device, time = F.col("seq") % 6, F.col("device_id"), F.col("timestamp")
    whole, number = F.floor("value"), F.col("k").cast("int")
    first = _json(device, time, F.col("value").alias("vibration"), F.col("k").alias("temperature"),
                  F.col("event_type").alias("status"))
    second = _json(device, time, whole.alias("vibration"), number.alias("temperature"), F.col("value").alias("pressure"))
    third = _json(device.alias("machine"), F.col("seq").alias("timestamp"), (whole + 0.5).alias("vibration"),
                  F.lit(0.4).alias("humidity"))
    text = _json(device, time, F.lit("high").alias("vibration"))
    value = (F.when(kind == 0, add_header(first, F.lit(1).cast("long"))).when(kind == 1, add_header(second, F.lit(2).cast("long")))
             .when(kind == 2, add_header(third, F.lit(3).cast("long"))).when(kind == 3, add_header(first, F.lit(99).cast("long")))
             .when(kind == 4, add_header(text, F.lit(5).cast("long"))).otherwise(first))
    return raw_messages(rows, value, "machine-telemetry", F.col("seq"), F.timestamp_millis("timestamp"))


def open_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry with fields no contract names: `humidity` (a whole number at times), `mode`, `armed`, `probe` (nested)."""
    rows = press_messages(spark, sf_dir).withColumn("k", props_k())
    odd = F.col("seq") % 2 == 1
    body = F.concat(
        F.lit('{"device_id":"'), "device_id", F.lit('","timestamp":'), "timestamp", F.lit(',"vibration":'),
        F.col("value").cast("string"), F.lit(',"humidity":'), F.when(odd, F.col("k").cast("int").cast("string")).otherwise(
            F.concat(F.col("k").cast("int"), F.lit(".5"))),
        F.when(odd, F.concat(F.lit(',"mode":"'), "event_type", F.lit('"'))).otherwise(
            F.concat(F.lit(',"armed":'), F.when(F.col("k") > 50, "true").otherwise("false"))),
        F.when(F.col("seq") % 3 == 0, F.concat(F.lit(',"probe":{"id":'), "seq", F.lit("}"))).otherwise(""),
        F.when(F.col("k") < 5, "").otherwise("}"))
    return raw_messages(rows, body.cast("binary"), "machine-telemetry", F.col("seq"), F.timestamp_millis("timestamp"))


def control_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control document per line (order priority) and two-year period, with limits from all orders of it.

    Lines 2 and 4 hold a broken document in the third period; line 3 never changes after the first.
    """
    line, period = F.substring("o_orderpriority", 1, 1).cast("int"), F.floor((F.year("o_orderdate") - 1990) / 2)
    orders = table(spark, sf_dir, "orders").select(line.alias("line"), period.cast("int").alias("period"), "o_orderkey")
    found = orders.groupBy("line", "period").agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("last"))
    steady = F.col("line") == 3
    text = F.concat(F.lit('{"version": '), "line", F.lit(', "rules": {"max_safe_temp": '),
                    F.when(steady, F.lit(7)).otherwise(F.col("orders")), F.lit('.5, "max_safe_pressure": '),
                    F.when(steady, F.lit(7)).otherwise(F.col("last")), F.lit(".0}}"))
    broken = F.col("line").isin(2, 4) & (F.col("period") % 4 == 0)
    return found.select("line", "period", F.when(broken, F.lit('{"version": 1, "rules": {')).otherwise(text).alias("raw_text"))


def context_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context events as messages; absent run, part and recipe are left out of the body."""
    rows = press_events(spark, sf_dir)
    fields = ["device_id", "event_type", "event_timestamp", "run_id", "part_no", "recipe_name"]
    body = add_header(_json(*[F.col(f) for f in fields]), F.lit(2).cast("long"))
    return raw_messages(rows, body, "machine-context-events", F.col("seq"), F.timestamp_millis("event_timestamp"))


def control_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limit records as messages: nations 20-21 send no record, nation 22 one without a machine type."""
    rows = rule_log(spark, sf_dir, "s_nationkey")
    nation = F.col("s_nationkey")
    kept = F.when(nation != 22, F.col("machine_type")).alias("machine_type")
    fields = [c for c in rows.columns if c not in ("offset", "log_time", "machine_type", "s_nationkey")]
    body = F.when(nation.isin(20, 21), F.lit(b"This is not a record")).otherwise(
        _json(kept, *[F.col(f) for f in fields]))
    return raw_messages(rows, add_header(body, F.lit(3).cast("long")), "machine-control", F.col("offset"),
                        F.timestamp_millis("log_time"))


def metric_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics as messages; some have an empty machine name or a temperature above 1000."""
    rows = press_messages(spark, sf_dir).withColumn("k", props_k())
    name = F.when(F.col("k") < 3, "").otherwise(F.col("device_id"))
    body = add_header(_json(name.alias("mc_name"), (F.col("value") * 4).alias("temp"),
                            (F.col("value") + 100).alias("pressure")), F.lit(4).cast("long"))
    return raw_messages(rows, body, "machine-events", F.col("seq"), F.timestamp_millis("timestamp"))


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records as messages: nations 0-4 send a number as id, nations 5-6 send no record at all."""
    nation = F.col("c_nationkey")
    name = F.col("c_name").alias("name")
    email = F.when(F.col("c_acctbal") >= 0, F.concat("c_name", F.lit("@example.com"))).alias("email")
    user = F.concat(F.lit("U"), "c_custkey").alias("id")
    body = (
        F.when(nation < 5, _json(F.col("c_custkey").alias("id"), name, email, F.lit("555").alias("phone")))
        .when(nation < 7, F.lit(b"This is not a record"))
        .otherwise(_json(user, name, email))
    )
    return raw_messages(table(spark, sf_dir, "customer"), add_header(body, F.lit(1).cast("long")), "user-events",
                        F.col("c_custkey"), F.timestamp_millis(F.col("c_custkey")))


def lathe_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the simple monitor, one per line item."""
    position = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("Lathe-"), "l_suppkey").alias("mc_name"),
        (F.col("l_extendedprice") / 100).alias("temp"),
        F.when(F.col("l_quantity") > 1, F.col("l_quantity") * 3.05).alias("pressure"),
        (position * 1_048_576 + F.col("l_partkey") % 1_048_576).alias("seq"),
        (F.unix_millis("l_shipdate") + position % 86_400_000).alias("timestamp"),
    )


def control_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of a control document; pending orders hold a broken one."""
    level = F.substring("o_orderpriority", 1, 1).cast("int")
    whole = F.concat(F.lit('{"version": '), level, F.lit(', "rules": {"max_safe_temp": '), level * 100 + 50,
                     F.lit('.5, "max_safe_pressure": '), level * 10 + 90, F.lit(".0}}"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("line-"), "o_custkey").alias("subject"),
        F.unix_millis("o_orderdate").alias("timestamp"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "P", F.lit('{"version": 1, "rules": {')).otherwise(whole).alias("raw_text"),
    )
