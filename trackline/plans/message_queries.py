"""Decoding of raw messages, and the split into good ones and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.functions.encode import encoded_rows, type_tag
from trackline.functions.fields import field_name
from trackline.functions.wire import has_header, message_body, schema_id
from trackline.operators import cycles, rules
from trackline.operators import decode as dec
from trackline.plans.registry import Catalogue
from trackline.plans.sql_views import PRESS, RAW_TEXT_HEX, RULE_LOG, TELEMETRY_RAW
from trackline.sources import contracts, fleet

CATALOGUE = Catalogue()

# What is wrong with a telemetry message follows from k (see fleet.telemetry_messages).
_OUTCOME = PRESS + """,
outcome AS (
  SELECT *, CASE WHEN k < 5 OR (k >= 19 AND k < 23) THEN 'undecodable'
                 WHEN k >= 13 AND k < 19 THEN 'missing_required_field' END AS error
  FROM press WHERE k < 10 OR k >= 13)"""


def decoded_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.decode(fleet.telemetry_messages(spark, sf_dir), contracts.TELEMETRY, ["device_id", "timestamp"])


@CATALOGUE.add("header_split", f"""
WITH {PRESS}, {TELEMETRY_RAW}
SELECT seq AS "offset", (k < 5 OR k >= 10) AS has_header,
       CASE WHEN k < 5 OR k >= 10 THEN 1 + seq % 3 END AS schema_id,
       CAST(len(raw_hex) // 2 - CASE WHEN k < 5 OR k >= 10 THEN 5 ELSE 0 END AS INTEGER) AS body_bytes
FROM raw""")
def header_split(spark, sf_dir):
    """Header found, schema id, and the length of the body of every message."""
    rows = fleet.telemetry_messages(spark, sf_dir).filter(F.col("value").isNotNull())
    return rows.select("offset", has_header(F.col("value")).alias("has_header"),
                       schema_id(F.col("value")).alias("schema_id"),
                       F.length(message_body(F.col("value"))).alias("body_bytes"))


def _raw_hex(letters: DataFrame) -> DataFrame:
    """Dead letters with their whole bytes and readable text, as hex."""
    return letters.select("offset", "source", "error", F.lower(F.hex("raw")).alias("raw_hex"),
                          F.lower(F.hex(F.encode("raw_text", "UTF-8"))).alias("text_hex"))


@CATALOGUE.add("decode_split", f"""
WITH {_OUTCOME} SELECT COALESCE(error, 'good') AS outcome, COUNT(*) AS messages FROM outcome GROUP BY 1""")
def decode_split(spark, sf_dir):
    decoded = decoded_telemetry(spark, sf_dir)
    return decoded.groupBy(F.coalesce("error", F.lit("good")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"))


@CATALOGUE.add("decoded_readings", f"""
WITH {_OUTCOME}
SELECT device_id, timestamp, value AS vibration, k AS temperature, CAST(65.5 AS DOUBLE) AS pressure,
       event_type || ',x' AS status, seq
FROM outcome WHERE error IS NULL""")
def decoded_readings(spark, sf_dir):
    return dec.good_records(decoded_telemetry(spark, sf_dir))


@CATALOGUE.add("required_fields", f"""
WITH {_OUTCOME}
SELECT seq AS "offset", CASE WHEN k < 16 THEN 'device_id' ELSE 'timestamp' END AS missing
FROM outcome WHERE error = 'missing_required_field'""")
def required_fields(spark, sf_dir):
    bad = decoded_telemetry(spark, sf_dir).filter(F.col("error") == dec.MISSING_FIELD)
    return bad.select("offset", F.when(F.col("record.device_id").isNull(), "device_id").otherwise("timestamp")
                      .alias("missing"))


@CATALOGUE.add("dead_letters", f"""
WITH {PRESS}, {TELEMETRY_RAW}
SELECT seq AS "offset", 'machine-telemetry' AS source,
       CASE WHEN k >= 13 AND k < 19 THEN 'missing_required_field' ELSE 'undecodable' END AS error, raw_hex,
       {RAW_TEXT_HEX} AS text_hex
FROM raw WHERE k < 5 OR (k >= 13 AND k < 23)""")
def dead_letters(spark, sf_dir):
    return _raw_hex(dec.dead_letters(decoded_telemetry(spark, sf_dir), "machine-telemetry"))


@CATALOGUE.add("dynamic_fields", f"""
WITH {_OUTCOME}, good AS (SELECT COUNT(*) AS n FROM outcome WHERE error IS NULL)
SELECT name, tag, n AS present FROM good,
  (VALUES ('vibration', 'DOUBLE'), ('temperature', 'DOUBLE'), ('pressure', 'DOUBLE'), ('status', 'TEXT')) AS f(name, tag)""")
def dynamic_fields(spark, sf_dir):
    """Fields found on good records besides their identity, with type tag and number of values."""
    records = dec.good_records(decoded_telemetry(spark, sf_dir))
    found = [(f.name, type_tag(f.dataType)) for f in records.schema.fields
             if f.name not in ("device_id", "timestamp", "seq") and type_tag(f.dataType)]
    counts = records.agg(*[F.count(name).alias(name) for name, _ in found])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(field_name(name)).alias("name"), F.lit(tag).alias("tag"), F.col(name).alias("present"))
        for name, tag in found])))


@CATALOGUE.add("numeric_fields", f"""
WITH {_OUTCOME}
SELECT seq, f.name AS name, CASE f.name WHEN 'vibration' THEN value WHEN 'temperature' THEN k ELSE 65.5 END AS value
FROM outcome, (VALUES ('vibration'), ('temperature'), ('pressure')) AS f(name) WHERE error IS NULL""")
def numeric_fields(spark, sf_dir):
    records = dec.good_records(decoded_telemetry(spark, sf_dir))
    return records.select("seq", F.explode(dec.numeric_fields(records)).alias("name", "value"))


@CATALOGUE.add("context_decode", f"""
WITH {PRESS}
SELECT device_id,
       CASE event_type WHEN 'signup' THEN 'TRACK_IN' WHEN 'purchase' THEN 'TRACK_OUT' ELSE 'PAUSE' END AS event_type,
       timestamp AS event_timestamp,
       CASE WHEN event_type = 'signup' THEN 'RUN-' || seq END AS run_id,
       CASE WHEN event_type = 'signup' THEN 'PART-' || seq END AS part_no,
       CASE WHEN event_type = 'signup' THEN 'RECIPE_' || CAST(k AS BIGINT) END AS recipe_name, seq
FROM press WHERE event_type IN ('signup', 'purchase', 'error')""")
def context_decode(spark, sf_dir):
    decoded = dec.decode(fleet.context_messages(spark, sf_dir), contracts.CONTEXT,
                         ["device_id", "event_type", "event_timestamp"])
    return dec.good_records(decoded)


# Nations 20-22 send unusable limit records (see fleet.control_messages).
_USABLE = "(SELECT r.* FROM rule_long r JOIN supplier s ON r.\"offset\" = s.s_suppkey WHERE s.s_nationkey NOT IN (20, 21, 22))"


def _decoded_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.decode_rule_log(fleet.control_messages(spark, sf_dir), contracts.CONTROL)


@CATALOGUE.add("control_decode", f"""
WITH {RULE_LOG}
SELECT machine_type, version, rule_profile, measurement, upper, lower FROM {_USABLE} AS u
WHERE upper IS NOT NULL OR lower IS NOT NULL""")
def control_decode(spark, sf_dir):
    """Limit records from messages to long form; only usable ones count as rules."""
    return rules.rules_long(dec.rule_records(_decoded_rules(spark, sf_dir)))


@CATALOGUE.add("control_latest", f"""
WITH {RULE_LOG}, usable AS {_USABLE}
SELECT u.machine_type, u.version, u.log_time, u.measurement, u.upper, u.lower
FROM usable u JOIN (SELECT machine_type, MAX("offset") AS newest FROM usable GROUP BY 1) n
  ON u.machine_type = n.machine_type AND u."offset" = n.newest
WHERE u.upper IS NOT NULL OR u.lower IS NOT NULL""")
def control_latest(spark, sf_dir):
    """Rules in force after reading the whole control topic: unusable records replace nothing."""
    latest = rules.latest_rules(dec.rule_records(_decoded_rules(spark, sf_dir)))
    return latest.select("machine_type", "version", "log_time", F.inline(rules.limits_array(latest.schema)))


@CATALOGUE.add("control_dead_letters", """
WITH raw AS (
  SELECT *, '0000000003' || lower(hex(encode(CASE WHEN s_nationkey < 22 THEN 'This is not a record'
    ELSE '{"version":"v' || s_suppkey || '","max_vibration":122.0,"min_vibration":2.2,"max_temperature":82.0,'
      || CASE WHEN s_acctbal >= 0 THEN '"min_temperature":5.0,' ELSE '' END
      || '"max_pressure":75.0,"rule_profile":"HIGH_PRECISION_STRICT"}' END))) AS raw_hex
  FROM supplier WHERE s_nationkey IN (20, 21, 22))
SELECT s_suppkey AS "offset", 'machine-control' AS source,
       CASE WHEN s_nationkey = 22 THEN 'missing_required_field' ELSE 'undecodable' END AS error, raw_hex,
       raw_hex AS text_hex
FROM raw""")
def control_dead_letters(spark, sf_dir):
    return _raw_hex(dec.dead_letters(_decoded_rules(spark, sf_dir), "machine-control"))


@CATALOGUE.add("metric_decode", f"""
WITH {PRESS}
SELECT seq AS "offset", CASE WHEN k < 3 OR value * 4 > 1000 THEN 'implausible' END AS error FROM press""")
def metric_decode(spark, sf_dir):
    decoded = dec.decode(fleet.metric_messages(spark, sf_dir), contracts.METRIC, ["mc_name", "temp", "pressure"])
    return dec.reject_implausible_metrics(decoded).select("offset", "error")


@CATALOGUE.add("metric_dead_letters", f"""
WITH {PRESS}, raw AS (
  SELECT *, '0000000004' || lower(hex(encode('{{"mc_name":"' || CASE WHEN k < 3 THEN '' ELSE device_id END
    || '","temp":' || value * 4 || ',"pressure":' || (value + 100) || '}}'))) AS raw_hex
  FROM press WHERE k < 3 OR value * 4 > 1000)
SELECT seq AS "offset", 'machine-events' AS source, 'implausible' AS error, raw_hex, raw_hex AS text_hex FROM raw""")
def metric_dead_letters(spark, sf_dir):
    decoded = dec.decode(fleet.metric_messages(spark, sf_dir), contracts.METRIC, ["mc_name", "temp", "pressure"])
    return _raw_hex(dec.dead_letters(dec.reject_implausible_metrics(decoded), "machine-events"))


def _decoded_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.decode(fleet.user_messages(spark, sf_dir), contracts.USER, ["id", "name"], strict=True)


@CATALOGUE.add("user_records", """
SELECT 'U' || c_custkey AS id, c_name AS name,
       CASE WHEN c_acctbal >= 0 THEN c_name || '@example.com' END AS email, c_custkey AS seq
FROM customer WHERE c_nationkey >= 7""")
def user_records(spark, sf_dir):
    return dec.good_records(_decoded_users(spark, sf_dir))


@CATALOGUE.add("user_dead_letters", """
SELECT CAST(NULL AS VARCHAR) AS key, 'error_message' AS header,
       CASE WHEN c_nationkey < 5 THEN 'contract_violation' ELSE 'undecodable' END AS error_message,
       '0000000001' || lower(hex(encode(CASE WHEN c_nationkey >= 5 THEN 'This is not a record'
         ELSE '{"id":' || c_custkey || ',"name":"' || c_name || '",'
           || CASE WHEN c_acctbal >= 0 THEN '"email":"' || c_name || '@example.com",' ELSE '' END
           || '"phone":"555"}' END))) AS value_hex
FROM customer WHERE c_nationkey < 7""")
def user_dead_letters(spark, sf_dir):
    bad = dec.error_headers(_decoded_users(spark, sf_dir))
    header = F.col("headers")[0]
    return bad.select(F.col("key").cast("string").alias("key"), header["key"].alias("header"),
                      header["value"].cast("string").alias("error_message"),
                      F.lower(F.hex("value")).alias("value_hex"))


@CATALOGUE.add("dynamic_fields_reserved", f"""
WITH {PRESS}
SELECT seq, 'phase,open,slice,seq,prev,machine_type' AS measurements, 'DOUBLE,BOOLEAN,INT64,INT64,TEXT,TEXT' AS types,
       value || ',' || (k > 20) || ',' || CAST(k AS BIGINT) || ',' || (seq + 1) || ',' || event_type || ',custom'
         AS "values"
FROM press WHERE event_type IN ('click', 'view')""")
def dynamic_fields_reserved(spark, sf_dir):
    """Sensor fields named like the library's own columns, from the message to the encoded row."""
    contract = T.StructType.fromDDL("device_id string, timestamp bigint, phase double, open boolean, slice bigint, "
                                    "seq bigint, prev string, machine_type string")
    rows = fleet.press_messages(spark, sf_dir).filter(F.col("event_type").isin(*fleet.READINGS))
    k = fleet.props_k()
    body = F.to_json(F.struct("device_id", "timestamp", F.col("value").alias("phase"), (k > 20).alias("open"),
                              k.cast("long").alias("slice"), (F.col("seq") + 1).alias("seq"),
                              F.col("event_type").alias("prev"), F.lit("custom").alias("machine_type")))
    messages = fleet.raw_messages(rows, body.cast("binary"), "odd", F.col("seq"), F.timestamp_millis("timestamp"))
    readings = dec.good_records(dec.decode(messages, contract, ["device_id", "timestamp"]))
    timeline = cycles.build_timeline(readings, fleet.press_events(spark, sf_dir).limit(0))
    enriched = cycles.enriched_rows(cycles.track(timeline)).withColumn("_seq", F.col("seq"))
    return encoded_rows(enriched, keep=("_seq",)).select(F.col("_seq").alias("seq"), "measurements", "types", "values")


@CATALOGUE.add("family_union_mixed", f"""
WITH {PRESS}
SELECT seq, 'level,status' AS measurements, 'DOUBLE,TEXT' AS types, value || ',' || event_type AS "values" FROM press
WHERE event_type IN ('click', 'view')
UNION ALL
SELECT (l_orderkey * 8 + l_linenumber) * 1048576 + l_partkey % 1048576, 'level,status', 'BOOLEAN,INT64',
       (l_quantity > 25) || ',' || l_orderkey FROM lineitem""")
def family_union_mixed(spark, sf_dir):
    """Two families whose fields agree in name but not in type keep their values and tags."""
    press = fleet.press_readings(spark, sf_dir).select("device_id", "timestamp", "seq", F.col("vibration").alias("level"),
                                                       "status")
    lathe = fleet.table(spark, sf_dir, "lineitem").select(
        F.lit("Lathe-1").alias("device_id"), F.lit(0).cast("long").alias("timestamp"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_048_576 + F.col("l_partkey") % 1_048_576).alias("seq"),
        (F.col("l_quantity") > 25).alias("level"), F.col("l_orderkey").alias("status"))
    both = dec.union_families(press, lathe).withColumn("_seq", F.col("seq"))
    return encoded_rows(both, keep=("_seq",)).select(F.col("_seq").alias("seq"), "measurements", "types", "values")


@CATALOGUE.add("family_union", f"""
WITH {PRESS}
SELECT device_id, timestamp, seq, value AS vibration, k AS temperature, CAST(NULL AS DOUBLE) AS spindle_rpm,
       CAST(NULL AS DOUBLE) AS cutting_force, CAST(NULL AS DOUBLE) AS coolant_pressure, event_type AS status
FROM press WHERE event_type IN ('click', 'view')
UNION ALL
SELECT 'Lathe-' || lpad(CAST(l_suppkey AS VARCHAR), 10, '0'),
       epoch_us(l_shipdate) // 1000 + (l_orderkey * 8 + l_linenumber) % 86400000,
       (l_orderkey * 8 + l_linenumber) * 1048576 + l_partkey % 1048576,
       NULL, NULL, l_quantity, l_extendedprice, l_discount, l_linestatus
FROM lineitem""")
def family_union(spark, sf_dir):
    return dec.union_families(fleet.press_readings(spark, sf_dir), fleet.lathe_readings(spark, sf_dir))
