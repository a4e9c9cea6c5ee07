"""Control rules, limit breaches and zone rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.operators import rules, spc
from trackline.operators.alerts import alerts_for, by_device
from trackline.operators.limits import limit_breaches
from trackline.operators.slices import SlicePlan, plan_slices
from trackline.plans.registry import Catalogue
from trackline.plans.sql_views import ALERT_DOCUMENT, CHECKED, PRESS, RULE_LOG, zone_rules
from trackline.sources import fleet

CATALOGUE = Catalogue()


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.press_readings(spark, sf_dir, all_types=True)


def checked_presses(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = rules.attach_latest(_readings(spark, sf_dir), fleet.rule_log(spark, sf_dir))
    return rules.checked_values(ruled)


def scored_presses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone rules over the press fleet: one shuffle of narrow readings, hot devices sliced."""
    readings = _readings(spark, sf_dir)
    plan = plan_slices(readings)
    ruled = rules.attach_latest(by_device(readings, plan), fleet.rule_log(spark, sf_dir), plan is not None)
    checked = rules.checked_values(ruled)
    return spc.evaluate(checked.drop("upper", "lower", "rule_profile", "rule_version"), plan)


@CATALOGUE.add("rule_long", f"""
WITH {RULE_LOG}
SELECT machine_type, version, rule_profile, measurement, upper, lower FROM rule_long
WHERE upper IS NOT NULL OR lower IS NOT NULL""")
def rule_long(spark, sf_dir):
    return rules.rules_long(fleet.rule_log(spark, sf_dir))


@CATALOGUE.add("rule_limit_maps", f"""
WITH {RULE_LOG}
SELECT machine_type, version, rule_profile, max_vibration AS upper_vibration, max_pressure AS upper_pressure,
       min_temperature AS lower_temperature,
       2 + CASE WHEN min_temperature IS NULL THEN 0 ELSE 1 END - 1 AS lower_limits
FROM rule_log""")
def rule_limit_maps(spark, sf_dir):
    maps = rules.limit_maps(fleet.rule_log(spark, sf_dir))
    return maps.select(
        "machine_type", "version", "rule_profile",
        F.try_element_at("upper", F.lit("vibration")).alias("upper_vibration"),
        F.try_element_at("upper", F.lit("pressure")).alias("upper_pressure"),
        F.try_element_at("lower", F.lit("temperature")).alias("lower_temperature"),
        F.size("lower").alias("lower_limits"))


@CATALOGUE.add("limited_measurements", f"""
WITH {RULE_LOG}
SELECT version, string_agg(measurement, ',' ORDER BY measurement) AS measurements
FROM rule_long WHERE upper IS NOT NULL OR lower IS NOT NULL GROUP BY version""")
def limited_measurements(spark, sf_dir):
    """Measurements limited on either side, per rule record."""
    log = fleet.rule_log(spark, sf_dir)
    names = F.transform(rules.limits_array(log.schema), lambda e: e.measurement)
    return log.select("version", F.array_join(F.array_sort(names), ",").alias("measurements"))


@CATALOGUE.add("latest_rule", f"""
WITH {RULE_LOG}
SELECT r.* FROM rule_log r JOIN (SELECT machine_type, MAX("offset") AS newest FROM rule_log GROUP BY 1) n
ON r.machine_type = n.machine_type AND r."offset" = n.newest""")
def latest_rule(spark, sf_dir):
    return rules.latest_rules(fleet.rule_log(spark, sf_dir))


@CATALOGUE.add("rule_lookup", f"""
WITH {PRESS}, {RULE_LOG}
SELECT p.seq, p.machine_type, r.version, r.rule_profile
FROM press p JOIN latest r ON p.machine_type = r.machine_type AND r.measurement = 'vibration'""")
def rule_lookup(spark, sf_dir):
    ruled = rules.attach_latest(_readings(spark, sf_dir), fleet.rule_log(spark, sf_dir))
    return ruled.select("seq", "machine_type", "rule.version", "rule.rule_profile")


@CATALOGUE.add("rule_lookup_as_of", f"""
WITH {PRESS}, {RULE_LOG}
SELECT p.seq, p.machine_type, r.version
FROM press p ASOF JOIN rule_log r ON p.machine_type = r.machine_type AND p.timestamp >= r.log_time""")
def rule_lookup_as_of(spark, sf_dir):
    ruled = rules.attach_as_of(_readings(spark, sf_dir), fleet.rule_log(spark, sf_dir))
    return ruled.select("seq", "machine_type", "rule.version")


@CATALOGUE.add("checked_values", f"WITH {CHECKED} SELECT * FROM checked")
def checked_values(spark, sf_dir):
    return checked_presses(spark, sf_dir)


@CATALOGUE.add("limit_breach", f"WITH {CHECKED} SELECT * FROM breaches")
def limit_breach(spark, sf_dir):
    return limit_breaches(checked_presses(spark, sf_dir))


@CATALOGUE.add("limit_breach_as_of", f"""
WITH {PRESS}, {RULE_LOG},
ruled AS (
  SELECT p.device_id, p.timestamp, p.seq, p.value, p.k, r.*
  FROM press p ASOF JOIN rule_log r ON p.machine_type = r.machine_type AND p.timestamp >= r.log_time)
SELECT device_id, timestamp, seq, 'vibration' AS measurement, value, 'upper' AS limit_type,
       max_vibration AS limit_value, version AS rule_version FROM ruled WHERE value > max_vibration
UNION ALL SELECT device_id, timestamp, seq, 'vibration', value, 'lower', min_vibration, version
FROM ruled WHERE value < min_vibration
UNION ALL SELECT device_id, timestamp, seq, 'temperature', k, 'upper', max_temperature, version
FROM ruled WHERE k > max_temperature
UNION ALL SELECT device_id, timestamp, seq, 'temperature', k, 'lower', min_temperature, version
FROM ruled WHERE k < min_temperature""")
def limit_breach_as_of(spark, sf_dir):
    ruled = rules.attach_as_of(_readings(spark, sf_dir), fleet.rule_log(spark, sf_dir))
    return limit_breaches(rules.checked_values(ruled)).drop("rule_profile")


_LONG_LOG = """
long_log AS (
  SELECT machine_type, log_time, arg_max(version, o_orderkey) AS version, arg_max(max_vibration, o_orderkey) AS max_vibration
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Press-A' ELSE 'Press-B' END AS machine_type,
               'o' || o_orderkey AS version, CAST(40 + o_orderkey % 60 AS DOUBLE) AS max_vibration,
               1704067200000 + CASE WHEN o_orderkey % 3 = 0 THEN 1000000000 + o_orderkey % 1000
                                    ELSE o_orderkey * 7919317 % 2700000000 END AS log_time
        FROM orders) AS records
  GROUP BY machine_type, log_time)"""


@CATALOGUE.add("limit_breach_long_log", f"""
WITH {PRESS}, {_LONG_LOG}
SELECT p.device_id, p.timestamp, p.seq, 'vibration' AS measurement, p.value, 'upper' AS limit_type,
       r.max_vibration AS limit_value, r.version AS rule_version
FROM press p ASOF JOIN long_log r ON p.machine_type = r.machine_type AND p.timestamp >= r.log_time
WHERE p.value > r.max_vibration""")
def limit_breach_long_log(spark, sf_dir):
    """Breaches under a rule log longer than the readings, a third of it within one second."""
    ruled = rules.attach_as_of(_readings(spark, sf_dir), fleet.long_rule_log(spark, sf_dir))
    return limit_breaches(rules.checked_values(ruled)).drop("rule_profile")


@CATALOGUE.add("spc_stats", f"""
WITH {CHECKED}, {zone_rules("checked")}
SELECT device_id, measurement, seq, n, round(mean, 6) AS mean, round(sd, 6) AS sd
FROM scored WHERE n >= 15""")
def spc_stats(spark, sf_dir):
    return scored_presses(spark, sf_dir).filter(F.col("n") >= spc.MIN_POINTS).select(
        "device_id", "measurement", "seq", "n", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


def _add_zone_rule(number: int) -> None:
    @CATALOGUE.add(f"spc_rule_{number}", f"""
WITH {CHECKED}, {zone_rules("checked")}
SELECT device_id, measurement, timestamp, seq, value FROM scored WHERE rule_{number}""")
    def zone_rule(spark, sf_dir):
        return scored_presses(spark, sf_dir).filter(f"rule_{number}").select(
            "device_id", "measurement", "timestamp", "seq", "value")


for _number in spc.RULES:
    _add_zone_rule(_number)


def violations_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT device_id, timestamp, seq, measurement, value, {n} AS rule_number, '{text}' AS rule_description "
        f"FROM {source} WHERE rule_{n}" for n, text in spc.RULES.items())


@CATALOGUE.add("spc_violations", f"WITH {CHECKED}, {zone_rules('checked')} {violations_sql('scored')}")
def spc_violations(spark, sf_dir):
    return spc.violations(scored_presses(spark, sf_dir))


LATHES = """
lathes AS (
  SELECT 'Lathe-' || lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS device_id,
         epoch_us(l_shipdate) // 1000 + (l_orderkey * 8 + l_linenumber) % 86400000 AS timestamp,
         (l_orderkey * 8 + l_linenumber) * 1048576 + l_partkey % 1048576 AS seq,
         l_quantity, l_extendedprice, l_discount
  FROM lineitem),
lathe_values AS (
  SELECT device_id, timestamp, seq, 'spindle_rpm' AS measurement, l_quantity AS value FROM lathes
  UNION ALL SELECT device_id, timestamp, seq, 'cutting_force', l_extendedprice FROM lathes
  UNION ALL SELECT device_id, timestamp, seq, 'coolant_pressure', l_discount FROM lathes)"""


@CATALOGUE.add("spc_lathes", f"WITH {LATHES}, {zone_rules('lathe_values')} {violations_sql('scored')}")
def spc_lathes(spark, sf_dir):
    """Zone rules over every measurement of every line item."""
    names = ("spindle_rpm", "cutting_force", "coolant_pressure")
    return _line_violations(fleet.lathe_readings(spark, sf_dir).select("device_id", "timestamp", "seq", *names))


def _line_violations(readings: DataFrame) -> DataFrame:
    """Zone rules over every measurement of the readings."""
    names = [c for c in readings.columns if c not in ("device_id", "timestamp", "seq")]
    plan = plan_slices(readings)
    rows = plan.assign(readings) if plan else readings
    return spc.violations(spc.evaluate_fields(rows, names, plan))


TIES = f"""{LATHES.replace("l_quantity, l_extendedprice, l_discount", "l_tax, l_linenumber")}""".split("lathe_values")[0] + """
lathe_values AS (
  SELECT device_id, timestamp, seq, 'fine' AS measurement, l_tax AS value FROM lathes
  UNION ALL SELECT device_id, timestamp, seq, 'far_from_zero', 1000000 + l_tax FROM lathes
  UNION ALL SELECT device_id, timestamp, seq, 'three_levels', (l_linenumber % 3 - 1) / 10.0 FROM lathes
  UNION ALL SELECT device_id, timestamp, seq, 'two_levels', (l_linenumber % 2) * 0.2 - 0.1 FROM lathes)"""


@CATALOGUE.add("spc_ties", f"WITH {TIES}, {zone_rules('lathe_values')} {violations_sql('scored')}")
def spc_ties(spark, sf_dir):
    """Zone rules where values are often equal to the mean or a sigma line, also far from zero."""
    lathes = fleet.lathe_readings(spark, sf_dir, "l_tax", "l_linenumber")
    number = F.col("l_linenumber")
    return _line_violations(lathes.select(
        "device_id", "timestamp", "seq", F.col("l_tax").alias("fine"), (1e6 + F.col("l_tax")).alias("far_from_zero"),
        ((number % 3 - 1) / 10.0).alias("three_levels"), ((number % 2 * 2 - 1) / 10.0).alias("two_levels")))


ALERT_VIEWS = f"""{zone_rules('checked')}, fired AS ({violations_sql('scored')}),
alerts AS (
  SELECT 'limit_breach' AS alert_type, device_id, timestamp, seq, measurement, value, limit_type, limit_value,
         rule_profile, rule_version, CAST(NULL AS INTEGER) AS rule_number, CAST(NULL AS VARCHAR) AS rule_description
  FROM breaches
  UNION ALL
  SELECT 'spc_rule', device_id, timestamp, seq, measurement, value, NULL, NULL, NULL, NULL, rule_number,
         rule_description
  FROM fired)"""
_ALERTS_SQL = f"WITH {CHECKED}, {ALERT_VIEWS}"


def press_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _readings(spark, sf_dir)
    return alerts_for(readings, fleet.rule_log(spark, sf_dir), plan_slices(readings))


@CATALOGUE.add("alerts", _ALERTS_SQL + " SELECT * FROM alerts")
def alerts(spark, sf_dir):
    return press_alerts(spark, sf_dir).drop("document")


@CATALOGUE.add("alert_documents", f"{_ALERTS_SQL} SELECT seq, {ALERT_DOCUMENT} AS document FROM alerts")
def alert_documents(spark, sf_dir):
    return press_alerts(spark, sf_dir).select("seq", "document")


#: Rows per slice of the queries that show that slicing changes nothing; few, so that small data is sliced too.
SLICED_ROWS = 40


@CATALOGUE.add("alerts_sliced", _ALERTS_SQL + " SELECT * FROM alerts")
def alerts_sliced(spark, sf_dir):
    """Alerts as for hot devices: every device with more than SLICED_ROWS readings is cut into slices."""
    readings = _readings(spark, sf_dir)
    plan = plan_slices(readings, SLICED_ROWS)
    return alerts_for(readings, fleet.rule_log(spark, sf_dir), plan).drop("document")


@CATALOGUE.add("rule_lookup_as_of_sliced", f"""
WITH {PRESS}, {RULE_LOG}
SELECT p.seq, p.machine_type, r.version
FROM press p ASOF JOIN rule_log r ON p.machine_type = r.machine_type AND p.timestamp >= r.log_time""")
def rule_lookup_as_of_sliced(spark, sf_dir):
    """The lookup for rule logs too large to copy, with machine types cut into slices."""
    ruled = rules.attach_as_of(_readings(spark, sf_dir), fleet.rule_log(spark, sf_dir), SLICED_ROWS, small_log=False)
    return ruled.select("seq", "machine_type", "rule.version")


_ODD_CHECKED = f"""{PRESS.replace("event_type, value,", "event_type, CASE WHEN event_id % 55 = 0 THEN NULL "
                                  "WHEN event_id % 40 = 0 THEN CAST('infinity' AS DOUBLE) ELSE value END AS value,")},
{RULE_LOG.replace("CAST(60 + s_nationkey AS DOUBLE) AS max_temperature",
                  "CASE WHEN s_nationkey % 3 <> 0 THEN CAST(60 + s_nationkey AS DOUBLE) END AS max_temperature")
         .replace("CAST(s_nationkey AS DOUBLE) / 10 AS min_vibration", "CAST(NULL AS DOUBLE) AS min_vibration")},
long_values AS (
  SELECT device_id, machine_type, timestamp, seq, 'vibration' AS measurement, value FROM press WHERE value IS NOT NULL
  UNION ALL SELECT device_id, machine_type, timestamp, seq, 'temperature', k FROM press),
checked AS (
  SELECT v.device_id, v.timestamp, v.seq, v.measurement, v.value, r.upper, r.lower, r.rule_profile,
         r.version AS rule_version
  FROM long_values v JOIN latest r ON v.machine_type = r.machine_type AND v.measurement = r.measurement
  WHERE r.upper IS NOT NULL OR r.lower IS NOT NULL),
breaches AS (
  SELECT device_id, timestamp, seq, measurement, value, 'upper' AS limit_type, upper AS limit_value,
         rule_profile, rule_version FROM checked WHERE value > upper
  UNION ALL
  SELECT device_id, timestamp, seq, measurement, value, 'lower', lower, rule_profile, rule_version
  FROM checked WHERE value < lower)"""


@CATALOGUE.add("alerts_nonfinite", f"WITH {_ODD_CHECKED}, {ALERT_VIEWS} SELECT * FROM alerts")
def alerts_nonfinite(spark, sf_dir):
    """Some values are NaN or infinite and some limits NaN: missing values, real breaches and no limits."""
    seq, nan = F.col("seq"), F.lit(float("nan"))
    readings = _readings(spark, sf_dir).withColumn("vibration", F.when(seq % 55 == 0, nan).when(
        seq % 40 == 0, F.lit(float("inf"))).otherwise(F.col("vibration")))
    log = fleet.rule_log(spark, sf_dir, "s_nationkey").withColumns({
        "max_temperature": F.when(F.col("s_nationkey") % 3 == 0, nan).otherwise(F.col("max_temperature")),
        "min_vibration": nan}).drop("s_nationkey")
    return alerts_for(readings, log, plan_slices(readings)).drop("document")
