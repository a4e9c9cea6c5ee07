"""The simple monitor over line items, and control documents over orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.functions.numbers import round_one_decimal
from trackline.operators import metrics
from trackline.operators.decode import decode, reject_implausible_metrics
from trackline.plans.registry import Catalogue
from trackline.plans.sql_views import PRESS
from trackline.sources import contracts, fleet

CATALOGUE = Catalogue()

_DOCUMENTS = """
documents_log AS (
  SELECT 'line-' || o_custkey AS subject, epoch_us(o_orderdate) // 1000 AS timestamp, o_orderkey AS seq,
         o_orderstatus <> 'P' AS valid,
         CASE WHEN o_orderstatus = 'P' THEN '{"version": 1, "rules": {'
              ELSE '{"version": ' || level || ', "rules": {"max_safe_temp": ' || (level * 100 + 50)
                   || '.5, "max_safe_pressure": ' || (level * 10 + 90) || '.0}}' END AS raw_text,
         level * 100 + 50.5 AS temp_max, level * 10 + 90.0 AS pressure_max
  FROM (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level FROM orders) AS leveled),
valid_documents AS (
  SELECT subject, timestamp, seq, CAST(temp_max AS DOUBLE) AS temp_max, CAST(pressure_max AS DOUBLE) AS pressure_max,
         sha256(raw_text) AS fingerprint
  FROM documents_log WHERE valid),
current_limits AS (
  SELECT fingerprint, temp_max, pressure_max FROM valid_documents ORDER BY timestamp DESC, seq DESC LIMIT 1)"""

_METRICS = _DOCUMENTS + """,
checked AS (
  SELECT 'Lathe-' || l_suppkey AS mc_name,
         (l_orderkey * 8 + l_linenumber) * 1048576 + l_partkey % 1048576 AS seq,
         epoch_us(l_shipdate) // 1000 + (l_orderkey * 8 + l_linenumber) % 86400000 AS timestamp,
         CAST(printf('%.1f', l_extendedprice / 100) AS DOUBLE) AS temp,
         CAST(printf('%.1f', CASE WHEN l_quantity > 1 THEN l_quantity * CAST(3.05 AS DOUBLE) ELSE 0.0 END) AS DOUBLE)
           AS pressure,
         c.temp_max, c.pressure_max, substr(c.fingerprint, 1, 8) AS config_version
  FROM lineitem, current_limits c),
lines AS (
  SELECT *, temp > temp_max AS temp_breached, pressure > pressure_max AS pressure_breached,
    CASE WHEN temp > temp_max OR pressure > pressure_max THEN
      '🚨 ALARM [Config v.' || config_version || ']: Machine ''' || mc_name
      || ''' Breached Safe Operations! -> '
      || CASE WHEN temp > temp_max THEN 'Temperature: ' || temp || '°C (Limit: ' || temp_max || '°C)' ELSE '' END
      || CASE WHEN temp > temp_max AND pressure > pressure_max THEN ' | ' ELSE '' END
      || CASE WHEN pressure > pressure_max
              THEN 'Pressure: ' || pressure || ' PSI (Limit: ' || pressure_max || ' PSI)' ELSE '' END
      || CASE WHEN temp > temp_max AND pressure > pressure_max THEN ''
              WHEN temp > temp_max THEN ' | [Pressure: ' || pressure || ' PSI]'
              ELSE ' | [Temperature: ' || temp || '°C]' END
    ELSE '📥 Telemetry Logged [Offset ' || seq || '][Config v.' || config_version || ']: ' || mc_name
      || ' is normal (' || temp || '°C, ' || pressure || ' PSI).' END AS line
  FROM checked)"""


def checked_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = metrics.current_limits(fleet.control_documents(spark, sf_dir))
    return metrics.check_metrics(fleet.lathe_metrics(spark, sf_dir), limits)


@CATALOGUE.add("fingerprint", f"""
WITH {_DOCUMENTS}
SELECT subject, seq, sha256(raw_text) AS fingerprint, substr(sha256(raw_text), 1, 8) AS short FROM documents_log""")
def fingerprint(spark, sf_dir):
    full = metrics.fingerprint(F.col("raw_text"))
    return fleet.control_documents(spark, sf_dir).select(
        "subject", "seq", full.alias("fingerprint"), metrics.short_fingerprint(full).alias("short"))


@CATALOGUE.add("control_documents", f"""
WITH {_DOCUMENTS}
SELECT seq, valid, CASE WHEN valid THEN CAST(temp_max AS DOUBLE) END AS temp_max,
       CASE WHEN valid THEN CAST(pressure_max AS DOUBLE) END AS pressure_max
FROM documents_log""")
def control_documents(spark, sf_dir):
    parsed = metrics.parse_documents(fleet.control_documents(spark, sf_dir))
    return parsed.select("seq", "valid", "temp_max", "pressure_max")


@CATALOGUE.add("control_changes", f"""
WITH {_DOCUMENTS},
ordered AS (
  SELECT *, LAG(fingerprint) OVER (PARTITION BY subject ORDER BY timestamp, seq) AS previous_fingerprint
  FROM valid_documents)
SELECT subject, timestamp, seq, fingerprint, previous_fingerprint, temp_max, pressure_max FROM ordered
WHERE previous_fingerprint IS NULL OR previous_fingerprint <> fingerprint""")
def control_changes(spark, sf_dir):
    return metrics.control_changes(fleet.control_documents(spark, sf_dir))


@CATALOGUE.add("control_changes_sliced", f"""
WITH {_DOCUMENTS},
ordered AS (
  SELECT *, LAG(fingerprint) OVER (PARTITION BY subject ORDER BY timestamp, seq) AS previous_fingerprint
  FROM valid_documents)
SELECT subject, timestamp, seq, fingerprint, previous_fingerprint, temp_max, pressure_max FROM ordered
WHERE previous_fingerprint IS NULL OR previous_fingerprint <> fingerprint""")
def control_changes_sliced(spark, sf_dir):
    """Changes as for hot subjects: every subject with more than 4 documents is cut into time slices."""
    return metrics.control_changes(fleet.control_documents(spark, sf_dir), max_rows=4)


@CATALOGUE.add("current_limits", f"WITH {_DOCUMENTS} SELECT * FROM current_limits")
def current_limits(spark, sf_dir):
    return metrics.current_limits(fleet.control_documents(spark, sf_dir))


@CATALOGUE.add("metric_rounding", """
SELECT (l_orderkey * 8 + l_linenumber) * 1048576 + l_partkey % 1048576 AS seq,
       CAST(printf('%.1f', l_extendedprice) AS DOUBLE) AS price,
       CAST(printf('%.1f', l_quantity * CAST(3.05 AS DOUBLE)) AS DOUBLE) AS quantity
FROM lineitem""")
def metric_rounding(spark, sf_dir):
    """Values with two decimals, so that ties are common."""
    rows = fleet.lathe_readings(spark, sf_dir)
    return rows.select("seq", round_one_decimal(F.col("cutting_force")).alias("price"),
                       round_one_decimal(F.col("spindle_rpm") * 3.05).alias("quantity"))


@CATALOGUE.add("metric_breach", f"""
WITH {_METRICS}
SELECT mc_name, seq, temp, pressure, temp_max, pressure_max, temp_breached, pressure_breached FROM lines
WHERE temp_breached OR pressure_breached""")
def metric_breach(spark, sf_dir):
    checked = checked_metrics(spark, sf_dir)
    return checked.filter("temp_breached OR pressure_breached").select(
        "mc_name", "seq", "temp", "pressure", "temp_max", "pressure_max", "temp_breached", "pressure_breached")


_ALL_LINES = f"""
WITH {PRESS}, {_METRICS.lstrip()},
all_lines AS (
  SELECT timestamp, seq, line FROM lines
  UNION ALL
  SELECT timestamp, seq, '⚠️ Caught Poison Pill at Offset ' || seq || ': implausible -> Routing to DLQ.'
  FROM press WHERE k < 3 OR value * 4 > 1000)"""


def rejected_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(fleet.metric_messages(spark, sf_dir), contracts.METRIC, ["mc_name", "temp", "pressure"])
    return metrics.rejected_log(reject_implausible_metrics(decoded))


@CATALOGUE.add("metric_log", f"{_ALL_LINES} SELECT seq, line FROM all_lines")
def metric_log(spark, sf_dir):
    """Lines of checked metrics and of rejected messages."""
    lines = metrics.metric_log(checked_metrics(spark, sf_dir)).select("seq", "line")
    return lines.unionByName(rejected_metrics(spark, sf_dir).select("seq", "line"))


@CATALOGUE.add("metric_latest30", f"{_ALL_LINES} SELECT * FROM all_lines ORDER BY timestamp DESC, seq DESC LIMIT 30")
def metric_latest30(spark, sf_dir):
    return metrics.latest_lines(checked_metrics(spark, sf_dir), rejected=rejected_metrics(spark, sf_dir)).select(
        "timestamp", "seq", "line")


@CATALOGUE.add("line_protocol", f"""
WITH {_METRICS}
SELECT seq, 'telemetry,machine_id=' || mc_name || ' temp=' || temp || ',pressure=' || pressure AS value FROM lines""")
def line_protocol(spark, sf_dir):
    return metrics.line_protocol(checked_metrics(spark, sf_dir))
