"""Common table expressions of the check queries, written apart from the Spark operators."""

from __future__ import annotations

PRESS = """
press AS (
  SELECT 'Press-' || CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END || '-'
           || lpad(CAST(user_id AS VARCHAR), 10, '0') AS device_id,
         CASE WHEN user_id % 2 = 0 THEN 'Press-A' ELSE 'Press-B' END AS machine_type,
         epoch_us(ts) // 1000 AS timestamp, event_id AS seq, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k
  FROM events)"""

# The bytes of every telemetry message of `press` as lower-case hex, null where a message has no value.
TELEMETRY_RAW = """
raw AS (
  SELECT *, lower(CASE WHEN k >= 5 AND k < 10 THEN '' ELSE '00' || printf('%08x', 1 + seq % 3) END
    || CASE WHEN k < 5 THEN hex(encode('This is not a record')) WHEN k >= 19 AND k < 21 THEN 'C328FF'
       ELSE hex(encode('{' || CASE WHEN k >= 13 AND k < 16 THEN '' ELSE '"device_id":"' || device_id || '",' END
         || CASE WHEN k >= 16 AND k < 19 THEN '' ELSE '"timestamp":' || timestamp || ',' END || '"vibration":'
         || CASE WHEN k >= 21 AND k < 23 THEN '"n/a"' ELSE CAST(value AS VARCHAR) END || ',"temperature":' || k
         || ',"pressure":65.5,"status":"' || event_type || ',x"}')) END) AS raw_hex
  FROM press WHERE k < 10 OR k >= 13)"""

# The text of a dead letter as hex: bytes that are not UTF-8 become the replacement character.
RAW_TEXT_HEX = "replace(raw_hex, 'c328ff', 'efbfbd28efbfbd')"

INCOMPLETE_DOCUMENT = """'{"device_id":"' || device_id || '","timestamp":' || timestamp || ',"reason":"' || reason || '"' ||
  CASE reason
    WHEN 'abandoned_cycle' THEN ',"abandoned_run_id":"' || abandoned_run_id || '","abandoned_part_no":"'
      || abandoned_part_no || '","abandoned_track_in":' || abandoned_track_in
      || ',"data_point_count_at_abandonment":' || data_point_count_at_abandonment
    WHEN 'orphaned_track_out' THEN ''
    WHEN 'between_cycles' THEN ',"last_track_out":' || last_track_out || ',"gap_since_last_track_out_ms":'
      || gap_since_last_track_out_ms
    ELSE ',"last_track_out":null' END || '}'"""

ALERT_DOCUMENT = """'{"alert_type":"' || alert_type || '","timestamp":' || timestamp || ',"measurement":"' || measurement
  || '","value":' || value || ',"device_id":"' || device_id || '",' ||
  CASE alert_type WHEN 'limit_breach' THEN '"limit_type":"' || limit_type || '","limit_value":' || limit_value
    || ',"rule_profile":"' || rule_profile || '","rule_version":"' || rule_version || '"}'
  ELSE '"rule_number":' || rule_number || ',"rule_description":"' || rule_description || '"}' END"""

# g counts the recognised events before a row, so event number g is the latest one.
_TRACKED = """,
line AS (
  SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS kr
  FROM press WHERE event_type <> 'error' AND ({keep})),
segments AS (
  SELECT *,
         SUM(1 - kr) OVER w - (1 - kr) AS g,
         MAX(CASE WHEN event_type = 'purchase' THEN timestamp END)
           OVER (PARTITION BY device_id ORDER BY timestamp, kr, seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_out
  FROM line
  WINDOW w AS (PARTITION BY device_id ORDER BY timestamp, kr, seq ROWS UNBOUNDED PRECEDING)),
turns AS (
  SELECT device_id, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY timestamp, seq) AS g,
         event_type = 'signup' AS opens, timestamp AS prev_time, seq AS prev_seq, k AS prev_k
  FROM line WHERE kr = 0),
tracked AS (
  SELECT s.device_id, s.timestamp, s.kr, s.seq, s.event_type, s.value, s.k, s.last_out,
         COALESCE(t.opens, FALSE) AS is_open, t.prev_time, t.prev_seq, t.prev_k,
         SUM(s.kr) OVER (PARTITION BY s.device_id, s.g ORDER BY s.timestamp, s.kr, s.seq
                         ROWS UNBOUNDED PRECEDING) AS n_before
  FROM segments s LEFT JOIN turns t ON s.device_id = t.device_id AND s.g = t.g),
enriched AS (
  SELECT device_id, timestamp, kr, seq,
         CASE WHEN kr = 1 THEN value END AS vibration,
         CASE WHEN kr = 1 THEN k END AS temperature,
         CASE WHEN kr = 1 THEN event_type END AS status,
         kr = 0 OR is_open AS context_complete,
         CASE WHEN event_type = 'signup' THEN 'RUN-' || seq WHEN is_open THEN 'RUN-' || prev_seq END AS run_id,
         CASE WHEN event_type = 'signup' THEN 'PART-' || seq WHEN is_open THEN 'PART-' || prev_seq END AS part_no,
         CASE WHEN event_type = 'signup' THEN 'RECIPE_' || CAST(k AS BIGINT)
              WHEN is_open THEN 'RECIPE_' || CAST(prev_k AS BIGINT) END AS recipe_name,
         CASE WHEN event_type = 'signup' THEN timestamp WHEN is_open THEN prev_time END AS track_in,
         CASE WHEN event_type = 'purchase' THEN timestamp END AS track_out,
         CASE WHEN event_type = 'signup' THEN 'TRACK_IN'
              WHEN event_type = 'purchase' AND is_open THEN 'TRACK_OUT_CLOSE'
              WHEN event_type = 'purchase' THEN 'TRACK_OUT_ORPHANED' END AS context_event,
         CAST(CASE WHEN event_type = 'signup' THEN 0 WHEN is_open THEN n_before END AS BIGINT) AS data_point_count,
         CASE WHEN kr = 1 AND NOT is_open THEN last_out END AS last_track_out
  FROM tracked),
incomplete AS (
  SELECT device_id, timestamp, seq,
         CASE WHEN event_type = 'signup' THEN 'abandoned_cycle' WHEN event_type = 'purchase' THEN 'orphaned_track_out'
              WHEN last_out IS NULL THEN 'never_tracked_since_job_start' ELSE 'between_cycles' END AS reason,
         CASE WHEN kr = 1 THEN last_out END AS last_track_out,
         CASE WHEN kr = 1 THEN timestamp - last_out END AS gap_since_last_track_out_ms,
         CASE WHEN event_type = 'signup' THEN 'RUN-' || prev_seq END AS abandoned_run_id,
         CASE WHEN event_type = 'signup' THEN 'PART-' || prev_seq END AS abandoned_part_no,
         CASE WHEN event_type = 'signup' THEN prev_time END AS abandoned_track_in,
         CAST(CASE WHEN event_type = 'signup' THEN n_before END AS BIGINT) AS data_point_count_at_abandonment
  FROM tracked
  WHERE (event_type = 'signup' AND is_open) OR (event_type <> 'signup' AND NOT is_open))"""


def tracked(keep: str = "TRUE") -> str:
    """Views up to `enriched` and `incomplete` over the press rows that satisfy `keep`."""
    return PRESS + _TRACKED.replace("{keep}", keep)


TRACKED = tracked()

RULE_LOG = """
rule_log AS (
  SELECT s_suppkey AS "offset", 1704067200000 + s_suppkey * 21600000 AS log_time, 'v' || s_suppkey AS version,
         CASE WHEN s_suppkey % 2 = 0 THEN 'Press-A' ELSE 'Press-B' END AS machine_type,
         CAST(100 + s_nationkey AS DOUBLE) AS max_vibration, CAST(s_nationkey AS DOUBLE) / 10 AS min_vibration,
         CAST(60 + s_nationkey AS DOUBLE) AS max_temperature,
         CASE WHEN s_acctbal >= 0 THEN CAST(5 AS DOUBLE) END AS min_temperature,
         CAST(75 AS DOUBLE) AS max_pressure,
         CASE WHEN s_nationkey % 2 = 0 THEN 'HIGH_PRECISION_STRICT' ELSE 'STANDARD_HEAVY_DUTY' END AS rule_profile
  FROM supplier),
rule_long AS (
  SELECT machine_type, version, rule_profile, "offset", log_time, 'vibration' AS measurement,
         max_vibration AS upper, min_vibration AS lower FROM rule_log
  UNION ALL
  SELECT machine_type, version, rule_profile, "offset", log_time, 'temperature', max_temperature, min_temperature
  FROM rule_log
  UNION ALL
  SELECT machine_type, version, rule_profile, "offset", log_time, 'pressure', max_pressure, CAST(NULL AS DOUBLE)
  FROM rule_log),
latest AS (
  SELECT r.* FROM rule_long r
  JOIN (SELECT machine_type, MAX("offset") AS newest FROM rule_log GROUP BY machine_type) n
    ON r.machine_type = n.machine_type AND r."offset" = n.newest)"""

# Readings in long form, under the current rules.
_CHECKED = PRESS + "," + RULE_LOG + """,
long_values AS (
  SELECT device_id, machine_type, timestamp, seq, 'vibration' AS measurement, value AS value FROM press WHERE {keep}
  UNION ALL
  SELECT device_id, machine_type, timestamp, seq, 'temperature', k FROM press WHERE {keep}),
checked AS (
  SELECT v.device_id, v.timestamp, v.seq, v.measurement, v.value, r.upper, r.lower, r.rule_profile,
         r.version AS rule_version
  FROM long_values v JOIN latest r ON v.machine_type = r.machine_type AND v.measurement = r.measurement),
breaches AS (
  SELECT device_id, timestamp, seq, measurement, value, 'upper' AS limit_type, upper AS limit_value,
         rule_profile, rule_version FROM checked WHERE value > upper
  UNION ALL
  SELECT device_id, timestamp, seq, measurement, value, 'lower', lower, rule_profile, rule_version
  FROM checked WHERE value < lower)"""


def checked(keep: str = "TRUE") -> str:
    """Views up to `checked` and `breaches` over the press rows that satisfy `keep`, each one a reading."""
    return _CHECKED.replace("{keep}", keep)


CHECKED = checked()


def zone_rules(series: str) -> str:
    """`scored`: rules 1-8 over `series`(device_id, measurement, timestamp, seq, value), in whole numbers.

    All values have two decimals, so hundredths and their sums are exact. With S and Q the sums of a window's values and
    squares, a value is off the centre by (n * value - S) / n and the variance is (n * Q - S * S) / n / (n - 1).
    """
    def tail(n: int) -> str:
        return f"list_slice(u, -{n}, -1)"

    def off(x: str, width: int) -> str:
        """Whether x lies beyond so many sigmas, on either side."""
        return f"(n * {x} - s) * (n * {x} - s) * (n - 1) > {width * width} * n * (n * q - s * s)"

    def beyond(n: int, needed: int, width: int) -> str:
        return (f"(len(list_filter({tail(n)}, lambda x: n * x > s AND {off('x', width)})) >= {needed} OR "
                f"len(list_filter({tail(n)}, lambda x: n * x < s AND {off('x', width)})) >= {needed})")

    return f"""
frames AS (
  SELECT device_id, measurement, timestamp, seq, value, CAST(COUNT(*) OVER f AS HUGEINT) AS n,
         bool_or(isinf(value)) OVER f AS wild, MAX(value) OVER f = 'infinity'::DOUBLE AS soars,
         SUM(hundredths) OVER f AS s, SUM(hundredths * hundredths) OVER f AS q, hundredths AS own,
         array_agg(hundredths) OVER f AS u, array_agg(value) OVER f AS w, array_agg(sign(step)) OVER f AS steps
  FROM (SELECT *, value - LAG(value) OVER (PARTITION BY device_id, measurement ORDER BY timestamp, seq) AS step,
               CAST(CASE WHEN isinf(value) THEN 0 ELSE round(value * 100) END AS HUGEINT) AS hundredths
        FROM {series}) AS stepped
  WINDOW f AS (PARTITION BY device_id, measurement ORDER BY timestamp, seq
               ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)),
spread AS (
  SELECT *, s / n::DOUBLE / 100 AS mean, n >= 15 AND (wild OR n * q > s * s) AS ready,
         CASE WHEN wild THEN 1 WHEN n > 1 THEN sqrt((n * q - s * s)::DOUBLE / (n * (n - 1))::DOUBLE) / 100 ELSE 0 END AS sd
  FROM frames),
scored AS (
  SELECT * REPLACE (CAST(n AS BIGINT) AS n),
    ready AND NOT wild AND {off('own', 3)} AS rule_1,
    ready AND CASE WHEN soars THEN len(list_filter(list_slice(w, -9, -1), lambda x: isinf(x))) = 0
      ELSE len(list_filter({tail(9)}, lambda x: n * x > s)) = 9
           OR len(list_filter({tail(9)}, lambda x: n * x < s)) = 9 END AS rule_2,
    ready AND abs(list_sum(list_slice(steps, -5, -1))) = 5 AS rule_3,
    ready AND len(list_filter(list_slice(steps, -13, -1), lambda x: x <> 0)) = 13
      AND len(list_filter(list_zip(list_slice(steps, -13, -2), list_slice(steps, -12, -1)), lambda p: p[1] = p[2])) = 0
      AS rule_4,
    ready AND NOT wild AND {beyond(3, 2, 2)} AS rule_5,
    ready AND NOT wild AND {beyond(5, 4, 1)} AS rule_6,
    ready AND NOT wild AND len(list_filter({tail(15)}, lambda x: {off('x', 1)})) = 0 AS rule_7,
    ready AND (wild OR len(list_filter({tail(8)}, lambda x: {off('x', 1)})) = 8) AS rule_8
  FROM spread)"""
