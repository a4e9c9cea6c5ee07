"""Cycle tracking over the press fleet: every row of `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.functions.encode import encoded_rows, field_text, incomplete_document
from trackline.functions.names import device_path, machine_type, routing_key
from trackline.operators import cycles
from trackline.operators.slices import plan_slices
from trackline.plans.registry import Catalogue
from trackline.plans.sql_views import INCOMPLETE_DOCUMENT, PRESS, TRACKED
from trackline.sources import fleet

CATALOGUE = Catalogue()


def tracked_presses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fleet on its time line, hot devices sliced."""
    timeline = fleet.press_timeline(spark, sf_dir)
    return cycles.track(timeline, plan_slices(timeline))


@CATALOGUE.add("machine_type", f"""
WITH {PRESS}
SELECT machine_type, COUNT(*) AS readings, COUNT(DISTINCT device_id) AS devices FROM press GROUP BY machine_type""")
def machine_types(spark, sf_dir):
    rows = fleet.press_messages(spark, sf_dir)
    # one row per device first, so that the few machine types never meet all rows
    devices = rows.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    return devices.groupBy(machine_type(F.col("device_id")).alias("machine_type")).agg(
        F.sum("n").alias("readings"), F.count(F.lit(1)).alias("devices"))


@CATALOGUE.add("device_path", f"""
WITH {PRESS}
SELECT seq, 'root.local.home.arpa.' || replace(machine_type, '-', '_') || '.' || replace(device_id, '-', '_') AS device
FROM press""")
def device_paths(spark, sf_dir):
    return fleet.press_messages(spark, sf_dir).select("seq", device_path(F.col("device_id")).alias("device"))


@CATALOGUE.add("routing_key", f"""
WITH {PRESS}
SELECT seq, CASE WHEN event_type = 'error' THEN '__unrouted__' ELSE device_id END AS routing_key FROM press""")
def routing_keys(spark, sf_dir):
    known = F.when(F.col("event_type") != "error", F.col("device_id"))
    return fleet.press_messages(spark, sf_dir).select("seq", routing_key(known).alias("routing_key"))


@CATALOGUE.add("list_safe_text", "SELECT event_id AS seq, replace(event_type || ',' || props, ',', ';') AS field FROM events")
def list_safe_text(spark, sf_dir):
    return fleet.press_messages(spark, sf_dir).select(
        "seq", field_text(F.concat_ws(",", "event_type", "props")).alias("field"))


@CATALOGUE.add("cycle_enrich", f"""
WITH {TRACKED}
SELECT device_id, timestamp, seq, vibration, temperature, status, context_complete, run_id, part_no, recipe_name,
       track_in, track_out, context_event, data_point_count, last_track_out
FROM enriched""")
def cycle_enrich(spark, sf_dir):
    return cycles.enriched_rows(tracked_presses(spark, sf_dir)).drop("kind_rank")


@CATALOGUE.add("cycle_enrich_sliced", f"""
WITH {TRACKED}
SELECT device_id, timestamp, seq, vibration, temperature, status, context_complete, run_id, part_no, recipe_name,
       track_in, track_out, context_event, data_point_count, last_track_out
FROM enriched""")
def cycle_enrich_sliced(spark, sf_dir):
    """Cycles as for hot devices: every device with more than 40 rows is cut into time slices."""
    timeline = fleet.press_timeline(spark, sf_dir)
    return cycles.enriched_rows(cycles.track(timeline, plan_slices(timeline, max_rows=40))).drop("kind_rank")


@CATALOGUE.add("cycle_enrich_two_feeds", f"""
WITH {TRACKED}
SELECT device_id, timestamp, seq, vibration, temperature, status, context_complete, run_id, part_no, recipe_name,
       track_in, track_out, context_event, data_point_count, last_track_out
FROM enriched""")
def cycle_enrich_two_feeds(spark, sf_dir):
    """The same join from separate reading and event feeds, unrecognised events included."""
    timeline = cycles.build_timeline(fleet.press_readings(spark, sf_dir), fleet.press_events(spark, sf_dir))
    return cycles.enriched_rows(cycles.track(timeline, plan_slices(timeline))).drop("kind_rank")


@CATALOGUE.add("recognised_events", """
SELECT CASE WHEN event_type = 'signup' THEN 'TRACK_IN' ELSE 'TRACK_OUT' END AS event_type, COUNT(*) AS events
FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY 1""")
def recognised_events(spark, sf_dir):
    rows = fleet.press_events(spark, sf_dir).filter(cycles.recognised(F.col("event_type")))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@CATALOGUE.add("cycle_markers", f"""
WITH {TRACKED}
SELECT device_id, timestamp, seq, run_id, part_no, recipe_name, track_in, track_out, context_event, data_point_count
FROM enriched WHERE context_event IS NOT NULL""")
def cycle_markers(spark, sf_dir):
    return cycles.cycle_markers(tracked_presses(spark, sf_dir))


@CATALOGUE.add("completed_cycles", f"""
WITH {TRACKED}
SELECT device_id, run_id, part_no, recipe_name, track_in, track_out, data_point_count,
       track_out - track_in AS duration_ms
FROM enriched WHERE context_event = 'TRACK_OUT_CLOSE'""")
def completed_cycles(spark, sf_dir):
    return cycles.completed_cycles(tracked_presses(spark, sf_dir))


@CATALOGUE.add("running_count", f"""
WITH {TRACKED}
SELECT device_id, seq, run_id, data_point_count FROM enriched WHERE kr = 1 AND context_complete""")
def running_count(spark, sf_dir):
    rows = cycles.enriched_rows(tracked_presses(spark, sf_dir))
    return rows.filter((F.col("kind_rank") == 1) & F.col("context_complete")).select(
        "device_id", "seq", "run_id", "data_point_count")


@CATALOGUE.add("incomplete_tracks", f"WITH {TRACKED} SELECT * FROM incomplete")
def incomplete_tracks(spark, sf_dir):
    return cycles.incomplete_tracks(tracked_presses(spark, sf_dir))


@CATALOGUE.add("incomplete_reasons", f"""
WITH {TRACKED} SELECT reason, COUNT(*) AS tracks FROM incomplete GROUP BY reason""")
def incomplete_reasons(spark, sf_dir):
    found = cycles.incomplete_tracks(tracked_presses(spark, sf_dir))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("tracks"))


@CATALOGUE.add("gap_since_close", f"""
WITH {TRACKED}
SELECT device_id, seq, last_track_out, gap_since_last_track_out_ms FROM incomplete WHERE reason = 'between_cycles'""")
def gap_since_close(spark, sf_dir):
    found = cycles.incomplete_tracks(tracked_presses(spark, sf_dir))
    return found.filter(F.col("reason") == cycles.BETWEEN_CYCLES).select(
        "device_id", "seq", "last_track_out", "gap_since_last_track_out_ms")


@CATALOGUE.add("last_track_out", f"""
WITH {PRESS}
SELECT device_id, MAX(timestamp) AS last_out FROM press WHERE event_type = 'purchase' GROUP BY device_id""")
def last_track_out(spark, sf_dir):
    """Last close per device at the end of the data, orphaned closes included."""
    closes = F.when(F.col("ev.event_type") == cycles.TRACK_OUT, F.col("timestamp"))
    last = fleet.press_timeline(spark, sf_dir).groupBy("device_id").agg(F.max(closes).alias("last_out"))
    return last.filter(F.col("last_out").isNotNull())


@CATALOGUE.add("open_cycles", f"""
WITH {TRACKED},
newest AS (SELECT device_id, event_type, timestamp, seq,
                  ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY timestamp DESC, seq DESC) AS age
           FROM line WHERE kr = 0)
SELECT n.device_id, 'RUN-' || n.seq AS run_id, n.timestamp AS track_in, COUNT(l.seq) AS data_point_count
FROM newest n LEFT JOIN line l ON l.device_id = n.device_id AND l.kr = 1 AND l.timestamp >= n.timestamp
WHERE n.age = 1 AND n.event_type = 'signup'
GROUP BY n.device_id, n.seq, n.timestamp""")
def open_cycles(spark, sf_dir):
    """Cycles still open at the end of the data."""
    state = cycles.closing_state(tracked_presses(spark, sf_dir))
    return state.filter(F.col("ev.event_type") == cycles.TRACK_IN).select(
        "device_id", "ev.run_id", F.col("ev.event_timestamp").alias("track_in"),
        F.col("n_since").alias("data_point_count"))


@CATALOGUE.add("incomplete_documents", f"WITH {TRACKED} SELECT seq, {INCOMPLETE_DOCUMENT} AS document FROM incomplete")
def incomplete_documents(spark, sf_dir):
    found = cycles.incomplete_tracks(tracked_presses(spark, sf_dir))
    return found.select("seq", incomplete_document().alias("document"))


@CATALOGUE.add("encoded_row", f"""
WITH {TRACKED}
SELECT 'root.local.home.arpa.' || replace(regexp_replace(device_id, '-[0-9]+$', ''), '-', '_') || '.'
         || replace(device_id, '-', '_') AS device,
       CAST(timestamp AS VARCHAR) AS timestamp,
       concat_ws(',', CASE WHEN kr = 1 THEN 'vibration,temperature,status' END,
         CASE WHEN run_id IS NOT NULL THEN 'run_id,part_no,recipe_name,track_in' END,
         CASE WHEN track_out IS NOT NULL THEN 'track_out' END,
         CASE WHEN context_event IS NOT NULL THEN 'context_event' END,
         CASE WHEN data_point_count IS NOT NULL THEN 'data_point_count' END) AS measurements,
       concat_ws(',', CASE WHEN kr = 1 THEN 'DOUBLE,DOUBLE,TEXT' END,
         CASE WHEN run_id IS NOT NULL THEN 'TEXT,TEXT,TEXT,INT64' END,
         CASE WHEN track_out IS NOT NULL THEN 'INT64' END,
         CASE WHEN context_event IS NOT NULL THEN 'TEXT' END,
         CASE WHEN data_point_count IS NOT NULL THEN 'INT64' END) AS types,
       concat_ws(',', CASE WHEN kr = 1 THEN concat_ws(',', vibration, temperature, status) END,
         CASE WHEN run_id IS NOT NULL THEN concat_ws(',', run_id, part_no, recipe_name, track_in) END,
         track_out, context_event, data_point_count) AS "values"
FROM enriched""")
def encoded_row(spark, sf_dir):
    return encoded_rows(cycles.enriched_rows(tracked_presses(spark, sf_dir)))
