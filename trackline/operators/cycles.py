"""Production cycles: which cycle a reading belongs to, and what went wrong with tracking.

The state of a device before a row depends only on its latest recognised event, because every
such event overwrites or clears it. So one window per device replaces the state machine:
`last(event)` finds the open cycle and a running count of readings, minus its value at that
event, gives the position inside the cycle.

Frames:
  timeline  device_id, timestamp, kind_rank, seq, ev, <sensor columns>
            kind_rank 0 = event, 1 = reading, so a reading at the very millisecond of an
            event comes after it: a cycle covers [track_in, track_out).
  carry     device_id, ev, n_since, last_out: the state of a device before its first row
  tracked   timeline + prev (latest event), n_before, last_out, open
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.functions.fields import held
from trackline.operators.slices import SlicePlan, partition_columns
from trackline.session import bounded_broadcast

# The event types and the words of the output contract.
TRACK_IN = "TRACK_IN"
TRACK_OUT = "TRACK_OUT"
MARKER_CLOSE = "TRACK_OUT_CLOSE"
MARKER_ORPHANED = "TRACK_OUT_ORPHANED"
NEVER_TRACKED = "never_tracked_since_job_start"
BETWEEN_CYCLES = "between_cycles"
ABANDONED = "abandoned_cycle"
ORPHANED = "orphaned_track_out"

EVENT = "struct<event_type:string,event_timestamp:bigint,run_id:string,part_no:string,recipe_name:string>"
TIMELINE_KEYS = ("device_id", "timestamp", "kind_rank", "seq", "ev")


def recognised(event_type: Column) -> Column:
    return event_type.isin(TRACK_IN, TRACK_OUT)


def event_struct(event_type: Column, timestamp: Column, run_id: Column, part_no: Column, recipe: Column) -> Column:
    return F.struct(event_type.alias("event_type"), timestamp.alias("event_timestamp"), run_id.alias("run_id"),
                    part_no.alias("part_no"), recipe.alias("recipe_name"))


def build_timeline(readings: DataFrame, events: DataFrame) -> DataFrame:
    """Put readings and recognised events of all devices on one time line; any field name is kept."""
    marked = held(readings).withColumns({"kind_rank": F.lit(1), "ev": F.lit(None).cast(EVENT)})
    turns = events.filter(recognised(F.col("event_type"))).select(
        "device_id",
        F.col("event_timestamp").alias("timestamp"),
        "seq",
        F.lit(0).alias("kind_rank"),
        event_struct(F.col("event_type"), F.col("event_timestamp"), F.col("run_id"), F.col("part_no"),
                     F.col("recipe_name")).alias("ev"),
    )
    return marked.unionByName(turns, allowMissingColumns=True)


def sensor_columns(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in (*TIMELINE_KEYS, "slice", "phase", "n_seed", "out_seed")]


def _order_key() -> Column:
    return F.struct("timestamp", "kind_rank", "seq")


def _slice_carry(timeline: DataFrame, plan: SlicePlan, carry: DataFrame | None) -> DataFrame:
    """State before each slice of the hot devices, from per-slice summaries.

    Hot rows are never shuffled here: the latest event per slice is a map-side combined
    aggregate, and so is the count of the readings that follow it.
    """
    rows = plan.assign(timeline.select(*TIMELINE_KEYS), hot_only=True)
    closing = rows.filter("ev IS NOT NULL").groupBy("device_id", "slice").agg(
        F.max_by("ev", _order_key()).alias("_ev"),
        F.max(_order_key()).alias("_ev_key"),
        F.max(F.when(F.col("ev.event_type") == TRACK_OUT, F.col("timestamp"))).alias("_out"),
    )
    following = (
        rows.filter("ev IS NULL")
        .join(bounded_broadcast(closing.select("device_id", "slice", "_ev_key"), rows=plan.slices * 2),
              ["device_id", "slice"], "left")
        .groupBy("device_id", "slice")
        .agg(F.count_if(F.col("_ev_key").isNull() | (_order_key() > F.col("_ev_key"))).alias("_n"))
    )
    summary = closing.drop("_ev_key").join(following, ["device_id", "slice"], "full")
    if carry is not None:
        initial = carry.join(plan.hot(), "device_id", "left_semi").select(
            "device_id", F.lit(-1).alias("slice"), F.col("ev").alias("_ev"), F.col("last_out").alias("_out"),
            F.col("n_since").alias("_n"))
        summary = summary.unionByName(initial)

    # One row per slice from here on.
    by_device = Window.partitionBy("device_id").orderBy("slice")
    before = by_device.rowsBetween(Window.unboundedPreceding, -1)
    return (
        summary.withColumn("_read", F.coalesce(F.sum(F.coalesce("_n", F.lit(0))).over(before), F.lit(0)))
        .withColumns({
            "ev": F.last("_ev", ignorenulls=True).over(before),
            "last_out": F.last("_out", ignorenulls=True).over(before),
            "_base": F.last(F.when(F.col("_ev").isNotNull(), F.col("_read")), ignorenulls=True).over(before),
        })
        .filter("slice >= 0")
        .select("device_id", "slice", "ev", (F.col("_read") - F.coalesce("_base", F.lit(0))).alias("n_since"),
                "last_out")
    )


def _seed_rows(carry: DataFrame) -> DataFrame:
    """Carried state as rows that sort before everything else in their partition."""
    return carry.withColumns({
        "timestamp": F.lit(0).cast("long"), "kind_rank": F.lit(-1), "seq": F.lit(0).cast("long"),
        "phase": F.lit(0),
    }).withColumnsRenamed({"n_since": "n_seed", "last_out": "out_seed"})


def track(timeline: DataFrame, plan: SlicePlan | None = None, carry: DataFrame | None = None) -> DataFrame:
    """Attach the state of the device to each row of the timeline: one shuffle, one sort.

    `plan` spreads hot devices over several tasks; `carry` is the state left by earlier data.
    """
    rows = timeline
    keys = partition_columns(plan, "device_id")
    order = [F.col("timestamp"), F.col("kind_rank"), F.col("seq")]
    seeds = None
    if plan is not None:
        rows = plan.assign(rows)
        seeds = _seed_rows(_slice_carry(timeline, plan, carry))
        if carry is not None:
            cold = carry.join(plan.hot(), "device_id", "left_anti")
            seeds = seeds.unionByName(_seed_rows(cold.withColumn("slice", F.lit(0))))
    elif carry is not None:
        seeds = _seed_rows(carry)
    if seeds is not None:
        rows = rows.withColumns({"phase": F.lit(1), "n_seed": F.lit(None).cast("long"),
                                 "out_seed": F.lit(None).cast("long")})
        rows = rows.unionByName(seeds, allowMissingColumns=True)
        order = [F.col("phase"), *order]

    spec = Window.partitionBy(*keys).orderBy(*order)
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    through = spec.rowsBetween(Window.unboundedPreceding, 0)
    is_reading = F.col("kind_rank") == 1
    base = F.col("_read")
    out_here = F.when(F.col("ev.event_type") == TRACK_OUT, F.col("timestamp"))
    if seeds is not None:
        base = F.when(F.col("phase") == 0, -F.col("n_seed")).otherwise(base)
        out_here = F.when(F.col("phase") == 0, F.col("out_seed")).otherwise(out_here)

    out = (
        rows.withColumn("_read", F.count_if(is_reading).over(through))
        .withColumns({
            "_prev": F.last(F.when(F.col("ev").isNotNull(), F.struct("ev", base.alias("base"))),
                            ignorenulls=True).over(before),
            "last_out": F.last(out_here, ignorenulls=True).over(before),
        })
        .withColumns({
            "prev": F.col("_prev.ev"),
            "n_before": F.col("_read") - F.col("_prev.base"),
            "open": F.coalesce(F.col("_prev.ev.event_type") == TRACK_IN, F.lit(False)),
        })
    )
    if seeds is not None:
        out = out.filter("phase = 1")
    return out.drop("_prev", "_read", "slice", "phase", "n_seed", "out_seed")


def _is(event_type: str) -> Column:
    return F.coalesce(F.col("ev.event_type") == event_type, F.lit(False))


def enriched_rows(tracked: DataFrame) -> DataFrame:
    """Readings with their cycle, and one marker row per recognised event.

    Incomplete readings stay in the output; `last_track_out` is set on them only.
    """
    reading = F.col("kind_rank") == 1
    inherits = F.col("open") & (reading | _is(TRACK_OUT))
    opens = _is(TRACK_IN)

    def of_cycle(field: str) -> Column:
        return F.when(opens, F.col(f"ev.{field}")).when(inherits, F.col(f"prev.{field}"))

    sensors = [c for c in sensor_columns(tracked) if c not in ("prev", "n_before", "last_out", "open")]
    return tracked.select(
        "device_id", "timestamp", "kind_rank", "seq", *sensors,
        (~reading | F.col("open")).alias("context_complete"),
        of_cycle("run_id").alias("run_id"),
        of_cycle("part_no").alias("part_no"),
        of_cycle("recipe_name").alias("recipe_name"),
        of_cycle("event_timestamp").alias("track_in"),
        F.when(_is(TRACK_OUT), F.col("timestamp")).alias("track_out"),
        F.when(opens, TRACK_IN)
        .when(_is(TRACK_OUT), F.when(F.col("open"), MARKER_CLOSE).otherwise(MARKER_ORPHANED))
        .alias("context_event"),
        F.when(opens, F.lit(0).cast("long")).when(inherits, F.col("n_before")).alias("data_point_count"),
        F.when(reading & ~F.col("open"), F.col("last_out")).alias("last_track_out"),
    )


def cycle_markers(tracked: DataFrame) -> DataFrame:
    """Only the rows that stand for an event, without sensor columns."""
    return enriched_rows(tracked.filter("kind_rank = 0").select(
        *TIMELINE_KEYS, "prev", "n_before", "last_out", "open")).drop("kind_rank", "context_complete", "last_track_out")


def completed_cycles(tracked: DataFrame) -> DataFrame:
    """One row per cycle that was opened and closed, with its final count."""
    return (
        cycle_markers(tracked.filter(F.col("open") & _is(TRACK_OUT)))
        .select("device_id", "run_id", "part_no", "recipe_name", "track_in", "track_out", "data_point_count")
        .withColumn("duration_ms", F.col("track_out") - F.col("track_in"))
    )


def incomplete_tracks(tracked: DataFrame) -> DataFrame:
    """The four tracking faults, one row each; a fault never removes the row it flags."""
    reading = F.col("kind_rank") == 1
    abandoned = _is(TRACK_IN) & F.col("open")
    orphaned = _is(TRACK_OUT) & ~F.col("open")
    idle = reading & ~F.col("open")
    known = idle & F.col("last_out").isNotNull()
    return tracked.filter(abandoned | orphaned | idle).select(
        "device_id", "timestamp", "seq",
        F.when(abandoned, ABANDONED).when(orphaned, ORPHANED)
        .when(known, BETWEEN_CYCLES).otherwise(NEVER_TRACKED).alias("reason"),
        F.when(known, F.col("last_out")).alias("last_track_out"),
        F.when(known, F.col("timestamp") - F.col("last_out")).alias("gap_since_last_track_out_ms"),
        F.when(abandoned, F.col("prev.run_id")).alias("abandoned_run_id"),
        F.when(abandoned, F.col("prev.part_no")).alias("abandoned_part_no"),
        F.when(abandoned, F.col("prev.event_timestamp")).alias("abandoned_track_in"),
        F.when(abandoned, F.col("n_before")).alias("data_point_count_at_abandonment"),
    )


def closing_state(tracked: DataFrame) -> DataFrame:
    """State of each device after its last row, in the form `track` takes as `carry`."""
    is_event = F.col("kind_rank") == 0
    after = F.struct(
        F.coalesce("ev", "prev").alias("ev"),
        F.when(is_event, F.lit(0).cast("long")).otherwise(F.coalesce("n_before", F.lit(0))).alias("n_since"),
        F.when(_is(TRACK_OUT), F.col("timestamp")).otherwise(F.col("last_out")).alias("last_out"),
    )
    return (
        tracked.groupBy("device_id")
        .agg(F.max_by(after, _order_key()).alias("s"), F.max("timestamp").alias("last_timestamp"))
        .select("device_id", "s.ev", "s.n_since", "s.last_out", "last_timestamp")
    )
