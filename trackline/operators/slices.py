"""Time slices for keys (devices, machine types, subjects) that hold too many rows for one task.

A window sorts all rows of its key in one task. Keys above `max_rows` are cut into
consecutive time slices of about that many rows; the window then runs per (key, slice) and
what must cross a slice border is carried over by seed rows, which the operators build from
per-slice summaries. Keys below the limit keep slice 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.session import bounded_broadcast

#: Rows of one device that one task sorts without trouble (about 200 MB of readings).
MAX_ROWS = 4_000_000

#: Histogram cells per slice: a slice overshoots `max_rows` by at most one cell. No grid has more cells than rows to count.
CELLS_PER_SLICE = 16

#: A cell that alone exceeds a slice is cut into at least this many finer ones, if it has as many rows.
CELLS_PER_BURST = 256

#: Largest grid, in cells, that may be copied to every executor.
BROADCAST_CELLS = 20_000_000


@dataclass(frozen=True)
class Grid:
    """Equal time cells from `_base` on, `_width` wide, and the slice of each (`_slice_of`).

    The first grid has one row per hot key; each further one refines cells of the grid before
    that hold too many rows. `_start` names the refined cell; `_base` is the first row in it.
    """

    table: DataFrame
    cells: int

    def join(self, rows: DataFrame, on: str | list[str], how: str) -> DataFrame:
        return rows.join(bounded_broadcast(self.table, BROADCAST_CELLS, self.cells), on, how)


@dataclass(frozen=True)
class SlicePlan:
    """Where the slices of the hot keys are."""

    grids: list[Grid]
    hot_keys: int
    slices: int
    key: str = "device_id"
    held: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Drop the cached counts; for streams, which make a plan per micro-batch."""
        for frame in self.held:
            frame.unpersist()

    def assign(self, rows: DataFrame, hot_only: bool = False) -> DataFrame:
        """Add `slice` to the rows; each lookup is one array access on a joined row.

        Timestamps outside the planned span go to the first or last slice.
        """
        first, *finer = self.grids
        out = _locate(first.join(rows, self.key, "inner" if hot_only else "left"), F.lit(0))
        for grid in finer:
            out = _locate(grid.join(out, [self.key, "_start"], "left"), F.col("slice"))
        return out.drop("_start")

    def hot(self) -> DataFrame:
        """The hot keys, hinted for a broadcast where their number allows it."""
        return bounded_broadcast(self.grids[0].table.select(self.key), rows=self.hot_keys)

    def slice_list(self) -> DataFrame:
        """Every slice of every hot key."""
        found = [g.table.select(self.key, F.explode(F.array_distinct("_slice_of")).alias("slice")) for g in self.grids]
        return reduce(DataFrame.union, found).distinct()


def _cell() -> Column:
    return F.floor((F.col("timestamp") - F.col("_base")) / F.col("_width"))


def _locate(joined: DataFrame, otherwise: Column) -> DataFrame:
    """Slice and start of the cell of each row, from the grid joined to it."""
    cell = F.least(F.greatest(_cell(), F.lit(0)), F.size("_slice_of") - 1)
    return joined.withColumns({
        "slice": F.coalesce(F.get("_slice_of", cell.cast("int")), otherwise),
        "_start": F.col("_base") + cell * F.col("_width"),
    }).drop("_base", "_width", "_slice_of")


def plan_slices(rows: DataFrame, max_rows: int = MAX_ROWS, key: str = "device_id") -> SlicePlan | None:
    """Measure the keys and slice the hot ones; None when no key is hot.

    Every pass reads two columns and combines map-side, so only counts are shuffled. There are
    at most total_rows / max_rows hot keys, and as many cells to refine. Refinement ends at
    one millisecond.
    """
    rows = rows.select(key, "timestamp")
    slices = F.ceil(F.col("_n") / F.lit(max_rows))
    hot = (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("timestamp").alias("_base"), F.max("timestamp").alias("_end"))
        .filter(F.col("_n") > max_rows)
        .select(key, "_n", F.col("_base").alias("_start"), "_base", "_end", F.lit(0).cast("long").alias("_before"),
                F.ceil((F.col("_end") - F.col("_base") + 1) / F.least(slices * CELLS_PER_SLICE, F.col("_n"))).alias("_width"))
    )
    grids: list[Grid] = []
    held: list[DataFrame] = []
    hot_keys = total = 0
    while True:
        hot = hot.persist()
        held.append(hot)
        found, rows_found, cells = hot.agg(
            F.count(F.lit(1)), F.sum(slices),
            F.sum(F.floor((F.col("_end") - F.col("_base")) / F.col("_width")) + 1)).first()
        if not found:
            held.pop().unpersist()
            return SlicePlan(grids, hot_keys, total, key, tuple(held)) if grids else None
        if not grids:
            hot_keys, total = int(found), int(rows_found)
        rows, filled = _count_cells(rows, hot, key, int(found), first=not grids)
        by_grid = F.sort_array(F.collect_list(F.struct(
            "_cell", F.floor(F.col("_before") / F.lit(max_rows)).cast("int").alias("_slice"))))
        table = filled.groupBy(key, "_start", "_base", "_width").agg(by_grid.alias("_cells"))
        names = [key, "_base", "_width", F.col("_cells._slice").alias("_slice_of")]
        table = table.select(*names) if not grids else table.select("_start", *names)
        grids.append(Grid(table.persist(), int(cells)))
        held += [filled, grids[-1].table]
        hot = _bursts(filled, max_rows, key)


def _count_cells(rows: DataFrame, hot: DataFrame, key: str, found: int, first: bool) -> tuple[DataFrame, DataFrame]:
    """The rows of the hot ranges with the start of their cell, and all cells with the rows before each."""
    ranges = hot.drop("_start") if first else hot
    inside = rows.join(bounded_broadcast(ranges, rows=found), key if first else [key, "_start"])
    cell_start = F.col("_base") + F.col("_cell") * F.col("_width")
    inside = inside.withColumn("_cell", _cell()).select(
        key, "timestamp", "_base", "_cell", cell_start.alias("_start"))
    counts = inside.groupBy(key, "_base", "_cell").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("timestamp").alias("_low"), F.max("timestamp").alias("_high"))
    last = F.floor((F.col("_end") - F.col("_base")) / F.col("_width"))
    cells = hot.select(key, "_start", "_base", "_width", "_before",
                       F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_cell"))
    earlier = Window.partitionBy(key, "_base").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    filled = cells.join(counts, [key, "_base", "_cell"], "left").withColumn(
        "_before", F.col("_before") + F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    return inside.select(key, "timestamp", "_start"), filled.persist()


def _bursts(filled: DataFrame, max_rows: int, key: str) -> DataFrame:
    """Cells that alone exceed a slice, as ranges to count again; rows of one millisecond stay together."""
    parts = F.greatest(F.col("_rows") * CELLS_PER_SLICE / F.lit(max_rows), F.lit(CELLS_PER_BURST))
    parts = F.least(parts, F.col("_rows"))
    return filled.filter((F.col("_rows") > max_rows) & (F.col("_high") > F.col("_low"))).select(
        key, F.col("_rows").alias("_n"),
        (F.col("_base") + F.col("_cell") * F.col("_width")).alias("_start"),
        F.col("_low").alias("_base"), F.col("_high").alias("_end"), "_before",
        F.ceil((F.col("_high") - F.col("_low") + 1) / parts).alias("_width"))


def partition_columns(plan: SlicePlan | None, *keys: str) -> list[Column]:
    """Window keys: the given ones, and the slice where there is a plan."""
    return [F.col(k) for k in keys] + ([F.col("slice")] if plan is not None else [])


def carry_forward(rows: DataFrame, value: str, key: str, order: list[str], plan: SlicePlan | None = None) -> DataFrame:
    """Add `carried`: the last non-null `value` among the earlier rows of the same key.

    The first of `order` must be `timestamp`. One shuffle; with a plan, the last value before
    each slice comes from a map-side combined aggregate.
    """
    keys = partition_columns(plan, key)
    sort = [F.col(c) for c in order]
    if plan is not None:
        per_slice = (
            plan.assign(rows.filter(F.col(value).isNotNull()).select(key, value, *order), hot_only=True)
            .groupBy(key, "slice").agg(F.max_by(value, F.struct(*order)).alias("_last"))
        )
        # every slice of the plan gets a seed, whether or not it holds a value of its own
        earlier = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        seeds = (
            plan.slice_list().join(per_slice, [key, "slice"], "left")
            .select(key, "slice", F.last("_last", ignorenulls=True).over(earlier).alias(value), F.lit(0).alias("_phase"))
            .filter(F.col(value).isNotNull())
        )
        rows = plan.assign(rows).withColumn("_phase", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
        sort = [F.col("_phase"), *sort]
    before = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("carried", F.last(value, ignorenulls=True).over(before))
    return out.filter("_phase = 1").drop("_phase", "slice") if plan is not None else out
