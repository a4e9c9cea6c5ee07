"""Zone rules of statistical process control over a rolling window of one series.

A series is one (device, measurement). Centre line and sigma come from the last 25 values
including the current one; nothing is evaluated before 15 values or on a flat window. NaN
values never get here (`checked_values` drops them). A window that holds an infinite value has no
spread that is a number: comparisons with it are false, as in the monitor's contract, so of the rules
on zones only rule 8 (no point inside) fires there, also where all its values are infinite.

The sum of a window is exact: every value is cut on fixed grids into parts whose sums no rounding touches, so it depends
neither on the order of the values nor on the slicing, and the mean is one rounding away from the true one. A value that
is on a line as written (0.05 with a mean of 0.05) differs from it only by what binary numbers can't hold; differences
below ROUNDING of the window's largest value count as none, so such a value is *on* the line, on neither side of it.

Spark shuffles and sorts each series and marks where it opens; the sorted rows then pass through numpy in Arrow batches,
where a moving window of 25 rows costs 25 additions of whole columns instead of 25 row accesses per value and aggregate.
A task holds one batch and the 24 values before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.operators.slices import SlicePlan, partition_columns

# Window sizes and the rule texts of the alert contract.
MIN_POINTS = 15
WINDOW_CAPACITY = 25
RULES = {
    1: "Point beyond 3-sigma control limit",
    2: "9 points in a row on the same side of centerline",
    3: "6 points in a row steadily trending",
    4: "14 points in a row alternating up/down",
    5: "2 of 3 points beyond 2-sigma on the same side",
    6: "4 of 5 points beyond 1-sigma on the same side",
    7: "15 points in a row within 1-sigma (stratification)",
    8: "8 points in a row avoiding zone C (mixture pattern)",
}

SERIES = ("device_id", "measurement")

#: Grids of the exact sums, coarse to fine. 25 parts of one grid add up without rounding for values below LARGEST; digits
#: below the finest grid (1e-25) and larger values are summed as they are.
GRIDS = (8, -37, -82)
LARGEST = 2.0 ** 55
#: Share of a window's largest value below which a distance from a line is rounding. Values of up to 13 digits are told apart.
ROUNDING = 2.0 ** -45


#: What is added to each value.
SCORES = {"n": "long", "mean": "double", "sd": "double", **{f"rule_{number}": "boolean" for number in RULES}}


def _parts(values: np.ndarray) -> list[np.ndarray]:
    """Values as parts on the grids and a rest: `x + big - big` is x rounded to the grid that `big` can hold."""
    small, rest, parts = np.abs(values) < LARGEST, values, []  # infinite ones are not small
    for grid in GRIDS:
        big = 1.5 * 2.0 ** (52 + grid)
        parts.append(np.where(small, (rest + big) - big, 0.0))
        rest = rest - parts[-1]
    return [*parts, rest]


class _Series:
    """Scores one column of values that come batch by batch, in order; keeps the 24 values before the next batch."""

    def __init__(self) -> None:
        self.before = np.zeros(WINDOW_CAPACITY - 1)
        self.seen = 0  # values of the series that is still open

    def score(self, values: np.ndarray, present: np.ndarray, opens: np.ndarray) -> dict[str, np.ndarray]:
        """The scores of the values that are present; `opens` marks the first row of each series."""
        counted = np.cumsum(present)
        if len(counted):
            position = counted - np.maximum.accumulate(np.where(opens, counted - present, -self.seen))
            self.seen = int(position[-1])
            n = np.minimum(position, WINDOW_CAPACITY)[present]
        else:
            n = counted
        line = np.concatenate([self.before, values[present]])
        self.before = line[len(line) - WINDOW_CAPACITY + 1:]
        with np.errstate(all="ignore"):  # infinite values
            return _score(line, n)


def _score(line: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Scores of the values of `line` after the first 24; `n` of each are in its window, itself included."""
    size, longest = len(n), int(n.max(initial=0))

    def back(column: np.ndarray, k: int) -> np.ndarray:
        """The column k rows before each."""
        return column[WINDOW_CAPACITY - 1 - k:WINDOW_CAPACITY - 1 - k + size]

    own = [n > k for k in range(longest)]

    def total(column: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        if column.any():
            for k in range(longest):
                out += np.where(own[k], back(column, k), 0.0)
        return out

    coarse, middle, fine, rest = (total(part) for part in _parts(line))
    mean = (coarse + (middle + (fine + rest))) / n
    low, high, squares = np.full(size, np.inf), np.full(size, -np.inf), np.zeros(size)
    for k in range(longest):
        value = back(line, k)
        np.minimum(low, np.where(own[k], value, np.inf), out=low)
        np.maximum(high, np.where(own[k], value, -np.inf), out=high)
        off = np.where(own[k], value - mean, 0.0)
        squares += off * off
    largest = np.maximum(np.abs(low), np.abs(high))
    # A flat window has no spread, whatever rounding leaves in the sum; equal infinite values are no flat window either:
    # their spread is no number.
    sd = np.where(high > low, np.sqrt(squares / np.maximum(n - 1, 1)), 0.0)
    sd = np.where(np.isinf(largest) & (n > 1), np.nan, sd)
    near = np.where(np.isinf(largest), 0.0, largest * ROUNDING)
    last = [back(line, k) for k in range(MIN_POINTS)]
    ready = (n >= MIN_POINTS) & ((sd > 0) | np.isnan(sd))
    rules = _tests(last, sd, mean + near, mean - near)
    return {"n": n, "mean": mean, "sd": sd, **{f"rule_{number}": ready & test for number, test in rules.items()}}


def _tail(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last 24 values per key; Spark limits each map task to 24 rows per key before the shuffle."""
    latest = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*[F.desc(c) for c in _order(rows)])
    return (
        rows.withColumn("_age", F.row_number().over(latest)).filter(F.col("_age") < WINDOW_CAPACITY)
    )


def _order(rows: DataFrame) -> list[str]:
    return [c for c in ("phase", "timestamp", "seq") if c in rows.columns]


def closing_tail(values: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """Last 24 values of each series in `values`, `position` counting up to the newest.

    Together with `carry` (an earlier result) it is the state a later run starts from.
    """
    rows = values.select(*SERIES, F.lit(1).alias("phase"), "timestamp", "seq", "value")
    if carry is not None:
        rows = _carry_rows(carry).unionByName(rows)
    return _tail(rows, list(SERIES)).select(*SERIES, (-F.col("_age")).alias("position"), "value")


def pack_tails(tails: DataFrame) -> DataFrame:
    """One row per series for storage; a tail has at most 24 values."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "value")))
    return tails.groupBy(*SERIES).agg(ordered.alias("_t")).select(*SERIES, F.col("_t.value").alias("tail"))


def unpack_tails(packed: DataFrame) -> DataFrame:
    """The inverse of `pack_tails`."""
    return packed.select(*SERIES, F.size("tail").alias("_n"), F.posexplode("tail").alias("_at", "value")).select(
        *SERIES, (F.col("_at") - F.col("_n")).alias("position"), "value")


def _carry_rows(carry: DataFrame) -> DataFrame:
    return carry.select(*SERIES, F.lit(0).alias("phase"), F.col("position").cast("long").alias("timestamp"),
                        F.lit(0).cast("long").alias("seq"), "value")


def _slice_seeds(values: DataFrame, plan: SlicePlan, carry: DataFrame | None) -> DataFrame:
    """The 24 values before each slice of the hot series.

    Each slice gives its last 24 values; over these few rows the values before the next slice
    are a frame of 24 rows.
    """
    hot = values.join(plan.hot(), "device_id", "left_semi")
    tails = _tail(hot.select(*SERIES, "slice", "timestamp", "seq", "value"), [*SERIES, "slice"])
    tails = tails.select(*SERIES, "slice", F.lit(1).alias("phase"), "timestamp", "seq", "value",
                         (F.col("_age") == 1).alias("_closes"))
    if carry is not None:
        earlier = _carry_rows(carry).join(plan.hot(), "device_id", "left_semi")
        tails = tails.unionByName(earlier.withColumns({"slice": F.lit(-1), "_closes": F.col("timestamp") == -1}))
    in_order = Window.partitionBy(*SERIES).orderBy("slice", "phase", "timestamp", "seq")
    kept = F.collect_list("value").over(in_order.rowsBetween(2 - WINDOW_CAPACITY, 0))
    by_slice = Window.partitionBy(*SERIES).orderBy("slice")
    return (
        tails.withColumn("_kept", kept).filter("_closes")
        .withColumn("_before", F.lag("_kept").over(by_slice))
        .filter("slice >= 0 AND _before IS NOT NULL")
        .select(*SERIES, "slice", F.posexplode("_before").alias("_at", "value"))
        .select(*SERIES, "slice", F.lit(0).alias("phase"), F.col("_at").cast("long").alias("timestamp"),
                F.lit(0).cast("long").alias("seq"), "value")
    )


def evaluate(values: DataFrame, plan: SlicePlan | None = None, carry: DataFrame | None = None) -> DataFrame:
    """Add n, mean, sd and rule_1 .. rule_8 to each value.

    `values` holds device_id, measurement, timestamp, seq, value (and `slice` with a plan);
    `carry` is the result of `closing_tail` over earlier data.
    """
    rows = values.withColumn("value", F.coalesce("value", F.lit(0.0)))
    seeds = None
    if plan is not None:
        seeds = _slice_seeds(values, plan, carry)
        if carry is not None:
            cold = carry.join(plan.hot(), "device_id", "left_anti")
            seeds = seeds.unionByName(_carry_rows(cold).withColumn("slice", F.lit(0)))
    elif carry is not None:
        seeds = _carry_rows(carry)
    if seeds is not None:
        rows = rows.withColumn("phase", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    rows = _opened(rows, plan, *SERIES)
    kept = [f for f in rows.schema.fields if f.name not in ("_opens", "slice", "phase")]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept] + _score_fields())
    return rows.mapInArrow(partial(_score_rows, tuple(f.name for f in kept)), schema)


def evaluate_fields(readings: DataFrame, names: list[str], plan: SlicePlan | None = None) -> DataFrame:
    """`evaluate` over the fields `names` of readings that carry all of them: the values on which a rule fired.

    Readings are sorted once, not once per measurement. `readings` holds device_id, timestamp, seq, the fields (and `slice`
    with a plan).
    """
    keep = ["device_id", "timestamp", "seq"]
    rows = readings.select(*keep, *(["slice"] if plan else []),
                           *[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in names])
    if plan is not None:
        measured = F.array(*[F.struct(F.lit(m).alias("measurement"), F.col(m).alias("value")) for m in names])
        seeds = _slice_seeds(rows.select(*keep, "slice", F.inline(measured)), plan, None)
        # a seed is a row with one field, so it enters the windows of that field alone
        seeds = seeds.select(*keep, "slice", "phase", *[F.when(F.col("measurement") == m, F.col("value")).alias(m) for m in names])
        rows = rows.withColumn("phase", F.lit(1)).unionByName(seeds)
    rows = _opened(rows, plan, "device_id")
    types = {c: rows.schema[c].dataType for c in keep}
    schema = T.StructType([
        *[T.StructField(c, types[c]) for c in keep], T.StructField("measurement", T.StringType()),
        T.StructField("value", T.DoubleType()), *_score_fields()])
    return rows.mapInArrow(partial(_score_fields_of, tuple(keep), tuple(names)), schema)


def _opened(rows: DataFrame, plan: SlicePlan | None, *keys: str) -> DataFrame:
    """The rows of each window key together and in order, its first row marked by `_opens`.

    A hash of the keys comes first in the sort: names of devices often begin alike, and numbers are compared faster.
    """
    columns = partition_columns(plan, *keys)
    spec = Window.partitionBy(F.xxhash64(*columns), *columns).orderBy(*_order(rows))
    return rows.withColumn("_opens", F.row_number().over(spec) == 1)


def _score_fields() -> list[T.StructField]:
    return list(T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in SCORES.items())).fields)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _is_new(batch: pa.RecordBatch) -> np.ndarray:
    """False for seeds, which only fill the windows of the rows after them."""
    return _column(batch, "phase") == 1 if "phase" in batch.schema.names else np.ones(batch.num_rows, dtype=bool)


def _score_rows(names: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    series = _Series()
    for batch in batches:
        found = series.score(_column(batch, "value"), np.ones(batch.num_rows, dtype=bool), _column(batch, "_opens"))
        out = pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [pa.array(found[c]) for c in SCORES], names=[*names, *SCORES])
        yield out.filter(pa.array(_is_new(batch))) if "phase" in batch.schema.names else out


def _score_fields_of(keep: tuple[str, ...], names: tuple[str, ...],
                     batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    series = {name: _Series() for name in names}
    for batch in batches:
        opens, new, rows = _column(batch, "_opens"), _is_new(batch), batch.select(list(keep))
        for name in names:
            present = batch.column(name).is_valid().to_numpy(zero_copy_only=False)
            values = _column(batch, name)
            found = series[name].score(values, present, opens)
            fired = np.flatnonzero(np.logical_or.reduce([found[f"rule_{number}"] for number in RULES]) & new[present])
            if len(fired):
                at = np.flatnonzero(present)[fired]
                yield pa.RecordBatch.from_arrays(
                    [*rows.take(pa.array(at)).columns, pa.array([name] * len(at)), pa.array(values[at]),
                     *[pa.array(found[c][fired]) for c in SCORES]], names=[*keep, "measurement", "value", *SCORES])


def _tests(last: list[np.ndarray], sd: np.ndarray, up: np.ndarray, down: np.ndarray) -> dict[int, np.ndarray]:
    """The eight rules over the latest values, newest first; comparisons with a spread that is no number are false."""
    every, least, greatest = np.logical_and.reduce, np.minimum.reduce, np.maximum.reduce
    rising = [a > b for a, b in zip(last, last[1:])]
    falling = [a < b for a, b in zip(last, last[1:])]

    def beyond(points: int, needed: int, width: int) -> np.ndarray:
        high, low = up + width * sd, down - width * sd
        return ((sum((v > high).astype(np.int8) for v in last[:points]) >= needed)
                | (sum((v < low).astype(np.int8) for v in last[:points]) >= needed))

    high, low = up + sd, down - sd
    return {
        1: beyond(1, 1, 3),
        2: (least(last[:9]) > up) | (greatest(last[:9]) < down),
        3: every(rising[:5]) | every(falling[:5]),
        4: every([(rising[k] & falling[k + 1]) | (falling[k] & rising[k + 1]) for k in range(12)]),
        5: beyond(3, 2, 2),
        6: beyond(5, 4, 1),
        7: (greatest(last[:15]) <= high) & (least(last[:15]) >= low),
        8: np.isnan(sd) | every([(v > high) | (v < low) for v in last[:8]]),
    }


def violations(evaluated: DataFrame) -> DataFrame:
    """One row per value and rule that fired.

    The array holds one entry per rule, null where it did not fire; dropping the nulls after
    the generator keeps the whole step in generated code, which array filters do not.
    """
    cases = [f"CASE WHEN rule_{number} THEN named_struct('rule_number', {number}, 'rule_description', '{text}') END"
             for number, text in RULES.items()]
    return evaluated.filter((F.col("n") >= MIN_POINTS) & (F.col("sd") > 0)).select(
        "device_id", "timestamp", "seq", "measurement", "value", F.expr(f"inline(array({', '.join(cases)}))")
    ).filter("rule_number IS NOT NULL")
