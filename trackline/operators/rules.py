"""Control rules: limits per machine type, and their lookup for each reading.

Frames:
  rule log   machine_type, version, rule_profile, offset, log_time, max_<m> / min_<m> columns
  long form  machine_type, version, rule_profile, measurement, upper, lower
  rule book  machine_type, rule struct<version, rule_profile, limits array<struct<measurement, upper, lower>>>
  checked    device_id, timestamp, seq, measurement, value, upper, lower, rule_profile, rule_version
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.functions.fields import field_name, held
from trackline.functions.names import machine_type
from trackline.operators.slices import carry_forward, plan_slices
from trackline.session import BROADCAST_ROWS, bounded_broadcast

# The prefixes that make a numeric field a limit.
MAX_PREFIX = "max_"
MIN_PREFIX = "min_"
#: Rows of the time line of readings and rules that one task carries rules along. Machine types are few, so they are cut finer
#: than devices: the slices also are what spreads the work.
LINE_ROWS = 250_000
#: Rules of one time cell above which it is cut into finer ones.
CROWD = 16


def limited_measurements(schema: T.StructType) -> list[str]:
    """Upper and lower measurement names together, in schema order."""
    names: dict[str, None] = {}
    for field in schema.fields:
        if isinstance(field.dataType, T.NumericType) and field.name.startswith((MAX_PREFIX, MIN_PREFIX)):
            names[field.name[len(MAX_PREFIX):]] = None
    return list(names)


def _limit(schema: T.StructType, name: str) -> Column:
    """A limit that is not a number limits nothing: every comparison with it is false."""
    present = name in schema.fieldNames() and isinstance(schema[name].dataType, T.NumericType)
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value) if present else F.lit(None).cast("double")


def limits_array(schema: T.StructType) -> Column:
    """All limits of one rule record as array<struct<measurement, upper, lower>>."""
    entries = [
        F.struct(F.lit(m).alias("measurement"), _limit(schema, MAX_PREFIX + m).alias("upper"),
                 _limit(schema, MIN_PREFIX + m).alias("lower"))
        for m in limited_measurements(schema)
    ]
    return F.filter(F.array(*entries), lambda e: e.upper.isNotNull() | e.lower.isNotNull())


def limit_maps(rules: DataFrame) -> DataFrame:
    """The map form: upper and lower limits by measurement."""
    limits = limits_array(rules.schema)

    def side(name: str) -> Column:
        held = F.filter(limits, lambda e: e[name].isNotNull())
        return F.map_from_entries(F.transform(held, lambda e: F.struct(e["measurement"], e[name])))

    return rules.select("machine_type", "version", "rule_profile", side("upper").alias("upper"),
                        side("lower").alias("lower"))


def rules_long(rules: DataFrame) -> DataFrame:
    """One row per rule record and limited measurement; new limit columns need no change here."""
    return rules.select("machine_type", "version", "rule_profile",
                        F.inline(limits_array(rules.schema)))


def latest_rules(log: DataFrame) -> DataFrame:
    """The last record per machine type wins, combined map-side. Records hold text, so Spark sorts them to aggregate.

    A record without a machine type is not usable.
    """
    row = F.struct(*[c for c in log.columns if c != "machine_type"])
    return (
        log.filter(F.col("machine_type").isNotNull())
        .groupBy("machine_type").agg(F.max_by(row, "offset").alias("r")).select("machine_type", "r.*")
    )


def rule_book(rules: DataFrame) -> DataFrame:
    """One row per rule record with all its limits in one array, ready for the lookup."""
    rule = F.struct(F.col("version"), F.col("rule_profile"), limits_array(rules.schema).alias("limits"))
    kept = [c for c in ("offset", "log_time") if c in rules.columns]
    return rules.select("machine_type", rule.alias("rule"), *kept)


def measurement_columns(readings: DataFrame) -> list[str]:
    """The numeric fields of a reading besides its identity."""
    identity = ("device_id", "timestamp", "seq", "kind_rank", "slice")
    return [f.name for f in readings.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in identity]


def attach_latest(readings: DataFrame, log: DataFrame, sliced: bool = False) -> DataFrame:
    """Add the current rule of the machine type; readings without one are dropped, as nothing is checked.

    `sliced` says that readings come from `alerts.by_device` with a plan.
    """
    book = rule_book(latest_rules(log))
    typed = held(readings, sliced).withColumn("machine_type", machine_type(F.col("device_id")))
    return typed.join(bounded_broadcast(book.select("machine_type", "rule")), "machine_type")


@dataclass(frozen=True)
class RuleIndex:
    """The rules of a log by time cells, so that a reading meets the few rules of its cell and not the log.

    `grids` hold, level by level, a grid of equal cells: the first one row per machine type (`_base`, `_width`, `_last`, the
    start of its last rule), each further one row per crowded cell of the level before (`_start`). `spans` has one row
    per cell (`_start`) and rule in force in it, from `_from` until before `_until` (null: still).
    """

    grids: list[DataFrame]
    spans: DataFrame
    held: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Drop the cached index; for streams, which make one per micro-batch."""
        for frame in self.held:
            frame.unpersist()

    def attach(self, readings: DataFrame) -> DataFrame:
        """Readings with the rule in force at their time; earlier ones go. Nothing is shuffled."""
        first, *finer = self.grids
        out = _in_cell(readings.join(F.broadcast(first), "machine_type"))
        for grid in finer:
            out = _in_cell(out.join(F.broadcast(grid), ["machine_type", "_start"], "left"))
        in_force = (F.col("timestamp") >= F.col("_from")) & (
            F.col("_until").isNull() | (F.col("timestamp") < F.col("_until")))
        met = out.join(F.broadcast(self.spans), ["machine_type", "_start"]).filter(in_force)
        return met.drop("_start", "_last", "_from", "_until")


def _in_cell(rows: DataFrame) -> DataFrame:
    """The start of each row's cell; where no finer grid was joined it stays. Times after the last rule count as its time."""
    time = F.least("timestamp", "_last")
    start = F.col("_base") + F.floor((time - F.col("_base")) / F.col("_width")) * F.col("_width")
    known = F.coalesce(start, F.col("_start")) if "_start" in rows.columns else start
    return rows.withColumn("_start", known).drop("_base", "_width")


def _over_cells(spans: DataFrame) -> DataFrame:
    """One row per rule and cell of its grid that it holds in; a rule without an end holds in the cell of its start."""
    def cell(time: Column) -> Column:
        return F.floor((time - F.col("_base")) / F.col("_width"))

    end = F.coalesce(F.col("_until") - 1, F.col("_from"))
    cells = F.sequence(cell(F.greatest("_from", "_base")), cell(F.least(end, F.col("_end"))))
    return spans.withColumn("_cell", F.explode(cells)).withColumn(
        "_start", F.col("_base") + F.col("_cell") * F.col("_width")).drop("_cell")


def rule_index(log: DataFrame, crowd: int = CROWD) -> RuleIndex:
    """Index a log that is small enough to be copied: about two rows per rule.

    Every machine type gets as many equal cells as it has rules. Cells with more than `crowd` rules are cut again, into
    twice as many cells as they have rules, until none is left or cells are one millisecond wide; of records with
    the same time the last one counts, so such a cell holds one rule.
    """
    book = rule_book(log).filter(F.col("machine_type").isNotNull() & F.col("log_time").isNotNull())
    book = book.groupBy("machine_type", F.col("log_time").alias("_from")).agg(F.max_by("rule", "offset").alias("rule"))
    spans = book.withColumn("_until", F.lead("_from").over(Window.partitionBy("machine_type").orderBy("_from")))
    grid = book.groupBy("machine_type").agg(
        F.min("_from").alias("_base"), F.max("_from").alias("_last"), F.count(F.lit(1)).alias("_n"))
    width = F.ceil((F.col("_last") - F.col("_base") + 1) / F.col("_n"))
    grid = grid.withColumn("_width", width).drop("_n")
    grids, left = [grid], spans.join(F.broadcast(grid.withColumn("_end", F.col("_last"))), "machine_type")
    keys, settled, kept = ["machine_type", "_start"], [], []
    while True:
        left = _over_cells(left).persist()
        kept.append(left)
        crowded = left.groupBy(*keys, "_width").agg(F.count(F.lit(1)).alias("_n")).filter(
            (F.col("_n") > crowd) & (F.col("_width") > 1)).collect()
        if not crowded:
            settled.append(left)
            break
        # as rows of their own, at most one in `crowd` of the rules: the plan stays flat however many levels there are
        finer = log.sparkSession.createDataFrame(
            [(c.machine_type, c["_start"], c["_start"], c["_start"] + c["_width"] - 1, -(-c["_width"] // (2 * c["_n"])))
             for c in crowded], "machine_type string, _start long, _base long, _end long, _width long")
        settled.append(left.join(F.broadcast(finer.select(*keys)), keys, "left_anti"))
        grids.append(finer.drop("_end"))
        left = left.select(*keys, "_from", "_until", "rule").join(F.broadcast(finer), keys)
    columns = ("machine_type", "_start", "_from", "_until", "rule")
    return RuleIndex(grids, reduce(DataFrame.unionByName, [part.select(*columns) for part in settled]),
                     tuple(kept))


def attach_as_of(readings: DataFrame, log: DataFrame, max_rows: int = LINE_ROWS,
                 small_log: bool | None = None) -> DataFrame:
    """Add the rule in force at the time of the reading, by log time.

    A log that is counted small is indexed by time cells and copied to the readings, which then do not move at all and
    meet a few rules each, however long the log is. Otherwise readings and
    rules share one time line per machine type and the last rule is carried forward, so no reading meets more than
    one rule; machine types are few and large, so they are sliced like hot devices.
    """
    if small_log is None:
        small_log = log.count() <= BROADCAST_ROWS
    if small_log:
        return rule_index(log).attach(held(readings).withColumn("machine_type", machine_type(F.col("device_id"))))
    typed = held(readings).withColumns({"machine_type": machine_type(F.col("device_id")), "_rank": F.lit(1)})
    updates = rule_book(log).select(
        "machine_type", "rule", F.col("log_time").alias("timestamp"), F.col("offset").alias("seq"),
        F.lit(0).alias("_rank"))
    merged = typed.unionByName(updates, allowMissingColumns=True)
    plan = plan_slices(merged.select("machine_type", "timestamp"), max_rows, key="machine_type")
    carried = carry_forward(merged, "rule", "machine_type", ["timestamp", "_rank", "seq"], plan)
    return (
        carried.filter((F.col("_rank") == 1) & F.col("carried").isNotNull())
        .drop("rule", "_rank").withColumnRenamed("carried", "rule")
    )


def checked_values(ruled: DataFrame) -> DataFrame:
    """One row per reading and limited measurement it carries; missing and NaN values are skipped."""
    columns = measurement_columns(ruled)
    keep = ["slice"] if "slice" in ruled.columns else []
    limit = F.col("limit")
    # the reading's values by name once, then one look-up per limit
    pairs = [x for m in columns for x in (F.lit(field_name(m)), F.col(m).cast("double"))]
    if len({field_name(m) for m in columns}) < len(columns):  # families disagree about a field's type
        names = dict.fromkeys(field_name(m) for m in columns)
        pairs = [x for name in names for x in (F.lit(name), F.coalesce(
            *[F.col(m).cast("double") for m in columns if field_name(m) == name]))]
    values = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
    return (
        ruled.withColumn("_values", values).withColumn("limit", F.explode("rule.limits"))
        .select("device_id", "timestamp", "seq", *keep, limit["measurement"].alias("measurement"),
                F.col("_values")[limit["measurement"]].alias("value"), limit["upper"].alias("upper"),
                limit["lower"].alias("lower"), F.col("rule.rule_profile").alias("rule_profile"),
                F.col("rule.version").alias("rule_version"))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )
