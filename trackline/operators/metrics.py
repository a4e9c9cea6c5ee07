"""The simple monitor: one pair of global limits, log lines and line-protocol text.

Frames:
  metrics    mc_name, temp, pressure, seq, timestamp
  documents  subject, timestamp, seq, raw_text: snapshots of the control document
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions.numbers import decimal_text, round_one_decimal
from trackline.operators.slices import MAX_ROWS, carry_forward, plan_slices
from trackline.sources.contracts import CONTROL_DOCUMENT

# Limits and fingerprint before any document was seen, and the texts of log lines.
DEFAULT_TEMP_MAX = 40.0
DEFAULT_PRESSURE_MAX = 120.0
UNKNOWN = "unknown"
ALARM = "🚨 ALARM [Config v.{version}]: Machine '{name}' Breached Safe Operations! -> {breaches}{context}"
NORMAL = "📥 Telemetry Logged [Offset {offset}][Config v.{version}]: {name} is normal ({temp}°C, {pressure} PSI)."
REJECTED = "⚠️ Caught Poison Pill at Offset {offset}: {error} -> Routing to DLQ."


def fingerprint(raw_text: Column) -> Column:
    return F.sha2(raw_text, 256)


def short_fingerprint(full: Column) -> Column:
    return F.substring(full, 1, 8)


def parse_documents(documents: DataFrame) -> DataFrame:
    """Add fingerprint and limits; `valid` is false unless the whole document can be read.

    Parsed inside a generator, as in `decode`, so that filters do not repeat the parse. A text that closes no object holds
    no rules; it is not parsed, as a failing parse costs several times a good one.
    """
    rules = F.col("_doc.rules")
    closed = F.when(F.contains(F.col("raw_text"), F.lit("}")), F.col("raw_text"))
    return (
        documents.withColumn("_doc", F.explode(F.array(F.from_json(closed, CONTROL_DOCUMENT))))
        .withColumns({
            "fingerprint": fingerprint(F.col("raw_text")),
            "temp_max": rules["max_safe_temp"],
            "pressure_max": rules["max_safe_pressure"],
        })
        .withColumn("valid", F.col("temp_max").isNotNull() & F.col("pressure_max").isNotNull())
        .drop("_doc")
    )


def control_changes(documents: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Snapshots that changed the limits of their subject: valid, and unlike the valid one before."""
    valid = parse_documents(documents).filter("valid").drop("raw_text", "valid")
    plan = plan_slices(documents.select("subject", "timestamp"), max_rows, key="subject")
    compared = carry_forward(valid, "fingerprint", "subject", ["timestamp", "seq"], plan)
    return (
        compared.filter(F.col("carried").isNull() | (F.col("carried") != F.col("fingerprint")))
        .withColumnRenamed("carried", "previous_fingerprint")
    )


def current_limits(documents: DataFrame) -> DataFrame:
    """One row with the limits of the latest valid document, or the defaults."""
    latest = parse_documents(documents).filter("valid").agg(
        F.max_by(F.struct("fingerprint", "temp_max", "pressure_max"), F.struct("timestamp", "seq")).alias("d"))
    return latest.select(
        F.coalesce("d.fingerprint", F.lit(UNKNOWN)).alias("fingerprint"),
        F.coalesce("d.temp_max", F.lit(DEFAULT_TEMP_MAX)).alias("temp_max"),
        F.coalesce("d.pressure_max", F.lit(DEFAULT_PRESSURE_MAX)).alias("pressure_max"),
    )


def check_metrics(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Round, default and compare each metric; the limits come in as a scalar subquery."""
    current = limits.select(F.struct("fingerprint", "temp_max", "pressure_max")).scalar()
    # Rounded inside a generator, so that filters on the outcome do not round again.
    rounded = F.inline(F.array(F.struct(
        F.coalesce("mc_name", F.lit("Unknown-Machine")).alias("mc_name"),
        round_one_decimal(F.coalesce("temp", F.lit(0.0))).alias("temp"),
        round_one_decimal(F.coalesce("pressure", F.lit(0.0))).alias("pressure"))))
    others = [c for c in metrics.columns if c not in ("mc_name", "temp", "pressure")]
    return (
        metrics.select(rounded, *others)
        .withColumn("_limits", current)
        .withColumns({
            "temp_max": F.col("_limits.temp_max"),
            "pressure_max": F.col("_limits.pressure_max"),
            "config_version": short_fingerprint(F.col("_limits.fingerprint")),
        })
        .withColumns({
            "temp_breached": (F.col("temp") > F.col("temp_max")) & ~F.isnan("temp"),
            "pressure_breached": (F.col("pressure") > F.col("pressure_max")) & ~F.isnan("pressure"),
        })
        .drop("_limits")
    )


def _fill(template: str, **parts: Column) -> Column:
    """Put columns into the {name} places of a text."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        text, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        pieces += [F.lit(text), parts[name]]
    return F.concat(*pieces, F.lit(rest))


def log_line() -> Column:
    """The log text of a checked metric, without the clock prefix."""
    temp, pressure = decimal_text(F.col("temp")), decimal_text(F.col("pressure"))
    hot, high = F.col("temp_breached"), F.col("pressure_breached")
    breaches = F.concat_ws(
        " | ",
        F.when(hot, _fill("Temperature: {v}°C (Limit: {m}°C)", v=temp, m=decimal_text(F.col("temp_max")))),
        F.when(high, _fill("Pressure: {v} PSI (Limit: {m} PSI)", v=pressure, m=decimal_text(F.col("pressure_max")))),
    )
    context = (
        F.when(hot & high, "")
        .when(hot, _fill(" | [Pressure: {v} PSI]", v=pressure))
        .otherwise(_fill(" | [Temperature: {v}°C]", v=temp))
    )
    version = F.col("config_version")
    return F.when(hot | high, _fill(ALARM, version=version, name=F.col("mc_name"), breaches=breaches, context=context)
                  ).otherwise(_fill(NORMAL, offset=F.col("seq").cast("string"), version=version,
                                    name=F.col("mc_name"), temp=temp, pressure=pressure))


def metric_log(checked: DataFrame, clock: Column | None = None) -> DataFrame:
    """One log line per metric; `clock` puts the time of day in front, as the live monitor does."""
    line = log_line()
    if clock is not None:
        line = F.concat(F.lit("["), F.date_format(clock, "HH:mm:ss"), F.lit("] "), line)
    return checked.withColumn("line", line)


def rejected_log(decoded: DataFrame, clock: Column | None = None) -> DataFrame:
    """(timestamp, seq, line): one log line per message that became a dead letter."""
    line = _fill(REJECTED, offset=F.col("offset").cast("string"), error=F.col("error"))
    if clock is not None:
        line = F.concat(F.lit("["), F.date_format(clock, "HH:mm:ss"), F.lit("] "), line)
    return decoded.filter(F.col("error").isNotNull()).select(
        F.unix_millis("timestamp").alias("timestamp"), F.col("offset").alias("seq"), line.alias("line"))


def latest_lines(checked: DataFrame, count: int = 30, rejected: DataFrame | None = None) -> DataFrame:
    """The newest log lines, newest first: a top-k, each task passes on at most `count` rows.

    Texts of checked metrics are made for these rows only. `rejected` is the log of dead letters.
    """
    newest = metric_log(checked.orderBy(F.desc("timestamp"), F.desc("seq")).limit(count))
    if rejected is not None:
        newest = newest.select("timestamp", "seq", "line").unionByName(rejected)
    return newest.orderBy(F.desc("timestamp"), F.desc("seq")).limit(count)


def line_protocol(checked: DataFrame) -> DataFrame:
    """One text line per metric for a time-series store."""
    return checked.select("seq", _fill(
        "telemetry,machine_id={name} temp={temp},pressure={pressure}", name=F.col("mc_name"),
        temp=decimal_text(F.col("temp")), pressure=decimal_text(F.col("pressure"))).alias("value"))
