"""The alert feed: limit breaches and zone-rule violations in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.functions.encode import alert_document
from trackline.functions.fields import held
from trackline.operators.rules import attach_latest, checked_values
from trackline.operators.slices import SlicePlan, partition_columns
from trackline.operators.spc import RULES, evaluate

LIMIT_BREACH = "limit_breach"
SPC_RULE = "spc_rule"


def _findings() -> str:
    """One entry per possible finding on a checked value, null where there is none."""
    def finding(condition: str, kind: str, limit: str = "NULL", number: str = "NULL", text: str = "NULL") -> str:
        return (f"CASE WHEN {condition} THEN named_struct('alert_type', '{kind}', "
                f"'limit_type', string({repr(limit) if limit != 'NULL' else limit}), 'limit_value', double({limit}), "
                f"'rule_number', int({number}), 'rule_description', string({text})) END")

    sides = [finding("value > upper", LIMIT_BREACH, "upper"), finding("value < lower", LIMIT_BREACH, "lower")]
    zone = [finding(f"rule_{n}", SPC_RULE, number=str(n), text=f"'{text}'") for n, text in RULES.items()]
    return f"inline(array({', '.join(sides + zone)}))"


def alerts(checked: DataFrame, plan: SlicePlan | None = None, carry: DataFrame | None = None) -> DataFrame:
    """All alerts of checked values (see `rules.checked_values`), each with its JSON document."""
    found = evaluate(checked, plan, carry).select(
        "device_id", "timestamp", "seq", "measurement", "value", "rule_profile", "rule_version",
        F.expr(_findings())).filter("alert_type IS NOT NULL")
    breach = F.col("alert_type") == LIMIT_BREACH
    return found.withColumns({
        "rule_profile": F.when(breach, F.col("rule_profile")),
        "rule_version": F.when(breach, F.col("rule_version")),
    }).withColumn("document", alert_document())


def by_device(readings: DataFrame, plan: SlicePlan | None = None) -> DataFrame:
    """Shuffle narrow readings once, before each fans out to its measurements.

    The windows per (device, measurement) are satisfied by this partitioning.
    """
    readings = held(readings)
    if plan is not None:
        readings = plan.assign(readings)
    return readings.repartition(*partition_columns(plan, "device_id"))


def alerts_for(readings: DataFrame, rule_log: DataFrame, plan: SlicePlan | None = None) -> DataFrame:
    """Alerts under the current rules."""
    return alerts(checked_values(attach_latest(by_device(readings, plan), rule_log, plan is not None)), plan)
