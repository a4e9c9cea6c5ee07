"""Limit breaches: strict comparisons against the limits of the machine type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def limit_breaches(checked: DataFrame) -> DataFrame:
    """One row per breached limit; one value may breach both."""
    sides = """inline(array(
        CASE WHEN value > upper THEN named_struct('limit_type', 'upper', 'limit_value', upper) END,
        CASE WHEN value < lower THEN named_struct('limit_type', 'lower', 'limit_value', lower) END))"""
    return checked.filter("value > upper OR value < lower").select(
        "device_id", "timestamp", "seq", "measurement", "value", F.expr(sides), "rule_profile", "rule_version"
    ).filter("limit_type IS NOT NULL")
