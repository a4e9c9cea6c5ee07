"""Number handling that must agree with IEEE-exact decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_one_decimal(x: Column) -> Column:
    """Round a double to one decimal by its exact binary value, ties to even.

    `bround` works on the shortest decimal text, so 40.15 (stored slightly below the tie) would
    go up. Only values whose text sits on a tie can differ; those few take the slower exact
    path through `format_number`.
    """
    hundredths = F.bround(F.abs(x) * 100)
    on_tie = (F.bround(x, 2) == x) & (F.pmod(hundredths, F.lit(10.0)) == 5)
    exact = F.replace(F.format_number(x, 1), F.lit(","), F.lit("")).cast("double")
    return F.when(on_tie, exact).otherwise(F.bround(x, 1))


def decimal_text(x: Column) -> Column:
    """A double with one decimal as text, without an exponent for large values."""
    return F.when(F.abs(x) >= 1e7, F.format_string("%.1f", x)).otherwise(x.cast("string"))
