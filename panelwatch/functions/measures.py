"""Rates, growth and shares on integer counts, rounded half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int) -> Column:
    """Round a double on its binary value.

    Spark's `round` goes through the decimal text of the double and so differs in the
    last digit for ratios such as 23/320 at five digits; this form also stays in
    primitive arithmetic.
    """
    scale = float(10**digits)
    # From 2**52 on a double has no fraction left, and `floor` would not fit its integer type.
    scaled = F.abs(x) * scale
    return F.when(scaled < float(1 << 52), F.signum(x) * F.floor(scaled + 0.5) / scale).otherwise(x.cast("double"))


def rate(part: Column, whole: Column) -> Column:
    """`part / whole`, NULL without a denominator."""
    ratio = part.cast("double") / F.nullif(whole, F.lit(0).cast("long")).cast("double")
    return round_half_away(ratio, 5)


def percent(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole`, NULL if that is zero."""
    hundredfold = F.lit(100.0) * part.cast("double")
    return round_half_away(
        hundredfold / F.nullif(whole, F.lit(0).cast("long")).cast("double"), 1
    )


def growth_percent(now: Column, before: Column) -> Column:
    """Relative change in percent; NULL in the first period and after a zero."""
    return percent(now - before, before)


def direction(growth: Column) -> Column:
    return F.when(growth >= 0, F.lit("up")).otherwise(F.lit("down"))
