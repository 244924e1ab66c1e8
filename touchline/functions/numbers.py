"""Rounding, rates and number display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    """Rows where the condition holds, 0 for an empty group (NULL does not count)."""
    return F.count(F.when(condition, F.lit(1)))


def round_to(value: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of the binary value scaled by a power of ten."""
    scale = float(10**digits)
    return F.round(value.cast("double") * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, NULL on a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percentage(part: Column, whole: Column) -> Column:
    """part / whole as a percentage, 0 when there is nothing to count."""
    return F.coalesce(ratio(part, whole) * 100.0, F.lit(0.0))


def signed(value: Column) -> Column:
    """+3, -2, +0."""
    return F.format_string("%+d", value.cast("bigint"))


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point text, ties decided on the exact binary value (as C and Python do)."""
    pattern = "0" + ("." + "0" * digits if digits else "")
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def record(won: Column, drawn: Column, lost: Column) -> Column:
    """W-D-L record, e.g. 10-3-2."""
    return F.concat(
        won.cast("string"), F.lit("-"), drawn.cast("string"), F.lit("-"), lost.cast("string")
    )


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(high, value))
