"""Number handling: rounding, decimals, averages and percentages.

All are Column expressions, so they stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_away(value: Column, places: int) -> Column:
    """Round a double by scaling it, rounding halves away from zero and scaling back.

    ``F.round`` works on the decimal text of the double instead and gives 1.01
    for 1.005, whose binary value is below the half.
    """
    scale = float(10**places)
    return F.round(value.cast("double") * scale, 0) / scale


def to_decimal(value: Column, precision: int, scale: int) -> Column:
    return round_half_away(value, scale).cast(f"decimal({precision},{scale})")


def avg_decimal(value: Column, scale: int) -> Column:
    """Average of a decimal column as a double, taken from its exact sum."""
    unit = 10**scale
    return (F.sum(value) * unit).cast("double") / nullif_zero(F.count(value) * unit)


def nullif_zero(value: Column) -> Column:
    return F.nullif(value, F.lit(0).cast("bigint"))


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL where ``whole`` is zero."""
    ratio = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return round_half_away(ratio * 100.0, places)
