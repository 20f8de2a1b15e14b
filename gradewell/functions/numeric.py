"""Number helpers that give the same value whatever order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r(value: Column, digits: int) -> Column:
    """Round a double by scaling, as ``round(x * 10^n) / 10^n``."""
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division of doubles that yields NULL for a zero or missing denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return r(ratio(F.lit(100.0) * part, whole), digits)


def tenths(grade: Column) -> Column:
    """A grade as whole tenths, so that sums of grades are exact integers.

    Grades have one decimal; the floor of the shifted product is their nearest
    tenth and far cheaper per row than a decimal rounding.
    """
    return F.floor(grade.cast("double") * 10 + 0.5)


def mean_grade(sum_of_tenths: Column, weight: Column) -> Column:
    """Weighted mean grade from ``sum(tenths * weight)`` and ``sum(weight)``."""
    return ratio(sum_of_tenths, weight * 10)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
