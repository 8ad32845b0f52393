"""Column expressions whose meaning differs between engines, fixed here once."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_column(as_of: date | None) -> Column:
    """The reference day of a report: a literal when given, otherwise today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month boundaries crossed (31 January to 1 February is 1)."""
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("int")


def month_bucket(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def flag(predicate: Column) -> Column:
    """1 where the predicate holds, 0 where it is false or NULL."""
    return F.when(predicate, 1).otherwise(0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL for a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero, by floor(|value| * 10**digits + 1/2).

    The same few double operations give the same last digit in every engine.
    """
    scale = F.lit(10.0**digits)
    size = F.floor(F.abs(value) * scale + 0.5).cast("double") / scale
    rounded = F.when(value < 0, -size).otherwise(size)
    return F.when(F.abs(value) * scale < 2.0**52, rounded).otherwise(value)


def percent(flag_column: Column) -> Column:
    """Share of ones in percent, two decimals."""
    return F.round(F.avg(flag_column) * 100, 2)


def text_token(value: Column) -> Column:
    """String form of a value; NULL becomes the token ``nan``."""
    return F.coalesce(value.cast("string"), F.lit("nan"))
