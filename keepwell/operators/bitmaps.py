"""Distinct days as bitmaps: one whole number per key and month, which merges over any split of the rows.

Bit d - 1 stands for day d of the month. Counting distinct days this way needs no row per distinct value and no second
copy of the rows, and stored bitmaps serve every window.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "month"
DAYS = "days"


def _month_index(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day) - 1).cast("int")


def _first_days(n: Column) -> Column:
    """Bitmap of the first ``n`` days of a month."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1


def day_bitmaps(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """(keys, ``month`` as year * 12 + month - 1, ``days``) of the days that occur; rows without a date add nothing."""
    at = F.col(day).cast("date")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(at) - 1)
    return df.filter(at.isNotNull()).groupBy(*keys, _month_index(at).alias(MONTH)).agg(F.bit_or(bit).alias(DAYS))


def merge_bitmaps(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Bitmaps of all rows from those of any parts, which may overlap."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*keys, MONTH).agg(F.bit_or(DAYS).alias(DAYS))


def distinct_days(
    bitmaps: DataFrame, keys: Sequence[str], first: date | Column | None = None, last: date | Column | None = None
) -> DataFrame:
    """(keys, ``n_days``): distinct days from ``first`` to ``last``, both included and both optional.

    ``bitmaps`` has one row per key and month, as :func:`day_bitmaps` and :func:`merge_bitmaps` give them. Keys without
    a day in the window have no row.
    """
    days = F.col(DAYS)
    if first is not None:
        at = first if isinstance(first, Column) else F.lit(first)
        bitmaps = bitmaps.filter(F.col(MONTH) >= _month_index(at))
        early = F.when(F.col(MONTH) == _month_index(at), _first_days(F.dayofmonth(at) - 1)).otherwise(F.lit(0).cast("long"))
        days = days.bitwiseAND(F.bitwise_not(early))
    if last is not None:
        at = last if isinstance(last, Column) else F.lit(last)
        bitmaps = bitmaps.filter(F.col(MONTH) <= _month_index(at))
        upto = F.when(F.col(MONTH) == _month_index(at), _first_days(F.dayofmonth(at))).otherwise(_first_days(F.lit(31)))
        days = days.bitwiseAND(upto)
    counted = bitmaps.groupBy(*keys).agg(F.sum(F.bit_count(days).cast("long")).alias("n_days"))
    return counted.filter("n_days > 0")
