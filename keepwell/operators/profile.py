"""Counts and moments of all columns from one aggregate of a written table, and the value counts of its strings."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.scratch import materialise

Moments = tuple[float | None, float | None]


def is_missing(df: DataFrame, column: str) -> Column:
    """NULL, and NaN in floating columns."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.col(column).isNull() | F.isnan(column)
    return F.col(column).isNull()


@dataclass(frozen=True)
class Profile:
    """Rows, missing values per column, and (mean, population deviation) per numeric column."""

    rows: int
    missing: dict[str, int]
    moments: dict[str, Moments]

    def present(self, column: str) -> int:
        return self.rows - self.missing[column]


def write_profiled(df: DataFrame, label: str) -> tuple[DataFrame, Profile]:
    """Write ``df`` as :func:`materialise` does and take its profile from one aggregate over the files.

    One row of a few numbers per column reaches the driver. An empty table has no rows, nothing missing, and NULL
    moments. The rows are not observed while they are written: a session that has observed something cannot be
    serialised, and fitted classifiers hold their session.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    wanted = [F.count(F.lit(1)).alias("rows")]
    wanted += [F.count(F.when(is_missing(df, c), 1)).alias(f"missing{i}") for i, c in enumerate(df.columns)]
    for i, c in enumerate(numeric):
        wanted += [F.avg(c).cast("double").alias(f"mean{i}"), F.stddev_pop(c).alias(f"sd{i}")]
    table = materialise(df, label)
    row = table.agg(*wanted).first()
    return table, Profile(
        row["rows"],
        {c: row[f"missing{i}"] for i, c in enumerate(df.columns)},
        {c: (row[f"mean{i}"], row[f"sd{i}"]) for i, c in enumerate(numeric)},
    )


def value_counts(tokens: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all the string columns, from one shuffle with partial counts; NULL is a value."""
    melted = tokens.select(*columns).unpivot([], list(columns), "column", "value")
    return melted.groupBy("column", "value").agg(F.count("*").alias("n"))


def first_values(counts: DataFrame, most: int) -> dict[str, list[tuple[str, int]]]:
    """The first ``most`` values of each column in their order, with their counts."""
    order = Window.partitionBy("column").orderBy("value")
    first = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    found: dict[str, list[tuple[str, int]]] = {}
    for row in sorted(first.collect(), key=lambda r: r["place"]):
        found.setdefault(row["column"], []).append((row["value"], row["n"]))
    return found


def code_moments(counts: Sequence[int]) -> Moments:
    """Mean and population deviation of the codes 0, 1, ... from how often each occurs."""
    rows = sum(counts)
    if not rows:
        return None, None
    mean = sum(code * n for code, n in enumerate(counts)) / rows
    return mean, math.sqrt(math.fsum(n * (code - mean) ** 2 for code, n in enumerate(counts)) / rows)


def weighted_moments(coded: DataFrame) -> Mapping[str, Moments]:
    """The same per column of a table (column, code, n), where a column has too many codes for the driver."""
    code, n = F.col("code").cast("double"), F.col("n")
    means = coded.groupBy("column").agg((F.sum(code * n) / F.sum("n")).alias("mean"))
    spread = coded.join(means, "column").groupBy("column").agg(
        F.max("mean").alias("mean"), F.sqrt(F.sum(n * F.pow(code - F.col("mean"), 2)) / F.sum("n")).alias("sd")
    )
    return {r["column"]: (r["mean"], r["sd"]) for r in spread.collect()}
