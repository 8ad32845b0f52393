"""Duplicate removal, missing-value profile and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.functions.columns import ratio
from keepwell.operators.ordering import EXACT_ROWS, exact_quantiles
from keepwell.operators.profile import is_missing, write_profiled
from keepwell.sources.tables import numeric_columns, string_columns


MAX_CLASSES = 1000


def drop_duplicate_keys(
    df: DataFrame, key: str = "customer_id", order_by: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row of every key in the order of ``order_by``, then of the other columns.

    Rows with a NULL key count as one group. The ``== 1`` filter lets Spark keep one row per key and
    task before the shuffle, so a key with very many rows stays cheap.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    order = Window.partitionBy(key).orderBy(*order_by, *rest)
    return (
        df.withColumn("_position", F.row_number().over(order))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def duplicate_report(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row: records, distinct keys (NULL is one key) and records that removal would drop."""
    distinct = F.countDistinct(key) + F.max(F.col(key).isNull().cast("int"))
    return df.agg(F.count("*").alias("n_records"), distinct.alias("n_distinct")).withColumn(
        "n_removed", F.col("n_records") - F.col("n_distinct")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, only columns that have any. One pass over the table."""
    wide = df.agg(*[F.count(F.when(is_missing(df, c), 1)).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "n_missing").filter(F.col("n_missing") > 0)


def medians(
    df: DataFrame, columns: Sequence[str], accuracy: int | None = None, exact_rows: int = EXACT_ROWS
) -> DataFrame:
    """Median per numeric column: exact, or with ``accuracy`` from one pass of quantile sketches."""
    if accuracy is None:
        found = exact_quantiles(df, {c: F.col(c) for c in columns}, exact_rows=exact_rows)
    else:
        missing = F.lit(None).cast("double")
        values = [F.nanvl(F.col(c).cast("double"), missing) for c in columns]
        row = df.agg(*[F.percentile_approx(v, 0.5, accuracy) for v in values]).first()
        found = dict(zip(columns, row))
    return df.sparkSession.createDataFrame(list(found.items()), "column string, median double")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per string column; among equals the smallest. No row if all are NULL."""
    counts = (
        df.select(*columns)
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg((-F.count("*")).alias("rank"))
    )
    return counts.groupBy("column").agg(F.min(F.struct("rank", "value"))["value"].alias("mode"))


def clean(
    df: DataFrame,
    key: str = "customer_id",
    label: str = "churn",
    order_by: Sequence[str] = (),
    include_all: bool = False,
) -> DataFrame:
    """Remove duplicate keys, then fill numeric columns with the median and strings with the mode.

    A filled numeric column becomes double. Key and label are left alone unless ``include_all``.
    Columns without any value stay as they are. What is missing is counted once for all columns;
    only those that need a fill are read again.
    """
    unique, profile = write_profiled(drop_duplicate_keys(df, key, order_by), "unique")
    kept = set() if include_all else {key, label}
    missing = {c for c, n in profile.missing.items() if n and profile.present(c)} - kept
    numeric = [c for c in numeric_columns(unique) if c in missing]
    text = [c for c in string_columns(unique) if c in missing]
    fills: dict[str, Column] = {}
    if numeric:
        sizes = {c: profile.present(c) for c in numeric}
        for column, value in exact_quantiles(unique, {c: F.col(c) for c in numeric}, sizes=sizes).items():
            known = F.when(~is_missing(unique, column), F.col(column)).cast("double")
            fills[column] = F.coalesce(known, F.lit(value))
    if text:
        for row in modes(unique, text).collect():
            fills[row["column"]] = F.coalesce(row["column"], F.lit(row["mode"]))
    return unique.withColumns(fills) if fills else unique


def class_values(df: DataFrame, label: str) -> list:
    """Values of a label, NULL left out; an error beyond ``MAX_CLASSES``, for then it is no class label."""
    found = df.select(label).filter(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"column {label!r} has more than {MAX_CLASSES} values")
    return sorted(row[0] for row in found)


def class_distribution(df: DataFrame, label: str = "churn") -> DataFrame:
    """Rows per class, largest class first."""
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def imbalance_ratio(df: DataFrame, label: str = "churn") -> DataFrame:
    """One row: size of the smallest class divided by that of the largest."""
    known = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return known.agg(ratio(F.min("n"), F.max("n")).alias("imbalance_ratio"))


def label_profile(df: DataFrame, by: str, label: str = "churn") -> DataFrame:
    """Rows, positives and rate per group, for example per split."""
    return df.groupBy(by).agg(
        F.count("*").alias("n_records"),
        F.sum(label).alias("n_positive"),
        F.avg(label).alias("positive_rate"),
    )


def median_by_class(df: DataFrame, measure: str = "tenure_months", label: str = "churn") -> DataFrame:
    """Exact median of a measure in every class of the label."""
    known = df.filter(F.col(label).isNotNull())
    classes = class_values(known, label)
    found = exact_quantiles(
        known, {c: F.when(F.col(label) == F.lit(c), F.col(measure)) for c in classes}
    )
    kind = df.schema[label].dataType.simpleString()
    schema = f"{label} {kind}, median_{measure} double"
    return df.sparkSession.createDataFrame(list(found.items()), schema)
