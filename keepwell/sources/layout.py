"""Stored layouts of tables: buckets of a join key, and folders per month.

Both are written once below the shared scratch folder and read by many queries: the first saves the shuffles of
joins and groupings on the key, the second reads only the months that a window touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.functions.columns import as_of_column
from keepwell.operators.joins import hot_keys
from keepwell.scratch import scratch_path

#: Name of the partition column of :func:`write_by_month`, year * 100 + month.
MONTH = "stored_month"


def write_buckets(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Write a table in sorted buckets of ``key``; joins and groupings on it then need no shuffle.

    All tables that are joined must have the same number of buckets. Rows are shuffled once on the key, so that each
    bucket is one file; choose the number for buckets that fit into a task. The table keeps its columns and rows,
    NULL keys included; it lives in the session's catalog and its files in the shared scratch folder.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", scratch_path(spark, "buckets")).saveAsTable(name)
    return spark.table(name)


@dataclass(frozen=True)
class KeyedStore:
    """Tables in buckets of one key, with the heavy keys that were found when they were written."""

    key: str
    tables: Mapping[str, DataFrame]
    heavy: Mapping[str, Mapping]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def store_by_key(tables: Mapping[str, DataFrame], key: str, buckets: int, min_rows: int | None = None) -> KeyedStore:
    """Write tables that are joined on ``key`` in equal buckets and count their heavy keys in the same turn.

    Queries over the store take the heavy keys from it instead of counting them while their plans are built.
    ``min_rows``: rows of a key from which on it is salted in joins (default: that of the joins).
    """
    stored = {name: write_buckets(table, key, buckets) for name, table in tables.items()}
    options = {} if min_rows is None else {"min_rows": min_rows}
    heavy = hot_keys(list(stored.values()), key, **options)
    return KeyedStore(key, stored, dict(zip(stored, heavy)))


def _month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def write_by_month(df: DataFrame, day: str, files_per_month: int | None = None) -> str:
    """Write a table in a folder per month of the date or timestamp ``day`` and return its path.

    ``files_per_month``: how many tasks share the rows of one month. By default that follows from their size: a
    month beyond ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is split over several tasks, so none grows
    with the input. Rows without a date are kept in a folder of their own, which no window reads.
    """
    path = scratch_path(df.sparkSession, "months")
    monthly = df.withColumn(MONTH, _month(F.col(day)))
    if files_per_month is None:
        dealt = monthly.hint("rebalance", F.col(MONTH))
    else:
        # A hash of the row, so that a task that runs again deals its rows alike.
        dealt = monthly.repartition(MONTH, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_month)))
    dealt.write.partitionBy(MONTH).parquet(path)
    return path


def read_window(
    spark: SparkSession, path: str, like: DataFrame, day: str, as_of: date | None = None, window_days: int = 90
) -> DataFrame:
    """Rows of the last ``window_days`` days before ``as_of``, and later ones, from the folders of their months only.

    ``like`` gives the columns. The same rows as a filter ``day >= as_of - window_days`` on the whole table.
    """
    start = F.date_sub(as_of_column(as_of), window_days)
    schema = T.StructType([*like.schema.fields, T.StructField(MONTH, T.IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    return stored.filter((F.col(MONTH) >= _month(start)) & (F.col(day) >= start)).drop(MONTH)
