"""Equi-joins that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.scratch import materialise

HOT_KEY_ROWS = 1_000_000
SKETCH_KEYS = 5_000
SKETCH_SLOTS = 50_000


def hot_keys(tables: Sequence[DataFrame], key: str, min_rows: int = HOT_KEY_ROWS) -> list[dict]:
    """Per table, the keys that occur more than about ``min_rows`` times, with their counts.

    One job with a frequent-items sketch of fixed size per table: the key columns are scanned, only
    sketches are shuffled and at most SKETCH_KEYS keys per table come back. Counts are too high by at
    most about 1 / SKETCH_SLOTS of a table's rows, so a key above that share is always found. A key that a
    sketch misses is still joined correctly, only unsalted.
    """
    keys = None
    for place, table in enumerate(tables):
        part = table.filter(F.col(key).isNotNull()).select(F.lit(place).alias("place"), key)
        keys = part if keys is None else keys.unionByName(part)
    sketch = F.expr(f"approx_top_k(`{key}`, {SKETCH_KEYS}, {SKETCH_SLOTS})")
    sketches = keys.groupBy("place").agg(sketch.alias("top"))
    heavy: list[dict] = [{} for _ in tables]
    for row in sketches.collect():
        heavy[row["place"]] = {k["item"]: k["count"] for k in row["top"] if k["count"] > min_rows}
    return heavy


def left_joins(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str,
    min_rows: int = HOT_KEY_ROWS,
    heavy_keys: Sequence[Mapping] | None = None,
) -> DataFrame:
    """A chain of left outer joins on ``key``, each by way of :func:`left_join`.

    ``heavy_keys``: the heavy keys of each right table, where they are known; else they are looked for.
    """
    found = hot_keys(rights, key, min_rows) if heavy_keys is None else heavy_keys
    for right, heavy in zip(rights, found):
        left = left_join(left, right, key, heavy, min_rows)
    return left


def left_join(
    left: DataFrame, right: DataFrame, key: str, heavy: Mapping, rows_per_salt: int = HOT_KEY_ROWS
) -> DataFrame:
    """Left outer join on ``key``, keeping every match of every row.

    Adaptive execution can split a heavy key on the left side of a left join, but not on the right.
    Rows of the ``heavy`` keys, which must occur on the right, are therefore joined on (key, salt):
    the right rows are dealt over the salts and each left row is repeated once per salt. A key has one
    salt for every ``rows_per_salt`` of its rows, whose number ``heavy`` holds. For these keys
    the left join and the inner join are the same. The salted rows are written before the join, so
    that a task that is run again cannot deal them differently.
    """
    if not heavy:
        return left.join(right, key, "left")
    is_heavy = F.coalesce(F.col(key).isin(list(heavy)), F.lit(False))
    light = left.filter(~is_heavy).join(right.filter(~is_heavy), key, "left")
    table = left.sparkSession.createDataFrame(
        [(k, -(-n // rows_per_salt)) for k, n in heavy.items()],
        T.StructType([T.StructField(key, right.schema[key].dataType), T.StructField("_salts", T.LongType())]),
    )
    table = F.broadcast(table)  # one row per heavy key, of which a sketch gives at most SKETCH_KEYS
    salt = F.pmod(F.monotonically_increasing_id(), F.col("_salts"))
    salted = right.filter(is_heavy).join(table, key).withColumn("_salt", salt).drop("_salts")
    dealt = materialise(salted, "salted")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))
    repeated = left.filter(is_heavy).join(table, key).withColumn("_salt", salts).drop("_salts")
    return light.unionByName(repeated.join(dealt, [key, "_salt"]).drop("_salt"))
