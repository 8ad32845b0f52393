"""Class weights and synthetic minority oversampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.operators.cleaning import class_values
from keepwell.operators.neighbours import BOX_ROWS, GROUP, nearest_neighbours, projected_neighbours
from keepwell.operators.ordering import HASH_PRIME, class_cuts, cuts_passed, key_hash
from keepwell.scratch import materialise

BALANCED_ABOVE = 0.5
COPIES_PER_BLOCK = 10_000


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class, one small row each; rows without a label count nowhere."""
    class_values(df, label)
    known = df.filter(F.col(label).isNotNull())
    return {row[label]: row["count"] for row in known.groupBy(label).count().collect()}


def class_weights(df: DataFrame, label: str = "churn") -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg((F.sum("n") / F.count("*")).alias("share"))
    return counts.withColumn("weight", totals.scalar() / F.col("n"))


def weight_column(counts: dict, label: str) -> Column:
    """Balanced weight of a row as a plain expression over its label."""
    total = sum(counts.values())
    weight = None
    for value, n in counts.items():
        matches, share = F.col(label) == F.lit(value), F.lit(total / (len(counts) * n))
        weight = F.when(matches, share) if weight is None else weight.when(matches, share)
    return weight


def needs_rebalancing(counts: dict, balanced_above: float = BALANCED_ABOVE) -> bool:
    """True when the smallest class is below the given share of the largest; not without any class."""
    return bool(counts) and min(counts.values()) / max(counts.values()) < balanced_above


def smote(
    df: DataFrame,
    features: Sequence[str],
    label: str = "churn",
    key: str = "customer_id",
    k: int = 5,
    seed: int = 42,
    box_rows: int = BOX_ROWS,
    search: str = "exact",
) -> DataFrame:
    """Raise every class to the size of the largest with points between rows and their neighbours.

    The result has (key, label, features as double, copy_no): originals carry copy_no 0, synthetic
    rows the key of their source row and 1, 2, ... Quotas are dealt evenly in key-hash order, and
    neighbour and position on the segment come from key, copy number and seed, so the outcome does
    not depend on partitioning. ``key`` must be unique. Fewer than k neighbours: all of them are
    used. Rows without a label belong to no class and are left out. ``search`` is "exact" or "projected":
    random projections, which may miss a neighbour and whose work per row does not grow with the input.
    """
    if search not in ("exact", "projected"):
        raise ValueError(f"unknown search: {search}")
    df = df.filter(F.col(label).isNotNull())
    counts = class_counts(df, label)
    target = max(counts.values(), default=0)
    doubles = [F.col(c).cast("double").alias(c) for c in features]
    result = df.select(key, label, *doubles, F.lit(0).cast("long").alias("copy_no"))
    short = [(F.lit(True), value, n, target - n) for value, n in counts.items() if n < target]
    if short:
        made = _synthetic(df, short, features, label, key, k, seed, box_rows, search)
        result = result.unionByName(made.drop(GROUP))
    return result


def smote_parts(
    df: DataFrame,
    features: Sequence[str],
    parts: Mapping[int, tuple[Column, Mapping]],
    label: str = "churn",
    key: str = "customer_id",
    k: int = 5,
    seed: int = 42,
    box_rows: int = BOX_ROWS,
) -> DataFrame | None:
    """The synthetic rows that :func:`smote` adds to each of several parts of a table, which may overlap, made together.

    ``parts`` has, by number, the condition of a part's rows and its class sizes. The result is as of :func:`smote`, without
    the originals and with the number of the part in ``part``; None if no class of any part is short of rows.
    """
    sizes = {number: max(counts.values(), default=0) for number, (_, counts) in parts.items()}
    short = [
        (number, (inside, value, n, sizes[number] - n))
        for number, (inside, counts) in parts.items() for value, n in counts.items() if n < sizes[number]
    ]
    if not short:
        return None
    made = _synthetic(df, [group for _, group in short], features, label, key, k, seed, box_rows)
    number = F.array(*[F.lit(number) for number, _ in short])[F.col(GROUP)]
    return made.withColumn("part", number).drop(GROUP)


def _stand_in(rows: DataFrame, key: str) -> Column:
    """Identifies the one point whose rows have no key; sorts before the keys."""
    whole = isinstance(rows.schema[key].dataType, T.IntegralType)
    return F.lit(-(2**63)) if whole else F.lit("")


def distinct_points(rows: DataFrame, key: str) -> DataFrame:
    """Each different ``vector`` of the rows, of a group if there are groups, with its smallest key and its number of rows."""
    smallest = F.coalesce(F.min(key), _stand_in(rows, key)).alias("pid")
    return rows.groupBy(*[c for c in (GROUP, "vector") if c in rows.columns]).agg(smallest, F.count("*").alias("copies"))


def _projected(points: DataFrame, groups: int, k: int, seed: int) -> DataFrame:
    found = [
        projected_neighbours(points.filter(F.col(GROUP) == g).drop(GROUP), k, seed=seed).withColumn(GROUP, F.lit(g))
        for g in range(groups)
    ]
    return reduce(DataFrame.unionByName, found)


def _synthetic(df, groups, features, label, key, k, seed, box_rows=BOX_ROWS, search="exact") -> DataFrame:
    """Synthetic rows per group (condition, class, its rows, rows needed), with the group's place in ``GROUP``.

    The groups go through the same jobs; a row may be in several.
    """
    own = [F.when(inside & F.col(label).eqNullSafe(F.lit(value)), F.lit(g)) for g, (inside, value, *_) in enumerate(groups)]
    rows = df.withColumn(GROUP, F.explode(F.array_compact(F.array(*own)))).select(
        GROUP, key, label, *[F.col(c).cast("double").alias(c) for c in features]
    )
    rows = materialise(rows.withColumn("vector", F.array(*features)), "minority")
    points = materialise(distinct_points(rows, key), "points")
    near = nearest_neighbours(points, k, box_rows) if search == "exact" else _projected(points, len(groups), k, seed)
    cuts = class_cuts(rows, GROUP, key, {g: [needed % n] for g, (_, _, n, needed) in enumerate(groups)}, seed)
    extra = (cuts_passed(rows, GROUP, key, cuts, seed) == 0).cast("long")
    least = [needed // n for _, _, n, needed in groups]
    quota = F.array(*map(F.lit, least))[F.col(GROUP)] + extra

    # Two steps keep the generated arrays short and spread a large quota over the tasks.
    last_block = F.floor((F.col("quota") - 1) / COPIES_PER_BLOCK)
    blocks = (
        rows.withColumn("quota", quota)
        .filter(F.col("quota") > 0)
        .join(near, [GROUP, "vector"])
        .select(
            GROUP, key, label, "vector", "neighbours", "quota", key_hash(rows, key, seed).alias("hash"),
            F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block"),
        )
    )
    if max(least) >= COPIES_PER_BLOCK:
        blocks = blocks.repartition(key, "block")
    start = F.col("block") * COPIES_PER_BLOCK + 1
    stop = F.least(F.col("quota"), start + (COPIES_PER_BLOCK - 1))
    copies = blocks.withColumn("copy_no", F.explode(F.sequence(start, stop)))

    choice = F.pmod(
        F.col("hash") * 31 + F.col("copy_no") * 17, F.greatest(F.size("neighbours"), F.lit(1))
    )
    neighbour = F.coalesce(F.get("neighbours", choice.cast("int")), F.col("vector"))
    position = F.pmod(F.col("hash") * 131 + F.col("copy_no") * 7919 + seed, F.lit(HASH_PRIME))
    moved = copies.withColumn("neighbour", neighbour).withColumn("at", position / HASH_PRIME)
    return moved.select(
        GROUP,
        key,
        label,
        *[
            (F.col("vector")[i] + F.col("at") * (F.col("neighbour")[i] - F.col("vector")[i])).alias(c)
            for i, c in enumerate(features)
        ],
        "copy_no",
    )
