"""Ranks, running totals and quantiles over a global order, without a single-task window."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.scratch import materialise

HASH_PRIME = 1_000_003
HASH_STEP = 1_000
EXACT_ROWS = 50_000
SKETCH_ACCURACY = 10_000


def running_totals(
    df: DataFrame, order_by: Sequence[Column], totals: Mapping[str, Column], slices: int | None = None
) -> DataFrame:
    """Add running sums (current row included) over the order of the whole table.

    The rows are range-partitioned into slices, each slice is summed on its own, and the sums of the
    slices before it are added: one shuffle by range, one by slice, and a table with one row per
    slice as the only broadcast. The slices are written down in between, so every later step sees
    the same boundaries. Their number is at most the number of shuffle partitions and follows the
    amount of data unless given. ``order_by`` has to identify a row: aggregate equal rows first.
    """
    number = () if slices is None else (slices,)
    ranged = df.repartitionByRange(*number, *order_by)
    sliced = materialise(ranged.withColumn("_slice", F.spark_partition_id()), "slices")
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(expr).alias(name) for name, expr in totals.items()])
        .select(
            "_slice",
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in totals],
        )
    )
    inside = (
        Window.partitionBy("_slice")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sliced.join(F.broadcast(offsets), "_slice").select(
        *df.columns,
        *[(F.sum(expr).over(inside) + F.col(f"_before_{n}")).alias(n) for n, expr in totals.items()],
    )


@dataclass
class _Rank:
    """Search state for the value at one 0-based rank of one expression."""

    expr: Column
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    value: float | None = None

    @property
    def inside(self) -> Column:
        """The values strictly inside the bracket, whose open ends are None, NULL elsewhere."""
        inside = self.expr.isNotNull()
        if self.low is not None:
            inside &= self.expr > F.lit(self.low)
        if self.high is not None:
            inside &= self.expr < F.lit(self.high)
        return F.when(inside, self.expr)


def _narrow(df: DataFrame, searches: Sequence[_Rank]) -> None:
    """Shrink every open bracket around its rank with one sketch pass and one counting pass."""
    margin = 2.0 / SKETCH_ACCURACY
    sketches = []
    for i, s in enumerate(searches):
        at = (s.rank - s.below + 0.5) / s.rows
        fractions = [max(at - margin, 0.0), min(at + margin, 1.0)]
        sketches.append(F.percentile_approx(s.inside, fractions, SKETCH_ACCURACY).alias(str(i)))
    pivots = df.agg(*sketches).first()
    counts = []
    for i, s in enumerate(searches):
        low, high = pivots[i]
        inside = s.inside
        counts += [
            F.count(F.when(inside < low, 1)).alias(f"lt{i}"),
            F.count(F.when(inside == low, 1)).alias(f"eq{i}"),
            F.count(F.when((inside > low) & (inside < high), 1)).alias(f"mid{i}"),
            F.count(F.when(inside == high, 1)).alias(f"top{i}"),
        ]
    counted = df.agg(*counts).first()
    for i, s in enumerate(searches):
        low, high = pivots[i]
        at = s.rank - s.below
        lt, eq, mid, top = (counted[f"{part}{i}"] for part in ("lt", "eq", "mid", "top"))
        if at < lt:
            s.high, s.rows = low, lt
        elif at < lt + eq:
            s.value = low
        elif at < lt + eq + mid:
            s.below, s.low, s.high, s.rows = s.below + lt + eq, low, high, mid
        elif low < high and at < lt + eq + mid + top:
            s.value = high
        else:
            taken = lt + eq + mid + (top if low < high else 0)
            s.below, s.low, s.rows = s.below + taken, high, s.rows - taken


def exact_quantiles(
    df: DataFrame,
    exprs: Mapping[str, Column],
    fraction: float = 0.5,
    exact_rows: int = EXACT_ROWS,
    sizes: Mapping[str, int] | None = None,
) -> dict[str, float | None]:
    """Exact interpolated quantile of each numeric expression, NULLs skipped.

    A bracket around the wanted rank is narrowed with quantile sketches of fixed size until at most
    ``exact_rows`` values are left inside, and only those are ranked exactly. NULL and NaN are missing;
    infinite values are values. Values tied at the edge of a bracket are settled by counting. All expressions share the passes; the driver sees counts
    and bracket edges only. ``sizes``, the number of values per expression, spares the counting pass.
    """
    missing = F.lit(None).cast("double")
    values = {}
    for name, expr in exprs.items():
        values[name] = F.nanvl(expr.cast("double"), missing)
    if sizes is None:
        sizes = dict(zip(values, df.agg(*[F.count(v).alias(str(i)) for i, v in enumerate(values.values())]).first()))
    searches: dict[str, tuple[float, list[_Rank]]] = {}
    for name, expr in values.items():
        position = (sizes[name] - 1) * fraction
        ranks = sorted({math.floor(position), math.ceil(position)}) if sizes[name] else []
        searches[name] = (position, [_Rank(expr, rank, sizes[name]) for rank in ranks])
    pending = [s for _, found in searches.values() for s in found]
    while wide := [s for s in pending if s.value is None and s.rows > exact_rows]:
        _narrow(df, wide)
    if narrow := [s for s in pending if s.value is None]:
        picked = df.agg(
            *[
                F.get(F.sort_array(F.collect_list(s.inside)), F.lit(s.rank - s.below)).alias(str(i))
                for i, s in enumerate(narrow)
            ]
        ).first()
        for i, s in enumerate(narrow):
            s.value = picked[i]
    result: dict[str, float | None] = {}
    for name, (position, found) in searches.items():
        if not found:
            result[name] = None
        else:
            low, high = found[0].value, found[-1].value
            weight = position - math.floor(position)
            result[name] = low if low == high else low * (1 - weight) + high * weight
    return result


def key_hash(df: DataFrame, key: str, seed: int) -> Column:
    """Deterministic spread of a key over 0 .. 1000002, the same on every partitioning.

    Both the remainder and the quotient of a key count, so that keys with one remainder spread too.
    """
    column = F.col(key)
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        column = F.xxhash64(column)
    prime, value = F.lit(HASH_PRIME), column.cast("long")
    low = F.pmod(value, prime)
    high = F.pmod(F.floor((value - low) / prime).cast("long"), prime)
    return F.coalesce(F.pmod(low * 7919 + high * 104729 + seed, prime), F.lit(0))


@dataclass(frozen=True)
class Cut:
    """Rows of one class up to (hash, key) inclusive lie before the cut; no hash: none do."""

    label: object
    hash: int | None = None
    key: object = None


def class_cuts(
    df: DataFrame, label: str, key: str, ranks: Callable[[int], Sequence[int]] | Mapping[object, Sequence[int]], seed: int = 42
) -> list[list[Cut]]:
    """Cut every class after given numbers of rows in the order of (key hash, key).

    ``ranks`` maps a class size, or if it is a mapping a class, to ascending row counts. The cut points are found by counting hash
    ranges, then single hash values, then the keys that share the one hash value at the cut, so the
    table itself is never sorted or shuffled; it is read up to three times, label and key only. Exact
    when keys are unique; a repeated key is kept whole on one side.
    """
    hashed = df.select(
        F.col(label).alias("label"), F.col(key).alias("key"), key_hash(df, key, seed).alias("hash")
    )
    coarse = F.floor(F.col("hash") / HASH_STEP).cast("int").alias("step")
    by_step: dict[object, dict[int, int]] = {}
    for row in hashed.groupBy("label", coarse).count().collect():
        by_step.setdefault(row["label"], {})[row["step"]] = row["count"]

    wanted = []
    for value, steps in by_step.items():
        found = ranks[value] if isinstance(ranks, Mapping) else ranks(sum(steps.values()))
        for index, rank in enumerate(found):
            wanted.append((value, index, *_locate(steps, rank)))
    open_steps = sorted({step for _, _, step, _ in wanted if step is not None})
    by_hash: dict[tuple, dict[int, int]] = {}
    if open_steps:
        fine = hashed.withColumn("step", coarse).filter(F.col("step").isin(open_steps))
        for row in fine.groupBy("label", "step", "hash").count().collect():
            by_hash.setdefault((row["label"], row["step"]), {})[row["hash"]] = row["count"]
    placed = [
        (value, index, *((None, 0) if step is None else _locate(by_hash[value, step], rest)))
        for value, index, step, rest in wanted
    ]
    cut_keys = _cut_keys(hashed, [(v, h, rest) for v, _, h, rest in placed if h is not None])
    cuts: dict[object, list[Cut]] = {value: [] for value in by_step}
    for value, _, hash_value, rest in placed:
        cuts[value].append(Cut(value, hash_value, cut_keys.get((value, hash_value, rest))))
    return list(cuts.values())


def _locate(counts: Mapping[int, int], rank: int) -> tuple[int | None, int]:
    """Bucket that holds the ``rank``-th row (1-based) and the rank inside it."""
    if rank <= 0:
        return None, 0
    for bucket in sorted(counts):
        if rank <= counts[bucket]:
            return bucket, rank
        rank -= counts[bucket]
    raise ValueError("rank beyond the class size")


def _cut_keys(hashed: DataFrame, targets: Sequence[tuple]) -> dict[tuple, object]:
    """Key of the wanted row among the keys that share a hash value at a cut."""
    if not targets:
        return {}
    tied = (
        hashed.filter(F.col("hash").isin(sorted({h for _, h, _ in targets})))
        .groupBy("label", "hash", "key")
        .count()
    )
    order = Window.partitionBy("label", "hash").orderBy("key")
    placed = tied.withColumn("upto", F.sum("count").over(order)).withColumn(
        "from", F.col("upto") - F.col("count")
    )
    hit = F.lit(False)
    for value, hash_value, rest in targets:
        hit |= (
            F.col("label").eqNullSafe(F.lit(value))
            & (F.col("hash") == hash_value)
            & (F.col("from") < rest)
            & (F.col("upto") >= rest)
        )
    found = placed.filter(hit).collect()
    return {
        (value, hash_value, rest): row["key"]
        for value, hash_value, rest in targets
        for row in found
        if row["label"] == value and row["hash"] == hash_value and row["from"] < rest <= row["upto"]
    }


def cuts_passed(df: DataFrame, label: str, key: str, cuts: Sequence[Sequence[Cut]], seed: int = 42) -> Column:
    """How many cuts of its class lie before a row: a plain column, no shuffle."""
    hashed, key_column = key_hash(df, key, seed), F.col(key)
    passed = None
    for class_cut in cuts:
        total = F.lit(0)
        for cut in class_cut:
            if cut.hash is None:
                beyond = F.lit(True)
            else:
                after_key = key_column.isNotNull()
                if cut.key is not None:
                    after_key = F.coalesce(key_column > F.lit(cut.key), F.lit(False))
                beyond = (hashed > cut.hash) | ((hashed == cut.hash) & after_key)
            total = total + beyond.cast("int")
        matches = F.col(label).eqNullSafe(F.lit(class_cut[0].label))
        passed = F.when(matches, total) if passed is None else passed.when(matches, total)
    return F.lit(None).cast("int") if passed is None else passed
