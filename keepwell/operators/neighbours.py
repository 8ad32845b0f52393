"""Nearest neighbours of every distinct point, without forming all pairs.

Exact search: points are cut into boxes by a tree over a bounded sample, and boxes that are still too full
are cut again on the executors, so that a box stays small however many points there are. Each point is
searched in its own box first; the distance found there tells which other boxes can still hold a nearer
point, and only those are searched, level by level. Projected search: boxes come from random projections in
several tables, and a point meets its own box of each table only; its recall is measured.

Points may come in groups (a column ``_group``, such as the parts of a cross-validation), which then share the jobs of an
exact search: a box belongs to one group, and a point's neighbours are of its own group.

Groups are at most about ``QUERY_ROWS`` queries and ``POINT_ROWS`` points of a box; a task returns the nearest few
per query and never the pairs.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.scratch import materialise

BOX_ROWS = 2_048
SAMPLE_ROWS = 200_000
SAMPLE_CELLS = 5_000_000
MIN_SAMPLE_PER_BOX = 16
QUERY_ROWS = 4_096
POINT_ROWS = 16_384
SPLIT_SAMPLE = 16_384
FULL_BOXES = 4
BLOCK_CELLS = 2_000_000
GROUP = "_group"

# The functions of this module travel to the executors with the job, installed there or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def grow_tree(sample: np.ndarray, box_rows: int) -> Tree:
    """Binary splits as parallel arrays (feature, threshold, left, right).

    A node without a split has feature -1; its number names a box.
    """
    nodes: list[list] = [[-1, 0.0, 0, 0]]
    open_nodes = [(0, sample)]
    while open_nodes:
        node, rows = open_nodes.pop()
        spread = rows.var(axis=0) if len(rows) > box_rows else np.zeros(1)
        if not spread.max() > 0:
            continue
        feature = int(spread.argmax())
        values = rows[:, feature]
        middle = (len(values) - 1) // 2
        threshold = np.partition(values, middle)[middle]
        if threshold == values.max():
            threshold = values[values < threshold].max()
        nodes[node] = [feature, threshold, len(nodes), len(nodes) + 1]
        lower = values <= threshold
        open_nodes += [(len(nodes), rows[lower]), (len(nodes) + 1, rows[~lower])]
        nodes += [[-1, 0.0, 0, 0], [-1, 0.0, 0, 0]]
    feature, threshold, left, right = zip(*nodes)
    return np.array(feature), np.array(threshold, float), np.array(left), np.array(right)


def box_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    """Box number of every point."""
    feature, threshold, left, right = tree
    node = np.zeros(len(points), dtype=np.int64)
    while (inner := np.flatnonzero(feature[node] >= 0)).size:
        at = node[inner]
        low = points[inner, feature[at]] <= threshold[at]
        node[inner] = np.where(low, left[at], right[at])
    return node


def squared_distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, features added one after the other in their given order."""
    total = np.zeros((len(queries), len(points)))
    for j in range(queries.shape[1]):
        total += np.square(queries[:, j, None] - points[None, :, j])
    return total


def box_distances(queries: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared distance from each query to each box, never above that of any point in the box."""
    total = np.zeros((len(queries), len(lower)))
    for j in range(queries.shape[1]):
        below = lower[None, :, j] - queries[:, j, None]
        above = queries[:, j, None] - upper[None, :, j]
        total += np.square(np.maximum(np.maximum(below, above), 0.0))
    return total


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, 0))


def _nearest(queries: pd.DataFrame, points: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query index, point index and distance of the k nearest other points, ties in the order of the points."""
    wanted, stored = _stack(queries["vector"]), _stack(points["vector"])
    ids, asking = points["pid"].to_numpy(), queries["pid"].to_numpy()
    step = max(1, BLOCK_CELLS // max(1, len(stored)))
    found = []
    for start in range(0, len(wanted), step):
        block = squared_distances(wanted[start : start + step], stored)
        block[asking[start : start + step, None] == ids[None, :]] = np.inf
        last = min(k, block.shape[1]) - 1
        reach = np.partition(block, last, axis=1)[:, last]
        who, where = np.nonzero((block <= reach[:, None]) & np.isfinite(block))
        gaps = block[who, where]
        order = np.lexsort((where, gaps, who))
        who, where, gaps = who[order], where[order], gaps[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        near = place < k
        found.append((who[near] + start, where[near], gaps[near]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    who, where, gaps = zip(*found)
    return np.concatenate(who), np.concatenate(where), np.concatenate(gaps)


def _parts(rows: int) -> Column:
    return F.ceil(F.count("*") / rows).cast("int")


def _dealt(parts: Column) -> Column:
    """Part of a row, from its identifier."""
    return F.pmod(F.xxhash64("pid"), parts).cast("int")


def _every(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def _identity(table: DataFrame) -> list[str]:
    """What names a point: its identifier, and its group where there are groups."""
    return [c for c in (GROUP, "pid") if c in table.columns]


def _search(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Candidates of each query among the points of the boxes it is routed to.

    Both sides of a box are dealt into parts, and every part of the one meets every part of the other.
    """
    points = points.select(*[F.col(c).alias(c) for c in points.columns])
    # Written, so that the joins below can be split where a box has very many queries.
    parts = materialise(
        queries.groupBy("box").agg(_parts(QUERY_ROWS).alias("asked"))
        .join(points.groupBy("box").agg(_parts(POINT_ROWS).alias("stored")), "box"),
        "parts",
    )
    asked = queries.join(parts, "box").select(
        "box", _dealt(F.col("asked")).alias("chunk"), _every(F.col("stored")).alias("part"), *_identity(queries), "vector"
    )
    stored = points.join(parts, "box").select(
        "box", _every(F.col("asked")).alias("chunk"), _dealt(F.col("stored")).alias("part"), "pid", "copies", "vector"
    )
    kind = points.schema["pid"].dataType.simpleString()
    groups = [c for c in _identity(queries) if c != "pid"]

    def nearest(asking: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        near = near.sort_values("pid", ignore_index=True)
        who, where, gaps = _nearest(asking, near, k) if len(asking) and len(near) else ([], [], [])
        return pd.DataFrame(
            {
                **{c: asking[c].to_numpy()[who] for c in groups},
                "pid": asking["pid"].to_numpy()[who],
                "distance": np.asarray(gaps, dtype=float),
                "near_pid": near["pid"].to_numpy()[where],
                "copies": near["copies"].to_numpy()[where],
                "vector": pd.Series(list(near["vector"].to_numpy()[where]), dtype=object),
            }
        )

    return (
        asked.groupBy("box", "chunk", "part")
        .cogroup(stored.groupBy("box", "chunk", "part"))
        .applyInPandas(
            nearest,
            "".join(f"{c} int, " for c in groups)
            + f"pid {kind}, distance double, near_pid {kind}, copies bigint, vector array<double>",
        )
    )


def _boxed(points: DataFrame, size: int, box_rows: int, group: int | None = None) -> DataFrame:
    """Name the box of every point, by a tree over a sample of bounded size, which an executor grows.

    With groups, the sample is one of the ``size`` points of ``group``, and a box's name begins with its group.
    """
    sample_size = min(SAMPLE_ROWS, max(1, SAMPLE_CELLS // len(points.first()["vector"])))
    share = min(1.0, sample_size / size)
    sample_rows = max(MIN_SAMPLE_PER_BOX, int(box_rows * share)) if share < 1 else box_rows
    sampled = points if group is None else points.filter(F.col(GROUP) == group)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tree": [cloudpickle.dumps(grow_tree(_stack(rows["vector"]), sample_rows))]})

    grown = sampled.select("vector").sample(share, seed=7).groupBy().applyInPandas(grow, "tree binary").first()
    tree = points.sparkSession.sparkContext.broadcast(
        pickle.loads(grown["tree"]) if grown else grow_tree(np.zeros((0, 0)), sample_rows)
    )

    @F.pandas_udf(T.StringType())
    def box(vectors: pd.Series) -> pd.Series:
        return pd.Series(box_of(tree.value, _stack(vectors)).astype(str))

    return points.withColumn("box", box("vector") if group is None else F.concat_ws(":", GROUP, box("vector")))


def split_boxes(boxed: DataFrame, box_rows: int, by: str = "vector") -> tuple[DataFrame, int]:
    """Cut boxes of more than ``FULL_BOXES * box_rows`` points until there are none; also the number of rounds.

    Each round grows a tree per full box, in a task of its own, over about ``SPLIT_SAMPLE`` of the box's points;
    the points find their new boxes in parts of bounded size. A new box has its number behind the old box's name and
    a stroke. Boxes that no tree can cut (points too near for a variance) stay as they are.
    """
    rounds = 0
    while True:
        counts = materialise(boxed.groupBy("box").agg(F.count("*").alias("rows")), "box-rows")
        full = counts.filter(F.col("rows") > FULL_BOXES * box_rows)
        if full.isEmpty():
            return boxed, rounds
        crowded = boxed.join(full, "box")

        def grow(rows: pd.DataFrame) -> pd.DataFrame:
            share = min(1.0, len(rows) / rows["rows"].iloc[0])
            # Ordered, so that a task that runs again grows the same tree.
            sample = _stack(rows.sort_values("pid")[by])
            least = max(MIN_SAMPLE_PER_BOX, int(box_rows * share))
            tree = grow_tree(sample, least if share < 1 else box_rows)
            return pd.DataFrame({"box": rows["box"].iloc[:1], "tree": [cloudpickle.dumps(tree)], "nodes": len(tree[0])})

        drawn = F.pmod(F.xxhash64("pid", F.lit(rounds)), F.col("rows")) < SPLIT_SAMPLE
        trees = materialise(
            crowded.filter(drawn).select("box", "pid", by, "rows").groupBy("box")
            .applyInPandas(grow, "box string, tree binary, nodes int").filter("nodes > 1"),
            "trees",
        )
        if trees.isEmpty():
            return boxed, rounds
        parts = F.ceil(F.col("rows") / POINT_ROWS).cast("int")
        dealt = crowded.select(*boxed.columns, _dealt(parts).alias("part"))
        grown = trees.join(full, "box").select("box", "tree", _every(parts).alias("part"))

        def place(rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
            if len(rows) and len(tree):
                number = box_of(pickle.loads(tree["tree"].iloc[0]), _stack(rows[by]))
                rows["box"] = rows["box"] + "/" + number.astype(str)
            return rows.drop(columns="part")

        moved = (
            dealt.groupBy("box", "part").cogroup(grown.groupBy("box", "part")).applyInPandas(place, boxed.schema)
        )
        kept = boxed.join(full.select("box"), "box", "left_anti").select(*boxed.columns)
        boxed = materialise(kept.unionByName(moved), "boxed")
        rounds += 1


def _lists(points: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Up to k vectors per point from its own copies and its candidates, by distance and identifier."""
    identity = _identity(points)
    own = points.select(
        *identity,
        F.lit(-1.0).alias("distance"),
        F.col("pid").alias("near_pid"),
        (F.col("copies") - 1).alias("copies"),
        "vector",
    )
    order = Window.partitionBy(*identity).orderBy("distance", "near_pid")
    taken = F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = own.unionByName(candidates).withColumn("taken", taken).filter(F.col("taken") < k)
    uses = F.least(F.col("copies"), k - F.col("taken")).cast("int")
    ordered = F.array_sort(
        F.collect_list(F.struct("distance", "near_pid", uses.alias("uses"), "vector"))
    )
    lists = F.flatten(F.transform(ordered, lambda n: F.array_repeat(n["vector"], n["uses"])))
    return ranked.groupBy(*identity).agg(
        F.min_by("vector", "distance").alias("vector"), lists.alias("neighbours")
    ).drop("pid")


def nearest_neighbours(points: DataFrame, k: int, box_rows: int = BOX_ROWS) -> DataFrame:
    """The k nearest neighbours of every distinct point.

    ``points`` has (pid, copies, vector): a distinct vector, how many rows share it, and the smallest
    key among them. A row's own copies are its nearest neighbours, at distance 0. The result has
    (vector, neighbours): up to k vectors in the order of (distance, pid). With groups both have a column ``_group`` too.
    """
    grouped = GROUP in points.columns
    whole = F.col(GROUP).cast("string") if grouped else F.lit("0")
    sizes = {row[0]: row[1] for row in points.groupBy(GROUP).count().collect()} if grouped else {None: points.count()}
    largest = max(sizes, key=sizes.get, default=None)
    size = sizes.get(largest, 0)
    if size <= box_rows:
        boxed = points.withColumn("box", whole)
        candidates = _search(boxed, boxed, k)
    else:
        first = _boxed(points, size, box_rows, largest)
        boxed, rounds = split_boxes(materialise(first, "boxed"), box_rows)
        first = materialise(_search(boxed, boxed, k), "near")
        reached = materialise(_reachable(boxed, first, k, rounds), "reached")
        candidates = first.unionByName(_search(reached, boxed, k))
    return _lists(points, candidates, k)


def projected_neighbours(
    points: DataFrame, k: int, tables: int = 8, directions: int = 3, bucket_rows: int = 1_024, seed: int = 42
) -> DataFrame:
    """The k nearest among the points that share a bucket of random projections with a point in some table.

    Same input and result as :func:`nearest_neighbours`, but neighbours may be missed; :func:`recall` measures how many.
    In each table a point's bucket comes from its coordinates along ``directions`` random directions, cut into
    equally full steps of a bounded sample; buckets that are still too full are cut further by the same coordinates.
    The work per point is ``tables`` buckets of about ``bucket_rows`` points and does not grow with the input.
    """
    size = points.count()
    first = points.first()
    if size <= bucket_rows or first is None:
        return nearest_neighbours(points, k, max(size, 1))
    planes = np.random.default_rng(seed).normal(size=(tables, len(first["vector"]), directions))
    share = min(1.0, max(1, SAMPLE_CELLS // planes[0].size) / size)
    sample = _stack(points.select("vector").sample(share, seed=7).toPandas()["vector"])
    sample = sample if len(sample) else np.array([first["vector"]])
    steps = max(1, round((size / bucket_rows) ** (1 / directions)))
    cuts = np.quantile(
        np.einsum("nw,twd->tnd", sample, planes), np.arange(1, steps) / steps, axis=1
    )  # step, table, direction
    kind = points.schema["pid"].dataType.simpleString()

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = _stack(batch["vector"])
            for table in range(tables if len(batch) else 0):
                along = vectors @ planes[table]
                places = (along[None] > cuts[:, table, None, :]).sum(axis=0)
                names = [f"{table}:" + "-".join(map(str, place)) for place in places]
                yield pd.DataFrame({**batch, "along": pd.Series(list(along), dtype=object), "box": names})

    schema = f"pid {kind}, copies bigint, vector array<double>, along array<double>, box string"
    dealt = materialise(points.select("pid", "copies", "vector").mapInPandas(project, schema), "buckets")
    boxed, _ = split_boxes(dealt, bucket_rows, "along")
    boxed = boxed.drop("along")
    found = _search(boxed, boxed, k).dropDuplicates(["pid", "near_pid"])
    return _lists(points, found, k)


def recall(found: DataFrame, points: DataFrame, k: int, every: int = 50) -> DataFrame:
    """Share of the true neighbours among those found, for one in ``every`` points against all points in blocks.

    A found neighbour counts if it is no further away than the last true one. One row: ``queries``, ``wanted``, ``hits``
    and ``recall`` (NULL without neighbours).
    """
    chosen = points.filter(F.pmod(F.xxhash64("pid"), F.lit(every)) == 0)
    whole = F.lit("0")
    exact = _lists(chosen, _search(chosen.withColumn("box", whole), points.withColumn("box", whole), k), k)

    def gaps(neighbours: str) -> Column:
        def gap(near: Column) -> Column:
            moved = F.zip_with(near, "vector", lambda a, b: (a - b) * (a - b))
            return F.aggregate(moved, F.lit(0.0), lambda total, x: total + x)

        return F.transform(neighbours, gap)

    true = exact.select("vector", gaps("neighbours").alias("true"))
    both = true.join(found.select("vector", gaps("neighbours").alias("got")), "vector", "left")
    wanted = F.size("true")
    got = F.coalesce("got", F.array().cast("array<double>"))
    hits = F.least(F.size(F.filter(got, lambda d: d <= F.array_max("true"))), wanted)
    totals = both.agg(
        F.count("*").alias("queries"),
        F.coalesce(F.sum(wanted), F.lit(0)).alias("wanted"),
        F.coalesce(F.sum(hits), F.lit(0)).alias("hits"),
    )
    return totals.withColumn("recall", F.try_divide("hits", "wanted"))


def _gap(vector: str, lower: str, upper: str) -> Column:
    """Squared distance from a vector to a box, in the order of :func:`box_distances`."""
    below = F.zip_with(lower, vector, lambda low, x: low - x)
    above = F.zip_with(vector, upper, lambda x, up: x - up)
    outside = F.zip_with(below, above, lambda a, b: F.greatest(a, b, F.lit(0.0)))
    return F.aggregate(outside, F.lit(0.0), lambda total, x: total + x * x)


def _level(level: int) -> Column:
    """Name of the box at a level, that is, the first parts of the whole name."""
    return F.substring_index("box", "/", level + 1)


def _reachable(boxed: DataFrame, first: DataFrame, k: int, rounds: int) -> DataFrame:
    """Route each point to the other boxes that may hold a nearer neighbour.

    The boxes of the first tree, whose number is bounded, go to every task; what is left is carried on to the parts
    of these boxes by joins, one level at a time.
    """
    width = len(boxed.first()["vector"])
    low = [F.min(F.col("vector")[j]) for j in range(width)]
    high = [F.max(F.col("vector")[j]) for j in range(width)]
    edges = materialise(
        boxed.groupBy("box").agg(F.array(*low).alias("lower"), F.array(*high).alias("upper")), "edges"
    )

    def edges_at(level: int) -> DataFrame:
        lows = [F.min(F.col("lower")[j]) for j in range(width)]
        highs = [F.max(F.col("upper")[j]) for j in range(width)]
        grouped = edges.groupBy(_level(level).alias("at"))
        return grouped.agg(F.array(*lows).alias("lower"), F.array(*highs).alias("upper"))

    identity = _identity(boxed)
    grouped = GROUP in identity
    table = edges_at(0).orderBy("at").toPandas()
    of_group = table["at"].str.split(":").str[0].astype(int).to_numpy() if grouped else np.zeros(len(table), int)
    boxes = boxed.sparkSession.sparkContext.broadcast(
        (of_group, table["at"].to_numpy(), _stack(table["lower"]), _stack(table["upper"]))
    )
    order = Window.partitionBy(*identity).orderBy("distance", "near_pid")
    reach = (
        first.select(*identity, "distance", "near_pid", "copies")
        .withColumn("upto", F.sum("copies").over(order))
        .groupBy(*identity)
        .agg(F.min(F.when(F.col("upto") >= k, F.col("distance"))).alias("full"))
    )
    asking = (
        boxed.filter(F.col("copies") <= k)
        .join(reach, identity, "left")
        .select(*identity, "vector", F.col("box").alias("own"), F.coalesce("full", F.lit(float("inf"))).alias("reach"))
    )

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_group, every, lowest, highest = boxes.value
        for batch in batches:
            for group, asked in batch.groupby(batch[GROUP] if grouped else np.zeros(len(batch), int)):
                names, lower, upper = (values[of_group == group] for values in (every, lowest, highest))
                step = max(1, BLOCK_CELLS // len(names))
                for start in range(0, len(asked), step):
                    part = asked.iloc[start : start + step]
                    gaps = box_distances(_stack(part["vector"]), lower, upper)
                    who, where = np.nonzero(gaps <= part["reach"].to_numpy()[:, None])
                    # Batches of rows that repeat a vector once per box.
                    for at in range(0, len(who), step):
                        rows, found = who[at : at + step], where[at : at + step]
                        yield part.iloc[rows].assign(box=names[found])

    kinds = ", ".join(f"{c} {boxed.schema[c].dataType.simpleString()}" for c in identity)
    routed = asking.mapInPandas(route, f"{kinds}, vector array<double>, own string, reach double, box string")
    for level in range(1, rounds + 1):
        parts = edges_at(level).withColumn("box", F.substring_index("at", "/", level)).filter(F.col("at") != F.col("box"))
        near = _gap("vector", "lower", "upper") <= F.col("reach")
        routed = (
            routed.join(materialise(parts, "edges"), "box", "left")
            .filter(F.col("at").isNull() | near)
            .select(*identity, "vector", "own", "reach", F.coalesce("at", "box").alias("box"))
        )
    return routed.filter(F.col("box") != F.col("own")).select(*identity, "vector", "box")
