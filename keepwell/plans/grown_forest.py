"""Forests whose trees are grown and kept on the executors, for more nodes than a driver holds.

Every row is drawn for every tree as often as a hash of the row, tree and seed says (Poisson, mean 1). As long as a node
has more than ``GROUP_ROWS`` rows, its split is chosen from histograms that all tasks count and one shuffle adds; below that,
the rows of a node meet in one group, which grows the rest of that tree. The driver sees the few large nodes and one short row
per grown part. Splits, pruning and importance follow Spark's forest (32 bins, Gini, ``sqrt`` of the features per node, parts of
one prediction pruned), so a forest is equal in distribution to Spark's, not of the same random choices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.scratch import discard, materialise, scratch_path

BINS = 32
#: A level's splits come from its rows' sorted cells where these are fewer than so many times the cells of its histograms.
FEW = 1.5
#: A tree's node with at most so many rows is grown to the end in one group.
GROUP_ROWS = 100_000
NEVER = 1 << 20
ROW = "_row"

#: Nodes of large size, of all trees; ``left`` is a place (the right child follows it), -1 where a grown part hangs.
TOP = np.dtype([("tree", "i4"), ("depth", "i4"), ("left", "i4"), ("feature", "i4"), ("cut", "i4"), ("ends", "?"), ("n", "f8"), ("zeros", "f8"), ("ones", "f8"), ("gain", "f8")])
#: Nodes of a grown part. ``uniform``: the deepest limit of the depth at which all below the node predicts as it does.
PART = np.dtype([("left", "i4"), ("feature", "i4"), ("cut", "i4"), ("uniform", "i4"), ("share", "f8")])
PART_SCHEMA = "node int, nodes binary, first array<int>, importance array<double>"


def _draws(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    start = (seed * 0xD1B54A32D192ED03 + (tree + 1) * 0x9E3779B97F4A7C15) % 2**64
    z = ids.view(np.uint64) + np.uint64(start)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    share = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(_POISSON, share, "right")


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def _purity(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (zeros * zeros + ones * ones) / np.maximum(zeros + ones, 1e-300)


def _best_splits(hist: np.ndarray, weights: Sequence[float], min_leaf: int) -> tuple[np.ndarray, ...]:
    """(slot, bin, gain, left, right) of the best split per node; ``hist`` is class x node x slot x bin and counts rows.

    ``left`` and ``right`` are (n, zeros, ones): rows, and the weight of either class.
    """
    left = np.cumsum(hist, axis=3)
    total = left[..., -1:]
    right, left = total - left[..., :-1], left[..., :-1]
    shares = [_purity(weights[0] * side[0], weights[1] * side[1]) for side in (left, right, total)]
    gain = shares[0] + shares[1] - shares[2]
    gain[(left[0] + left[1] < min_leaf) | (right[0] + right[1] < min_leaf)] = 0
    flat = gain.reshape(len(gain), -1)
    best, at = flat.argmax(axis=1), np.arange(len(flat))
    gain = flat[at, best]
    slot, cut = np.divmod(best, hist.shape[3] - 1)
    left, right = (_stats(side[0, at, slot, cut], side[1, at, slot, cut], weights) for side in (left, right))
    return slot, cut, _worth(gain, left, right), left, right


def _best_splits_of_few(cells: np.ndarray, marks: np.ndarray, weights: Sequence[float], min_leaf: int):
    """:func:`_best_splits` from the rows' cells, sorted, where most cells of the histograms would be empty.

    ``marks`` has how often a row is drawn, and 32 more for class 1.
    """
    some = len(cells)
    kind = np.int32 if cells.max() < 2**24 else np.int64
    packed = np.sort(((cells.astype(kind) << 6) + marks.astype(kind)).ravel())
    cell = packed >> 6
    ends = np.flatnonzero(cell[1:] != cell[:-1])
    ends = np.append(ends, len(cell) - 1)
    drawn = (packed & 31).astype(np.int64)
    sums = np.cumsum(drawn << (packed & 32))[ends]  # rows of class 0 in the lower half, of class 1 in the upper
    cell = cell[ends]
    slots = cell // BINS  # each holds all rows of its node
    last = np.append(np.flatnonzero(slots[1:] != slots[:-1]), len(slots) - 1)
    sizes = np.diff(last, prepend=-1)
    whole = np.diff(sums[last], prepend=0)
    left = sums - np.repeat(sums[last] - whole, sizes)
    right = np.repeat(whole, sizes) - left
    (zeros, ones), (zeros_right, ones_right) = ((side & 0xFFFFFFFF, side >> 32) for side in (left, right))
    total = np.repeat(_purity(weights[0] * (whole & 0xFFFFFFFF), weights[1] * (whole >> 32)), sizes)
    gain = _purity(weights[0] * zeros, weights[1] * ones) + _purity(weights[0] * zeros_right, weights[1] * ones_right) - total
    gain[(zeros + ones < min_leaf) | (zeros_right + ones_right < min_leaf)] = 0
    starts = np.append(0, last[some - 1 : -1 : some] + 1)
    most = np.maximum.reduceat(gain, starts)
    found = np.flatnonzero(gain == np.repeat(most, np.diff(starts, append=len(gain))))
    best = found[np.searchsorted(found, starts)]
    left, right = _stats(zeros[best], ones[best], weights), _stats(zeros_right[best], ones_right[best], weights)
    return slots[best] % some, cell[best] % BINS, _worth(most, left, right), left, right


def _stats(zeros: np.ndarray, ones: np.ndarray, weights: Sequence[float]) -> np.ndarray:
    return np.stack([zeros + ones, weights[0] * zeros, weights[1] * ones], axis=1).astype(float)


def _worth(gain: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The gains, 0 where they are no more than rounding."""
    return np.where(gain > 1e-9 * (left[:, 1:] + right[:, 1:]).sum(axis=1), gain, 0)


def _subsets(rng: np.random.Generator, n: int, n_features: int) -> np.ndarray:
    some = math.ceil(math.sqrt(n_features))
    order = rng.random((n, n_features))
    chosen = order.argpartition(some - 1, axis=1)[:, :some]
    return np.take_along_axis(chosen, np.take_along_axis(order, chosen, 1).argsort(axis=1), 1)


def _cells(bins: np.ndarray, rows: np.ndarray, place: np.ndarray, subsets: np.ndarray) -> np.ndarray:
    """Per slot and row, the cell of its node's histograms that counts it; ``rows`` are places in ``bins``."""
    some = subsets.shape[1]
    found = np.take(np.ascontiguousarray(subsets.T), place, axis=1)
    found += rows * bins.shape[1]
    cells = np.take(bins.reshape(-1), found).astype(np.int64)
    cells += place * (some * BINS)
    cells += (np.arange(some) * BINS)[:, None]
    return cells


def _histograms(cells: np.ndarray, ones: np.ndarray, draws: np.ndarray, n: int) -> np.ndarray:
    """Rows per class, node, slot and bin."""
    some = len(cells)
    size = n * some * BINS
    found = np.bincount((cells + ones * size).ravel(), np.tile(draws, some), 2 * size)
    return found.reshape(2, n, some, BINS)


def _values(ones: np.ndarray, draws: np.ndarray, weights: Sequence[float]) -> np.ndarray:
    return np.stack([draws, draws * weights[0] * (ones == 0), draws * weights[1] * (ones == 1)], axis=1).astype(float)


def grow(bins: np.ndarray, values: np.ndarray, depth: int, limit: int, min_leaf: int, rng: np.random.Generator):
    """The part of a tree below one node, level by level: its nodes, the first depth of either prediction, importance.

    Rows are counted in whole numbers and weighed by their class afterwards, so their order does not matter.
    """
    rows, place, root_depth = np.arange(len(bins)), np.zeros(len(bins), np.int64), depth
    draws, ones = values[:, 0].astype(np.int64), (values[:, 2] > 0).astype(np.int64)
    weights = [(values[ones == c][:1, 1 + c] / values[ones == c][:1, 0]).sum() for c in (0, 1)]
    marks = draws + 32 * ones
    bins = np.ascontiguousarray(bins)
    counts = np.bincount(ones, draws, 2)
    levels, stats, gains, n_nodes = [], [_stats(counts[:1], counts[1:], weights)], [], 1
    while True:
        level, s = np.zeros(len(stats[-1]), PART), stats[-1]
        level["left"], level["feature"] = -1, -1
        level["share"] = s[:, 2] / (s[:, 1] + s[:, 2])
        levels.append(level)
        gains.append(np.zeros(len(level)))
        able = np.flatnonzero((s[:, 1] > 0) & (s[:, 2] > 0) & (s[:, 0] >= 2 * min_leaf)) if depth < limit else []
        if not len(able):
            break
        if len(able) < len(level):
            number = np.full(len(level), -1)
            number[able] = np.arange(len(able))
            place = number[place]
            kept = np.flatnonzero(place >= 0)
            rows, place = rows[kept], place[kept]
        subsets = _subsets(rng, len(able), bins.shape[1])
        cells = _cells(bins, rows, place, subsets)
        if cells.size < FEW * len(able) * subsets.shape[1] * BINS:
            slot, cut, gain, left, right = _best_splits_of_few(cells, marks[rows], weights, min_leaf)
        else:
            slot, cut, gain, left, right = _best_splits(_histograms(cells, ones[rows], draws[rows], len(able)), weights, min_leaf)
        split = np.flatnonzero(gain > 0)
        if not len(split):
            break
        feature = subsets[np.arange(len(able)), slot]
        level["left"][able[split]] = n_nodes + 2 * np.arange(len(split))
        level["feature"][able[split]], level["cut"][able[split]] = feature[split], cut[split]
        gains[-1][able[split]] = gain[split]
        stats.append(np.stack([left[split], right[split]], axis=1).reshape(-1, 3))
        goes_right = np.take(bins.reshape(-1), rows * bins.shape[1] + feature[place]) > cut[place]
        number = np.full(len(able), -1)
        number[split] = 2 * np.arange(len(split))
        place = number[place]
        kept = np.flatnonzero(place >= 0)
        rows, place = rows[kept], place[kept] + goes_right[kept]
        n_nodes, depth = n_nodes + 2 * len(split), depth + 1
    nodes, tall = np.concatenate(levels), np.repeat(np.arange(len(levels)) + root_depth, [len(x) for x in levels])
    s = np.concatenate(stats)
    first = _first_depths(nodes["left"], tall, s[:, 2] > s[:, 1], np.full((len(nodes), 2), NEVER))
    nodes["uniform"] = first[np.arange(len(nodes)), (s[:, 2] <= s[:, 1]).astype(int)] - 1
    counts = (nodes["left"] >= 0) & (nodes["uniform"] < limit)
    importance = np.bincount(nodes["feature"][counts], np.concatenate(gains)[counts], bins.shape[1])
    return nodes, first[0], importance


def _first_depths(left: np.ndarray, depth: np.ndarray, predicts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Per node, the first depth at or under it of a node that predicts 0, and 1; children come after their parents."""
    first = below.copy()
    at = np.arange(len(left)), predicts.astype(int)
    first[at] = np.minimum(first[at], depth)
    for d in range(int(depth.max(initial=0)) - 1, -1, -1):
        inner = np.flatnonzero((depth == d) & (left >= 0))
        first[inner] = np.minimum(first[inner], np.minimum(first[left[inner]], first[left[inner] + 1]))
    return first


def _route(bins: np.ndarray, top: np.ndarray, tree: int) -> np.ndarray:
    """The large node without children that each row comes to; the root of tree i is at place i."""
    node = np.full(len(bins), tree)
    while True:
        inner = np.flatnonzero(top["left"][node] >= 0)
        if not len(inner):
            return node
        at = node[inner]
        node[inner] = top["left"][at] + (bins[inner, top["feature"][at]] > top["cut"][at])


def _by_node(node: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each node with the rows that came to it."""
    order = np.argsort(node, kind="stable")
    starts = np.flatnonzero(np.diff(node[order], prepend=-1))
    for rows in np.split(order, starts[1:]):
        if len(rows):
            yield int(node[rows[0]]), rows


def _matrix(blobs: Sequence[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)


def _thresholds(features: DataFrame) -> list[np.ndarray]:
    """Per feature, up to 31 values at even ranks; a row goes to the bin of the first that is not below its value."""
    first = features.first()
    ranks = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    x = F.col("features")
    found = features.agg(*[
        F.struct(F.percentile_approx(x[i], ranks, 10_000).alias("at"), F.max(x[i]).alias("top")).alias(f"f{i}")
        for i in range(len(first["features"]))
    ]).first()
    return [np.array([v for v in sorted(set(f["at"])) if v < f["top"]]) for f in found]


def _binned(features: pa.Array, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    values = features.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(thresholds))
    return np.stack([np.searchsorted(t, values[:, i]) for i, t in enumerate(thresholds)], axis=1).astype(np.uint8)


@dataclass(frozen=True)
class BinnedRows:
    """Training rows as bins, written, from which any number of forests are grown: ``weights`` per class when weighted."""

    table: DataFrame
    thresholds: list[np.ndarray]
    weights: list[float]
    rows: int


def bin_rows(training: DataFrame) -> BinnedRows:
    """The bins of ``target`` (0 or 1), ``features`` and the ``weight`` of the row's class."""
    rows = training.select("target", "weight", vector_to_array("features").alias("features"))
    thresholds = _thresholds(rows.select("features"))
    # A row's draws hang on what it is, not on where it lies.
    identity = F.xxhash64(*[c for c in training.columns if c not in ("features", "weight")], vector_to_array("features"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                packed = np.column_stack([_binned(batch.column(2), thresholds), batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in packed], pa.binary())], ["id", "bins"])

    plain = training.select(identity.alias("id"), "target", vector_to_array("features").alias("features"))
    table = materialise(plain.mapInArrow(pack, "id long, bins binary"), "binned")
    classes = {r["target"]: r for r in rows.groupBy("target").agg(F.max("weight").alias("weight"), F.count("*").alias("n")).collect()}
    weights = [classes[c]["weight"] if c in classes else 1.0 for c in (0.0, 1.0)]
    return BinnedRows(table, thresholds, weights, sum(r["n"] for r in classes.values()))


def fit_forest(
    training: DataFrame | BinnedRows, trees: int, max_depth: int, min_leaf: int, seed: int = 42, weighted: bool = False
) -> GrownForest:
    """Grow a forest on ``target`` (0 or 1), ``features`` and, if ``weighted``, the ``weight`` of the row's class."""
    binned = training if isinstance(training, BinnedRows) else bin_rows(training)
    spark, table, thresholds = binned.table.sparkSession, binned.table, binned.thresholds
    width, weights = len(thresholds), binned.weights if weighted else [1.0, 1.0]
    top = _grow_top(table, trees, max_depth, min_leaf, seed, weights, width, binned.rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed = batch.column(0).to_numpy(), _matrix(batch.column(1).to_pylist(), width + 1)
            for tree in range(trees):
                draws = _draws(ids, tree, seed)
                mine = np.flatnonzero(draws)
                node, drawn = _route(packed[mine], top, tree), np.column_stack([packed[mine], draws[mine].astype(np.uint8)])
                found = [(n, drawn[r].tobytes()) for n, r in _by_node(node) if not top["ends"][n]]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["node", "rows"])

    def finish(group: pa.Table) -> pa.Table:
        node = group.column("node")[0].as_py()
        packed = _matrix(group.column("rows").to_pylist(), width + 2)
        values = _values(packed[:, -2], packed[:, -1], weights)
        rng = np.random.default_rng([seed, 1, node])
        nodes, first, importance = grow(packed[:, :width], values, int(top["depth"][node]), max_depth, min_leaf, rng)
        return pa.table({
            "node": pa.array([node], pa.int32()), "nodes": pa.array([nodes.tobytes()], pa.binary()),
            "first": pa.array([first.tolist()], pa.list_(pa.int32())), "importance": pa.array([importance.tolist()], pa.list_(pa.float64())),
        })

    path = scratch_path(spark, "forest")
    dealt = table.mapInArrow(deal, "node int, rows binary")
    dealt.groupBy("node").applyInArrow(finish, PART_SCHEMA).write.parquet(path)
    ends = np.flatnonzero(top["ends"])
    if len(ends):
        spark.createDataFrame([_ended(top, n, width) for n in ends.tolist()], PART_SCHEMA).write.mode("append").parquet(path)
    if binned is not training:
        discard(table)
    return GrownForest(path, top, thresholds, trees, max_depth)


def _ended(top: np.ndarray, node: int, width: int) -> tuple:
    """A large node that no split divides, as a part of one node."""
    part, one = np.zeros(1, PART), top["ones"][node] > top["zeros"][node]
    part["left"], part["uniform"] = -1, NEVER
    part["share"] = top["ones"][node] / (top["zeros"][node] + top["ones"][node])
    first = [NEVER, NEVER]
    first[int(one)] = int(top["depth"][node])
    return node, bytearray(part.tobytes()), first, [0.0] * width


def _grow_top(table: DataFrame, trees: int, max_depth: int, min_leaf: int, seed: int, weights, width: int, rows: int) -> np.ndarray:
    """Split the nodes of more than ``GROUP_ROWS`` rows, one level of all trees at a time."""
    top = np.zeros(trees, TOP)
    top["tree"], top["left"], top["n"] = np.arange(trees), -1, rows
    opened = np.arange(trees) if rows > GROUP_ROWS else np.arange(0)
    level = 0
    while len(opened) and level < max_depth:
        subsets = _subsets(np.random.default_rng([seed, 0, level]), len(opened), width)
        tree_of = top["tree"][opened]
        opened = opened[np.argsort(tree_of, kind="stable")]
        starts = np.searchsorted(top["tree"][opened], np.arange(trees + 1))
        number = np.full(len(top), -1)
        number[opened] = np.arange(len(opened))

        def count(batches: Iterator[pa.RecordBatch], top=top, opened=opened, starts=starts, number=number, subsets=subsets) -> Iterator[pa.RecordBatch]:
            added = np.zeros((2, len(opened), subsets.shape[1], BINS))
            for batch in batches:
                ids, packed = batch.column(0).to_numpy(), _matrix(batch.column(1).to_pylist(), width + 1)
                for tree in np.flatnonzero(np.diff(starts)).tolist():
                    a, b = starts[tree], starts[tree + 1]
                    draws = _draws(ids, tree, seed)
                    mine = np.flatnonzero(draws)
                    place = number[_route(packed[mine], top, tree)]
                    mine, place = mine[place >= 0], place[place >= 0] - a
                    cells = _cells(packed, mine, place, subsets[a:b])
                    added[:, a:b] += _histograms(cells, packed[mine, -1].astype(np.int64), draws[mine], b - a)
            yield pa.RecordBatch.from_arrays([pa.array(opened, pa.int32()), pa.array([h.tobytes() for h in added.swapaxes(0, 1)], pa.binary())], ["node", "hist"])

        def choose(group: pa.Table) -> pa.Table:
            hist = sum(np.frombuffer(h) for h in group.column("hist").to_pylist()).reshape(2, 1, -1, BINS)
            slot, cut, gain, left, right = _best_splits(hist, weights, min_leaf)
            values = [slot[0], cut[0], gain[0], *left[0], *right[0], *(left[0] + right[0])]
            return pa.table({"node": group.column("node")[:1], "best": pa.array([[float(v) for v in values]], pa.list_(pa.float64()))})

        found = table.mapInArrow(count, "node int, hist binary").groupBy("node").applyInArrow(choose, "node int, best array<double>").collect()
        following = []
        for row in sorted(found):
            node, (slot, cut, gain, *sums) = row["node"], row["best"]
            top["n"][node], top["zeros"][node], top["ones"][node] = sums[6:]
            if gain <= 0:
                top["ends"][node] = True
                continue
            top["left"][node], top["feature"][node] = len(top) + len(following), subsets[number[node], int(slot)]
            top["cut"][node], top["gain"][node] = cut, gain
            following += [(top["tree"][node], level + 1, -1, 0, 0, level + 1 >= max_depth, *s, 0) for s in (sums[:3], sums[3:6])]
        before = len(top)
        top = np.concatenate([top, np.array(following, TOP)])
        opened = before + np.flatnonzero(top["n"][before:] > GROUP_ROWS)
        level += 1
    return top


def numbered(table: DataFrame) -> DataFrame:
    """``table`` written with a number per row, for forests to score it."""
    return materialise(table.withColumn(ROW, F.monotonically_increasing_id()), "to_score")


class GrownForest(Model, MLWritable, MLReadable):
    """A two-class forest whose parts lie in a table; scores rows as Spark's model of the same trees would."""

    def __init__(self, path: str, top: np.ndarray, thresholds: Sequence[np.ndarray], trees: int, max_depth: int):
        super().__init__()
        self.path, self.top, self.thresholds, self.trees, self.max_depth = path, top, thresholds, trees, max_depth
        parts = SparkSession.active().read.parquet(path).select("node", "first", "importance").collect()
        first = np.full((len(top), 2), NEVER)
        importance = np.zeros((trees, len(thresholds)))
        for part in parts:
            first[part["node"]] = part["first"]
        # A large node without children predicts what its part's first node does.
        predicts = np.where(top["left"] >= 0, top["ones"] > top["zeros"], first[:, 1] < first[:, 0])
        first = _first_depths(top["left"], top["depth"], predicts, first)
        self.uniform = first[np.arange(len(top)), (~predicts).astype(int)] - 1
        self.above = np.full(len(top), -1)
        for node in np.flatnonzero(top["left"] >= 0):
            self.above[top["left"][node] : top["left"][node] + 2] = node
        for part in parts:
            if np.isnan(self._cut_above(part["node"], max_depth)):
                importance[top["tree"][part["node"]]] += part["importance"]
        for node in np.flatnonzero(top["left"] >= 0):
            if self.uniform[node] < max_depth:
                importance[top["tree"][node], top["feature"][node]] += top["gain"][node]
        sums = importance.sum(axis=1, keepdims=True)
        each = np.divide(importance, sums, out=np.zeros_like(importance), where=sums > 0).sum(axis=0)
        self.featureImportances = DenseVector(each / each.sum() if each.sum() else each)

    def _cut_above(self, node: int, depth: int) -> float:
        """Share of class 1 in the highest large node above that is pruned at a limit of the depth; NaN without one."""
        share = math.nan
        while (node := self.above[node]) >= 0:
            if self.uniform[node] >= depth:
                share = self.top["ones"][node] / (self.top["zeros"][node] + self.top["ones"][node])
        return share

    def scores(self, table: DataFrame, cuts: Sequence[tuple[int, int]]) -> DataFrame:
        """``table`` and ``scores``, an array with the probability of class 1 for each (trees, depth) of ``cuts``; it may be :func:`numbered` before."""
        stored = table if ROW in table.columns else numbered(table)
        thresholds, top, trees, width = self.thresholds, self.top, max(n for n, _ in cuts), len(self.thresholds)
        depths = sorted({d for _, d in cuts})
        hanging = np.flatnonzero(top["left"] < 0).tolist()
        pruned = {n: [self._cut_above(n, d) for d in depths] for n in hanging}

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, bins = batch.column(0).to_numpy(), _binned(batch.column(1), thresholds)
                for tree in range(trees):
                    found = [(n, ids[r].tobytes(), bins[r].tobytes()) for n, r in _by_node(_route(bins, top, tree))]
                    node, rows, values = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), pa.array(rows, pa.binary()), pa.array(values, pa.binary())], ["node", "rows", "bins"])

        def descend(rows: pa.Table, part: pa.Table) -> pa.Table:
            shares = np.zeros((0, len(depths)))
            ids = np.zeros(0, np.int64)
            if rows.num_rows:
                node, nodes = rows.column("node")[0].as_py(), np.frombuffer(part.column("nodes")[0].as_py(), PART)
                ids = np.frombuffer(b"".join(rows.column("rows").to_pylist()), np.int64)
                bins = _matrix(rows.column("bins").to_pylist(), width)
                at, found, lines = np.zeros(len(ids), np.int64), np.full((len(ids), len(depths)), np.nan), np.arange(len(ids))
                while len(lines):
                    here = at[lines]
                    for i, depth in enumerate(depths):
                        new = lines[(nodes["uniform"][here] >= depth) & np.isnan(found[lines, i])]
                        found[new, i] = nodes["share"][at[new]]
                    lines = lines[nodes["uniform"][here] < depths[-1]]
                    here = at[lines]
                    at[lines] = nodes["left"][here] + (bins[lines, nodes["feature"][here]] > nodes["cut"][here])
                shares = np.where(np.isnan(pruned[node]), found, pruned[node])
            tree = int(top["tree"][node]) if len(ids) else 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * len(depths), pa.int32()), pa.array(shares.ravel()))
            return pa.table({ROW: pa.array(ids), "tree": pa.array(np.full(len(ids), tree), pa.int32()), "p": lists})

        dealt = stored.select(ROW, vector_to_array("features").alias("features")).mapInArrow(deal, "node int, rows binary, bins binary")
        parts = stored.sparkSession.read.parquet(self.path).select("node", "nodes")
        each = dealt.groupBy("node").cogroup(parts.groupBy("node")).applyInArrow(descend, f"{ROW} long, tree int, p array<double>")
        means = [F.avg(F.when(F.col("tree") < n, F.col("p")[depths.index(d)])) for n, d in cuts]
        return stored.join(each.groupBy(ROW).agg(F.array(*means).alias("scores")), ROW).drop(ROW)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = F.col("scores")[0]
        scored = self.scores(dataset, [(self.trees, self.max_depth)])
        return scored.select(*dataset.columns, array_to_vector(F.array(1 - p, p)).alias("probability"), (p > 0.5).cast("double").alias("prediction"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: GrownForest):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, SparkSession.active()
        facts = {"trees": model.trees, "max_depth": model.max_depth}
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata=facts)
        spark.read.parquet(model.path).write.parquet(f"{path}/parts")
        names = [*TOP.names]
        schema = "place int, tree int, depth int, left int, feature int, cut int, ends boolean, n double, zeros double, ones double, gain double"
        rows = [(i, *r) for i, r in enumerate(model.top[names].tolist())]
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/top")
        cuts = [(i, t.tolist()) for i, t in enumerate(model.thresholds)]
        spark.createDataFrame(cuts, "place int, thresholds array<double>").write.parquet(f"{path}/thresholds")


class _Reader(MLReader):
    def load(self, path: str) -> GrownForest:
        spark = SparkSession.active()
        facts = DefaultParamsReader.loadMetadata(path, spark)
        top = np.array([tuple(r)[1:] for r in spark.read.parquet(f"{path}/top").orderBy("place").collect()], TOP)
        thresholds = [np.array(r["thresholds"], float) for r in spark.read.parquet(f"{path}/thresholds").orderBy("place").collect()]
        model = GrownForest(f"{path}/parts", top, thresholds, facts["trees"], facts["max_depth"])
        model._resetUid(facts["uid"])
        return model
