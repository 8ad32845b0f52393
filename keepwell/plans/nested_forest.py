"""Scores of many forest settings from one fitted forest.

A forest that is grown level by level holds shallower ones: cut at a depth, a tree is what the same splits would
have given with that limit, and the first trees of a forest are a smaller forest. Spark's saved model keeps class
counts at inner nodes too, so one table of nodes scores a row at several depths and for several numbers of trees
while it goes down once. At full depth and size the score is the model's own; for the other settings it is
that of a forest with the same distribution as a fit of its own, not of the same random choices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.scratch import scratch_path

SLICE_ROWS = 1024


@dataclass(frozen=True)
class NodeTable:
    """All nodes of a forest, tree after tree; ``left`` and ``right`` are places in the table, -1 at a leaf."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    share: np.ndarray  # of class 1 among the node's training rows
    predicts: np.ndarray

    def leaves(self, max_depth: int) -> np.ndarray:
        """Which nodes are leaves with a limit of the depth: those at it, and parents of two leaves with one prediction."""
        leaf = (self.left < 0) | (self.depth >= max_depth)
        for depth in range(min(max_depth, int(self.depth.max(initial=0))) - 1, -1, -1):
            inner = np.flatnonzero((self.depth == depth) & ~leaf)
            a, b = self.left[inner], self.right[inner]
            leaf[inner] = leaf[a] & leaf[b] & (self.predicts[a] == self.predicts[b])
        return leaf

    def scores(self, rows: np.ndarray, cuts: Sequence[tuple[int, int]]) -> np.ndarray:
        """Probability of class 1 per row and (trees, depth) of ``cuts``; the rows go down all trees at once."""
        depths = sorted({d for _, d in cuts})
        leaf = [self.leaves(d) for d in depths]
        node = np.tile(self.roots, (len(rows), 1))
        found = [np.full(node.shape, np.nan) for _ in depths]
        line = np.arange(len(rows))[:, None]
        while True:
            for share, ends in zip(found, leaf):
                new = np.isnan(share) & ends[node]
                share[new] = self.share[node[new]]
            inner = ~leaf[-1][node]
            if not inner.any():
                break
            goes_left = rows[line, self.feature[node]] <= self.threshold[node]
            node = np.where(inner, np.where(goes_left, self.left[node], self.right[node]), node)
        return np.stack([found[depths.index(d)][:, :n].mean(axis=1) for n, d in cuts], axis=1)


def node_table(spark: SparkSession, model: RandomForestClassificationModel) -> NodeTable:
    """The nodes of a two-class model over continuous features, by way of its saved form.

    They come to the driver, as the model itself does in a fit.
    """
    path = scratch_path(spark, "forest")
    model.write().save(path)
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        n["impurityStats"][0].alias("zeros"), n["impurityStats"][1].alias("ones"), n["prediction"].alias("predicts"),
    )
    table = nodes.orderBy("treeID", "id").toArrow()
    tree, number, left, right = (table[c].to_numpy() for c in ("treeID", "id", "left", "right"))
    roots = np.flatnonzero(np.diff(tree, prepend=-1))
    first = np.repeat(roots, np.diff(roots, append=len(tree)))
    if not np.array_equal(number, np.arange(len(number)) - first):
        raise ValueError("nodes are not numbered from 0 in every tree")
    left, right = np.where(left < 0, -1, left + first), np.where(right < 0, -1, right + first)
    depth = np.zeros(len(tree), np.int64)
    level = roots
    while len(level):
        inner = level[left[level] >= 0]
        below = np.concatenate((left[inner], right[inner]))
        depth[below] = np.tile(depth[inner] + 1, 2)
        level = below
    zeros, ones = table["zeros"].to_numpy(), table["ones"].to_numpy()
    return NodeTable(
        roots, np.maximum(table["feature"].to_numpy(), 0), table["threshold"].to_numpy(), left, right, depth,
        ones / (zeros + ones), table["predicts"].to_numpy(),
    )


def nested_scores(table: DataFrame, nodes: NodeTable, cuts: Sequence[tuple[int, int]]) -> DataFrame:
    """``target`` and ``scores``, an array with the probability of class 1 for each (trees, depth) of ``cuts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(at, SLICE_ROWS)
                rows = some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
                found = nodes.scores(rows, cuts)
                lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * len(cuts), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], ["target", "scores"])

    columns = table.select("target", vector_to_array("features").alias("features"))
    return columns.mapInArrow(run, "target double, scores array<double>")
