"""Connected components of an edge table, by alternating star contractions on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.scratch import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node near it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    moved = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialise(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that it reaches, for every node of an edge (u, v).

    Roots themselves are not listed; loops and repeated edges do no harm, and an empty table has an
    empty result. A node with very many edges is only a key of a partial minimum, which is written, and of a join
    with one row per node on its other side, which adaptive execution splits. Each round is written to the shared folder, which cuts the
    lineage; the driver sees two numbers per round. The rounds grow with the logarithm of the nodes.
    """
    edges = materialise(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = None
    while True:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
