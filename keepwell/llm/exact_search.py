"""Exact top-k inner-product search over a vector-approximation file.

Vectors become integers and equal ones a class with its smallest identifiers. Classes are dealt to tiles; a
tile holds a cell number per component on a grid of its own, from which follow an upper and a lower
bound of every score. The scan of a block of queries against a tile reads cells only and passes on the classes
that can be among a query's best within the tile. Over all tiles, the best lower bounds of a query
exclude most of these. Exact vectors are then read in the order of the bounds: first as many as results are
wanted, and of the rest only those whose bound reaches the last of these exact scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.scratch import materialise

SCALE = 256
#: Up to this size sums of products are exact in doubles; beyond, bounds are rounded outwards.
EXACT = float(1 << 52)
LARGEST = float((1 << 63) - 1024)
CELLS = 64
TILE_ROWS = 4096
BLOCK_ROWS = 512


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct (id, dim, ints) of the rows that take part."""
    fine = F.forall(F.col(vec_col), lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    usable = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine)

    ints = F.transform(F.col(vec_col), lambda x: F.floor(SCALE * x.cast("double")).cast("long")).alias("ints")
    return usable.select(F.col(id_col).alias("id"), F.size(vec_col).alias("dim"), ints).distinct()


def _numbered(distinct: DataFrame, label: str) -> DataFrame:
    """Write the rows once with a number each, which stays as it is from then on."""
    return materialise(distinct.withColumn("no", F.monotonically_increasing_id()), label)


def vector_classes(points: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: no, dim, ints, and its ``keep`` smallest identifiers, ascending."""
    order = Window.partitionBy("dim", "ints").orderBy("id")
    least = points.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    return _numbered(least.groupBy("dim", "ints").agg(F.sort_array(F.collect_list("id")).alias("ids")), "classes")


def approximation_tiles(classes: DataFrame, tile_rows: int, cells: int) -> DataFrame:
    """Tiles of at most about ``tile_rows`` vectors: cell numbers, and per component least value and width."""
    tiles = classes.count() // tile_rows + 1

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x = np.array(frame["ints"].tolist(), dtype=np.int64).reshape(len(frame), -1)
        low = x.min(axis=0)
        above = x.view(np.uint64) - low.view(np.uint64)  # modulo 2**64: exact even across the whole range
        width = above.max(axis=0, initial=0) // np.uint64(cells) + np.uint64(1)
        codes = (above // width).astype(np.uint8)
        row = (*key, low, width.astype(np.int64), codes.tobytes(), frame["no"].to_numpy())
        return pd.DataFrame([row], columns=["dim", "tile", "low", "width", "codes", "nos"])

    placed = classes.select("no", "dim", "ints", F.pmod(F.xxhash64("no"), F.lit(tiles)).alias("tile"))
    schema = "dim int, tile long, low array<long>, width array<long>, codes binary, nos array<long>"
    return materialise(placed.groupBy("dim", "tile").applyInPandas(build, schema), "approximations")


def bounds(q: np.ndarray, low: np.ndarray, width: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of the inner products of queries with vectors known by their cells."""
    least, step, q = low.astype(np.float64), width.astype(np.float64), q.astype(np.float64)
    near = least + codes * step
    far = near + (step - 1)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    upper, lower = plus @ far.T + minus @ near.T, plus @ near.T + minus @ far.T
    size = np.abs(q) @ (np.abs(least) + 256 * step)
    slack = np.where(size < EXACT, 0.0, size * (4 * len(low) + 16) * np.finfo(np.float64).eps)[:, None]
    return np.clip(np.ceil(upper + slack), -LARGEST, LARGEST), np.clip(np.floor(lower - slack), -LARGEST, LARGEST)


def scan(tiles: DataFrame, queries: DataFrame, want: int, block_rows: int) -> DataFrame:
    """(query, no, upper, lower) of the classes that bounds within their tile cannot exclude."""
    blocks = queries.count() // block_rows + 1
    block = F.pmod(F.xxhash64("no"), F.lit(blocks)).alias("block")
    packed = queries.select("no", "dim", "ints", block).groupBy("dim", "block").agg(
        F.collect_list(F.struct("no", "ints")).alias("queries")
    )
    packed = packed.select("dim", "block", "queries.no", F.flatten("queries.ints").alias("ints"))
    pairs = tiles.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(
        materialise(packed, "queries"), ["dim", "block"]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in batch.schema.names}
                dim = row["dim"].as_py()
                q, low, width = (row[n].values.to_numpy(zero_copy_only=False) for n in ("ints", "low", "width"))
                numbers, nos = (row[n].values.to_numpy() for n in ("no", "nos"))
                codes = np.frombuffer(row["codes"].as_buffer(), np.uint8).reshape(len(nos), dim)
                upper, lower = bounds(q.reshape(len(numbers), dim), low, width, codes)
                if len(nos) > want:
                    last = np.partition(lower, len(nos) - want, axis=1)[:, len(nos) - want]
                    i, j = np.nonzero(upper >= last[:, None])
                else:
                    i, j = np.nonzero(np.ones_like(upper, dtype=bool))
                found = [numbers[i], nos[j], upper[i, j].astype(np.int64), lower[i, j].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query", "no", "upper", "lower"])

    columns = pairs.select("dim", "no", "ints", "low", "width", "codes", "nos")
    return columns.mapInArrow(compare, "query long, no long, upper long, lower long")


def _exact(candidates: DataFrame, queries: DataFrame, classes: DataFrame) -> DataFrame:
    """(query, no, ids, own, score): the exact score of every candidate, and whether it is the query's vector."""
    product = F.zip_with("a", "b", lambda x, y: x * y)
    return (
        candidates.select("query", "no")
        .join(classes.select("no", "ids", F.col("ints").alias("b")), "no")
        .join(queries.select(F.col("no").alias("query"), F.col("ints").alias("a")), "query")
        .select(
            "query", "no", "ids", (F.col("a") == F.col("b")).alias("own"),
            F.aggregate(product, F.lit(0).cast("long"), lambda t, x: t + x).alias("score"),
        )
    )


def _last_of(df: DataFrame, value: str, want: int) -> DataFrame:
    """Per query the ``want``-th highest value; no row for a query with fewer."""
    best = Window.partitionBy("query").orderBy(F.col(value).desc())
    top = df.select("query", value).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= want)
    return top.filter(F.col("rank") == want).select("query", F.col(value).alias("last"))


def refine(found: DataFrame, queries: DataFrame, classes: DataFrame, want: int) -> DataFrame:
    """Exact scores of all candidates that can be among the ``want`` best classes of a query."""
    certain = materialise(_last_of(found, "lower", want), "certain")
    open_ = found.join(certain, "query", "left").filter(F.col("last").isNull() | (F.col("upper") >= F.col("last")))
    open_ = materialise(open_.select("query", "no", "upper"), "open")
    order = Window.partitionBy("query").orderBy(F.col("upper").desc(), "no")
    nearest = open_.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= want)
    first = materialise(_exact(nearest, queries, classes), "scores")
    last = materialise(_last_of(first, "score", want), "last")
    rest = open_.join(last, "query").filter(F.col("upper") >= F.col("last"))
    rest = rest.join(first.select("query", "no"), ["query", "no"], "left_anti")
    return first.unionByName(_exact(rest, queries, classes))


def exact_top_k(
    vectors: DataFrame,
    k: int = 5,
    is_query: Column | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    tile_rows: int = TILE_ROWS,
    block_rows: int = BLOCK_ROWS,
    cells: int = CELLS,
) -> DataFrame:
    """Per query row its ``k`` best other rows: query_id, rank (from 1), the found ``id_col``, score.

    ``is_query`` is a condition on the column ``id`` (default: divisible by 50). Scores are inner products
    of floor(256 * component); ties go to the smaller identifier. Rows with a NULL identifier, a NULL vector, or a NULL or non-finite
    component take no part; a score beyond 64 bits is an error. Only vectors of equal length are
    compared. Repeated rows count once; rows that share an identifier but not the vector are points of
    their own. A query with fewer than ``k`` other
    points has fewer results, an empty table none. Other columns are not read.
    """
    is_query = F.col("id") % 50 == 0 if is_query is None else is_query
    points = materialise(integer_vectors(vectors, id_col, vec_col), "points")
    asked = points.filter(is_query)
    want = k + 1  # the query itself is among the best and goes afterwards
    classes = vector_classes(points, want)
    queries = _numbered(asked.select("dim", "ints").distinct(), "query-vectors")
    tiles = approximation_tiles(classes, tile_rows, cells)
    found = materialise(scan(tiles, queries, want, block_rows), "bounds")
    scores = refine(found, queries, classes, want).select("query", F.explode("ids").alias("id"), "own", "score")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    top = scores.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= want)
    listed = top.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "id", "own", "score"))).alias("top"))
    asked = asked.join(queries, ["dim", "ints"]).select(F.col("id").alias("query_id"), F.col("no").alias("query"))
    others = F.slice(F.filter("top", lambda x: ~x["own"] | (x["id"] != F.col("query_id"))), 1, k)
    ranked = asked.join(listed, "query").select("query_id", F.posexplode(others).alias("at", "found"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("found.id").alias(id_col), F.col("found.score").alias("score")
    )
