"""SimHash near-duplicates: exact comparison of fingerprints, tile by tile.

A fingerprint's population counts in three parts of its bits name its cell. Two fingerprints differ in at
least as many bits as their three counts differ in sum, so only tiles of cells within the radius are
compared, each pair with one exclusive-or of NumPy arrays and a bit count. Cells are cut into tiles of
bounded size by a hash; the fingerprints are distinct, so no tile is hot. From a pair of tiles come not
all linked pairs but edges that span its linked groups, at most one per fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import fresh_name
from keepwell.llm.components import connected_components
from keepwell.scratch import materialise

SEED = 42
#: Lowest bit and width of the parts that are counted one by one.
PARTS = ((0, 21), (21, 21), (42, 22))
TILE_ROWS = 8192
BLOCK = 512
SLICE_ROWS = 256


def fingerprint(text: str | None, shingle: int) -> int:
    """Bits set in over half the shingle hashes of a text, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle, 0)
    spans = zip(starts[: last + 1].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        octets = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        # A few texts at a time, so that a batch is not held as Python strings as well.
        slices = (texts.slice(at, SLICE_ROWS).to_pylist() for at in range(0, len(texts), SLICE_ROWS))
        return pa.array([fingerprint(t, shingle) for part in slices for t in part], pa.int64())

    return prints(text)


def _part_counts(value: Column) -> list[Column]:
    return [
        F.bit_count(F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))).cast("int")
        for low, width in PARTS
    ]


def make_tiles(prints: DataFrame, tile_rows: int = TILE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Tiles (cell, chunk, prints) of distinct fingerprints, and the number of chunks of every cell.

    There are at most 22 * 22 * 23 cells, however large the table: the only table that is broadcast.
    """
    names = [f"c{i}" for i in range(len(PARTS))]
    placed = prints.select("fp", *[c.alias(n) for n, c in zip(names, _part_counts(F.col("fp")))])
    counts = placed.groupBy(*names).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("chunks"))
    cells = materialise(counts, "cells")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int").alias("chunk")
    dealt = placed.join(F.broadcast(cells), names).select("fp", *names, chunk)
    return materialise(dealt.groupBy(*names, "chunk").agg(F.collect_list("fp").alias("fps")), "tiles"), cells


def _tile_pairs(tiles: DataFrame, cells: DataFrame, radius: int) -> DataFrame:
    """Pairs of tiles whose cells are within the radius, each unordered pair once.

    A tile is repeated once per neighbouring tile and joined on (cell, chunk), a key of one right row,
    so that a populous cell is dealt over many tasks.
    """
    names = [f"c{i}" for i in range(len(PARTS))]
    reach = range(-radius, radius + 1)
    steps = [s for s in product(reach, repeat=len(PARTS)) if sum(map(abs, s)) <= radius and s >= (0,) * len(PARTS)]
    listed = F.array(*[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate(s)]) for s in steps])
    left = tiles.select(*[F.col(n).alias(f"a{n}") for n in names], F.col("chunk").alias("at"), "fps", F.inline(listed))
    aimed = left.select(
        *[(F.col(f"a{n}") + F.col(f"d{i}")).alias(n) for i, n in enumerate(names)],
        F.expr("d0 = 0 AND d1 = 0 AND d2 = 0").alias("own"), "at", F.col("fps").alias("a"),
    )
    aimed = aimed.join(F.broadcast(cells), names)
    first = F.when(F.col("own"), F.col("at")).otherwise(F.lit(0))
    aimed = aimed.withColumn("chunk", F.explode(F.sequence(first, F.col("chunks") - 1)))
    right = tiles.select(*names, "chunk", F.col("fps").alias("b"))
    return aimed.join(right, [*names, "chunk"]).select("a", "b")


def spanning_edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the given edges connect, at most one per node."""
    nodes, places = np.unique(np.concatenate((u, v)), return_inverse=True)
    x, y = places[: len(u)], places[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the pairs of ``a`` and ``b`` that differ in 1 to ``radius`` bits."""
    us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(a), BLOCK):
        block = a[at : at + BLOCK]
        differ = np.bitwise_count(block[:, None].view(np.uint64) ^ b[None, :].view(np.uint64))
        i, j = np.nonzero(differ <= radius)
        u, v = spanning_edges(block[i], b[j])
        us.append(u)
        vs.append(v)
    return spanning_edges(np.concatenate(us), np.concatenate(vs))


def print_links(prints: DataFrame, radius: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (u, v) that span all groups of fingerprints linked at ``radius`` or fewer bits."""
    tiles, cells = make_tiles(prints, tile_rows)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            lists = [batch.column(name) for name in ("a", "b")]
            (a, a_at), (b, b_at) = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in lists]
            for k in range(batch.num_rows):
                u, v = tile_links(a[a_at[k] : a_at[k + 1]], b[b_at[k] : b_at[k + 1]], radius)
                if len(u):
                    us.append(u)
                    vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (us, vs)], ["u", "v"])

    return _tile_pairs(tiles, cells, radius).mapInArrow(compare, "u long, v long")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 3,
    carry: Sequence[str] = (),
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Per row: ``carry`` columns, ``fingerprint`` (hexadecimal), ``component_id`` and ``first``.

    ``component_id`` is the smallest identifier among the rows reachable over links, a NULL identifier
    only where there is no other; ``first`` holds for one row of each group, the one with that
    identifier (of repeated rows, one). NULL and empty texts and texts of white space have fingerprint
    zero. Texts are read whole. An empty table gives an empty result. Names that clash with
    carried ones get underscores in front. The rows are written once with their
    fingerprints, numbered, and everything else works on distinct fingerprints.
    """
    carry = list(dict.fromkeys([id_col, *carry]))
    row, fp = fresh_name(carry, "row"), fresh_name(carry, "fp")
    numbered = docs.select(*carry, fingerprint_column(F.col(text_col), shingle).alias(fp))
    rows = materialise(numbered.withColumn(row, F.monotonically_increasing_id()), "fingerprints")
    rank = F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row")
    )
    prints = materialise(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(rank).alias("first")), "prints")
    roots = connected_components(print_links(prints, radius, tile_rows))
    placed = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    placed = materialise(placed, "roots")
    least = materialise(placed.groupBy("root").agg(F.min("first").alias("least")), "least")
    print_col, least_col = fresh_name(rows.columns, "print"), fresh_name(rows.columns, "least")
    grouped = placed.join(least, "root").select(F.col("fp").alias(print_col), F.col("least").alias(least_col))
    names = {n: fresh_name(carry, n) for n in ("fingerprint", "component_id", "first")}
    return rows.join(grouped, rows[fp] == grouped[print_col]).select(
        *carry,
        F.lpad(F.lower(F.hex(F.col(fp))), 16, "0").alias(names["fingerprint"]),
        F.col(least_col)["id"].alias(names["component_id"]),
        (F.col(least_col)["row"] == F.col(row)).alias(names["first"]),
    )


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of every group of near-duplicates, with the columns as they are."""
    grouped = simhash_groups(docs, id_col, text_col, carry=docs.columns, **options)
    return grouped.filter(F.col(grouped.columns[-1])).select(*docs.columns)
