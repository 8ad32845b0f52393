"""Shards of near-equal bytes by longest-processing-time scheduling of groups.

Rows with equal texts stay together. Groups of at least 1/64 of a shard are scheduled one by one, and
there can be no more than 64 times the shards of them; all smaller groups are first dealt, by digest, to a
fixed number of bundles. Groups and bundles, sorted by size, go to the least-loaded shard through a heap.
So the schedule has a bounded number of entries, however many rows there are, and shards
differ by less than the largest entry scheduled last allows. A group is never split, so a group larger than an even
share makes its shard larger.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.scratch import materialise

SHARE = 64
BUNDLES = 4096
CHUNK_ROWS = 20_000


def schedule(entries: Iterable[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """(entry, shard): by falling size, each entry to the shard with the least load so far."""
    heap = [(0, shard) for shard in range(shards)]
    placed = []
    for entry, size in sorted(entries, key=lambda e: (-e[1], e[0])):
        load, shard = heapq.heappop(heap)
        placed.append((entry, shard))
        heapq.heappush(heap, (load + size, shard))
    return placed


def _bundle(digest: Column, bundles: int) -> Column:
    return F.concat(F.lit("bundle "), F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % bundles)


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", bundles: int = BUNDLES
) -> DataFrame:
    """Per row: ``doc_id``, size, text_crc32, law, shard, slot and grown_shard (NULL under this law).

    A row's size is the bytes of its text plus one; NULL texts have no bytes and are a group of their own, apart from the empty texts.
    Slots number the rows of a shard from 0 without gaps, by chunks that are counted first, so that no
    task holds a shard; they follow the order of the rows as read and written down. Repeated rows are
    rows of their own, in the same shard. Other columns are not read. An empty table gives an empty result.
    """
    text = F.col(text_col)
    rows = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
            F.coalesce(F.sha2(text, 256), F.lit("none")).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    groups = materialise(rows.groupBy("digest").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "groups")
    total, n_rows = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    large = (F.col("size") * (shards * SHARE) >= total) & (F.col("size") > 1)
    entry = F.when(large, F.col("digest")).otherwise(_bundle(F.col("digest"), bundles))
    entries = groups.groupBy(entry.alias("entry")).agg(F.sum("size").alias("size")).collect()
    plan = docs.sparkSession.createDataFrame(
        schedule([(e["entry"], e["size"]) for e in entries], shards), "entry string, shard int"
    )
    placed = groups.withColumn("entry", entry).join(F.broadcast(plan), "entry").select("digest", "shard")
    return _with_slots(rows.join(placed, "digest"), max(1, n_rows // CHUNK_ROWS))


def _with_slots(rows: DataFrame, chunks: int) -> DataFrame:
    """Number the rows of each shard: within chunks, then shifted by the rows of the chunks before."""
    dealt = rows.withColumn("chunk", F.pmod("row", F.lit(chunks)))
    dealt = materialise(dealt, "dealt")
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "chunk").orderBy("row")
    numbered = dealt.withColumn("number", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "chunk"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("number") + F.col("before")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
