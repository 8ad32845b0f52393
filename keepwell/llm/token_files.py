"""Token files: ids of a whole table in order, coded in independent blocks that are read in parallel.

The documents are range-partitioned by identifier, tokenized in order, and their ids cut into chunks of a
fixed number of ids, which no longer depend on each other. From all chunks follow the counts of the ids, the
one table that all blocks share; then every chunk becomes a block of :mod:`keepwell.llm.rans` with its
place in the order of all ids, a checksum, and the list of the documents that it holds parts of. Both tables are
Parquet, ``frequencies`` and ``blocks`` below one folder, so Spark's commit protocol covers lost executors and
any store that Spark reads will do. Blocks are read one by one: a document that spans blocks gets its checksum
from those of its parts, shifted by the bytes behind them and joined by exclusive-or.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keepwell.llm import rans
from keepwell.llm.common import fresh_name
from keepwell.llm.tokens import apart_encoder, encoder
from keepwell.scratch import scratch_path

END_ID = 1
BLOCK_IDS = 1 << 19
#: Bytes of texts that are encoded at a time, but at least one text.
ENCODE_BYTES = 6 << 20
#: The polynomial of CRC-32 with its bits reversed, and the polynomials 1 and x in the same order.
POLYNOMIAL, ONE, X = 0xEDB88320, 0x80000000, 0x40000000


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32."""
    product = 0
    while a:
        if a & ONE:
            product ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return product


def shifted(crc: int, n_bytes: int) -> int:
    """What a part with this CRC-32 adds, by exclusive-or, to that of a whole with ``n_bytes`` behind the part."""
    power, base, left = ONE, X, 8 * n_bytes
    while left:
        if left & 1:
            power = _times(power, base)
        base, left = _times(base, base), left >> 1
    return _times(power, crc)


def _by_bytes(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts, in the second column, have at most so many bytes, or of one row."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64))
    row, before = 0, 0
    while row < batch.num_rows:
        beyond = max(int(np.searchsorted(ends, before + most, "right")), row + 1)
        yield batch.slice(row, beyond - row)
        row, before = beyond, int(ends[beyond - 1])


def _chunks(docs: DataFrame, tokenizer: str, id_col: str, end_id: int, block_ids: int, words_apart: bool) -> DataFrame:
    """Ids of the documents in order, cut: (part, no, ids, docs), ``no`` numbering the chunks of a partition."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce("text_", F.lit(""))
    rows = docs.select(F.col(id_col).alias("id_"), F.col("text_")).withColumn("text_", text)
    order = [F.col("id_").asc_nulls_last(), F.xxhash64("text_"), F.monotonically_increasing_id()]
    names = [f"order_{i}" for i in range(len(order) - 1)]
    keyed = rows.withColumns(dict(zip(names, order[1:])))
    by = [order[0], *names]
    ordered = keyed.repartitionByRange(*by).sortWithinPartitions(*by).select("id_", "text_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = (apart_encoder if words_apart else encoder)(tokenizer)
        part, number, at, held, parts, id_kind = TaskContext.get().partitionId(), 0, 0, [], [], pa.null()

        def chunk() -> pa.RecordBatch:
            ids = np.concatenate(held).astype("<u4")
            kind = pa.struct(
                [("id", id_kind), ("start", pa.int64()), ("from", pa.int64()), ("length", pa.int32()), ("total", pa.int64())]
            )
            names_ = ("id", "start", "from", "length", "total")
            listed = pa.array([[dict(zip(names_, p)) for p in parts]], pa.list_(kind))
            small = ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids
            columns = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([small.tobytes()], pa.binary()),
                       pa.array([len(ids)], pa.int32()), listed]
            return pa.RecordBatch.from_arrays(columns, ["part", "no", "ids", "n", "docs"])

        room = block_ids
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for some in _by_bytes(batch, ENCODE_BYTES):
                for doc, found in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist())):
                    ids, taken = np.append(found, np.uint32(end_id)), 0
                    while taken < len(ids):
                        piece = ids[taken : taken + room]
                        held.append(piece)
                        parts.append((doc, at, taken, len(piece), len(ids)))
                        taken, room = taken + len(piece), room - len(piece)
                        if not room:
                            yield chunk()
                            number, held, parts, room = number + 1, [], [], block_ids
                    at += len(ids)
        if held:
            yield chunk()

    kind = f"struct<id: {id_type}, start: long, from: long, length: int, total: long>"
    return ordered.mapInArrow(run, f"part int, no int, ids binary, n int, docs array<{kind}>")


def _ids(cell: pa.BinaryScalar, n: int) -> np.ndarray:
    data = cell.as_buffer()
    return np.frombuffer(data, f"<u{data.size // max(n, 1)}")


def id_counts(chunks: DataFrame) -> dict[int, int]:
    """How often every id occurs: one number per id of the vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for cell, n in zip(batch.column(0), batch.column(1).to_pylist()):
                found = np.bincount(_ids(cell, n), minlength=len(total))
                found[: len(total)] += total
                total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counted = chunks.select("ids", "n").mapInArrow(count, "id long, n long")
    return {r["id"]: r["n"] for r in counted.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    words_apart: bool = True,
) -> None:
    """Write the ids of all documents, each with ``end_id`` behind it, in ascending order of ``id_col``.

    ``tokenizer`` is the path of a tokenizers file that every executor can read; ``words_apart`` says that it
    drops white space and reads words apart. NULL identifiers come last; rows with one identifier are documents
    of their own, in the order of a hash of their texts and then as read; NULL and empty texts are ``end_id``
    alone. A very long text spans blocks. An empty table gives files without blocks. Other columns are not read, and
    clash with nothing. A task holds one batch of texts, the
    words of 6 MB of them, and the ids of one block.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col), F.col(text_col).alias("text_"))
    stored = scratch_path(spark, "chunks")
    _chunks(named, tokenizer, id_col, end_id, block_ids, words_apart).write.option("compression", "zstd").parquet(stored)
    chunks = spark.read.parquet(stored)
    frequencies = rans.scaled_frequencies(id_counts(chunks))
    table = spark.createDataFrame(sorted(frequencies.items()), "id int, frequency int")
    table.coalesce(1).write.parquet(f"{path}/frequencies")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = chunks.groupBy("part").agg(F.sum("n").alias("ids_")).select(
        "part", F.coalesce(F.sum("ids_").over(earlier), F.lit(0)).alias("before")
    )
    placed = chunks.join(F.broadcast(offsets), "part")
    docs_column = F.transform("docs", lambda d: d.withField("start", d["start"] + F.col("before")))
    listed = placed.select(
        "part", "no", (F.col("before") + F.col("no") * F.lit(block_ids).cast("long")).alias("first"), "n", docs_column.alias("docs"), "ids"
    )
    coder = rans.model(frequencies)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = _ids(row.column("ids")[0], row.column("n")[0].as_py())
                columns = [row.column(name) for name in ("part", "no", "first", "n", "docs")]
                columns += [pa.array([zlib.crc32(ids.astype("<u4"))], pa.int64()), pa.array([rans.encode(ids, coder)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "no", "first", "n", "docs", "ids_crc32", "block"])

    kind = listed.schema["docs"].dataType.simpleString()
    schema = f"part int, no int, first long, n int, docs {kind}, ids_crc32 long, block binary"
    listed.mapInArrow(code, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def _model(spark: SparkSession, path: str) -> rans.Model:
    return rans.model({r["id"]: r["frequency"] for r in spark.read.parquet(f"{path}/frequencies").collect()})


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: id, start (ids of all documents before it), n_tokens and ids_crc32."""
    coder, blocks = _model(spark, path), spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["docs"].dataType.elementType["id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = rans.decode(batch.column("block")[k].as_py(), coder).astype("<u4")
                if zlib.crc32(ids) != batch.column("ids_crc32")[k].as_py():
                    raise ValueError("the ids of a block do not match their checksum")
                docs = batch.column("docs")[k].values
                start, from_, length, total = (docs.field(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
                ends = np.cumsum(length)
                behind = 4 * (total - from_ - length)
                found = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), length.tolist())]
                found = [shifted(c, b) if b else c for c, b in zip(found, behind.tolist())]
                columns = [docs.field(0), pa.array(start), pa.array(total), pa.array(length, pa.int64()), pa.array(found, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "start", "total", "length", "crc"])

    parts = blocks.select("docs", "ids_crc32", "block").mapInArrow(
        check, f"id {id_type}, start long, total long, length long, crc long"
    )
    whole = parts.groupBy("id", "start", "total").agg(F.sum("length").alias("length"), F.bit_xor("crc").alias("crc"))
    lost = F.raise_error(F.lit("a document's parts are not all in the files")).cast("long")
    return whole.select(
        "id", "start", F.when(F.col("length") == F.col("total"), F.col("total")).otherwise(lost).alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )


def read_ids(spark: SparkSession, path: str, first: int, beyond: int) -> DataFrame:
    """(first, ids) of the ids from place ``first`` to before ``beyond``, one row per block, from its nearest checkpoint."""
    coder = _model(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks").filter((F.col("first") < beyond) & (F.col("first") + F.col("n") > first))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                skip = max(first - start, 0)
                ids = rans.decode(block, coder, skip, beyond - start)
                columns = [pa.array([start + skip], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["first", "ids"])

    return blocks.select("first", "block").mapInArrow(cut, "first long, ids array<long>")


def file_digests(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", **options) -> DataFrame:
    """Write the files, read them back: ``id_col``, start, n_tokens, ids_crc32 per document."""
    write_token_files(docs, tokenizer, path, id_col, **options)
    names = [fresh_name([id_col], n) for n in ("start", "n_tokens", "ids_crc32")]
    return read_documents(docs.sparkSession, path).toDF(id_col, *names)
