"""Sum-of-squares packing of documents into fixed windows of tokens.

Every task packs the documents of its own partition, in their order. A document's tokens beyond whole
windows go to the fill level for which the sum of squared counts of partially filled windows becomes
smallest; the counts per level are held in an array. At the end of a partition the windows still open
are joined end to end and cut anew into full windows, and what is left, less than one window, becomes
sequences of power-of-two lengths, which need no padding. So padding is zero however the rows are
partitioned, and no state leaves a task; a task that runs again makes its sequences again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import fresh_name
from keepwell.llm.tokens import encoder

CAPACITY = 1024
END_ID = 0
#: Sequences of one partition are numbered from its number times this.
PARTITION_STEP = 1 << 33
FLUSH_SEQUENCES = 1_000
ENCODE_ROWS = 256


@dataclass(frozen=True)
class Piece:
    doc: object
    start: int
    doc_tokens: int
    ids: np.ndarray


class Packer:
    """Windows of one partition; ``take`` gives the closed sequences as lists of pieces."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.closed: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """Fill level that takes ``size`` tokens; 0 is a new window. Ties go to the fullest level."""
        cap, n = self.capacity, self.counts
        change = 2 * (n[size : cap + 1] - n[: cap + 1 - size]) + 2
        change[0] = 2 * n[size] + 1
        change[-1] = 1 - 2 * n[cap - size] if size < cap else 0
        change[1:][n[1 : cap + 1 - size] == 0] = np.iinfo(np.int64).max
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def add(self, doc: object, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.capacity
        for at in range(0, whole, self.capacity):
            self.closed.append([Piece(doc, at, len(ids), ids[at : at + self.capacity])])
        if whole == len(ids):
            return
        size = len(ids) - whole
        level = self.level_for(size)
        window = self.open[level].pop() if level else []
        self.counts[level] -= level > 0
        window.append(Piece(doc, whole, len(ids), ids[whole:].copy()))
        if level + size == self.capacity:
            self.closed.append(window)
        else:
            self.open.setdefault(level + size, []).append(window)
            self.counts[level + size] += 1

    def finish(self) -> None:
        """Close all windows: full ones, then the powers of two that the rest is the sum of."""
        rest = [p for level in sorted(self.open, reverse=True) for w in self.open[level] for p in w]
        total = sum(len(p.ids) for p in rest)
        lengths = [self.capacity] * (total // self.capacity)
        left = total % self.capacity
        lengths += [1 << b for b in reversed(range(left.bit_length())) if left >> b & 1]
        self.open.clear()
        self.counts[:] = 0
        pieces = iter(rest)
        piece = None
        for length in lengths:
            window, room = [], length
            while room:
                piece = piece if piece is not None else next(pieces)
                taken, over = piece.ids[:room], piece.ids[room:]
                window.append(Piece(piece.doc, piece.start, piece.doc_tokens, taken))
                room -= len(taken)
                piece = Piece(piece.doc, piece.start + len(taken), piece.doc_tokens, over) if len(over) else None
            self.closed.append(window)

    def take(self) -> list[list[Piece]]:
        closed, self.closed = self.closed, []
        return closed


def _rows(sequences: list[list[Piece]], first: int, schema: pa.Schema) -> pa.RecordBatch:
    """One row per piece, with the columns of the schema: all of them, or all but the ids."""
    columns: list[list] = [[] for _ in schema]
    for number, pieces in enumerate(sequences, first):
        offset = 0
        for p in pieces:
            ids = np.ascontiguousarray(p.ids, dtype="<u4")
            row = (p.doc, p.start, len(ids), zlib.crc32(ids), p.doc_tokens, number, offset, ids.view("<i4"))
            for column, value in zip(columns, row):
                column.append(value)
            offset += len(ids)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset and, unless
    ``with_ids`` is false, the piece's ``ids``.

    ``tokenizer`` is the path of a tokenizers file that every executor can read. A document is its ids without
    added special tokens, then ``end_id``; NULL and empty texts are ``end_id`` alone. Rows are taken one
    by one: NULL and repeated identifiers and repeated rows are documents of their own. Other columns are not
    read. An empty table gives an empty result. ``capacity`` is a power of two. A task holds one batch of texts and its open windows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [fresh_name([id_col], n) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    columns = [f"`{id_col}` {id_type}", *[f"{n} long" for n in names]]
    ids_name = fresh_name([id_col], "ids")
    if with_ids:
        columns.append(f"{ids_name} array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        packer, number = Packer(capacity), TaskContext.get().partitionId() * PARTITION_STEP
        kinds, id_kind = [pa.int64()] * 6, pa.null()

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            sequences = packer.take()
            fields = list(zip([id_col, *names], [id_kind, *kinds]))
            schema = pa.schema([*fields, (ids_name, pa.list_(pa.int32()))] if with_ids else fields)
            batch = _rows(sequences, number, schema)
            number += len(sequences)
            yield batch

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, ENCODE_ROWS):
                part = batch.slice(at, ENCODE_ROWS)
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    packer.add(doc, np.append(ids, np.uint32(end_id)))
                if len(packer.closed) >= FLUSH_SEQUENCES:
                    yield from flushed()
        packer.finish()
        if packer.closed:
            yield from flushed()

    return docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("text_")).mapInArrow(run, ", ".join(columns))
