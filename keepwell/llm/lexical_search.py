"""Ranked lexical search by a dual tree over items and documents.

A document's terms that the items have become a sparse vector of impacts: weight times saturated frequency, in
integers. Documents are sorted by their strongest terms and cut into tiles, and a tile is a tree: its root, then
groups, then single documents, each node with the coordinate maxima of its documents. The items form a tree of
the same kind, with the maxima of their term counts. The bound of a pair of nodes, the inner product of both
maxima, is at least the score of every item and document below them. A pair whose bound does not reach the weakest
kth score of its items is dropped with all below it; of the others the parts are looked at, down to exact scores.
The kth scores that the items have after a first part of the documents are a start for the rest, and a pair that
reaches the score exactly is kept, so no document that can be among an item's best is lost, ties included. Items come
in blocks of bounded size; only a block's terms, counts and kth scores pass through the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.common import fresh_name
from keepwell.operators.ordering import running_totals
from keepwell.scratch import discard, materialise

K = 10
#: A block of items ends with the one that brings the sum of their different terms to this.
BLOCK_TERMS = 500_000
TILE_ROWS = 2048
GROUP = 32
#: One tile in so many is searched first, to learn kth scores.
FIRST_SHARE = 16
SLICE_ROWS = 256
#: Bytes of terms become lower case, all others a space: letters A to Z, digits, and all beyond ASCII are terms.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


@dataclass(frozen=True)
class ItemTree:
    """Items in an order that puts like ones together, and per level the nodes' bounds and count maxima.

    ``levels`` goes from the root to single items; node i of a level covers nodes ``first[i]`` to before
    ``first[i + 1]`` of the next. A node's terms are ``codes[at[i] : at[i + 1]]`` with their maxima.
    """

    rows: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _maxima(node: np.ndarray, code: np.ndarray, value: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greatest value per (node, code), sorted, and where each node starts."""
    order = np.lexsort((code, node))
    node, code, value = node[order], code[order], value[order]
    opens = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (code[1:] != code[:-1])]) if len(node) else np.empty(0, np.int64)
    top = np.maximum.reduceat(value, opens) if len(opens) else value
    return np.searchsorted(node[opens], np.arange(nodes + 1)), code[opens], top


def item_tree(rows: np.ndarray, items: list[dict[int, int]], fan: int = 8) -> ItemTree:
    """``items`` map codes to counts; every item has one at least."""
    order = sorted(range(len(items)), key=lambda i: sorted(items[i], reverse=True))
    node = np.repeat(np.arange(len(items)), [len(items[i]) for i in order])
    code = np.array([c for i in order for c in items[i]], np.int64)
    count = np.array([n for i in order for n in items[i].values()], np.int64)
    levels, nodes, first = [], len(items), np.arange(len(items) + 1)
    while True:
        at, codes, tops = _maxima(node, code, count, nodes)
        levels.insert(0, (first, at, codes, tops))
        if nodes == 1:
            return ItemTree(rows[order], levels)
        node, code, count = np.repeat(np.arange(nodes), np.diff(at)) // fan, codes, tops
        first, nodes = np.minimum(np.arange(-(-nodes // fan) + 1) * fan, nodes), -(-nodes // fan)


def _products(dense: np.ndarray, level: tuple, nodes: np.ndarray) -> np.ndarray:
    """Inner products of a dense vector with the given nodes of a level."""
    _, at, codes, tops = level
    sizes = at[nodes + 1] - at[nodes]
    ends = np.cumsum(sizes)
    places = np.repeat(at[nodes] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    sums = np.concatenate(([0], np.cumsum(dense[codes[places]] * tops[places])))
    return sums[ends] - sums[ends - sizes]


class Search:
    """Best documents of every item over the tiles of one task; ``start`` holds scores known to be reached."""

    def __init__(self, tree: ItemTree, vocabulary: int, k: int, start: np.ndarray):
        self.tree, self.k, self.start = tree, k, start
        self.dense = np.zeros(vocabulary, np.int64)
        self.scores = np.zeros((len(tree.rows), k), np.int64)  # ascending per item; 0: none yet
        self.learn()

    def learn(self) -> None:
        """Per node of the item tree, what a score must reach: the weakest kth score below it, and 1 at least."""
        least = np.maximum(np.maximum(self.scores[:, 0], self.start), 1)
        self.least = [least]
        for first, *_ in reversed(self.tree.levels[:-1]):
            least = np.minimum.reduceat(least, first[:-1])
            self.least.insert(0, least)

    def reachable(self, codes: np.ndarray, tops: np.ndarray) -> np.ndarray:
        """The items for which a document node with these maxima can hold one of the best."""
        self.dense[codes] = tops
        nodes = np.arange(1)
        for depth, level in enumerate(self.tree.levels):
            nodes = nodes[_products(self.dense, level, nodes) >= self.least[depth][nodes]]
            if depth + 1 < len(self.tree.levels) and len(nodes):
                first = level[0]
                sizes = first[nodes + 1] - first[nodes]
                ends = np.cumsum(sizes)
                nodes = np.repeat(first[nodes] - (ends - sizes), sizes) + np.arange(ends[-1])
        self.dense[codes] = 0
        return nodes

    def exact(self, codes: np.ndarray, impacts: np.ndarray, items: np.ndarray) -> np.ndarray:
        self.dense[codes] = impacts
        found = _products(self.dense, self.tree.levels[-1], items)
        self.dense[codes] = 0
        return found

    def tile(self, at: np.ndarray, codes: np.ndarray, impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, document, score) of the best of one tile, at most k per item, smaller documents first in ties.

        Document i has ``codes[at[i] : at[i + 1]]`` with their impacts. Groups go by falling sum of maxima.
        """
        n = len(at) - 1
        owner = np.repeat(np.arange(n), np.diff(at))
        _, top_codes, tops = _maxima(np.zeros_like(owner), codes, impacts, 1)
        none = np.empty(0, np.int64)
        found = [(none, none, none)]
        if len(self.reachable(top_codes, tops)):
            g_at, g_codes, g_tops = _maxima(owner // GROUP, codes, impacts, -(-n // GROUP))
            sums = np.concatenate(([0], np.cumsum(g_tops)))[g_at]
            for g in np.argsort(sums[:-1] - sums[1:], kind="stable").tolist():
                part = slice(g_at[g], g_at[g + 1])
                near = self.reachable(g_codes[part], g_tops[part])
                if not len(near):
                    continue
                docs = np.arange(g * GROUP, min((g + 1) * GROUP, n))
                values = np.stack([self.exact(codes[at[d] : at[d + 1]], impacts[at[d] : at[d + 1]], near) for d in docs])
                i, j = np.nonzero(values >= self.least[-1][near])
                found.append((near[j], docs[i], values[i, j]))
                self.scores[near] = np.sort(np.concatenate((self.scores[near], values.T), axis=1), axis=1)[:, -self.k :]
                self.learn()
        item, doc, score = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        best = place < self.k
        return item[best], doc[best], score[best]


def _item_terms(items: DataFrame, text_col: str) -> DataFrame:
    """(row, terms, counts) of the items that have a term; rows are those of the written table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r, Counter(terms(t))) for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            found = [(r, list(c), list(c.values())) for r, c in found if c]
            kinds = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            columns = list(zip(*found)) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "terms", "counts"])

    return items.select("row", text_col).mapInArrow(count, "row long, terms array<binary>, counts array<long>")


def _postings(docs: DataFrame, id_col: str, text_col: str, codes: dict[bytes, int]) -> DataFrame:
    """(id_, n, codes, tfs) of every document with a term: its terms of the vocabulary, as arrays of 4 bytes each."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(at, SLICE_ROWS)
                sizes, lists = [], []
                for text in some.column(1).to_pylist():
                    words = terms(text)
                    known = np.fromiter(map(codes.get, words, repeat(-1)), np.int64, len(words))
                    sizes.append(len(words))
                    lists.append(np.unique(known[known >= 0], return_counts=True))
                held = pa.array([n > 0 for n in sizes])
                columns = [some.column(0), pa.array(sizes, pa.int64())]
                columns += [pa.array([x[i].astype("<u4").tobytes() for x in lists], pa.binary()) for i in range(2)]
                yield pa.RecordBatch.from_arrays([c.filter(held) for c in columns], ["id_", "n", "codes", "tfs"])

    return docs.select(id_col, text_col).mapInArrow(read, f"id_ {id_type}, n long, codes binary, tfs binary")


def _lists(column: pa.BinaryArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(cell.as_buffer(), kind).astype(np.int64) for cell in column]


def _document_counts(postings: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for held in _lists(batch.column(0), "<u4"):
                total[held] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    found = postings.select("codes").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    result = np.zeros(size, np.int64)
    for r in found.collect():
        result[r["code"]] = r["n"]
    return result


def _impacts(postings: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(id_, codes, impacts, lead, second): impacts of 8 bytes each, and the codes of the two strongest terms."""
    id_type = postings.schema["id_"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = 25 + 75 * batch.column(1).to_numpy() * n_docs // n_terms
            impacts, leads = [], []
            for held, tf, m in zip(_lists(batch.column(2), "<u4"), _lists(batch.column(3), "<u4"), length):
                impact = weights[held] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                strong = held[np.argsort(-impact, kind="stable")[:2]].tolist() + [-1, -1]
                impacts.append(impact.astype("<i8").tobytes())
                leads.append(strong[:2])
            columns = [batch.column(0), batch.column(2), pa.array(impacts, pa.binary())]
            columns += [pa.array([x[i] for x in leads], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, ["id_", "codes", "impacts", "lead", "second"])

    schema = f"id_ {id_type}, codes binary, impacts binary, lead long, second long"
    return postings.select("id_", "n", "codes", "tfs").mapInArrow(weigh, schema)


def _best(docs: DataFrame, tree: ItemTree, vocabulary: int, k: int, start: np.ndarray, tile_rows: int) -> DataFrame:
    """(row, id_, score): per tile the at most k best documents of every item."""
    id_type = docs.schema["id_"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Search(tree, vocabulary, k, start)
        for batch in batches:
            for at in range(0, batch.num_rows, tile_rows):
                some = batch.slice(at, tile_rows)
                ids = some.column(0).to_pylist()
                nulls = [i for i, x in enumerate(ids) if x is None]
                order = sorted((i for i, x in enumerate(ids) if x is not None), key=ids.__getitem__) + nulls
                some = some.take(pa.array(order))
                held, impacts = _lists(some.column(1), "<u4"), _lists(some.column(2), "<i8")
                ends = np.concatenate(([0], np.cumsum([len(x) for x in held])))
                item, doc, score = state.tile(ends, np.concatenate(held), np.concatenate(impacts))
                columns = [pa.array(tree.rows[item]), some.column(0).take(pa.array(doc)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "id_", "score"])

    return docs.select("id_", "codes", "impacts").mapInArrow(search, f"row long, id_ {id_type}, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id_").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(
    docs: DataFrame, block: Sequence, k: int, id_col: str, text_col: str, tile_rows: int, first_share: int
) -> DataFrame | None:
    """(row, id_, score, rank) of the items of one block, given as rows (row, terms, counts)."""
    codes: dict[bytes, int] = {}
    items = [{codes.setdefault(bytes(t), len(codes)): n for t, n in zip(b["terms"], b["counts"])} for b in block]
    tree = item_tree(np.array([b["row"] for b in block], np.int64), items)
    postings = materialise(_postings(docs, id_col, text_col, codes), "postings")
    n_docs, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    holding = _document_counts(postings, len(codes)).tolist()
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holding], np.int64)
    weighed = _impacts(postings.filter(F.length("codes") > 0), weights, n_docs, n_terms)
    weighed = weighed.withColumn("number", F.monotonically_increasing_id())
    by = ["lead", "second", "number"]
    sorted_docs = materialise(weighed.repartitionByRange(*by).sortWithinPartitions(*by), "impacts")
    discard(postings)
    is_first = F.pmod(F.xxhash64("number"), F.lit(first_share)) == 0
    start = np.zeros(len(block), np.int64)
    first = materialise(_best(sorted_docs.filter(is_first), tree, len(codes), k, start, tile_rows), "first")
    reached = {r["row"]: r["score"] for r in _top(first, k).filter(F.col("rank") == k).select("row", "score").collect()}
    start = np.array([reached.get(r, 0) for r in tree.rows.tolist()], np.int64)
    rest = materialise(_best(sorted_docs.filter(~is_first), tree, len(codes), k, start, tile_rows), "rest")
    discard(sorted_docs)
    return _top(first.unionByName(rest), k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
    tile_rows: int = TILE_ROWS,
    first_share: int = FIRST_SHARE,
) -> DataFrame:
    """Per item its ``k`` best documents with a score above 0: ``item_col``, rank (from 1), ``id_col``, score.

    Every row of ``items`` is an item of its own, repeated ones too, and so is every row of ``docs``. Equal scores
    rank by identifier, NULL last. Texts are read whole; NULL and empty texts have no terms: such items have no
    results, such documents count nowhere. Either table may be empty. Other columns are not read; result names that clash
    get underscores in front. Documents are read once per block of items.
    """
    names = [fresh_name([item_col, id_col], n) for n in ("rank", "score")]
    numbered = items.select(F.col(item_col).alias("item_"), F.col(item_text_col).alias("text_"))
    stored = materialise(numbered.withColumn("row", F.monotonically_increasing_id()), "items")
    listed = materialise(_item_terms(stored, "text_"), "item-terms")
    sized = listed.select("row", F.size("terms").cast("long").alias("size"))
    dealt = running_totals(sized, [F.col("row")], {"upto": F.col("size")})
    block = F.floor((F.col("upto") - F.col("size")) / block_terms)
    dealt = materialise(dealt.select("row", block.alias("block")), "blocks")
    found = None
    for number in sorted(r["block"] for r in dealt.select("block").distinct().collect()):
        part = listed.join(dealt.filter(F.col("block") == number), "row").collect()
        best = _search_block(docs, part, k, id_col, text_col, tile_rows, first_share)
        if best is not None:
            found = best if found is None else found.unionByName(best)
    if found is None:
        kinds = [items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()]
        schema = f"`{item_col}` {kinds[0]}, {names[0]} int, `{id_col}` {kinds[1]}, {names[1]} long"
        return docs.sparkSession.createDataFrame([], schema)
    return found.join(stored.select("row", "item_"), "row").select(
        F.col("item_").alias(item_col), F.col("rank").cast("int").alias(names[0]), F.col("id_").alias(id_col),
        F.col("score").alias(names[1]),
    )
