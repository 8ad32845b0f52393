"""Spelling variants: words within one edit, found by dynamic programming along sorted lists.

The vocabulary is range-partitioned, sorted and cut into tiles; each word, as a query, visits the tiles that can
hold words with its first half. A tile is scanned as the tree that the common prefixes of neighbours in the
sorted list span: per query the band of the edit matrix around the diagonal is kept for a prefix, reused by all
words that share it, and a whole range is skipped as soon as every cell of its row exceeds one edit. All queries
of a task go down together, as arrays. Words that differ within the first half share the second one, so
the same is done once more with all words reversed. Queries of a tile are dealt to chunks, so a prefix that very
many words share is spread; each chunk sees a tile of bounded size.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.scratch import materialise

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
ERROR_RATE = 31
TILE_WORDS = 8192
#: There are at most about this many tiles, however large the vocabulary; their limits are what is broadcast.
MOST_TILES = 1 << 14
LIMIT_CHARS = 64
CHUNK_QUERIES = 8192
SLICE_ROWS = 256
COUNTED_WORDS = 200_000
WITHIN_TASK = 1 << 32
LAST = "\U0010ffff"


def word_runs(doc_id: object, text: str | None, length: int = MIN_LENGTH) -> Counter:
    """Words of at least ``length`` code points with their occurrences, some with one code point deleted.

    Only A-Z are lower-cased. A run loses a code point if ``ERROR_RATE`` divides the CRC-32 of identifier, colon
    and run; a NULL identifier is written as nothing.
    """
    text = text or ""
    lower = text.lower() if text.isascii() else text.encode().lower().decode()
    runs = Counter(re.findall("[a-zÀ-ÿ]{%d,}" % length, lower))
    seed = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    found: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), seed)
        if h % ERROR_RATE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= length:
            found[run] += n
    return found


def document_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = MIN_LENGTH) -> DataFrame:
    """(word, n) of all documents, counted within tasks; NULL texts have no words, repeated rows count each time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(at, SLICE_ROWS)
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    held.update(word_runs(doc, text, length))
                if len(held) > COUNTED_WORDS:
                    yield flushed()
        yield flushed()

    return docs.select(id_col, text_col).mapInArrow(count, "word string, n long")


class SortedWords:
    """A sorted list of different words as the tree of their common prefixes, level by level.

    Level d has one node per different prefix of d + 1 code points, in order: where its range of words starts, and
    its last code point; the node's children are a range of the next level's nodes.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.common = np.zeros(len(words), np.int64)  # with the word before
        for i, (a, b) in enumerate(zip(words, words[1:]), 1):
            n = min(len(a), len(b))
            if a[:n] == b[:n]:
                self.common[i] = n
            else:
                self.common[i] = next(k for k in range(n) if a[k] != b[k])
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.long, self.short_of = np.arange(len(words)), self.common

    def level(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, code point) of the nodes for prefixes of ``depth`` + 1 code points; a range ends before the next start."""
        while len(self.levels) <= depth:
            d = len(self.levels)
            self.long = self.long[self.lengths[self.long] > d]
            starts = self.long[self.common[self.long] <= d]
            self.levels.append((starts, self.points[self.offsets[starts] + d]))
        return self.levels[depth]


def near_words(queries: list[str], tree: SortedWords, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of all pairs one edit apart that share the query's first ``halves`` code points.

    The band of row d, for a prefix of d code points, holds its edit distances to d - 1, d and d + 1 code points
    of the query; 2 stands for more than one edit.
    """
    lengths = np.array([len(q) for q in queries], np.int64)
    offsets = np.cumsum(lengths) - lengths
    points = np.concatenate((np.frombuffer("".join(queries).encode("utf-32-le"), np.uint32), [0]))
    words = np.array(tree.words, dtype=object)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def points_at(q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Code point of each query at a place; beyond its end one that no word has."""
        inside = (at >= 0) & (at < lengths[q])
        return np.where(inside, points[np.where(inside, offsets[q] + at, 0)], np.uint32(0xFFFFFFFF))

    # Queries enter at the depth of their half, with the range of the words that begin with it.
    entering = {int(h): np.flatnonzero(halves == h) for h in np.unique(halves)}
    query = low = high = np.empty(0, np.int64)
    band = np.empty((0, 3), np.int8)
    for depth in range(int(min(halves, default=0)), int(max(tree.lengths.max(initial=0), halves.max(initial=0))) + 1):
        if depth in entering:
            new = entering.pop(depth)
            first = np.searchsorted(words, np.array([queries[i][:depth] for i in new], dtype=object))
            beyond = np.searchsorted(words, np.array([queries[i][:depth] + LAST for i in new], dtype=object))
            new, first, beyond = (x[first < beyond] for x in (new, first, beyond))
            query, low, high = np.r_[query, new], np.r_[low, first], np.r_[high, beyond]
            band = np.concatenate((band, np.tile(np.array([[1, 0, 1]], np.int8), (len(new), 1))))
        if not len(query):
            if not entering:
                break
            continue
        # The word that ends here comes first in its range.
        over = lengths[query] - depth
        ends = (tree.lengths[low] == depth) & (np.abs(over) <= 1)
        hit = np.flatnonzero(ends)
        hit = hit[band[hit, over[hit] + 1] == 1]
        found.append((query[hit], low[hit]))
        # Ranges fall into those of the next code point; the band moves one row down.
        starts, chars = tree.level(depth)
        a, b = np.searchsorted(starts, low), np.searchsorted(starts, high)
        sizes = b - a
        total = np.cumsum(sizes)
        node = np.repeat(a - (total - sizes), sizes) + np.arange(total[-1])
        back = np.repeat(np.arange(len(query)), sizes)
        parent_high, query, above = high[back], query[back], band[back]
        low = starts[node]
        high = np.minimum(np.append(starts, len(words))[node + 1], parent_high)
        c = chars[node]
        band = np.empty_like(above)
        left = np.minimum(above[:, 0] + (c != points_at(query, np.full(len(query), depth - 1))), above[:, 1] + 1)
        middle = np.minimum(np.minimum(above[:, 1] + (c != points_at(query, np.full(len(query), depth))), above[:, 2] + 1), left + 1)
        right = np.minimum(above[:, 2] + (c != points_at(query, np.full(len(query), depth + 1))), middle + 1)
        for k, column in enumerate((left, middle, right)):
            band[:, k] = np.minimum(column, 2)
        alive = band.min(axis=1) <= 1
        query, low, high, band = query[alive], low[alive], high[alive], band[alive]
    if not found:
        return query, low
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _tiles(keyed: DataFrame, tile_words: int) -> DataFrame:
    """Sorted words of a side, cut: (tile, side, keys, ns, low, high), the last two the cut limits."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() * WITHIN_TASK, []

        def tile(rows: list[tuple]) -> pa.RecordBatch:
            sides, keys, ns = (list(c) for c in zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.string(), pa.string()]
            values = [number, sides[0], keys, ns, keys[0][:LIMIT_CHARS], keys[-1][:LIMIT_CHARS] + LAST]
            names = ["tile", "side", "keys", "ns", "low", "high"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and (len(held) == tile_words or row[0] != held[0][0]):
                    yield tile(held)
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield tile(held)

    ranged = keyed.repartitionByRange("side", "key").sortWithinPartitions("side", "key")
    return ranged.mapInArrow(cut, "tile long, side int, keys array<string>, ns array<long>, low string, high string")


def _visits(keyed: DataFrame, limits: list) -> DataFrame:
    """(tile, key): every word with every tile that can hold words with its first half."""
    sides = [sorted((r["low"], r["high"], r["tile"]) for r in limits if r["side"] == side) for side in range(2)]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = [[x[0] for x in side] for side in sides]
        highs = [[x[1] for x in side] for side in sides]
        for batch in batches:
            tiles, keys = [], []
            for side, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                half = key[: len(key) // 2]
                for k in range(bisect_left(highs[side], half), bisect_right(lows[side], half + LAST)):
                    tiles.append(sides[side][k][2])
                    keys.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(tiles, pa.int64()), pa.array(keys, pa.string())], ["tile", "query"])

    return keyed.select("side", "key").mapInArrow(visit, "tile long, query string")


def _best_near(queries: list[str], keys: list[str], ns: np.ndarray, backwards: bool) -> list[tuple]:
    """(word, number of near words, their largest n, the smallest word with it) of the queries that have any here."""
    halves = np.array([len(q) // 2 for q in queries], np.int64)
    query, key = near_words(queries, SortedWords(keys), halves)
    words = [k[::-1] for k in keys] if backwards else keys
    asked = [q[::-1] for q in queries] if backwards else queries
    if backwards:  # pairs with the same first half as well are found forwards
        pairs = zip(query.tolist(), key.tolist())
        new = np.array([words[k][: halves[q]] != asked[q][: halves[q]] for q, k in pairs], dtype=bool)
        query, key = query[new], key[new]
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[key], -ns[key], query))
    query, key = query[order], key[order]
    opens = np.flatnonzero(np.diff(query, prepend=-1))
    sizes = np.diff(opens, append=len(query))
    return [(asked[query[i]], int(n), int(ns[key[i]]), words[key[i]]) for i, n in zip(opens.tolist(), sizes.tolist())]


def near_counts(vocabulary: DataFrame, tile_words: int = TILE_WORDS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """(word, n_near, most, nearest) of the words that have near ones; ``vocabulary`` has one row (word, n) per word."""
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("key")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("key")))
    keyed = vocabulary.select("n", F.inline(sides)).select("side", "key", "n")
    size = max(tile_words, -(-vocabulary.count() // MOST_TILES))
    tiles = materialise(_tiles(keyed, size), "tiles")
    visits = materialise(_visits(keyed, tiles.select("tile", "side", "low", "high").collect()), "visits")
    chunks = visits.groupBy("tile").agg(F.ceil(F.count("*") / chunk_queries).cast("int").alias("chunks"))
    chunks = materialise(chunks, "chunks")  # one row per tile, whose number is bounded
    chunk = F.pmod(F.xxhash64("query"), F.col("chunks")).alias("chunk")
    asked = visits.join(F.broadcast(chunks), "tile").groupBy("tile", chunk).agg(F.collect_list("query").alias("queries"))
    work = materialise(asked, "queries").join(tiles, "tile").select("side", "queries", "keys", "ns")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for k in range(batch.num_rows):
                side, queries, keys, ns = (batch.column(i)[k].as_py() for i in range(4))
                rows = _best_near(queries, keys, np.array(ns, np.int64), side == 1)
                columns = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], ["word", "n_near", "most", "nearest"]
                )

    found = work.mapInArrow(scan, "word string, n_near long, most long, nearest string")
    best = F.min(F.struct((-F.col("most")).alias("most"), "nearest"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", (-F.col("best.most")).alias("most"), "best.nearest")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last by doubling; counts rise along them, so they end."""
    state = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("next"), F.col("root").alias("beyond"))
        moved = state.join(further, state["root"] == further["next"], "left")
        moved = materialise(moved.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def spelling_groups(
    counts: DataFrame,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    tile_words: int = TILE_WORDS,
    chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """Per word with ``min_count`` occurrences: word, form, root, n, n_near, form_n.

    ``counts`` has (word, n); repeated words are added up, NULL words left out, other columns not read. Words are near if one code point is
    inserted, deleted or replaced. The form of a word is its near word of largest n, the smaller word in a tie, if
    that n is at least ``ratio`` times the word's; the root is the last word that forms lead to, the word itself
    without one. A very long word is a query and a list entry like any other. An empty table gives an empty result.
    """
    added = counts.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = materialise(added.filter(F.col("n") >= min_count), "vocabulary")
    near = near_counts(vocabulary, tile_words, chunk_queries)
    has_form = F.col("most") >= ratio * F.col("n")
    joined = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has_form, F.col("nearest")).alias("form"), F.when(has_form, F.col("most")).alias("form_n"),
    )
    joined = materialise(joined, "forms")
    roots = _roots(joined.filter("form IS NOT NULL"))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
