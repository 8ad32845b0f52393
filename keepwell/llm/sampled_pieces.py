"""Sampled SentencePiece segmentations by forward filtering and backward sampling, and their decoding.

The lattice of a text has a node between all characters and an edge for every piece of the vocabulary. A path
has the product of its pieces' weights, a piece's weight being its rank to the power of minus ``alpha``:
the file's scores are ranks of merges, not probabilities. Forward sums give every node its weight; from the
end, one incoming edge after the other is drawn in proportion. No piece has a space after another
character, so each path passes every place where a space follows one, and the lattice falls apart into
those of words; their forward sums are kept in a bounded cache, and the words of a batch are sampled
together, one step of all at a time. A text without spaces is one long word; the rest of words that are much longer than
the others is stepped edge by edge, so that such texts take time in proportion to their length, at a few millionths
of a second for each character.

A draw depends on the seed, the row's key and the character place alone, so a row has the same
segmentation in every run and on every partitioning. Characters without a piece become bytes, the character that stands for
the space in pieces too, so decoding gives back every text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import fresh_name, put

SPACE = "▁"
WORD = re.compile(" *[^ ]+| +")
#: Bounds of the cache of one worker process.
CACHED_WORDS = 600_000
CACHED_NODES = 6_000_000
BATCH_CHARS = 400_000
#: Where no more than FEW edges or words are left for at least LONG steps, they are taken one by one instead of in arrays.
FEW = 32
LONG = 64
#: Forward sums below SMALL are scaled; with weights above 32000 ** -MOST_ALPHA none gets lost before.
SMALL = 1e-60
MOST_ALPHA = 4


class Vocabulary:
    """Pieces with plain spaces as a trie in arrays, their weights, and the bytes they stand for."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        if not 0 <= alpha <= MOST_ALPHA:
            raise ValueError(f"alpha is between 0 and {MOST_ALPHA}")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.table: list[bytes] = []
        self.pieces: dict[str, int] = {}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        first = 1 + max(i for i in range(size) if model.is_byte(i))
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.table.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.table.append(b"")
            else:
                plain = piece.replace(SPACE, " ")
                self.table.append(plain.encode())
                self.pieces[plain] = i
        self.weights = np.full(size, float(size)) ** -alpha
        self.weights[first:] = (np.arange(first, size) - first + 2.0) ** -alpha
        self.longest = max(map(len, self.pieces))
        self.single = np.zeros(0x110000, dtype=bool)
        self.single[[ord(p) for p in self.pieces if len(p) == 1]] = True
        if not all(self.single[ord(c)] for p in self.pieces for c in p):
            raise ValueError("a character of a piece is not a piece itself")
        states = {"": 0}
        for piece in self.pieces:
            for end in range(1, len(piece) + 1):
                states.setdefault(piece[:end], len(states))
        keys = np.array([(states[x[:-1]] << 21) + ord(x[-1]) for x in states if x], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.next = np.array([state for x, state in states.items() if x], dtype=np.int64)[order]
        self.piece_at = np.full(len(states), -1, dtype=np.int32)
        self.piece_at[[states[p] for p in self.pieces]] = list(self.pieces.values())

    def symbols(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of all words, or -1 - byte for the bytes of a character without a piece; and lengths."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array(list(map(len, words)), dtype=np.int64)
        known = self.single[points]
        if known.all():
            return points, lengths
        sizes = np.where(known, 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        at = np.cumsum(sizes) - sizes
        spread, n = np.repeat(points, sizes), np.repeat(sizes, sizes)
        behind = n - 1 - (np.arange(len(spread)) - np.repeat(at, sizes))  # bytes of the character that follow
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n] | (spread >> 6 * (n - 1))
        octets = np.where(behind == n - 1, lead, 0x80 | (spread >> 6 * behind & 0x3F))
        symbols = np.where(np.repeat(known, sizes), spread, -1 - octets)
        return symbols, np.add.reduceat(sizes, np.cumsum(lengths) - lengths)

    def edges(self, symbols: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol where it starts, number of symbols, piece) of every edge; ``room``: symbols to the word's end."""
        octets = np.flatnonzero(symbols < 0)
        found = [(octets, np.ones_like(octets), self.byte_ids[-1 - symbols[octets]])]
        at = np.flatnonzero(symbols >= 0)
        state, depth = np.zeros(len(at), dtype=np.int64), 0
        while len(at):
            key = (state << 21) + symbols[at + depth]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[place] == key
            at, state = at[hit], self.next[place[hit]]
            depth += 1
            whole = self.piece_at[state] >= 0
            found.append((at[whole], np.full(np.count_nonzero(whole), depth), self.piece_at[state[whole]]))
            more = room[at] > depth
            at, state = at[more], state[more]
            more = symbols[at + depth] >= 0
            at, state = at[more], state[more]
        return tuple(np.concatenate(column) for column in zip(*found))


class Lattices:
    """Forward sums of words in arrays, node after node.

    A word has a node before its first and after each symbol. The edges into node n lie from ``first[n]``
    on, with running sums of their shares, plus n, in ``sums``; the last of them is n + 1.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.known = self.nodes = self.edges = 0
        self.bases, self.lasts, self.first = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.sums = np.zeros(1 << 16)
        self.sources, self.pieces = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)

    def learn(self, words: set[str]) -> None:
        """Build the lattices of new words together, one node of each at a time."""
        if len(self.words) > CACHED_WORDS or self.nodes > CACHED_NODES:
            self.clear()
        new = list(words.difference(self.words))
        if not new:
            return
        symbols, lengths = self.vocabulary.symbols(new)
        bases = np.cumsum(lengths + 1) - (lengths + 1)
        offset = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        before = np.repeat(bases, lengths) + offset
        start, span, piece = self.vocabulary.edges(symbols, np.repeat(lengths, lengths) - offset)
        end, depth = before[start] + span, offset[start] + span
        order = np.lexsort((end, depth))
        end, source, piece, depth = end[order], before[start[order]], piece[order], depth[order]
        sums = self._forward(end, source, self.vocabulary.weights[piece], depth, bases, len(symbols) + len(new))
        order = np.argsort(end, kind="stable")
        counts = np.bincount(end, minlength=len(symbols) + len(new))
        self.first = put(self.first, self.nodes, self.edges + np.cumsum(counts) - counts)
        self.sums = put(self.sums, self.edges, (sums + self.nodes)[order])
        self.sources = put(self.sources, self.edges, (source + self.nodes)[order])
        self.pieces = put(self.pieces, self.edges, piece[order])
        self.bases = put(self.bases, self.known, bases + self.nodes)
        self.lasts = put(self.lasts, self.known, bases + lengths + self.nodes)
        self.words.update(zip(new, range(self.known, self.known + len(new))))
        self.known += len(new)
        self.nodes += len(symbols) + len(new)
        self.edges += len(end)

    def _forward(
        self, end: np.ndarray, source: np.ndarray, weight: np.ndarray, depth: np.ndarray, bases: np.ndarray, nodes: int
    ) -> np.ndarray:
        """Node plus running share for every edge; edges come by depth of their end, then by end."""
        forward, sums = np.zeros(nodes), np.empty(len(end))
        forward[bases] = 1.0
        is_base = np.zeros(nodes + 1, dtype=bool)
        is_base[bases] = True
        per_depth = np.bincount(depth)[1:]
        cuts = np.concatenate(([0], np.cumsum(per_depth)))
        crowded = np.flatnonzero(per_depth > FEW)
        stepped = int(crowded[-1]) + 1 if len(crowded) else 0
        if len(per_depth) - stepped < LONG:
            stepped = len(per_depth)
        for low, high in zip(cuts[:stepped], cuts[1 : stepped + 1]):
            ends = end[low:high]
            heads = np.flatnonzero(np.diff(ends, prepend=-1))
            group = np.cumsum(np.diff(ends, prepend=-1) != 0) - 1
            shares = forward[source[low:high]] * weight[low:high]
            totals = np.add.reduceat(shares, heads)
            running = np.cumsum(shares / totals[group]) - group
            running[np.append(heads[1:], len(ends)) - 1] = 1.0
            sums[low:high] = ends + np.clip(running, 0.0, 1.0)
            forward[ends[heads]] = totals
            small = totals < SMALL
            if small.any():
                node, by = ends[heads][small], totals[small]
                for _ in range(self.vocabulary.longest + 1):
                    forward[node] /= by
                    inner = ~is_base[node]
                    node, by = node[inner] - 1, by[inner]
        if stepped < len(per_depth):
            rest = cuts[stepped]
            sums[rest:] = self._forward_few(end[rest:], source[rest:], weight[rest:], forward, is_base)
        return sums

    def _forward_few(
        self, end: np.ndarray, source: np.ndarray, weight: np.ndarray, forward: np.ndarray, is_base: np.ndarray
    ) -> list[float]:
        """The same for the ends of long words, where a depth has too few edges for arrays: one edge at a time."""
        ahead, sums = forward.tolist(), []
        ends, sources, weights = end.tolist(), source.tolist(), weight.tolist()
        at, stop = 0, len(ends)
        while at < stop:
            node, shares = ends[at], []
            while at < stop and ends[at] == node:
                shares.append(ahead[sources[at]] * weights[at])
                at += 1
            total = sum(shares)
            running = 0.0
            for share in shares[:-1]:
                running += share / total
                sums.append(node + min(running, 1.0))
            sums.append(node + 1.0)
            ahead[node] = total
            if total < SMALL:
                for n in range(node, node - self.vocabulary.longest - 1, -1):
                    ahead[n] /= total
                    if is_base[n]:
                        break
        return sums

    def draw(self, base: int, node: int, drawn: np.ndarray) -> list[int]:
        """Pieces of one word from its end back, without arrays; ``drawn``: a number per node after ``base``."""
        first = self.first[base : node + 1].tolist()
        low, high = int(self.first[base]), int(self.first[node]) + self.vocabulary.longest + 1
        sums, sources, pieces = (a[low:high].tolist() for a in (self.sums, self.sources, self.pieces))
        chances, found, at = drawn.tolist(), [], node
        while at > base:
            edge, chance = first[at - base] - low, at + chances[at - base]
            while sums[edge] <= chance:
                edge += 1
            found.append(pieces[edge])
            at = sources[edge]
        return found


def uniform(seeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) with 29 bits, from mixing (seed, place)."""
    x = seeds + (places + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(35)) * 2.0**-29


class Sampler:
    def __init__(self, path: str, alpha: float):
        self.vocabulary = Vocabulary(path, alpha)
        self.lattices = Lattices(self.vocabulary)

    def encode(self, texts: Sequence[str], seeds: Sequence[int]) -> list[np.ndarray]:
        """Piece ids of a sampled segmentation per text; none for an empty text."""
        split = [WORD.findall(" " + text) if text else [] for text in texts]
        self.lattices.learn({w for words in split for w in words})
        counts = np.array([len(words) for words in split], dtype=np.int64)
        words = (w for words in split for w in words)
        codes = np.fromiter(map(self.lattices.words.__getitem__, words), np.int64, int(counts.sum()))
        if not len(codes):
            return [np.zeros(0, np.int32) for _ in texts]
        base, node = self.lattices.bases[codes], self.lattices.lasts[codes]
        seed = np.repeat(np.array(seeds, dtype=np.int64).view(np.uint64), counts)
        shift = np.cumsum(node - base) - (node - base)
        heads = np.minimum(np.cumsum(counts) - counts, len(shift) - 1)  # first word of each text
        offset = (shift - np.repeat(shift[heads], counts)).astype(np.uint64)
        active, steps, alone = np.arange(len(node)), [], []
        sums, first = self.lattices.sums, self.lattices.first
        while len(active):
            at = node[active]
            drawn = at + uniform(seed[active], offset[active] + (at - base[active]).astype(np.uint64))
            edge = first[at]
            behind = np.flatnonzero(sums[edge] <= drawn)
            while len(behind):
                edge[behind] += 1
                behind = behind[sums[edge[behind]] <= drawn[behind]]
            steps.append((active, self.lattices.pieces[edge]))
            node[active] = self.lattices.sources[edge]
            active = active[node[active] > base[active]]
            if 0 < len(active) <= FEW and (node[active] - base[active]).max() > LONG:
                for word in active.tolist():
                    places = offset[word] + np.arange(node[word] - base[word] + 1, dtype=np.uint64)
                    chances = uniform(seed[word], places)
                    alone.append((word, self.lattices.draw(int(base[word]), int(node[word]), chances)))
                break
        lengths = np.zeros(len(node), dtype=np.int64)
        for active, _ in steps:
            lengths[active] += 1
        for word, pieces in alone:
            lengths[word] += len(pieces)
        ends = np.cumsum(lengths)
        ids = np.empty(ends[-1], dtype=np.int32)
        for back, (active, pieces) in enumerate(steps, 1):
            ids[ends[active] - back] = pieces
        for word, pieces in alone:
            stop = ends[word] - len(steps)
            ids[stop - len(pieces) : stop] = pieces[::-1]
        stops = np.concatenate(([0], ends))[np.cumsum(counts)]
        return np.split(ids, stops[:-1])

    def decode(self, ids: Sequence[int]) -> str:
        """The text of any encoded ids; the space put in front of each text is taken off."""
        return b"".join(map(self.vocabulary.table.__getitem__, ids)).decode(errors="replace")[1:]


@lru_cache(maxsize=2)
def sampler(path: str, alpha: float) -> Sampler:
    return Sampler(path, alpha)


def _parts(texts: list[str]) -> Iterator[slice]:
    """Slices of at most about BATCH_CHARS characters, one text at least."""
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > BATCH_CHARS:
            yield slice(start, k)
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def sample_pieces(
    docs: DataFrame,
    model: str,
    seed: int = 0,
    alpha: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    digests: bool = False,
) -> DataFrame:
    """Per row: the identifier and ``ids``, or with ``digests`` n_pieces, ids_crc32 and decoded_crc32.

    ``model`` is a SentencePiece file that every executor can read. NULL texts have NULL ids (digests: no pieces, as the empty
    text), empty texts none. The row's key is its identifier: rows with NULL identifiers share one, and
    repeated rows have equal segmentations. Texts are encoded whole; a task holds a batch of texts and the cache.
    Other columns are not read. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    wanted = [("n_pieces", "long"), ("ids_crc32", "long"), ("decoded_crc32", "long")] if digests else [("ids", "array<int>")]
    names = [(fresh_name([id_col], n), kind) for n, kind in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = sampler(model, alpha)
        for batch in batches:
            texts, seeds = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            plain = [t or "" for t in texts]
            found = [ids for part in _parts(plain) for ids in core.encode(plain[part], seeds[part])]
            if digests:
                columns = [
                    pa.array([len(ids) for ids in found], pa.int64()),
                    pa.array([zlib.crc32(ids.astype("<u4")) for ids in found], pa.int64()),
                    pa.array([zlib.crc32(core.decode(ids.tolist()).encode()) for ids in found], pa.int64()),
                ]
            else:
                lists = [None if t is None else ids for t, ids in zip(texts, found)]
                columns = [pa.array(lists, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *[n for n, _ in names]])

    keyed = docs.select(F.col(id_col), F.col(text_col).alias("text_"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("seed_"))
    return keyed.mapInArrow(run, ", ".join([f"`{id_col}` {id_type}", *[f"{n} {kind}" for n, kind in names]]))


def decode_pieces(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the identifier and ``text``; NULL ids give a NULL text, no ids the empty text."""
    id_type = encoded.schema[id_col].dataType.simpleString()
    name = fresh_name([id_col], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = sampler(model, 1.0)
        for batch in batches:
            texts = [None if ids is None else core.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, name])

    return encoded.select(id_col, F.col(ids_col).alias("ids_")).mapInArrow(run, f"`{id_col}` {id_type}, {name} string")
