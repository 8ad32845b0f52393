"""A static range asymmetric numeral system over blocks of token ids, many interleaved lanes at a time.

A block's ids are laid out in rows of ``lanes`` ids; lane j codes the ids of column j with a state of its
own, so each step of NumPy arrays codes one row. States are held in 2**31 .. 2**63 and give off 32-bit
words. Encoding runs from the last row to the first and decoding forwards. Every ``CHECKPOINT_ROWS`` rows the
states and the place in the words are stored, so that decoding can start there.

Layout of a block, little-endian: ids, lanes, words, checkpoints (4 bytes each); the states (8 bytes each); per
checkpoint its place in the words (4 bytes) and states; the words (4 bytes each); the CRC-32 of all before it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

import numpy as np

LANES = 1024
CHECKPOINT_ROWS = 128
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
HEADER = struct.Struct("<4I")


@dataclass(frozen=True)
class Model:
    """Frequencies of all ids, which add up to 2**``SCALE_BITS``; ids that do not occur have none."""

    frequencies: np.ndarray

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.frequencies) - self.frequencies

    @cached_property
    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.frequencies), dtype=np.uint32), self.frequencies.astype(np.int64))


def scaled_frequencies(counts: Mapping[int, int]) -> dict[int, int]:
    """Counts in proportion, at least 1 each, with the sum 2**``SCALE_BITS``."""
    if not counts:
        return {}
    room, total = (1 << SCALE_BITS) - len(counts), sum(counts.values())
    if room < 0:
        raise ValueError(f"more than {1 << SCALE_BITS} different ids")
    scaled = {i: 1 + n * room // total for i, n in counts.items()}
    scaled[max(counts, key=lambda i: (counts[i], -i))] += (1 << SCALE_BITS) - sum(scaled.values())
    return scaled


def model(frequencies: Mapping[int, int]) -> Model:
    table = np.zeros(max(frequencies, default=0) + 1, dtype=np.uint64)
    table[list(frequencies)] = list(frequencies.values())
    return Model(table)


def encode(ids: np.ndarray, model: Model) -> bytes:
    lanes = max(1, min(LANES, len(ids)))
    frequency, start = model.frequencies[ids], model.starts[ids]
    states, chunks, saved, given = np.full(lanes, LOW), [], [], 0
    room = np.uint64(63 - SCALE_BITS)
    for row in reversed(range(-(-len(ids) // lanes))):
        part = slice(row * lanes, (row + 1) * lanes)
        f = frequency[part]
        x = states[: len(f)]
        full = x >= f << room
        if full.any():
            chunks.append(x[full].astype("<u4"))
            given += len(chunks[-1])
            x = np.where(full, x >> WORD, x)
        above, rest = np.divmod(x, f)
        states[: len(f)] = (above << np.uint64(SCALE_BITS)) + rest + start[part]
        if row and row % CHECKPOINT_ROWS == 0:
            saved.append((given, states.astype("<u8").tobytes()))
    marks = b"".join(struct.pack("<I", given - at) + kept for at, kept in reversed(saved))
    words = b"".join(c.tobytes() for c in reversed(chunks))
    body = HEADER.pack(len(ids), lanes, given, len(saved)) + states.astype("<u8").tobytes() + marks + words
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, model: Model, first: int = 0, beyond: int | None = None) -> np.ndarray:
    """Ids ``first`` to before ``beyond`` of a block, read from the last checkpoint before them."""
    body = memoryview(block)[:-4]
    if len(block) < HEADER.size + 4 or zlib.crc32(body) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("a block does not match its checksum")
    n, lanes, given, marks = HEADER.unpack_from(block)
    beyond = n if beyond is None else min(beyond, n)
    mark = min(first // (lanes * CHECKPOINT_ROWS), marks)
    words = np.frombuffer(block, "<u4", given, len(body) - 4 * given).astype(np.uint64)
    place = HEADER.size + 8 * lanes
    at, place = struct.unpack_from("<I", block, place + (mark - 1) * (4 + 8 * lanes))[0] if mark else 0, (
        place + (mark - 1) * (4 + 8 * lanes) + 4 if mark else HEADER.size
    )
    states = np.frombuffer(block, "<u8", lanes, place).astype(np.uint64)
    opened = mark * CHECKPOINT_ROWS * lanes
    ids = np.empty(max(beyond - opened, 0), dtype=np.uint32)
    mask, bits = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
    for row in range(0, len(ids), lanes):
        x = states[: min(lanes, n - opened - row)]
        slot = x & mask
        found = model.slots[slot]
        x = model.frequencies[found] * (x >> bits) + slot - model.starts[found]
        short = x < LOW
        wanted = np.count_nonzero(short)
        if wanted:
            x[short] = x[short] << WORD | words[at : at + wanted]
            at += wanted
        states[: len(x)] = x
        ids[row : row + lanes] = found[: len(ids) - row]
    return ids[first - opened :]
