"""Tokenizers inside tasks, one per worker process and file, with a bounded cache of words."""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from keepwell.llm.common import put

#: Bounds of the cache of one worker process, about 80 MB: a worker stays alive beside a full heap after its stage.
CACHED_WORDS = 300_000
CACHED_CHARS = 6_000_000

#: How byte-level vocabularies write the space, and how many words are encoded at a time; UNKNOWN: no code yet.
BYTE_SPACE = "\u0120"
JOINED_WORDS = 200
UNKNOWN = -2


class WordEncoder:
    """Ids of whole texts from a byte-level BPE tokenizer, by words that are encoded once.

    Such a tokenizer starts a new piece at every single space between other characters, so the ids of a
    text are those of its words, each with its space, end to end. A text in which a space has another
    white-space character beside it is encoded in one go. All ids come from the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens_word[[i for piece, i in vocabulary.items() if piece.startswith(BYTE_SPACE)]] = True
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.chars = self.known = self.filled = 0
        self.lengths, self.starts = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)

    def _plain(self, texts: Sequence[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32) for x in found]

    def _learn(self, new: set[str]) -> None:
        """Encode new words, many in one string: only the first id of a word begins with a space.

        Words that are empty or begin or end with white space get code -1.
        """
        safe = [w for w in new if w and w.strip() == w]
        if len(safe) < len(new):
            self.codes.update(dict.fromkeys(new, -1))
        self.codes.update(zip(safe, range(self.known, self.known + len(safe))))
        if not safe:
            return
        joined = [" " + " ".join(safe[at : at + JOINED_WORDS]) for at in range(0, len(safe), JOINED_WORDS)]
        ids = np.concatenate(self._plain(joined))
        starts = np.flatnonzero(self.opens_word[ids])
        lengths = np.diff(starts, append=len(ids))
        self.starts = put(self.starts, self.known, starts + self.filled)
        self.lengths = put(self.lengths, self.known, lengths)
        self.flat = put(self.flat, self.filled, ids)
        self.known += len(safe)
        self.filled += len(ids)
        self.chars += sum(map(len, safe))

    def _codes(self, words: list[str]) -> np.ndarray:
        if len(self.codes) > CACHED_WORDS or self.chars > CACHED_CHARS:
            self.clear()
        codes = np.fromiter(map(self.codes.get, words, repeat(UNKNOWN)), np.int64, len(words))
        new = np.flatnonzero(codes == UNKNOWN)
        if len(new):
            found = [words[i] for i in new.tolist()]
            self._learn(set(found))
            codes[new] = np.fromiter(map(self.codes.__getitem__, found), np.int64, len(found))
        return codes

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray]:
        split = [text.split(" ") for text in texts]
        codes = self._codes([w for words in split for w in words[1:]])
        heads = self._plain([words[0] for words in split])
        lengths = self.lengths[codes]  # of no use where the code is -1
        starts = self.starts[codes]
        result, at = [], 0
        for text, words, head in zip(texts, split, heads):
            part = slice(at, at + len(words) - 1)
            at = part.stop
            if len(words) > 1 and (codes[part].min() < 0 or words[0][-1:].isspace()):
                result += self._plain([text])
                continue
            size = lengths[part]
            ends = np.cumsum(size)
            places = np.repeat(starts[part] - (ends - size), size)
            body = self.flat[places + np.arange(len(places))]
            result.append(np.concatenate((head, body)))
        return result


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[Sequence[str]], list[np.ndarray]]:
    return WordEncoder(path)


class ApartWordEncoder:
    """Ids of whole texts from a tokenizer that drops white space, ignores case and reads letters apart from stops.

    The ids of a text are those of its words, split at spaces and line feeds, end to end; each different
    word is encoded once, by the tokenizers library, and kept in a bounded cache. New words are encoded many
    at a time, with a control character between them that is one id; those in which it stands, or which may
    hold special strings, alone; and those of the letters a to z, which nothing in front of the library's model
    changes, by the model. A space goes before each full stop and comma of a text in which these have
    only letters, digits, spaces and line feeds beside them, which leaves the ids as they are and makes for fewer
    different words. White space of other kinds stays inside a word and is left to the library.
    """

    MARK, SPECIAL = "\x01", "<|"
    BESIDE_STOPS = re.compile(r"[.,](?:(?=[^\w \n]|_)|(?<=[^\w \n].)|(?<=_.))")
    CACHED_WORDS = 700_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark_id,) = self._plain([self.MARK])[0]
        letters = "".join(map(chr, range(ord("a"), ord("z") + 1)))
        self.direct = self._by_model(letters) == self._plain([letters])[0].tolist()
        self.clear()

    _plain = WordEncoder._plain

    def clear(self) -> None:
        WordEncoder.clear(self)
        self.words = pa.array([], pa.large_string())  # the place of a word is its code

    def _add(self, words: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.codes.update(zip(words, range(self.known, self.known + len(words))))
        self.starts = put(self.starts, self.known, self.filled + np.cumsum(lengths) - lengths)
        self.lengths = put(self.lengths, self.known, lengths)
        self.flat = put(self.flat, self.filled, ids)
        self.known += len(words)
        self.filled += len(ids)
        self.chars += sum(map(len, words))

    def _by_model(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def _learn(self, words: list[str]) -> np.ndarray:
        """Take different words in that are not known, and return their codes."""
        self._encode_new(words)
        self.words = pa.concat_arrays([self.words, pa.array(list(self.codes), pa.large_string())])
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        self.codes = {}
        return codes

    def _encode_new(self, words: list[str]) -> None:
        simple = [w for w in words if self.direct and w.isascii() and w.isalpha() and w.islower()]
        if simple:
            pieces = list(map(self.tokenizer.model.tokenize, simple))
            lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
            ids = map(attrgetter("id"), chain.from_iterable(pieces))
            self._add(simple, lengths, np.fromiter(ids, np.uint32, int(lengths.sum())))
            words = list(dict.fromkeys(words).keys() - simple)
        alone = [w for w in words if self.MARK in w or self.SPECIAL in w]
        for word, ids in zip(alone, self._plain(alone)):
            self._add([word], np.array([len(ids)]), ids)
        joined = [w for w in words if not (self.MARK in w or self.SPECIAL in w)] if alone else words
        if joined:
            gap = f" {self.MARK} "
            texts = [gap.join(joined[at : at + JOINED_WORDS]) + gap for at in range(0, len(joined), JOINED_WORDS)]
            ids = np.concatenate(self._plain(texts))
            ends = np.flatnonzero(ids == self.mark_id)
            self._add(joined, np.diff(ends, prepend=-1) - 1, np.delete(ids, ends))

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words with these codes, end to end, and where each word ends."""
        sizes = self.lengths[codes]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[codes] - (ends - sizes), sizes)
        return self.flat[places + np.arange(len(places))], ends

    def _spaced(self, text: str) -> str:
        """The text with a space wherever it may be cut into words."""
        if self.SPECIAL not in text:
            text = text.lower() if text.isascii() else text.encode().lower().decode()  # A-Z only
            if not self.BESIDE_STOPS.search(text):
                text = text.replace(".", " .").replace(",", " ,")
        return text.replace("\n", " ")

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if self.known > self.CACHED_WORDS or self.chars > 2 * CACHED_CHARS:
            self.clear()
        gc.disable()  # nothing here forms cycles, and its many small lists would start the collector again and again
        try:
            return self._encoded(texts)
        finally:
            gc.enable()

    def _encoded(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Each different word of these texts is looked up once: Arrow cuts the texts and numbers their words."""
        split = pc.split_pattern(pa.array(map(self._spaced, texts), pa.large_string()), " ")
        numbered = split.flatten().dictionary_encode()
        different = numbered.dictionary
        known = pc.index_in(different, value_set=self.words)
        codes = known.fill_null(UNKNOWN).to_numpy().astype(np.int64)
        if known.null_count:
            codes[codes == UNKNOWN] = self._learn(different.filter(known.is_null()).to_pylist())
        ids, ends = self._gather(codes[numbered.indices.to_numpy()])
        last = np.cumsum(pc.list_value_length(split).to_numpy()) - 1
        return np.split(ids, ends[last[:-1]])


@lru_cache(maxsize=2)
def apart_encoder(path: str) -> ApartWordEncoder:
    return ApartWordEncoder(path)
