import math
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keepwell.llm import sampled_pieces
from tests.llm.conftest import corpus

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def core():
    return sampled_pieces.sampler(PATH, 1.0)


def segmentations(vocabulary, text):
    """All paths of a text with their weights, by trying every cut."""
    if not text:
        return {(): 1.0}
    found = {}
    for k in range(1, len(text) + 1):
        piece = vocabulary.pieces.get(text[:k])
        if piece:
            for rest, w in segmentations(vocabulary, text[k:]).items():
                found[piece, *rest] = w * vocabulary.weights[piece]
    return found


@pytest.mark.parametrize("text", ["then in", "  a the", "abc ing of"])
def test_frequencies_follow_the_weights_of_all_paths(core, text):
    exact = segmentations(core.vocabulary, " " + text)
    total = sum(exact.values())
    n = 20_000
    drawn = Counter(tuple(x.tolist()) for x in core.encode([text] * n, list(range(n))))
    assert set(drawn) <= set(exact)
    distance = sum(abs(drawn[path] / n - w / total) for path, w in exact.items()) / 2
    assert distance < 0.5 * math.sqrt(len(exact) / n) + 0.01


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_decoding_gives_the_text(core, texts):
    assert [core.decode(x.tolist()) for x in core.encode(texts, list(range(len(texts))))] == texts


def test_same_ids_alone_and_in_company_and_after_the_cache_is_cleared(core, awkward):
    texts = [t or "" for _, t in awkward]
    together = core.encode(texts, [7] * len(texts))
    core.lattices.clear()
    for text, ids in zip(texts, together):
        assert np.array_equal(core.encode([text], [7])[0], ids)


def unspaced(n, seed=3):
    """Texts of words without spaces, of Chinese characters and of characters without a piece."""
    rng = np.random.default_rng(seed)
    words = ["the", "nation", "Zürich", "0x1f", "ing", "ab"]
    latin = "".join(words[i] for i in rng.integers(0, len(words), n // 3))
    chinese = "".join(map(chr, rng.integers(0x4E00, 0x5E00, n)))
    rare = "".join(map(chr, rng.integers(0x1F300, 0x1F500, n // 4)))
    return [latin, chinese, rare, latin + " " + chinese, "a" * n]


def test_long_words_one_edge_at_a_time_are_drawn_as_in_arrays(core, monkeypatch):
    texts = unspaced(3_000) + ["some words of a text", "", "x " * 50]
    seeds = list(range(len(texts)))
    core.lattices.clear()
    found = core.encode(texts, seeds)
    alone = []
    for text, seed in zip(texts, seeds):
        core.lattices.clear()
        alone.append(core.encode([text], [seed])[0])
    monkeypatch.setattr(sampled_pieces, "FEW", 0)
    core.lattices.clear()
    arrays = core.encode(texts, seeds)
    core.lattices.clear()
    for a, b, c, text in zip(found, alone, arrays, texts):
        assert np.array_equal(a, b) and np.array_equal(a, c) and core.decode(a.tolist()) == text


def test_long_words_follow_the_weights_of_all_paths(core, monkeypatch):
    """The path without arrays, on a word whose segmentations can be listed."""
    monkeypatch.setattr(sampled_pieces, "LONG", 0)
    core.lattices.clear()
    exact = segmentations(core.vocabulary, " nationing")
    drawn = Counter(tuple(core.encode(["nationing"], [seed])[0].tolist()) for seed in range(8_000))
    core.lattices.clear()
    total = sum(exact.values())
    assert set(drawn) <= set(exact)
    distance = sum(abs(drawn[path] / 8_000 - w / total) for path, w in exact.items()) / 2
    assert distance < 0.5 * math.sqrt(len(exact) / 8_000) + 0.01


def test_time_of_texts_without_spaces_grows_with_their_length(core):
    def seconds(text):
        core.lattices.clear()
        start = time.perf_counter()
        core.encode([text], [1])
        return time.perf_counter() - start

    long = unspaced(120_000)[1]
    seconds(long[:1_000])
    assert seconds(long) < 4  # a round of array calls for each character takes more than 20
    core.lattices.clear()


def test_round_trip_of_awkward_rows(spark, awkward):
    docs = corpus(spark, awkward)
    encoded = sampled_pieces.sample_pieces(docs, PATH)
    decoded = sampled_pieces.decode_pieces(encoded, PATH)
    assert Counter(map(tuple, decoded.collect())) == Counter(awkward)
    again = sampled_pieces.sample_pieces(docs.repartition(5), PATH, digests=True).collect()
    once = sampled_pieces.sample_pieces(docs, PATH, digests=True).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, once))
    ids = {r.doc_id: r.ids for r in encoded.collect() if r.ids and r.doc_id in (7, 8)}
    for r in once:
        if r.doc_id in ids:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id], dtype="<u4"))


def test_empty_table_and_given_documents(spark, data):
    assert sampled_pieces.sample_pieces(corpus(spark, []), PATH).count() == 0
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = sampled_pieces.sample_pieces(docs, PATH, digests=True).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    assert all(r.decoded_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
