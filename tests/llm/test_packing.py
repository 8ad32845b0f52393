import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keepwell.llm import packing, tokens
from tests.llm.conftest import corpus

PATH = public_tokenizers.path("byte_bpe_50k.json")


@lru_cache
def library():
    return Tokenizer.from_file(PATH)


def plain_ids(texts):
    tokenizer = library()
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def check(spark, texts, partitions):
    docs = corpus(spark, texts).repartition(partitions)
    rows = packing.pack(docs, PATH).collect()
    pieces, sequences = {}, {}
    for r in rows:
        ids = np.array(r["ids"], dtype="<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end & (end - 1) == 0 and end <= 1024
    full = sum(sum(n for _, n in parts) == 1024 for parts in sequences.values())
    assert len(sequences) - full <= 10 * partitions
    got = []
    for (doc, n), parts in pieces.items():
        starts = sorted(parts)
        copies = sum(s == 0 for s, _ in starts)
        flat = [x for _, ids in starts for x in ids]
        assert len(flat) == n * copies
        got += [(doc, n)] * copies
        if copies == 1:
            assert flat in [ids for (i, _), ids in zip(texts, plain_ids([t for _, t in texts])) if i == doc]
    assert sorted(got, key=repr) == sorted(((i, len(x)) for (i, _), x in zip(texts, plain_ids([t for _, t in texts]))), key=repr)


def test_awkward_rows_as_by_brute_force(spark, awkward):
    check(spark, awkward, 3)


def test_given_documents_as_by_brute_force(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in rows], 4)


def test_empty_table(spark):
    assert packing.pack(corpus(spark, []), PATH).count() == 0


def test_level_with_smallest_sum_of_squares():
    rng = np.random.default_rng(1)
    packer = packing.Packer(32)
    for k in range(3000):
        size = int(rng.integers(1, 32))
        best = {}
        for level in range(0, 33 - size):
            if level and not packer.counts[level]:
                continue
            after = packer.counts.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 32
            best[level] = int((after[1:] ** 2).sum())
        assert best[packer.level_for(size)] == min(best.values())
        packer.add(k, np.arange(size, dtype=np.uint32))
        assert packer.counts.sum() == sum(map(len, packer.open.values()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab 'sé1\n\t .<|>endoftxÅ\x1c "), max_size=40), max_size=6))
def test_words_give_the_ids_of_the_library(texts):
    encode = tokens.encoder(PATH)
    assert [[*x.tolist(), 0] for x in encode(texts)] == plain_ids(texts)
