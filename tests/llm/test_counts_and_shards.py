import heapq
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from keepwell.llm import sharding, token_counts
from tests.llm.conftest import corpus, sentence

MODEL = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [MODEL, JSON])
def test_counts_of_awkward_rows(spark, awkward, folder, path):
    texts = [*awkward, (12, "<s>a</s> <unk> ▁▁ b")]
    got = token_counts.token_counts(corpus(spark, texts), path, folder + "/cache", limit=60).collect()
    if path == MODEL:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(library.encode(t))
    else:
        library = Tokenizer.from_file(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    expected = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 60) for i, t in texts]
    assert Counter(map(tuple, got)) == Counter(expected)


def test_only_distinct_misses_are_encoded(spark, folder):
    cache = folder + "/cache"
    first = corpus(spark, [(k, sentence(k % 4)) for k in range(40)])
    token_counts.token_counts(first, MODEL, cache).collect()
    assert spark.read.parquet(cache).count() == 4
    more = corpus(spark, [(k, sentence(k % 6)) for k in range(40)] + [(41, None)])
    assert token_counts.token_counts(more, MODEL, cache).count() == 41
    stored = spark.read.parquet(cache)
    assert stored.count() == 7 and stored.select("digest").distinct().count() == 7
    token_counts.token_counts(first, JSON, cache).collect()
    assert spark.read.parquet(cache).groupBy("tokenizer").count().count() == 2


def test_empty_table_has_no_counts(spark, folder):
    assert token_counts.token_counts(corpus(spark, []), MODEL, folder + "/cache").count() == 0


def check_shards(spark, texts, shards):
    rows = sharding.shard_by_bytes(corpus(spark, texts), shards).collect()
    sizes = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(sizes)
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in rows)
    slots, of_text, loads = defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        of_text[r.text_crc32, r["size"]].add(r.shard)
        loads[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for k, s in of_text.items() if k != (0, 1))
    return loads


def test_awkward_rows_are_sharded(spark, awkward):
    check_shards(spark, awkward, 4)
    assert sharding.shard_by_bytes(corpus(spark, []), 4).count() == 0


def test_given_documents_have_even_shards(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    texts = [tuple(r) for r in rows]
    loads = check_shards(spark, texts, 4)
    groups = Counter()
    for _, t in texts:
        groups[t] += len(t.encode()) + 1
    assert max(loads.values()) <= sum(groups.values()) / 4 + max(groups.values())
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())


def test_schedule_by_brute_force():
    entries = [(str(k), (k * 7919) % 101) for k in range(200)]
    loads = [0] * 5
    expected = []
    for name, size in sorted(entries, key=lambda e: (-e[1], e[0])):
        shard = loads.index(min(loads))
        loads[shard] += size
        expected.append((name, shard))
    assert sharding.schedule(entries, 5) == expected
    assert heapq.nsmallest(1, loads)[0] > 0


def test_slots_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 7)
    check_shards(spark, [(k, sentence(k % 50, 5)) for k in range(300)], 3)
