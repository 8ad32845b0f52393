"""Token files against the tokenizers library and plain sums; coding round trips."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from keepwell.llm import rans, token_files
from keepwell.llm.tokens import ApartWordEncoder, apart_encoder
from tests.llm.conftest import corpus, sentence

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(texts):
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*x.ids, 1] for x in found]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_words_apart_as_the_library_gives_them():
    texts = [
        "", " ", "it's IT'S we'll  x's", "<|endoftext|> a<|startoftext|>b <|start", "tab\tand\x0bother\x1cspace\xa0kinds here",
        "Eiń café ́x Σ ΣΑΣ İi ﬁ 12345 a1b2", "\U0001f600\U0001f600 中文字 คำ", "line\nfeed\r\nboth", "End. end., END, é. 1. ., a.b. x\u0301. \x01 a\x01b <|ENDOFTEXT|> Up", "UP Low. low., ... .", "x" * 5000, sentence(3, 3000),
    ]
    encode = apart_encoder(PATH)
    for _ in range(2):
        assert [[*x.tolist(), 1] for x in encode(texts)] == plain(texts)


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 300_000])
def test_blocks_round_trip_from_every_checkpoint(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 5000).astype(np.uint32)
    values, counts = np.unique(ids, return_counts=True)
    coder = rans.model(rans.scaled_frequencies(dict(zip(values.tolist(), counts.tolist()))))
    block = rans.encode(ids, coder)
    assert np.array_equal(rans.decode(block, coder), ids)
    for first, beyond in ((0, 1), (n // 2, n // 2 + 7), (131_072, 131_073), (262_143, 262_146), (max(n - 1, 0), n + 9)):
        assert np.array_equal(rans.decode(block, coder, min(first, n), beyond), ids[min(first, n) : beyond])
    if n > 1000:
        entropy = -(counts / n * np.log2(counts / n)).sum() * n / 8
        assert len(block) < 1.02 * entropy + 8 * 1024 * 4 + 100
        broken = bytearray(block)
        broken[len(block) // 2] ^= 1
        with pytest.raises(ValueError):
            rans.decode(bytes(broken), coder)


def test_one_id_alone_and_frequencies():
    coder = rans.model(rans.scaled_frequencies({7: 12}))
    assert rans.decode(rans.encode(np.full(3000, 7), coder), coder).tolist() == [7] * 3000
    scaled = rans.scaled_frequencies({k: 10**15 if k == 3 else 1 for k in range(60_000)})
    assert sum(scaled.values()) == 1 << rans.SCALE_BITS and min(scaled.values()) == 1


def test_checksums_of_parts():
    data = np.random.default_rng(1).bytes(1000)
    parts = [data[:10], data[10:10], data[10:700], data[700:]]
    whole, behind = 0, len(data)
    for p in parts:
        behind -= len(p)
        whole ^= token_files.shifted(zlib.crc32(p), behind)
    assert whole == zlib.crc32(data)


def test_awkward_rows_by_brute_force(spark, awkward, tmp_path):
    path = str(tmp_path / "files")
    docs = corpus(spark, awkward).repartition(5)
    found = token_files.file_digests(docs, PATH, path, block_ids=700).collect()
    ids = dict(zip([t or "" for _, t in awkward], plain([t for _, t in awkward])))
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (i or 0, len(ids[t or ""]), crc(ids[t or ""])) for i, t in awkward
    )
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in found), key=lambda i: (i is None, i or 0))
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    parts = sorted(token_files.read_ids(spark, path, ordered[3].start, at).collect())
    assert crc([i for p in parts for i in p.ids][: ordered[3].n_tokens]) == ordered[3].ids_crc32
    empty = token_files.file_digests(corpus(spark, []), PATH, str(tmp_path / "none"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_given_documents_by_brute_force(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.file_digests(docs, PATH, str(tmp_path / "files")).collect()}
    rows, at = sorted((r.doc_id, r.text) for r in docs.collect()), 0
    for (i, _), ids in zip(rows, plain([t for _, t in rows])):
        assert found[i] == (at, len(ids), crc(ids))
        at += len(ids)
    assert len(found) == len(rows)


def test_words_after_the_cache_was_emptied(monkeypatch):
    encode = ApartWordEncoder(PATH)
    monkeypatch.setattr(ApartWordEncoder, "CACHED_WORDS", 20)
    texts = [sentence(k, 30) + " é. X1" for k in range(12)] + [""]
    for at in range(0, len(texts), 3):
        some = texts[at : at + 3]
        assert [[*x.tolist(), 1] for x in encode(some)] == plain(some)
    assert encode.known < 200 and encode([]) == []


@pytest.mark.parametrize("most", [1, 5, 10, 1000])
def test_slices_by_bytes(most):
    texts = ["", "abc", "", "é" * 4, "x" * 30, "y", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["id", "text"])
    found = [s.column(1).to_pylist() for s in token_files._by_bytes(batch, most)]
    assert [t for part in found for t in part] == texts
    assert all(len(part) == 1 or sum(len(t.encode()) for t in part) <= most for part in found)
    assert list(token_files._by_bytes(batch.slice(0, 0), most)) == []
