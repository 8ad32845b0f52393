from collections import defaultdict

import numpy as np
import xxhash

from keepwell.llm import simhash
from keepwell.llm.components import connected_components
from tests.llm.conftest import corpus, sentence


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, radius):
    """Smallest value reachable, by comparing all pairs."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def check(spark, texts):
    got = simhash.simhash_groups(corpus(spark, texts), carry=["text", "fingerprint", "row"]).collect()
    prints = [plain_fingerprint(t) for _, t in texts]
    roots = plain_roots(set(prints), 3)
    least = defaultdict(list)
    for (i, _), p in zip(texts, prints):
        least[roots[p]].append(i)
    expected = []
    for (i, _), p in zip(texts, prints):
        ids = [x for x in least[roots[p]] if x is not None]
        expected.append((i, f"{p:016x}", min(ids) if ids else None))
    key = repr
    assert sorted([(r["doc_id"], r["_fingerprint"], r["component_id"]) for r in got], key=key) == sorted(expected, key=key)
    assert sum(r["first"] for r in got) == len(least)
    assert all(r["doc_id"] == r["component_id"] for r in got if r["first"])


def test_awkward_rows_as_by_brute_force(spark, awkward):
    check(spark, awkward)


def test_given_documents_as_by_brute_force(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in rows])


def test_empty_table(spark):
    docs = corpus(spark, [])
    assert simhash.simhash_groups(docs).count() == 0
    assert simhash.first_of_groups(docs).columns == docs.columns


def test_links_of_random_prints_with_small_tiles(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63 - 1, 150)
    near = [int(b) ^ int(sum(1 << int(k) for k in rng.choice(62, rng.integers(0, 5), replace=False))) for b in base for _ in range(3)]
    values = sorted({*map(int, base), *near})
    edges = simhash.print_links(spark.createDataFrame([(v,) for v in values], "fp long"), 3, tile_rows=8)
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert {v: roots.get(v, v) for v in values} == plain_roots(values, 3)


def test_dense_group_gives_few_edges():
    a = np.arange(8, dtype=np.int64)
    u, v = simhash.tile_links(a, a, 3)
    assert len(u) == 7 and set(v) == {0}


def test_chain_longer_than_a_round(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (5, 5)], "u long, v long")
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert roots == {**{i: 0 for i in range(1, 301)}, 901: 900}


def test_one_row_of_each_group_stays(spark):
    texts = [(3, sentence(1)), (2, sentence(1)), (2, sentence(1)), (9, sentence(50)), (None, sentence(1))]
    docs = corpus(spark, texts)
    kept = simhash.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 9]
