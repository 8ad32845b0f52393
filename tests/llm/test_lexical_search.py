"""Ranked lexical search against SQL and plain scores of all pairs."""

import math
import re

import numpy as np

from keepwell.llm import lexical_search, sql
from tests.llm.conftest import corpus, sentence
from tests.llm.duck import assert_same

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id string, text string, rank int, doc_id long"


def plain_terms(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    held = [(i, plain_terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n, total, df = len(held), sum(len(t) for _, t in held), {}
    for _, t in held:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    found = []
    for item, text in items:
        scores = []
        for i, t in held:
            m = 25 + 75 * len(t) * n // total
            score = 0
            for w in plain_terms(text):
                tf = t.count(w)
                if tf:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score:
                scores.append((-score, i is None, i or 0))
        found += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=repr)


def search(spark, docs, items, **options):
    table = spark.createDataFrame([(i, t, 0, 0) for i, t in items], ITEM)
    rows = lexical_search.ranked_search(corpus(spark, docs), table, **options).collect()
    return sorted(map(tuple, rows), key=repr)


def test_terms_as_the_contract_says():
    text = "Ab1-cD Éé ÀB\u0080x\x7f中文 \x00a[b`c{d~e:f@g/h 0 \U0001f600"
    assert [t.decode() for t in lexical_search.terms(text)] == plain_terms(text)
    assert lexical_search.terms(None) == []


def test_awkward_rows_by_brute_force(spark, awkward):
    docs = awkward + [(20 + k, sentence(k % 7, 25) + " w1 common") for k in range(60)] + [(None, "common one"), (90, "common one")]
    items = [
        ("a", "one common W1 common"), ("a", "one common W1 common"), (None, sentence(1, 12)), ("b", None), ("c", ""), ("d", "zzz"),
        ("e", " ".join(sentence(k, 8) for k in range(9))), ("f", "common"), ("g", "Einä A-Z two"),
    ]
    expected = brute(docs, items)
    assert search(spark, docs, items) == expected
    assert search(spark, docs, items, block_terms=10, tile_rows=3, first_share=2) == expected
    assert search(spark, [], items) == search(spark, docs, []) == search(spark, [(1, None)], items) == []


def test_skewed_terms_and_ties_by_brute_force(spark):
    rng = np.random.default_rng(3)
    docs = [(k, " ".join(f"t{min(int(x), 300)}" for x in rng.zipf(1.4, 30))) for k in range(700)]
    docs += [(2000 - k, docs[5][1]) for k in range(300)]
    items = [(str(k), " ".join(f"t{min(int(x), 300)}" for x in rng.zipf(1.3, 9))) for k in range(70)]
    assert search(spark, docs, items, tile_rows=64) == brute(docs, items)


def test_bounds_hold_for_every_pair_of_nodes():
    rng = np.random.default_rng(8)
    items = [{int(c): int(n) for c, n in zip(rng.integers(0, 40, 5), rng.integers(1, 4, 5))} for _ in range(50)]
    tree = lexical_search.item_tree(np.arange(50), items)
    assert sorted(tree.rows.tolist()) == list(range(50)) and len(tree.levels[0][1]) == 2
    dense = rng.integers(0, 100, 40)
    below = [lexical_search._products(dense, level, np.arange(len(level[1]) - 1)) for level in tree.levels]
    for depth, level in enumerate(tree.levels[:-1]):
        assert np.array_equal(below[depth] >= np.maximum.reduceat(below[depth + 1], level[0][:-1]), np.full(len(below[depth]), True))
    exact = [sum(dense[c] * n for c, n in items[r].items()) for r in tree.rows]
    assert below[-1].tolist() == exact


def test_given_tables_as_in_sql(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("documents", "benchmark"))
    assert_same(lexical_search.ranked_search(docs, items), sql.RANKED_SEARCH, documents=docs, benchmark=items)
