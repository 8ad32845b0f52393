import math

import numpy as np

from keepwell.llm import exact_search, sql
from tests.llm.duck import assert_same

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], SCHEMA)


def best(rows, k=5):
    """All pairs, in exact integers."""
    usable = {
        (i, tuple(math.floor(256 * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    found = []
    for q, a in usable:
        if q % 50 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), p) for p, b in usable if (p, b) != (q, a) and len(a) == len(b)]
            found += [(q, r, p, -s) for r, (s, p) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def search(spark, rows, **options):
    return sorted(map(tuple, exact_search.exact_top_k(vectors(spark, rows), 5, **options).collect()))


def test_given_vectors_as_in_sql(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    assert_same(exact_search.exact_top_k(table), sql.EXACT_SEARCH, embeddings=table)


def test_awkward_vectors_by_brute_force(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -0.5]), (50, [1.0, -0.5]), (50, [1.0, -0.5]), (1, [1.0, -0.5]), (2, None), (3, [nan, 1.0]),
        (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (100, [0.0, 0.0]), (6, [-1e12, 1e6]), (10, [3.0e4, -2.0e4]), (11, [3.0e4, -2.0e4 + 0.25]), (7, [0.003, -0.001]),
        (8, []), (150, []), (9, [1.0, 2.0, 3.0]), (200, [1.0, 1.0, 1.0]), (50, [0.25, 0.25]),
    ]
    rows += [(300 + k, [0.5, 0.5]) for k in range(12)]
    assert search(spark, rows) == best(rows)
    assert search(spark, []) == []


def test_many_tiles_and_blocks_by_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12)) / 3
    rows = [(k, [float(np.float32(x)) for x in centres[k % 6] + rng.normal(size=12) / 20]) for k in range(600)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)]
    assert search(spark, rows, tile_rows=40, block_rows=3, cells=8) == best(rows)
