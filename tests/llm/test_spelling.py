"""Spelling groups against plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from keepwell.llm import registry, spelling
from tests.llm.conftest import corpus, sentence


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def brute(counts):
    n = {w: k for w, k in counts.items() if k >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    found = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(found)


def plain_words(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n}


@pytest.mark.parametrize("letters, tile, chunk", [("ab", 8192, 8192), ("abcéà", 17, 5)])
def test_random_words_by_brute_force(spark, letters, tile, chunk):
    pick = random.Random(len(letters))
    words = ["".join(pick.choice(letters) for _ in range(pick.randint(7, 10))) for _ in range(400)]
    words += [words[k][:-1] for k in range(40)] + ["x" * 400, "x" * 399, "x" * 200 + "y" + "x" * 199]
    counts = {w: pick.choice([1, 2, 3, 25, 40, 300, 4000]) for w in words}
    rows = [(w, n - n // 2, 1) for w, n in counts.items()] + [(w, n // 2, 2) for w, n in counts.items()] + [(None, 9, 3)]
    table = spark.createDataFrame(rows, "word string, n long, root int")
    found = spelling.spelling_groups(table, tile_words=tile, chunk_queries=chunk)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == brute(counts)


def test_words_and_chains_of_awkward_documents(spark, awkward, tmp_path):
    texts = [(500 + k, " ".join(["Morning×light"] * 30 + ["mornings"] * 3 + ["evenings"] * 2)) for k in range(40)]
    texts += [(700, "morningx " * 50 + "mornngx " * 4), (None, "Ünïcödé ünïcödé straßen STRASSEN")]
    texts += [(800 + k, "lanternes " * 25 + "lanterne " * 2 + "lantern" * (k < 2)) for k in range(10)]
    texts += [*awkward, (701, sentence(3).replace("w", "word"))]
    path = str(tmp_path / "documents.parquet")
    corpus(spark, texts).write.parquet(path)
    found = sorted(map(tuple, registry.queries()["op11_spelling_groups"](spark, str(tmp_path)).collect()))
    assert found == brute(plain_words(texts))
    assert any(r[1] is not None and r[2] != r[1] for r in found)


def test_given_documents_by_brute_force(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    counted = spelling.document_words(spark.read.parquet(f"{data}/documents.parquet"))
    found = sorted(map(tuple, spelling.spelling_groups(counted, tile_words=300).collect()))
    assert found == brute(plain_words(docs))


def test_empty_table(spark):
    assert spelling.spelling_groups(spelling.document_words(corpus(spark, []))).count() == 0
