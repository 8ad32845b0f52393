"""The stages of the pipeline, each against its SQL counterpart or brute force on what its predecessor kept."""

import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from keepwell.llm import sql
from keepwell.scratch import materialise
from tests.llm.test_packing import plain_ids
from tests.llm.test_simhash import plain_fingerprint, plain_roots

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, data), name)
        found.append(docs)
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def in_sql(statement, df):
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    return con.execute(statement).df()


def test_stages_return_documents(results):
    for df in results[1:-1]:
        assert df.columns == COLUMNS
        assert all(r.n_chars == len(r.text) for r in df.collect())


def test_quality_stage(results):
    judged = in_sql(sql.QUALITY_RULES, results[0])
    whole = texts(results[0])
    assert texts(results[1]) == {i: whole[i] for i, kept in zip(judged.doc_id, judged.kept) if kept}


def test_line_stage(results):
    cut = in_sql(sql.LINE_DEDUP, results[1])
    assert texts(results[2]) == dict(zip(cut.doc_id, cut.text))


def test_near_duplicate_stage(results):
    before = texts(results[2])
    prints = {i: plain_fingerprint(t) for i, t in before.items()}
    roots = plain_roots(set(prints.values()), 3)
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    assert texts(results[3]) == {i: before[i] for i in least.values()}
    assert len(least) < len(before)


def test_substring_stage(results):
    cut = in_sql(sql.SUBSTRING_DEDUP, results[3])
    assert texts(results[4]) == dict(zip(cut.doc_id, cut.text))


def test_packing_stage(results):
    before = texts(results[4])
    ids = dict(zip(before, plain_ids(before.values())))
    pieces, ends = {}, {}
    for r in results[5].collect():
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
    assert {i: [x for _, part in sorted(p) for x in part] for i, p in pieces.items()} == ids
    assert all(n & (n - 1) == 0 for n in ends.values())
    assert sum(ends.values()) == sum(map(len, ids.values()))


def test_run_gives_the_rows_of_the_stages(spark, data, results):
    assert corpus_pipeline.run(spark, data).count() == results[-1].count()
