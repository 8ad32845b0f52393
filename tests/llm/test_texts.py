"""Quality rules, line dedup and substring dedup against their SQL counterparts and small cases."""

import pytest
from pyspark.sql import functions as F

from keepwell.llm import line_dedup, quality_rules, registry, sql, substring_dedup
from tests.llm.conftest import corpus, sentence
from tests.llm.duck import assert_same

PASSAGE = "The first of many words. " + " ".join(f"And sentence {k} of it has words enough." for k in range(9))


@pytest.fixture(scope="module")
def documents(spark, awkward):
    """Texts with shared passages, log lines and repeats; no repeated rows, which SQL counts apart."""
    texts = [t for k, t in enumerate(awkward) if k != 4 and t[0] is not None]
    texts = [(100 + k, t) for k, (_, t) in enumerate(texts)]
    for k in range(40):
        log = f"connect from 10.0.0.{k} port {k * 37} accepted\nUser u{k} logged in at {k}:{k}"
        own = sentence(1000 + k, 30)
        texts.append((k, f"{own}\n{log}\n{own[:50]} {PASSAGE if k % 7 == 0 else ''} tail {k}\n*** $$$ {k}\n\n{sentence(k % 3, 12)}"))
    texts += [(200 + k, f"{sentence(k, 20)} | # $ % & * | " * 3) for k in range(5)]
    texts += [(300 + k, "line of words again\n" * (k + 2)) for k in range(5)]
    return corpus(spark, texts).cache()


def query_like(cut):
    return registry._with_spans(cut)


def test_quality_rules_as_in_sql(documents):
    judged, _ = quality_rules.quality_rules(documents, carry=["doc_id"])
    assert_same(judged, sql.QUALITY_RULES, documents=documents.select("doc_id", "text", "lang", "source"))


def test_line_dedup_as_in_sql(documents):
    cut = query_like(line_dedup.line_dedup(documents, carry=["doc_id", "text"]))
    assert_same(cut, sql.LINE_DEDUP, documents=documents.select("doc_id", "text"))
    by_id = {r.doc_id: r for r in cut.collect()}
    assert "connect from" in by_id[0].text and "connect from" not in by_id[1].text
    assert "User" not in by_id[39].text and sentence(1039, 30) in by_id[39].text


def test_substring_dedup_as_in_sql(documents):
    cut = query_like(substring_dedup.substring_dedup(documents, carry=["doc_id", "text"]))
    assert_same(cut, sql.SUBSTRING_DEDUP, documents=documents.select("doc_id", "text"))
    by_id = {r.doc_id: r for r in cut.collect()}
    assert PASSAGE in by_id[0].text
    assert all("sentence 3" not in by_id[k].text and f"tail {k}" in by_id[k].text for k in (7, 14, 21, 28, 35))


def test_every_repeated_unit_goes(spark, documents, tmp_path):
    cut = query_like(substring_dedup.substring_dedup(
        documents, carry=["doc_id", "text"], min_words=substring_dedup.EVERY_UNIT
    ))
    assert_same(cut, sql.SUBSTRING_DEDUP_UNITS, documents=documents.select("doc_id", "text"))

    inner = "Five words stand right here. " + " ".join(f"Then six more words stand {k}." for k in range(3)) + " "
    shared = sentence(7, 16) + ". " + inner + "Last " + sentence(8, 15)
    assert len(shared.split()) == 55
    texts = [(1, f"Alpha {shared} beta gamma."), (2, f"Delta own {shared} other end."), (3, "Then six more words stand 1.")]
    path = str(tmp_path / "documents.parquet")
    corpus(spark, texts).write.parquet(path)
    found = {r.doc_id: r.text for r in registry.queries()["op4_substring_dedup_units"](spark, str(tmp_path)).collect()}
    assert found[1] == texts[0][1] and found[3] == ""
    assert found[2] == texts[1][1].replace(inner, "")


def test_lines_and_paragraphs_as_units(spark):
    block = "One line here\nand a second line\n\n"
    docs = corpus(spark, [(1, block + "own words\n\n"), (2, "and a second line\nother\n\n" + block)]).withColumn("removed", F.lit(1))
    for kind, left in (("lines", "other\n\n\n"), ("paragraphs", "and a second line\nother\n\n")):
        cut = substring_dedup.substring_dedup(docs, min_words=1, units=kind)
        assert cut.columns == [*docs.columns, "_removed"]
        assert {r.doc_id: r.text for r in cut.collect()} == {1: block + "own words\n\n", 2: left}


def test_long_text_with_many_runs(spark):
    lines = [f"mine {k}\n" if k % 2 else f"shared number {k}\n" for k in range(1500)]
    docs = corpus(spark, [(1, "".join(lines[::2])), (2, "".join(lines))])
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(docs, min_words=1, units="lines").collect()}
    assert found[2].text == "".join(lines[1::2]) and len(found[2].removed) == 750
    whole = "".join(lines)
    assert "".join(whole[s["start"] : s["end"]] for s in found[2].removed) == "".join(lines[::2])


def test_spans_are_offsets_of_the_whole_text(documents):
    for operator in (line_dedup.line_dedup, substring_dedup.substring_dedup):
        whole = {r.doc_id: r.text for r in documents.collect()}
        for r in operator(documents, carry=["doc_id", "text"]).collect():
            text, at = whole[r.doc_id], 0
            if text is None:
                assert r.text is None and r.removed == []
                continue
            kept = ""
            for span in r.removed:
                kept, at = kept + text[at : span["start"]], span["end"]
            assert kept + text[at:] == r.text


def test_repeated_rows_and_copies(spark):
    texts = [(1, PASSAGE), (1, PASSAGE), (2, PASSAGE), (None, PASSAGE), (3, None), (3, "")]
    cut = substring_dedup.substring_dedup(corpus(spark, texts))
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == sorted(
        [(1, PASSAGE), (1, PASSAGE), (2, ""), (None, ""), (3, None), (3, "")], key=repr
    )
    lines = line_dedup.line_dedup(corpus(spark, texts * 12))
    assert lines.filter(F.size("removed") > 0).count() == 0  # copies of a text count once


def test_windows_found_twice(spark):
    def count(text):
        docs = corpus(spark, [(1, text)])
        measured, names = quality_rules.measure(docs, "text", ["doc_id"])
        return measured.first()[names["n_repeat_words"]]

    assert count("a b c d e") == 0
    assert count("a b c d e x a b c d e") == 10
    assert count("a a a a a a") == 6
    assert count("a b c d e f a b c d e f g") == 12


def test_small_groups_take_the_thresholds_of_their_language(spark):
    good = [(k, sentence(k, 60)) for k in range(60)]
    docs = corpus(spark, [*good, (99, " ".join("x#$%" for _ in range(1)) + " " + " ".join(f"#{k}$%&*" for k in range(60)))])
    kept = quality_rules.kept_documents(docs.withColumn("source", F.concat(F.lit("s"), F.col("doc_id").cast("string"))))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))


def test_every_signal_can_reject_by_the_tail_of_its_group(spark):
    def lines(k, twice):
        own = [sentence(60 * k + j, 6) for j in range(12)]
        return "\n".join([*own, *own[:twice]])

    texts = [(k, lines(k, 0)) for k in range(120)]
    odd = {
        900: " ".join(f"{w}abcdefghij" for w in lines(900, 0).split(" ")), 901: lines(901, 0) + " ### $$$",
        902: lines(902, 0) + "\n-" * 9, 903: lines(903, 0) + " " + " ".join(lines(903, 0).split()[:7]),
    }
    docs = corpus(spark, [*texts, *odd.items()]).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    judged, names = quality_rules.quality_rules(docs, carry=["doc_id"])
    assert judged.filter(names["base_failed"]).count() == 0
    assert {r.doc_id for r in judged.filter(names["kept"]).collect()} == set(range(120))


def test_empty_tables_and_columns(spark):
    docs = corpus(spark, [])
    assert quality_rules.kept_documents(docs).columns == docs.columns
    for result in (quality_rules.kept_documents(docs), line_dedup.without_recurring_lines(docs), substring_dedup.without_repeats(docs)):
        assert result.columns == docs.columns and result.count() == 0
