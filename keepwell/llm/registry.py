"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.llm import (
    exact_search, lexical_search, line_dedup, packing, quality_rules, sampled_pieces, sharding, simhash, spelling, sql, substring_dedup,
    token_counts, token_files, tool_chat,
)
from keepwell.llm.common import read_table
from keepwell.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return quality_rules.quality_rules(docs, carry=["doc_id"])[0]


def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    grouped = simhash.simhash_groups(docs, shingle=3, radius=3)
    return grouped.select("doc_id", "fingerprint", "component_id")


def _with_spans(cut: DataFrame) -> DataFrame:
    """Spans as text, which both engines write alike."""
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return cut.select(
        "doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.concat_ws(",", spans).alias("removed")
    )


def _substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return _with_spans(substring_dedup.substring_dedup(docs, carry=["doc_id", "text"]))


def _substring_dedup_units(spark: SparkSession, folder: str) -> DataFrame:
    """Every repeated unit but the earliest is cut, however short."""
    docs = read_table(spark, folder, "documents")
    every = substring_dedup.EVERY_UNIT
    return _with_spans(substring_dedup.substring_dedup(docs, carry=["doc_id", "text"], min_words=every))


def _line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return _with_spans(line_dedup.line_dedup(docs, carry=["doc_id", "text"]))


def _packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def _sampled_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the sampled segmentations, and of the texts that they decode to."""
    docs = read_table(spark, folder, "documents")
    return sampled_pieces.sample_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)


def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    cache = scratch_path(spark, "token-counts")
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), cache)


def _sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(read_table(spark, folder, "documents"), 16)


def _exact_search(spark: SparkSession, folder: str) -> DataFrame:
    return exact_search.exact_top_k(read_table(spark, folder, "embeddings"), 5)


def _spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_groups(spelling.document_words(read_table(spark, folder, "documents")))


def _ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked_search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def _token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return token_files.file_digests(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "token-files"))


_SOURCE = tool_chat.Parameter(
    "source", "object", fields=(tool_chat.Parameter("conv", "integer"), tool_chat.Parameter("turn", "integer", most=5))
)
#: The tools that the turns of ``conversations`` are read as calls of.
TOOLS = {
    "ask": (
        tool_chat.Parameter("text", "string", most=300), tool_chat.Parameter("words", "integer", most=50), _SOURCE,
        tool_chat.Parameter("tags", "array", items="string", options=("long", "question")),
    ),
    "note": (
        tool_chat.Parameter("text", "string", least=10), tool_chat.Parameter("words", "integer", options=(4, 5, 6, 7)), _SOURCE,
        tool_chat.Parameter("tags", "array", required=False, items="string", most=1),
    ),
}


def turn_events(turns: DataFrame) -> DataFrame:
    """User turns as calls, the turn after each as its result, all others as messages.

    A call with up to eight words is of the tool ``note``, others of ``ask``. Of four calls in eight turns, the second and
    third use the result of the first, and the last uses both of theirs. Arguments are the text, its words, tags of what it
    is like and where it comes from.
    """
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[^ ]+"))
    user, answer = F.col("role") == "user", F.col("role") == "assistant"
    identifier = F.concat(F.lit("q"), F.when(user, F.col("turn")).when(answer, F.col("turn") - 1).cast("string"))
    phase = F.col("turn") % 8
    earlier = [F.concat(F.lit("q"), (F.col("turn") - back).cast("string")) for back in (4, 2)]
    first = F.concat(F.lit("q"), (F.col("turn") - phase).cast("string"))
    uses = F.when(user & phase.between(2, 5), F.array(first)).when(user & (phase > 5), F.array(*earlier))
    marks = (("long", words > 32), ("question", F.col("text").contains("?")), ("lines", F.col("text").contains("\n")))
    tags = F.filter(F.array(*[F.when(mark, tag) for tag, mark in marks]), lambda x: x.isNotNull())
    source = F.struct(F.col("conv_id").alias("conv"), "turn")
    fields = F.struct(source.alias("source"), tags.alias("tags"), "text", words.cast("long").alias("words"))
    arguments = F.to_json(fields, {"ignoreNullFields": "false"})
    return turns.select(
        "conv_id", F.col("turn").alias("place"),
        F.when(user, "call").when(answer, "result").otherwise("message").alias("kind"),
        identifier.alias("call_id"), uses.alias("depends_on"),
        F.when(user, F.when(words <= 8, "note").otherwise("ask")).alias("name"),
        F.when(user, arguments).alias("arguments"), F.when(~user, F.col("text")).alias("content"), "role",
    )


def _tool_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations")
    return tool_chat.link_tool_calls(turn_events(turns), tool_chat.tool_table(spark, TOOLS))


def queries() -> dict[str, Query]:
    return {
        "op1_sampled_pieces": _sampled_pieces,
        "op2_exact_search": _exact_search,
        "op3_simhash_dedup": _simhash,
        "op4_substring_dedup": _substring_dedup,
        "op4_substring_dedup_units": _substring_dedup_units,
        "op5_line_dedup": _line_dedup,
        "op6_token_counts": _token_counts,
        "op7_packing": _packing,
        "op8_sharding": _sharding,
        "op9_tool_chat": _tool_chat,
        "op10_quality_rules": _quality_rules,
        "op11_spelling_groups": _spelling,
        "op12_ranked_search": _ranked_search,
        "op13_token_files": _token_files,
        "op10_quality_rules_tails": _quality_rules,  # the same query under its earlier name
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_search": sql.EXACT_SEARCH,
        "op4_substring_dedup": sql.SUBSTRING_DEDUP,
        "op4_substring_dedup_units": sql.SUBSTRING_DEDUP_UNITS,
        "op5_line_dedup": sql.LINE_DEDUP,
        "op9_tool_chat": sql.TOOL_CHAT,
        "op10_quality_rules": sql.QUALITY_RULES,
        "op12_ranked_search": sql.RANKED_SEARCH,
        "op10_quality_rules_tails": sql.QUALITY_RULES,
    }
