"""From raw documents to packed training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keepwell.llm import line_dedup, packing, quality_rules, simhash, substring_dedup
from keepwell.llm.common import read_table
from keepwell.scratch import materialise


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    return quality_rules.kept_documents(docs)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines of recurring templates are dropped, except the earliest of each template."""
    return line_dedup.without_recurring_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document with the smallest identifier of each group stays."""
    return simhash.first_of_groups(docs, shingle=3, radius=3)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages that an earlier document has are cut out."""
    return substring_dedup.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: one row per piece of a document, with its token ids and its place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_recurring_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

# Packing needs a tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again for the next stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
