"""Cutting numbered units, such as lines, out of texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import fresh_name, let, row_key

SPANS = "array<struct<start: long, end: long>>"
#: Running sums are taken in blocks, so that a text with very many runs costs little more per run.
SUM_BLOCK = 256


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def running_sums(values: Column) -> Column:
    """Sum of the array's values up to each of them."""
    size = F.size(values)

    def with_blocks(blocks: Column) -> Column:
        def upto(_: Column, i: Column) -> Column:
            block = F.shiftright(i, 8)
            inside = F.slice(values, block * SUM_BLOCK + 1, i - block * SUM_BLOCK + 1)
            return _total(F.slice(blocks, F.lit(1), block)) + _total(inside)

        return F.transform(values, upto)

    numbers = F.sequence(F.lit(0), F.shiftright(F.greatest(size - 1, F.lit(0)), 8))
    return let(F.transform(numbers, lambda b: _total(F.slice(values, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK)))), with_blocks)


def cut_column(units: Column, runs: Column) -> Column:
    """Struct of the text without the runs of units, and the (start, end) of each run in the whole text."""

    def joined(u: Column, first: Column, beyond: Column) -> Column:
        return F.array_join(F.slice(u, first + 1, beyond - first), "")

    def cut(u: Column, r: Column) -> Column:
        def between(i: Column) -> Column:
            first = F.coalesce(F.get(r, i - 1)["last"] + 1, F.lit(0))
            return joined(u, first, F.coalesce(F.get(r, i)["first"], F.size(u)))

        def spans(kept: Column) -> Column:
            gone = F.transform(r, lambda x: F.length(joined(u, x["first"], x["last"] + 1)).cast("long"))
            steps = let(gone, lambda g: F.zip_with(F.slice(kept, F.lit(1), F.size(r)), g, _step))
            return let(steps, lambda s: F.zip_with(s, let(F.transform(s, lambda x: x["step"]), running_sums), _span))

        pieces = F.transform(F.sequence(F.lit(0), F.size(r)), between)
        return let(pieces, lambda kept: F.struct(F.array_join(kept, "").alias("text"), spans(kept).alias("spans")))

    return let(units, lambda u: let(F.sort_array(runs), lambda r: cut(u, r)))


def _step(kept: Column, gone: Column) -> Column:
    return F.struct(gone.alias("gone"), (F.length(kept) + gone).alias("step"))


def _span(step: Column, end: Column) -> Column:
    return F.struct((end - step["gone"]).alias("start"), end.alias("end"))


def remove_runs(
    docs: DataFrame, runs: DataFrame, id_col: str, text_col: str, units: Column, carry: Sequence[str]
) -> DataFrame:
    """``carry`` columns with the text cut, and a column ``removed`` with the spans in the whole text.

    ``runs`` has (id, key, runs): arrays of (first, last) unit numbers. Texts are cut by column expressions,
    row by row, and only where something goes. Where ``removed`` would clash with a carried name it gets underscores in front.
    """
    key, cut_name = fresh_name(docs.columns, "key"), fresh_name(docs.columns, "cut")
    runs = runs.withColumnsRenamed({c: fresh_name(docs.columns, f"_run_{c}") for c in runs.columns})
    run_id, run_key, run_list = runs.columns
    runs = runs.hint("shuffle_hash")  # the texts are moved once and never sorted, whatever the number of runs
    keyed = docs.withColumn(key, row_key(F.col(id_col), F.col(text_col)))
    joined = keyed.join(runs, (keyed[key] == runs[run_key]) & keyed[id_col].eqNullSafe(runs[run_id]), "left")
    hit = F.col(run_list).isNotNull()
    done = joined.withColumn(cut_name, F.when(hit, cut_column(units, F.col(run_list))))
    text = F.when(hit, F.col(cut_name)["text"]).otherwise(F.col(text_col))
    spans = F.coalesce(F.col(cut_name)["spans"], F.array().cast(SPANS))
    return done.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in carry],
        spans.alias(fresh_name(carry, "removed")),
    )


def texts_replaced(cut_docs: DataFrame, docs: DataFrame, text_col: str, length_col: str) -> DataFrame:
    """The columns of ``docs``; the character count, if there is one, follows the new text."""
    return cut_docs.select(
        *[
            F.length(text_col).cast(docs.schema[c].dataType).alias(c) if c == length_col else F.col(c)
            for c in docs.columns
        ]
    )
