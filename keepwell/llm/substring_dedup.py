"""Substring dedup by hashing units of text across all documents.

Units are lines, paragraphs or, by default, phrases: a phrase ends with a line, after the white space that
follows a full stop, exclamation or question mark, and before a capitalised word, so that a passage set into
other prose falls into the same units wherever it stands. Units are normalised (lower case, single spaces) and grouped by a 128-bit digest; the earliest
occurrence, by identifier and place, stays. Repeated units are removed where they stand in a row with
``min_words`` words or more between them, so single common phrases are left alone. ``EVERY_UNIT`` removes each
repeated unit: the whole units inside a passage go, however few words they hold together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.common import SPACE_CLASS, SPACES, row_key
from keepwell.llm.units import remove_runs, texts_replaced
from keepwell.scratch import discard, materialise

#: Where a text is cut into units, by their kind.
BOUNDARIES = {
    "phrases": r"(?<=\n)|(?<=[ \t\r])(?=\p{Lu})|(?<=[.!?][ \t\r])(?=\S)",
    "lines": r"(?<=\n)",
    "paragraphs": r"(?<=\n\n)(?!\n)",
}
MIN_WORDS = 30
EVERY_UNIT = 1


def units_of(text: Column, kind: str = "phrases") -> Column:
    return F.split(text, BOUNDARIES[kind], -1)


def list_units(docs: DataFrame, id_col: str, text_col: str, kind: str = "phrases") -> DataFrame:
    """One row per unit that has a word: its document, order among those units, place, words, digest."""
    placed = F.transform(units_of(F.col(text_col), kind), lambda u, k: F.struct(k.alias("place"), u.alias("unit")))
    worded = F.filter(placed, lambda x: x["unit"].rlike(f"[^{SPACE_CLASS[1:]}"))
    listed = docs.select(
        F.col(id_col).alias("id"),
        row_key(F.col(id_col), F.col(text_col)).alias("key"),
        F.posexplode(worded).alias("number", "placed"),
    )
    plain = F.regexp_replace(F.btrim(F.lower("placed.unit"), F.lit(SPACES)), SPACE_CLASS + "+", " ")
    return listed.select("id", "key", "number", "placed.place", plain.alias("plain")).select(
        "id", "key", "number", "place",
        F.regexp_count("plain", F.lit("[^ ]+")).alias("words"),
        F.unhex(F.md5("plain")).alias("digest"),
    )


def repeated_runs(units: DataFrame, min_words: int) -> DataFrame:
    """(id, key, runs) of the documents that lose units; each run is (first, last) place.

    A digest that very many documents share is only a key of a partial aggregate and of a join with one
    row per digest on its other side.
    """
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "key", "number")
    counted = units.groupBy("digest").agg(F.count("*").alias("n"), F.min(rank).alias("first"))
    repeated = materialise(counted.filter("n > 1").drop("n"), "repeated")
    later = units.join(repeated, "digest").filter(rank != F.col("first"))
    marked = later.select("id", "key", "number", "place", "words").distinct()
    row = F.col("number") - F.row_number().over(Window.partitionBy("id", "key").orderBy("number"))
    runs = (
        marked.withColumn("row", row)
        .groupBy("id", "key", "row")
        .agg(F.sum("words").alias("words"), F.min("place").alias("first"), F.max("place").alias("last"))
        .filter(F.col("words") >= min_words)
    )
    listed = materialise(runs.groupBy("id", "key").agg(F.collect_list(F.struct("first", "last")).alias("runs")), "runs")
    discard(repeated)
    return listed


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    min_words: int = MIN_WORDS,
    units: str = "phrases",
) -> DataFrame:
    """``carry`` columns (default: all) with repeated passages cut, and ``removed``, their original spans.

    ``units`` is phrases, lines or paragraphs. Offsets count characters (code points). A very long text is cut by
    array expressions in time proportional to its units. A carried column ``removed`` keeps its name and
    the spans get underscores in front. NULL texts stay NULL, empty ones empty; a text made of repeats
    only becomes empty, and its row stays. Rows rank by identifier, NULL last, and then by a hash of the text; repeated rows (equal identifier
    and text) count as one document and have equal results. An empty table gives an empty result.
    """
    carry = docs.columns if carry is None else list(carry)
    listed = materialise(list_units(docs, id_col, text_col, units), "units")
    runs = repeated_runs(listed, min_words)
    discard(listed)
    return remove_runs(docs, runs, id_col, text_col, units_of(F.col(text_col), units), carry)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with repeated passages cut and their columns as they are."""
    return texts_replaced(substring_dedup(docs, id_col, text_col), docs, text_col, length_col)
