"""Line dedup by a tree of line templates.

A line descends by its number of tokens and its leading tokens, those with digits as a wildcard, to a leaf
of fixed depth. Within a leaf, a token that stands at the same position in ``min_docs`` documents is constant
and all others are variable fields, so the template of a line is its constant tokens with wildcards
between them; a line of which less than ``similar`` of the tokens are constant has none. A template found in
``min_docs`` documents is recurring: its earliest line stays, all others are dropped.

The tree is grown by counting, not line by line, so the result does not depend on the order of the lines and
no leaf has to fit into a task. Documents are told apart by identifier and text, so copies of a text under
other identifiers count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import SPACE_CLASS, SPACES, row_key, words_of
from keepwell.llm.units import remove_runs, texts_replaced
from keepwell.scratch import materialise

WILDCARD = "<*>"


def lines_of(text: Column) -> Column:
    """Lines with the line ends that close them."""
    return F.split(text, r"(?<=\n)", -1)


def list_lines(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """One row per line that has a word, with its leading tokens, joined."""
    listed = docs.select(
        F.col(id_col).alias("id"),
        row_key(F.col(id_col), F.col(text_col)).alias("key"),
        F.posexplode(lines_of(F.col(text_col))).alias("line", "content"),
    ).withColumn("content", F.btrim("content", F.lit(SPACES)))
    first = F.slice(F.split("content", SPACE_CLASS + "+", depth + 1), 1, depth)
    lead = F.transform(first, lambda t: F.when(t.rlike("[0-9]"), WILDCARD).otherwise(t))
    return listed.filter("content <> ''").withColumn("lead", F.concat_ws(" ", lead))


def candidate_lines(docs: DataFrame, id_col: str, text_col: str, depth: int, min_docs: int) -> DataFrame:
    """(id, key, line, leaf, plain) of the lines whose leaf is in ``min_docs`` documents.

    Lines whose leading tokens alone are in too few documents are left out before all tokens are read.
    """
    lines = list_lines(docs, id_col, text_col, depth)
    leads = materialise(_in_documents(lines, ["lead"], min_docs), "leads")
    tokens = words_of(F.col("content"))
    inner = lines.join(leads, "lead", "left_semi").select(
        "id", "key", "line",
        F.concat_ws(" ", F.size(tokens).cast("string"), "lead").alias("leaf"),
        F.array_join(tokens, " ").alias("plain"),
    )
    inner = materialise(inner.distinct(), "lines")
    leaves = materialise(_in_documents(inner, ["leaf"], min_docs), "leaves")  # written, so that a hot leaf's join is split
    return inner.join(leaves, "leaf", "left_semi")


def _in_documents(df: DataFrame, keys: Sequence[str], min_docs: int) -> DataFrame:
    """The keys that are in ``min_docs`` different documents."""
    seen = df.select(*keys, "key").distinct().groupBy(*keys).agg(F.count("*").alias("n"))
    return seen.filter(F.col("n") >= min_docs).select(*keys)


def _tokens(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, F.posexplode(F.split("plain", " ")).alias("at", "token"))


def line_templates(lines: DataFrame, min_docs: int, similar: float) -> DataFrame:
    """(leaf, plain, template) for every different line that has a template.

    All tokens of a line that is itself in ``min_docs`` documents are constant, so the line is its own
    template. A token of no such line is counted over the documents of the other lines alone.
    """
    counted = lines.select("leaf", "plain", "key").distinct().groupBy("leaf", "plain").agg(F.count("*").alias("n"))
    contents = materialise(counted.withColumn("no", F.monotonically_increasing_id()), "contents")
    common, rare = contents.filter(F.col("n") >= min_docs), contents.filter(F.col("n") < min_docs)
    rare_lines = lines.join(rare.select("leaf", "plain"), ["leaf", "plain"], "left_semi")
    counts = _in_documents(_tokens(rare_lines, "leaf", "key"), ["leaf", "at", "token"], min_docs)
    constant = counts.unionByName(_tokens(common, "leaf")).distinct().withColumn("constant", F.lit(True))
    constant = materialise(constant, "constant")
    field = F.when(F.col("constant"), F.col("token")).otherwise(WILDCARD)
    parsed = (
        _tokens(rare, "no", "leaf")
        .join(constant, ["leaf", "at", "token"], "left")
        .groupBy("no")
        .agg(
            F.sort_array(F.collect_list(F.struct("at", field.alias("field")))).alias("fields"),
            F.count("constant").alias("constants"),
        )
        .filter(F.col("constants") >= F.size("fields") * similar)
        .select("no", F.concat_ws(" ", "fields.field").alias("template"))
    )
    own = common.select("leaf", "plain", F.col("plain").alias("template"))
    return rare.join(parsed, "no").select("leaf", "plain", "template").unionByName(own)


def recurring_lines(
    docs: DataFrame, id_col: str, text_col: str, depth: int, min_docs: int, similar: float
) -> DataFrame:
    """(id, key, line, template) of the lines to drop."""
    lines = materialise(candidate_lines(docs, id_col, text_col, depth, min_docs), "candidates")
    templates = materialise(line_templates(lines, min_docs, similar), "templates")
    parsed = lines.join(templates, ["leaf", "plain"]).select("id", "key", "line", "template")
    parsed = materialise(parsed, "parsed")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "key", "line")
    first = parsed.groupBy("template").agg(F.min(rank).alias("first"))
    recurring = materialise(_in_documents(parsed, ["template"], min_docs).join(first, "template"), "recurring")
    later = parsed.join(recurring, "template")
    return later.filter(rank != F.col("first")).select("id", "key", "line", "template")


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    depth: int = 3,
    min_docs: int = 10,
    similar: float = 0.5,
) -> DataFrame:
    """``carry`` columns (default: all) with lines of recurring templates dropped, and ``removed``.

    ``removed`` lists the dropped lines as spans of the original text; a line goes with its line end. A carried
    column ``removed`` keeps its name and the spans get underscores in front. Very long texts are rows of
    lines like all others; a line of very many words is one row.
    NULL texts stay NULL, empty ones empty, and lines without a word stay. Rows rank by identifier, NULL last,
    and then by a hash of the text; repeated rows (equal identifier and text) count as one document and have equal results. An empty
    table gives an empty result.
    """
    carry = docs.columns if carry is None else list(carry)
    dropped = recurring_lines(docs, id_col, text_col, depth, min_docs, similar)
    one = F.struct(F.col("line").alias("first"), F.col("line").alias("last"))
    runs = materialise(dropped.groupBy("id", "key").agg(F.collect_list(one).alias("runs")), "runs")
    return remove_runs(docs, runs, id_col, text_col, lines_of(F.col(text_col)), carry)


def without_recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars"
) -> DataFrame:
    """The documents with recurring lines dropped and their columns as they are."""
    return texts_replaced(line_dedup(docs, id_col, text_col), docs, text_col, length_col)
