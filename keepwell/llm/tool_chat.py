"""Tool-call linking: calls and results joined by identifier, put into order, validated, serialised.

Events are messages, calls and results. A result belongs to the call with its identifier in the same
conversation; a call may use the results of any number of other calls. Events with one parent form chains, which
are followed by doubling: each round joins every event with the one its pointer has reached, so a chain
of n events takes about log2(n) joins. Events with several parents are settled from front to back, as many rounds
as the longest path among them has. Everything runs as DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.operators.ordering import running_totals
from keepwell.scratch import materialise

EVENT_COLUMNS = ("conv_id", "place", "kind", "call_id", "depends_on", "name", "arguments", "content", "role")


@dataclass(frozen=True)
class Parameter:
    """A parameter of a tool; ``kind`` is string, integer, number, boolean, object or array.

    ``options`` lists the allowed values of a string or integer, or of an array's items; ``least`` and ``most``
    bound a number, the code points of a string or the items of an array. ``items`` is the kind of an array's items.
    ``fields`` are the parameters of an object, to any depth; without them it may hold anything.
    """

    name: str
    kind: str
    required: bool = True
    options: tuple[str | int, ...] = ()
    least: float | None = None
    most: float | None = None
    items: str | None = None
    fields: tuple[Parameter, ...] = ()


RULE = (
    "path string, holder string, label string, kind string, required boolean, options array<string>, least double, most double, "
    "items string, fields array<string>"
)


def _rules(params: tuple[Parameter, ...], path: str = "$", label: str = "") -> Iterator[tuple]:
    """One row per parameter at any depth, with its path and that of the object which holds it."""
    for p in params:
        quote = '"' if "'" in p.name else "'"
        inner, shown = f"{path}[{quote}{p.name}{quote}]", f"{label}{p.name}"
        bounds = [None if b is None else float(b) for b in (p.least, p.most)]
        names = [f.name for f in p.fields] or None
        yield inner, path, shown, p.kind, p.required, [str(o) for o in p.options] or None, *bounds, p.items, names
        yield from _rules(p.fields, inner, f"{shown}.")


def tool_table(spark: SparkSession, tools: dict[str, tuple[Parameter, ...]]) -> DataFrame:
    """(tool, params): the rules of each tool; the first, of the arguments as a whole, has the label ''."""
    rows = []
    for tool, params in tools.items():
        whole = ("$", "$", "", "object", True, None, None, None, None, [p.name for p in params])
        rows.append((tool, [whole, *_rules(params)]))
    return spark.createDataFrame(rows, f"tool string, params array<struct<{RULE}>>")


def _kind(schema: Column) -> Column:
    """Kind of a variant value from its schema, as tool schemas name it; NULL for no value."""
    return (
        F.when(schema == "STRING", "string")
        .when(schema == "BIGINT", "integer")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema == "VOID", "null")
        .when(schema.isNotNull(), "number")
    )


def _fits(kind: Column, wanted: Column) -> Column:
    """An integer serves as a number too."""
    return (kind == wanted) | ((wanted == "number") & (kind == "integer"))


def argument_errors(arguments: Column, params: Column) -> Column:
    """Sorted texts, one per fault of the arguments; an empty array if they are valid.

    A fault is a word and the dotted name of the parameter: missing (also within an object that is there), type,
    range, value (not among the options), items (an item of the wrong kind, or not among the options) or unknown (a name
    that the schema lacks). ``params`` is NULL for an unknown tool. A null is a value of the wrong type.
    """
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))

    def look(rule: Column) -> Column:
        value = F.try_variant_get(parsed, rule["path"], "variant")
        holder = F.schema_of_variant(F.try_variant_get(parsed, rule["holder"], "variant"))
        return F.struct(
            rule.alias("rule"), value.alias("value"), _kind(F.schema_of_variant(value)).alias("kind"),
            F.coalesce(holder.startswith("OBJECT"), F.lit(False)).alias("held"),
        )

    def faults(seen: Column) -> Column:
        rule, value, kind = seen["rule"], seen["value"], seen["kind"]
        options, label = rule["options"], rule["label"]
        listed = F.try_variant_get(value, "$", "array<variant>")
        size = (
            F.when(kind == "string", F.char_length(F.try_variant_get(value, "$", "string")).cast("double"))
            .when(kind == "array", F.size(listed).cast("double"))
            .when(kind.isin("integer", "number"), F.try_variant_get(value, "$", "double"))
        )
        other = kind.isin("string", "integer") & ~F.array_contains(options, F.try_variant_get(value, "$", "string"))
        wrong = F.exists(
            listed,
            lambda x: F.coalesce(~_fits(_kind(F.schema_of_variant(x)), rule["items"]), F.lit(False))
            | F.coalesce(~F.array_contains(options, F.try_variant_get(x, "$", "string")), F.lit(False)),
        )
        names = F.when(rule["fields"].isNotNull(), F.map_keys(F.try_variant_get(value, "$", "map<string,variant>")))
        prefix = F.when(label == "", "").otherwise(F.concat(label, F.lit(".")))
        unknown = F.transform(F.array_except(names, rule["fields"]), lambda n: F.concat(F.lit("unknown "), prefix, n))
        named = F.array(*[
            F.when(fault, F.concat(F.lit(word), label))
            for word, fault in (
                ("range ", (size < rule["least"]) | (size > rule["most"])), ("value ", other), ("items ", (kind == "array") & wrong)
            )
        ])
        none = F.array().cast("array<string>")
        return (
            F.when(kind.isNull(), F.when(rule["required"] & seen["held"], F.array(F.concat(F.lit("missing "), label))).otherwise(none))
            .when(~_fits(kind, rule["kind"]), F.array(F.concat(F.lit("type "), label)))
            .otherwise(F.concat(F.filter(named, lambda x: x.isNotNull()), F.coalesce(unknown, none)))
        )

    found = F.flatten(F.transform(F.transform(params, look), faults))
    return (
        F.when(params.isNull(), F.array(F.lit("unknown tool")))
        .when(~is_object, F.array(F.lit("not an object")))
        .otherwise(F.sort_array(found))
    )


def _parents(events: DataFrame) -> Column:
    """Identifiers of the calls whose results a call uses, as an array; ``depends_on`` may hold one or an array."""
    given = F.col("depends_on")
    return given if isinstance(events.schema["depends_on"].dataType, T.ArrayType) else F.when(given.isNotNull(), F.array(given))


def _nodes(events: DataFrame) -> DataFrame:
    """One row per linked call or result: (conv, node, parents, place); the earliest of a repeated one."""
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    kind = F.when(is_call, "c:").when(is_result, "r:")
    used = F.array_distinct(F.filter("depends_on", lambda x: x.isNotNull()))
    parents = F.when(is_result, F.array(F.concat(F.lit("c:"), "call_id"))).otherwise(F.transform(used, lambda x: F.concat(F.lit("r:"), x)))
    named = events.filter(kind.isNotNull() & F.col("call_id").isNotNull()).select(
        F.col("conv_id").alias("conv"), F.concat(kind, "call_id").alias("node"), parents.alias("parents"), "place"
    )
    return named.groupBy("conv", "node").agg(
        F.min("place").alias("place"), F.min_by("parents", F.struct(F.col("place"), F.col("parents"))).alias("parents")
    )


def _under(df: DataFrame, prefix: str) -> DataFrame:
    """The same table under other names, to be joined where pointers point."""
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def _at(pointer: str, other: str, node: str = "node") -> Column:
    return F.col("conv").eqNullSafe(F.col(f"{other}_conv")) & (F.col(pointer) == F.col(f"{other}_{node}"))


def _chains(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv, node, place, pointer, head, ready, depth, linked): every event with where its chain of single parents ends.

    ``head`` is the first event with several parents on the way, itself included, NULL if the chain ends before one;
    ``ready`` and ``depth`` are the latest place and the number of events up to there. A pointer is left only on or
    behind a cycle: rounds end when no pointer is left or their number no longer falls.
    """
    counted = edges.groupBy("conv", "node").agg(F.count("*").alias("n"), F.min("parent").alias("one"))
    counted = materialise(counted, "parents")
    several = F.col("p_n") > 1
    state = materialise(
        nodes.join(_under(counted, "p"), _at("node", "p"), "left").select(
            "conv", "node", "place", F.when(~several, F.col("p_one")).alias("pointer"), F.when(several, F.col("node")).alias("head"),
            F.col("place").alias("ready"), F.when(~several, 1).otherwise(0).cast("long").alias("depth"),
            F.col("p_n").isNotNull().alias("linked"),
        ),
        "pointers",
    )
    left = state.filter("pointer IS NOT NULL").count()
    while left:
        beyond = _under(state.select("conv", "node", "pointer", "head", "ready", "depth"), "b")
        moved = state.join(beyond, _at("pointer", "b"), "left").select(
            "conv", "node", "place", F.col("b_pointer").alias("pointer"), F.coalesce("head", "b_head").alias("head"),
            F.greatest("ready", "b_ready").alias("ready"), (F.col("depth") + F.coalesce("b_depth", F.lit(0))).alias("depth"), "linked",
        )
        state = materialise(moved, "pointers")
        before, left = left, state.filter("pointer IS NOT NULL").count()
        if left == before:
            break
    return state


def _settled(state: DataFrame, edges: DataFrame) -> DataFrame | None:
    """(conv, node, ready, depth) of the events with several parents, but for those on or behind a cycle.

    Each round settles the events whose parents all are and joins the rest with them.
    """
    heads = state.filter(F.col("head") == F.col("node"))
    if heads.isEmpty():
        return None
    own = _under(heads.select("conv", "node", "place"), "o")
    reached = _under(state.select("conv", "node", "pointer", "head", "ready", "depth"), "s")
    waiting = edges.join(own, _at("node", "o")).join(reached, _at("parent", "s")).select(
        "conv", "node", F.col("s_head").alias("head"), F.greatest("o_place", "s_ready").alias("ready"),
        (F.col("s_depth") + 1).alias("depth"), F.col("s_pointer").isNotNull().alias("stuck"),
    )
    done = None
    while True:
        waiting = materialise(waiting, "waiting")
        grouped = waiting.groupBy("conv", "node").agg(
            F.max("ready").alias("ready"), F.max("depth").alias("depth"), F.max(F.col("stuck") | F.col("head").isNotNull()).alias("open")
        )
        ready = materialise(grouped.filter(~F.col("open")).drop("open"), "settled")
        if ready.isEmpty():
            return done if done is not None else ready
        done = ready if done is None else done.unionByName(ready)
        gone, found = _under(ready.select("conv", "node"), "g"), _under(ready, "f")
        waiting = waiting.join(gone, _at("node", "g"), "left_anti").join(found, _at("head", "f"), "left").select(
            "conv", "node", F.when(F.col("f_node").isNull(), F.col("head")).alias("head"), F.greatest("ready", "f_ready").alias("ready"),
            (F.col("depth") + F.coalesce("f_depth", F.lit(0))).alias("depth"), "stuck",
        )


def follow_parents(nodes: DataFrame) -> DataFrame:
    """(conv, node, ready, depth, linked, cyclic): the latest place before each event, its own included, and the longest
    path of events before it. Parents that are not there are left out. An event on or behind a cycle keeps its own place.
    """
    known = _under(nodes.select("conv", "node"), "k")
    listed = nodes.select("conv", "node", F.explode("parents").alias("parent"))
    edges = materialise(listed.join(known, _at("parent", "k")).select("conv", "node", "parent"), "edges")
    state = _chains(nodes, edges)
    settled = _settled(state, edges)
    if settled is None:
        settled = state.select("conv", "node", "ready", "depth").limit(0)
    cyclic = F.col("pointer").isNotNull() | (F.col("head").isNotNull() & F.col("d_node").isNull())
    return state.join(_under(settled, "d"), _at("head", "d"), "left").select(
        "conv", "node", F.when(cyclic, F.col("place")).otherwise(F.greatest("ready", "d_ready")).alias("ready"),
        F.when(cyclic, 0).otherwise(F.col("depth") + F.coalesce("d_depth", F.lit(0))).alias("depth"), "linked", cyclic.alias("cyclic"),
    )


def link_tool_calls(events: DataFrame, tools: DataFrame) -> DataFrame:
    """Per event: conv_id, position, kind, call_id, status, errors and its canonical ``json``.

    ``position`` numbers the events of a conversation from 0 so that each follows all that it rests on, and otherwise by
    place. ``status`` is ok, message, unanswered (a call without a result), orphan (a result without a
    call), cycle, or repeated (an identifier met before; only the earliest event carries it); ``errors``
    joins the faults of a call's arguments. JSON has sorted keys, no spaces, and NULLs written out; arguments that
    are not JSON are a string in it.

    Only EVENT_COLUMNS are read; ``depends_on`` is an identifier or an array of them, an array in the JSON. A NULL conversation is one conversation, a NULL place comes first, a call or result without an
    identifier is an orphan or unanswered, identifiers in ``depends_on`` that are NULL, repeated or of no result are passed over, and events that are equal in all columns keep one position each. An empty table gives an empty
    result. A conversation with very many events is sorted in slices, not in one task.
    """
    node = F.when(F.col("call_id").isNotNull(), F.concat(F.when(F.col("kind") == "call", "c:").when(F.col("kind") == "result", "r:"), "call_id"))
    events = events.withColumn("depends_on", _parents(events)).select(*EVENT_COLUMNS).withColumn("node", node)
    nodes = materialise(_nodes(events), "nodes")
    followed = follow_parents(nodes).withColumnsRenamed({"conv": "f_conv", "node": "f_node"})
    answered = nodes.filter(F.col("node").startswith("r:")).select(
        F.col("conv").alias("a_conv"), F.concat(F.lit("c:"), F.substring("node", 3, 1 << 30)).alias("a_node")
    )
    least = nodes.select(F.col("conv").alias("l_conv"), F.col("node").alias("l_node"), F.col("place").alias("least"))
    calls = events.withColumn("row", F.monotonically_increasing_id())
    joined = (
        materialise(calls, "events")
        .join(followed, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("node") == F.col("f_node")), "left")
        .join(least, F.col("conv_id").eqNullSafe(F.col("l_conv")) & (F.col("node") == F.col("l_node")), "left")
        .join(answered, F.col("conv_id").eqNullSafe(F.col("a_conv")) & (F.col("node") == F.col("a_node")), "left")
        .join(tools, F.col("name") == F.col("tool"), "left")
    )
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    status = (
        F.when(~(is_call | is_result), "message")
        .when(F.col("place") > F.col("least"), "repeated")
        .when(F.col("cyclic"), "cycle")
        .when(is_result & ~F.coalesce("linked", F.lit(False)), "orphan")
        .when(is_call & F.col("a_node").isNull(), "unanswered")
        .otherwise("ok")
    )
    errors = F.when(is_call, F.concat_ws(",", argument_errors(F.col("arguments"), F.col("params"))))
    ready = F.coalesce("ready", "place")
    placed = joined.select(
        "conv_id", "kind", "call_id", "depends_on", "name", "arguments", "content", "role", "place", "row",
        ready.alias("ready"), F.coalesce("depth", F.lit(0)).alias("depth"), status.alias("status"), errors.alias("errors"),
    )
    order = [F.col(c) for c in ("conv_id", "ready", "depth", "place", "row")]
    placed = materialise(placed, "placed")  # the cut into ranges reads it twice
    counted = materialise(running_totals(placed, order, {"upto": F.lit(1)}), "ordered")
    starts = counted.groupBy(F.col("conv_id").alias("s_conv")).agg(F.min("upto").alias("start"))
    starts = materialise(starts, "starts")  # written, so that the join of a hot conversation is split
    return counted.join(starts, F.col("conv_id").eqNullSafe(F.col("s_conv"))).select(
        "conv_id", (F.col("upto") - F.col("start")).cast("long").alias("position"), "kind", "call_id", "status",
        F.coalesce("errors", F.lit("")).alias("errors"), canonical_json().alias("json"),
    )


def canonical_json() -> Column:
    """One event as JSON text; the arguments are set in with their own keys sorted."""
    rest = F.to_json(F.struct("call_id", "content", "depends_on", "kind", "name", "role"), {"ignoreNullFields": "false"})
    plain = F.to_json(F.struct(F.col("arguments").alias("v")), {"ignoreNullFields": "false"})
    sorted_json = F.to_json(F.try_parse_json("arguments"))
    as_text = F.regexp_extract(plain, r'(?s)^\{"v":(.*)\}$', 1)
    return F.concat(F.lit('{"arguments":'), F.coalesce(sorted_json, as_text), F.lit(","), F.substring(rest, 2, 1 << 30))
