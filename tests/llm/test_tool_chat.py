import json
import random

from keepwell.llm import registry, sql, tool_chat
from keepwell.llm.tool_chat import Parameter
from tests.llm.duck import assert_same

TOOLS = {"add": (Parameter("x", "number"), Parameter("y", "number"), Parameter("note", "string", required=False))}
SCHEMA = "conv_id long, place long, kind string, call_id string, depends_on string, name string, arguments string, content string, role string, node string, row int"


def link(spark, events, tools=TOOLS):
    names = tool_chat.EVENT_COLUMNS
    rows = [tuple(e.get(n) for n in names) + ("x", k) for k, e in enumerate(events)]
    several = any(isinstance(e.get("depends_on"), list) for e in events)
    schema = SCHEMA.replace("depends_on string", "depends_on array<string>") if several else SCHEMA
    linked = tool_chat.link_tool_calls(spark.createDataFrame(rows, schema), tool_chat.tool_table(spark, tools))
    return sorted(linked.collect(), key=lambda r: (repr(r.conv_id), r.position))


def call(place, call_id, depends_on=None, arguments='{"x":1,"y":2.5}', name="add", conv_id=1):
    return dict(conv_id=conv_id, place=place, kind="call", call_id=call_id, depends_on=depends_on, name=name, arguments=arguments)


def result(place, call_id, conv_id=1, content="done"):
    return dict(conv_id=conv_id, place=place, kind="result", call_id=call_id, content=content)


def test_given_conversations_as_in_sql(spark, data):
    turns = spark.read.parquet(f"{data}/conversations.parquet")
    linked = registry._tool_chat(spark, data)
    assert_same(linked, sql.TOOL_CHAT, conversations=turns)


def test_order_follows_dependencies(spark):
    events = [result(0, "b"), call(1, "b", depends_on="a"), result(5, "a"), call(6, "a"), dict(conv_id=1, place=2, kind="message", content="hi")]
    got = [(r.kind, r.call_id, r.status) for r in link(spark, events)]
    assert got == [("message", None, "message"), ("call", "a", "ok"), ("result", "a", "ok"), ("call", "b", "ok"), ("result", "b", "ok")]
    assert [r.position for r in link(spark, events)] == [0, 1, 2, 3, 4]


def test_long_chain_against_the_order(spark):
    n = 70
    events = []
    for k in range(n):
        events += [call(2 * (n - k), f"c{k}", depends_on=f"c{k - 1}" if k else None), result(2 * (n - k) + 1, f"c{k}")]
    got = [(r.kind, r.call_id) for r in link(spark, events)]
    assert got == [(kind, f"c{k}") for k in range(n) for kind in ("call", "result")]


def test_diamond(spark):
    events = [
        call(0, "end", depends_on=["left", "right", None, "left", "lost"]), result(1, "end"), call(2, "left", depends_on=["top"]),
        call(3, "right", depends_on=["top"]), result(4, "right"), result(5, "left"), call(6, "top"), result(7, "top"),
    ]
    got = link(spark, events)
    assert [(r.kind, r.call_id) for r in got] == [
        ("call", "top"), ("result", "top"), ("call", "left"), ("call", "right"), ("result", "right"), ("result", "left"),
        ("call", "end"), ("result", "end"),
    ]
    assert {r.status for r in got} == {"ok"}
    assert json.loads(got[-2].json)["depends_on"] == ["left", "right", None, "left", "lost"]


def expected_order(calls):
    """Order of calls {name: (place, parents)} and their results, by (latest place before, longest path, place)."""
    parents = {("call", c): [("result", p) for p in used if p in calls] for c, (_, used) in calls.items()}
    parents |= {("result", c): [("call", c)] for c in calls}
    place = {(kind, c): p + (kind == "result") for c, (p, _) in calls.items() for kind in ("call", "result")}
    reach = {n: {n} for n in parents}
    for _ in parents:
        reach = {n: {n}.union(*[reach[p] for p in parents[n]]) for n in parents}
    cyclic = {n for n in parents if any(n in reach[p] for p in parents[n])}
    cyclic = {n for n in parents if reach[n] & cyclic}

    def depth(n):
        return max((1 + depth(p) for p in parents[n]), default=0)

    keys = {n: (place[n], 0) if n in cyclic else (max(place[m] for m in reach[n]), depth(n)) for n in parents}
    return sorted(parents, key=lambda n: (*keys[n], place[n])), cyclic


def test_random_graphs_against_brute_force(spark):
    for seed, backward in ((1, True), (2, True), (3, False)):
        rng = random.Random(seed)
        names = [f"n{k}" for k in range(14)]
        places = rng.sample(range(14), 14)
        calls = {}
        for k, name in enumerate(names):
            pool = names[:k] if backward else names
            calls[name] = (2 * places[k], rng.sample(pool, min(len(pool), rng.choice([0, 1, 1, 2, 3] if backward else [0, 0, 1, 2]))))
        events = [e for c, (p, used) in calls.items() for e in (call(p, c, depends_on=used), result(p + 1, c))]
        rng.shuffle(events)
        got = link(spark, events)
        order, cyclic = expected_order(calls)
        assert [(r.kind, r.call_id) for r in got] == order
        assert {(r.kind, r.call_id) for r in got if r.status == "cycle"} == cyclic


def test_cycle_through_several_parents(spark):
    events = [
        call(0, "a", depends_on=["b", "c"]), result(1, "a"), call(2, "b", depends_on=["a"]), result(3, "b"), call(4, "c"), result(5, "c"),
        call(6, "behind", depends_on=["a", "c"]), call(7, "free", depends_on=["c"]),
    ]
    got = {(r.kind, r.call_id): r.status for r in link(spark, events)}
    assert {k for k, v in got.items() if v == "cycle"} == {(k, c) for c in "ab" for k in ("call", "result")} | {("call", "behind")}
    assert got["call", "free"] == "unanswered"


def test_states_of_events(spark):
    events = [
        call(0, "a"), result(1, "a"), call(2, "a"), call(3, "open"), result(4, "lost"), result(5, None), call(6, None),
        call(7, "p", depends_on="q"), result(8, "p"), call(9, "q", depends_on="p"), result(10, "q"),
        result(0, "a", conv_id=2), call(0, "n", conv_id=None), result(None, "n", conv_id=None),
    ]
    got = {(r.conv_id, r.kind, json.loads(r.json)["call_id"], r.position): r.status for r in link(spark, events)}
    assert sorted(got.values()) == sorted(
        ["ok", "ok", "repeated", "unanswered", "orphan", "orphan", "unanswered", *["cycle"] * 4, "orphan", "ok", "ok"]
    )
    assert got[None, "call", "n", 0] == "ok" and got[None, "result", "n", 1] == "ok"


def test_arguments_are_validated_and_canonical(spark):
    cases = {
        '{ "y": 2.5, "x": 1 }': "", '{"x":1}': "missing y", '{"x":"1","y":true}': "type x,type y", '{"x":1,"y":2,"z":[]}': "unknown z",
        '{"x":1,"y":null}': "type y", "[1]": "not an object", "{broken": "not an object", "": "not an object",
        '{"x":1e3,"y":-2,"note":"é\\n"}': "", '{"x":{"a":1},"y":[1]}': "type x,type y",
    }
    events = [call(k, str(k), arguments=a) for k, a in enumerate(cases)] + [call(90, "u", name="other"), call(91, "v", arguments=None)]
    got = link(spark, events)
    assert [r.errors for r in got] == [*cases.values(), "unknown tool", "not an object"]
    for r, text in zip(got, cases):
        event = json.loads(r.json)
        assert list(event) == sorted(event)
        try:
            assert event["arguments"] == json.loads(text)
        except ValueError:
            assert event["arguments"] == text
    assert got[0].json.startswith('{"arguments":{"x":1,"y":2.5},"call_id":"0","content":null,')


def test_nested_schemas(spark):
    place = Parameter("place", "object", fields=(
        Parameter("city", "string", most=5), Parameter("it's", "integer", required=False, least=1),
        Parameter("geo", "object", required=False, fields=(Parameter("lat", "number", least=-90, most=90),)),
    ))
    tools = {"add": (
        place, Parameter("unit", "string", False, options=("m", "km")), Parameter("level", "integer", False, options=(1, 2)),
        Parameter("days", "array", False, options=("mo", "tu"), most=2, items="string"), Parameter("any", "object", False),
        Parameter("rates", "array", False, items="number"),
    )}
    cases = {
        '{"place":{"city":"Rome"}}': "", '{"place":{}}': "missing place.city", "{}": "missing place", '{"place":"Rome"}': "type place",
        '{"place":{"city":"Vienna","geo":{}}}': "missing place.geo.lat,range place.city",
        '{"place":{"city":"é","geo":{"lat":91.5,"lon":1}}}': "range place.geo.lat,unknown place.geo.lon",
        '{"place":{"city":"R","it\'s":0}}': "range place.it's", '{"place":{"city":"R"},"unit":"mi","level":3}': "value level,value unit",
        '{"place":{"city":"R"},"days":["mo","we"]}': "items days", '{"place":{"city":"R"},"days":["mo","tu","mo"],"level":2}': "range days",
        '{"place":{"city":"R"},"days":[1],"any":{"x":{}}}': "items days", '{"place":{"city":"R"},"days":[],"rates":[1,2.5],"unit":null}': "type unit",
        '{"place":{"city":"R"},"rates":[1,"2"]}': "items rates", '{"place":null}': "type place",
    }
    got = link(spark, [call(k, str(k), arguments=a) for k, a in enumerate(cases)], tools)
    assert [r.errors for r in got] == list(cases.values())


def test_equal_events_and_empty_table(spark):
    twice = [dict(conv_id=1, place=0, kind="message", content="hi", role="user")] * 3
    assert [r.position for r in link(spark, twice)] == [0, 1, 2]
    assert link(spark, []) == []
