"""Tool-call linking, order, validation and canonical JSON."""

import json

import pytest

from commuta.llm import chat
from commuta.llm.queries import QUERIES, SQL
from workload.check import compare, connect

MESSAGES = "conv_id long, turn long, role string, content string, tool_calls array<struct<id:string,name:string,arguments:string>>, tool_call_id string, json string"
SPECS = [
    ("f", "s", "string", True), ("f", "i", "integer", False), ("f", "n", "number", False), ("f", "b", "boolean", False),
    ("f", "o", "object", False), ("f", "a", "array", False), ("bare", None, None, None),
]


def formatted(spark, rows):
    messages = spark.createDataFrame([(*r, "clash") for r in rows], MESSAGES).repartition(3)
    schemas = spark.createDataFrame(SPECS, "tool string, parameter string, kind string, required boolean")
    return chat.format_chats(messages, schemas)


def call(id, arguments, name="f"):
    return (id, name, arguments)


def said(conv, turn, calls=None, role="assistant", content="hi"):
    return (conv, turn, role, content, calls, None)


def tool(conv, turn, id, content="out"):
    return (conv, turn, "tool", content, None, id)


def in_order(rows):
    return sorted(rows, key=lambda r: (r.conv_id or 0, r.anchor, r.level, r.step, r.turn, r.place))


@pytest.mark.parametrize("arguments,status", [
    ('{"s": "x"}', "valid"), ('{"i": 1}', "missing:s"), ('{"s": 1}', "wrong_type:s"), ('{"s": "x", "z": 0, "y": 1}', "unexpected:y;unexpected:z"),
    ('{"s":"x","i":1,"n":2.5,"b":true,"o":{},"a":[]}', "valid"), ('{"s":"x","i":1.5,"n":"2","b":0,"o":[],"a":{}}', "wrong_type:a;wrong_type:b;wrong_type:i;wrong_type:n;wrong_type:o"),
    ('{"s":null}', "wrong_type:s"), ("[1]", "not_an_object"), ("7", "not_an_object"), ("{", "bad_json"), ("", "bad_json"), (None, "bad_json"), ('{"s":"a","s":"b"}', "bad_json"),
    ('{"s": {"$result": "none"}}', "valid"),
])
def test_validation(spark, arguments, status):
    rows = formatted(spark, [said(1, 1, [call("c", arguments)]), tool(1, 2, "c")]).filter("kind = 'call'").collect()
    assert [r.status for r in rows] == [status]


def test_canonical_json(spark):
    text = ' { "b" : 1.50, "a" : {"z":[1, 2.0, "é\\n\\"/"], "c":null}, "A":true } '
    rows = formatted(spark, [said(1, 1, [call("c", text)]), tool(1, 2, "c", 'say "x"\n')]).collect()
    by = {r.kind: r.json for r in rows}
    assert by["call"] == '{"arguments":{"A":true,"a":{"c":null,"z":[1,2,"é\\n\\"/"]},"b":1.5},"id":"c","name":"f"}'
    assert by["result"] == '{"content":"say \\"x\\"\\n","role":"tool","tool_call_id":"c"}'
    assert by["message"] == '{"content":"hi","role":"assistant","turn":1}'
    assert all(json.loads(j) for j in by.values())


def test_order_and_links(spark):
    rows = [
        said(1, 0, role="user"), said(1, 1, [call("late", '{"s":{"$result":"early"}}'), call("early", '{"s":"x"}')]),
        tool(1, 0, "late", "recorded before its call"), tool(1, 3, "early"), tool(1, 4, "early", "again"), tool(1, 2, "nowhere"),
        said(1, 5, [call("early", '{"s":"y"}'), call("third", '{"s":{"$result":"late"}}'), call("free", "{}", "bare"), call("who", "{}", "unknown")]),
        said(2, 1, [call("p", '{"s":{"$result":"q"}}'), call("q", '{"s":{"$result":"p"}}'), call("early", '{"s":"x"}')]), tool(2, 2, "p"),
    ]
    got = in_order(formatted(spark, rows).collect())
    one = [(r.kind, r.call_id, r.status) for r in got if r.conv_id == 1]
    assert one == [
        ("message", None, "said"), ("message", None, "said"), ("call", "early", "valid"), ("result", "early", "linked"), ("result", "early", "repeated"),
        ("call", "late", "valid"), ("result", "late", "linked"), ("result", "nowhere", "orphan"), ("message", None, "said"),
        ("call", "free", "valid+unanswered"), ("call", "who", "unknown_tool+unanswered"), ("call", "third", "valid+unanswered"), ("call", "early", "repeated_id"),
    ]
    assert {r.call_id: r.status for r in got if r.conv_id == 2 and r.kind == "call"} == {"p": "cycle", "q": "cycle", "early": "valid+unanswered"}


def test_long_chain(spark):
    calls = [call(f"k{n}", f'{{"s":{{"$result":"k{n - 1}"}}}}' if n else '{"s":"x"}') for n in range(12)]
    got = in_order(formatted(spark, [said(1, 1, calls[::-1])] + [tool(1, 0, f"k{n}") for n in range(12)]).collect())
    assert [r.call_id for r in got if r.kind == "call"] == [f"k{n}" for n in range(12)]
    at = {(r.kind, r.call_id): k for k, r in enumerate(got)}
    assert all(at["result", f"k{n - 1}"] < at["call", f"k{n}"] < at["result", f"k{n}"] for n in range(1, 12))


def test_nulls_repeats_and_empty(spark):
    rows = [
        said(None, 1, [call("c", "{}", "bare")]), tool(None, 2, "c"), said(1, 1, [call(None, "{}", "bare")]), tool(1, 2, None, None),
        said(1, None, None, role=None, content=None), said(2, 1, []), said(3, 1, [call("r", "{}", "bare")]), said(3, 1, [call("r", "{}", "bare")]), tool(3, 2, "r"), tool(3, 2, "r"),
        said(4, 1, content="long " * 100_000),
    ]
    got = formatted(spark, rows).collect()
    assert sum(r.kind == "message" for r in got) == 7 and sum(r.kind == "call" for r in got) == 4 and sum(r.kind == "result" for r in got) == 4
    assert [r.status for r in got if r.conv_id is None and r.kind != "message"] == ["valid+unanswered", "orphan"]
    assert {r.status for r in got if r.conv_id == 3 and r.kind != "message"} == {"valid", "linked"}
    assert formatted(spark, rows).limit(0).count() == 0
    empty = spark.createDataFrame([], MESSAGES)
    schemas = spark.createDataFrame(SPECS, "tool string, parameter string, kind string, required boolean")
    assert chat.format_chats(empty, schemas).count() == 0


def test_query_matches_sql(spark, sf_dir):
    df = QUERIES["op4_chat_formatting"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    con = connect(sf_dir)
    con.execute(f"create or replace view conversations as select * from '{sf_dir}/conversations.parquet'")
    cur = con.execute(SQL["op4_chat_formatting"])
    assert compare(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall()) is None


def plain_levels(turns, refs):
    """level and anchor by recursion; none for calls that wait for a circle."""
    import sys

    sys.setrecursionlimit(10_000)
    made, open_ = {}, set()

    def of(c):
        if c in made:
            return made[c]
        if c in open_:
            return None
        open_.add(c)
        below = [of(r) for r in refs[c] if r in refs]
        open_.discard(c)
        made[c] = None if None in below else (1 + max((b[0] for b in below), default=-1), max([turns[c], *[b[1] for b in below]]))
        return made[c]

    return {c: of(c) for c in refs}


def levels_of(spark, graphs, monkeypatch=None):
    calls = [(conv, c, turns[c], " ".join(f'"$result": "{r}"' for r in refs[c])) for conv, (turns, refs) in enumerate(graphs) for c in refs]
    df = spark.createDataFrame(calls, "conv_id long, call_id string, turn long, arguments string")
    return {(r.conv_id, r.call_id): (r.level, r.anchor) for r in chat._levels(df).collect()}


def test_levels_of_random_graphs(spark):
    import random

    rng = random.Random(4)
    graphs = []
    for _ in range(40):
        n = rng.randint(1, 30)
        names = [f"c{k}" for k in range(n)]
        refs = {c: [rng.choice(names[:k]) for _ in range(rng.choice([0, 1, 1, 1, 2]))] if k else [] for k, c in enumerate(names)}
        graphs.append(({c: rng.randint(1, 50) for c in names}, refs))
    graphs.append(({c: 1 for c in "abcdefg"}, {"a": ["b"], "b": ["c"], "c": ["a"], "d": ["a"], "e": ["d", "f"], "f": [], "g": ["f", "lost"]}))  # a circle and what waits for it
    graphs.append(({"s": 3, "t": 4}, {"s": ["s"], "t": ["s"]}))
    want = {(k, c): v for k, (turns, refs) in enumerate(graphs) for c, v in plain_levels(turns, refs).items() if v}
    assert levels_of(spark, graphs) == want
    assert max(v[0] for v in want.values()) > 5


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    names = [f"c{k}" for k in range(1000)]
    refs = {c: names[k - 1 : k] for k, c in enumerate(names)}
    tables = []
    written = chat.written_table
    monkeypatch.setattr(chat, "written_table", lambda df, name="table": tables.append(name) or written(df, name))
    got = levels_of(spark, [({c: 1000 - k for k, c in enumerate(names)}, refs)])
    assert got == {(0, c): (k, 1000) for k, c in enumerate(names)}
    assert tables.count("jumps") <= 12 and tables.count("settled") <= 2
