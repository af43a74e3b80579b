from __future__ import annotations

import json
import random

from terrace.llm.tool_calls import format_calls

MESSAGES = "conv_id long, turn long, role string, text string"
SCHEMAS = [
    ("find", "query", "string", True), ("find", "limit", "integer", True), ("find", "after", "string", False),
    ("add", "a", "number", True), ("add", "b", "number", False), ("add", "tags", "array", False),
]


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a if isinstance(a, str) else json.dumps(a)} for i, n, a in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def run(spark, rows, **options):
    schemas = spark.createDataFrame(SCHEMAS, "name string, parameter string, type string, required boolean")
    out = format_calls(spark.createDataFrame(rows, MESSAGES), schemas, **options).collect()
    return {(r["conv_id"], r["call_id"], r["nth"]): r for r in out}


def test_links_validation_and_canonical_records(spark):
    rows = [
        (1, 0, "assistant", call(("a", "find", {"query": "x\"é", "limit": 3}), ("b", "add", '{"b": 2, "a" : 1.50, "tags":[ 1,2 ]}'))),
        (1, 1, "tool", result("b", "3")), (1, 2, "tool", result("a", "hits")), (1, 3, "tool", result("zz", "?")),
        (1, 4, "assistant", call(("a", "add", {"a": "one", "c": None}), ("d", "none", {}), ("e", "add", "[1]"), ("f", "add", "not json"))),
        (1, 5, "tool", result("a", "again")), (1, 4, "tool", result("d", "early")), (2, 0, "assistant", call(("a", "add", {"a": 2}))),
    ]
    got = run(spark, rows)
    assert {k: r["status"] for k, r in got.items()} == {
        (1, "a", 1): "linked", (1, "b", 1): "linked", (1, "zz", 1): "orphan_result", (1, "a", 2): "linked", (1, "d", 1): "early_result",
        (1, "e", 1): "missing_result", (1, "f", 1): "missing_result", (2, "a", 1): "missing_result",
    }
    assert {k: r["errors"] for k, r in got.items() if r["errors"]} == {
        (1, "a", 2): ["type:a", "unexpected:c"], (1, "d", 1): ["unknown_tool"], (1, "e", 1): ["not_an_object"], (1, "f", 1): ["not_an_object"],
    }
    assert got[1, "a", 1]["valid"] and not got[1, "zz", 1]["valid"]
    record = got[1, "b", 1]["record"]
    assert record == '{"arguments":{"a":1.5,"b":2,"tags":[1,2]},"id":"b","name":"add","result":"3"}'
    assert json.loads(got[1, "a", 1]["record"]) == {"arguments": {"limit": 3, "query": "x\"é"}, "id": "a", "name": "find", "result": "hits"}
    assert json.loads(got[1, "f", 1]["record"])["arguments"] == {"arguments": "not json"}


def test_topological_order_of_random_dependencies(spark):
    """Against the definition: every call comes after all it needs, and untouched calls keep their turn."""
    rng, rows, needs = random.Random(2), [], {}
    for conv in range(12):
        ids = list(range(15))
        rank = rng.sample(ids, 15)  # a hidden order without circles
        for t in ids:
            some = [d for d in ids if rank[d] < rank[t] and rng.random() < 0.12]
            needs[conv, t] = some
            args = {"query": "q", "limit": 1, "after": [f"$result:c{d}" for d in some]}
            rows.append((conv, t, "assistant", call((f"c{t}", "find", args))))
    got = run(spark, rows)
    key = {(c, int(i[1:])): (r["since"], r["step"], r["turn"], r["position"]) for (c, i, _), r in got.items()}
    assert all(r["ordered"] for r in got.values())
    for (c, t), some in needs.items():
        assert all(key[c, d] < key[c, t] for d in some)
        if not some:
            assert key[c, t][:2] == (t, 0)


def needs(*ids):
    return json.dumps({"query": "q", "limit": 1, "after": [f"$result:{i}" for i in ids]})


def test_circles_and_all_behind_them(spark):
    rows = [
        (1, 0, "assistant", call(("a", "find", needs("b")))), (1, 1, "assistant", call(("b", "find", needs("c")))),
        (1, 2, "assistant", call(("c", "find", needs("a")))), (1, 3, "assistant", call(("d", "find", needs("c")))),
        (1, 4, "assistant", call(("e", "find", needs("d")))), (1, 5, "assistant", call(("f", "find", needs()))),
        (2, 0, "assistant", call(("a", "find", needs("nope", "b")))), (2, 3, "assistant", call(("b", "find", needs()))),
        (3, 0, "assistant", call(("a", "find", needs("a")))), (None, 0, "assistant", call(("a", "find", needs("b")), ("b", "find", needs("a")))),
    ]
    got = run(spark, rows)
    assert {k[:2]: r["ordered"] for k, r in got.items()} == {
        (1, "a"): False, (1, "b"): False, (1, "c"): False, (1, "d"): False, (1, "e"): False, (1, "f"): True,
        (2, "a"): True, (2, "b"): True, (3, "a"): False, (None, "a"): False, (None, "b"): False,
    }
    assert all((r["since"], r["step"]) == (r["turn"], 0) for r in got.values() if not r["ordered"])
    assert got[2, "a", 1]["unknown"] == ["nope"] and (got[2, "a", 1]["since"], got[2, "a", 1]["step"]) == (3, 1)


def test_nesting_has_no_limit(spark):
    deep = 70
    rows = [(1, i, "assistant", call((f"c{i}", "find", needs(f"c{i + 1}") if i < deep else needs()))) for i in range(deep + 1)]
    got = run(spark, rows)
    assert all(r["ordered"] and (r["since"], r["step"]) == (deep, deep - int(k[1][1:])) for k, r in got.items())


def test_schema_rows_repeated_or_without_parameter(spark):
    rows = [("t", "a", "string", False), ("t", "a", "integer", None), ("t", "a", "string", True), ("t", None, "string", True), ("u", None, None, None),
            (None, "a", "string", True), ("t", "b", None, None)]
    schemas = spark.createDataFrame(rows, "name string, parameter string, type string, required boolean")
    said = [(1, 0, "assistant", call(("x", "t", {"a": 1}), ("y", "t", {"b": "any"}), ("z", "u", {}), ("w", "t", {"a": "no"})))]
    got = {r["call_id"]: r["errors"] for r in format_calls(spark.createDataFrame(said, MESSAGES), schemas).collect()}
    assert got == {"x": [], "y": ["missing:a"], "z": [], "w": ["type:a"]}


def test_messages_of_one_turn_keep_one_order(spark):
    rows = [(1, 0, "assistant", call(("a", "add", {"a": i}))) for i in range(6)] + [(1, 1, "tool", result("a", f"r{i}")) for i in range(6)]
    got = run(spark, rows)
    assert run(spark, rows[::-1]) == got
    assert [json.loads(got[1, "a", n]["record"])["result"] for n in range(1, 7)] == [f"r{i}" for i in range(6)]


def test_odd_inputs(spark):
    rows = [
        (None, 0, "assistant", call(("a", "add", {"a": 1}))), (None, 1, "tool", result("a", None)), (1, None, "assistant", None),
        (1, 0, None, "{}"), (1, 1, "user", call(("u", "add", {}))), (1, 2, "assistant", "plain {text"), (1, 3, "assistant", '{"tool_calls": []}'),
        (1, 4, "assistant", '{"tool_calls": [{"name": "add"}]}'), (1, 5, "tool", "{}"), (1, 6, "assistant", call(("long", "find", {"query": "w " * 60_000, "limit": 1}))),
        (1, 6, "assistant", call(("long", "find", {"query": "w", "limit": 1}))),
    ]
    got = run(spark, rows)
    assert got[None, "a", 1]["status"] == "linked" and got[None, "a", 1]["valid"]
    assert {k[:2] for k in got} == {(None, "a"), (1, None), (1, "long")} and {k[2] for k in got if k[1] == "long"} == {1, 2}
    assert run(spark, []) == {}
