from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from rideflow.llm import tool_calls as tc

SCHEMA = "conv_id long, turn long, role string, text string"
TOOLS = {
    "search": {"properties": {"q": "string", "n": "integer", "w": "number", "on": "boolean", "tags": "array", "after": "object"}, "required": ["q"]},
    "open": {"properties": {}, "additional": True},
}


def calls(*items):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in items]})


def rows_of(spark, messages, schemas=TOOLS):
    return tc.linked_calls(spark.createDataFrame(messages, SCHEMA), schemas).collect()


def test_calls_and_results_are_linked(spark):
    messages = [
        (1, 0, "assistant", calls(("a", "search", {"q": "x"}), ("b", "open", {"z": {"k": [1, {"d": 1, "c": 2}]}, "b": None}))),
        (1, 1, "tool", json.dumps({"tool_call_id": "b", "content": 'said "so"'})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "first"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "a", "content": "second"})),
        (1, 4, "tool", json.dumps({"tool_call_id": "zz", "content": "nobody asked"})),
        (2, 0, "tool", json.dumps({"tool_call_id": "a", "content": "elsewhere"})),
        (2, 5, "assistant", calls(("late", "none", {}))),
    ]
    got = {(r.conv_id, r.call_id): r for r in rows_of(spark, messages) if not r.repeat}
    assert set(got) == {(1, "a"), (1, "b"), (1, "zz"), (2, "a"), (2, "late")}
    assert (got[1, "a"].result_turn, got[1, "a"].n_results, got[1, "a"].valid) == (2, 2, True)
    assert got[1, "b"].json == '{"arguments":{"b":null,"z":{"k":[1,{"c":2,"d":1}]}},"id":"b","name":"open","result":"said \\"so\\""}'
    assert (got[1, "zz"].errors, got[1, "zz"].n_calls, got[1, "zz"].call_turn) == ("no call", 0, None)
    assert got[2, "late"].errors == "no schema" and got[2, "late"].result_turn is None
    for r in got.values():
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


@pytest.mark.parametrize("arguments, errors", [
    ({"q": "a"}, ""), ({}, "missing q"), ({"q": 1}, "type q"), ({"q": "a", "n": 1.5, "w": 2, "on": "yes", "tags": {}}, "type n,type on,type tags"),
    ({"q": "a", "else": 1}, "unknown else"), ({"q": None}, "type q"), ({"q": "a", "w": 1.25, "n": 3, "on": True, "tags": [1], "after": {}}, ""),
    ([1], "not an object"), ("text", "not an object"), ('{"q": "a"}', ""), ('{"q": ', "not an object"),
])
def test_arguments_against_schemas(spark, arguments, errors):
    (row,) = rows_of(spark, [(1, 0, "assistant", calls(("a", "search", arguments)))])
    assert row.errors == errors and row.valid == (errors == "")


def sorted_calls(rows):
    return sorted(rows, key=lambda r: (r.lift_turn, r.lift_index, r.step, r.call_turn, r.call_index))


@pytest.mark.parametrize("seed", range(5))
def test_order_respects_references(spark, seed):
    rng = random.Random(seed)
    ids = [f"c{i}" for i in range(14)]
    ranks = rng.sample(ids, len(ids)) if seed else ids  # references go against the turns, except once
    messages, wanted = [], {}
    for turn, i in enumerate(ids):
        before = ranks[: ranks.index(i)]
        wanted[i] = rng.sample(before, min(len(before), rng.randint(0, 2)))
        messages.append((1, turn, "assistant", calls((i, "open", {f"r{k}": {"$ref": x} for k, x in enumerate(wanted[i])}))))
    rows = sorted_calls(rows_of(spark, messages))
    place = {r.call_id: k for k, r in enumerate(rows)}
    assert not any(r.cyclic for r in rows) and all(place[x] < place[i] for i in ids for x in wanted[i])
    if not seed:
        assert [r.call_id for r in rows] == ids


def test_cycles_are_marked_and_end(spark):
    ref = lambda x: {"r": {"$ref": x}}
    messages = [(1, 0, "assistant", calls(("a", "open", ref("b")), ("b", "open", ref("c")), ("c", "open", ref("a")), ("d", "open", ref("d")), ("e", "open", ref("f")), ("f", "open", {}))),
                (2, 0, "assistant", calls(("a", "open", ref("gone"))))]
    rows = rows_of(spark, messages)
    assert {(r.conv_id, r.call_id) for r in rows if r.cyclic} == {(1, x) for x in "abcd"}
    place = [r.call_id for r in sorted_calls([r for r in rows if r.conv_id == 1])]
    assert place.index("f") < place.index("e")


def test_nulls_repeats_and_plain_turns(spark):
    messages = [
        (None, 0, "user", "hello"), (None, 1, "assistant", "hi"), (1, None, "user", "x"), (1, 0, "system", "rules"), (1, 1, "user", None), (1, 2, "assistant", ""),
        (1, 3, "user", 'say "{}"'), (1, 3, "user", 'say "{}"'), (1, 4, None, "y"), (2, 0, "assistant", '{"tool_calls": 5}'), (2, 1, "assistant", '{"tool_calls": [{"name": "x"}]}'),
        (2, 2, "tool", "no json"), (2, 3, "tool", None), (1, 4, "assistant", "answer"),
    ]
    got = {(r.conv_id, r.call_id): r for r in rows_of(spark, messages, tc.SCHEMAS) if not r.repeat}
    assert got[1, "1:3"].n_calls == 2 and got[1, "1:3"].result_turn == 4 and got[1, "1:3"].valid
    assert json.loads(got[1, "1:3"].json)["arguments"] == {"after": {"$ref": "1:1"}, "prompt": 'say "{}"'}
    assert json.loads(got[1, "1:1"].json)["result"] == ""
    assert all(json.loads(r.json)["id"] == r.call_id for r in got.values())


def test_extra_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", 3, 4)], SCHEMA + ", at int, Name int")
    assert tc.linked_calls(df).count() == 1 and tc.linked_calls(df.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = tc.linked_calls(talk)
    raw = {(r.conv_id, r.turn): (r.role, r.text) for r in talk.collect()}
    got = {(r.conv_id, r.call_id): r for r in rows.collect()}
    users = {(c, f"{c}:{t}") for (c, t), (role, _) in raw.items() if role == "user"}
    answers = {(c, f"{c}:{t - 1}") for (c, t), (role, _) in raw.items() if role == "assistant"}
    assert set(got) == users | answers
    for (c, i), r in got.items():
        t = int(i.split(":")[1])
        answer = raw.get((c, t + 1))
        held = json.loads(r.json)
        assert held["result"] == (answer[1] if answer and answer[0] == "assistant" else None)
        if (c, i) in users:
            assert held["arguments"]["prompt"] == raw[c, t][1] and r.valid
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert rows.agg(F.max("step")).first()[0] == 0


def test_no_text_vanishes_without_place_or_identifier(spark):
    messages = [(None, 0, "user", f"hello {i}") for i in range(4)] + [(None, 1, "assistant", f"hi {i}") for i in range(3)] + [
        (1, None, "user", "x"), (1, None, "user", "y"), (1, None, "assistant", "z"), (2, 0, "user", "how?"), (2, 1, "assistant", 'write "tool_calls" in it'),
        (2, 2, "assistant", '{"tool_calls": [{"name": "x"}, {"name": "open", "arguments": {}}]}'),
    ]
    rows = rows_of(spark, messages, {**tc.SCHEMAS, **TOOLS})
    assert len({(r.conv_id, r.call_id) for r in rows}) == len(rows) == 13
    held = [json.loads(r.json) for r in rows]
    assert {h["arguments"]["prompt"] for h in held if h["name"] == "reply"} == {*(f"hello {i}" for i in range(4)), "x", "y", "how?"}
    assert {h["result"] for h in held} == {None, *(f"hi {i}" for i in range(3)), "z", 'write "tool_calls" in it'}
    assert {h["id"]: h["result"] for h in held}["2:0"] == 'write "tool_calls" in it'
    assert {(h["id"], h["name"]) for h in held if "#" in h["id"]} == {("2:2#0", "x"), ("2:2#1", "open")}


def test_repeats_keep_their_texts(spark):
    messages = [
        (1, 0, "assistant", calls(("a", "search", {"q": "x"}))), (1, 1, "assistant", calls(("a", "search", {"q": 5}), ("a", "search", {"q": 5}))),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "first"})), (1, 3, "tool", json.dumps({"tool_call_id": "a", "content": "second"})),
        (1, 4, "user", "same"), (1, 4, "user", "same"), (1, 4, "user", "to"), (1, 6, "user", "alone"),
    ]
    rows = [r for r in tc.linked_calls(spark.createDataFrame(messages, SCHEMA), {**tc.SCHEMAS, **TOOLS}).collect() if r.repeat]
    told = sorted((r.call_id, r.call_turn, r.call_index, r.result_turn, r.n_calls, r.n_results, r.errors) for r in rows if r.call_turn is not None)
    assert told == [("1:4", 4, 0, None, 1, 0, ""), ("1:4", 4, 0, None, 1, 0, ""), ("a", 1, 0, None, 1, 0, "type q"), ("a", 1, 1, None, 1, 0, "type q")]
    assert [(json.loads(r.json)["result"], r.result_turn, r.n_results) for r in rows if r.call_turn is None] == [("second", 3, 1)]
    assert sorted(json.loads(r.json)["arguments"].get("prompt", "") for r in rows if r.call_id == "1:4") == ["same", "to"]


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """Every call refers to the next one, and a cycle of its own stands beside them."""
    n, rounds, write = 3000, [], tc.written
    monkeypatch.setattr(tc, "written", lambda df, purpose: (rounds.append(purpose), write(df, purpose))[1])
    items = [(f"c{i}", "open", {"$ref": f"c{i + 1}"}) for i in range(n)] + [("x", "open", {"$ref": "y"}), ("y", "open", {"$ref": "x"})]
    messages = [(1, i, "assistant", calls(item)) for i, item in enumerate(items)]
    messages += [(2, 0, "assistant", calls(("a", "open", {}), ("b", "open", {"$ref": "a"})))]
    rows = tc.ordered(tc.calls_of(spark.createDataFrame(messages, SCHEMA)).select("conv_id", "call_id", "at", "name", "arguments")).collect()
    assert {r.call_id for r in rows if r.cyclic} == {"x", "y"} and len(rows) == n + 4
    place = {r.call_id: (r.place.lift.turn, r.place.lift["index"], r.place.step) for r in rows if r.conv_id == 1}
    assert all(place[f"c{i}"] > place[f"c{i + 1}"] for i in range(n - 1))
    assert rounds.count("places") < 40
