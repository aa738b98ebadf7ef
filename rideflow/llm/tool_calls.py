"""Tool-call linking: calls and results joined by identifier, ordered, validated, written as canonical JSON.

All of it is DataFrame expressions. A conversation is never gathered into one task: the order is a
sort key of each call, and identifiers are made unique before they are joined.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.llm.common import written

#: Arguments of a tool: property types by name, and which are required.
Schemas = Mapping[str, Mapping[str, object]]

#: What a turn of plain text counts as: a request to this tool.
REPLY = "reply"
SCHEMAS: Schemas = {REPLY: {"properties": {"prompt": "string", "after": "object"}, "required": ["prompt"]}}

_CALLS = "tool_calls array<struct<id: string, name: string, arguments: string, function: struct<name: string, arguments: string>>>"
_RESULT = "tool_call_id string, content string"
_REFERENCE = r'"\$ref"\s*:\s*"([^"\\]+)"'
_KEY = ["conv_id", "call_id"]


def _position(turn: Column, index: Column) -> Column:
    return F.struct(turn.isNull().alias("none"), turn.cast("long").alias("turn"), index.cast("long").alias("index"))


def _held(text: Column) -> Column:
    """The calls that a text holds; null for any text whose ``tool_calls`` do not parse."""
    return F.when(text.contains('"tool_calls"'), F.from_json(text, _CALLS)["tool_calls"])


def _identifier(role: str, text: Column, back: int = 0) -> Column:
    """``conversation:turn`` of the turn so many before; a turn of no known place is told by role and text, and answers none."""
    known = F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    lone = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.concat(F.lit(role + "?"), F.md5(text.cast("binary"))))
    return F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), lone).otherwise(known)


def calls_of(messages: DataFrame) -> DataFrame:
    """``conv_id, call_id, at, name, arguments``: one row per call of ``messages(conv_id, turn, role, text)``.

    A text ``{"tool_calls": [...]}`` holds calls of its own, each with an ``id``, a ``name`` and
    ``arguments`` (or these under ``function``). Any other text of the user is one call of the tool
    ``reply`` with the identifier ``conversation:turn``, which follows the request two turns before.
    Calls without an identifier get ``conversation:turn#index``. A plain turn without a conversation
    or turn has its role and the hash of its text in its identifier, so no two texts share one.
    """
    text = F.coalesce("text", F.lit(""))
    held = _held(text)
    place = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    explicit = messages.select("conv_id", "turn", F.posexplode(held).alias("index", "call")).select(
        "conv_id",
        F.coalesce("call.id", F.concat(place, F.lit("#"), F.col("index").cast("string"))).alias("call_id"),
        _position(F.col("turn"), F.col("index")).alias("at"),
        F.coalesce("call.name", "call.function.name").alias("name"),
        F.coalesce("call.arguments", "call.function.arguments", F.lit("{}")).alias("arguments"),
    )
    plain = messages.where((F.col("role") == "user") & held.isNull())
    earlier = F.when(F.col("conv_id").isNotNull() & (F.col("turn") >= 2), F.struct(F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 2).cast("string")).alias("$ref")))
    implicit = plain.select(
        "conv_id",
        _identifier("user", text).alias("call_id"),
        _position(F.col("turn"), F.lit(0)).alias("at"),
        F.lit(REPLY).alias("name"),
        F.to_json(F.struct(earlier.alias("after"), text.alias("prompt"))).alias("arguments"),
    )
    return explicit.union(implicit)


def results_of(messages: DataFrame) -> DataFrame:
    """``conv_id, call_id, at, content``: one row per result.

    A text of the role ``tool`` names its call; one of the assistant without calls answers the turn before.
    """
    text = F.coalesce("text", F.lit(""))
    named = F.from_json(text, _RESULT)
    tool = messages.where("role = 'tool'").select(
        "conv_id", named["tool_call_id"].alias("call_id"), _position(F.col("turn"), F.lit(0)).alias("at"),
        F.coalesce(named["content"], text).alias("content"),
    )
    answers = messages.where((F.col("role") == "assistant") & _held(text).isNull()).select(
        "conv_id", _identifier("assistant", text, 1).alias("call_id"), _position(F.col("turn"), F.lit(0)).alias("at"), text.alias("content")
    )
    return tool.union(answers).where(F.col("call_id").isNotNull())


def _distinct(rows: DataFrame, values: list[str], purpose: str) -> DataFrame:
    """The rows with ``n``, how often each stands there; written."""
    return written(rows.groupBy(*_KEY, "at", *values).agg(F.count(F.lit(1)).alias("n")), purpose)


def _first(distinct: DataFrame, values: list[str]) -> DataFrame:
    """The earliest row of each identifier and how many there were; equal places go by value."""
    first = F.min(F.struct("at", *values)).alias("first")
    return distinct.groupBy(*_KEY).agg(first, F.sum("n").alias("times")).select(*_KEY, "first.*", "times")


def _later(distinct: DataFrame, values: list[str]) -> DataFrame:
    """The rows of each identifier but the earliest, equal ones once with their number."""
    first = _first(distinct, values).where("times > 1").select(*[F.col(c).alias(f"f_{c}") for c in _KEY], F.struct("at", *values).alias("first"))
    both = distinct.join(first, distinct["conv_id"].eqNullSafe(F.col("f_conv_id")) & (F.col("call_id") == F.col("f_call_id")))
    times = F.col("n") - F.struct("at", *values).eqNullSafe(F.col("first")).cast("long")
    return both.select(*_KEY, "at", *values, times.alias("times")).where("times > 0")


def _same_call(left: DataFrame, right: DataFrame) -> Column:
    return left["conv_id"].eqNullSafe(right["conv_id"]) & (left["call_id"] == right["call_id"])


def ordered(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, place, cyclic``: a sort key by which every call comes after those it refers to.

    ``place`` starts as the call's position. A call that does not come after a reference moves just
    behind it (``lift``, then ``step``), again and again until nothing moves; references to earlier
    calls move nothing, and conversations without others are done at once. In each round a call also goes on
    from the call that its longest way so far ends at, so a chain takes rounds in proportion to its length's
    logarithm. Calls that reach more steps than calls were moved are on or behind a cycle:
    they keep their position and are marked.
    """
    references = F.array_distinct(F.regexp_extract_all("arguments", F.lit(_REFERENCE), F.lit(1)))
    # A reference to a call of another conversation, or to none, orders nothing.
    wanted = written(calls.select(*_KEY, "at", F.explode(references).alias("before")), "references")
    there = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("b"), F.col("at").alias("there"))
    known = wanted.join(there, wanted["conv_id"].eqNullSafe(F.col("c")) & (F.col("before") == F.col("b")))
    moving = written(known.where("there >= at").select(F.col("conv_id").alias("m")).distinct(), "moving")
    still = calls.select(*_KEY, F.struct(F.col("at").alias("lift"), F.lit(0).cast("long").alias("step")).alias("place"), F.lit(False).alias("cyclic"))
    if not moving.take(1):
        return still
    inside = lambda rows, how: rows.join(moving, rows["conv_id"].eqNullSafe(F.col("m")), how)
    moved = _moved(inside(calls.select(*_KEY, "at"), "left_semi"), inside(wanted.select(*_KEY, "before"), "left_semi"))
    return inside(still, "left_anti").union(moved)


def _moved(calls: DataFrame, wanted: DataFrame) -> DataFrame:
    """The order of conversations in which something moves. ``end`` is where the way of a call ends, ``place.step`` references on."""
    start = calls.select(*_KEY, F.struct(F.col("at").alias("lift"), F.lit(0).cast("long").alias("step"), F.col("call_id").alias("end")).alias("place"))
    start, wanted, cyclic = written(start, "places"), written(wanted, "references"), None
    places = start.withColumn("moves", F.lit(True)).withColumn("over", F.lit(False))
    while True:
        now = places.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("place").alias("there"))
        direct = wanted.join(now, wanted["conv_id"].eqNullSafe(F.col("c")) & (F.col("before") == F.col("i"))).select(
            *_KEY, F.struct("there.lift", (F.col("there.step") + 1).alias("step"), "there.end").alias("ways")
        )
        going = places.where("place.step > 0").select(*_KEY, "place")
        onward = going.join(now, going["conv_id"].eqNullSafe(F.col("c")) & (F.col("place.end") == F.col("i"))).select(
            *_KEY, F.struct("there.lift", (F.col("place.step") + F.col("there.step")).alias("step"), "there.end").alias("ways")
        )
        best = direct.union(onward).groupBy(*_KEY).agg(F.max("ways").alias("best")).toDF("c", "i", "best")
        further = F.coalesce(F.struct("best.lift", "best.step") > F.struct("place.lift", "place.step"), F.lit(False))
        joined = places.join(best, places["conv_id"].eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i")), "left").select(
            *_KEY, F.when(further, F.col("best")).otherwise(F.col("place")).alias("place"), further.alias("moves"), F.col("over").alias("was_over")
        )
        # No way without a cycle has more steps than there are calls that moved.
        most = joined.where("place.step > 0").groupBy("conv_id").agg(F.count(F.lit(1)).alias("most")).toDF("c", "most")
        counted = joined.join(most, joined["conv_id"].eqNullSafe(F.col("c")), "left")
        places = written(counted.select(*_KEY, "place", "moves", "was_over", (F.col("place.step") > F.coalesce("most", F.lit(0))).alias("over")), "places")
        if places.where("moves AND NOT was_over").take(1):
            continue
        if not places.where("moves").take(1):
            break
        # Only calls on or behind a cycle still move. Once more without them, so that nothing stays moved by a cycle.
        found = places.where("over").select(*_KEY)
        cyclic = written(found if cyclic is None else cyclic.union(found).distinct(), "cyclic")
        wanted = written(wanted.join(cyclic, _same_call(wanted, cyclic), "left_anti"), "references")
        places = start.withColumn("moves", F.lit(True)).withColumn("over", F.lit(False))
    rows = places.select(*_KEY, F.struct("place.lift", "place.step").alias("place"))
    if cyclic is None:
        return rows.withColumn("cyclic", F.lit(False))
    marked = cyclic.toDF("c", "i").withColumn("marked", F.lit(True))
    return rows.join(marked, rows["conv_id"].eqNullSafe(F.col("c")) & (rows["call_id"] == F.col("i")), "left").select(
        *_KEY, "place", F.coalesce("marked", F.lit(False)).alias("cyclic")
    )


def _kind(value: Column) -> Column:
    """The JSON type of a variant."""
    of = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | F.is_variant_null(value), "null")
        .when(of == "STRING", "string").when(of == "BOOLEAN", "boolean").when(of == "BIGINT", "integer")
        .when(of.startswith("ARRAY"), "array").when(of.startswith("OBJECT"), "object").otherwise("number")
    )


def argument_errors(name: Column, arguments: Column, schemas: Schemas = SCHEMAS) -> Column:
    """What is wrong with the arguments by the tool's schema, sorted; empty if nothing is.

    A schema has ``properties`` (string, integer, number, boolean, object, array or null by name),
    ``required`` names, and may allow ``additional`` ones. A tool without a schema is an error, as
    are arguments that are no JSON object.
    """
    listed = {t: {"properties": s.get("properties", {}), "required": s.get("required", []), "additional": bool(s.get("additional"))} for t, s in schemas.items()}
    table = F.from_json(
        F.lit(json.dumps(listed)), "map<string, struct<properties: map<string, string>, required: array<string>, additional: boolean>>"
    )
    known = F.try_element_at(table, name)
    members = F.from_json(arguments, "map<string, variant>")
    keys = F.coalesce(F.map_keys(members), F.array().cast("array<string>"))

    def wrong(key: Column) -> Column:
        wanted, got = F.try_element_at(known["properties"], key), _kind(F.element_at(members, key))
        return wanted.isNotNull() & (wanted != got) & ~((wanted == "number") & (got == "integer"))

    missing = F.transform(F.filter(known["required"], lambda r: ~F.array_contains(keys, r)), lambda r: F.concat(F.lit("missing "), r))
    unknown = F.transform(
        F.filter(keys, lambda k: ~known["additional"] & F.try_element_at(known["properties"], k).isNull()), lambda k: F.concat(F.lit("unknown "), k)
    )
    typed = F.transform(F.filter(keys, wrong), lambda k: F.concat(F.lit("type "), k))
    return (
        F.when(known.isNull(), F.array(F.lit("no schema")))
        .when(F.try_parse_json(arguments).isNull() | (F.json_array_length(arguments).isNotNull()) | F.get_json_object(arguments, "$").isNull()
              | ~F.ltrim(arguments).startswith("{"), F.array(F.lit("not an object")))
        .otherwise(F.array_sort(F.concat(missing, unknown, typed)))
    )


def _string(value: Column) -> Column:
    """A JSON string; null stays null."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))


def _canonical(identifier: Column, name: Column, arguments: Column, content: Column) -> Column:
    """A call and its result as JSON with sorted keys and no spaces at any depth; arguments that are no JSON are a string in it."""
    null = F.lit("null")
    return F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json(F.try_parse_json(arguments)), _string(arguments), null), F.lit(',"id":'), _string(identifier),
        F.lit(',"name":'), F.coalesce(_string(name), null), F.lit(',"result":'), F.coalesce(_string(content), null), F.lit("}"),
    )


def linked_calls(messages: DataFrame, schemas: Schemas = SCHEMAS) -> DataFrame:
    """One row per identifier of a call or result in ``messages(conv_id, turn, role, text)``; then one per text that repeats it.

    ``call_turn`` and ``result_turn`` are null where that side is missing. The earliest call and result of an
    identifier are linked; ``n_calls`` and ``n_results`` count all of them. Every other one is a row with
    ``repeat``, not linked, whose count says how often this call or result stands at its place. Rows of a conversation sorted by
    ``lift_turn, lift_index, step, call_turn, call_index`` have every call after those it refers to,
    unless it is ``cyclic``; repeats are not ordered. ``errors`` lists what is wrong with the arguments, ``valid`` says that
    nothing is. ``json`` has sorted keys and no spaces at any depth; arguments that are no JSON are
    a string in it. Null texts are empty; plain turns of a null conversation or turn are rows of their own,
    linked to nothing. Without messages there is no row.
    """
    rows = messages.select("conv_id", "turn", "role", "text")
    all_calls = _distinct(calls_of(rows), ["name", "arguments"], "calls")
    all_results = _distinct(results_of(rows), ["content"], "results")
    calls, results = _first(all_calls, ["name", "arguments"]), _first(all_results, ["content"])
    results = results.select(*[F.col(c).alias(f"r_{c}") for c in results.columns])
    order = ordered(calls)
    order = order.select(*[F.col(c).alias(f"o_{c}") for c in order.columns])
    both = calls.join(results, calls["conv_id"].eqNullSafe(F.col("r_conv_id")) & (F.col("call_id") == F.col("r_call_id")), "full")
    both = both.join(order, both["conv_id"].eqNullSafe(F.col("o_conv_id")) & (F.col("call_id") == F.col("o_call_id")), "left")
    call = F.col("call_id").isNotNull()
    wrong = F.when(call, argument_errors(F.col("name"), F.col("arguments"), schemas)).otherwise(F.array(F.lit("no call")))
    identifier = F.coalesce("call_id", "r_call_id")
    linked = both.select(
        F.when(call, F.col("conv_id")).otherwise(F.col("r_conv_id")).alias("conv_id"),
        identifier.alias("call_id"), F.lit(False).alias("repeat"),
        F.col("at.turn").alias("call_turn"), F.col("at.index").alias("call_index"),
        F.col("r_at.turn").alias("result_turn"),
        F.col("name"),
        F.col("o_place.lift.turn").alias("lift_turn"), F.col("o_place.lift.index").alias("lift_index"), F.col("o_place.step").alias("step"),
        F.coalesce("o_cyclic", F.lit(False)).alias("cyclic"),
        F.coalesce("times", F.lit(0)).cast("long").alias("n_calls"), F.coalesce("r_times", F.lit(0)).cast("long").alias("n_results"),
        F.array_join(wrong, ",").alias("errors"), (F.size(wrong) == 0).alias("valid"),
        _canonical(identifier, F.col("name"), F.col("arguments"), F.col("r_content")).alias("json"),
    )
    text = F.lit(None).cast("string")
    wrong = argument_errors(F.col("name"), F.col("arguments"), schemas)
    more_calls = _later(all_calls, ["name", "arguments"]).select(
        *_KEY, F.lit(True).alias("repeat"), F.col("at.turn").alias("call_turn"), F.col("at.index").alias("call_index"), F.col("name"), F.col("times").alias("n_calls"),
        F.lit(0).cast("long").alias("n_results"), F.lit(False).alias("cyclic"), F.array_join(wrong, ",").alias("errors"), (F.size(wrong) == 0).alias("valid"),
        _canonical(F.col("call_id"), F.col("name"), F.col("arguments"), text).alias("json"),
    )
    more_results = _later(all_results, ["content"]).select(
        *_KEY, F.lit(True).alias("repeat"), F.col("at.turn").alias("result_turn"), F.lit(0).cast("long").alias("n_calls"), F.col("times").alias("n_results"),
        F.lit(False).alias("cyclic"), F.lit("no call").alias("errors"), F.lit(False).alias("valid"), _canonical(F.col("call_id"), text, text, F.col("content")).alias("json"),
    )
    return linked.unionByName(more_calls, allowMissingColumns=True).unionByName(more_results, allowMissingColumns=True)
