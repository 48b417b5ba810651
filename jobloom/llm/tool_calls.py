"""Tool calls in chats: linking, order, validation, canonical JSON.

Calls and results are hash-joined by conversation and identifier.  A call may name another call that it comes after; pointer
doubling gives every call its level in that order in logarithmically many joins and finds cycles.  Arguments are checked
against the schema of their tool, and every message is serialised as canonical JSON (sorted keys, no blanks, UTF-8; half a surrogate
pair stays a ``\\u`` escape).  Messages stay rows, so no conversation is ever gathered; ``place`` numbers those of a conversation by
level, then turn.

Defined results: one row per call, result and other message.  Status of a call: ``linked``, ``no_result``, ``cycle`` (on or behind
one), ``duplicate`` (not the first by turn, then arguments, name and after, of its identifier) or ``orphan`` (a null identifier,
which never matches).  Status of a result: ``linked``, ``duplicate`` (not the first by turn, then content, of its call) or
``orphan``.  A call whose ``after`` is unknown counts as first.  Rows without a level come after those with one.  Arguments that are
null, no JSON (infinite numbers, too many digits, nested too deeply) or no object are invalid and serialised as a string.  Texts
of any length are read and written whole.  Empty tables give an empty result; columns that are not named are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import number_in_order, stage_table

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}
CHECKED = T.StructType([T.StructField("error", T.StringType()), T.StructField("arguments", T.StringType())])


_HALF = re.compile("[\ud800-\udfff]")


def canonical_json(value) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _HALF.sub(lambda half: f"\\u{ord(half[0]):04x}", text)


def _finite(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(f"{text} is no JSON")
    return value


def _constant(text: str):
    raise ValueError(f"{text} is no JSON")


def checked(tool: str | None, text: str | None, schemas: Mapping[str, Mapping]) -> tuple[str | None, str]:
    """(error or None, canonical JSON) of one call's arguments."""
    try:
        value = json.loads(text, parse_constant=_constant, parse_float=_finite) if text is not None else None
        error = "unknown tool" if tool not in schemas else schema_error(value, {"type": "object", **schemas[tool]})
        return error, canonical_json(value if isinstance(value, dict) else text)
    except (ValueError, RecursionError):
        return "$: no JSON", canonical_json(text)


def schema_error(value, schema: Mapping, at: str = "$") -> str | None:
    """The first violation of a schema of type, required, properties, additionalProperties, items, enum, minimum, maximum."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _TYPES[kind]) or (isinstance(value, bool) and kind in ("integer", "number"))):
        return f"{at}: not {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not allowed"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            return f"{at}: out of range"
    if isinstance(value, dict):
        for name in sorted(schema.get("required", ())):
            if name not in value:
                return f"{at}.{name}: missing"
        known = schema.get("properties", {})
        for name in sorted(value):
            if name in known:
                if error := schema_error(value[name], known[name], f"{at}.{name}"):
                    return error
            elif schema.get("additionalProperties", True) is False:
                return f"{at}.{name}: unknown"
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            if error := schema_error(item, schema["items"], f"{at}[{i}]"):
                return error
    return None


def checked_arguments(name: Column, arguments: Column, schemas: Mapping[str, Mapping]) -> Column:
    """Struct of error (null if valid) and the arguments as canonical JSON."""
    schemas = dict(schemas)

    @F.arrow_udf(CHECKED)
    def check(names: pa.Array, texts: pa.Array) -> pa.Array:
        rows = [checked(tool, text, schemas) for tool, text in zip(names.to_pylist(), texts.to_pylist(), strict=True)]
        errors, values = ([r[i] for r in rows] for i in range(2))
        return pa.StructArray.from_arrays([pa.array(errors, pa.string()), pa.array(values, pa.string())], ["error", "arguments"])

    return check.asNondeterministic()(name, arguments)


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: 0 for calls after none, else one more than the call they come after; null on or behind a cycle."""
    ids = calls.select("conv_id", "call_id")
    known = ids.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    linked = calls.join(known, (F.col("conv_id") == F.col("c")) & (F.col("after") == F.col("i")), "left")
    at = stage_table(linked.select("conv_id", "call_id", F.col("i").alias("up"), F.when(F.col("i").isNull(), 0).otherwise(1).cast("long").alias("level")), "levels")
    open_ = at.filter(F.col("up").isNotNull()).count()
    while open_:
        above = at.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("up").alias("up2"), F.col("level").alias("more"))
        step = at.join(above, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("i")), "left")
        at = stage_table(step.select("conv_id", "call_id", F.col("up2").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "levels")
        # a round settles some call of every chain that ends; where it settles none, only cycles are left
        before, open_ = open_, at.filter(F.col("up").isNotNull()).count()
        if open_ == before:
            break
    return at.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


KEY = ["conv_id", "call_id"]


def _marked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Written rows with ``row`` (a number of their own) and ``first``: is this the first of its identifier?  Null identifiers: null.

    The first is an aggregate that is combined before the shuffle, so a hot identifier is not sorted in one task.
    """
    rows = stage_table(rows.withColumn("row", F.monotonically_increasing_id()), name)
    keyed = rows.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    firsts = keyed.groupBy(*KEY).agg(F.min_by("row", F.struct(*order, "row")).alias("_first")).select(F.col("_first"))
    known = F.when(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull(), F.col("_first").isNotNull())
    return stage_table(rows.join(firsts, F.col("row") == F.col("_first"), "left").withColumn("first", known).drop("_first"), name)


def format_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping], messages: DataFrame | None = None) -> DataFrame:
    """One row per call, result and other message: conv_id, call_id, kind, place, level, turn, status, error, json.

    calls: conv_id, turn, call_id, after, name, arguments (JSON text).  results: conv_id, turn, call_id, content.  messages: conv_id,
    turn, role, content.
    """
    none = F.lit(None).cast("string")
    calls = _marked(calls.select("conv_id", "turn", "call_id", "after", "name", "arguments"), ["turn", "arguments", "name", "after"], "calls")
    results = _marked(results.select("conv_id", "turn", "call_id", "content"), ["turn", "content"], "results")
    own = calls.filter("first")
    level = stage_table(levels(own), "call-levels")
    answers = results.filter("first").select(*KEY, F.lit(True).alias("_answered"))
    # only first calls are joined, one row per identifier; the others get their status without a join
    linked = own.join(level, KEY, "left").join(answers, KEY, "left")
    status = F.when(F.col("level").isNull(), "cycle").when(F.col("_answered").isNull(), "no_result").otherwise("linked")
    rest = calls.filter(~F.coalesce("first", F.lit(False)))
    rest = rest.withColumn("level", F.lit(None).cast("long")).withColumn("status", F.when(F.col("first").isNull(), "orphan").otherwise("duplicate"))
    made = linked.withColumn("status", status).drop("_answered").unionByName(rest)
    made = made.withColumn("_c", checked_arguments(F.col("name"), F.col("arguments"), schemas))
    call_rows = made.select(
        *KEY, F.lit("call").alias("kind"), "level", "turn", "status", F.col("_c.error").alias("error"),
        canonical(F.col("call_id"), F.lit("call"), F.col("name"), F.col("_c.arguments")).alias("json"), "row",
    )
    result_status = F.when(F.col("_known").isNull(), "orphan").when(~F.col("first"), "duplicate").otherwise("linked")
    told = results.join(own.select(*KEY, "name", F.lit(True).alias("_known")).join(level, KEY), KEY, "left")
    result_rows = told.select(
        *KEY, F.lit("result").alias("kind"), "level", "turn", result_status.alias("status"), none.alias("error"),
        canonical(F.col("call_id"), F.lit("result"), F.col("name"), json_string(F.col("content"))).alias("json"), "row",
    )
    rows = call_rows.unionByName(result_rows)
    if messages is not None:
        rows = rows.unionByName(
            messages.select(
                "conv_id", none.alias("call_id"), F.lit("message").alias("kind"), F.lit(0).cast("long").alias("level"), "turn", F.lit("message").alias("status"),
                none.alias("error"), canonical(none, F.lit("message"), F.col("role"), json_string(F.col("content"))).alias("json"),
                F.monotonically_increasing_id().alias("row"),
            )
        )
    rows = stage_table(rows, "chat-rows")
    last = F.coalesce("level", F.lit(2**62)).alias("_level")
    narrow = rows.select("conv_id", last, "turn", "kind", "call_id", "row")
    order = ["_level", "turn", "kind", "call_id", "row"]
    placed = number_in_order(narrow, "conv_id", order, "place", "_size").select(F.col("kind").alias("_k"), F.col("row").alias("_r"), "place")
    joined = rows.join(placed, (F.col("kind") == F.col("_k")) & (F.col("row") == F.col("_r")))
    return joined.select(*KEY, "kind", "place", "level", "turn", "status", "error", "json")


@F.arrow_udf(T.StringType())
def json_string(texts: pa.Array) -> pa.Array:
    return pa.array([canonical_json(t) for t in texts.to_pylist()], pa.string())


def canonical(call_id: Column, kind: Column, name: Column, body: Column) -> Column:
    """{"body":...,"id":...,"kind":...,"name":...}: keys in order, as canonical_json would write them."""
    quoted = [F.coalesce(json_string(x), F.lit("null")) for x in (call_id, name)]
    return F.concat(F.lit('{"body":'), body, F.lit(',"id":'), quoted[0], F.lit(',"kind":"'), kind, F.lit('","name":'), quoted[1], F.lit("}"))
