"""Chat formatting: tool calls linked to their results.

Calls and results are joined by identifier. A call may name an earlier call whose
result it uses (``after``); its depth is the number of calls before it along these names, so that
order by depth, then turn, then id is a topological order of every conversation. Depths are
found by doubling: each round a call jumps over twice as many predecessors, so a chain of n
calls takes log2(n) joins. Arguments are validated against the schema of the tool, and the
linked call is written as canonical JSON: keys in order, no spaces, text as it is.

An identifier holds within its conversation: calls and results are joined by ``conv_id`` and
``call_id``, a null conversation being one of its own.

Defined results: of several calls (or results) with one identifier the first by turn and content
counts, the others come as ``duplicate``; a null identifier links nothing, and
such rows come as ``no_id``; rows equal in all columns are one row, their number is ``n_same`` of a call
and ``n_results`` of a result. Results without ``conv_id`` can only be joined by ``call_id`` over the whole
table: then an identifier holds for all conversations. No row is left out: a call without result, an unknown tool, broken JSON and arguments against the
schema come with their ``status``; results without a call come as ``no_call``; ``after`` that
names no call counts as none; calls on a cycle or after one have no depth and status ``cycle``. Texts of any length go through whole; other columns
of both tables are not looked at; empty tables give an empty one, or all rows of the other.
"""

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .runs import same
from .scratch import stored

CHECKED = "problems array<string>, record string"
TYPES = {
    "string": str,
    "integer": int,
    "number": (int, float),
    "boolean": bool,
    "array": list,
    "object": dict,
    "null": type(None),
}
KEYWORDS = {"type", "enum", "required", "properties", "additionalProperties", "items"}
#: Keywords that say nothing about validity.
NOTES = {"title", "description", "default", "examples", "$comment", "$schema"}


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def check(value, schema: dict, at: str = "$") -> Iterator[str]:
    """What is wrong with a value: ``type``, ``enum``, ``required``, ``properties``,
    ``additionalProperties`` and ``items`` of JSON Schema are understood."""
    kind = schema.get("type")
    if kind and (not isinstance(value, TYPES[kind]) or (isinstance(value, bool) and kind in ("integer", "number"))):
        yield f"{at}: not of type {kind}"
        return
    if "enum" in schema and value not in schema["enum"]:
        yield f"{at}: not one of the values"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        yield from (f"{at}.{name}: missing" for name in sorted(schema.get("required", [])) if name not in value)
        for name in sorted(value):
            if name in known:
                yield from check(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                yield f"{at}.{name}: unknown"
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            yield from check(item, schema["items"], f"{at}[{i}]")


def refuse_unsupported(schema: dict, at: str = "$") -> None:
    """Raises for a schema with a keyword that ``check`` would pass over."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema is an object")
    if unknown := sorted(set(schema) - KEYWORDS - NOTES):
        raise ValueError(f"{at}: unsupported {', '.join(unknown)}")
    kind = schema.get("type")
    if kind is not None and (not isinstance(kind, str) or kind not in TYPES):
        raise ValueError(f"{at}: unsupported type {kind}")
    if schema.get("additionalProperties", False) not in (True, False):
        raise ValueError(f"{at}: unsupported schema in additionalProperties")
    for name, inner in schema.get("properties", {}).items():
        refuse_unsupported(inner, f"{at}.{name}")
    if "items" in schema:
        refuse_unsupported(schema["items"], f"{at}[]")


def unique(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a key repeats")
    return out


def refuse(constant: str):
    raise ValueError(f"{constant} is not JSON")


def formatted(call_id, name, arguments, result, schemas: dict) -> dict:
    problems, parsed = [], None
    try:
        parsed = json.loads(arguments or "", object_pairs_hook=unique, parse_constant=refuse)
        problems += check(parsed, schemas[name]) if name in schemas else [f"unknown tool {name}"]
        record = canonical({"id": call_id, "name": name, "arguments": parsed, "result": result})
    except (ValueError, RecursionError):
        problems, record = ["arguments are not JSON"], None
    return {"problems": problems, "record": record}


def returned(call_id, result) -> dict:
    """The record of a result that no call takes."""
    return {"problems": [], "record": canonical({"id": call_id, "result": result})}


def checked(is_call: Column, call_id: Column, name: Column, arguments: Column, result: Column, schemas: dict) -> Column:
    kind = to_arrow_type(StructType.fromDDL(CHECKED))

    @F.arrow_udf(CHECKED)
    def compute(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch))
            facts = [formatted(i, n, a, r, schemas) if call else returned(i, r) for call, i, n, a, r in rows]
            yield pa.array(facts, kind)

    return compute(is_call, call_id, name, arguments, result)


def split_by_id(rows: DataFrame, purpose: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Equal rows counted in ``n_same``; then one row for each conversation and identifier, the least
    by turn and content, and all others with their ``status``."""
    content = F.struct("turn", *columns)
    rows = stored(rows.groupBy("conv_id", "call_id", "turn", *columns).agg(F.count("*").alias("n_same")), purpose)
    named = rows.where("call_id is not null")
    least = F.min(F.struct(content.alias("content"), "n_same")).alias("least")
    ids = stored(named.groupBy("conv_id", "call_id").agg(least, F.count("*").alias("kinds")), purpose)
    first = ids.select("conv_id", "call_id", "least.content.*", "least.n_same")
    several = ids.where("kinds > 1").select("conv_id", "call_id", F.col("least.content").alias("least"))
    further = same(named, several, "conv_id", "call_id").where(~content.eqNullSafe(F.col("least"))).drop("least")
    unnamed = rows.where("call_id is null").withColumn("status", F.lit("no_id"))
    return first, further.withColumn("status", F.lit("duplicate")).unionByName(unnamed)


def call_depths(calls: DataFrame) -> DataFrame:
    """``(call_id, depth)`` of calls with columns ``call_id`` (unique) and ``after``; null on and behind a cycle."""
    ids = calls.select(F.col("call_id").alias("after"), F.lit(True).alias("there"))
    state = stored(
        calls.select("call_id", "after")
        .join(ids, "after", "left")
        .select("call_id", F.when(F.col("there"), F.col("after")).alias("before"))
        .withColumn("depth", F.when(F.col("before").isNull(), 0).otherwise(1).cast("long")),
        "depths",
    )
    n = state.where("before is not null").count()
    for _ in range(math.ceil(math.log2(n + 1)) + 1 if n else 0):
        further = state.select(
            F.col("call_id").alias("before"), F.col("before").alias("next"), F.col("depth").alias("more")
        )
        # calls that have come to a beginning are done, and stay out of the join
        moved = state.where("before is not null").join(further, "before", "left").select(
            "call_id", F.col("next").alias("before"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        )
        state = stored(state.where("before is null").select("call_id", "before", "depth").union(moved), "depths")
        if state.where("before is not null").isEmpty():
            break
    return state.select("call_id", F.when(F.col("before").isNull(), F.col("depth")).alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row for each call, and for each result without one.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON), after. ``results``: conv_id, turn, call_id,
    content; without conv_id they are joined by call_id alone. ``schemas``: a JSON Schema by tool name;
    one with keywords that ``check`` does not know raises.
    Result: conv_id, call_id, name, turn, depth, status, problems, n_same, n_results, record.
    """
    for name, schema in schemas.items():
        refuse_unsupported(schema, name)
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "after", F.col("conv_id").alias("of"))
    results = results.withColumn("of", F.col("conv_id") if "conv_id" in results.columns else F.lit(None))
    if "conv_id" not in results.columns:  # identifiers of one conversation, that of all
        calls, results = (t.withColumn("conv_id", F.lit(None).cast(calls.schema["of"].dataType)) for t in (calls, results))
    own, more_calls = split_by_id(calls, "calls", "name", "arguments", "after", "of")
    given, more_results = split_by_id(results, "results", "content", "of")
    key = F.struct("conv_id", "call_id")
    before = F.when(F.col("after").isNotNull(), F.struct("conv_id", F.col("after").alias("call_id")))
    own = own.withColumns({"key": key, "is_call": F.lit(True)})
    given = given.select(
        key.alias("key"),
        F.col("of").alias("result_of"),
        F.col("call_id").alias("result_id"),
        F.col("turn").alias("result_turn"),
        F.col("n_same").alias("n_results"),
        "content",
    )
    depths = stored(call_depths(own.select(F.col("key").alias("call_id"), before.alias("after"))), "depths")
    linked = own.join(given, "key", "full").join(depths.withColumnRenamed("call_id", "key"), "key", "left")
    linked = linked.select(
        F.coalesce("of", "result_of").alias("conv_id"),
        F.coalesce("call_id", "result_id").alias("call_id"),
        "name",
        "arguments",
        "content",
        F.coalesce("turn", "result_turn").alias("turn"),
        "depth",
        F.coalesce("is_call", F.lit(False)).alias("is_call"),
        F.coalesce("n_same", "n_results").alias("n_same"),
        "n_results",
        F.lit(None).cast("string").alias("status"),
    )
    for more, is_call in ((more_calls, True), (more_results, False)):
        more = more.withColumns({"is_call": F.lit(is_call), "conv_id": F.col("of")})
        if not is_call:
            more = more.withColumn("n_results", F.col("n_same"))
        linked = linked.unionByName(more.drop("after", "of"), allowMissingColumns=True)
    facts = checked(F.col("is_call"), F.col("call_id"), F.col("name"), F.col("arguments"), F.col("content"), schemas)
    linked = linked.withColumn("c", facts)
    status = (
        F.when(F.col("status").isNotNull(), F.col("status"))
        .when(~F.col("is_call"), "no_call")
        .when(F.col("depth").isNull(), "cycle")
        .when(F.size("c.problems") > 0, "invalid")
        .when(F.col("n_results").isNull(), "no_result")
        .otherwise("linked")
    )
    return linked.select(
        "conv_id",
        "call_id",
        "name",
        "turn",
        "depth",
        status.alias("status"),
        F.col("c.problems").alias("problems"),
        "n_same",
        "n_results",
        F.when(status != "no_call", F.col("c.record")).alias("record"),
    )
