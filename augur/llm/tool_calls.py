"""Chat formatting: tool calls linked to their results.

Calls and results are hash-joined by (conversation, identifier). Calls are
ordered topologically: a call comes after the calls it depends on (its level
is one more than the greatest of theirs), calls of a level by turn and
identifier. Arguments are validated against the tool's schema, and every call
becomes one line of canonical JSON (keys in UTF-16 order, no blanks, integral
floats as integers, no escapes but those JSON needs).

Levels are found by doubling: rounds of joins, each written to the shared folder,
whose number grows with the logarithm of a chain's length; positions come from a range-partitioned numbering. No task ever holds a whole
conversation, so one may have any share of the rows.

Defined cases: a call without a result has status ``open``; a result without a
call is an ``orphan`` line; of several results the least text is the call's
(``n_results`` counts them), repeated rows of a call are one call, and of different calls
under one identifier the first by turn, name and arguments is linked. The other
calls, and with ``all_results`` each other content of the results (with the number of its rows), are lines
with status ``duplicate`` and an error, after those in order. Calls in or
behind a dependency cycle get level -1 and come last with the error ``cycle``.
A dependency on an unknown identifier is the error ``unknown dependency``, and
doesn't hold the call back. Unknown tools, arguments that aren't a JSON object
and values against the schema make a line invalid. Rows with a null
conversation or identifier can't be linked: each is a line of its own, as
``open`` or ``orphan``. Empty tables give empty tables. Only the named columns are read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augur.llm.scratch import stored
from augur.operators.sequence import sequence_number

TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}
# Tools that the roles of a plain conversation stand for.
CHAT_SCHEMAS = {
    "configure": {"type": "object", "required": ["instructions"], "properties": {"instructions": {"type": "string", "minLength": 1}}, "additionalProperties": False},
    "reply": {
        "type": "object",
        "required": ["message", "turn"],
        "properties": {"message": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
        "additionalProperties": False,
    },
}


def plain(value):
    """The value with integral floats as integers; raises on NaN and infinities."""
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("not a JSON number")
        return int(value) if value.is_integer() and abs(value) < 2**53 else value
    if isinstance(value, list):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {k: plain(value[k]) for k in sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))}
    return value


def canonical(value) -> str:
    return json.dumps(plain(value), separators=(",", ":"), ensure_ascii=False)


def violations(value, schema: dict, at: str = "") -> list[str]:
    """What in ``value`` is against ``schema`` (type, enum, required,
    properties, additionalProperties, items, minimum, maximum, minLength, maxLength)."""
    where = at or "arguments"
    kinds = schema.get("type")
    if kinds:
        names = [kinds] if isinstance(kinds, str) else kinds
        fits = any(
            isinstance(value, TYPES[n]) and not (isinstance(value, bool) and n in ("integer", "number"))
            or n == "integer" and isinstance(value, float) and value.is_integer()
            for n in names
        )
        if not fits:
            return [f"{where}: not {' or '.join(names)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{where}: not an allowed value")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{where}: under {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{where}: over {schema['maximum']}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{where}: too short")
        if len(value) > schema.get("maxLength", math.inf):
            out.append(f"{where}: too long")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += violations(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{where}: lacks {k}" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}" if at else k)
            elif schema.get("additionalProperties") is False:
                out.append(f"{where}: unknown {k}")
    return out


def _no_constant(name: str):
    raise ValueError(name)


def checked(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[object, list[str]]:
    """The parsed arguments (the raw text if they can't be parsed) and their faults."""
    try:
        value = plain(json.loads(arguments or "", parse_constant=_no_constant))
    except (ValueError, RecursionError):
        return arguments, ["arguments: not JSON"]
    if name not in schemas:
        return value, ["unknown tool"]
    return value, violations(value, {"type": "object"} | schemas[name])


def _serialise(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, errors, lines = [], [], []
            for row in batch.select(["conv", "call_id", "position", "status", "name", "arguments", "depends_on", "level", "unknown", "n_results", "content"]).to_pylist():
                line = {"conversation": row["conv"], "id": row["call_id"], "position": row["position"], "status": row["status"]}
                faults: list[str] = []
                further = row["status"] == "duplicate"
                if further and row["n_results"]:
                    faults = ["duplicate result"]
                    line["errors"] = faults
                elif row["status"] != "orphan":
                    value, faults = checked(row["name"], row["arguments"], schemas)
                    if row["level"] == -1:
                        faults.append("cycle")
                    if row["unknown"]:
                        faults.append("unknown dependency")
                    if further:
                        faults.append("duplicate call")
                    line |= {"name": row["name"], "arguments": value, "depends_on": sorted(row["depends_on"] or []), "errors": faults}
                if row["n_results"]:
                    line |= {"result": row["content"], "results": row["n_results"]}
                valid.append(row["status"] == "linked" and not faults)
                errors.append(faults)
                lines.append(canonical(line))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"], batch["position"], batch["call_id"], batch["name"], batch["status"],
                    pa.array(valid, pa.bool_()), pa.array(errors, pa.list_(pa.string())), pa.array(lines, pa.string()),
                ],
                names=["conv_id", "position", "call_id", "name", "status", "valid", "errors", "json"],
            )

    return run


def levels(calls: DataFrame) -> DataFrame:
    """calls (conv, call_id, depends_on) -> (conv, call_id, level, unknown).

    A level is the longest path to a call without dependencies, found by doubling.
    An edge (call, on, w) says: level >= level of ``on`` + w; without ``on`` it is a bound by itself.
    A call with bounds alone has its level. A call with one ``on``, whose own bound is no greater
    than w, follows that one. Each round replaces such an ``on`` by what it follows, w added, so
    the paths along chains, trees and diamonds double every round. A path longer
    than there are calls runs round a cycle; so do all calls left when nothing can be replaced.
    """
    nodes = calls.select("conv", "call_id")
    needs = (
        calls.select("conv", "call_id", F.explode("depends_on").alias("on")).filter("on is not null").distinct()
        .join(nodes.select("conv", F.col("call_id").alias("on"), F.lit(True).alias("known")), ["conv", "on"], "left")
    )
    needs = stored(needs, "needs")
    unknown = needs.filter("known is null").select("conv", "call_id", F.lit(True).alias("unknown")).distinct()
    known = needs.filter("known").select("conv", "call_id", "on")
    free = nodes.join(known, ["conv", "call_id"], "left_anti")
    edge = lambda df, on, w: df.select("conv", "call_id", on.alias("on"), F.lit(w).cast("long").alias("w"), F.lit(False).alias("cycle"))
    edges = edge(free, F.lit(None).cast("string"), 0).unionByName(edge(known, F.col("on"), 1))
    edges = stored(edges.withColumn("moved", F.lit(True)), "edges")
    most, placed, gone = nodes.count(), [], []
    while True:
        left, moved = edges.agg(F.count(F.lit(1)), F.max("moved")).first()
        if not left:
            break
        if not moved:
            placed.append(edges.select("conv", "call_id").distinct().withColumn("level", F.lit(-1)))
            break
        state = stored(_followed(edges, most), "followed")
        placed.append(state.filter("done").select("conv", "call_id", F.col("to_w").cast("int").alias("level")))
        # calls placed in earlier rounds too: a call may get to them only now
        ends = reduce(DataFrame.unionByName, [*gone, state.filter("follows")])
        ends = ends.select("conv", F.col("call_id").alias("on"), "to", "to_w", F.col("cycle").alias("to_cycle"))
        gone.append(state.filter("done"))
        rest = edges.join(state.filter("done"), ["conv", "call_id"], "left_anti").join(ends, ["conv", "on"], "left")
        replaced = F.col("to_w").isNotNull()
        edges = stored(
            rest.select(
                "conv",
                "call_id",
                F.when(replaced, F.col("to")).otherwise(F.col("on")).alias("on"),
                (F.col("w") + F.coalesce("to_w", F.lit(0))).alias("w"),
                (F.col("cycle") | F.coalesce("to_cycle", F.lit(False))).alias("cycle"),
                replaced.alias("moved"),
            )
            .groupBy("conv", "call_id", "on")
            .agg(F.max("w").alias("w"), F.max("cycle").alias("cycle"), F.max("moved").alias("moved")),
            "edges",
        )
    found = reduce(DataFrame.unionByName, placed) if placed else nodes.withColumn("level", F.lit(0))
    return found.join(unknown, ["conv", "call_id"], "left")


def _followed(edges: DataFrame, most: int) -> DataFrame:
    """Per call: whether its level is known (``done``), whether other calls' edges to it can be
    replaced (``follows``), and by what: ``to`` (null: nothing more), ``to_w`` and ``cycle``."""
    per_call = edges.groupBy("conv", "call_id").agg(
        F.count("on").alias("n"),
        F.min("on").alias("to"),
        F.max(F.when(F.col("on").isNotNull(), F.col("w"))).alias("w"),
        F.max(F.when(F.col("on").isNull(), F.col("w"))).alias("bound"),
        (F.max("cycle") | (F.max("w") > most)).alias("cycle"),
    )
    done = (F.col("n") == 0) | F.col("cycle")
    one = (F.col("n") == 1) & F.coalesce(F.col("bound") <= F.col("w"), F.lit(True))
    return per_call.select(
        "conv",
        "call_id",
        done.alias("done"),
        (done | one).alias("follows"),
        F.when(~done, F.col("to")).alias("to"),
        F.when(F.col("cycle"), F.lit(-1)).when(done, F.col("bound")).otherwise(F.col("w")).cast("long").alias("to_w"),
        "cycle",
    )


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], all_results: bool = False) -> DataFrame:
    """``calls`` (conv_id, call_id, turn, name, arguments, depends_on) and
    ``results`` (conv_id, call_id, turn, content) -> one line each: (conv_id,
    position, call_id, name, status, valid, errors, json). ``all_results``:
    further results of a call are lines too, not only counted."""
    conv_type = calls.schema["conv_id"].dataType.simpleString()
    linkable = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    named = calls.filter(linkable).select(
        F.col("conv_id").cast("string").alias("conv"), "conv_id", "call_id", "turn", "name", "arguments", "depends_on"
    )
    first = F.struct("turn", "name", "arguments", F.sort_array("depends_on").alias("depends_on"), "conv_id")
    one = named.groupBy("conv", "call_id").agg(F.min(first).alias("c")).select("conv", "call_id", "c.*")
    one = stored(one, "calls")
    answers = (
        results.filter(linkable)
        .groupBy(F.col("conv_id").cast("string").alias("conv"), "call_id")
        .agg(F.count(F.lit(1)).alias("n_results"), F.min("content").alias("content"), F.min("turn").alias("r_turn"), F.min("conv_id").alias("r_conv"))
    )
    linked = one.join(levels(one), ["conv", "call_id"]).join(answers.hint("shuffle_hash"), ["conv", "call_id"], "full").select(
        F.coalesce("conv_id", "r_conv").alias("conv_id"),
        "conv",
        "call_id",
        F.coalesce("turn", "r_turn").alias("turn"),
        "name",
        "arguments",
        "depends_on",
        F.coalesce("level", F.lit(0)).alias("level"),
        F.coalesce("unknown", F.lit(False)).alias("unknown"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        "content",
        F.when(F.col("level").isNull(), "orphan").when(F.col("n_results").isNull(), "open").otherwise("linked").alias("status"),
    )
    lone_calls = calls.filter(~linkable).select(
        "conv_id", F.col("conv_id").cast("string").alias("conv"), "call_id", "turn", "name", "arguments", "depends_on",
        F.lit(0).alias("level"), F.lit(False).alias("unknown"), F.lit(0).cast("long").alias("n_results"),
        F.lit(None).cast("string").alias("content"), F.lit("open").alias("status"),
    )
    lone_results = results.filter(~linkable).select(
        "conv_id", F.col("conv_id").cast("string").alias("conv"), "call_id", "turn", F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("array<string>").alias("depends_on"),
        F.lit(0).alias("level"), F.lit(False).alias("unknown"), F.lit(1).cast("long").alias("n_results"),
        "content", F.lit("orphan").alias("status"),
    )
    # further calls and results of an identifier; only those of keys that have any are joined
    keys = ["conv", "call_id"]
    several = named.groupBy(keys).agg(F.min(first).alias("c"), F.max(first).alias("m")).filter("not c <=> m").select(*keys, "c")
    more_calls = named.select(*keys, first.alias("o")).join(several, keys).filter("not o <=> c").select(*keys, "o").distinct().select(
        "o.conv_id", *keys, "o.turn", "o.name", "o.arguments", "o.depends_on",
        F.lit(-2).alias("level"), F.lit(False).alias("unknown"), F.lit(0).cast("long").alias("n_results"),
        F.lit(None).cast("string").alias("content"), F.lit("duplicate").alias("status"),
    )
    lines = linked.unionByName(lone_calls).unionByName(lone_results).unionByName(more_calls)
    if all_results:
        given = results.filter(linkable).withColumn("conv", F.col("conv_id").cast("string"))
        mixed = F.min("content").isNotNull() & ((F.min("content") != F.max("content")) | (F.count("content") < F.count(F.lit(1))))
        mixed = given.groupBy(keys).agg(F.min("content").alias("c"), mixed.alias("mixed")).filter("mixed").select(*keys, "c")
        further = given.join(mixed, keys).filter("not content <=> c").groupBy(*keys, "content")
        lines = lines.unionByName(
            further.agg(F.min("turn").alias("turn"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_results")).select(
                "conv_id", *keys, "turn", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
                F.lit(None).cast("array<string>").alias("depends_on"), F.lit(-2).alias("level"), F.lit(False).alias("unknown"),
                "n_results", "content", F.lit("duplicate").alias("status"),
            )
        )
    lines = lines.withColumns({"_last": F.col("level") < 0, "_tie": F.xxhash64("name", "arguments", "content")})
    numbered = sequence_number(lines, ["conv"], ["_last", "level", "turn", "call_id", "status", "_tie"], "position")
    return numbered.mapInArrow(
        _serialise(schemas),
        f"conv_id {conv_type}, position long, call_id string, name string, status string, valid boolean, errors array<string>, json string",
    )


def chat_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a plain conversation (conv_id, turn, role, text)
    stands for: a user turn calls ``reply``, a system turn ``configure``; an
    assistant turn is the result of the turn before it. Replies depend on the
    conversation's first system turn if that is before it. A turn of any other
    role (or none) is a call of that name without an identifier, so it stays open."""
    ident = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    whole = F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), ident(F.col("turn")))
    system = (
        messages.filter("role = 'system' and conv_id is not null and turn is not null")
        .groupBy("conv_id")
        .agg(F.min("turn").alias("start"))  # the first one; a conversation has few or none
    )
    asked = messages.filter("role in ('user', 'system')").join(system, "conv_id", "left")
    calls = asked.select(
        "conv_id",
        whole.alias("call_id"),
        "turn",
        F.when(F.col("role") == "system", "configure").otherwise("reply").alias("name"),
        F.when(F.col("role") == "system", F.to_json(F.struct(F.col("text").alias("instructions"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("message"), "turn")))
        .alias("arguments"),
        F.when((F.col("role") == "user") & (F.col("start") < F.col("turn")), F.array(ident(F.col("start"))))
        .otherwise(F.array().cast("array<string>"))
        .alias("depends_on"),
    )
    results = messages.filter("role = 'assistant'").select(
        "conv_id",
        F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), ident(F.col("turn") - 1)).alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    others = messages.filter("role is null or role not in ('user', 'system', 'assistant')").select(
        "conv_id",
        F.lit(None).cast("string").alias("call_id"),
        "turn",
        F.col("role").alias("name"),
        F.to_json(F.struct(F.col("text").alias("message"), "turn")).alias("arguments"),
        F.array().cast("array<string>").alias("depends_on"),
    )
    return calls.unionByName(others), results


def op5_tool_call_linking(spark, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations`` as linked, validated lines."""
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return link_calls(*chat_calls(messages), CHAT_SCHEMAS, all_results=True)
