"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

DataFrame operations only.  ``link`` takes

* calls (call_id, name, arguments as JSON text, parent_id or null, further columns are dropped),
* results (call_id, content),
* schemas (name, arg, type, required, least, most), small: one row per argument of a tool.

1. Calls and results meet by hash join on the identifier.
2. A call whose ``parent_id`` is another call comes after it.  Depths come from pointer doubling: every round a
   call adds the depth of the call it points at and points where that one does, so chains of n calls take
   log2(n) rounds.  Calls on a cycle, or behind one, never reach a root; they get a null depth and the error
   ``cycle``.  (depth, call_id) is a topological order.
3. Arguments are parsed as variants and checked against the tool's schema: missing, unexpected, wrong type, or
   outside [least, most] (numbers by value, strings and arrays by length).
4. ``json`` is canonical: keys sorted, no blanks, null kept, one text for equal values.

Defined results: calls or results with a null identifier link with nothing (such calls keep a row each); a repeated call id keeps
the smallest (name, arguments, parent); repeated results keep the smallest content and are counted; a result
without a call is dropped; a parent that is no call counts as none; arguments that are no JSON object give the
error ``arguments`` and null in the JSON; a tool without schema gives ``unknown tool``; empty tables give no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SCHEMA_ROWS = 10_000


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth) from (call_id unique, parent_id): 0 for roots, null on or behind a cycle."""
    known = calls.select(F.col("call_id").alias("up"))
    state = (calls.select("call_id", F.col("parent_id").alias("up")).join(known.withColumn("_there", F.lit(True)), "up", "left")
             .select("call_id", F.when(F.col("_there"), F.col("up")).alias("up"), F.when(F.col("_there"), 1).otherwise(0).cast("bigint").alias("depth")).checkpoint())
    rounds = max(1, state.count()).bit_length() + 1
    for _ in range(rounds):
        if not state.where("up is not null").limit(1).count():
            break
        there = state.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        state = (state.join(there, "up", "left")
                 .select("call_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")).checkpoint())
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def schema_map(schemas: DataFrame) -> Column:
    """The schemas as one literal map name -> rules; their number is checked."""
    rows = schemas.select("name", "arg", "type", "required", "least", "most").limit(MAX_SCHEMA_ROWS + 1).collect()
    if len(rows) > MAX_SCHEMA_ROWS:
        raise ValueError(f"more than {MAX_SCHEMA_ROWS} schema rows")
    rules: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["name"], r["arg"])):
        rules.setdefault(r["name"], []).append({"arg": r["arg"], "type": r["type"], "required": bool(r["required"]), "least": r["least"], "most": r["most"]})
    kind = "map<string,array<struct<arg:string,type:string,required:boolean,least:double,most:double>>>"
    return F.from_json(F.lit(json.dumps(rules)), kind)


def _faults(args: Column, rules: Column) -> Column:
    """Sorted errors of the arguments (map<string, variant>) against the rules of the tool."""
    def check(rule: Column) -> Column:
        value = F.element_at(args, rule["arg"])
        kind = F.schema_of_variant(value)
        absent = value.isNull() | (kind == "VOID")
        number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        fits = (F.when(rule["type"] == "integer", kind == "BIGINT").when(rule["type"] == "number", number)
                .when(rule["type"] == "boolean", kind == "BOOLEAN").when(rule["type"] == "string", kind == "STRING")
                .when(rule["type"] == "array", kind.startswith("ARRAY")).when(rule["type"] == "object", kind.startswith("OBJECT")).otherwise(F.lit(False)))
        size = (F.when(number, F.try_variant_get(value, "$", "double")).when(kind == "STRING", F.length(F.try_variant_get(value, "$", "string")).cast("double"))
                .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(value, "$", "array<variant>")).cast("double")))
        outside = F.coalesce((size < rule["least"]) | (size > rule["most"]), (size < rule["least"]), (size > rule["most"]), F.lit(False))
        return (F.when(absent & rule["required"], F.concat(rule["arg"], F.lit(": missing")))
                .when(~absent & ~fits, F.concat(rule["arg"], F.lit(": type")))
                .when(~absent & outside, F.concat(rule["arg"], F.lit(": range"))))

    known = F.transform(rules, lambda r: r["arg"])
    unexpected = F.transform(F.array_except(F.map_keys(args), known), lambda k: F.concat(k, F.lit(": unexpected")))
    return F.array_sort(F.concat(F.filter(F.transform(rules, check), lambda e: e.isNotNull()), unexpected))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """(call_id, name, parent_id, depth, n_results, valid, errors, json) of every call."""
    rows = calls.select(F.col("call_id").cast("string").alias("call_id"), F.col("name").cast("string").alias("name"),
                        F.col("arguments").cast("string").alias("arguments"), F.col("parent_id").cast("string").alias("parent_id"))
    body = F.struct("name", "arguments", "parent_id")
    unique = (rows.where("call_id is not null").groupBy("call_id").agg(F.min(body).alias("b")).select("call_id", "b.*")).checkpoint()
    got = (results.select(F.col("call_id").cast("string").alias("call_id"), F.col("content").cast("string").alias("content")).where("call_id is not null")
           .groupBy("call_id").agg(F.min("content").alias("result"), F.count(F.lit(1)).alias("n_results")))
    linked = unique.join(got, "call_id", "left").join(depths(unique), "call_id", "left")
    nameless = rows.where("call_id is null").withColumns({"result": F.lit(None).cast("string"), "n_results": F.lit(None).cast("bigint"), "depth": F.lit(0).cast("bigint")})
    both = linked.unionByName(nameless)
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    both = both.withColumn("_args", F.when(is_object, parsed)).withColumn("_rules", F.element_at(schema_map(schemas), F.coalesce("name", F.lit(""))))
    faults = (F.when(~is_object, F.array(F.lit("arguments"))).when(F.col("_rules").isNull(), F.array(F.lit("unknown tool")))
              .otherwise(_faults(F.try_variant_get("_args", "$", "map<string,variant>"), F.col("_rules"))))
    errors = F.concat(faults, F.when(F.col("depth").isNull(), F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>")))
    told = both.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)
    record = F.struct(F.col("_args").alias("arguments"), "depth", "errors", F.col("call_id").alias("id"), "name", F.col("parent_id").alias("parent"), "result", "valid")
    return told.select("call_id", "name", "parent_id", "depth", F.coalesce("n_results", F.lit(0)).alias("n_results"), "valid",
                       F.array_join("errors", ",").alias("errors"), F.to_json(record, {"ignoreNullFields": "false"}).alias("json"))
