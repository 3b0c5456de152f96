"""Tool calls of conversations: linked with their results, ordered, validated and serialised.

Calls and results meet in a hash join on conversation and identifier. Calls name the calls they come after;
the level of a call is one more than the highest of those, and sorting by level and turn is a topological
order. It is found in rounds over all conversations together, so none has to fit into one task. A call behind
a single other one points to it, and pointers are doubled: a chain of n calls takes about log2(n) rounds.
Arguments are checked against the schema of the called tool, and each call becomes one line of canonical
JSON: sorted names, no blanks.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farebox.llm.tables import map_batches, stage

_TYPES = {
    "string": (str,),
    "integer": (int,),
    "number": (int, float),
    "boolean": (bool,),
    "object": (dict,),
    "array": (list,),
    "null": (type(None),),
}
_OUT = (
    "conv_id long, call_id string, turn long, level int, name string, status string, valid boolean, "
    "errors string, line string"
)


def canonical(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def schema_errors(value, schema: Mapping, at: str = "$") -> list[str]:
    """What is wrong with ``value``: type, enum, bounds, lengths, required and unknown properties, items."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _TYPES[kind]) or isinstance(value, bool) and kind in ("integer", "number")):
        return [f"{at}: not of type {kind}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not one of the allowed values")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            found.append(f"{at}: too small")
        if value > schema.get("maximum", value):
            found.append(f"{at}: too large")
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        if len(value) < schema.get(low, 0):
            found.append(f"{at}: too short")
        if len(value) > schema.get(high, len(value)):
            found.append(f"{at}: too long")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += schema_errors(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in sorted(schema.get("required", ())) if name not in value]
        for name in sorted(value):
            if name in known:
                found += schema_errors(value[name], known[name], f"{at}.{name}")
            elif not schema.get("additionalProperties", True):
                found.append(f"{at}.{name}: unknown")
    return found


def call_levels(calls: DataFrame) -> DataFrame:
    """(key, level) of calls with ``key`` and ``after``, keys of other calls; without a row for those in or behind a cycle.

    Keys in ``after`` that no call has are ignored.
    """
    ids = calls.select("key").distinct()
    named = calls.select("key", F.explode("after").alias("before")).distinct()
    edges = stage(named.join(ids.withColumnsRenamed({"key": "before"}), "before").select("key", "before"), "edges")
    waits = edges.groupBy("key").agg(F.count("*").alias("n"), F.min("before").alias("to"))
    settled = stage(ids.join(edges, "key", "left_anti").withColumn("level", F.lit(0)), "levels")
    jumps = stage(waits.where("n = 1").select("key", "to", F.lit(1).alias("far")), "jumps")
    several = stage(waits.where("n > 1").select("key", "n"), "several")
    fresh = settled
    while not fresh.isEmpty():
        known = settled.withColumnsRenamed({"key": "to", "level": "top"})
        chained = jumps.join(known, "to").select("key", (F.col("top") + F.col("far")).alias("level"))
        reached = edges.join(several, "key").join(known.withColumnRenamed("to", "before"), "before")
        reached = reached.groupBy("key", "n").agg(F.count("*").alias("m"), F.max("top").alias("top")).where("m = n")
        fresh = stage(chained.union(reached.select("key", (F.col("top") + 1).alias("level"))), "levels")
        settled = settled.union(fresh)
        done = fresh.select("key")
        several = stage(several.join(done, "key", "left_anti"), "several")
        left = jumps.join(done, "key", "left_anti")
        # What a pointer leads to may itself point further; settled calls and those behind several stay its end.
        onward = left.select(F.col("key").alias("to"), F.col("to").alias("onward"), F.col("far").alias("more"))
        further = F.coalesce("onward", "to").alias("to"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far")
        jumps = stage(left.join(onward, "to", "left").select("key", *further), "jumps")
    return settled


def _line(schemas: Mapping[str, Mapping]):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string()]
    names = [field.split()[0] for field in _OUT.split(", ")]

    def one(row: dict) -> tuple:
        key = row["conv_id"], row["call_id"], row["turn"], row["level"], row["name"]
        if row["orphan"]:
            return (*key, row["status"] or "orphan", None, None, canonical({"id": row["call_id"], "result": row["content"]}))
        status = row["status"] or ("cycle" if row["level"] is None else "linked" if row["answered"] else "unanswered")
        try:
            arguments = json.loads(row["arguments"])
        except (TypeError, ValueError):
            errors, arguments = ["$: not JSON"], row["arguments"]
        else:
            known = row["name"] in schemas
            errors = schema_errors(arguments, schemas[row["name"]]) if known else ["$: unknown tool"]
        said = {"arguments": arguments, "id": row["call_id"], "name": row["name"], "result": row["content"]}
        return (*key, status, not errors, "; ".join(errors), canonical(said))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(row) for row in batch.to_pylist()]
            if rows:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row per call, and one per result that answers none.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), after (identifiers in the conversation);
    ``results``: conv_id, call_id, turn, content. Result: conv_id, call_id, turn, level, name, status, valid,
    errors, line. Identifiers need to be unique in a conversation only; rows without a conversation are one.
    Status is linked, unanswered or cycle for a call, orphan for a result without a call. Repeated rows count
    once. Of different calls, or results, with one identifier the least by turn, then by content, counts; the
    others are surplus, and calls without an identifier nameless: they link with nothing and have no level.
    Null arguments are invalid.
    """
    at = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), "call_id")
    after = F.transform("after", lambda a: F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), a))
    said = F.struct("turn", "arguments", "name", "conv_id", "call_id", F.coalesce(after, F.array()).alias("after"))
    told = F.struct("turn", "content", "conv_id", "call_id")
    key = F.when(F.col("call_id").isNotNull(), at).alias("key")

    def chosen(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(the row of each key, the other rows)."""
        rows = rows.distinct()
        first = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("row").alias("row"))
        rest = rows.join(first.withColumnsRenamed({"row": "first"}), "key", "left")
        return first, rest.where("first IS NULL OR first <> row").select("key", "row")

    call, more_calls = chosen(calls.select(key, said.alias("row")))
    answer, more_results = chosen(results.select(key, told.alias("row")))
    both = call.withColumnRenamed("row", "c").join(answer.withColumnRenamed("row", "r"), "key", "full")
    levelled = both.join(call_levels(call.select("key", "row.after")), "key", "left")
    surplus = F.when(F.col("key").isNotNull(), "surplus")
    extra = more_calls.select(F.col("row").alias("c"), F.coalesce(surplus, F.lit("nameless")).alias("status"))
    extra = extra.unionByName(more_results.select(F.col("row").alias("r"), surplus.alias("status")), allowMissingColumns=True)
    rows = levelled.unionByName(extra, allowMissingColumns=True).select(
        F.coalesce("c.conv_id", "r.conv_id").cast("long").alias("conv_id"),
        F.coalesce("c.call_id", "r.call_id").alias("call_id"),
        F.coalesce("c.turn", "r.turn").cast("long").alias("turn"),
        F.col("level").cast("int").alias("level"),
        "c.name",
        "c.arguments",
        F.col("r.content").alias("content"),
        F.col("r").isNotNull().alias("answered"),
        F.col("c").isNull().alias("orphan"),
        "status",
    )
    return map_batches(rows, _line(schemas), _OUT)
