"""Tool-call linking: calls and results joined by identifier, ordered by their references, validated, canonical.

Messages hold calls as ``<tool_call>{"id", "name", "arguments"}</tool_call>`` blocks in any role's text and
results as messages of role ``tool`` with ``{"tool_call_id", "content"}``. A block ends with its JSON value, so a
closing mark inside a string is text; each block is parsed once, and references, errors and the canonical
arguments all come from the parsed value. Calls and results meet in a hash join on
(conversation, identifier). A call depends on the calls that ``{"$ref": identifier}`` in its arguments names;
levels come from peeling, call by call inside blocks of ``TURNS`` turns of a conversation, so that a task holds a
block and not a conversation. References across blocks are settled in rounds, for all conversations at
once, until a round frees no call; a conversation that fits a block needs one. Each round also contracts runs of
blocks, twice as long each time: references within a run to calls that wait for ``WIDTH`` others at most are replaced by
what those wait for. So long chains need rounds by their logarithm; where calls wait for more, rounds go block by block.

One row per call and per result without a call. ``status``: ``linked``, ``unanswered``, ``early`` (the result
comes before its call), ``duplicate`` (the identifier was used before; only the first is linked and
referred to), ``orphan`` (a result without a call). ``level`` is NULL for calls in or behind a circle of references.
``errors`` lists, by path, where the arguments miss the tool's schema; ``missing_refs`` references that no call has.

Defined results: NULL texts hold nothing; blocks that are no JSON object with an identifier, or are nested deeper than
the parser goes, get status ``malformed`` and keep their text as ``arguments``; arguments in a string that holds
JSON count as that JSON, other strings as themselves (error ``$: no JSON``), missing ones as null; numbers beyond the range of doubles keep their written form, lone
surrogates are written as escapes, ``NaN`` and ``Infinity`` are no JSON; a NULL conversation is a conversation of its own;
of several results for a call the first counts; repeated rows are duplicates of the first; empty
tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

import json
import math
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.sources.staging import drop_stage, stage_table

OPEN, CLOSE = "<tool_call>", "</tool_call>"
BLANKS, AFTER = re.compile(r"[ \t\n\r]*"), re.compile(r"[ \t\n\r]*" + CLOSE)
#: Digits of an integer beyond which it keeps its written form.
DIGITS = 4000
TURNS = 512
#: References of a call up to which they are passed on; a call has the square of that at most by then.
WIDTH = 4
#: Longer than any path; steps around a circle, which double as well, stay there.
FAR = 2 ** 31


class Huge(float):
    """A number that no double holds, with its written form."""

    def __new__(cls, text: str):
        out = super().__new__(cls, text)
        out.text = text
        return out


def _constant(text: str) -> None:
    raise ValueError(f"{text} is no JSON")


DECODER = json.JSONDecoder(
    parse_float=lambda s: float(s) if math.isfinite(float(s)) else Huge(s),
    parse_int=lambda s: int(s) if len(s) <= DIGITS else Huge(s), parse_constant=_constant)


def escaped(text: str) -> str:
    """``text`` with lone surrogates, which no UTF-8 holds, as escapes."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def scalar(value: object) -> str:
    if isinstance(value, Huge):
        return value.text
    if isinstance(value, float) and value.is_integer() and abs(value) < 2 ** 53:
        return str(int(value))
    return escaped(json.dumps(value, ensure_ascii=False))


def canonical(value: object) -> str:
    """JSON with keys in order of their UTF-16 units, no blanks, no escapes that are not needed, whole floats as integers.

    Works on a stack of its own, so that any depth has a form.
    """
    out, todo = [], [(value, False)]
    while todo:
        item, written = todo.pop()
        if written:
            out.append(item)
        elif isinstance(item, dict):
            keys = sorted(item, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
            out.append("{")
            todo.append(("}", True))
            for i in range(len(keys) - 1, -1, -1):
                todo += [(item[keys[i]], False), ("," * (i > 0) + scalar(keys[i]) + ":", True)]
        elif isinstance(item, list):
            out.append("[")
            todo.append(("]", True))
            for i in range(len(item) - 1, -1, -1):
                todo += [(item[i], False), ("," * (i > 0), True)]
        else:
            out.append(scalar(item))
    return "".join(out)


def references(value: object) -> list[str]:
    """The identifiers that ``{"$ref": identifier}`` objects anywhere in ``value`` name, sorted."""
    found, todo = set(), [value]
    while todo:
        item = todo.pop()
        if isinstance(item, dict):
            if isinstance(item.get("$ref"), str):
                found.add(escaped(item["$ref"]))
            todo += item.values()
        elif isinstance(item, list):
            todo += item
    return sorted(found)


def is_kind(value: object, kind: str) -> bool:
    if kind == "number":
        return isinstance(value, int | float) and not isinstance(value, bool)
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
    return isinstance(value, kinds[kind])


def own_errors(value: object, schema: dict, path: str) -> tuple[list[str], list[tuple[object, dict, str]]]:
    """Where ``value`` itself misses ``schema``, and its parts with their schemas and paths."""
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return [], []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(is_kind(value, k) for k in kinds):
        return [f"{path}: type"], []
    out = [f"{path}: {word}" for word, bad in (
        ("enum", "enum" in schema and value not in schema["enum"]),
        ("const", "const" in schema and value != schema["const"])) if bad]
    if is_kind(value, "number"):
        out += [f"{path}: {word}" for word, bad in (
            ("minimum", value < schema.get("minimum", value)), ("maximum", value > schema.get("maximum", value))) if bad]
    if isinstance(value, str):
        out += [f"{path}: {word}" for word, bad in (
            ("minLength", len(value) < schema.get("minLength", 0)),
            ("maxLength", len(value) > schema.get("maxLength", len(value))),
            ("pattern", not re.search(schema.get("pattern", ""), value))) if bad]
    if isinstance(value, list):
        return out, [(item, schema.get("items", {}), f"{path}[{i}]") for i, item in enumerate(value)]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: required" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{path}.{k}: unknown" for k in sorted(value) if k not in known]
        return out, [(value[k], known.get(k, {}), f"{path}.{k}") for k in sorted(value)]
    return out, []


def schema_errors(value: object, schema: dict, path: str = "$") -> list[str]:
    """Where ``value`` misses ``schema``: type, enum, const, bounds, lengths, pattern, items, properties. References fit anywhere.

    Parts that no schema says anything of are not walked, so deep values cost no long paths.
    """
    out, todo = [], [(value, schema, path)]
    while todo:
        own, parts = own_errors(*todo.pop())
        out += own
        todo += [p for p in reversed(parts) if p[1]]
    return out


def parsed(text: str, at: int = 0) -> tuple[object, int]:
    """The JSON value that starts at ``at`` (blanks before it pass), and where it ends; ValueError where there is none."""
    try:
        return DECODER.raw_decode(text, BLANKS.match(text, at).end())
    except RecursionError as e:
        raise ValueError("nested too deep") from e


def name_text(value: object) -> str | None:
    return None if value is None else escaped(value) if isinstance(value, str) else canonical(value)


def read_call(value: dict, schemas: dict[str, dict]) -> dict:
    """Identifier, tool, canonical arguments, references and errors of a parsed block."""
    own, tool, arguments = name_text(value["id"]), name_text(value.get("name")), value.get("arguments")
    errors = None
    if isinstance(arguments, str):
        try:
            inner, end = parsed(arguments)
            if BLANKS.match(arguments, end).end() < len(arguments):
                raise ValueError("more than one value")
            arguments = inner
        except ValueError:
            errors = ["$: no JSON"]
    if errors is None:
        errors = ["$: no schema"] if tool not in schemas else schema_errors(arguments, schemas[tool])
    return {"call_id": own, "tool": tool, "arguments": canonical(arguments), "refs": references(arguments),
            "errors": escaped("; ".join(errors))}


def blocks_of(text: str, schemas: dict[str, dict]) -> list[dict]:
    """The call blocks of a text, in order; without a closing mark there is no block."""
    out, at = [], 0
    while (at := text.find(OPEN, at)) >= 0:
        at += len(OPEN)
        try:
            value, end = parsed(text, at)
            after = AFTER.match(text, end)
            if after and isinstance(value, dict) and value.get("id") is not None:
                out.append(read_call(value, schemas))
                at = after.end()
                continue
        except ValueError:
            after = None
        end = after.start() if after else text.find(CLOSE, at)
        if end < 0:
            break
        body = text[at:after.end() - len(CLOSE)] if after else text[at:end]
        out.append({"call_id": None, "tool": None, "arguments": canonical(body), "refs": [], "errors": "$: no JSON call"})
        at = after.end() if after else end + len(CLOSE)
    return out


CALLS = "array<struct<call_id: string, tool: string, arguments: string, refs: array<string>, errors: string>>"


def calls_in(messages: DataFrame, schemas: dict[str, dict], conversation: str, turn: str, text: str) -> DataFrame:
    """(conv, turn, place, call_id, tool, arguments, refs, errors): the call blocks, in order."""
    @F.pandas_udf(CALLS)
    def blocks(texts: pd.Series) -> pd.Series:
        return pd.Series([blocks_of(t, schemas) for t in texts], dtype=object)

    found = messages.filter(F.contains(F.col(text), F.lit(OPEN))).select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.posexplode(blocks(text)).alias("place", "block"))
    return found.select("conv", "turn", "place", "block.*")


def results_in(messages: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, call_id, result_turn, content): the first result for each identifier."""
    rows = messages.filter(F.col(role) == "tool").select(
        F.col(conversation).alias("conv"), F.get_json_object(text, "$.tool_call_id").alias("call_id"),
        F.struct(F.col(turn).alias("result_turn"), F.get_json_object(text, "$.content").alias("content")).alias("r"))
    return rows.filter("call_id is not null").groupBy("conv", "call_id").agg(F.min("r").alias("r")).select(
        "conv", "call_id", "r.*")


def same_call(a: DataFrame, b: DataFrame, name: str = "call_id"):
    return a["conv"].eqNullSafe(b["conv"]) & (a["call_id"] == b[name])


def solve(table: pa.Table) -> pa.Table:
    """Levels of the calls of a block that wait for no other block: rows without ``ref`` are calls with their least level
    so far in ``steps``, others references with the steps they count, ``outside`` to other blocks."""
    rows = table.to_pylist()
    level = {r["call_id"]: r["steps"] for r in rows if r["ref"] is None}
    waits: dict[str, set] = {c: set() for c in level}
    users: dict[str, list] = {}
    for r in rows:
        if r["ref"] is not None:
            waits[r["call_id"]].add(r["ref"])
            if not r["outside"]:
                users.setdefault(r["ref"], []).append((r["call_id"], r["steps"]))
    free = [c for c, w in waits.items() if not w]
    for c in free:  # grows while it is read
        for user, steps in users.get(c, ()):
            level[user] = max(level[user], level[c] + steps)
            waits[user].discard(c)
            if not waits[user]:
                free.append(user)
    return pa.table({"conv": pa.repeat(table.column("conv")[0], len(free)), "call_id": pa.array(free, pa.string()),
                     "level": pa.array([level[c] for c in free], pa.int32())})


def next_round(waiting: DataFrame, refs: DataFrame, found: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """The calls still waiting and their references after ``found``; narrow references
    within a run of 2 ** ``turn`` blocks are replaced by what they wait for."""
    left = waiting.join(found, same_call(waiting, found), "left_anti")
    own = refs.join(found, same_call(refs, found), "left_anti")
    told = stage_table(own.join(found, own["conv"].eqNullSafe(found["conv"]) & (own["ref"] == found["call_id"]), "left").select(
        own["conv"], "block", own["call_id"], "ref", "ref_block", "steps", "level"), "call-told")
    known = told.filter("level is not null").groupBy("conv", "call_id").agg(F.max(F.col("steps") + F.col("level")).alias("least"))
    calls = stage_table(left.join(known, same_call(left, known), "left").select(
        left["conv"], "block", left["call_id"], F.greatest("steps", "least").alias("steps")), "calls-waiting")
    rest = told.filter("level is null").drop("level")
    counts = stage_table(rest.groupBy("conv", "call_id").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") <= WIDTH), "narrow-calls")
    narrow = rest.join(counts, same_call(rest, counts), "left_semi")
    lists = narrow.groupBy("conv", "call_id").agg(F.collect_list(F.struct("ref", "ref_block", "steps")).alias("next"))
    passed = stage_table(lists.join(calls, same_call(lists, calls)).select(
        lists["conv"], lists["call_id"].alias("via"), "next", F.col("steps").alias("via_steps")), "calls-passed")
    jumps = stage_table(narrow.join(passed, narrow["conv"].eqNullSafe(passed["conv"]) & (narrow["ref"] == passed["via"])
        & (F.shiftright("block", turn) == F.shiftright("ref_block", turn)), "left").select(
        narrow["conv"], "block", narrow["call_id"], "ref", "ref_block", "steps", "next", "via_steps"), "call-jumps")
    far = F.lit(FAR).cast("long")
    moved = jumps.filter("next is not null").select("conv", "block", "call_id", "steps", F.explode("next").alias("e")).select(
        "conv", "block", "call_id", "e.ref", "e.ref_block", F.least(F.col("steps") + F.col("e.steps"), far).alias("steps"))
    kept = jumps.filter("next is null").drop("next", "via_steps").unionByName(
        rest.join(counts, same_call(rest, counts), "left_anti"))
    new_refs = stage_table(moved.unionByName(kept).groupBy("conv", "block", "call_id", "ref", "ref_block").agg(
        F.max("steps").alias("steps")), "call-references")
    least = jumps.filter("next is not null").groupBy("conv", "call_id").agg(
        F.max(F.least(F.col("steps") + F.col("via_steps"), far)).alias("least"))
    new_calls = stage_table(calls.join(least, same_call(calls, least), "left").select(
        calls["conv"], "block", calls["call_id"], F.greatest("steps", "least").alias("steps")), "calls-waiting")
    for done in (told, calls, counts, passed, jumps, waiting, refs):
        drop_stage(done)
    return new_calls, new_refs


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level, missing_refs) of first calls; level is NULL where references run in a circle."""
    nodes = stage_table(calls.select("conv", "call_id", F.floor(F.coalesce("turn", F.lit(0)) / TURNS).alias("block")),
                        "call-nodes")
    refs = calls.select("conv", "call_id", F.explode("refs").alias("ref"), F.floor(F.coalesce("turn", F.lit(0)) / TURNS).alias("block"))
    known = nodes.select("conv", "call_id", F.col("block").alias("ref_block"))
    named = stage_table(refs.join(
        known, refs["conv"].eqNullSafe(known["conv"]) & (refs["ref"] == known["call_id"]), "left").select(
        refs["conv"], refs["call_id"], "block", "ref", "ref_block"), "call-references")
    missing = named.filter("ref_block is null").groupBy("conv", "call_id").agg(
        F.array_join(F.array_sort(F.collect_list("ref")), ",").alias("missing_refs"))
    kind = dict(calls.dtypes)["conv"]
    refs = named.filter("ref_block is not null").withColumn("steps", F.lit(1).cast("long"))
    waiting, across = nodes.withColumn("steps", F.lit(0).cast("long")), refs.filter("ref_block <> block").limit(1).count()
    waiting, refs = (stage_table(waiting, "calls-waiting"), stage_table(refs, "call-references")) if across else (waiting, refs)
    done, turn = None, 0
    while True:  # of the calls that wait for no circle a round frees one at least
        rows = waiting.select("conv", "block", "call_id", F.lit(None).cast("string").alias("ref"), "steps",
                              F.lit(False).alias("outside")).unionByName(refs.select(
                                  "conv", "block", "call_id", "ref", "steps", (F.col("ref_block") != F.col("block")).alias("outside")))
        found = stage_table(rows.groupBy("conv", "block").applyInArrow(
            solve, f"conv {kind}, call_id string, level int"), "call-levels")
        if done is not None and not found.limit(1).count():
            break
        done = found if done is None else stage_table(done.unionByName(found), "call-levels")
        if not across:
            break
        turn = min(turn + 1, 62)
        waiting, refs = next_round(waiting, refs, found, turn)
    out = nodes.join(done, same_call(nodes, done), "left").select(nodes["conv"], nodes["call_id"], "level")
    return out.join(missing, same_call(out, missing), "left").select(
        out["conv"], out["call_id"], "level", F.coalesce("missing_refs", F.lit("")).alias("missing_refs"))


def records(call_id: pd.Series, tool: pd.Series, arguments: pd.Series, content: pd.Series) -> pd.Series:
    """The canonical record of a call, around its canonical arguments."""
    return pd.Series([
        f'{{"arguments":{args},"id":{scalar(own)},"name":{scalar(name)},"result":{scalar(result)}}}'
        for own, name, args, result in zip(call_id, tool, arguments, content, strict=True)], dtype=object)


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict], conversation: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """Calls with their results, levels, errors and canonical records; see the module for the columns' meaning."""
    calls = stage_table(calls_in(messages, schemas, conversation, turn, text), "calls")
    results = stage_table(results_in(messages, conversation, turn, role, text), "results")
    firsts = stage_table(calls.filter("call_id is not null").groupBy("conv", "call_id").agg(
        F.min(F.struct("turn", "place", "tool", "arguments", "refs", "errors")).alias("c"), F.count(F.lit(1)).alias("n")).select(
        "conv", "call_id", "c.*", "n"), "first-calls")
    ranked = levels(firsts)
    joined = firsts.join(results, same_call(firsts, results), "left").select(
        firsts["conv"], firsts["call_id"], "turn", "place", "tool", "arguments", "errors", "result_turn", "content")
    linked = joined.join(ranked, same_call(joined, ranked), "left").select(
        joined["conv"], joined["call_id"], "turn", "place", "tool", "arguments", "errors", "result_turn", "content", "level",
        "missing_refs", F.when(F.col("result_turn").isNull(), "unanswered").when(
            F.col("result_turn") < F.col("turn"), "early").otherwise("linked").alias("status"))
    first = firsts.select("conv", "call_id", F.col("turn").alias("t"), F.col("place").alias("p"), "n")
    # The first row of an identifier is the smallest; rows equal to it in place count by number.
    later = calls.join(first.filter("n > 1"), same_call(calls, first)).filter(
        ~(F.col("turn").eqNullSafe(F.col("t")) & (F.col("place") == F.col("p")))).select(
        calls["conv"], calls["call_id"], "turn", "place", calls["tool"], calls["arguments"], calls["errors"], F.lit("duplicate").alias("status"))
    same = calls.join(first.filter("n > 1"), same_call(calls, first)).filter(
        F.col("turn").eqNullSafe(F.col("t")) & (F.col("place") == F.col("p"))).groupBy(
        calls["conv"], calls["call_id"], "turn", "place").agg(
        F.max("tool").alias("tool"), F.max(F.struct("arguments", "errors")).alias("c"), F.count(F.lit(1)).alias("k"))
    copies = same.filter("k > 1").withColumn("_", F.explode(F.sequence(F.lit(2).cast("long"), "k"))).select(
        "conv", "call_id", "turn", "place", "tool", "c.arguments", "c.errors", F.lit("duplicate").alias("status"))
    broken = calls.filter("call_id is null").drop("refs").withColumn("status", F.lit("malformed"))
    orphans = results.join(firsts, same_call(results, firsts), "left_anti").withColumn("status", F.lit("orphan"))
    parts = linked
    for more in (later, copies, broken, orphans):
        parts = parts.unionByName(more, allowMissingColumns=True)
    record = F.pandas_udf(records, "string")("call_id", "tool", "arguments", "content")
    return parts.select(
        F.col("conv").alias(conversation), "call_id", F.col("turn").alias(turn), "place", "tool", "status",
        "result_turn", "level", F.coalesce("missing_refs", F.lit("")).alias("missing_refs"),
        F.coalesce("errors", F.lit("")).alias("errors"), F.when(F.col("status") != "orphan", record).alias("record"))
