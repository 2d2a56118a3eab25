"""Tool-call linking for chat data: calls and results joined by identifier, ordered, validated.

``messages`` has (conv_id, turn, role, text), where the text of an assistant's tool call is JSON
``{"id", "name", "arguments": {...}, "after": [ids]}`` and that of a tool's result is JSON
``{"call_id", "content"}``. ``link_calls`` gives one row per call:

* ``result``: the content of the result with the same identifier in the conversation; of several
  results the first (turn, then text) counts, a call without any is ``unanswered``.
* ``rank``: place in a topological order of the conversation. A call comes after all calls it
  names in ``after``; among free calls the earlier turn goes first. The sort key is the pair
  (latest turn among the call and all it depends on, steps past that turn), found by joins that
  repeat until nothing changes; references forward in time are therefore followed. Calls on a
  cycle, and calls of no later turn that wait for one, are ``cyclic``: their key would grow for
  ever. Conversations that still change after ``depth`` rounds, by a cycle or a longer chain, are
  ordered one by one in tasks, from ids, turns and references alone; that is exact for chains of
  any length. A call of a later turn does not wait for cyclic ones.
* ``problems``: sorted list of what the schema of the named tool finds wrong (``unknown tool``,
  ``not json``, ``missing <field>``, ``type <field>``, ``extra <field>``).
* ``line``: the call and its result as canonical JSON: sorted keys, no spaces, ASCII escapes.

Calls that repeat an identifier in a conversation keep the first (turn, then text); the others
are rows with status ``repeated`` and rank null. Null texts and texts that are not JSON objects
with an identifier are no calls or results. References to unknown identifiers are ignored.
A null conv_id is a conversation of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.session import stored

DEPTH = 64  # rounds of joins, after which the conversations left are ordered one by one
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}


def problems_of(arguments: str | None, schema: dict | None) -> list[str]:
    """What a JSON schema (type, required, properties with types) finds wrong."""
    if schema is None:
        return ["unknown tool"]
    try:
        given = json.loads(arguments or "")
    except ValueError:
        return ["not json"]
    if not isinstance(given, dict):
        return ["not json"]
    known = schema.get("properties", {})
    found = [f"missing {k}" for k in schema.get("required", []) if k not in given]
    found += [f"extra {k}" for k in given if k not in known]
    for k, v in given.items():
        kind = KINDS.get(known.get(k, {}).get("type"))
        if kind and (not isinstance(v, kind) or (isinstance(v, bool) and kind is not bool)):
            found.append(f"type {k}")
    return sorted(found)


def canonical(text: str | None) -> object:
    """Parsed JSON where the text is JSON, else the text itself."""
    try:
        return json.loads(text) if text is not None else None
    except ValueError:
        return text


def _first(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Marks the first row of each key; repeats combine in the task before they are shuffled."""
    return rows.groupBy(*keys).agg(F.min(F.struct("turn", "text")).alias("first"))


def order_of(turns: dict[str, int | None], needs: list[tuple[str, str]]) -> dict[str, tuple[int | None, int, bool]]:
    """(key, steps, cyclic) of the calls of one conversation, in time linear in calls and references."""
    users: dict[str, list[str]] = {k: [] for k in turns}
    for one, other in needs:
        users[other].append(one)
    key: dict[str, int | None] = {}
    for first in sorted(turns, key=lambda k: (turns[k] is not None, turns[k] or 0), reverse=True):
        todo = [first] if first not in key else []
        while todo:  # whatever depends on the latest turn has its key
            one = todo.pop()
            if one not in key:
                key[one] = turns[first]
                todo += users[one]
    waits = dict.fromkeys(turns, 0)
    for one, other in needs:
        waits[one] += key[one] == key[other]
    free, steps, placed = [k for k in turns if not waits[k]], dict.fromkeys(turns, 0), set()
    while free:
        other = free.pop()
        placed.add(other)
        for one in users[other]:
            if key[one] == key[other]:
                steps[one] = max(steps[one], steps[other] + 1)
                waits[one] -= 1
                if not waits[one]:
                    free.append(one)
    return {k: (key[k], steps[k], k not in placed) for k in turns}


def _order(calls: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """(conv, id, key, steps, cyclic) of calls; ``edges`` are (conv, id, needs) of known calls."""
    state = stored(calls.select("conv", "id", F.col("turn").alias("key"), F.lit(0).alias("steps")), "calls")
    edges = stored(edges, "call-edges")
    start, moved = state, None
    for _ in range(depth):
        need = state.select("conv", F.col("id").alias("needs"), F.col("key").alias("k"), F.col("steps").alias("s"))
        late = edges.join(need, ["conv", "needs"]).groupBy("conv", "id").agg(F.max(F.struct("k", F.col("s") + 1)).alias("late"))
        moved = state.join(late, ["conv", "id"]).where(F.col("late") > F.struct(F.col("key").alias("k"), F.col("steps").alias("s")))
        moved = stored(moved.select("conv", "id", F.col("late.k").alias("k"), F.col("late.col2").alias("s")), "calls-moved")
        if moved.isEmpty():
            return state.withColumn("cyclic", F.lit(False))
        state = stored(state.join(moved, ["conv", "id"], "left").select("conv", "id", F.coalesce("k", "key").alias("key"), F.coalesce("s", "steps").alias("steps")), "calls")
    if moved is None:
        moved = state

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        turns = {i: None if pd.isna(t) else int(t) for i, t in zip(rows["id"], rows["turn"])}
        found = order_of(turns, [(i, n) for i, n in zip(rows["id"], rows["needs"]) if not pd.isna(n)])
        out = [(rows["conv"].iloc[0], i, None if k is None else str(k), s, c) for i, (k, s, c) in found.items()]
        return pd.DataFrame(out, columns=["conv", "id", "key", "steps", "cyclic"])

    open_ = stored(moved.select("conv").distinct(), "calls-open")
    rest = start.join(open_, "conv", "left_semi").select("conv", "id", F.col("key").cast("string").alias("turn")).join(edges, ["conv", "id"], "left")
    rest = rest.groupBy("conv").applyInPandas(finish, "conv string, id string, key string, steps int, cyclic boolean")
    done = state.join(open_, "conv", "left_anti").withColumn("cyclic", F.lit(False))
    return done.unionByName(rest.withColumn("key", F.col("key").cast("long")))


def link_calls(messages: DataFrame, schemas: dict[str, dict], depth: int = DEPTH) -> DataFrame:
    """One row per call of ``messages``; ``schemas`` are the tools' argument schemas by name."""
    plain = messages.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    call = F.from_json("text", "id string, name string, arguments string, after array<string>")
    calls = plain.where("role = 'assistant'").withColumn("call", call).where("call.id is not null")
    calls = calls.select("conv", "conv_id", "turn", "text", F.col("call.id").alias("id"), F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"), F.col("call.after").alias("after"))
    calls = stored(calls.groupBy(*calls.columns).count(), "tool-calls")
    kept = _first(calls, ["conv", "id"])
    calls = calls.join(kept, ["conv", "id"]).withColumn("main", (F.col("first.turn").eqNullSafe(F.col("turn"))) & (F.col("first.text") == F.col("text"))).drop("first")
    result = F.from_json("text", "call_id string, content string")
    results = plain.where("role = 'tool'").withColumn("result", result).where("result.call_id is not null")
    results = _first(results.select("conv", F.col("result.call_id").alias("id"), "turn", F.coalesce("result.content", F.lit("")).alias("text")), ["conv", "id"])
    main = calls.where("main")
    edges = main.select("conv", "id", F.explode("after").alias("needs")).where("needs <> id").distinct()
    edges = edges.join(main.select("conv", F.col("id").alias("needs")), ["conv", "needs"], "left_semi")
    placed = _order(main, edges.select("conv", "id", "needs"), depth)
    linked = calls.join(placed, ["conv", "id"], "left").join(results.select("conv", "id", F.col("first.text").alias("result")), ["conv", "id"], "left")
    linked = linked.withColumn("cyclic", F.coalesce("cyclic", F.lit(False)) & F.col("main"))
    ranked = F.row_number().over(Window.partitionBy("conv", "usable").orderBy("key", "steps", "turn", "id"))
    linked = linked.withColumn("usable", F.col("main") & ~F.col("cyclic"))
    linked = linked.withColumn("rank", F.when(F.col("usable"), ranked))
    status = (
        F.when(~F.col("main"), "repeated").when(F.col("cyclic"), "cyclic").when(F.col("result").isNull(), "unanswered").otherwise("linked")
    )

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["problems"] = [problems_of(a, schemas.get(n)) for a, n in zip(f["arguments"], f["name"])]
            f["line"] = [
                json.dumps({"arguments": canonical(a), "id": i, "name": n, "result": canonical(r)}, sort_keys=True, separators=(",", ":"))
                for a, i, n, r in zip(f["arguments"], f["id"], f["name"], f["result"])
            ]
            yield f[["conv_id", "turn", "id", "name", "rank", "status", "problems", "line"]]

    out = linked.select("conv_id", "turn", "id", "name", "arguments", "result", F.col("rank").cast("long").alias("rank"), status.alias("status"))
    kind = messages.schema["conv_id"].dataType.simpleString()
    # Text columns only, and nullable whole numbers as text, so that pandas keeps nulls apart from 0.
    numbers = ["conv_id", "turn", "rank"]
    done = out.withColumns({c: F.col(c).cast("string") for c in numbers}).mapInPandas(
        finish, "conv_id string, turn string, id string, name string, rank string, status string, problems array<string>, line string"
    )
    return done.withColumns({"conv_id": F.col("conv_id").cast(kind), "turn": F.col("turn").cast("long"), "rank": F.col("rank").cast("long")})
