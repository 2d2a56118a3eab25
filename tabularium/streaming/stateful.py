"""Per-run state: how runs end, and a bounded history of their events."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tabularium.session import new_path
from tabularium.sources.merge import merge_stream
from tabularium.sources.registry import top_per
from tabularium.vocabulary import EVENTS_PER_RUN, FINAL_STAGE

ENDING = "run_id bigint, started_us bigint, ended_us bigint, status string, event_id bigint, n_events bigint"
SILENCE_S = 24 * 3600
LATENESS_S = 3600


def _final() -> Column:
    ended = (F.col("stage") == FINAL_STAGE) & F.col("status").isin("SUCCESS", "FAILED")
    return F.when(ended, F.col("status"))


def endings(events: DataFrame, silence_s: int = SILENCE_S, lateness_s: int = LATENESS_S) -> DataFrame:
    """One row per run that ended: by the first success or failure of its final stage, or by silence.

    A run whose events stop for ``silence_s`` has timed out at the end of that time; a later event
    of the same id is a new run. Events are judged in the order of their time, once the watermark
    (``lateness_s`` behind the newest event) has passed them, so the result does not depend on how
    they are cut into micro-batches. State is a few numbers a run and the events not yet passed by the
    watermark; timers in event time remove it when the run falls silent, whether it had ended or not.
    """
    silence = silence_s * 1_000_000

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs() * 1000
        held = json.loads(state.get[0]) if state.exists else {"run": None, "waiting": []}
        run, waiting, out = held["run"], held["waiting"], []
        for pdf in batches:
            waiting += [[int(t), int(e), s] for t, e, s in zip(pdf["us"], pdf["event_id"], pdf["final"])]
        waiting.sort(key=lambda w: (w[0], w[1]))
        while True:
            fresh = waiting[0] if waiting and waiting[0][0] < passed else None
            until = run["last"] + silence if run else None
            if run and (fresh[0] > until if fresh else until < passed):
                if not run["done"]:
                    out.append([key[0], run["start"], until, "TIMEOUT", run["event"], run["n"]])
                run = None
            if not fresh:
                break
            waiting.pop(0)
            run = run or {"start": fresh[0], "n": 0, "done": False}
            run |= {"last": fresh[0], "event": fresh[1], "n": run["n"] + 1}
            if fresh[2] and not run["done"]:
                out.append([key[0], run["start"], fresh[0], fresh[2], fresh[1], run["n"]])
                run["done"] = True
        timers = [w[0] for w in waiting[:1]] + ([run["last"] + silence] if run else [])
        if timers:
            state.update((json.dumps({"run": run, "waiting": waiting}),))
            state.setTimeoutTimestamp(min(timers) // 1000)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ENDING.split(", ")])

    rows = events.select("run_id", "ts", F.unix_micros("ts").alias("us"), "event_id", _final().alias("final"))
    ended = (
        rows.withWatermark("ts", f"{lateness_s} seconds")
        .groupBy("run_id")
        .applyInPandasWithState(follow, ENDING, "held string", "append", GroupStateTimeout.EventTimeTimeout)
    )
    return _with_times(ended)


def batch_endings(events: DataFrame, silence_s: int = SILENCE_S, lateness_s: int = LATENESS_S) -> DataFrame:
    """The batch twin of ``endings``: what a stream over the same events has found at its end."""
    silence = silence_s * 1_000_000
    rows = events.select("run_id", F.unix_micros("ts").alias("us"), "event_id", _final().alias("final"))
    newest = rows.agg(F.max("us").alias("us")).scalar()
    passed = F.floor(newest / 1000) * 1000 - lateness_s * 1_000_000
    order = Window.partitionBy("run_id").orderBy("us", "event_id")
    rows = rows.where(F.col("us") < passed)
    broken = F.coalesce((F.col("us") - F.lag("us").over(order) > silence).cast("int"), F.lit(0))
    rows = rows.withColumn("broken", broken).withColumn("part", F.sum("broken").over(order))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("run_id", "part").orderBy("us", "event_id")))
    seen = F.struct("us", "event_id", F.col("n").cast("bigint").alias("n"), "final")
    runs = rows.groupBy("run_id", "part").agg(
        F.min("us").alias("started_us"), F.max(seen).alias("last"), F.min(F.when(F.col("final").isNotNull(), seen)).alias("end")
    )
    until = F.col("last.us") + silence
    kept = runs.where(F.col("end").isNotNull() | (until < passed))
    pick = lambda field: F.when(F.col("end").isNotNull(), F.col(f"end.{field}")).otherwise(F.col(f"last.{field}"))
    return _with_times(kept.select(
        "run_id", "started_us", F.when(F.col("end").isNotNull(), F.col("end.us")).otherwise(until).alias("ended_us"),
        F.coalesce("end.final", F.lit("TIMEOUT")).alias("status"), pick("event_id").alias("event_id"), pick("n").alias("n_events"),
    ))


def _with_times(ended: DataFrame) -> DataFrame:
    times = [F.timestamp_micros(f"{c}_us").alias(f"{c}_at") for c in ("started", "ended")]
    return ended.select("run_id", *times, "status", "event_id", "n_events")


def histories(events: DataFrame, keep: int = EVENTS_PER_RUN, root: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """The last ``keep`` events of every run of a stream, as (run_id, ts, event_id) rows.

    Each micro-batch is merged into the buckets of its runs and trimmed. Partitions trim to ``keep``
    rows per run before the shuffle, so a run with most of the events is no hot spot.
    """
    rows = events.select("run_id", "ts", "event_id")

    def trim(kept: DataFrame, fresh: DataFrame) -> DataFrame:
        order = [F.desc("ts"), F.desc("event_id")]
        return top_per(kept.unionByName(fresh), ["run_id"], order, keep, "_back").drop("_back")

    root = root or new_path(events.sparkSession, "histories")
    return merge_stream(rows, ["run_id"], trim, root, checkpoint or f"{root}-checkpoint")


def completions(events: DataFrame, root: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """When each run of a stream first ended, however long ago: (run_id, status, completed_at, event_id).

    The answer of a run never expires, so it is kept in a table by run and not in streaming state.
    """
    rows = events.where(_final().isNotNull()).select("run_id", "status", F.col("ts").alias("completed_at"), "event_id")

    def first(kept: DataFrame, fresh: DataFrame) -> DataFrame:
        least = kept.unionByName(fresh).groupBy("run_id").agg(F.min(F.struct("completed_at", "event_id", "status")).alias("m"))
        return least.select("run_id", "m.*")

    root = root or new_path(events.sparkSession, "completions")
    return merge_stream(rows, ["run_id"], first, root, checkpoint or f"{root}-checkpoint")


def batch_completions(events: DataFrame) -> DataFrame:
    """The first success or failure of the final stage of every run."""
    return (
        events.where(_final().isNotNull())
        .groupBy("run_id")
        .agg(F.min(F.struct("ts", "event_id", "status")).alias("m"))
        .select("run_id", "m.status", F.col("m.ts").alias("completed_at"), "m.event_id")
    )


def batch_histories(events: DataFrame, keep: int, runs: int) -> DataFrame:
    """Last events of the newest runs, newest by first event."""
    first = events.groupBy("run_id").agg(F.min(F.struct("ts", "event_id")).alias("first"))
    kept = first.orderBy(F.desc("first")).limit(runs).select("run_id")
    last = top_per(events, ["run_id"], [F.desc("ts"), F.desc("event_id")], keep, "_back")
    return last.drop("_back").join(kept, "run_id", "left_semi")
