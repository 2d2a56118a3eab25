"""Streams over several files equal their batch twins, and state stays bounded."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.sources import merge
from tabularium.sources.readers import event_stream
from tabularium.sources.registry import upsert
from tabularium.streaming import monitor, stateful
from workloads.streaming import SCHEMA, as_run_events

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Four files written in event order."""
    path = tmp_path_factory.mktemp("events")
    kinds = ["view", "error", "purchase", "click"]
    for part in range(4):
        rows = [
            (i, START + dt.timedelta(minutes=17 * i), i % 5, kinds[(i * 7) % 4], float(i % 40), "{}")
            for i in range(part * 150, part * 150 + 150)
        ]
        one = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        one.write.mode("append").parquet(str(path))
    return str(path)


def stream(spark, folder):
    raw = (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    return as_run_events(raw)


def batch(spark, folder):
    return as_run_events(spark.read.parquet(folder))


def same(a, b):
    assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))


def test_source(spark, folder):
    s = event_stream(spark, folder, "*.parquet", SCHEMA)
    assert s.isStreaming and isinstance(s.schema["ts"].dataType, T.TimestampType)


def test_windows(spark, folder):
    keys = ["window_start", "event_type"]
    same(
        monitor.drain(monitor.window_counts(stream(spark, folder), ["event_type"]), keys, "w"),
        monitor.window_counts(batch(spark, folder), ["event_type"]),
    )


def test_sliding_rate(spark, folder):
    same(
        monitor.drain(monitor.sliding_rate(stream(spark, folder), []), ["window_start"], "r"),
        monitor.sliding_rate(batch(spark, folder), []),
    )


def test_progress(spark, folder):
    latest = monitor.drain(monitor.latest_status(stream(spark, folder)), ["run_id", "stage"], "s")
    same(monitor.progress(latest), monitor.progress(monitor.latest_status(batch(spark, folder))))


def test_completion_is_found_once(spark, folder):
    out = stateful.completions(stream(spark, folder))
    same(out, stateful.batch_completions(batch(spark, folder)))
    assert out.count() == out.select("run_id").distinct().count()


def test_history_is_bounded(spark, folder):
    out = stateful.histories(stream(spark, folder), 7)
    want = stateful.batch_histories(batch(spark, folder), 7, 50).select("run_id", "event_id")
    same(out.select("run_id", "event_id"), want)


def test_late_events_are_dropped_by_watermark(spark, tmp_path):
    first = [(1, START + dt.timedelta(days=9), 1, "error", 1.0, "{}")]
    tail = [(2, START + dt.timedelta(days=10), 1, "error", 1.0, "{}")]
    late = [(3, START, 1, "error", 1.0, "{}")]
    for rows in (first, tail, late):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path))
    counts = monitor.window_counts(stream(spark, str(tmp_path)), ["status"])
    out = monitor.drain(counts, ["window_start", "status"], "late")
    assert out.agg(F.sum("n")).first()[0] == 2


@pytest.mark.parametrize(
    "buckets,q,want", [([2, 4, 4], 0.5, 1.0), ([2, 4, 8], 0.5, 3.0), ([0, 2, 8], 0.95, 3.0), ([4, 4, 4], 0.25, 0.25)]
)
def test_bucket_quantile(spark, buckets, q, want):
    col = monitor.bucket_quantile(F.array(*[F.lit(b) for b in buckets]), [1, 3], q)
    assert spark.range(1).select(col).first()[0] == pytest.approx(want)


def one_by_one(spark, tmp_path, parts, take):
    """Write each part as a file and run ``take`` over the stream after each of them."""
    out = None
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path))
        out = take()
    return out


def run_events():
    """Three runs: one ends and goes on, one falls silent and comes back, one is left open."""
    at = lambda h: START + dt.timedelta(hours=h)
    rows = [(7, 0.0, 1, "purchase"), (8, 1.0, 1, "view"), (15, 2.5, 1, "error"), (9, 0.5, 2, "view"), (10, 3.0, 2, "view"),
            (23, 30.0, 2, "error"), (12, 31.0, 3, "view"), (13, 31.5, 1, "view"), (14, 34.0, 1, "view")]
    return [(e, at(h), run, kind, 1.0, "{}") for e, h, run, kind in sorted(rows, key=lambda r: r[1])]


def test_runs_end_by_their_last_stage_or_by_silence(spark, tmp_path):
    rows, silence, lateness = run_events(), 6 * 3600, 3600
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "one"))
    want = stateful.batch_endings(batch(spark, str(tmp_path / "one")), silence, lateness)
    got = monitor.append_all(stateful.endings(stream(spark, str(tmp_path / "one")), silence, lateness), "ends")
    same(got, want)
    found = {(r.run_id, r.status, r.event_id, r.n_events) for r in want.collect()}
    assert found == {(1, "SUCCESS", 7, 1), (2, "TIMEOUT", 10, 2), (2, "FAILED", 23, 1)}


def test_endings_do_not_depend_on_batches_and_survive_a_restart(spark, tmp_path):
    rows, silence, lateness = run_events(), 6 * 3600, 3600
    swapped = [rows[0], rows[2], rows[1], *rows[3:]]  # out of order, but not late
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def take():
        ended = stateful.endings(stream(spark, str(tmp_path / "in")), silence, lateness)
        query = ended.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        query.trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(ended.schema).parquet(out)

    got = one_by_one(spark, tmp_path / "in", [swapped[k : k + 2] for k in range(0, len(rows), 2)], take)
    same(got, stateful.batch_endings(batch(spark, str(tmp_path / "in")), silence, lateness))
    counts = [json.loads(q)["numRowsTotal"] for q in state_rows(spark, state)]
    assert counts[-1] <= 3  # one entry per open run at most


def state_rows(spark, state):
    """State entries after the last batch, read back with the state data source."""
    left = spark.read.format("statestore").load(state).count()
    return [json.dumps({"numRowsTotal": left})]


def upserted(spark, root, checkpoint, folder):
    raw = stream(spark, folder).select("run_id", "event_id", "status")
    return merge.merge_stream(raw, ["run_id"], lambda b, r: upsert(b, r, ["run_id"], "event_id"), root, checkpoint, 8)


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).glob("data/*/*/*.parquet")}


def test_merged_table_goes_on_where_it_stopped(spark, tmp_path):
    root, state, source = str(tmp_path / "table"), str(tmp_path / "state"), tmp_path / "in"
    first = [(k, START + dt.timedelta(minutes=k), k % 5, "view", 1.0, "{}") for k in range(20)]
    second = [(k, START + dt.timedelta(minutes=k), 3, "error", 1.0, "{}") for k in range(20, 24)]
    one_by_one(spark, source, [first], lambda: upserted(spark, root, state, str(source)))
    before = files(root)
    got = one_by_one(spark, source, [second], lambda: upserted(spark, root, state, str(source)))
    assert {(r.run_id, r.event_id, r.status) for r in got.collect()} == {
        *((k, 15 + k, "PROGRESS") for k in (0, 1, 2, 4)), (3, 23, "FAILED")}
    after = files(root)
    assert before.items() <= after.items()  # nothing that was written is touched
    new = {f for f in after if f not in before}
    assert len({f.split("/")[2] for f in new}) == 1  # run 3 lies in one bucket
    merge.vacuum(spark, root, keep=1)
    assert merge.commits(spark, root) == [1]
    assert {(r.run_id, r.event_id) for r in merge.read_merged(spark, root, got.schema).collect()} == {
        (0, 15), (1, 16), (2, 17), (4, 19), (3, 23)}


def test_a_replayed_batch_changes_nothing_and_a_stopped_one_is_written_anew(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([(k, k, "a") for k in range(30)], "run_id long, event_id long, status string")
    later = spark.createDataFrame([(1, 99, None), (2, 98, "b")], rows.schema)
    calls = []

    def latest(base, fresh):
        calls.append(1)
        return upsert(base, fresh, ["run_id"], "event_id")

    merge.merge_batch(rows, root, ["run_id"], latest, 0, 8)
    merge.merge_batch(later, root, ["run_id"], latest, 1, 8)
    want, seen = merge.read_merged(spark, root, rows.schema).collect(), files(root)
    merge.merge_batch(later, root, ["run_id"], latest, 1, 8)
    assert len(calls) == 2 and files(root) == seen
    Path(root, "commits/batch=1/_SUCCESS").unlink()  # as if the second had stopped before its commit
    assert {r.event_id for r in merge.read_merged(spark, root, rows.schema).collect()} == set(range(30))
    merge.merge_batch(later, root, ["run_id"], latest, 1, 8)
    got = merge.read_merged(spark, root, rows.schema).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and (1, 99, "a") in map(tuple, got)
