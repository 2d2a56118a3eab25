"""Windowed counts, rates, histogram quantiles, gauges and progress of an event stream.

The functions take a batch or a streaming frame: a stream gets a watermark, which bounds the
state, and the same aggregation. ``drain`` runs a stream over everything available and returns
the newest value of every key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.session import new_path
from tabularium.vocabulary import STAGES

LATENESS = "1 day"
TERMINAL = ["SUCCESS", "FAILED"]


def marked(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Watermark on ``ts`` when the frame is a stream."""
    return events.withWatermark("ts", lateness) if events.isStreaming else events


def _start(window: str = "window") -> Column:
    return F.col(f"{window}.start")


def window_counts(events: DataFrame, labels: Sequence[str], size: str = "24 hours") -> DataFrame:
    """Events per label in tumbling windows."""
    return (
        marked(events)
        .groupBy(F.window("ts", size), *labels)
        .agg(F.count("*").alias("n"))
        .select(_start().alias("window_start"), *labels, "n")
    )


def sliding_rate(
    events: DataFrame, labels: Sequence[str], size_s: int = 300, slide_s: int = 60
) -> DataFrame:
    """Events per second over sliding windows."""
    return (
        marked(events)
        .groupBy(F.window("ts", f"{size_s} seconds", f"{slide_s} seconds"), *labels)
        .agg((F.count("*") / float(size_s)).alias("per_second"))
        .select(_start().alias("window_start"), *labels, "per_second")
    )


def bucket_counts(value: str, bounds: Sequence[float]) -> Column:
    """Cumulative histogram: rows at or below each bound, then all rows."""
    return F.array(
        *[F.count_if(F.col(value) <= float(b)) for b in bounds], F.count(value)
    )


def bucket_quantile(buckets: Column, bounds: Sequence[float], q: float) -> Column:
    """Quantile of a cumulative histogram by linear interpolation inside the bucket.

    The first bucket starts at 0; a rank beyond the last bound gives the last bound.
    """
    total = F.element_at(buckets, -1)
    rank = F.lit(q) * total
    out = F.lit(float(bounds[-1]))
    for i in range(len(bounds) - 1, -1, -1):
        lo = float(bounds[i - 1]) if i else 0.0
        below = buckets[i - 1] if i else F.lit(0)
        inside = buckets[i] - below
        at = F.lit(lo) + F.lit(float(bounds[i]) - lo) * F.try_divide(rank - below, inside)
        out = F.when(buckets[i] >= rank, at).otherwise(out)
    return F.when(total > 0, out)


def histogram_quantiles(
    events: DataFrame,
    labels: Sequence[str],
    value: str,
    bounds: Sequence[float],
    quantiles: Sequence[float] = (0.5, 0.95),
    size: str = "24 hours",
) -> DataFrame:
    """Bucket-based quantiles per window and label, as columns p50, p95, …"""
    counted = (
        marked(events)
        .groupBy(F.window("ts", size), *labels)
        .agg(bucket_counts(value, bounds).alias("buckets"))
    )
    return counted.select(
        _start().alias("window_start"),
        *labels,
        *[
            bucket_quantile(F.col("buckets"), bounds, q).alias(f"p{round(q * 100)}")
            for q in quantiles
        ],
    )


def failure_ratio(events: DataFrame, labels: Sequence[str], size: str = "24 hours") -> DataFrame:
    """Successes, failures and their failure share per window and label."""
    ok, bad = F.col("status") == "SUCCESS", F.col("status") == "FAILED"
    return (
        marked(events)
        .groupBy(F.window("ts", size), *labels)
        .agg(F.count_if(ok).alias("successes"), F.count_if(bad).alias("failures"))
        .select(
            _start().alias("window_start"),
            *labels,
            "successes",
            "failures",
            F.coalesce(
                F.try_divide(F.col("failures"), F.col("successes") + F.col("failures")), F.lit(0.0)
            ).alias("failure_ratio"),
        )
    )


def gauges(events: DataFrame, labels: Sequence[str], value: str) -> DataFrame:
    """Counter and last value per label combination."""
    return events.groupBy(*labels).agg(
        F.count("*").alias("total"),
        F.max_by(value, F.struct("ts", "event_id")).alias("last_value"),
    )


def latest_status(events: DataFrame) -> DataFrame:
    """Last status of every stage of every run."""
    return events.groupBy("run_id", "stage").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("status")
    )


def progress(statuses: DataFrame) -> DataFrame:
    """Share of the stages that have ended, per run, in percent."""
    ended = F.count_if(F.col("status").isin(*TERMINAL) & F.col("stage").isin(*STAGES))
    return statuses.groupBy("run_id").agg((ended * 100.0 / len(STAGES)).alias("progress_pct"))


def drain(stream: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Run a keyed streaming aggregation over everything available; newest value per key.

    Each micro-batch overwrites its own partition of the output, so a replayed batch leaves no
    duplicates, and the result keeps the row of the latest batch for every key.
    """
    spark = stream.sparkSession
    out, state = new_path(spark, label), new_path(spark, f"{label}-state")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
        .awaitTermination()
    )
    rest = [c for c in stream.columns if c not in keys]
    written = spark.read.option("basePath", out).parquet(out)
    return (
        written.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("_v"))
        .select(*keys, "_v.*")
        .select(*stream.columns)
    )


def append_all(stream: DataFrame, label: str) -> DataFrame:
    """Run an append-only stream over everything available; all rows it wrote."""
    spark = stream.sparkSession
    out, state = new_path(spark, label), new_path(spark, f"{label}-state")
    (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(out)
