"""Run, quality, anomaly and model history: pages, newest rows, drift tops and lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEVERITIES = ["HIGH", "MEDIUM", "LOW"]


def page(df: DataFrame, order: list, number: int, per_page: int) -> DataFrame:
    """One page of an ordered table. Page < 1 → 1; size outside 1..500 → 50."""
    number = max(number, 1)
    per_page = per_page if 1 <= per_page <= 500 else 50
    return df.orderBy(*order).offset((number - 1) * per_page).limit(per_page)


def anomaly_page(
    df: DataFrame, severity: str | None, order: list, number: int = 1, per_page: int = 50
) -> DataFrame:
    """A page of the anomaly log; an unknown severity means no filter."""
    if severity and severity.upper() in SEVERITIES:
        df = df.where(F.col("severity") == severity.upper())
    return page(df, order, number, per_page)


def paged_table(df: DataFrame, order: list, number: int, per_page: int) -> DataFrame:
    """A page with the total row and page counts on every row."""
    total = df.agg(F.count("*")).scalar()
    return page(df, order, number, per_page).withColumns(
        {
            "total": total,
            "pages": F.floor((total + per_page - 1) / per_page),
        }
    )


def latest_n(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def run_history(runs: DataFrame) -> DataFrame:
    """Runs with their duration and the change against the previous run of the same owner.

    The previous run is looked up by owner and month: within the month by a window, for the
    first run of a month from the last run of the owner's month before. So an owner with very
    many runs is not sorted by one task.
    """
    took = F.floor((F.unix_micros("completed_at") - F.unix_micros("started_at")) / 1000)
    timed = runs.withColumn("duration_ms", F.coalesce(took, F.lit(0).cast("bigint"))).withColumn(
        "_month", F.date_trunc("month", "started_at")
    )
    months = timed.groupBy("owner", "_month").agg(
        F.max_by("duration_ms", F.struct("started_at", "run_id")).alias("_last")
    )
    by_month = Window.partitionBy("owner").orderBy("_month")
    before = months.select("owner", "_month", F.lag("_last").over(by_month).alias("_before"))
    inside = Window.partitionBy("owner", "_month").orderBy("started_at", "run_id")
    previous = F.coalesce(F.lag("duration_ms").over(inside), F.col("_before"))
    return (
        timed.join(before, ["owner", "_month"])
        .withColumn("delta_ms", F.col("duration_ms") - previous)
        .drop("_month", "_before")
    )


def latest_metrics(runs: DataFrame, models: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Newest successful run with its champion metrics and its anomaly count."""
    newest = (
        runs.where(F.col("status") == "SUCCESS")
        .agg(F.max_by(F.struct("run_id", "rows_out"), F.struct("started_at", "run_id")).alias("r"))
        .select("r.*")
        .where(F.col("run_id").isNotNull())
    )
    best = models.where(F.col("is_best")).select("run_id", "test_rmse", "test_r2")
    counts = anomalies.groupBy("run_id").agg(F.count("*").alias("anomalies_count"))
    return (
        newest.join(best, "run_id", "left")
        .join(counts, "run_id", "left")
        .select(
            "run_id",
            F.col("rows_out").alias("rows_processed"),
            F.coalesce("anomalies_count", F.lit(0).cast("bigint")).alias("anomalies_count"),
            F.coalesce("test_rmse", F.lit(0.0)).alias("best_rmse"),
            F.coalesce("test_r2", F.lit(0.0)).alias("best_r2"),
        )
    )


def drift_top(history: DataFrame, top: int = 5) -> DataFrame:
    """History rows of the columns with the highest null rate of any run."""
    worst = (
        history.groupBy("column")
        .agg(F.max("null_rate").alias("m"))
        .orderBy(F.desc("m"), "column")
        .limit(top)
        .select("column")
    )
    return history.join(worst, "column", "left_semi")


def null_heatmap(history: DataFrame, run: str, top: int = 30) -> DataFrame:
    """Columns of the newest run with nulls, highest rate first; all columns if none has any."""
    newest = history.agg(F.max(run)).scalar()
    latest = history.where(F.col(run) == newest)
    any_null = latest.agg(F.coalesce(F.max(F.col("null_rate") > 0), F.lit(False))).scalar()
    return (
        latest.where((F.col("null_rate") > 0) | ~any_null)
        .orderBy(F.desc("null_rate"), "column")
        .limit(top)
    )


def schema_history(history: DataFrame) -> DataFrame:
    return history.withColumn("null_rate", F.coalesce("null_rate", F.lit(0.0)))


def record(log: DataFrame, key: str, value: object) -> DataFrame:
    """The stored record of one id; the filter reaches the scan, so a sorted log reads little."""
    return log.where(F.col(key) == value)


def json_details(raw: Column, schema: str) -> Column:
    """Parse nested details; malformed text gives an empty map."""
    parsed = F.from_json(raw, schema)
    empty = F.create_map().cast(schema)
    return F.coalesce(parsed, empty)


def quality_record(
    df: DataFrame, imputed: Column, artifact: Column, run_id: str, steps: Sequence[str]
) -> DataFrame:
    """Add the quality flags and lineage of each row as structs."""
    return df.withColumns(
        {
            "quality_flags": F.struct(
                imputed.alias("missing_imputed"),
                F.col("anomaly_flagged"),
                F.col("anomaly_severity"),
                artifact.alias("artifact_flag"),
            ),
            "lineage": F.struct(
                F.lit(run_id).alias("pipeline_run_id"),
                F.array(*[F.lit(s) for s in steps]).alias("transformation_steps"),
            ),
        }
    )
