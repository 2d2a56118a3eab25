"""A summary of a run, gathered while its stages are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabularium.session import stored


def null_cells(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Aggregate: cells without a value."""
    return F.sum(sum((F.col(f"`{c}`").isNull().cast("long") for c in columns or df.columns), F.lit(0).cast("long")))


class RunSummary:
    """One line per stage: rows in and out, rows lost, and named measures of what the stage wrote.

    Each stage is written once; the measures are observed in that same job, so nothing is read
    again for them. The next stage reads what was written. A stage that is repeated after a lost
    executor counts once, as only the job that completes reports.
    """

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.run_id = spark, run_id
        self.lines: list[dict] = []
        self.measures: list[str] = []

    def stage(self, name: str, df: DataFrame, **measures: Column) -> DataFrame:
        """Write the rows of a stage, take its measures, and return the written table."""
        seen = Observation()
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows_out"), *[m.cast("long").alias(k) for k, m in measures.items()])
        out = stored(watched, f"run-{name}")
        self.measures += [k for k in measures if k not in self.measures]
        self.lines.append({"stage": name, **seen.get})
        return out

    def table(self) -> DataFrame:
        """(run_id, position, stage, rows_in, rows_out, rows_dropped, measures...); what a stage did not measure is null."""
        rows, before = [], None
        for position, line in enumerate(self.lines, 1):
            rows_in = line["rows_out"] if before is None else before
            measured = [None if line.get(k) is None else int(line[k]) for k in self.measures]
            rows.append((self.run_id, position, line["stage"], rows_in, line["rows_out"], rows_in - line["rows_out"], *measured))
            before = line["rows_out"]
        kinds = "run_id string, position int, stage string, rows_in long, rows_out long, rows_dropped long"
        return self.spark.createDataFrame(rows, ", ".join([kinds, *[f"`{k}` long" for k in self.measures]]))
