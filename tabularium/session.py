"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "tabularium", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a machine-local
    path would lose data with its executor, so the setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tabularium-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tabularium/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table.

    Used for fitted parameters and for intermediates read more than once. The scan carries
    real file sizes, so Catalyst broadcasts it in a join only when it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise; it also cuts the
    lineage without tying the data to an executor.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows of a table with fewer files than the session has cores, dealt out by columns ``by``.

    For work that is heavy per row: a table of one small file is otherwise read, and so
    processed, by a single task. Tables of many files keep their scan partitions unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if len(df.inputFiles()) < cores else df


def literal_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A short fixed table as literals in the plan, so its size is known without a job."""
    lines = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*lines)))
