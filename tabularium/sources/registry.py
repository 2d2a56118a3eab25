"""Data identity, run registry and table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabularium.session import stored


def row_digest(df: DataFrame, algorithm: str = "sha256") -> DataFrame:
    """``df`` plus ``row_hash``, a digest of all columns rendered as text ('~' for null)."""
    line = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in df.columns])
    digest = F.md5(line) if algorithm == "md5" else F.sha2(line, 256)
    return df.withColumn("row_hash", digest)


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive fingerprint of a table: row count and combined row digests.

    Only fixed-size numbers are combined, so a table of any size shuffles one row per task.
    """
    hashed = row_digest(df)
    head = F.conv(F.substring("row_hash", 1, 12), 16, 10).cast("bigint")
    tail = F.conv(F.substring("row_hash", 13, 12), 16, 10).cast("bigint")
    return hashed.agg(
        F.count("*").alias("row_count"),
        F.bit_xor(head).alias("xor_head"),
        F.bit_xor(tail).alias("xor_tail"),
        F.min("row_hash").alias("min_hash"),
        F.max("row_hash").alias("max_hash"),
    )


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of the raw bytes of each file below ``path``; a file is read by one task, up to 2 GB."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select("path", "length", F.sha2("content", 256).alias("dataset_hash"))
    )


def file_tree_digests(spark: SparkSession, path: str, leaf_lines: int = 4096) -> DataFrame:
    """(path, length, lines, dataset_hash) of each text file below ``path``, by a tree of digests.

    A leaf is the SHA-256 of ``leaf_lines`` line digests, the root that of the file's length and its
    leaves. Files are read in splits, lines are numbered across them from the splits' line counts,
    and leaves are hashed by different tasks, so one huge file is not one task; the digest depends on
    the bytes alone and not on how they were split. Scans leave out empty files.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path).select(
        meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), F.sha2("value", 256).alias("h"),
        F.monotonically_increasing_id().alias("id"),
    )
    lines = stored(lines, "line-digests")
    blocks = lines.groupBy("path", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    numbered = lines.join(blocks, ["path", "block"]).withColumn("line", F.col("id") - F.col("first") + F.col("before"))
    in_order = lambda n, h: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(n, h))), lambda s: s[h]), "")
    leaves = numbered.groupBy("path", F.floor(F.col("line") / leaf_lines).alias("leaf")).agg(
        F.sha2(in_order("line", "h"), 256).alias("h"), F.count("*").alias("lines")
    )
    tree = leaves.groupBy("path").agg(in_order("leaf", "h").alias("leaves"), F.sum("lines").alias("lines"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")  # contents are not read
    known = files.join(tree, "path", "left").na.fill({"leaves": "", "lines": 0})
    root = F.sha2(F.concat(F.col("length").cast("string"), F.lit(":"), F.col("leaves")), 256)
    return known.select("path", "length", "lines", root.alias("dataset_hash"))


def processed_flag(incoming: DataFrame, runs: DataFrame, force: bool = False) -> DataFrame:
    """Mark data sets whose hash already has a successful run."""
    if force:
        return incoming.withColumn("is_rerun", F.lit(False))
    done = runs.where(F.col("status") == "SUCCESS").select("dataset_hash").distinct()
    done = done.withColumn("is_rerun", F.lit(True))
    return incoming.join(done, "dataset_hash", "left").withColumn(
        "is_rerun", F.coalesce("is_rerun", F.lit(False))
    )


def skip_processed(incoming: DataFrame, runs: DataFrame) -> DataFrame:
    """Only the data sets without a successful run."""
    done = runs.where(F.col("status") == "SUCCESS").select("dataset_hash")
    return incoming.join(done, "dataset_hash", "left_anti")


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Newest non-null value of every column per key.

    A null in a newer row keeps the earlier value. Written as one aggregation with a map-side
    combine (no window), so a key updated millions of times costs one row per task.
    """
    both = base.unionByName(updates)
    rest = [c for c in both.columns if c not in keys and c != order]
    return both.groupBy(*keys).agg(
        F.max(order).alias(order),
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(order, c))).alias(c)
            for c in rest
        ],
    ).select(*base.columns)


def append_history(df: DataFrame, path: str, run_id: str | Column) -> None:
    """Append rows to a run-partitioned history table, all runs of ``run_id`` in one job.

    A run that is appended again replaces itself; the partitions of other runs are not touched.
    """
    (
        df.withColumn("run_id", run_id if isinstance(run_id, Column) else F.lit(run_id))
        .hint("rebalance", "run_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def save_table(df: DataFrame, path: str) -> DataFrame:
    """Full-refresh write, returned as a scan of the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_complete_run(runs: DataFrame, artifacts: Sequence[str]) -> DataFrame:
    """The newest run (by id) that has every artifact."""
    ready = runs
    for a in artifacts:
        ready = ready.where(F.col(a))
    return ready.agg(F.max_by(F.struct(*runs.columns), "run_id").alias("r")).select("r.*")


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``: one aggregation with a map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(*keys, "_last.*")
        .select(*df.columns)
    )


def top_per(df: DataFrame, keys: Sequence[str], order: list, n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key; Catalyst trims every partition to ``n`` before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
