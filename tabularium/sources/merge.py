"""A keyed table that batches are merged into, bucket by bucket.

Rows are dealt to buckets by a hash of their keys. A batch rewrites only the buckets that its rows
fall into, under its own number; a commit then says which batch holds the current content of each
bucket. Readers follow the last commit, so a batch shows whole or not at all, untouched buckets keep
their files, and a batch that is replayed after its commit changes nothing. A batch that stopped
before its commit is written anew. What a commit lists is one small row per bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabularium.session import stored

BUCKETS = 64
Merge = Callable[[DataFrame, DataFrame], DataFrame]


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = file_system(spark, path)
    return fs.exists(place)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, place = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def commits(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed batches, ascending."""
    names = [n for n in _children(spark, f"{root}/commits") if exists(spark, f"{root}/commits/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix("batch=")) for n in names)


def current(spark: SparkSession, root: str, upto: int | None = None) -> dict[int, int]:
    """The batch that holds each bucket, as of the last commit (up to batch ``upto``)."""
    known = [c for c in commits(spark, root) if upto is None or c <= upto]
    if not known:
        return {}
    rows = spark.read.schema("bucket int, held long").parquet(f"{root}/commits/batch={known[-1]}").collect()
    return {r.bucket: r.held for r in rows}  # at most as many as buckets


def _read(spark: SparkSession, root: str, schema: StructType, held: dict[int, int]) -> DataFrame:
    paths = [f"{root}/data/batch={b}/bucket={k}" for k, b in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_merged(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The table as of its last commit."""
    return _read(spark, root, schema, current(spark, root))


def merge_batch(rows: DataFrame, root: str, keys: Sequence[str], merge: Merge, batch: int, buckets: int = BUCKETS) -> None:
    """Merge one batch of rows into the table below ``root``; a committed batch is left alone.

    ``merge(base, rows)`` sees the touched buckets only and returns their new content, with the
    columns of ``rows``. Batches come in ascending order; ``buckets`` stays the same for a table.
    """
    spark = rows.sparkSession
    if batch in commits(spark, root):
        return
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    fresh = stored(rows, "merge-batch")  # read for the buckets it touches and for the merge
    touched = [r.b for r in fresh.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets`` numbers
    held = current(spark, root, batch - 1)
    base = _read(spark, root, rows.schema, {k: b for k, b in held.items() if k in set(touched)})
    merged = merge(base, fresh).select(*rows.columns).withColumn("bucket", bucket)
    place = f"{root}/data/batch={batch}"
    merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(place)
    written = {int(n.removeprefix("bucket=")) for n in _children(spark, place) if n.startswith("bucket=")}
    held = {k: b for k, b in held.items() if k not in touched} | {k: batch for k in written}
    line = spark.createDataFrame(sorted(held.items()), "bucket int, held long")
    line.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/batch={batch}")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete buckets that none of the last ``keep`` commits refers to, and older commits."""
    known = commits(spark, root)
    used = {(b, k) for c in known[-keep:] for k, b in current(spark, root, c).items()}
    gone = []
    for name in _children(spark, f"{root}/data"):
        batch = int(name.removeprefix("batch="))
        if not known or batch > known[-1]:
            continue  # still being written
        for child in _children(spark, f"{root}/data/{name}"):
            if child.startswith("bucket=") and (batch, int(child.removeprefix("bucket="))) not in used:
                gone.append(f"{root}/data/{name}/{child}")
    gone += [f"{root}/commits/batch={c}" for c in known[:-keep]]
    for path in gone:
        fs, place = file_system(spark, path)
        fs.delete(place, True)
    return gone


def merge_stream(stream: DataFrame, keys: Sequence[str], merge: Merge, root: str, checkpoint: str, buckets: int = BUCKETS) -> DataFrame:
    """Merge everything available of a stream, micro-batch by micro-batch, and return the table.

    With the same ``root`` and ``checkpoint`` a later call goes on where an earlier one stopped.
    """

    def step(rows: DataFrame, batch: int) -> None:
        merge_batch(rows, root, keys, merge, batch, buckets)

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start().awaitTermination()
    return read_merged(stream.sparkSession, root, stream.schema)
