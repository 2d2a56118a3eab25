"""Exact nearest neighbours of a batch of query vectors in a corpus of any size."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.sources.registry import top_per

BROADCAST_QUERIES = 4096
SHARD_ROWS = 100_000


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    corpus_id: str = "doc_id",
    query_id: str = "query_id",
    vector: str = "embedding",
    metric: str = "cosine",
) -> DataFrame:
    """The ``k`` best corpus rows per query: query id, corpus id, score, rank (from 1).

    Every task keeps only its own best ``k`` per query, so the shuffle carries k rows per query
    and task and never the pairs. A query batch up to ``BROADCAST_QUERIES`` is shipped to the
    tasks; a larger one meets the corpus in a grid of bounded blocks. ``metric`` is "cosine"
    or "euclidean" (score = minus the distance). Ties go to the smaller id.
    """
    docs = corpus.select(
        F.col(corpus_id).cast("bigint").alias("d"), F.col(vector).cast("array<double>").alias("v")
    ).where(F.col("v").isNotNull())
    asks = queries.select(
        F.col(query_id).cast("bigint").alias("q"), F.col(vector).cast("array<double>").alias("v")
    ).where(F.col("v").isNotNull())
    head = asks.limit(BROADCAST_QUERIES + 1).toPandas()
    if len(head) <= BROADCAST_QUERIES:
        best = _shipped(docs, head, k, metric)
    else:
        best = _grid(docs, asks, k, metric)
    ranked = top_per(best, ["q"], [F.desc("score"), "d"], k)
    return ranked.select(
        F.col("q").alias(query_id), F.col("d").alias(corpus_id), "score", "rank"
    )


def _scores(qv: np.ndarray, dv: np.ndarray, metric: str) -> np.ndarray:
    """queries × docs score matrix, at 9 digits so that copies of a vector tie."""
    if metric == "cosine":
        qn = qv / (np.linalg.norm(qv, axis=1, keepdims=True) + 1e-10)
        dn = dv / (np.linalg.norm(dv, axis=1, keepdims=True) + 1e-10)
        return np.round(qn @ dn.T, 9)
    sq = (qv**2).sum(axis=1)[:, None] + (dv**2).sum(axis=1)[None, :] - 2 * qv @ dv.T
    return np.round(-np.sqrt(np.maximum(sq, 0.0)), 9)


def keep_best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k columns of every row, ties to the smaller id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _shipped(docs: DataFrame, head: pd.DataFrame, k: int, metric: str) -> DataFrame:
    qids = head["q"].to_numpy()
    qv = np.vstack(head["v"].to_numpy()) if len(head) else np.zeros((0, 1))
    shipped = docs.sparkSession.sparkContext.broadcast((qids, qv))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shipped.value
        if len(ids) == 0:
            return
        best_s = best_d = None
        for b in batches:
            if b.num_rows == 0:
                continue
            d = b.column(0).to_numpy(zero_copy_only=False)
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(d), -1)
            s = _scores(vectors, v, metric)
            dd = np.broadcast_to(d, s.shape)
            if best_s is not None:
                s, dd = np.hstack([best_s, s]), np.hstack([best_d, dd])
            best_s, best_d = keep_best(s, dd, k)
        if best_s is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids, best_s.shape[1])),
                    pa.array(best_d.ravel()),
                    pa.array(best_s.ravel()),
                ],
                names=["q", "d", "score"],
            )

    return docs.mapInArrow(scan, "q bigint, d bigint, score double")


def _grid(docs: DataFrame, asks: DataFrame, k: int, metric: str) -> DataFrame:
    blocks = math.ceil(asks.count() / BROADCAST_QUERIES)
    shards = max(math.ceil(docs.count() / SHARD_ROWS), 1)
    left = asks.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>"))
    )
    right = docs.withColumn("shard", F.pmod(F.xxhash64("d"), F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))
    )

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"q": [], "d": [], "score": []})
        s = _scores(np.vstack(a["v"].to_numpy()), np.vstack(b["v"].to_numpy()), metric)
        s, d = keep_best(s, np.broadcast_to(b["d"].to_numpy(), s.shape), k)
        return pd.DataFrame(
            {"q": np.repeat(a["q"].to_numpy(), s.shape[1]), "d": d.ravel(), "score": s.ravel()}
        )

    keys = ["block", "shard"]
    return (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(meet, "q bigint, d bigint, score double")
    )


def similar_rows(
    df: DataFrame, requests: DataFrame, features: list[str], row_id: str, request_id: str, k: int
) -> DataFrame:
    """Rows most like each request: Euclidean neighbours over (already scaled) features."""
    vec = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in features])
    return nearest(
        df.select(row_id, vec.alias("embedding")),
        requests.select(request_id, vec.alias("embedding")),
        k,
        corpus_id=row_id,
        query_id=request_id,
        metric="euclidean",
    )
