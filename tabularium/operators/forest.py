"""Isolation forest: sampled trees fitted in parallel, whole table scored in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.operators.quantiles import quantiles
from tabularium.session import stored
from tabularium.vocabulary import CONTAMINATION, FOREST_SAMPLE, FOREST_TREES

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, path double"
)
EULER = 0.5772156649015329


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n items."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _vector(features: Sequence[str]) -> Column:
    return F.array(
        *[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in features]
    )


def _uniform(keys: np.ndarray, *salt: int) -> np.ndarray:
    """A number between 0 and 1 for every 64-bit key; other salts give other numbers."""
    odd = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
    x = keys ^ np.uint64(sum(s * o for s, o in zip(salt, odd)) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53


def least_ranks(keys: np.ndarray, copies: np.ndarray, tree: int, seed: int, below: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranks under ``below`` of all copies of the keys in one tree: ranks, copy numbers, row of each.

    Every copy of a key has a uniform rank. Those of n copies are the order statistics of n
    uniform numbers, made one after another from the least, so copies need not be listed.
    """
    rows = np.flatnonzero(_uniform(keys, seed, tree, 0) <= below * copies)
    rank, out = np.zeros(len(rows)), []
    number = 0
    while len(rows):
        fresh = -np.expm1(np.log1p(-_uniform(keys[rows], seed, tree, number)) / (copies[rows] - number))
        rank = rank + (1 - rank) * fresh
        on = rank < below
        rows, rank = rows[on], rank[on]
        out.append((rank, np.full(len(rows), number), rows))
        number += 1
        on = copies[rows] > number
        rows, rank = rows[on], rank[on]
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (rank, rows, rows)


def draw_samples(
    df: DataFrame, features: Sequence[str], trees: int, sample: int, seed: int
) -> DataFrame:
    """(tree, x, pos): for every tree a random sample without replacement, the same for any partitioning.

    A tree takes the rows of the least ranks, a rank being drawn from the hash of the row's values, the
    number of the tree and of the copy: a bottom-k sketch, which any task can make of its rows and any
    other can merge. Only ranks under a limit that about four times the sample stays below leave a task;
    should a tree get too few, the limit is raised and the pass repeated.
    """
    vectors = df.select(_vector(features).alias("x")).withColumn("h", F.xxhash64("x"))
    counted = stored(vectors.groupBy("h").agg(F.count("*").alias("n")), "forest-rows")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total == 0:
        raise ValueError("cannot fit a forest on an empty table")
    want = min(sample, total)

    def ranks(below: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h, n = (batch.column(c).to_numpy() for c in ("h", "n"))
                for tree in range(trees):
                    rank, number, rows = least_ranks(h.view(np.uint64), n, tree, seed, below)
                    columns = [pa.array(np.full(len(rank), tree, np.int32)), pa.array(rank), pa.array(number), pa.array(h[rows])]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "rank", "copy", "h"])

        return run

    below = 4.0 * want / total
    while True:
        below = below if below < 1.0 else 2.0  # above every rank
        drawn = stored(counted.mapInArrow(ranks(below), "tree int, rank double, copy long, h long"), "forest-ranks")
        sizes = drawn.groupBy("tree").count()
        full = sizes.where(F.col("count") >= want).count() == trees
        if full or below >= 1.0:
            break
        below *= 4.0
    order = Window.partitionBy("tree").orderBy("rank", "h", "copy")
    kept = drawn.withColumn("pos", F.row_number().over(order) - 1).where(F.col("pos") < want)
    kept = stored(kept.select("tree", "pos", "h"), "forest-kept")  # at most trees x sample rows
    values = vectors.join(kept.select("h").distinct(), "h").groupBy("h").agg(F.min("x").alias("x"))
    return kept.join(values, "h").select("tree", "x", "pos")


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    trees: int = FOREST_TREES,
    sample: int = FOREST_SAMPLE,
    seed: int = 42,
) -> DataFrame:
    """Stored node table of the forest; one task group per tree, each over one bounded sample."""

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        x = np.vstack(pdf.sort_values("pos")["x"].to_numpy())
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(x), 2)))
        nodes: list[list] = []
        todo = [(np.arange(len(x)), 0, None)]
        while todo:
            idx, depth, slot = todo.pop()
            me = len(nodes)
            if slot is not None:
                nodes[slot[0]][slot[1]] = me
            lo, hi = x[idx].min(axis=0), x[idx].max(axis=0)
            open_features = np.flatnonzero(hi > lo)
            if depth >= limit or len(idx) <= 1 or len(open_features) == 0:
                nodes.append([tree, me, -1, 0.0, -1, -1, depth + average_path(len(idx))])
                continue
            f = int(rng.choice(open_features))
            cut = float(rng.uniform(lo[f], hi[f]))
            below = x[idx, f] <= cut
            nodes.append([tree, me, f, cut, -1, -1, 0.0])
            todo.append((idx[~below], depth + 1, (me, 5)))
            todo.append((idx[below], depth + 1, (me, 4)))
        return pd.DataFrame(
            nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path"]
        )

    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    samples = draw_samples(df, features, trees, sample, seed).repartition(tasks, "tree")
    return stored(samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA), "forest-nodes")


def raw_scores(
    df: DataFrame, nodes: DataFrame, features: Sequence[str], sample: int = FOREST_SAMPLE
) -> DataFrame:
    """Add ``raw_score`` = -2^(-mean path / c): -1 is most anomalous.

    The node table has at most trees x (2 x sample - 1) rows whatever the data size, so it is
    shipped to the executors once as a broadcast variable.
    """
    pdf = nodes.orderBy("tree", "node").toPandas()
    leaf = pdf["feature"] < 0
    # A leaf points to itself, so every row can walk the same number of steps.
    pdf["left"], pdf["right"] = pdf["left"].mask(leaf, pdf["node"]), pdf["right"].mask(leaf, pdf["node"])
    pdf["threshold"] = pdf["threshold"].mask(leaf, np.inf)
    pdf["feature"] = pdf["feature"].clip(lower=0)
    columns = ["feature", "threshold", "left", "right", "path"]
    trees = [
        tuple(g[c].to_numpy() for c in columns) for _, g in pdf.groupby("tree", sort=True)
    ]
    shipped = df.sparkSession.sparkContext.broadcast(trees)
    scale = average_path(min(sample, df.count())) or 1.0
    steps = math.ceil(math.log2(max(sample, 2)))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forest = shipped.value
        for series in batches:
            if len(series) == 0:
                yield pd.Series([], dtype="float64")
                continue
            x = np.vstack(series.to_numpy())
            flat, base = x.ravel(), np.arange(len(x)) * x.shape[1]
            total = np.zeros(len(x))
            for feature, threshold, left, right, path in forest:
                at = np.zeros(len(x), dtype=np.int64)
                for _ in range(steps):
                    low = flat[base + feature[at]] <= threshold[at]
                    at = np.where(low, left[at], right[at])
                total += path[at]
            yield pd.Series(-np.exp2(-(total / len(forest)) / scale))

    return df.withColumn("raw_score", score(_vector(features)))


def isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    contamination: float = CONTAMINATION,
    trees: int = FOREST_TREES,
    sample: int = FOREST_SAMPLE,
    seed: int = 42,
) -> DataFrame:
    """Add ``iso_score`` (negative = anomalous) and ``iso_flag``.

    Scores are written once and read twice: for the contamination quantile and for the flags.
    """
    nodes = fit_forest(df, features, trees, sample, seed)
    scored = stored(raw_scores(df, nodes, features, sample), "forest-scores")
    cut = quantiles(scored, [], "raw_score", {"q": contamination}).select("q").scalar()
    return (
        scored.withColumn("iso_score", F.col("raw_score") - cut)
        .withColumn("iso_flag", F.col("iso_score") < 0)
        .drop("raw_score")
    )
