"""Exact path-dependent Shapley attributions of a boosted-tree model.

Given the training counts of its nodes, a tree is a sum of leaves, and each leaf is a product
over the features on its path: a feature in the coalition contributes whether the row follows
the path, one outside contributes the share of training rows that does. Shapley values of such
a product over at most ``depth`` features are a short sum over its subsets, computed here for
a whole Arrow batch at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.operators.boosting import Boosted


def leaf_paths(nodes: pd.DataFrame) -> list[tuple[float, dict[int, tuple[float, float, float]]]]:
    """Per leaf its weighted value and, per feature on its path, (low, high, cover share)."""
    out = []
    for _, tree in nodes.groupby("tree", sort=True):
        by_id = tree.set_index("node").to_dict("index")
        weight = float(tree["weight"].iloc[0])
        todo: list[tuple[int, dict]] = [(0, {})]
        while todo:
            node, path = todo.pop()
            info = by_id[node]
            if info["left"] < 0:
                out.append((weight * info["prediction"], path))
                continue
            f, cut = int(info["feature"]), float(info["threshold"])
            for child, is_left in ((int(info["left"]), True), (int(info["right"]), False)):
                lo, hi, share = path.get(f, (-math.inf, math.inf, 1.0))
                share *= by_id[child]["cover"] / info["cover"]
                limits = (lo, min(hi, cut), share) if is_left else (max(lo, cut), hi, share)
                todo.append((child, {**path, f: limits}))
    return out


def batch_attributions(x: np.ndarray, leaves) -> np.ndarray:
    """Attributions (rows × features) of a batch."""
    phi = np.zeros(x.shape)
    for value, path in leaves:
        feats = list(path)
        m = len(feats)
        follows = {f: ((x[:, f] > path[f][0]) & (x[:, f] <= path[f][1])).astype(float) for f in feats}
        for j in feats:
            rest = [f for f in feats if f != j]
            total = np.zeros(len(x))
            for size in range(m):
                coef = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                for inside in combinations(rest, size):
                    term = np.full(len(x), coef)
                    for f in rest:
                        term = term * (follows[f] if f in inside else path[f][2])
                    total += term
            phi[:, j] += value * (follows[j] - path[j][2]) * total
    return phi


def tree_attribution(df: DataFrame, model: Boosted, features: Sequence[str]) -> DataFrame:
    """Add ``prediction``, ``base_value`` and ``attributions`` (one number per feature)."""
    return attribute_nodes(df, model.nodes(), features, model.base)


def attribute_nodes(df: DataFrame, nodes: pd.DataFrame, features: Sequence[str], constant: float = 0.0) -> DataFrame:
    """The same from a node table and the constant that the trees add to.

    The model, not the data, sets the size of the node table that is shipped to the tasks.
    """
    leaves = leaf_paths(nodes)
    base = constant + sum(v * math.prod(s for _, _, s in p.values()) for v, p in leaves)
    shipped = df.sparkSession.sparkContext.broadcast(leaves)

    @F.pandas_udf("array<double>")
    def attribute(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        paths = shipped.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            yield pd.Series(list(batch_attributions(x, paths)), dtype=object)

    values = [F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in features]
    return df.withColumn("base_value", F.lit(float(base))).withColumn("attributions", attribute(*values)).withColumn(
        "prediction",
        F.col("base_value") + F.aggregate("attributions", F.lit(0.0), lambda a, v: a + v),
    )
