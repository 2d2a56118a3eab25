"""Model training: cross-validated ridge from sufficient statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators.scoring import linear
from tabularium.session import literal_table
from tabularium.vocabulary import RIDGE_ALPHAS, RIDGE_FOLDS


@dataclass
class Ridge:
    """A fitted ridge model and its cross-validation errors."""

    coefs: dict[str, float]
    intercept: float
    alpha: float
    cv_rmse: dict[float, float]

    def predict(self) -> Column:
        return linear(self.coefs, self.intercept)

    def table(self, spark) -> DataFrame:
        lines = [(n, float(w)) for n, w in self.coefs.items()] + [("(intercept)", self.intercept)]
        return literal_table(spark, lines, ["term", "coefficient"]).withColumn(
            "alpha", F.lit(self.alpha)
        )


def _numbers(names: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(0.0)).alias(n) for n in names]


def centre(df: DataFrame, features: Sequence[str], label: str) -> np.ndarray:
    """About the mean of every feature and of the label, from one aggregate; 0 for an empty table."""
    means = df.select(*_numbers([*features, label])).agg(*[F.avg(f"`{n}`") for n in (*features, label)]).first()
    return np.array([m or 0.0 for m in means])


def fold_statistics(df: DataFrame, features: Sequence[str], label: str, fold: str, shift: np.ndarray) -> DataFrame:
    """Sum of outer products of (1, x - shift, y - shift) per fold: everything ridge and its CV need.

    Each task folds its batches into one small matrix per fold, so the data are read once and
    never shuffled; only (features + 2)² numbers per task and fold travel. With ``shift`` near
    the means the products are as small as the spread of the data and nothing cancels.
    """
    width = len(features) + 2
    names = [*features, label]

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for k, part in pdf.groupby(fold):
                z = np.column_stack([np.ones(len(part)), part[names].to_numpy(dtype=float) - shift])
                total[int(k)] = total.get(int(k), np.zeros((width, width))) + z.T @ z
        for k, g in total.items():
            yield pd.DataFrame(
                {"fold": k, "cell": np.arange(width * width), "value": g.ravel()}
            )

    sums = df.select(*_numbers(names), F.col(fold)).mapInPandas(gram, "fold int, cell int, value double")
    return sums.groupBy("fold", "cell").agg(F.sum("value").alias("value"))


def fit_ridge(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    fold_key: Sequence[str],
    alphas: Sequence[float] = RIDGE_ALPHAS,
    folds: int = RIDGE_FOLDS,
) -> Ridge:
    """Ridge with the penalty chosen by k-fold RMSE, in two passes over the training rows.

    The first takes means, the second products around them, so large means with a small spread
    lose no digits. Rows go to folds by a hash of ``fold_key``. The collected statistics are folds ×
    (features + 2)² numbers, whatever the number of rows.
    """
    keyed = train.withColumn("_fold", F.pmod(F.xxhash64(*fold_key), F.lit(folds)).cast("int"))
    width = len(features) + 2
    grams = np.zeros((folds, width, width))
    shift = centre(train, features, label)
    for r in fold_statistics(keyed, features, label, "_fold", shift).collect():
        grams[r["fold"]].flat[r["cell"]] = r["value"]
    whole = grams.sum(axis=0)
    errors: dict[float, float] = {}
    for alpha in alphas:
        per_fold = []
        for held in grams:
            rest = whole - held
            if held[0, 0] == 0 or rest[0, 0] == 0:
                continue
            w, b = _solve(rest, alpha)
            v = np.concatenate([[b], w, [-1.0]])
            per_fold.append(np.sqrt(max(v @ held @ v, 0.0) / held[0, 0]))
        errors[float(alpha)] = float(np.mean(per_fold)) if per_fold else 0.0
    alpha = min(errors, key=lambda a: (errors[a], a))
    w, b = _solve(whole, alpha)
    intercept = b + shift[-1] - w @ shift[:-1]
    return Ridge(dict(zip(features, map(float, w))), float(intercept), alpha, errors)


def _solve(gram: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Ridge weights with an unpenalised intercept from the (1, x, y) statistics."""
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    centred = gram[1:, 1:] - n * np.outer(mean, mean)
    p = len(mean) - 1
    w = np.linalg.solve(centred[:p, :p] + alpha * np.eye(p), centred[:p, p])
    return w, float(mean[p] - mean[:p] @ w)
