"""Scoring, evaluation and linear attribution as plain expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.numeric import band, unlog
from tabularium.operators.market import unpivot_row


def _x(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0))


def linear(coefs: Mapping[str, float], intercept: float) -> Column:
    """Linear model as one expression; missing inputs count as 0."""
    terms = [F.lit(float(w)) * _x(n) for n, w in coefs.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))


def batch_score(
    df: DataFrame, coefs: Mapping[str, float], intercept: float, logged: bool = True
) -> DataFrame:
    """Add ``predicted_price`` and its band to every request row."""
    raw = linear(coefs, intercept)
    out = df.withColumn("predicted_price", unlog(raw) if logged else raw)
    low, high = band(F.col("predicted_price"))
    return out.withColumns({"band_low": low, "band_high": high})


def regression_metrics(
    preds: DataFrame, keys: Sequence[str], actual: str, predicted: str, logged: bool = False
) -> DataFrame:
    """RMSE, MAE, R², MAPE (actual clipped at 1) and RMSE in model space, in one aggregation."""
    a, p = F.col(actual), F.col(predicted)
    ad, pd_ = (F.expm1(a), F.expm1(p)) if logged else (a, p)
    err = ad - pd_
    sst = F.var_pop(ad) * F.count(ad)
    clipped = F.greatest(ad, F.lit(1.0))
    return preds.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(F.sum(err * err), sst)).alias("r2"),
        (F.avg(F.abs(clipped - pd_) / clipped) * 100).alias("mape"),
        F.sqrt(F.avg((a - p) * (a - p))).alias("rmse_model_space"),
    )


def champion(metrics: DataFrame, model: str, split: str, select_on: str = "val") -> DataFrame:
    """The model with the highest R² on the selection split, with its test metrics.

    Selection defaults to validation so the test split stays untouched; ``select_on="test"``
    picks by test R² instead.
    """
    best = metrics.where(F.col(split) == select_on).agg(
        F.max_by(model, F.struct("r2", model)).alias(model), F.max("r2").alias("selection_r2")
    )
    test = metrics.where(F.col(split) == "test").select(
        F.col(model), F.col("r2").alias("test_r2"), F.col("rmse").alias("test_rmse")
    )
    return best.join(test, model)


def contributions(
    coefs: Mapping[str, float], background: Mapping[str, float] | None = None
) -> dict[str, Column]:
    """Per-feature contribution w·(x - background)."""
    base = background or {}
    return {n: F.lit(float(w)) * (_x(n) - F.lit(float(base.get(n, 0.0)))) for n, w in coefs.items()}


def linear_attribution(
    df: DataFrame, coefs: Mapping[str, float], intercept: float, top: int = 8, logged: bool = True
) -> DataFrame:
    """Add ``top_features``: the largest contributions in price units, as (feature, impact)."""
    priced = df.withColumn("_price", unlog(linear(coefs, intercept)) if logged else F.lit(1.0))
    impacts = {n: phi * F.col("_price") for n, phi in contributions(coefs).items()}
    entries = F.array(
        *[
            F.struct((-F.abs(i)).alias("order"), F.lit(n).alias("feature"), i.alias("impact"))
            for n, i in impacts.items()
        ]
    )
    best = priced.withColumn("_best", F.slice(F.sort_array(entries), 1, top))
    pairs = F.arrays_zip(
        F.col("_best.feature").alias("feature"), F.col("_best.impact").alias("impact")
    )
    return best.withColumn("top_features", pairs).drop("_price", "_best")


def attribution_importance(
    df: DataFrame, coefs: Mapping[str, float], background: Mapping[str, float] | None = None
) -> DataFrame:
    """Mean absolute contribution per feature, largest first; one wide aggregation."""
    phis = contributions(coefs, background)
    wide = df.agg(*[F.avg(F.abs(phi)).alias(n) for n, phi in phis.items()])
    return unpivot_row(wide, list(phis), "feature", "mean_abs_impact").orderBy(
        F.desc("mean_abs_impact"), "feature"
    )
