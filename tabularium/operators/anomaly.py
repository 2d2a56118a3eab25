"""Anomaly flags: z-scores, severity, per-feature detail and summaries. Rows are never removed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.vocabulary import ISO_HIGH, ISO_MEDIUM, Z_LIMIT

FOREST, ZSCORE = "isolation_forest", "z_score"


def _value(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0))


def abs_z(df: DataFrame, features: Sequence[str]) -> dict[str, Column]:
    """|z| per feature against the population moments of all rows (nulls count as 0).

    All moments come from one aggregation that each row sees as a constant; a feature without
    spread never flags.
    """
    moments = df.agg(
        F.struct(
            *[F.avg(_value(f)).alias(f"m{i}") for i, f in enumerate(features)],
            *[F.stddev_pop(_value(f)).alias(f"s{i}") for i, f in enumerate(features)],
        )
    ).scalar()
    return {
        f: F.coalesce(
            F.try_divide(F.abs(_value(f) - moments[f"m{i}"]), moments[f"s{i}"]), F.lit(0.0)
        )
        for i, f in enumerate(features)
    }


def zscore_flags(df: DataFrame, features: Sequence[str], limit: float = Z_LIMIT) -> DataFrame:
    """Add ``max_abs_z`` and ``z_flag`` (any feature beyond the limit)."""
    z = list(abs_z(df, features).values())
    top = F.greatest(*z) if len(z) > 1 else z[0]
    return df.withColumn("max_abs_z", top).withColumn("z_flag", F.col("max_abs_z") > limit)


def methods(forest: Column, z: Column) -> Column:
    """Names of the detectors that fired."""
    return F.array_compact(
        F.array(F.when(forest, F.lit(FOREST)), F.when(z, F.lit(ZSCORE)))
    )


def severity(forest: Column, z: Column, score: Column) -> Column:
    """HIGH, MEDIUM, LOW for flagged rows and NONE for the rest."""
    both, one = forest & z, forest != z
    return (
        F.when(~(forest | z), "NONE")
        .when(both & (score < ISO_HIGH), "HIGH")
        .when(one | ((score >= ISO_HIGH) & (score < ISO_MEDIUM)), "MEDIUM")
        .otherwise("LOW")
    )


def combine(df: DataFrame, forest: str, z: str, score: str) -> DataFrame:
    """Add the combined flag, the methods list and the severity."""
    f, zz = F.col(forest), F.col(z)
    return df.withColumns(
        {
            "anomaly_flagged": f | zz,
            "methods": methods(f, zz),
            "anomaly_severity": severity(f, zz, F.col(score)),
        }
    )


def details(
    df: DataFrame, features: Sequence[str], forest: str, limit: float = Z_LIMIT
) -> DataFrame:
    """Add ``anomalous_features``: feature → (value, z_score, is_outlier_zscore, is_outlier_iforest)."""
    z = abs_z(df, features)
    entries = [
        x
        for f in features
        for x in (
            F.lit(f),
            F.struct(
                _value(f).alias("value"),
                F.round(z[f], 3).alias("z_score"),
                (z[f] > limit).alias("is_outlier_zscore"),
                F.col(forest).alias("is_outlier_iforest"),
            ),
        )
    ]
    return df.withColumn("anomalous_features", F.create_map(*entries))


def summary(df: DataFrame, forest: str, z: str, severity_col: str) -> DataFrame:
    """Totals per detector and severity, and the flagged share of all rows."""
    f, zz = F.col(forest), F.col(z)
    total = F.count("*")
    flagged = F.count_if(f | zz)
    return df.agg(
        flagged.alias("total_flagged"),
        F.round(F.try_divide(flagged * 100.0, total), 2).alias("pct_of_dataset"),
        F.count_if(f).alias("isolation_forest_flags"),
        F.count_if(zz).alias("zscore_flags"),
        F.count_if(f & zz).alias("both_methods_flags"),
        F.count_if(F.col(severity_col) == "HIGH").alias("high_severity"),
    )


def either(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows flagged by any of the detectors."""
    return df.where(reduce(lambda a, b: a | b, [F.col(f) for f in flags]))


def every(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows flagged by all of the detectors."""
    return df.where(reduce(lambda a, b: a & b, [F.col(f) for f in flags]))
