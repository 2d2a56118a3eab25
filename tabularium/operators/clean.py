"""Leakage-free cleaning: fills, imputation, trimming, artefact rules and their report.

Everything fitted takes ``train``, a predicate that selects the rows statistics may come from.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.text import strip
from tabularium.operators.profile import string_columns
from tabularium.operators.quantiles import quantiles, with_overall
from tabularium.session import stored

MISSING = "None"


def fill_structural(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null means "has none": filled with the text None."""
    return df.na.fill(MISSING, subset=[c for c in columns if c in df.columns])


def fill_from_column(df: DataFrame, column: str, other: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(_c(column), _c(other)))


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One wide row of null counts."""
    return df.agg(*[F.count_if(_c(c).isNull()).alias(c) for c in columns])


def impute_group_median(
    df: DataFrame, column: str, group: str, train: Column
) -> DataFrame:
    """Null ← training median of the row's group, else the global training median."""
    fitted = df.where(train).select(group, column)
    fits = stored(
        quantiles(
            with_overall(fitted, group, column), ["overall", group], column, {"_median": 0.5}, costly=True,
        ),
        "group-medians",
    )
    overall = fits.where("overall").agg(F.max("_median")).scalar()
    medians = fits.where(~F.col("overall") & _c(group).isNotNull()).select(group, "_median")
    joined = df.join(medians, group, "left")
    return joined.withColumn(column, F.coalesce(_c(column), "_median", overall)).select(*df.columns)


def column_medians(
    df: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """One row per column: its exact median over the given rows."""
    return quantiles(
        long_numbers(df, columns), ["feature"], "value", {"median": 0.5}
    ).select("feature", "median")


def long_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value) rows, generated inside the row."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), _c(c).cast("double").alias("value")) for c in columns
    ]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def per_feature(params: DataFrame, names: Sequence[str], value: str) -> Column:
    """A (feature, value) parameter table as one struct with a field per feature.

    The table has one row per column of the data, so its size is fixed by the schema.
    """
    picks = [F.max(F.when(F.col("feature") == n, F.col(value))).alias(n) for n in names]
    return params.agg(F.struct(*picks)).scalar()


def fill_remaining(
    df: DataFrame,
    train: Column,
    columns: Sequence[str] | None = None,
    snapshot: DataFrame | None = None,
) -> DataFrame:
    """Remaining nulls: numbers ← training median, strings ← None.

    Medians come from ``snapshot`` (the table before rows were dropped) when one is given.
    """
    names = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in names if isinstance(types[c], T.NumericType)]
    text = [c for c in names if isinstance(types[c], T.StringType)]
    out = df.na.fill(MISSING, subset=text) if text else df
    if not numeric:
        return out
    source = (df if snapshot is None else snapshot).where(train)
    medians = per_feature(
        stored(column_medians(source, numeric), "column-medians"), numeric, "median"
    )
    fills = {c: F.coalesce(_c(c), medians[c].cast(types[c])) for c in numeric}
    return out.withColumns(fills)


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = columns or string_columns(df)
    return df.withColumns({c: strip(_c(c)) for c in names})


def trim_changes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Changed cells per string column (nulls do not count as changed)."""
    names = columns or string_columns(df)
    return df.agg(*[F.count_if(_c(c) != strip(_c(c))).alias(c) for c in names])


def flag_artifacts(
    df: DataFrame, predicate: Column, reason: str, remove: bool = False
) -> DataFrame:
    """Flag rows that match a domain rule, or remove them; an unknown result is no artefact."""
    hit = F.coalesce(predicate, F.lit(False))
    if remove:
        return df.where(~hit)
    return df.withColumn("artifact_flag", hit).withColumn(
        "artifact_reason", F.when(hit, F.lit(reason))
    )


def drop_required_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def cleaning_report(
    df: DataFrame,
    structural: Sequence[str],
    imputed: Mapping[str, str],
    required: Sequence[str],
    trimmed: Sequence[str],
    artifact: Column,
) -> DataFrame:
    """Long report (column_name, action, method, rows_affected) of a cleaning run, in one scan."""
    lines: list[tuple[str, str, str, Column]] = []
    for c in structural:
        lines.append((c, "structural_fill", "fill_None", _c(c).isNull()))
    for c, method in imputed.items():
        lines.append((c, "impute", method, _c(c).isNull()))
    for c in required:
        lines.append((c, "drop_row", "required_not_null", _c(c).isNull()))
    for c in trimmed:
        lines.append((c, "standardise", "trim", _c(c) != strip(_c(c))))
    lines.append(("*", "artifact", "domain_rule", artifact))
    wide = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"r{i}") for i, (*_, p) in enumerate(lines)])
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(a).alias("action"),
            F.lit(m).alias("method"),
            F.col(f"r{i}").alias("rows_affected"),
        )
        for i, (c, a, m, _) in enumerate(lines)
    ]
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _c(name: str) -> Column:
    return F.col(f"`{name}`")
