"""Column profiles, schema checks and null-rate drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.market import unpivot_row
from tabularium.vocabulary import (
    CONTINUOUS_COLUMNS,
    DISCRETE_COLUMNS,
    ORDINAL_COLUMNS,
    STRUCTURAL_NULL_SHARE,
)

NOMINAL = "nominal_categorical"


def housing_kinds() -> dict[str, str]:
    """Semantic kind of every contract column that is not nominal."""
    kinds = {c: "numeric_continuous" for c in CONTINUOUS_COLUMNS}
    kinds |= {c: "numeric_discrete" for c in DISCRETE_COLUMNS}
    kinds |= {c: "ordinal_categorical" for c in ORDINAL_COLUMNS}
    return kinds


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def select_numeric(df: DataFrame) -> DataFrame:
    """Only the numeric columns."""
    return df.select(*[_c(n) for n in numeric_columns(df)])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def column_profile(
    df: DataFrame, kinds: Mapping[str, str] | None = None, approx: bool = False
) -> DataFrame:
    """One row per column: null rate, distinct count, kind, structural flag and numeric range.

    The table is scanned once. Cells are unpivoted inside the row and combined by
    (column, value) before the shuffle, so a constant or null-heavy column costs one row per
    task. ``approx`` replaces the exact distinct count by a sketch and drops that shuffle.
    """
    kinds = kinds or {}
    cells = []
    for f in df.schema.fields:
        numeric = isinstance(f.dataType, T.NumericType)
        value = _c(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(value == 0, F.lit(0).cast(f.dataType)).otherwise(value)
        cells.append(
            F.struct(
                F.lit(f.name).alias("column"),
                value.cast("string").alias("v"),
                (value.cast("double") if numeric else F.lit(None).cast("double")).alias("num"),
            )
        )
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    if approx:
        per_column = long.groupBy("column").agg(
            F.count("*").alias("total"),
            F.count_if(F.col("v").isNull()).alias("nulls"),
            F.approx_count_distinct("v").alias("unique_count"),
            F.min("num").alias("min_value"),
            F.max("num").alias("max_value"),
        )
    else:
        per_value = long.groupBy("column", "v").agg(
            F.count("*").alias("n"), F.min("num").alias("num")
        )
        per_column = per_value.groupBy("column").agg(
            F.sum("n").alias("total"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("v").alias("unique_count"),
            F.min("num").alias("min_value"),
            F.max("num").alias("max_value"),
        )
    share = F.col("nulls") / F.col("total")
    return per_column.select(
        "column",
        _kind(kinds).alias("kind"),
        "total",
        "nulls",
        F.round(share, 4).alias("null_rate"),
        "unique_count",
        (share > STRUCTURAL_NULL_SHARE).alias("is_structural"),
        "min_value",
        "max_value",
    )


def _kind(kinds: Mapping[str, str]) -> Column:
    if not kinds:
        return F.lit(NOMINAL)
    pairs = [F.lit(x) for kv in kinds.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("column")), F.lit(NOMINAL))


def kind_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("kind").agg(F.count("*").alias("columns"))


def schema_confidence(profile: DataFrame) -> DataFrame:
    """1 - (nulls outside structural columns) / (all cells), rounded to 4 digits."""
    unexpected = F.sum(F.when(F.col("is_structural"), 0).otherwise(F.col("nulls")))
    cells = F.sum("total")
    return profile.agg(
        cells.alias("cells"),
        unexpected.alias("unexpected_nulls"),
        F.when(cells > 0, F.round(1 - F.try_divide(unexpected, cells), 4))
        .otherwise(F.lit(0.0))
        .alias("confidence"),
        F.count_if("is_structural").alias("structural_columns"),
    )


def null_drift(df: DataFrame, run: str, columns: Sequence[str]) -> DataFrame:
    """Null rate of each column per run, with the change against the previous and first run."""
    per_run = df.groupBy(run).agg(
        *[F.avg(F.when(_c(c).isNull(), 1.0).otherwise(0.0)).alias(c) for c in columns]
    )
    pairs = [F.struct(F.lit(c).alias("column"), _c(c).alias("null_rate")) for c in columns]
    long = per_run.select(run, F.explode(F.array(*pairs)).alias("p")).select(run, "p.*")
    w = Window.partitionBy("column").orderBy(run)
    return long.select(
        run,
        "column",
        "null_rate",
        (F.col("null_rate") - F.lag("null_rate").over(w)).alias("vs_previous"),
        (F.col("null_rate") - F.first("null_rate").over(w)).alias("vs_first"),
    )


def target_validity(df: DataFrame, target: str) -> DataFrame:
    """Whether the target is complete and positive, with its range."""
    t = _c(target)
    return df.agg(
        F.count("*").alias("total"),
        F.count(t).alias("non_null"),
        F.min(t).alias("min_value"),
        F.max(t).alias("max_value"),
        F.bool_and(F.coalesce(t > 0, F.lit(False))).alias("valid"),
    )


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: number of violating rows (an unknown result violates) and verdict."""
    names = list(rules)
    wide = df.agg(
        *[F.count_if(~F.coalesce(rules[n], F.lit(False))).alias(n) for n in names]
    )
    return unpivot_row(wide, names, "rule", "violations").withColumn(
        "passed", F.col("violations") == 0
    )


def _c(name: str) -> Column:
    return F.col(f"`{name}`")
