"""Encoding and scaling: fitted on the training rows, applied to any rows.

``fit`` turns the training rows into small parameter tables; ``apply`` joins or looks them up.
Training and serving share ``apply``, so a served row gets exactly the training treatment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.operators.clean import long_numbers, per_feature
from tabularium.operators.profile import numeric_columns, string_columns
from tabularium.operators.quantiles import quantiles
from tabularium.session import new_path, stored
from tabularium.vocabulary import (
    LOG_COLUMNS,
    ONE_HOT_COLUMNS,
    ORDINAL_SCALE_OF,
    ORDINAL_SCALES,
    TARGET_ENCODED_COLUMNS,
    TARGET_MIN_ROWS,
    TARGET_SMOOTHING,
)

MAX_CATEGORIES = 1000


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def ordinal_code(column: str, scale: Mapping[str, int]) -> Column:
    """Rank of a category on its scale; unmapped and null give 0."""
    lookup = F.create_map(*[F.lit(x) for kv in scale.items() for x in kv])
    return F.coalesce(F.element_at(lookup, _c(column)), F.lit(0)).cast("int")


def smoothing_weight(n: Column) -> Column:
    """Trust in a category mean, rising with its training count."""
    return 1 / (1 + F.exp(-(n - TARGET_MIN_ROWS) / TARGET_SMOOTHING))


def fit_target(train: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Stored table (column, category, encoding, global_mean) for all columns in one scan.

    Categories are combined before the shuffle, so a category with a third of the rows costs
    one row per task. Rows with a null category count in the global mean only.
    """
    t = _c(target).cast("double")
    pairs = [F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("category")) for c in columns]
    stats = (
        train.select(t.alias("_t"), F.explode(F.array(*pairs)).alias("p"))
        .select("_t", "p.*")
        .groupBy("column", "category")
        .agg(F.count("_t").alias("n"), F.sum("_t").alias("s"))
    )
    overall = train.agg(F.sum(t) / F.count(t)).scalar()
    w = smoothing_weight(F.col("n"))
    encoding = w * (F.col("s") / F.col("n")) + (1 - w) * F.col("global_mean")
    fitted = stats.withColumn("global_mean", overall).where(
        F.col("category").isNotNull() & (F.col("n") > 0)
    )
    return stored(
        fitted.select("column", "category", encoding.alias("encoding"), "global_mean"),
        "target-encoding",
    )


def apply_target(df: DataFrame, fitted: DataFrame, column: str) -> DataFrame:
    """Replace a category by its encoding; unseen categories get the global mean."""
    own = fitted.where(F.col("column") == column).select(
        F.col("category").alias("_cat"), F.col("encoding").alias("_enc")
    )
    overall = fitted.where(F.col("column") == column).agg(F.max("global_mean")).scalar()
    joined = df.join(own, _c(column) == F.col("_cat"), "left")
    return joined.withColumn(column, F.coalesce("_enc", overall)).drop("_cat", "_enc")


def fit_categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted training categories per column.

    They become column names, so they must be few; more than ``MAX_CATEGORIES`` in all is an
    error rather than a truncation.
    """
    if not columns:
        return {}
    pairs = [F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("category")) for c in columns]
    found = (
        train.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.*")
        .where(F.col("category").isNotNull())
        .distinct()
        .limit(MAX_CATEGORIES + 1)
        .collect()
    )
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"one-hot columns have more than {MAX_CATEGORIES} categories")
    return {c: sorted(r["category"] for r in found if r["column"] == c) for c in columns}


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Indicator per category but the first; unknown values are all zeros."""
    out = {
        f"{c}_{v}": F.coalesce((_c(c) == v).cast("double"), F.lit(0.0))
        for c, values in categories.items()
        for v in values[1:]
    }
    return df.withColumns(out).drop(*categories) if out else df.drop(*categories)


def log_transform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``log_x`` = log1p(x) instead of x."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({f"log_{c}": F.log1p(_c(c)) for c in present}).drop(*present)


def fit_robust(
    train: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Stored table (feature, center, scale): exact median and IQR; a zero IQR scales by 1."""
    probs = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    q = quantiles(long_numbers(train, columns), ["feature"], "value", probs)
    iqr = F.col("q3") - F.col("q1")
    fitted = q.select(
        "feature",
        F.col("q2").alias("center"),
        F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"),
    )
    return stored(fitted, "robust-scale")


def apply_robust(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - center) / scale; a missing value takes the center, hence 0."""
    center = per_feature(fitted, columns, "center")
    scale = per_feature(fitted, columns, "scale")
    return df.withColumns(
        {c: (F.coalesce(_c(c).cast("double"), center[c]) - center[c]) / scale[c] for c in columns}
    )


@dataclass(frozen=True)
class EncodingSpec:
    """Which columns are treated how (defaults: the housing table)."""

    target: str = "SalePrice"
    ordinal: Mapping[str, Mapping[str, int]] = field(
        default_factory=lambda: {c: ORDINAL_SCALES[s] for c, s in ORDINAL_SCALE_OF.items()}
    )
    target_encoded: Sequence[str] = tuple(TARGET_ENCODED_COLUMNS)
    one_hot: Sequence[str] = tuple(ONE_HOT_COLUMNS)
    log: Sequence[str] = tuple(LOG_COLUMNS)
    ids: Sequence[str] = ("Order", "PID")
    keep: Sequence[str] = ("Yr Sold",)
    drop: Sequence[str] = ("artifact_flag", "artifact_reason")
    labels: Mapping[str, str] = field(default_factory=lambda: {"Neighborhood": "Neighborhood_orig"})


@dataclass
class Encoder:
    """Fitted parameters and their application."""

    spec: EncodingSpec
    targets: DataFrame | None
    categories: dict[str, list[str]]
    scaler: DataFrame
    scaled: list[str]

    def apply(self, df: DataFrame) -> DataFrame:
        return apply_robust(self._before_scaling(df), self.scaler, self.scaled)

    def _before_scaling(self, df: DataFrame) -> DataFrame:
        return _encode(df, self.spec, self.targets, self.categories, self.scaled)

    def feature_names(self, matrix: DataFrame) -> list[str]:
        """Model inputs, in matrix order: numbers that are no id, label, year or target."""
        out = {*self.spec.ids, *self.spec.keep, self.spec.target, f"log_{self.spec.target}"}
        return [c for c in numeric_columns(matrix) if c not in out]

    def save(self, path: str) -> None:
        """Parameter tables as parquet below ``path``."""
        spark = self.scaler.sparkSession
        self.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
        cats = [(c, v, i) for c, vs in self.categories.items() for i, v in enumerate(vs)]
        spark.createDataFrame(cats, "column string, category string, position int").write.mode(
            "overwrite"
        ).parquet(f"{path}/categories")
        names = [(c, i) for i, c in enumerate(self.scaled)]
        spark.createDataFrame(names, "feature string, position int").write.mode(
            "overwrite"
        ).parquet(f"{path}/scaled")
        if self.targets is not None:
            self.targets.write.mode("overwrite").parquet(f"{path}/targets")

    @staticmethod
    def load(spark: SparkSession, path: str, spec: EncodingSpec) -> Encoder:
        cats: dict[str, list[str]] = {}
        for r in spark.read.parquet(f"{path}/categories").orderBy("column", "position").collect():
            cats.setdefault(r["column"], []).append(r["category"])
        names = spark.read.parquet(f"{path}/scaled").orderBy("position").collect()
        targets = spark.read.parquet(f"{path}/targets") if spec.target_encoded else None
        return Encoder(
            spec, targets, cats, spark.read.parquet(f"{path}/scaler"), [r["feature"] for r in names]
        )


def _encode(
    df: DataFrame,
    spec: EncodingSpec,
    targets: DataFrame | None,
    categories: Mapping[str, Sequence[str]],
    expected: Sequence[str] = (),
) -> DataFrame:
    """Ordinal, target and one-hot encoding, leftover strings dropped, logs taken.

    Columns in ``expected`` that the input lacks are added as nulls, to be centred later.
    """
    labels = {new: _c(old) for old, new in spec.labels.items() if old in df.columns}
    out = df.withColumns(labels) if labels else df
    out = out.drop(*[c for c in spec.drop if c in out.columns])
    codes = {c: ordinal_code(c, s) for c, s in spec.ordinal.items() if c in out.columns}
    out = out.withColumns(codes) if codes else out
    for c in spec.target_encoded:
        if targets is not None and c in out.columns:
            out = apply_target(out, targets, c)
    out = one_hot(out, {c: v for c, v in categories.items() if c in out.columns})
    kept = {*spec.ids, *labels}
    out = out.drop(*[c for c in string_columns(out) if c not in kept])
    out = log_transform(out, spec.log)
    absent = [c for c in expected if c not in out.columns]
    return out.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else out


def fit(
    df: DataFrame, spec: EncodingSpec, train: Column
) -> Encoder:
    """Fit every parameter on the rows selected by ``train``."""
    rows = df.where(train)
    te = [c for c in spec.target_encoded if c in df.columns]
    targets = fit_target(rows, te, spec.target) if te else None
    categories = fit_categories(rows, [c for c in spec.one_hot if c in df.columns])
    encoded = _encode(rows, spec, targets, categories)
    hot = {f"{c}_{v}" for c, vs in categories.items() for v in vs[1:]}
    skip = {*spec.ids, *spec.keep, spec.target, *hot}
    scaled = [c for c in numeric_columns(encoded) if c not in skip and not c.startswith("log_")]
    return Encoder(spec, targets, categories, fit_robust(encoded, scaled), scaled)


def encode_matrix(
    df: DataFrame, spec: EncodingSpec, train: Column
) -> tuple[DataFrame, Encoder]:
    """The fully numeric matrix and the encoder that made it."""
    encoder = fit(df, spec, train)
    return encoder.apply(df), encoder


def save_params(params: DataFrame, path: str | None = None) -> DataFrame:
    """Write a parameter table and return a scan of it."""
    path = path or new_path(params.sparkSession, "params")
    params.write.mode("overwrite").parquet(path)
    return params.sparkSession.read.schema(params.schema).parquet(path)


