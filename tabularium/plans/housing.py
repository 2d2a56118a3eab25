"""The housing flow: contract → profile → clean → features → matrix → anomalies ∥ models → documents.

Each step is one lazy plan; fitted parameters and the encoded matrix, which two branches read,
are the only intermediates that are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators import anomaly, chunking, clean, encode, features, forest, profile
from tabularium.operators import reports, scoring, training
from tabularium.operators.boosting import LEAF_WISE, fit_boosted
from tabularium.operators.canonical import canonical_columns
from tabularium.operators.market import group_stats
from tabularium.session import stored
from tabularium.sources.registry import append_history, save_table
from tabularium.vocabulary import (
    ANOMALY_FEATURES,
    ARTIFACT_AREA,
    ARTIFACT_PRICE,
    CONTINUOUS_COLUMNS,
    DISCRETE_COLUMNS,
    HOUSING_COLUMNS,
    STRUCTURAL_NULL_COLUMNS,
    TEST_YEAR,
    TRAIN_YEARS,
    VALIDATION_YEAR,
)

TARGET, YEAR, HOOD = "SalePrice", "Yr Sold", "Neighborhood"


def housing_schema() -> T.StructType:
    """Declared types of the housing file."""
    fractional = {"Lot Frontage", "Mas Vnr Area", "SalePrice"}
    out = []
    for c in HOUSING_COLUMNS:
        kind: T.DataType = T.StringType()
        if c in CONTINUOUS_COLUMNS or c in DISCRETE_COLUMNS:
            kind = T.DoubleType() if c in CONTINUOUS_COLUMNS or c in fractional else T.LongType()
        out.append(T.StructField(c, kind))
    return T.StructType(out)


def train_rows():
    return F.col(f"`{YEAR}`").between(*TRAIN_YEARS)


def to_contract(df: DataFrame) -> DataFrame:
    """Columns renamed to the contract names they resemble."""
    renames = {k: v for k, v in canonical_columns(df.columns, HOUSING_COLUMNS).items() if k != v}
    return profile.rename_columns(df, renames) if renames else df


def artifact():
    return (F.col("`Gr Liv Area`") > ARTIFACT_AREA) & (F.col(TARGET) < ARTIFACT_PRICE)


def clean_housing(
    df: DataFrame, remove_artifacts: bool = True
) -> DataFrame:
    """Every cleaning step in order; no nulls remain."""
    out = clean.fill_structural(df, STRUCTURAL_NULL_COLUMNS)
    snapshot = out
    if "Lot Frontage" in out.columns:
        out = clean.impute_group_median(out, "Lot Frontage", HOOD, train_rows())
    if {"Garage Yr Blt", "Year Built"} <= set(out.columns):
        out = clean.fill_from_column(out, "Garage Yr Blt", "Year Built")
    constants = {"Mas Vnr Type": clean.MISSING, "Mas Vnr Area": 0}
    out = clean.fill_constants(out, {c: v for c, v in constants.items() if c in out.columns})
    if "Electrical" in out.columns:
        out = clean.drop_required_nulls(out, ["Electrical"])
    out = clean.trim_strings(out)
    if {"Gr Liv Area", TARGET} <= set(out.columns):
        out = clean.flag_artifacts(
            out, artifact(), f"GrLivArea>{ARTIFACT_AREA} & SalePrice<{ARTIFACT_PRICE}", remove_artifacts
        )
    names = [c for c in out.columns if c not in ("artifact_flag", "artifact_reason")]
    return clean.fill_remaining(out, train_rows(), names, snapshot)


def cleaning_log(df: DataFrame) -> DataFrame:
    """The long report of what cleaning would change in ``df``."""
    have = set(df.columns)
    imputed = {
        "Lot Frontage": "neighborhood_median_train_only",
        "Garage Yr Blt": "fill_with_YearBuilt",
        "Mas Vnr Type": "fill_None",
        "Mas Vnr Area": "fill_zero",
    }
    return clean.cleaning_report(
        df,
        [c for c in STRUCTURAL_NULL_COLUMNS if c in have],
        {c: m for c, m in imputed.items() if c in have},
        [c for c in ["Electrical"] if c in have],
        profile.string_columns(df),
        artifact(),
    )


def find_anomalies(
    matrix: DataFrame, trees: int | None = None
) -> DataFrame:
    """The matrix with forest and z-score flags, methods, severity and per-feature detail."""
    names = [f for f in ANOMALY_FEATURES if f in matrix.columns]
    kw = {"trees": trees} if trees else {}
    scored = forest.isolation_forest(matrix, names, **kw)
    flagged = anomaly.zscore_flags(scored, names)
    return anomaly.details(
        anomaly.combine(flagged, "iso_flag", "z_flag", "iso_score"), names, "iso_flag"
    )


@dataclass
class Run:
    """Tables of one run."""

    profile: DataFrame
    cleaned: DataFrame
    matrix: DataFrame
    anomalies: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    champion: DataFrame
    documents: DataFrame
    chunks: DataFrame
    encoder: encode.Encoder


def run_housing(
    raw: DataFrame,
    rounds: int = 100,
    trees: int | None = None,
) -> Run:
    """The whole flow over a raw housing table."""
    df = to_contract(raw)
    prof = profile.column_profile(df, profile.housing_kinds())
    cleaned = stored(clean_housing(df), "housing-cleaned")
    engineered = features.engineer(cleaned)
    spec = encode.EncodingSpec()
    matrix, encoder = encode.encode_matrix(engineered, spec, train_rows())
    matrix = stored(matrix, "housing-matrix")

    flagged = stored(find_anomalies(matrix, trees), "housing-anomalies")
    preds = stored(predict_all(matrix, encoder, rounds), "housing-predictions")
    metrics = scoring.regression_metrics(preds, ["model_name", "split"], "actual", "pred", logged=True)
    best = scoring.champion(metrics, "model_name", "split")

    flags = anomaly.summary(flagged, "iso_flag", "z_flag", "anomaly_severity")
    counts = cleaned.agg(F.count("*").alias("rows_out"))
    rows_in = df.agg(F.count("*")).scalar()
    test = metrics.where(F.col("split") == "test").select("model_name", F.col("rmse").alias("test_rmse"))
    docs = reports.report_documents(
        group_stats(cleaned, HOOD, TARGET),
        HOOD,
        cleaned.groupBy(F.col(f"`{YEAR}`").alias("yr")).agg(F.count("*").alias("n")),
        "yr",
        flags,
        counts.withColumn("rows_in", rows_in),
        test,
    )
    docs = stored(docs, "housing-documents")
    chunks = chunking.sentence_chunks(docs.withColumn("doc", F.col("title")), "doc", "title", "content")
    return Run(prof, cleaned, matrix, flagged, preds, metrics, best, docs, chunks, encoder)


def predict_all(matrix: DataFrame, encoder: encode.Encoder, rounds: int) -> DataFrame:
    """Held-out predictions of ridge and both boosted models, in log space."""
    names = encoder.feature_names(matrix)
    label = f"log_{TARGET}"
    year = F.col(f"`{YEAR}`")
    split = F.when(year == VALIDATION_YEAR, "val").when(year == TEST_YEAR, "test")
    held = matrix.withColumn("split", split).where(F.col("split").isNotNull())
    ridge = training.fit_ridge(matrix.where(train_rows()), names, label, ["PID", "Order"])
    out = held.select(
        F.lit("ridge").alias("model_name"), "split", F.col(f"`{label}`").alias("actual"),
        ridge.predict().alias("pred"),
    )
    fitting = matrix.where(train_rows() | (year == VALIDATION_YEAR))
    safe = {n: f"x{i}" for i, n in enumerate(names)}

    def plain(df: DataFrame) -> DataFrame:
        keep = [F.col(f"`{n}`").cast("double").alias(a) for n, a in safe.items()]
        return df.select(*keep, F.col(f"`{label}`").alias("label_value"), year.alias("sold"))

    for model_name, shape in (("boosted", {}), ("boosted_leaves", LEAF_WISE)):
        model = fit_boosted(
            plain(fitting), list(safe.values()), "label_value", F.col("sold") == VALIDATION_YEAR, rounds=rounds, **shape
        )
        scored = plain(held).withColumn("prediction", model.predict())
        out = out.unionByName(
            scored.select(
                F.lit(model_name).alias("model_name"),
                F.when(F.col("sold") == VALIDATION_YEAR, "val").otherwise("test").alias("split"),
                F.col("label_value").alias("actual"),
                F.col("prediction").alias("pred"),
            )
        )
    return out


def persist(run: Run, folder: str, run_id: str) -> None:
    """Append the run's history tables and replace the chunk table."""
    append_history(run.profile, f"{folder}/schema_history", run_id)
    append_history(run.metrics, f"{folder}/model_results", run_id)
    append_history(
        run.anomalies.where("anomaly_flagged").select(
            F.col("PID").cast("string").alias("pid"),
            F.col("Neighborhood_orig").alias("neighborhood"),
            F.col("anomaly_severity").alias("severity"),
            F.round("iso_score", 4).alias("isolation_score"),
            "methods",
            F.to_json("anomalous_features").alias("anomalous_features"),
        ),
        f"{folder}/anomaly_log",
        run_id,
    )
    append_history(run.documents, f"{folder}/documents", run_id)
    save_table(run.chunks, f"{folder}/chunks")
    run.encoder.save(f"{folder}/encoder")
