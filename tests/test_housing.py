import pytest
from pyspark.sql import functions as F

from tabularium.operators import profile
from tabularium.operators.canonical import canonical_columns
from tabularium.plans import housing
from tabularium.vocabulary import HOUSING_COLUMNS


@pytest.fixture(scope="module")
def run(houses):
    return housing.run_housing(houses, rounds=5, trees=50)


def test_contract_names():
    assert len(HOUSING_COLUMNS) == 82
    assert canonical_columns(["Lot  Area", "SalePrise", "zzz"], HOUSING_COLUMNS) == {
        "Lot  Area": "Lot Area", "SalePrise": "SalePrice", "zzz": "zzz",
    }
    kinds = profile.housing_kinds().values()
    assert [list(kinds).count(k) for k in ("numeric_continuous", "numeric_discrete", "ordinal_categorical")] == [20, 18, 17]


def test_profile(run, houses):
    rows = {r["column"]: r for r in run.profile.collect()}
    assert set(rows) == {c.replace("  ", " ") for c in houses.columns}
    assert rows["Alley"]["is_structural"] and not rows["Lot Frontage"]["is_structural"]
    assert 0 < rows["Lot Frontage"]["null_rate"] < 0.4
    confidence = profile.schema_confidence(run.profile).first()["confidence"]
    assert 0.9 < confidence < 1


def test_cleaning(run, houses):
    df = run.cleaned
    nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    assert sum(nulls) == 0
    assert df.where("SalePrice <= 0").count() == 0
    assert {r[0] for r in df.select("Neighborhood").distinct().collect()} == {
        "Harbour", "Mill", "Old Quay", "Hillside",
    }
    dropped = houses.where(F.col("Electrical").isNull()).count() + 1
    assert df.count() == houses.count() - dropped


def test_group_median_uses_training_rows_only(houses):
    base = housing.to_contract(houses)
    moved = base.withColumn(
        "Lot Frontage",
        F.when(F.col("`Yr Sold`") >= 2009, F.col("`Lot Frontage`") + 1000).otherwise(F.col("`Lot Frontage`")),
    )
    gap = F.col("`Lot Frontage`").isNull()

    def fills(df):
        ids = [r[0] for r in df.where(gap).select("PID").collect()]
        out = housing.clean_housing(df)
        return {r[0]: r[1] for r in out.where(F.col("PID").isin(ids)).select("PID", "`Lot Frontage`").collect()}

    assert fills(base) == fills(moved)


def test_matrix_is_numeric(run):
    kept = {"PID", "Neighborhood_orig"}
    assert set(profile.string_columns(run.matrix)) == kept
    assert "MS Zoning_RL" in run.matrix.columns and "MS Zoning_RH" not in run.matrix.columns
    assert "log_SalePrice" in run.matrix.columns and "SalePrice" not in run.matrix.columns
    names = run.encoder.feature_names(run.matrix)
    assert not {"log_SalePrice", "Yr Sold", "Order"} & set(names)
    assert {"TotalBathrooms", "HouseAge", "log_TotalSF"} <= set(names)


def test_unseen_category_and_missing_column(run, spark):
    one = run.cleaned.limit(1).withColumn("Neighborhood", F.lit("Nowhere")).withColumn(
        "MS Zoning", F.lit("??")
    )
    from tabularium.operators.features import engineer

    served = run.encoder.apply(engineer(one).drop("Fireplaces", "Garage Qual", "SalePrice"))
    row = served.first()
    assert row["MS Zoning_RL"] == 0.0 and row["MS Zoning_RM"] == 0.0
    assert row["Fireplaces"] == 0.0 and row["Garage Qual"] == 0.0
    assert row["Neighborhood"] is not None


def test_anomalies(run):
    assert run.anomalies.count() == run.matrix.count()
    assert {r[0] for r in run.anomalies.select("anomaly_severity").distinct().collect()} <= {
        "NONE", "LOW", "MEDIUM", "HIGH",
    }
    flagged = run.anomalies.where("anomaly_flagged")
    assert flagged.where(F.size("methods") == 0).count() == 0
    assert 0 < flagged.count() < 40


def test_models(run):
    rows = run.metrics.collect()
    assert {(r["model_name"], r["split"]) for r in rows} == {
        (m, s) for m in ("ridge", "boosted", "boosted_leaves") for s in ("val", "test")
    }
    best = run.champion.first()
    assert best["model_name"] == "ridge" and best["test_r2"] > 0.8


def test_documents_and_persistence(run, spark, tmp_path):
    titles = {r[0] for r in run.documents.select("title").collect()}
    assert titles >= {"neighborhood_stats", "cleaning_report", "anomaly_report", "model_evaluation_report"}
    assert run.chunks.where(~F.col("content").startswith("DOCUMENT: ")).count() == 0
    folder = str(tmp_path)
    for _ in range(2):
        housing.persist(run, folder, "run-1")
    housing.persist(run, folder, "run-2")
    log = spark.read.parquet(f"{folder}/anomaly_log")
    per_run = {r[0]: r[1] for r in log.groupBy("run_id").count().collect()}
    assert per_run["run-1"] == per_run["run-2"] == run.anomalies.where("anomaly_flagged").count()


def test_cleaning_log(houses):
    rows = {(r[0], r[1]): r["rows_affected"] for r in housing.cleaning_log(housing.to_contract(houses)).collect()}
    assert rows[("*", "artifact")] == 1
    assert rows[("Alley", "structural_fill")] == houses.where("Alley is null").count()
    assert rows[("Neighborhood", "standardise")] > 0
