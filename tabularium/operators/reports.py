"""Plain-text report documents built from aggregates of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.session import stored


def _int(c: Column) -> Column:
    return F.floor(c).cast("bigint").cast("string")


def _top(df: DataFrame, order: Column, value: str, n: int) -> Column:
    """The ``n`` values with the smallest order of a small aggregate, as a comma list."""
    first = df.select(order.alias("o"), F.col(value).alias("v")).orderBy("o", "v").limit(n)
    listed = F.array_sort(F.collect_list(F.struct("o", "v")))
    return first.agg(F.array_join(F.transform(listed, lambda x: x["v"]), ", ")).scalar()


def neighborhood_document(stats: DataFrame, group: str) -> DataFrame:
    """From the per-group statistics (one row per group), read several times."""
    stats = stored(stats, "report-groups")
    high = _top(stats, -F.col("median_price"), group, 3)
    low = _top(stats, F.col("median_price"), group, 3)
    return stats.agg(
        F.count("*").alias("n"), F.min("min_price").alias("a"), F.max("max_price").alias("b")
    ).select(
        F.lit("neighborhood_stats").alias("title"),
        F.concat(
            F.lit("Prices by neighborhood\n\nCompared: "), F.col("n").cast("string"),
            F.lit(". Dearest by median: "), high, F.lit(". Cheapest by median: "), low,
            F.lit(". Single sales run from $"), _int(F.col("a")), F.lit(" up to $"), _int(F.col("b")), F.lit("."),
        ).alias("content"),
    )


def trend_document(years: DataFrame, year: str) -> DataFrame:
    """From the yearly transaction counts ``n``."""
    most = F.max_by(year, F.struct("n", -F.col(year)))
    least = F.min_by(year, F.struct("n", year))
    return years.agg(most.cast("string").alias("most"), least.cast("string").alias("least")).select(
        F.lit("price_trends_report").alias("title"),
        F.concat(
            F.lit("Sales over the years\n\nBusiest year: "), "most", F.lit(". Quietest year: "), "least", F.lit("."),
        ).alias("content"),
    )


def anomaly_document(flags: DataFrame) -> DataFrame:
    return flags.select(
        F.lit("anomaly_report").alias("title"),
        F.format_string(
            "Unusual sales\n\nFlagged in all: %d\nBy the isolation forest: %d\n"
            "By z-scores: %d\nBy both: %d\n",
            "total_flagged", "isolation_forest_flags", "zscore_flags", "both_methods_flags",
        ).alias("content"),
    )


def cleaning_document(cleaning: DataFrame) -> DataFrame:
    return cleaning.select(
        F.lit("cleaning_report").alias("title"),
        F.format_string(
            "Cleaning\n\nRead: %d rows, kept: %d\nRemoved: %d\n",
            F.col("rows_in"), F.col("rows_out"), F.col("rows_in") - F.col("rows_out"),
        ).alias("content"),
    )


def model_document(models: DataFrame) -> DataFrame:
    """From the model results (one row per model)."""
    line = F.concat(
        F.lit("- "), "model_name", F.lit(": RMSE on the test rows $"),
        F.round("test_rmse").cast("bigint").cast("string"), F.lit("\n"),
    )
    lines = F.array_sort(F.collect_list(F.struct("model_name", line.alias("t"))))
    return models.agg(F.array_join(F.transform(lines, lambda x: x["t"]), "").alias("t")).select(
        F.lit("model_evaluation_report").alias("title"),
        F.concat(F.lit("Models compared\n\n"), "t").alias("content"),
    )


def report_documents(
    stats: DataFrame, group: str, years: DataFrame, year: str, flags: DataFrame,
    cleaning: DataFrame, models: DataFrame,
) -> DataFrame:
    """All data-driven documents: title, content."""
    docs = neighborhood_document(stats, group)
    for other in (
        trend_document(years, year), anomaly_document(flags), cleaning_document(cleaning),
        model_document(models),
    ):
        docs = docs.unionByName(other)
    return docs
