"""Domain features, temporal split, serving defaults and request validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators.market import correlations
from tabularium.vocabulary import FEATURE_NOTES


@dataclass(frozen=True)
class FeatureColumns:
    """Which columns feed the engineered features (defaults: the housing table)."""

    area: Sequence[str] = ("Total Bsmt SF", "1st Flr SF", "2nd Flr SF")
    porch: Sequence[str] = (
        "Wood Deck SF", "Open Porch SF", "Enclosed Porch", "3Ssn Porch", "Screen Porch",
    )
    sold: str = "Yr Sold"
    built: str = "Year Built"
    remodelled: str = "Year Remod/Add"
    garage_built: str = "Garage Yr Blt"
    full_baths: Sequence[str] = ("Full Bath", "Bsmt Full Bath")
    half_baths: Sequence[str] = ("Half Bath", "Bsmt Half Bath")
    presence: Mapping[str, str] = field(
        default_factory=lambda: {
            "HasPool": "Pool Area",
            "HasGarage": "Garage Area",
            "HasBasement": "Total Bsmt SF",
            "HasFireplace": "Fireplaces",
        }
    )
    quality: str = "Overall Qual"
    condition: str = "Overall Cond"


HOUSING_FEATURES = FeatureColumns()


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _total(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [_c(n) for n in names])


def engineer(df: DataFrame, cols: FeatureColumns = HOUSING_FEATURES, clamp: bool = False) -> DataFrame:
    """Add the 12 features. ``clamp`` keeps ages at zero or more, as serving does."""

    def age(year: Column) -> Column:
        years = _c(cols.sold) - year
        return F.when(years < 0, F.lit(0)).otherwise(years) if clamp else years

    house = age(_c(cols.built))
    baths = _total(cols.full_baths) + 0.5 * _total(cols.half_baths)
    flags = {
        name: F.coalesce((_c(source) > 0).cast("int"), F.lit(0))
        for name, source in cols.presence.items()
    }
    return df.withColumns(
        {
            "TotalSF": _total(cols.area),
            "PorchSF": _total(cols.porch),
            "HouseAge": house,
            "RemodAge": age(_c(cols.remodelled)),
            "GarageAge": F.coalesce(age(_c(cols.garage_built)), house),
            "TotalBathrooms": baths,
            **flags,
            "IsNew": F.coalesce((_c(cols.built) == _c(cols.sold)).cast("int"), F.lit(0)),
            "OverallScore": _c(cols.quality) * _c(cols.condition),
        }
    )


def feature_manifest(df: DataFrame, target: str) -> DataFrame:
    """Engineered features with formula, rationale and correlation to the target (4 digits)."""
    names = [n for n, *_ in FEATURE_NOTES if n in df.columns]
    entry = F.create_map(
        *[
            x
            for n, formula, why in FEATURE_NOTES
            for x in (F.lit(n), F.struct(F.lit(formula).alias("f"), F.lit(why).alias("w")))
        ]
    )
    note = F.element_at(entry, F.col("feature"))
    return correlations(df, target, names).select(
        F.col("feature").alias("name"),
        note["f"].alias("formula"),
        note["w"].alias("rationale"),
        F.round(F.coalesce("corr", F.lit(0.0)), 4).alias("pearson_correlation"),
    )


def temporal_split(
    df: DataFrame, year: str, train: tuple[int, int], validation: int, test: int
) -> DataFrame:
    """Column ``split`` by sale year; years outside the bounds get null."""
    y = _c(year)
    return df.withColumn(
        "split",
        F.when(y.between(*train), "train").when(y == validation, "val").when(y == test, "test"),
    )


def default_year(column: str, fallback: str) -> Column:
    """An absent or zero year falls back to another year column."""
    return F.when(_c(column) > 0, _c(column)).otherwise(_c(fallback))


def validate_requests(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """Add ``reasons``, the fields that are missing or out of bounds, and ``accepted``.

    A bound is (lowest, highest, required); ``None`` leaves a side open.
    """
    checks = []
    for col, (lo, hi, required) in bounds.items():
        ok = F.lit(True)
        if lo is not None:
            ok = ok & (_c(col) >= lo)
        if hi is not None:
            ok = ok & (_c(col) <= hi)
        ok = F.coalesce(ok, F.lit(not required))
        checks.append(F.when(~ok, F.lit(col)))
    reasons = F.array_compact(F.array(*checks))
    return df.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)
