"""Snap misspelled names or values to a known vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.numeric import levenshtein_ratio
from tabularium.session import stored

MIN_SCORE = 80.0


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for ch in a:
        diagonal = 0
        for j, other in enumerate(b, 1):
            kept = row[j]
            row[j] = diagonal + 1 if ch == other else max(row[j], row[j - 1])
            diagonal = kept
    return row[-1]


def indel_ratio(a: str, b: str) -> float:
    """Insert/delete similarity in percent."""
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * common_length(a, b) / total


def best_indel(value: Column, vocabulary: Sequence[str]) -> Column:
    """Best vocabulary entry by insert/delete similarity, or the value itself below the limit."""
    names = list(vocabulary)
    known = set(names)

    @F.pandas_udf("string")
    def pick(values: pd.Series) -> pd.Series:
        def one(v):
            if v is None or v in known or not names:
                return v
            scores = [indel_ratio(v, n) for n in names]
            top = max(range(len(names)), key=lambda i: (scores[i], -i))
            return names[top] if scores[top] > MIN_SCORE else v

        return values.map(one)

    return pick(value)


def best_levenshtein(value: Column, vocabulary: Sequence[str]) -> Column:
    """The same with edit-distance similarity, without Python."""
    scored = F.array(
        *[
            F.struct(
                levenshtein_ratio(value, F.lit(n)).alias("score"),
                F.lit(-i).alias("order"),
                F.lit(n).alias("name"),
            )
            for i, n in enumerate(vocabulary)
        ]
    )
    best = F.array_max(scored)
    return (
        F.when(value.isin(*vocabulary), value)
        .when(best["score"] > MIN_SCORE, best["name"])
        .otherwise(value)
    )


def canonicalize(
    df: DataFrame, column: str, vocabulary: Sequence[str], scorer=best_levenshtein
) -> DataFrame:
    """Add ``canonical``. Each distinct value is matched once, whatever its row count."""
    values = df.select(column).distinct().where(F.col(column).isNotNull())
    matched = stored(values.withColumn("canonical", scorer(F.col(column), vocabulary)), "canonical")
    return df.join(matched, column, "left")


def canonical_columns(columns: Sequence[str], vocabulary: Sequence[str]) -> dict[str, str]:
    """Column renames that bring a table to its contract (names only, no data)."""
    out = {}
    known = set(vocabulary)
    for c in columns:
        if c in known or not vocabulary:
            out[c] = c
            continue
        best = max(vocabulary, key=lambda n: indel_ratio(c, n))
        out[c] = best if indel_ratio(c, best) > MIN_SCORE else c
    return out
