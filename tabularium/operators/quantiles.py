"""Exact quantiles of all groups at once by narrowing, with one plan for tables of any size.

A wanted quantile lies at one or two ranks of its group. The first pass takes the size, least and
greatest value of every group; each further pass cuts the range that still holds a wanted rank into
``SLOTS`` cells of equal width and takes the size, least and greatest value of every cell, for all
groups and ranks in one aggregate. The cell that holds the rank becomes the next range. A rank is found
once its range has a single value or the rank is the first or last of it, which takes two or three
passes for usual data and never more than a handful: a range shrinks by ``SLOTS`` each time.

Rows combine in their tasks, so a pass shuffles at most ``SLOTS`` small rows per task, group and
range, whatever the size of a group; nothing is sampled and no task holds a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import stored

SLOTS = 4096


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    extra: dict[str, Column] | None = None,
    costly: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` per group: keys, ``n`` and one column per name.

    Nulls do not count; a null key is a group. ``extra`` are named aggregates over ``value`` that
    ride along in the first pass. ``costly`` marks an input (a join) that should be written once
    rather than computed for every pass. Without keys there is one row, of nulls for no values.
    """
    keys, extra = list(keys), extra or {}
    present = df.select(*keys, F.col(f"`{value}`").cast("double").alias(value)).where(F.col(f"`{value}`").isNotNull())
    if costly:
        present = stored(present, "quantile-input")
    v = F.col(f"`{value}`")
    groups = present.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"), *[c.alias(k) for k, c in extra.items()]
    )
    groups = stored(groups, "quantile-groups")

    def rank(name: str, side) -> Column:
        return F.struct(F.lit(f"{name}:{side.__name__}").alias("rank"), side(F.lit(float(probs[name])) * (F.col("n") - 1)).alias("r"))

    ranks = F.array(*[rank(name, side) for name in probs for side in (F.floor, F.ceil)])
    state = groups.where("n > 0").select(*keys, F.inline(ranks), "_lo", "_hi", F.lit(0).cast("bigint").alias("_before"), F.col("n").alias("_c"))
    state = state.select(*keys, "rank", "r", "_lo", "_hi", "_before", "_c", _found().alias("found"))
    known = []
    while True:
        known.append(state.where("found IS NOT NULL").select(*keys, "rank", "found"))
        open_ranks = state.where("found IS NULL").drop("found", "_c")
        if open_ranks.isEmpty():
            break
        state = stored(_narrow(present.withColumnRenamed(value, "_v"), open_ranks, keys), "quantile-ranks")  # a row per group and rank
    found = reduce(DataFrame.unionByName, known)
    at = lambda name, side: F.max(F.when(F.col("rank") == f"{name}:{side}", F.col("found")))
    wide = found.groupBy(*keys).agg(*[at(name, side).alias(f"_{name}_{side}") for name in probs for side in ("floor", "ceil")])
    if keys:
        out = null_safe_join(groups, wide, keys)
    else:
        one = wide.select(F.struct(*wide.columns).alias("s")).scalar()
        out = groups.withColumns({c: one[c] for c in wide.columns})
    picked = []
    for name in probs:
        pos = F.lit(float(probs[name])) * (F.col("n") - 1)
        low, high = F.col(f"_{name}_floor"), F.col(f"_{name}_ceil")
        picked.append(F.when(low == high, low).otherwise(low + (high - low) * (pos - F.floor(pos))).alias(name))
    return out.select(*keys, "n", *picked, *extra)


def _found() -> Column:
    """The value at the rank where the range of ``_c`` values after ``_before`` others tells it."""
    lo, hi = F.col("_lo"), F.col("_hi")
    last = F.col("_before") + F.col("_c") - 1
    return F.when((lo == hi) | (F.col("r") == F.col("_before")), lo).when(F.col("r") == last, hi)


def _narrow(present: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """The open ranks with the cell of their range that holds them as their new range."""
    spans = ranks.groupBy(*keys).agg(F.collect_set(F.struct("_lo", "_hi")).alias("_spans"))  # at most two a quantile
    if keys:
        located = null_safe_join(present, spans, keys)
    else:
        located = present.withColumn("_spans", spans.select("_spans").scalar())
    v = F.col("_v")
    within = F.filter("_spans", lambda s: (s["_lo"] <= v) & (v <= s["_hi"]))
    rows = located.select(*keys, "_v", F.inline(within))
    lo, hi = F.col("_lo"), F.col("_hi")
    # Halves cannot overflow where the width does; between infinite ends all else is in the middle.
    halves = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)
    share = F.when(hi - lo == float("inf"), halves).otherwise(F.try_divide(v - lo, hi - lo))
    share = F.nanvl(F.coalesce(share, F.lit(0.5)), F.lit(0.5))
    inner = F.least(F.greatest(F.floor(share * SLOTS), F.lit(0)), F.lit(SLOTS - 1))
    cell = F.when(v == lo, 0).when(v == hi, SLOTS - 1).otherwise(inner)
    cells = rows.groupBy(*keys, "_lo", "_hi", cell.alias("_cell")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
    )
    order = Window.partitionBy(*keys, "_lo", "_hi").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("_upto", F.sum("_c").over(order))  # at most SLOTS rows a range
    both = null_safe_join(ranks, cells, [*keys, "_lo", "_hi"])
    start, end = F.col("_before") + F.col("_upto") - F.col("_c"), F.col("_before") + F.col("_upto")
    hit = both.where((start <= F.col("r")) & (F.col("r") < end))
    hit = hit.select(*keys, "rank", "r", F.col("_from").alias("_lo"), F.col("_to").alias("_hi"), start.alias("_before"), "_c")
    return hit.withColumn("found", _found())


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys where two nulls are equal."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, cond).drop(*[f"_r_{k}" for k in keys])


def with_overall(df: DataFrame, group: str, value: str) -> DataFrame:
    """Every row under its own group and once more under the whole table (``overall`` = true).

    Lets one pass produce the statistics of the groups and of the table.
    """
    kind = dict(df.dtypes)[group]
    both = F.array(
        F.struct(F.lit(False).alias("overall"), F.col(group).alias(group)),
        F.struct(F.lit(True).alias("overall"), F.lit(None).cast(kind).alias(group)),
    )
    return df.select(F.explode(both).alias("g"), value).select("g.*", value)
