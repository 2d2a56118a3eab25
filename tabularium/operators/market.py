"""Market analytics: group statistics, distribution, trend, drivers and scenarios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.numeric import pct_over, sample_skewness, variation_pct
from tabularium.operators.quantiles import quantiles, with_overall
from tabularium.session import stored
from tabularium.vocabulary import MONTH_NAMES, R2_BANDS, STABLE_VARIATION_PCT


def market_filter(
    df: DataFrame,
    equal: Mapping[str, Any] | None = None,
    between: Mapping[str, tuple[Any, Any]] | None = None,
) -> DataFrame:
    """Equality filters ("All" means no filter) and inclusive ranges."""
    for col, value in (equal or {}).items():
        if value != "All":
            df = df.where(F.col(col) == value)
    for col, (lo, hi) in (between or {}).items():
        df = df.where(F.col(col).between(lo, hi))
    return df


def filter_options(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Distinct values of each categorical column and the bounds of each numeric one.

    One scan: the columns are unpivoted inside the row and combined before the shuffle.
    """
    def cell(c: str, option: Column, value: Column) -> Column:
        return F.struct(
            F.lit(c).alias("field"), option.cast("string").alias("option"), value.cast("double").alias("v")
        )

    none = F.lit(None)
    cells = [cell(c, F.col(c), none) for c in categorical] + [cell(c, none, F.col(c)) for c in numeric]
    return (
        df.select(F.explode(F.array(*cells)).alias("o"))
        .select("o.*")
        .where(F.col("option").isNotNull() | F.col("field").isin(*numeric))
        .groupBy("field", "option")
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    )


def group_stats(
    df: DataFrame, group: str, price: str, digits: int = 2, volume: bool = False
) -> DataFrame:
    """Median, mean, deviation, count and range of the price per group, highest median first.

    ``volume`` adds the traded volume in millions, from the sum of the prices.
    """
    joined = quantiles(
        df,
        [group],
        price,
        {"median_price": 0.5},
        extra={
            "mean_price": F.avg(price),
            "std_price": F.stddev_samp(price),
            "min_price": F.min(price),
            "max_price": F.max(price),
            **({"volume_m": F.sum(price) / 1e6} if volume else {}),
        },
        costly=True,
    ).withColumnRenamed("n", "transaction_count")

    def money(c: str) -> Column:
        return F.round(F.coalesce(F.col(c), F.lit(0.0)), digits).alias(c)

    return joined.select(
        group,
        money("median_price"),
        money("mean_price"),
        money("std_price"),
        "transaction_count",
        money("min_price"),
        money("max_price"),
        *([F.round("volume_m", 4).alias("volume_m")] if volume else []),
    ).orderBy(F.desc("median_price"), group)


def group_volume(
    df: DataFrame, group: str, price: str
) -> DataFrame:
    """Group statistics plus the traded volume in millions."""
    return group_stats(df, group, price, digits=4, volume=True)


def market_kpis(df: DataFrame, price: str) -> DataFrame:
    """Median, mean, total, variation and the stable-market flag in one row."""
    return quantiles(
        df,
        [],
        price,
        {"median_price": 0.5},
        extra={
            "mean_price": F.avg(price),
            "total_volume": F.sum(price),
            "cv_pct": variation_pct(price),
        },
    ).select(
        "median_price",
        "mean_price",
        "total_volume",
        F.col("n").alias("transactions"),
        "cv_pct",
        (F.col("cv_pct") < STABLE_VARIATION_PCT).alias("stable"),
    )


def top_group_premium(
    df: DataFrame, group: str, price: str
) -> DataFrame:
    """The group with the highest median and its premium over the market median."""
    medians = quantiles(
        with_overall(df, group, price), ["overall", group], price, {"m": 0.5}, costly=True,
    )
    own = ~F.col("overall")
    return medians.agg(
        F.max_by(
            F.struct(F.col(group).alias("g"), F.col("m").alias("m")),
            F.when(own, F.struct("m", F.col(group))),
        ).alias("best"),
        F.max(F.when(F.col("overall"), F.col("m"))).alias("market_median"),
    ).select(
        F.col("best.g").alias("top_group"),
        F.col("best.m").alias("top_median"),
        "market_median",
        pct_over(F.col("best.m"), F.col("market_median")).alias("premium_pct"),
    )


def segment_of(col: Column, segments: Mapping[str, Sequence[str]]) -> Column:
    """Segment name of a value, null when it belongs to none."""
    label = F.lit(None).cast("string")
    for name, members in reversed(list(segments.items())):
        label = F.when(col.isin(*members), F.lit(name)).otherwise(label)
    return label


def market_segments(
    df: DataFrame,
    group: str,
    price: str,
    segments: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Median, volume in millions and count per named segment; empty segments do not appear."""
    labelled = df.withColumn("segment", segment_of(F.col(group), segments)).where(
        F.col("segment").isNotNull()
    )
    q = quantiles(
        labelled, ["segment"], price, {"median_price": 0.5},
        extra={"volume_m": F.sum(price) / 1e6}, costly=True,
    )
    return q.select("segment", "volume_m", F.col("n").alias("units"), "median_price")


def yearly_trend(
    df: DataFrame, year: str, price: str
) -> DataFrame:
    """Median price and count per year."""
    q = quantiles(df, [year], price, {"median_price": 0.5}, costly=True)
    return q.select(year, "median_price", F.col("n").alias("transactions"))


def month_year_pivot(
    df: DataFrame, year: str, month: str, price: str, years: Sequence[int], digits: int = 4
) -> DataFrame:
    """Mean price by month (rows) and year (columns) for a declared list of years."""
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    table = df.groupBy(month).pivot(year, list(years)).agg(F.round(F.avg(price), digits))
    return table.withColumn("month_name", F.element_at(names, F.col(month)))


def distribution_shape(df: DataFrame, price: str) -> DataFrame:
    """Skewness, quartiles, IQR, share above the upper quartile and the mean-median gap."""
    q = (
        quantiles(df, [], price, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
        .select(F.struct("q25", "q50", "q75"))
        .scalar()
    )
    return df.agg(
        sample_skewness(price).alias("skew"),
        F.avg(price).alias("mean_price"),
        F.count(price).alias("n"),
        F.count_if(F.col(price) > q["q75"]).alias("above"),
    ).select(
        "skew",
        q["q25"].alias("q25"),
        q["q75"].alias("q75"),
        (q["q75"] - q["q25"]).alias("iqr"),
        (F.col("above") / F.greatest("n", F.lit(1)) * 100).alias("luxury_share_pct"),
        (F.col("mean_price") - q["q50"]).alias("mean_minus_median"),
    )


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """Equal-width histogram over the value range, empty bins included."""
    r = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    width = (r["hi"] - r["lo"]) / bins
    v = F.col(value)
    slot = F.when(width > 0, F.floor(F.try_divide(v - r["lo"], width))).otherwise(F.lit(0))
    counts = (
        df.where(v.isNotNull())
        .select(F.least(slot, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    slots = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return slots.join(counts, "bin", "left").select(
        "bin",
        (r["lo"] + width * F.col("bin")).alias("bin_start"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def box_summary(
    df: DataFrame, group: str, price: str
) -> DataFrame:
    """Five-number summary, 1.5 IQR fences and outlier count per group, by descending median."""
    probs = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0}
    q = stored(quantiles(df, [group], price, probs, costly=True), "box").drop("n")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fences = q.withColumn("low_fence", F.col("q1") - reach).withColumn(
        "high_fence", F.col("q3") + reach
    )
    outliers = (
        df.select(group, price)
        .join(fences.select(group, "low_fence", "high_fence"), group)
        .groupBy(group)
        .agg(
            F.count_if(
                (F.col(price) < F.col("low_fence")) | (F.col(price) > F.col("high_fence"))
            ).alias("outliers")
        )
    )
    return fences.join(outliers, group).orderBy(F.desc("q2"), group)


def unpivot_row(row: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    """One wide row of numbers to one (key, value) row per column."""
    pairs = [F.struct(F.lit(n).alias(key), F.col(f"`{n}`").alias(value)) for n in names]
    return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column with the target over complete pairs, in one pass."""
    t = F.col(f"`{target}`").cast("double")
    wide = df.agg(*[F.corr(F.col(f"`{c}`").cast("double"), t).alias(c) for c in columns])
    return unpivot_row(wide, columns, "feature", "corr")


def value_drivers(
    df: DataFrame, target: str, columns: Sequence[str], top: int = 15
) -> DataFrame:
    """Columns with the strongest absolute correlation to the target."""
    return (
        correlations(df, target, columns)
        .withColumn("abs_corr", F.abs("corr"))
        .where(F.col("abs_corr").isNotNull())
        .orderBy(F.desc("abs_corr"), "feature")
        .limit(top)
    )


def ols_trend(df: DataFrame, x: str, y: str, points: int = 50) -> DataFrame:
    """Least-squares line of y on x evaluated on evenly spaced x."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = both.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min(x).cast("double").alias("lo"),
        F.max(x).cast("double").alias("hi"),
    )
    steps = fit.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / max(points - 1, 1)
    return steps.select(
        "i", at.alias("x"), (F.col("intercept") + F.col("slope") * at).alias("y")
    )


def seeded_sample(df: DataFrame, n: int, seed: int) -> DataFrame:
    """At most ``n`` rows in a random order fixed by the seed and the row contents."""
    line = F.concat_ws(
        "|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns], F.lit(str(seed))
    )
    order = F.md5(line)
    return df.orderBy(order, *df.columns).limit(n)


def scenario_grid(
    df: DataFrame, scenarios: Mapping[str, Mapping[str, Column]], score: Column,
) -> DataFrame:
    """Score every row under each scenario and place it against the median of the base scores.

    A scenario replaces attributes by expressions. The scenarios are a fixed short list, so
    they are generated inside the row instead of joined.
    """
    base = df.withColumn("base_score", score)
    market = quantiles(base, [], "base_score", {"m": 0.5}).select("m").scalar()
    changed = sorted({c for changes in scenarios.values() for c in changes})
    variants = [
        F.struct(
            F.lit(name).alias("scenario"),
            *[changes.get(c, F.col(c)).alias(c) for c in changed],
        )
        for name, changes in scenarios.items()
    ]
    kept = [c for c in df.columns if c not in changed]
    grid = df.select(*kept, F.explode(F.array(*variants)).alias("_s")).select(*kept, "_s.*")
    return grid.withColumn("score", score).withColumn("vs_median_pct", pct_over(F.col("score"), market))


def market_position(df: DataFrame, price: str) -> DataFrame:
    """Percent distance of each price from the market median."""
    m = quantiles(df, [], price, {"m": 0.5}).select("m").scalar()
    return df.withColumn("position_pct", pct_over(F.col(price), m))


def r2_band(r2: Column) -> Column:
    """Quality band of a model's R²."""
    low, good = R2_BANDS
    return F.when(r2 < low, "weak").when(r2 < good, "fair").otherwise("good")


def leaderboard(results: DataFrame) -> DataFrame:
    """Models by test R², with the quality band."""
    return results.withColumn("band", r2_band(F.col("test_r2"))).orderBy(
        F.desc("test_r2"), "model_name"
    )


def topk_abs(df: DataFrame, value: str, tie: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest absolute value."""
    return df.orderBy(F.desc(F.abs(value)), tie).limit(k)
