"""Market analytics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.functions.numeric import band
from tabularium.operators import market as m
from workloads.base import SALES, query, sales, table

NUMERIC = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice", "c_acctbal"]
TIERS = {
    "first": ["NATION_0", "NATION_5", "NATION_10", "NATION_15", "NATION_20"],
    "second": ["NATION_1", "NATION_6", "NATION_11", "NATION_16"],
    "third": ["NATION_2", "NATION_7", "NATION_12"],
    "absent": ["NATION_99"],
}


@query("group_stats", f"""WITH {SALES}
SELECT hood, round(median(price), 4) AS median_price, round(avg(price), 4) AS mean_price,
       round(coalesce(stddev_samp(price), 0), 4) AS std_price, count(price) AS transaction_count,
       round(min(price), 4) AS min_price, round(max(price), 4) AS max_price
FROM sales GROUP BY hood""")
def group_stats(spark, d):
    return m.group_stats(sales(spark, d, "hood", "heavy"), "hood", "price", 4)


@query("market_kpis", f"""WITH {SALES}
SELECT round(median(price), 4) AS median_price, round(avg(price), 4) AS mean_price,
       round(sum(price), 2) AS total_volume, count(price) AS transactions,
       round(stddev_samp(price) / avg(price) * 100, 6) AS cv_pct,
       stddev_samp(price) / avg(price) * 100 < 35 AS stable
FROM sales""")
def market_kpis(spark, d):
    k = m.market_kpis(sales(spark, d), "price")
    return k.select(
        F.round("median_price", 4).alias("median_price"),
        F.round("mean_price", 4).alias("mean_price"),
        F.round("total_volume", 2).alias("total_volume"),
        "transactions",
        F.round("cv_pct", 6).alias("cv_pct"),
        "stable",
    )


@query("top_group_premium", f"""WITH {SALES}, g AS (
  SELECT hood, median(price) AS md FROM sales GROUP BY hood ORDER BY md DESC, hood LIMIT 1),
mk AS (SELECT median(price) AS md FROM sales)
SELECT g.hood AS top_group, round(g.md, 4) AS top_median, round(mk.md, 4) AS market_median,
       round((g.md - mk.md) / mk.md * 100, 6) AS premium_pct FROM g, mk""")
def top_group_premium(spark, d):
    t = m.top_group_premium(sales(spark, d, "hood", "heavy"), "hood", "price")
    return t.select(
        "top_group",
        F.round("top_median", 4).alias("top_median"),
        F.round("market_median", 4).alias("market_median"),
        F.round("premium_pct", 6).alias("premium_pct"),
    )


@query("market_segments", f"""WITH {SALES}, s AS (
  SELECT price, CASE
    WHEN hood IN ('NATION_0','NATION_5','NATION_10','NATION_15','NATION_20') THEN 'first'
    WHEN hood IN ('NATION_1','NATION_6','NATION_11','NATION_16') THEN 'second'
    WHEN hood IN ('NATION_2','NATION_7','NATION_12') THEN 'third'
    WHEN hood IN ('NATION_99') THEN 'absent' END AS segment FROM sales)
SELECT segment, round(sum(price) / 1e6, 6) AS volume_m, count(price) AS units,
       round(median(price), 4) AS median_price
FROM s WHERE segment IS NOT NULL GROUP BY segment""")
def market_segments(spark, d):
    s = m.market_segments(
        sales(spark, d, "hood", "heavy"), "hood", "price", TIERS
    )
    return s.select(
        "segment",
        F.round("volume_m", 6).alias("volume_m"),
        "units",
        F.round("median_price", 4).alias("median_price"),
    )


@query("group_volume", f"""WITH {SALES}, g AS (
SELECT hood, round(median(price), 4) AS median_price, round(avg(price), 4) AS mean_price,
       round(coalesce(stddev_samp(price), 0), 4) AS std_price, count(price) AS transaction_count,
       round(min(price), 4) AS min_price, round(max(price), 4) AS max_price,
       round(sum(price) / 1e6, 4) AS volume_m
FROM sales GROUP BY hood)
SELECT * FROM g""")
def group_volume(spark, d):
    return m.group_volume(sales(spark, d, "hood", "heavy"), "hood", "price")


@query("yearly_trend", f"""WITH {SALES}
SELECT yr, round(median(price), 4) AS median_price, count(price) AS transactions
FROM sales GROUP BY yr""")
def yearly_trend(spark, d):
    t = m.yearly_trend(sales(spark, d, "orders", "heavy"), "yr", "price")
    return t.select("yr", F.round("median_price", 4).alias("median_price"), "transactions")


@query("month_year_pivot", f"""WITH {SALES}
SELECT mo, substr('JanFebMarAprMayJunJulAugSepOctNovDec', mo * 3 - 2, 3) AS month_name,
""" + ",\n".join(
    f'  round(avg(price) FILTER (yr = {y}), 4) AS "{y}"' for y in range(1995, 2002)
) + "\nFROM sales GROUP BY mo")
def month_year_pivot(spark, d):
    return m.month_year_pivot(
        sales(spark, d, "orders"), "yr", "mo", "price", list(range(1995, 2002))
    )


@query("distribution_shape", """WITH q AS (
  SELECT quantile_cont(l_extendedprice, 0.25) AS q25, median(l_extendedprice) AS q50,
         quantile_cont(l_extendedprice, 0.75) AS q75 FROM lineitem)
SELECT round(skewness(l_extendedprice), 8) AS skew, round(any_value(q25), 4) AS q25,
       round(any_value(q75), 4) AS q75, round(any_value(q75 - q25), 4) AS iqr,
       round(count(*) FILTER (l_extendedprice > q75) * 100.0 / count(*), 8) AS luxury_share_pct,
       round(avg(l_extendedprice) - any_value(q50), 4) AS mean_minus_median
FROM lineitem, q""")
def distribution_shape(spark, d):
    # No bound given: takes the two-pass exact quantile plan used for unbounded groups.
    s = m.distribution_shape(sales(spark, d), "price")
    return s.select(
        F.round("skew", 8).alias("skew"),
        F.round("q25", 4).alias("q25"),
        F.round("q75", 4).alias("q75"),
        F.round("iqr", 4).alias("iqr"),
        F.round("luxury_share_pct", 8).alias("luxury_share_pct"),
        F.round("mean_minus_median", 4).alias("mean_minus_median"),
    )


@query("histogram", """WITH r AS (
  SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 60)), 59) AS INTEGER) AS bin,
       count(*) AS n FROM lineitem, r GROUP BY 1)
SELECT CAST(s.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 60 * s.bin, 4) AS bin_start,
       coalesce(c.n, 0) AS n
FROM (SELECT unnest(range(60)) AS bin) s CROSS JOIN r LEFT JOIN c ON c.bin = s.bin""")
def histogram(spark, d):
    h = m.histogram(sales(spark, d), "price", 60)
    return h.select("bin", F.round("bin_start", 4).alias("bin_start"), "n")


@query("box_summary", f"""WITH {SALES}, q AS (
  SELECT hood, min(price) AS q0, quantile_cont(price, 0.25) AS q1, median(price) AS q2,
         quantile_cont(price, 0.75) AS q3, max(price) AS q4 FROM sales GROUP BY hood)
SELECT q.hood, round(any_value(q0), 6) AS q0, round(any_value(q1), 6) AS q1,
       round(any_value(q2), 6) AS q2, round(any_value(q3), 6) AS q3, round(any_value(q4), 6) AS q4,
       round(any_value(q1 - 1.5 * (q3 - q1)), 6) AS low_fence,
       round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS high_fence,
       count(*) FILTER (price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS outliers
FROM q JOIN sales USING (hood) GROUP BY q.hood""")
def box_summary(spark, d):
    b = m.box_summary(
        sales(spark, d, "hood", "heavy"), "hood", "price"
    )
    nums = ["q0", "q1", "q2", "q3", "q4", "low_fence", "high_fence"]
    return b.select("hood", *[F.round(c, 6).alias(c) for c in nums], "outliers")


@query("value_drivers", f"""WITH {SALES}, w AS (SELECT
""" + ",\n".join(f"  corr(price, {c}) AS {c}" for c in NUMERIC) + """ FROM sales),
u AS (UNPIVOT w ON """ + ", ".join(NUMERIC) + """ INTO NAME feature VALUE corr)
SELECT feature, round(corr, 8) AS corr, round(abs(corr), 8) AS abs_corr
FROM u ORDER BY abs_corr DESC, feature LIMIT 15""")
def value_drivers(spark, d):
    v = m.value_drivers(sales(spark, d, "hood", "part"), "price", NUMERIC)
    return v.select(
        "feature", F.round("corr", 8).alias("corr"), F.round("abs_corr", 8).alias("abs_corr")
    )


@query("ols_trend", """WITH f AS (
  SELECT regr_slope(p_retailprice, p_size) AS b, regr_intercept(p_retailprice, p_size) AS a,
         CAST(min(p_size) AS DOUBLE) AS lo, CAST(max(p_size) AS DOUBLE) AS hi
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CAST(i AS INTEGER) AS i, round(lo + (hi - lo) * i / 49, 6) AS x,
       round(a + b * (lo + (hi - lo) * i / 49), 6) AS y
FROM f, (SELECT unnest(range(50)) AS i)""")
def ols_trend(spark, d):
    t = m.ols_trend(sales(spark, d, "part"), "p_size", "p_retailprice")
    return t.select("i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("market_filter", f"""WITH {SALES}
SELECT l_orderkey, l_linenumber, hood, yr, price FROM sales
WHERE c_mktsegment = 'BUILDING' AND yr BETWEEN 1996 AND 1998 AND price BETWEEN 20000 AND 60000""")
def market_filter(spark, d):
    return m.market_filter(
        sales(spark, d, "hood"),
        equal={"c_mktsegment": "BUILDING", "hood": "All"},
        between={"yr": (1996, 1998), "price": (20000, 60000)},
    ).select("l_orderkey", "l_linenumber", "hood", "yr", "price")


@query("filter_options", f"""WITH {SALES}
SELECT 'hood' AS field, hood AS option, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi
FROM (SELECT DISTINCT hood FROM sales)
UNION ALL SELECT 'c_mktsegment', c_mktsegment, NULL, NULL
FROM (SELECT DISTINCT c_mktsegment FROM sales)
UNION ALL SELECT 'yr', NULL, CAST(min(yr) AS DOUBLE), CAST(max(yr) AS DOUBLE) FROM sales
UNION ALL SELECT 'price', NULL, min(price), max(price) FROM sales""")
def filter_options(spark, d):
    return m.filter_options(sales(spark, d, "hood"), ["hood", "c_mktsegment"], ["yr", "price"])


@query("seeded_sample", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42')),
         l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000""")
def seeded_sample(spark, d):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return m.seeded_sample(table(spark, d, "lineitem").select(*cols), 1000, 42)


SCORE = 500.0, 20.0, 3.0


def linear_score():
    a, b, c = SCORE
    return F.lit(a) * F.col("l_quantity") + F.lit(b) * F.col("p_size") + F.lit(c) * F.col("p_retailprice")


@query("scenario_grid", """WITH b AS (
  SELECT l_orderkey, l_linenumber, l_quantity, p_size, p_retailprice
  FROM lineitem JOIN part ON l_partkey = p_partkey),
md AS (SELECT median(500.0 * l_quantity + 20.0 * p_size + 3.0 * p_retailprice) AS md FROM b),
g AS (
  SELECT l_orderkey, l_linenumber, 'as_is' AS scenario,
         500.0 * l_quantity + 20.0 * p_size + 3.0 * p_retailprice AS score FROM b
  UNION ALL SELECT l_orderkey, l_linenumber, 'larger',
         500.0 * l_quantity + 20.0 * (p_size + 10) + 3.0 * p_retailprice FROM b
  UNION ALL SELECT l_orderkey, l_linenumber, 'bulk',
         500.0 * (l_quantity * 1.5) + 20.0 * p_size + 3.0 * p_retailprice FROM b)
SELECT l_orderkey, l_linenumber, scenario, round(score, 4) AS score,
       round((score - md) / md * 100, 6) AS vs_median_pct FROM g, md""")
def scenario_grid(spark, d):
    base = sales(spark, d, "part", "heavy").select(
        "l_orderkey", "l_linenumber", "l_quantity", "p_size", "p_retailprice"
    )
    g = m.scenario_grid(
        base,
        {
            "as_is": {},
            "larger": {"p_size": F.col("p_size") + 10},
            "bulk": {"l_quantity": F.col("l_quantity") * 1.5},
        },
        linear_score(),
    )
    return g.select(
        "l_orderkey",
        "l_linenumber",
        "scenario",
        F.round("score", 4).alias("score"),
        F.round("vs_median_pct", 6).alias("vs_median_pct"),
    )


@query("market_position", """SELECT l_orderkey, l_linenumber, l_extendedprice AS price,
  round((l_extendedprice - md) / md * 100, 6) AS position_pct
FROM lineitem, (SELECT median(l_extendedprice) AS md FROM lineitem)""")
def market_position(spark, d):
    p = m.market_position(sales(spark, d), "price")
    return p.select(
        "l_orderkey", "l_linenumber", "price", F.round("position_pct", 6).alias("position_pct")
    )


@query("prediction_band", """SELECT o_orderkey, o_totalprice AS price,
  round(o_totalprice * 0.9, 6) AS low, round(o_totalprice * 1.1, 6) AS high FROM orders""")
def prediction_band(spark, d):
    low, high = band(F.col("o_totalprice"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        F.round(low, 6).alias("low"),
        F.round(high, 6).alias("high"),
    )
