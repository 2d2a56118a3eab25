"""Profiling, cleaning and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.operators import clean as c
from tabularium.operators import features as f
from tabularium.operators import profile as p
from workloads.base import GAPPY, SALES, gappy, query, sales, table

PROFILED = ["l_orderkey", "l_linenumber", "price", "l_discount", "qty", "flag", "extra", "l_linestatus"]
KINDS = {
    "price": "numeric_continuous", "l_discount": "numeric_continuous", "qty": "numeric_discrete",
    "l_orderkey": "numeric_discrete", "l_linenumber": "numeric_discrete",
    "flag": "ordinal_categorical",
}
TRAIN_SQL = "yr <= 1999"


def train():
    return F.col("yr") <= 1999


def profiled(spark, d):
    return gappy(sales(spark, d, "heavy")).select(*PROFILED)


def _profile_sql() -> str:
    lines = []
    for col in PROFILED:
        numeric = col not in ("flag", "extra", "l_linestatus")
        rng = f"CAST(min({col}) AS DOUBLE), CAST(max({col}) AS DOUBLE)" if numeric else "NULL, NULL"
        lines.append(
            f"SELECT '{col}', '{KINDS.get(col, 'nominal_categorical')}', count(*), "
            f"count(*) - count({col}), round((count(*) - count({col})) / count(*), 4), "
            f"count(DISTINCT {col}), (count(*) - count({col})) / count(*) > 0.4, {rng} FROM gappy"
        )
    return (
        f"WITH {GAPPY}, prof(\"column\", kind, total, nulls, null_rate, unique_count, is_structural, "
        "min_value, max_value) AS (" + "\nUNION ALL ".join(lines) + ")\n"
    )


PROFILE = _profile_sql()


@query("column_profile", PROFILE + """SELECT "column", kind, CAST(total AS BIGINT) AS total,
  CAST(nulls AS BIGINT) AS nulls, null_rate, unique_count, is_structural,
  min_value + 0.0 AS min_value, max_value + 0.0 AS max_value FROM prof""")
def column_profile(spark, d):
    return p.column_profile(profiled(spark, d), KINDS)


@query("kind_counts", PROFILE + "SELECT kind, count(*) AS columns FROM prof GROUP BY kind")
def kind_counts(spark, d):
    return p.kind_counts(p.column_profile(profiled(spark, d), KINDS, approx=True))


@query("schema_confidence", PROFILE + """SELECT CAST(sum(total) AS BIGINT) AS cells,
  CAST(sum(CASE WHEN is_structural THEN 0 ELSE nulls END) AS BIGINT) AS unexpected_nulls,
  round(1 - sum(CASE WHEN is_structural THEN 0 ELSE nulls END) / sum(total), 4) AS confidence,
  count(*) FILTER (is_structural) AS structural_columns FROM prof""")
def schema_confidence(spark, d):
    return p.schema_confidence(p.column_profile(profiled(spark, d), KINDS, approx=True))


@query("null_drift", f"""WITH {GAPPY}, r AS (
  SELECT yr, 'qty' AS "column", avg(CASE WHEN qty IS NULL THEN 1.0 ELSE 0 END) AS nr FROM gappy GROUP BY yr
  UNION ALL SELECT yr, 'flag', avg(CASE WHEN flag IS NULL THEN 1.0 ELSE 0 END) FROM gappy GROUP BY yr
  UNION ALL SELECT yr, 'extra', avg(CASE WHEN extra IS NULL THEN 1.0 ELSE 0 END) FROM gappy GROUP BY yr)
SELECT yr, "column", round(nr, 8) AS null_rate,
  round(nr - lag(nr) OVER w, 8) AS vs_previous, round(nr - first(nr) OVER w, 8) AS vs_first
FROM r WINDOW w AS (PARTITION BY "column" ORDER BY yr)""")
def null_drift(spark, d):
    g = gappy(sales(spark, d, "orders"))
    drift = p.null_drift(g, "yr", ["qty", "flag", "extra"])
    return drift.select(
        "yr", "column", *[F.round(x, 8).alias(x) for x in ("null_rate", "vs_previous", "vs_first")]
    )


@query("target_validity", """SELECT count(*) AS total, count(l_extendedprice) AS non_null,
  min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value,
  bool_and(l_extendedprice > 0) AS valid FROM lineitem""")
def target_validity(spark, d):
    return p.target_validity(sales(spark, d), "price")


@query("quality_rules", f"""WITH {GAPPY}, v AS (
  SELECT 'no_null_qty' AS rule, count(*) FILTER (qty IS NULL) AS violations FROM gappy
  UNION ALL SELECT 'positive_price', count(*) FILTER (NOT coalesce(price > 0, false)) FROM gappy
  UNION ALL SELECT 'ships_after_1994', count(*) FILTER (NOT coalesce(yr > 1994, false)) FROM gappy
  UNION ALL SELECT 'price_covers_unit', count(*) FILTER (NOT coalesce(price >= qty * 1000, false)) FROM gappy)
SELECT rule, violations, violations = 0 AS passed FROM v""")
def quality_rules(spark, d):
    rules = {
        "no_null_qty": F.col("qty").isNotNull(),
        "positive_price": F.col("price") > 0,
        "ships_after_1994": F.col("yr") > 1994,
        "price_covers_unit": F.col("price") >= F.col("qty") * 1000,
    }
    return p.check_rules(gappy(sales(spark, d, "orders")), rules)


@query("rename_columns", """SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
  s_nationkey, s_acctbal AS balance FROM supplier""")
def rename_columns(spark, d):
    return p.rename_columns(
        table(spark, d, "supplier"),
        {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_acctbal": "balance"},
    )


@query("select_numeric", "SELECT p_partkey, p_size, p_retailprice FROM part")
def select_numeric(spark, d):
    return p.select_numeric(table(spark, d, "part"))


def artifact():
    return (F.col("qty") > 40) & (F.col("price") < 20000)


@query("artifact_flags", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, price, coalesce(qty > 40 AND price < 20000, false) AS artifact_flag,
  CASE WHEN qty > 40 AND price < 20000 THEN 'large but cheap' END AS artifact_reason FROM gappy""")
def artifact_flags(spark, d):
    flagged = c.flag_artifacts(gappy(sales(spark, d)), artifact(), "large but cheap")
    return flagged.select("l_orderkey", "l_linenumber", "price", "artifact_flag", "artifact_reason")


@query("artifact_removed", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, price FROM gappy WHERE NOT coalesce(qty > 40 AND price < 20000, false)""")
def artifact_removed(spark, d):
    kept = c.flag_artifacts(gappy(sales(spark, d)), artifact(), "large but cheap", remove=True)
    return kept.select("l_orderkey", "l_linenumber", "price")


@query("drop_required_nulls", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, qty, flag FROM gappy WHERE flag IS NOT NULL""")
def drop_required_nulls(spark, d):
    g = gappy(sales(spark, d)).select("l_orderkey", "l_linenumber", "qty", "flag")
    return c.drop_required_nulls(g, ["flag"])


@query("structural_na_fill", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, coalesce(extra, 'None') AS extra, coalesce(flag, 'None') AS flag
FROM gappy""")
def structural_na_fill(spark, d):
    g = gappy(sales(spark, d)).select("l_orderkey", "l_linenumber", "extra", "flag")
    return c.fill_structural(g, ["extra", "flag", "not_there"])


@query("fill_from_column", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, coalesce(qty, p_size) AS qty, p_size FROM gappy""")
def fill_from_column(spark, d):
    g = c.fill_from_column(gappy(sales(spark, d, "part")), "qty", "p_size")
    return g.select("l_orderkey", "l_linenumber", "qty", "p_size")


@query("fill_constants", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, coalesce(qty, 0.0) AS qty, coalesce(flag, 'None') AS flag FROM gappy""")
def fill_constants(spark, d):
    g = gappy(sales(spark, d)).select("l_orderkey", "l_linenumber", "qty", "flag")
    return c.fill_constants(g, {"qty": 0, "flag": "None"})


@query("catchall_median_fill", f"""WITH {GAPPY}, md AS (
  SELECT median(qty) AS q FROM gappy WHERE {TRAIN_SQL})
SELECT l_orderkey, l_linenumber, coalesce(qty, q) AS qty, coalesce(flag, 'None') AS flag,
       coalesce(extra, 'None') AS extra
FROM gappy, md WHERE l_linestatus IS NOT NULL AND NOT coalesce(qty > 40 AND price < 20000, false)""")
def catchall_median_fill(spark, d):
    whole = gappy(sales(spark, d, "orders"))
    kept = c.flag_artifacts(whole, artifact(), "", remove=True)
    filled = c.fill_remaining(
        kept, train(), ["qty", "flag", "extra"], snapshot=whole
    )
    return filled.select("l_orderkey", "l_linenumber", "qty", "flag", "extra")


@query("impute_group_median", f"""WITH {GAPPY}, g AS (
  SELECT hood, median(qty) AS gm FROM gappy WHERE {TRAIN_SQL} GROUP BY hood),
a AS (SELECT median(qty) AS am FROM gappy WHERE {TRAIN_SQL})
SELECT l_orderkey, l_linenumber, gappy.hood, coalesce(qty, gm, am) AS qty
FROM gappy LEFT JOIN g ON g.hood = gappy.hood, a""")
def impute_group_median(spark, d):
    out = c.impute_group_median(
        gappy(sales(spark, d, "hood", "heavy")), "qty", "hood", train()
    )
    return out.select("l_orderkey", "l_linenumber", "hood", "qty")


def dirty_parts(spark, d):
    odd = F.col("p_partkey") % 2 == 1
    return table(spark, d, "part").select(
        "p_partkey",
        F.when(odd, F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).otherwise(F.col("p_name")).alias("p_name"),
        F.when(F.col("p_partkey") % 5 != 0, F.concat(F.col("p_type"), F.lit("\t"))).alias("p_type"),
    )


DIRTY = """dirty AS (SELECT p_partkey,
  CASE WHEN p_partkey % 2 = 1 THEN concat('  ', p_name, ' ') ELSE p_name END AS p_name,
  CASE WHEN p_partkey % 5 <> 0 THEN concat(p_type, chr(9)) END AS p_type FROM part)"""


@query("trim_strings", f"""WITH {DIRTY}
SELECT p_partkey, trim(p_name, ' ' || chr(9)) AS p_name, trim(p_type, ' ' || chr(9)) AS p_type FROM dirty""")
def trim_strings(spark, d):
    return c.trim_strings(dirty_parts(spark, d))


@query("trim_changes", f"""WITH {DIRTY}
SELECT count(*) FILTER (p_name <> trim(p_name, ' ' || chr(9))) AS p_name,
       count(*) FILTER (p_type <> trim(p_type, ' ' || chr(9))) AS p_type FROM dirty""")
def trim_changes(spark, d):
    return c.trim_changes(dirty_parts(spark, d))


@query("cleaning_report", f"""WITH {GAPPY}
SELECT 'extra' AS column_name, 'structural_fill' AS action, 'fill_None' AS method,
       count(*) FILTER (extra IS NULL) AS rows_affected FROM gappy
UNION ALL SELECT 'qty', 'impute', 'group_median_train_only', count(*) FILTER (qty IS NULL) FROM gappy
UNION ALL SELECT 'flag', 'drop_row', 'required_not_null', count(*) FILTER (flag IS NULL) FROM gappy
UNION ALL SELECT 'p_name', 'standardise', 'trim', count(*) FILTER (p_name <> trim(p_name)) FROM gappy
UNION ALL SELECT '*', 'artifact', 'domain_rule', count(*) FILTER (qty > 40 AND price < 20000) FROM gappy""")
def cleaning_report(spark, d):
    return c.cleaning_report(
        gappy(sales(spark, d, "part")),
        structural=["extra"],
        imputed={"qty": "group_median_train_only"},
        required=["flag"],
        trimmed=["p_name"],
        artifact=artifact(),
    )


@query("temporal_split", f"""WITH {SALES}
SELECT l_orderkey, l_linenumber, yr, CASE WHEN yr BETWEEN 1990 AND 1999 THEN 'train'
  WHEN yr = 2000 THEN 'val' WHEN yr = 2001 THEN 'test' END AS split FROM sales""")
def temporal_split(spark, d):
    s = f.temporal_split(sales(spark, d, "orders"), "yr", (1990, 1999), 2000, 2001)
    return s.select("l_orderkey", "l_linenumber", "yr", "split")


SPEC = f.FeatureColumns(
    area=("l_quantity", "p_size", "l_linenumber"),
    porch=("l_quantity", "l_tax", "l_discount", "p_size", "l_linenumber"),
    sold="yr",
    built="built",
    remodelled="remod",
    garage_built="garage",
    full_baths=("l_linenumber", "p_size"),
    half_baths=("l_quantity", "l_linenumber"),
    presence={
        "HasPool": "l_tax", "HasGarage": "l_discount", "HasBasement": "p_size",
        "HasFireplace": "qty",
    },
    quality="l_linenumber",
    condition="p_size",
)


def houses(spark, d):
    g = gappy(sales(spark, d, "orders", "part"))
    return g.withColumns(
        {
            "built": (F.lit(1960) + F.col("l_partkey") % 45).cast("int"),
            "remod": (F.lit(1980) + F.col("l_suppkey") % 25).cast("int"),
            "garage": F.when(
                F.col("l_partkey") % 3 != 0, (F.lit(1970) + F.col("l_orderkey") % 40).cast("int")
            ),
        }
    )


HOUSES = GAPPY + """, houses AS (SELECT *, CAST(1960 + l_partkey % 45 AS INTEGER) AS built,
  CAST(1980 + l_suppkey % 25 AS INTEGER) AS remod,
  CASE WHEN l_partkey % 3 <> 0 THEN CAST(1970 + l_orderkey % 40 AS INTEGER) END AS garage FROM gappy)"""


def _features_sql(age):
    return f"""SELECT l_orderkey, l_linenumber, l_quantity + p_size + l_linenumber AS TotalSF,
  round(l_quantity + l_tax + l_discount + p_size + l_linenumber, 6) AS PorchSF,
  {age.format('built')} AS HouseAge, {age.format('remod')} AS RemodAge,
  coalesce({age.format('garage')}, {age.format('built')}) AS GarageAge,
  l_linenumber + p_size + 0.5 * (l_quantity + l_linenumber) AS TotalBathrooms,
  CAST(l_tax > 0 AS INTEGER) AS HasPool, CAST(l_discount > 0 AS INTEGER) AS HasGarage,
  CAST(p_size > 0 AS INTEGER) AS HasBasement, CAST(coalesce(qty > 0, false) AS INTEGER) AS HasFireplace,
  CAST(built = yr AS INTEGER) AS IsNew, l_linenumber * p_size AS OverallScore FROM houses"""


FEATURES = [
    "TotalSF", "PorchSF", "HouseAge", "RemodAge", "GarageAge", "TotalBathrooms", "HasPool",
    "HasGarage", "HasBasement", "HasFireplace", "IsNew", "OverallScore",
]


@query("features_batch", f"WITH {HOUSES} " + _features_sql("(yr - {})"))
def features_batch(spark, d):
    out = f.engineer(houses(spark, d), SPEC).withColumn("PorchSF", F.round("PorchSF", 6))
    return out.select("l_orderkey", "l_linenumber", *FEATURES)


@query("features_serving", f"WITH {HOUSES} " + _features_sql(
    "CASE WHEN {0} IS NULL THEN NULL ELSE greatest(yr - {0}, 0) END"))
def features_serving(spark, d):
    out = f.engineer(houses(spark, d), SPEC, clamp=True)
    out = out.withColumn("PorchSF", F.round("PorchSF", 6))
    return out.select("l_orderkey", "l_linenumber", *FEATURES)


@query("feature_manifest", f"""WITH {HOUSES}, e AS (
  SELECT price, yr - built AS HouseAge, yr - remod AS RemodAge, l_linenumber * p_size AS OverallScore,
         l_quantity + p_size + l_linenumber AS TotalSF FROM houses)
SELECT 'HouseAge' AS name, 'YrSold - YearBuilt' AS formula, 'Relative age prevents temporal leakage' AS rationale,
  round(corr(HouseAge, price), 4) AS pearson_correlation FROM e
UNION ALL SELECT 'RemodAge', 'YrSold - YearRemod/Add', 'Recency of remodel affects value',
  round(corr(RemodAge, price), 4) FROM e
UNION ALL SELECT 'TotalSF', 'TotalBsmtSF + 1stFlrSF + 2ndFlrSF', 'Combined livable space is primary value driver',
  round(corr(TotalSF, price), 4) FROM e
UNION ALL SELECT 'OverallScore', 'OverallQual * OverallCond', 'Quality × condition interaction',
  round(corr(OverallScore, price), 4) FROM e""")
def feature_manifest(spark, d):
    e = f.engineer(houses(spark, d), SPEC)
    e = e.select("price", "HouseAge", "RemodAge", "TotalSF", "OverallScore")
    return f.feature_manifest(e, "price")


@query("serving_defaults", f"""WITH {HOUSES}, r AS (
  SELECT l_orderkey, l_linenumber, yr, built, CASE WHEN l_partkey % 4 = 0 THEN 0 ELSE remod END AS remod,
         garage FROM houses),
d AS (SELECT *, CASE WHEN remod > 0 THEN remod ELSE built END AS remod2,
             CASE WHEN garage > 0 THEN garage ELSE built END AS garage2 FROM r)
SELECT l_orderkey, l_linenumber, remod2 AS remod, garage2 AS garage,
       greatest(yr - remod2, 0) AS remod_age, greatest(yr - garage2, 0) AS garage_age FROM d""")
def serving_defaults(spark, d):
    r = houses(spark, d).withColumn(
        "remod", F.when(F.col("l_partkey") % 4 == 0, F.lit(0)).otherwise(F.col("remod"))
    )
    r = r.withColumns(
        {"remod": f.default_year("remod", "built"), "garage": f.default_year("garage", "built")}
    )
    return r.select(
        "l_orderkey",
        "l_linenumber",
        "remod",
        "garage",
        F.greatest(F.col("yr") - F.col("remod"), F.lit(0)).alias("remod_age"),
        F.greatest(F.col("yr") - F.col("garage"), F.lit(0)).alias("garage_age"),
    )


@query("request_validation", f"""WITH {GAPPY}, r AS (
  SELECT l_orderkey, l_linenumber, concat_ws(',',
    CASE WHEN NOT coalesce(qty >= 1 AND qty <= 45, false) THEN 'qty' END,
    CASE WHEN NOT coalesce(p_size >= 2, false) THEN 'p_size' END,
    CASE WHEN NOT coalesce(l_tax <= 0.07, true) THEN 'l_tax' END) AS reasons FROM gappy)
SELECT *, reasons = '' AS accepted FROM r""")
def request_validation(spark, d):
    v = f.validate_requests(
        gappy(sales(spark, d, "part")),
        {"qty": (1, 45, True), "p_size": (2, None, True), "l_tax": (None, 0.07, False)},
    )
    return v.select(
        "l_orderkey", "l_linenumber", F.concat_ws(",", "reasons").alias("reasons"), "accepted"
    )
