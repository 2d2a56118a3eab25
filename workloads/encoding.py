"""Encoding, scaling and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.operators import encode as e
from tabularium.session import new_path, stored
from workloads.base import GAPPY, gappy, query, sales

TRAIN_SQL = "yr <= 1999"
PRIORITY = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 0}
ORDINAL = """CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4
  WHEN '3-MEDIUM' THEN 3 ELSE 0 END AS INTEGER)"""
SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # after the first, AUTOMOBILE


def train():
    return F.col("yr") <= 1999


def target_sql(col: str, alias: str) -> str:
    """Smoothed target statistics of one column as two CTEs."""
    return f"""{alias}_g AS (SELECT sum(price) / count(price) AS gm FROM gappy WHERE {TRAIN_SQL}),
{alias} AS (SELECT {col} AS cat, w * m + (1 - w) * gm AS enc, gm FROM (
  SELECT {col}, avg(price) AS m, 1 / (1 + exp(-(count(price) - 5) / 10.0)) AS w
  FROM gappy WHERE {TRAIN_SQL} GROUP BY {col}), {alias}_g)"""


@query("target_encode", f"""WITH {GAPPY}, {target_sql('hood', 't')}
SELECT l_orderkey, l_linenumber, gappy.hood AS label, round(coalesce(enc, t_g.gm), 6) AS hood
FROM gappy LEFT JOIN t ON t.cat = gappy.hood, t_g""")
def target_encode(spark, d):
    s = sales(spark, d, "hood").select("l_orderkey", "l_linenumber", "hood", "price", "yr")
    fitted = e.fit_target(s.where(train()), ["hood"], "price")
    out = e.apply_target(s.withColumn("label", F.col("hood")), fitted, "hood")
    return out.select("l_orderkey", "l_linenumber", "label", F.round("hood", 6).alias("hood"))


@query("ordinal_encode", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, {ORDINAL} AS priority FROM gappy""")
def ordinal_encode(spark, d):
    s = sales(spark, d, "orders")
    return s.select(
        "l_orderkey", "l_linenumber", e.ordinal_code("o_orderpriority", PRIORITY).alias("priority")
    )


@query("one_hot", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS DOUBLE) AS c_mktsegment_{s}" for s in SEGMENTS
) + ", CAST(coalesce(flag = 'N', false) AS DOUBLE) AS flag_N, "
    "CAST(coalesce(flag = 'R', false) AS DOUBLE) AS flag_R FROM gappy")
def one_hot(spark, d):
    s = gappy(sales(spark, d, "hood")).select(
        "l_orderkey", "l_linenumber", "c_mktsegment", "flag", "yr"
    )
    categories = e.fit_categories(s.where(train()), ["c_mktsegment", "flag"])
    return e.one_hot(s, categories).drop("yr")


@query("log_transform", """SELECT l_orderkey, l_linenumber, round(ln(1 + l_extendedprice), 8) AS log_price,
  round(ln(1 + l_quantity), 8) AS log_qty,
  CASE WHEN l_quantity < 20 THEN round(exp(l_quantity) - 1, 2) ELSE l_quantity END AS back FROM lineitem""")
def log_transform(spark, d):
    from tabularium.functions.numeric import unlog

    s = sales(spark, d).select(
        "l_orderkey", "l_linenumber", "price", F.col("l_quantity").alias("qty"),
        unlog(F.col("l_quantity")).alias("back"),
    )
    out = e.log_transform(s, ["price", "qty", "absent"])
    return out.select(
        "l_orderkey",
        "l_linenumber",
        F.round("log_price", 8).alias("log_price"),
        F.round("log_qty", 8).alias("log_qty"),
        F.when(F.col("back") == F.floor("back"), F.col("back")).otherwise(F.round("back", 2)).alias("back"),
    )


SCALED = ["price", "l_tax", "qty", "l_linenumber"]


def scale_sql(columns, where):
    """Robust parameters of several columns as one wide CTE."""
    picks = []
    for c in columns:
        picks.append(f"median({c}) AS {c}_m")
        iqr = f"(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
        picks.append(f"CASE WHEN {iqr} = 0 THEN 1.0 ELSE {iqr} END AS {c}_s")
    return f"SELECT {', '.join(picks)} FROM {where}"


def scaled_sql(c):
    return f"round((coalesce({c}, {c}_m) - {c}_m) / {c}_s, 6) AS {c}"


@query("robust_scale", f"""WITH {GAPPY}, r AS ({scale_sql(SCALED, 'gappy WHERE ' + TRAIN_SQL)})
SELECT l_orderkey, l_partkey, {', '.join(scaled_sql(c) for c in SCALED)} FROM gappy, r""")
def robust_scale(spark, d):
    s = gappy(sales(spark, d, "orders"))
    fitted = e.fit_robust(s.where(train()), SCALED)
    out = e.apply_robust(s, fitted, SCALED)
    return out.select("l_orderkey", "l_partkey", *[F.round(c, 6).alias(c) for c in SCALED])


SPEC = e.EncodingSpec(
    target="price",
    ordinal={"o_orderpriority": PRIORITY},
    target_encoded=("hood", "p_brand"),
    one_hot=("c_mktsegment", "flag"),
    log=("price", "p_retailprice"),
    ids=("l_orderkey", "l_partkey"),
    keep=("yr",),
    drop=(),
    labels={"hood": "hood_label"},
)
RAW = [
    "l_orderkey", "l_partkey", "yr", "price", "qty", "l_tax", "p_size", "p_retailprice", "hood",
    "p_brand", "c_mktsegment", "flag", "o_orderpriority", "extra",
]


def raw(spark, d):
    """The joined table, written once: fitting reads it several times."""
    return stored(gappy(sales(spark, d, "hood", "part", "heavy")).select(*RAW), "encoding-input")


MATRIX_SCALED = ["qty", "l_tax", "p_size", "hood", "p_brand", "o_orderpriority"]
MATRIX = f"""WITH {GAPPY}, {target_sql('hood', 'th')}, {target_sql('p_brand', 'tb')},
enc AS (SELECT l_orderkey, l_partkey, yr, price, qty, l_tax, p_size, p_retailprice, c_mktsegment, flag,
  gappy.hood AS hood_label, coalesce(th.enc, th_g.gm) AS hood, coalesce(tb.enc, tb_g.gm) AS p_brand,
  {ORDINAL} AS o_orderpriority
  FROM gappy LEFT JOIN th ON th.cat = gappy.hood LEFT JOIN tb ON tb.cat = gappy.p_brand, th_g, tb_g),
r AS ({scale_sql(MATRIX_SCALED, 'enc WHERE ' + TRAIN_SQL)}),
matrix AS (SELECT l_orderkey, l_partkey, yr, hood_label,
  {', '.join(scaled_sql(c) for c in MATRIX_SCALED)},
  {', '.join(f"CAST(c_mktsegment = '{s}' AS DOUBLE) AS c_mktsegment_{s}" for s in SEGMENTS)},
  CAST(coalesce(flag = 'N', false) AS DOUBLE) AS flag_N,
  CAST(coalesce(flag = 'R', false) AS DOUBLE) AS flag_R,
  round(ln(1 + price), 8) AS log_price, round(ln(1 + p_retailprice), 8) AS log_p_retailprice
  FROM enc, r)
"""


def rounded(df):
    return df.withColumns(
        {
            **{c: F.round(c, 6) for c in MATRIX_SCALED},
            **{c: F.round(c, 8) for c in ("log_price", "log_p_retailprice")},
        }
    )


@query("encode_matrix", MATRIX + "SELECT * FROM matrix")
def encode_matrix(spark, d):
    matrix, _ = e.encode_matrix(raw(spark, d), SPEC, train())
    return rounded(matrix)


@query("serving_features", MATRIX + """SELECT * EXCLUDE (qty, log_price), 0.0::DOUBLE AS qty
FROM matrix WHERE yr > 1999""")
def serving_features(spark, d):
    """Rows after the training years, without the quantity, through saved parameters."""
    whole = raw(spark, d)
    path = new_path(spark, "encoder")
    e.fit(whole, SPEC, train()).save(path)
    requests = whole.where(F.col("yr") > 1999).drop("qty", "price")
    served = e.Encoder.load(spark, path, SPEC).apply(requests)
    return rounded(served.withColumn("log_price", F.lit(0.0))).drop("log_price")


@query("params_roundtrip", f"""WITH {GAPPY}, r AS ({scale_sql(SCALED, 'gappy WHERE ' + TRAIN_SQL)})
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({c}_m, 6) AS center, round({c}_s, 6) AS scale FROM r" for c in SCALED
))
def params_roundtrip(spark, d):
    s = gappy(sales(spark, d, "orders"))
    saved = e.save_params(e.fit_robust(s.where(train()), SCALED))
    return saved.select(
        "feature", F.round("center", 6).alias("center"), F.round("scale", 6).alias("scale")
    )
