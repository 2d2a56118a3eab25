"""Anomaly detection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.operators import anomaly as a
from tabularium.operators import clean as c
from tabularium.operators import forest
from tabularium.plans.summary import RunSummary, null_cells
from tabularium.session import literal_table
from workloads.base import GAPPY, gappy, query, sales

FEATURES = ["price", "l_quantity", "l_tax"]


def planted(spark, d, *parts):
    """Sales with extreme prices planted on some orders and a score from a fixed expression."""
    s = sales(spark, d, *parts).withColumn(
        "price",
        F.when(F.col("l_orderkey") % 97 == 0, F.col("price") * 50).otherwise(F.col("price")),
    )
    return s.withColumn("score", (F.col("l_partkey") % 23 - 12) / F.lit(25.0)).withColumn(
        "forest_flag", F.col("score") < -0.2
    )


PLANTED = """planted AS (SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 50
    ELSE l_extendedprice END AS l_extendedprice), (l_partkey % 23 - 12) / 25.0::DOUBLE AS score,
  (l_partkey % 23 - 12) / 25.0::DOUBLE < -0.2 AS forest_flag FROM lineitem),
mo AS (SELECT avg(l_extendedprice) AS m0, stddev_pop(l_extendedprice) AS s0,
  avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_tax) AS m2, stddev_pop(l_tax) AS s2 FROM planted),
z AS (SELECT *, abs(l_extendedprice - m0) / s0 AS z0, abs(l_quantity - m1) / s1 AS z1,
  abs(l_tax - m2) / s2 AS z2 FROM planted, mo),
flagged AS (SELECT *, greatest(z0, z1, z2) AS max_abs_z, greatest(z0, z1, z2) > 3.5 AS z_flag FROM z),
sev AS (SELECT *, CASE WHEN NOT (forest_flag OR z_flag) THEN 'NONE'
    WHEN forest_flag AND z_flag AND score < -0.3 THEN 'HIGH'
    WHEN forest_flag <> z_flag OR (score >= -0.3 AND score < -0.1) THEN 'MEDIUM'
    ELSE 'LOW' END AS anomaly_severity FROM flagged)"""


def combined(spark, d):
    return a.combine(a.zscore_flags(planted(spark, d), FEATURES), "forest_flag", "z_flag", "score")


@query("zscore_flags", f"""WITH {PLANTED}
SELECT l_orderkey, l_linenumber, round(max_abs_z, 6) AS max_abs_z, z_flag FROM flagged""")
def zscore_flags(spark, d):
    z = a.zscore_flags(planted(spark, d), FEATURES)
    return z.select("l_orderkey", "l_linenumber", F.round("max_abs_z", 6).alias("max_abs_z"), "z_flag")


@query("anomaly_severity", f"""WITH {PLANTED}
SELECT l_orderkey, l_linenumber, forest_flag OR z_flag AS anomaly_flagged, anomaly_severity FROM sev""")
def anomaly_severity(spark, d):
    return combined(spark, d).select(
        "l_orderkey", "l_linenumber", "anomaly_flagged", "anomaly_severity"
    )


@query("anomaly_methods", f"""WITH {PLANTED}
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN forest_flag THEN 'isolation_forest' END,
  CASE WHEN z_flag THEN 'z_score' END) AS methods FROM sev WHERE forest_flag OR z_flag""")
def anomaly_methods(spark, d):
    hits = combined(spark, d).where("anomaly_flagged")
    return hits.select("l_orderkey", "l_linenumber", F.concat_ws(",", "methods").alias("methods"))


@query("anomaly_detail", f"""WITH {PLANTED}
SELECT l_orderkey, l_linenumber, 'price' AS feature, l_extendedprice AS value, round(z0, 3) AS z_score,
  z0 > 3.5 AS is_outlier_zscore, forest_flag AS is_outlier_iforest FROM sev WHERE forest_flag OR z_flag
UNION ALL SELECT l_orderkey, l_linenumber, 'l_quantity', l_quantity, round(z1, 3), z1 > 3.5, forest_flag
  FROM sev WHERE forest_flag OR z_flag
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax + 0.0, round(z2, 3), z2 > 3.5, forest_flag
  FROM sev WHERE forest_flag OR z_flag""")
def anomaly_detail(spark, d):
    hits = a.details(combined(spark, d), FEATURES, "forest_flag").where("anomaly_flagged")
    long = hits.select(
        "l_orderkey", "l_linenumber", F.explode("anomalous_features").alias("feature", "detail")
    )
    return long.select("l_orderkey", "l_linenumber", "feature", "detail.*")


@query("anomaly_summary", f"""WITH {PLANTED}
SELECT count(*) FILTER (forest_flag OR z_flag) AS total_flagged,
  round(count(*) FILTER (forest_flag OR z_flag) * 100.0::DOUBLE / count(*), 2) AS pct_of_dataset,
  count(*) FILTER (forest_flag) AS isolation_forest_flags, count(*) FILTER (z_flag) AS zscore_flags,
  count(*) FILTER (forest_flag AND z_flag) AS both_methods_flags,
  count(*) FILTER (anomaly_severity = 'HIGH') AS high_severity FROM sev""")
def anomaly_summary(spark, d):
    return a.summary(combined(spark, d), "forest_flag", "z_flag", "anomaly_severity")


@query("flag_union", f"""WITH {PLANTED}
SELECT l_orderkey, l_linenumber, l_partkey FROM sev WHERE forest_flag OR z_flag""")
def flag_union(spark, d):
    return a.either(combined(spark, d), ["forest_flag", "z_flag"]).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query("flag_intersect", f"""WITH {PLANTED}
SELECT l_orderkey, l_linenumber, l_partkey FROM sev WHERE forest_flag AND z_flag""")
def flag_intersect(spark, d):
    return a.every(combined(spark, d), ["forest_flag", "z_flag"]).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query("isolation_forest")
def isolation_forest(spark, d):
    cols = ["l_orderkey", "l_linenumber", "price", "l_quantity", "l_tax"]
    out = forest.isolation_forest(
        planted(spark, d, "heavy").select(*cols), FEATURES
    )
    return out.select(*cols, "iso_score", "iso_flag")


@query("quality_flags", f"""WITH {PLANTED}, q AS (
  SELECT l_orderkey, l_linenumber, l_partkey % 7 = 0 AS missing_imputed, forest_flag OR z_flag AS anomaly_flagged,
    anomaly_severity, l_quantity > 40 AND l_extendedprice < 20000 AS artifact_flag FROM sev)
SELECT *, 'run-1' AS pipeline_run_id, 'impute,flag' AS transformation_steps FROM q""")
def quality_flags(spark, d):
    from tabularium.operators.history import quality_record

    out = quality_record(
        combined(spark, d),
        imputed=F.col("l_partkey") % 7 == 0,
        artifact=(F.col("l_quantity") > 40) & (F.col("price") < 20000),
        run_id="run-1",
        steps=["impute", "flag"],
    )
    return out.select(
        "l_orderkey",
        "l_linenumber",
        "quality_flags.missing_imputed",
        "quality_flags.anomaly_flagged",
        "quality_flags.anomaly_severity",
        "quality_flags.artifact_flag",
        "lineage.pipeline_run_id",
        F.concat_ws(",", "lineage.transformation_steps").alias("transformation_steps"),
    )


def small_forest():
    """Two literal trees over FEATURES: (tree, node, feature, threshold, left, right, path)."""
    return [
        (0, 0, 0, 40000.0, 1, 2, 0.0), (0, 1, 1, 25.5, 3, 4, 0.0), (0, 2, -1, 0.0, -1, -1, 1.0),
        (0, 3, -1, 0.0, -1, -1, 4.5), (0, 4, 2, 0.045, 5, 6, 0.0), (0, 5, -1, 0.0, -1, -1, 5.25), (0, 6, -1, 0.0, -1, -1, 3.75),
        (1, 0, 2, 0.015, 1, 2, 0.0), (1, 1, -1, 0.0, -1, -1, 2.5), (1, 2, 0, 250000.0, 3, 4, 0.0),
        (1, 3, -1, 0.0, -1, -1, 6.125), (1, 4, -1, 0.0, -1, -1, 2.0),
    ]


_NODES = ", ".join(str(n) for n in small_forest())


@query("forest_scores", f"""WITH RECURSIVE {PLANTED},
nd(tree, node, feature, cut, l, r, path) AS (VALUES {_NODES}),
x AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, [l_extendedprice, l_quantity, l_tax] AS v FROM planted),
walk AS (SELECT rid, v, tree, node FROM x, (SELECT DISTINCT tree, 0 AS node FROM nd)
  UNION ALL SELECT w.rid, w.v, w.tree, CASE WHEN w.v[nd.feature + 1] <= nd.cut THEN nd.l ELSE nd.r END
  FROM walk w JOIN nd USING (tree, node) WHERE nd.feature >= 0),
p AS (SELECT rid, sum(path) AS path FROM walk JOIN nd USING (tree, node) WHERE nd.feature < 0 GROUP BY rid)
SELECT l_orderkey, l_linenumber, round(-pow(2.0::DOUBLE, -(path / 2) / (2.0::DOUBLE * (ln(255.0::DOUBLE) + 0.5772156649015329) - 2.0::DOUBLE * 255 / 256)), 9) AS raw_score
FROM x JOIN p USING (rid)""")
def forest_scores(spark, d):
    """The walk of every row through given trees; 256 rows a tree, as far as the table has them."""
    nodes = literal_table(spark, small_forest(), ["tree", "node", "feature", "threshold", "left", "right", "path"])
    out = forest.raw_scores(planted(spark, d), nodes, FEATURES)
    return out.select("l_orderkey", "l_linenumber", F.round("raw_score", 9).alias("raw_score"))


@query("run_summary", f"""WITH {GAPPY}, i AS (SELECT *, CASE WHEN l_orderkey % 97 = 0 THEN price * 50 ELSE price END AS paid FROM gappy),
c AS (SELECT * REPLACE (coalesce(flag, 'unknown') AS flag) FROM i WHERE qty IS NOT NULL AND NOT (l_discount < 0.02 AND l_tax > 0.07)),
m AS (SELECT avg(paid) AS m0, stddev_pop(paid) AS s0, avg(paid / qty) AS m1, stddev_pop(paid / qty) AS s1 FROM c),
z AS (SELECT greatest(abs(paid - m0) / s0, abs(paid / qty - m1) / s1) > 3.5 AS z FROM c, m),
s AS (SELECT 1 AS position, 'ingestion_agent' AS stage, (SELECT count(*) FROM i) AS rows_in, (SELECT count(*) FROM i) AS rows_out,
    (SELECT sum(CASE WHEN qty IS NULL THEN 1 ELSE 0 END + CASE WHEN flag IS NULL THEN 1 ELSE 0 END + CASE WHEN extra IS NULL THEN 1 ELSE 0 END) FROM i) AS null_cells, NULL AS flagged
  UNION ALL SELECT 2, 'cleaning_agent', (SELECT count(*) FROM i), (SELECT count(*) FROM c), (SELECT count(*) FROM c WHERE extra IS NULL), NULL
  UNION ALL SELECT 3, 'feature_agent', (SELECT count(*) FROM c), (SELECT count(*) FROM c), (SELECT count(*) FROM c WHERE extra IS NULL), NULL
  UNION ALL SELECT 4, 'anomaly_agent', (SELECT count(*) FROM c), (SELECT count(*) FROM c), NULL, (SELECT count(*) FROM z WHERE z))
SELECT 'sales' AS run_id, CAST(position AS INTEGER) AS position, stage, rows_in, rows_out, rows_in - rows_out AS rows_dropped,
  CAST(null_cells AS BIGINT) AS null_cells, CAST(flagged AS BIGINT) AS flagged FROM s""")
def run_summary(spark, d):
    """Ingestion, cleaning, features and anomaly flags of all sales, with what each stage did."""
    run = RunSummary(spark, "sales")
    paid = F.when(F.col("l_orderkey") % 97 == 0, F.col("price") * 50).otherwise(F.col("price"))
    gaps = ["qty", "flag", "extra"]
    raw = gappy(sales(spark, d, "hood", "part")).withColumn("paid", paid)
    raw = run.stage("ingestion_agent", raw, null_cells=null_cells(raw, gaps))
    artifact = (F.col("l_discount") < 0.02) & (F.col("l_tax") > 0.07)
    clean = c.drop_required_nulls(c.flag_artifacts(raw, artifact, "untaxed discount", remove=True), ["qty"])
    clean = c.fill_constants(clean, {"flag": "unknown"})
    clean = run.stage("cleaning_agent", clean, null_cells=null_cells(clean, gaps))
    made = clean.withColumn("unit_price", F.col("paid") / F.col("qty"))
    made = run.stage("feature_agent", made, null_cells=null_cells(made, gaps))
    run.stage("anomaly_agent", a.zscore_flags(made, ["paid", "unit_price"]), flagged=F.count_if("z_flag"))
    return run.table()
