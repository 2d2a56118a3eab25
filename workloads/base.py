"""Registry, table access and the derived sales tables used by the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabularium.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SCHEMAS: dict[str, StructType] = {}  # read from a footer once per table, not once per query
KEYS = {
    "lineitem": ["l_orderkey", "l_partkey"],
    "documents": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL statement where one exists."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str, heavy: bool = False) -> DataFrame:
    """One of the given tables; ``heavy`` spreads a single-file table for costly row work."""
    path = f"{folder}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    df = spark.read.schema(SCHEMAS[path]).parquet(path)
    return spread(df, *KEYS[name]) if heavy else df


def sales(spark: SparkSession, folder: str, *parts: str) -> DataFrame:
    """Line items as sales; ``parts`` names the dimensions a query needs.

    "orders" adds the sale date, "hood" the customer's nation, "part" the product; "heavy"
    spreads the line items first.
    """
    df = table(spark, folder, "lineitem", "heavy" in parts).withColumnRenamed("l_extendedprice", "price")
    if "orders" in parts or "hood" in parts:
        orders = table(spark, folder, "orders")
        df = df.join(orders, df.l_orderkey == orders.o_orderkey)
        df = df.withColumn("yr", F.year("o_orderdate")).withColumn("mo", F.month("o_orderdate"))
    if "hood" in parts:
        customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
        df = df.join(customer, df.o_custkey == customer.c_custkey)
        df = df.join(nation, df.c_nationkey == nation.n_nationkey)
        df = df.withColumnRenamed("n_name", "hood")
    if "part" in parts:
        part = table(spark, folder, "part")
        df = df.join(part, df.l_partkey == part.p_partkey)
    return df


def gappy(df: DataFrame) -> DataFrame:
    """Sales with planted gaps: quantity, return flag and a mostly missing extra column."""
    return (
        df.withColumn("qty", F.when(F.col("l_partkey") % 7 != 0, F.col("l_quantity")))
        .withColumn("flag", F.when(F.col("l_suppkey") % 11 != 0, F.col("l_returnflag")))
        .withColumn("extra", F.when(F.col("l_partkey") % 5 == 0, F.col("l_linestatus")))
    )


# The same derived tables for the SQL side.
SALES = """sales AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
         l.l_extendedprice AS price, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
         o.o_orderpriority, o.o_orderdate, CAST(year(o.o_orderdate) AS INTEGER) AS yr,
         CAST(month(o.o_orderdate) AS INTEGER) AS mo, n.n_name AS hood, c.c_mktsegment,
         c.c_acctbal, p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

GAPPY = SALES + """, gappy AS (
  SELECT *, CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END AS qty,
         CASE WHEN l_suppkey % 11 <> 0 THEN l_returnflag END AS flag,
         CASE WHEN l_partkey % 5 = 0 THEN l_linestatus END AS extra
  FROM sales)"""
