"""Connected components of a table of links, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id reachable, itself included.

    Alternates two steps until the edges no longer change: every node hands its larger
    neighbours, then its smaller ones, to the least of its neighbourhood. Minima combine in each
    task, so a node with a third of all links costs one row per task and a join that adaptive
    execution can split. Each round is written to the shared folder.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = stored(ordered, "edges"), None
    while (now := _signature(edges)) != before:
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least).distinct(), "edges")
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
