"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm import tables


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); the component
    is named by its smallest node.

    Large-star and small-star steps alternate until the edges stay the same;
    each turn is written to shared storage.  A node with many neighbours is
    combined before the shuffle; its join is split by adaptive execution.
    """
    now = tables.materialize(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours above a node go to the least of its neighbourhood.
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "least").alias("b")).where("a != b").distinct())
        # Small star: a node and its neighbours below it go to the least of them.
        floor = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (large.join(floor, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
                 .unionByName(floor.select("a", F.col("least").alias("b"))).where("a != b").distinct())
        now = tables.materialize(small, "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
