"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``edges`` (u long, v long).

    Each round hangs neighbours onto smaller ones, first the larger then the smaller neighbours of every node; the
    number of rounds grows with the logarithm of the component's width, the number of edges never grows, and each
    round is one small table in the shared folder.  Loops and repeated edges are allowed.
    """
    edges = common.materialise(edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = common.materialise(small.where("u != v").distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(
        roots.select("node", F.col("node").alias("component"))).groupBy("node").agg(
        F.min("component").alias("component"))
