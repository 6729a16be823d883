"""Connected components by alternating large-star / small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Stages


def _hook(edges: DataFrame, mins: DataFrame) -> DataFrame:
    """Every neighbour of u now points at u's smallest neighbour. ``mins`` is
    stored, one row per node, so adaptive execution can split a hot node."""
    return edges.join(mins, "u")


def _is_star(edges: DataFrame) -> bool:
    """Does every node point at one other node, which itself points nowhere?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    per = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return per.agg(F.count_if((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0)))).first()[0] == 0


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over the links.

    Only nodes with a link to another node appear. Each half of a round stores
    its edges, deletes those before and ends the search when they are stars; nothing but that answer
    reaches the driver. Rounds grow with the logarithm of the number of nodes.
    """
    stages = Stages(links.sparkSession)
    edges = stages.put(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter("u <> v").distinct(), "cc-0")
    for half in range(2 * max_rounds):
        if _is_star(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        if half % 2 == 0:
            # Large star: neighbours above u go to the smallest of u and its neighbours.
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            mins = stages.put(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-m")
            star = _hook(both, mins).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            # Small star: what is below u goes to the smallest of it, and so does u.
            mins = stages.put(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-m")
            star = _hook(edges, mins).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(
                mins.select("u", F.col("m").alias("v")))
        edges = stages.put(star.distinct(), f"cc-{half + 1}")
        stages.drop(f"cc-{half}", "cc-m")
    raise RuntimeError("components did not settle")
