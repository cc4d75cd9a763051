"""Connected components of a link table by alternating stars; no link or component visits the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): every node of the links (a, b) with the smallest node reachable from it.

    Large star: each node passes its smallest neighbour on to its larger neighbours; small star: to its smaller ones
    and itself.  Both are a minimum per node, combined before the shuffle, and a join back, so a hub with any number of
    neighbours is never gathered.  The links become one star per component in a logarithmic number of rounds.
    """
    edges = scratch.store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .filter("u <> v").distinct(), f"{name}-links")
    seen, turn = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").unionByName(
            low.select("u", F.col("low").alias("v"))).distinct()
        edges = scratch.store(small, f"{name}-{turn}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen, turn = now, turn + 1
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
