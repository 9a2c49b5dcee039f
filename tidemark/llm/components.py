"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so a hub with very many neighbours is
a partial aggregate per task, never one list. The edges are rewritten as a table
in the shared folder every round, which cuts the lineage; the number of rounds
grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the (a, b) links; a component is named by its smallest node.

    Null ends and links of a node to itself are left out; no links give no rows.
    """
    links = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = staged(hung.unionByName(smallest.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
