"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import on_cluster_disk


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; a component's name is its smallest node.

    Each round replaces the links by fewer or shorter ones with the same components, until every
    component is a star around its smallest node. All steps are joins and minimums that combine
    before the shuffle; rounds are cut by reliable checkpoints. Null ends and loops are no links.
    """
    a, b = F.col("a"), F.col("b")
    low = links.filter(a != b).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()
    edges, mark = _settled(low)
    while mark[0]:
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(root, "hi")
        small = moved.select(F.col("m").alias("lo"), F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"))
        kept = moved.filter(F.col("lo") != F.col("m")).select(F.col("m").alias("lo"), "hi")
        after, new_mark = _settled(small.unionByName(kept).distinct())
        if new_mark == mark:
            break
        edges, mark = after, new_mark
    leaves = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return leaves.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links on shared disk, with their number and a checksum that does not depend on order."""
    edges = on_cluster_disk(edges)
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("sum")).first()
    return edges, (row["n"], row["sum"])
