"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialise


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``links``; the component is its smallest node.

    ``links`` has two columns of longs. Null ends, loops and repeated or reversed links count for
    nothing; an empty table gives an empty one. Each round points every node at the smallest
    neighbour of its neighbours, by a count-like aggregate and a join, so that a node with a third
    of the links is combined before the shuffle and split by the skew join. Rounds grow with the
    logarithm of the longest path. Every round is written to the shared folder.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        a.isNotNull() & b.isNotNull() & (a != b)).distinct()
    edges = materialise(edges, name)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialise(small.where("u != v").distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
