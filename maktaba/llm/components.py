"""Connected components of an edge table, by alternating large-star and small-star rounds on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame, *, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the least node reachable) for every node of the edges. Rows with a = b or nulls are left out.

    Each round links a node's neighbours to the least of them; the number of rounds grows with the logarithm of the
    longest path. Rounds end on a written table, so that lineage stays short and a lost executor costs one round.
    """
    now = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while (mark := now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) != before:
        before = mark
        # Large star: each neighbour above a node goes to the least of the node and its neighbours.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = now.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: each neighbour below a node, and the node, go to the least of those neighbours.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        now = staged(large.join(least, "u").select(pair.alias("p")).select("p.u", "p.v").filter("u <> v").distinct(), "edges")
    tops = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(tops)
