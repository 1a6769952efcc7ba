"""Connected components by alternating large-star and small-star steps, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadtime.llm.common import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of an edge; root is the component's smallest node.

    Each step hangs nodes on the smallest neighbour they know. Neighbours are never
    gathered: a step is an aggregate (combined before the shuffle) and a join, which Spark splits where
    a node has very many edges. Steps end when all edges form stars; long chains take about log2 of their length.
    """
    now = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    # a star: each of its nodes hangs on one other, which hangs on none
    while not (now.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
               .union(now.select(F.col("v").alias("n"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
               .groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or hangs = 1 and holds = 1")
               .agg(F.count("*")).first()[0] == 0):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(down.select("u", F.col("m").alias("v")))
        now = cut_lineage(small.distinct(), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
