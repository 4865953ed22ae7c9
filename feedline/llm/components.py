"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedline.llm.shared import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of each linked node; a component's name is its smallest node.

    Each round links every node with the smallest of its neighbours, first the larger neighbours, then the smaller
    ones, until each node hangs on the smallest of its component.  Neighbours are reduced by aggregation and joined
    back, so a node with very many links is no group in one task.  Links are whole numbers; nulls link nothing.
    """
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.where(u != v).select(F.greatest(u, v).alias("hi"), F.least(u, v).alias("lo")).distinct()
    edges = written(edges, "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least(F.col("hi"), F.min("lo")).alias("least"))
        large = both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        large = written(large.where("hi <> lo").distinct(), "links")
        least = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = large.join(least, "hi")
        hung = small.select(F.col("lo").alias("hi"), F.col("least").alias("lo")).unionByName(least.select("hi", F.col("least").alias("lo")))
        edges = written(hung.where("hi <> lo").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
