"""Connected components of a graph given as edges, without hubs in one task.

Alternating star steps: in a large step each node passes the least node around it to its larger
neighbours, in a small step to its smaller ones. After a few rounds every component is a star around its
least node. Each round is written to the shared folder. The least nodes are written before they are
joined, so that adaptive execution may split the join of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges(u, v) with u > v in, the same out."""
    around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = cut(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    moved = around.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge; root is the least node of its component. Edges with a null end and loops count for nothing."""
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNotNull().alias("x"), F.col(b).isNotNull().alias("y"))
    stars = cut(ends.where("x and y and u <> v").select("u", "v").distinct())
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(stars)
    while before[0]:
        stars = cut(_star(_star(stars, True), False))
        if (now := mark(stars)) == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
