"""Connected components of an edge table, by alternating stars.

Each round rewires the edges of every node towards the smallest node it
knows (large star, then small star), so that the graph turns into stars
around the smallest node of each component in O(log^2 n) rounds, whatever
its diameter.  A round is two groupings and two joins on the node; its
edges are written to the shared folder, so that neither the plan nor the
recomputation after a lost executor grows with the rounds.  Only a count
and a checksum of each round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v; returns edges (u, v), u > v.

    Large star joins every larger neighbour of a node to the node's smallest
    neighbour; small star joins the node and its smaller neighbours to it.
    """
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select(
            "u", F.least("u", "least").alias("least"))
        out = (both.join(least, "u").where(F.col("v") > F.col("u"))
               .select(F.col("v").alias("u"), F.col("least").alias("v")))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("least"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        out = out.union(least.select("u", F.col("least").alias("v")))
    return out.where(F.col("u") > F.col("v")).distinct()


def _mark(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node.

    Any orderable node type.  Self-loops, repeated edges and either
    direction are accepted; rows with a null end are ignored; an empty edge
    table gives an empty result.
    """
    e = (edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = stored(e, "edges")
    mark = _mark(e)
    while mark[0]:
        e = stored(_star(_star(e, True), False), "edges")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
