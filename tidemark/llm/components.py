"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.spread import join_spread


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (u long, v long); the root is the smallest node.

    Edges stay distributed: each step is a shuffle by node, written before the next one. The
    edges of a node with very many of them are not brought together. Loops and repeated edges are
    allowed; nodes without an edge to another one are their own root.
    """
    edges = stored(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).distinct(), "cc")
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    links = edges.where("u <> v")
    last = (links.count(),)
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"),
                                      F.count("*").alias("n"))
        met = join_spread(both, least, "u", "n", 2 * last[0])
        # every edge now points from the larger node to the smaller one
        down = stored(met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .where("u <> v").distinct(), "cc")
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        met = join_spread(down, least, "u", "n", last[0])
        small = (met.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
            .where("u <> v").distinct())
        links = stored(small, "cc")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    return nodes.join(links.select(F.col("u").alias("node"), F.col("v").alias("root")), "node",
                      "left").select("node", F.coalesce("root", "node").alias("root"))
