"""Connected components of an edge table, by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.llm.shared import Spilled


def _star(edges: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Join each node's neighbours to its smallest one, itself included."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m"))
    return neighbours.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs to (node, component): each node that has an edge, its component's smallest node.

    Null ends and loops are passed over. The edges are rewritten each round, to the shared folder;
    what the driver sees of them is one count and one checksum.
    """
    start = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, mark = Spilled(start, "edges"), None
    while True:
        both = now.df.unionByName(now.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(now.df, both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large, large)
        down = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        new = Spilled(down.where("u <> v").distinct(), "edges")
        now.drop()
        now, old = new, mark
        mark = now.df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == old or not mark[0]:
            break
    roots = now.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
