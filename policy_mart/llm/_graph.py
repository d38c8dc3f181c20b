"""Connected components of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._work import Shelf


def components(links: DataFrame, shelf: Shelf) -> DataFrame:
    """(node, root): for every node of `links` (columns a, b) the smallest node it is joined to.

    Rounds of two steps. In the large step each node hands its larger neighbours to its smallest one,
    in the small step its smaller neighbours. Both shrink chains by half or more, so rounds grow with
    the logarithm of the longest chain. No step gathers a node's neighbours: minima are aggregated
    before the shuffle and joined back, which lets Spark split a node with many links. Every round
    is written to the shared folder, and the round before is removed.
    """
    edges = shelf.put(
        links.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).filter("child <> parent").distinct()
    )
    while True:
        both = edges.select(F.col("child").alias("u"), F.col("parent").alias("v")).unionByName(
            edges.select(F.col("parent").alias("u"), F.col("child").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("child"), F.col("m").alias("parent")).distinct()
        )
        # Smaller neighbours only: every edge points down already.
        lowest = large.groupBy("child").agg(F.min("parent").alias("m"))
        small = (
            large.join(lowest, "child")
            .select(F.explode(F.array(F.struct("child", F.col("m").alias("parent")), F.struct(F.col("parent").alias("child"), F.col("m").alias("parent")))).alias("e"))
            .select("e.child", "e.parent")
            .filter("child <> parent")
            .distinct()
        )
        nxt = shelf.put(small)
        # Done when every node has one parent and no parent has one.
        many = nxt.groupBy("child").count().filter("count > 1").isEmpty()
        done = many and nxt.join(nxt.select(F.col("child").alias("parent")), "parent", "left_semi").isEmpty()
        shelf.drop(edges)
        edges = nxt
        if done:
            break
    roots = edges.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("root")).unionByName(roots)
