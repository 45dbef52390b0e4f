"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import stored


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``node, label`` (smallest node of its component) for every node of ``links(a, b)`` that is not itself the smallest.

    Alternates two steps until nothing changes: every node hands its smallest
    neighbour to its larger ones, then to its smaller ones. A hub's minimum is
    pre-aggregated, and its links are never gathered in one place. Each round
    is written to the shared checkpoint folder.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m"))

    def mark(edges: DataFrame) -> tuple:
        """Number and checksum of the links, to see whether a round changed any."""
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = smallest(both).withColumn("m", F.least("u", "m"))
        # To the larger neighbours: u's neighbours v > u point at the minimum m <= u.
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()
        # To the smaller ones: u and its neighbours v < u point at the minimum.
        small = large.join(smallest(large), "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*").where("u <> v").distinct()
        edges = stored(small, name)
        after = mark(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = after
