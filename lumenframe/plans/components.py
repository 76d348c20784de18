"""Connected components of a table of edges, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.plans.lineage import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node that can be reached) for the nodes of ``edges`` (``a``, ``b``).

    Rounds of large and small stars: every node hands its larger neighbours to the smallest one around, then
    its smaller ones; the number of rounds grows with the logarithm of the longest path.
    """
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    alone = turned.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    links, seen = stored(turned.where("a <> b"), "star-links"), None
    while True:
        sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sides.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = sides.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stored(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct(), "star-links")
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    found = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root"))
    rest = alone.join(found.select("node"), "node", "left_anti")
    return found.unionByName(roots).unionByName(rest).distinct()
