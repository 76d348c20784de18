"""Connected components by alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import stash


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``edges`` (``a``, ``b``).

    Each round hangs larger neighbours, then smaller ones, on the smallest node around; the loop
    ends when the edges stay the same.  A node with very many neighbours is only ever a join key
    met by one row, so its rows can be split.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, mark, k = stash(links, "links-0"), None, 0
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = large.where("a <> b")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        k += 1
        links = stash(hung.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), f"links-{k}")
        got = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(got) == mark:
            break
        mark = tuple(got)
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
