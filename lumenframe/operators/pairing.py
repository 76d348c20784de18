"""Pairing two sets of files whose names or counters have drifted apart."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions import capture as C
from lumenframe.plans.ordered import number_slot, ranked

# How far counters may drift, and by how much they may differ after that.
REACH = 10
TIGHT = 1

_FLOW = "shoot bigint, ours_num bigint, vendor_num bigint, ours_from bigint, vendor_from bigint, n bigint"


def offset_votes(ours: DataFrame, vendor: DataFrame, reach: int = REACH) -> DataFrame:
    """Votes per (shoot, offset ours - vendor).

    Equal counters are counted first, so a vote is a product of two counts and the join
    emits at most ``2 * reach + 1`` rows per distinct counter instead of all pairs.
    """
    o = ours.groupBy("shoot", "num").agg(F.count(F.lit(1)).alias("n_o"))
    v = vendor.groupBy("shoot", F.col("num").alias("v_num")).agg(F.count(F.lit(1)).alias("n_v"))
    shifted = o.select("shoot", "num", "n_o", F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("offset"))
    shifted = shifted.withColumn("v_num", F.col("num") - F.col("offset"))
    return shifted.join(v, ["shoot", "v_num"]).groupBy("shoot", "offset").agg(
        F.sum(F.col("n_o") * F.col("n_v")).alias("votes")
    )


def best_offset(votes: DataFrame) -> DataFrame:
    """Most votes, then the smallest shift, then the negative one."""
    rank = F.struct((-F.col("votes")).alias("a"), F.abs("offset").alias("b"), F.col("offset").alias("c"))
    return votes.groupBy("shoot").agg(F.min_by("offset", rank).alias("offset"))


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Serve runs of counters in order: own counter first, then the one below, then above.

    Rows come sorted by (shoot, run, at).  Only the free files of three neighbouring counters
    are remembered, so a run may be of any length.
    """
    columns = [c.split()[0] for c in _FLOW.split(", ")]
    held = None  # (key, at, offset, n_o) waiting to see the counter above it
    left: dict[int, list[int]] = {}  # counter -> [free, used]

    def serve(out: list) -> None:
        (shoot, _), at, offset, n = held
        served = 0
        for to in (at, at - TIGHT, at + TIGHT):
            stock = left.get(to)
            take = min(n - served, stock[0]) if stock else 0
            if take > 0:
                out.append((shoot, at + offset, to, served, stock[1], take))
                stock[0] -= take
                stock[1] += take
                served += take

    for batch in batches:
        out: list = []
        rows = zip(*(batch[x] for x in ("shoot", "run", "at", "offset", "n_o", "n_v")))
        for shoot, run, at, offset, n_o, n_v in rows:
            if held is not None and held[0] == (shoot, run):
                left[at] = [n_v, 0]
                serve(out)
                left.pop(at - 2, None)
            else:
                if held is not None:
                    serve(out)
                left = {at: [n_v, 0]}
            held = ((shoot, run), at, offset, n_o)
        yield pd.DataFrame(out, columns=columns)
    if held is not None:
        out = []
        serve(out)
        yield pd.DataFrame(out, columns=columns)


def fuzzy_pair(ours: DataFrame, vendor: DataFrame, reach: int = REACH) -> DataFrame:
    """One-to-one pairs (shoot, ours, vendor) at the shoot's prevailing counter offset +-1.

    The greedy walk works on counts per counter, not on files, and is cut wherever a counter
    is unused on both sides, because nothing can be passed across such a gap.  Files are then
    dealt out by their rank within a counter.
    """
    offset = best_offset(offset_votes(ours, vendor, reach))
    o = ours.join(offset, "shoot")
    v = vendor.join(offset, "shoot")
    at = o.select("shoot", (F.col("num") - F.col("offset")).alias("at"), "offset", F.lit(1).alias("o"), F.lit(0).alias("v"))
    at = at.unionByName(v.select("shoot", F.col("num").alias("at"), "offset", F.lit(0).alias("o"), F.lit(1).alias("v")))
    counts = at.groupBy("shoot", "at").agg(
        F.max("offset").cast("long").alias("offset"), F.sum("o").alias("n_o"), F.sum("v").alias("n_v")
    )
    runs = ranked(counts, ["shoot"], number_slot("at"), ["at"]).withColumn("run", F.col("at") - F.col("rn"))
    runs = runs.select(F.col("shoot").cast("long").alias("shoot"), "run", F.col("at").cast("long").alias("at"), "offset", "n_o", "n_v")
    by_run = runs.repartition("shoot", "run").sortWithinPartitions("shoot", "run", "at")
    flow = by_run.mapInPandas(_walk, _FLOW)

    o_rank = ranked(ours, ["shoot", "num"], F.substring("name", 1, 8), ["name"], "__i")
    v_rank = ranked(vendor, ["shoot", "num"], F.substring("name", 1, 8), ["name"], "__j")
    dealt = o_rank.join(flow, (o_rank["shoot"] == flow["shoot"]) & (o_rank["num"] == flow["ours_num"])).where(
        (F.col("__i") > F.col("ours_from")) & (F.col("__i") <= F.col("ours_from") + F.col("n"))
    )
    dealt = dealt.select(
        o_rank["shoot"],
        F.col("name").alias("ours"),
        F.col("vendor_num").alias("num"),
        (F.col("__i") - F.col("ours_from") + F.col("vendor_from")).alias("__j"),
    )
    return dealt.join(v_rank.withColumnRenamed("name", "vendor"), ["shoot", "num", "__j"]).select("shoot", "ours", "vendor")


def _keys(files: DataFrame) -> DataFrame:
    stem = F.lower(C.drop_extension(F.col("name")))
    return files.withColumn("__exact", stem).withColumn("__squashed", F.replace(stem, F.lit("_"), F.lit("")))


def exact_match(ours: DataFrame, vendor: DataFrame) -> DataFrame:
    """Pairs by lower-case stem, else by the stem without underscores; the first file wins a key."""
    keyed = _keys(vendor).select("shoot", "name", F.explode(F.array_distinct(F.array("__exact", "__squashed"))).alias("key"))
    first = keyed.groupBy("shoot", "key").agg(F.min("name").alias("vendor"))
    o = _keys(ours).select("shoot", F.col("name").alias("ours"), "__exact", "__squashed")
    a = first.select("shoot", F.col("key").alias("__exact"), F.col("vendor").alias("__a"))
    b = first.select("shoot", F.col("key").alias("__squashed"), F.col("vendor").alias("__b"))
    both = o.join(a, ["shoot", "__exact"], "left").join(b, ["shoot", "__squashed"], "left")
    return both.select("shoot", "ours", F.coalesce("__a", "__b").alias("vendor")).where("vendor IS NOT NULL")


def pair_with_fallback(ours: DataFrame, vendor: DataFrame, exact_consumes: bool = False) -> DataFrame:
    """Exact pairs first, fuzzy pairs for the rest.

    By default a vendor file taken by an exact match may serve a second time.
    """
    exact = exact_match(ours, vendor)
    rest = ours.join(exact.select("shoot", F.col("ours").alias("name")), ["shoot", "name"], "left_anti")
    pool = vendor
    if exact_consumes:
        pool = vendor.join(exact.select("shoot", F.col("vendor").alias("name")), ["shoot", "name"], "left_anti")
    fuzzy = fuzzy_pair(rest, pool)
    return exact.withColumn("kind", F.lit("exact")).unionByName(fuzzy.withColumn("kind", F.lit("fuzzy")))


def pair_manifest(inputs: DataFrame, targets: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(pairs with the same name, inputs without a target)."""
    return inputs.join(targets, name), inputs.join(targets, name, "left_anti")
