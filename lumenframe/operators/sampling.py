"""Seeded splits, caps, samples and ordered pages.

Where the original draws at random, rows are ordered by the digest of seed and key:
repeatable, parallel, and independent of the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.plans.ordered import digest, digest_slot, number_slot, prior, ranked, time_slot, total_of, with_total


def _by_digest(df: DataFrame, keys: Sequence[str], seed, key: str, out: str = "rn") -> DataFrame:
    d = df.withColumn("__d", digest(seed, key))
    return ranked(d, keys, digest_slot("__d"), ["__d", key], out).drop("__d")


def group_split_cumulative(df: DataFrame, group: str, frac: float, seed) -> DataFrame:
    """Whole groups go to ``val`` in digest order until they hold ``int(rows * frac)`` rows."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).withColumn("__d", digest(seed, group))
    sizes = with_total(sizes, total_of(sizes, F.sum("__n").alias("__all")))
    run = prior(sizes, [], digest_slot("__d"), ["__d", group], {"__before": ("sum", F.col("__n"))})
    side = F.when(F.col("__before") < F.floor(F.col("__all") * frac), "val").otherwise("train")
    return df.join(run.select(group, side.alias("split")), group)


def group_split_fraction(df: DataFrame, group: str, slot: Column, frac: float) -> DataFrame:
    """The first ``int(groups * frac)`` groups in key order train, the rest validate."""
    groups = df.select(group).distinct()
    order = ranked(groups, [], slot, [group])
    order = with_total(order, total_of(groups, F.count(F.lit(1)).alias("__all")))
    side = F.when(F.col("rn") <= F.floor(F.col("__all") * frac), "train").otherwise("val")
    return df.join(order.select(group, side.alias("split")), group)


def stratified_split(df: DataFrame, cls: str, key: str, frac: float, seed) -> DataFrame:
    """``max(1, int(n * frac))`` rows of every class validate."""
    sizes = df.groupBy(cls).agg(F.count(F.lit(1)).alias("__all"))
    order = _by_digest(df, [cls], seed, key).join(sizes, cls)
    n_val = F.greatest(F.lit(1), F.floor(F.col("__all") * frac))
    return order.withColumn("split", F.when(F.col("rn") <= n_val, "val").otherwise("train")).drop("rn", "__all")


def random_split(df: DataFrame, key: str, n_val: Column, seed) -> DataFrame:
    """A seeded split; ``n_val`` is an expression over the row count ``total``."""
    order = _by_digest(df, [], seed, key)
    order = with_total(order, total_of(df, F.count(F.lit(1)).alias("total")))
    return order.withColumn("split", F.when(F.col("rn") <= n_val, "val").otherwise("train")).drop("rn", "total")


def oldest_holdout(df: DataFrame, t_us: str, key: str, n: int) -> DataFrame:
    """The ``n`` oldest rows evaluate; 0 evaluates all; too few rows to train on is an error."""
    if n == 0:
        return df.withColumn("split", F.lit("eval"))
    order = ranked(df, [], time_slot(t_us), [t_us, key])
    order = with_total(order, total_of(df, F.count(F.lit(1)).alias("total")))
    side = (
        F.when(F.col("total") <= n, F.raise_error(F.lit("hold-out leaves nothing to train on")))
        .when(F.col("rn") <= n, "eval")
        .otherwise("train")
    )
    return order.withColumn("split", side).drop("rn", "total")


def even_sample(df: DataFrame, group: str, slot: Column, order: Sequence[str], k: int) -> DataFrame:
    """At most ``k`` evenly spaced rows per group: positions floor(i * (n - 1) / (k - 1))."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    rows = ranked(df, [group], slot, order).join(sizes, group)
    pos, last = F.col("rn") - 1, F.col("__n") - 1
    if k == 1:
        hit = pos == 0
    else:
        i = F.ceil(pos * (k - 1) / last)
        hit = F.floor(i * last / (k - 1)) == pos
    return rows.where((F.col("__n") <= k) | hit).drop("rn", "__n")


def target_cutoff(
    df: DataFrame, group: str, group_rank: Sequence[Column], group_slot: Column,
    slot: Column, order: Sequence[str], n: int,
) -> DataFrame:
    """Groups in order until ``n`` rows are reached; the last group is cut short.

    ``group_rank`` and ``group_slot`` are expressions over the group's columns.  Only group
    sizes are walked globally; rows are ranked inside the groups that survive.
    """
    sizes = df.groupBy(group, *[c.alias(f"__r{i}") for i, c in enumerate(group_rank)], group_slot.alias("__g")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    keys = [f"__r{i}" for i in range(len(group_rank))]
    run = prior(sizes, [], F.col("__g"), [*keys, group], {"__before": ("sum", F.col("__n"))})
    kept = df.join(run.where(F.col("__before") < n).select(group, "__before"), group)
    rows = ranked(kept, [group], slot, order)
    return rows.where(F.col("rn") + F.col("__before") <= n).drop("rn", "__before")


def balanced_cap(df: DataFrame, cls: str, classes: Sequence[str], order: Sequence[str], total: int) -> DataFrame:
    """``max(1, total // classes)`` rows of each listed class, then ``total`` in class order."""
    cap = max(1, total // max(1, len(classes)))
    parts = [
        df.where(F.col(cls) == name).orderBy(*order).limit(cap).withColumn("__c", F.lit(i))
        for i, name in enumerate(classes)
    ]
    both = reduce(DataFrame.unionByName, parts)
    return both.orderBy("__c", *order).limit(total).drop("__c")


def even_slices(df: DataFrame, key: str, slot: Column, n: int, start: int = 0) -> DataFrame:
    """Cut an ordered table in ``n`` slices whose sizes differ by at most one (long ones first)."""
    rows = with_total(ranked(df, [], slot, [key]), total_of(df, F.count(F.lit(1)).alias("__all")))
    pos = F.col("rn") - 1
    small, extra = F.floor(F.col("__all") / n), F.col("__all") % n
    head = extra * (small + 1)
    tile = F.when(pos < head, F.floor(pos / (small + 1))).otherwise(extra + F.floor((pos - head) / small))
    rows = rows.withColumn("slice", tile).withColumn(
        "offset", start + F.col("slice") * small + F.least(F.col("slice"), extra)
    )
    return rows.drop("rn", "__all")


def slice_plan(df: DataFrame, n: int, start: int = 0) -> DataFrame:
    """Offsets and limits of the slices alone."""
    total = df.agg(F.count(F.lit(1)).alias("all"))
    small, extra = F.floor(F.col("all") / n), F.col("all") % n
    s = F.col("slice")
    return total.select("all", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("slice")).select(
        "slice",
        (start + s * small + F.least(s, extra)).alias("offset"),
        (small + (s < extra).cast("long")).alias("limit"),
    )


def best_so_far(df: DataFrame, keys: Sequence[str], slot: Column, order: Sequence[str], metric: str, higher: bool) -> DataFrame:
    """Flag rows that beat everything before them in their run."""
    how = "max" if higher else "min"
    rows = prior(df, keys, slot, order, {"__best": (how, F.col(metric))})
    better = F.col(metric) > F.col("__best") if higher else F.col(metric) < F.col("__best")
    return rows.withColumn("saved", F.col("__best").isNull() | better).drop("__best")


def compact_journal(log: DataFrame, key: str, seq: str, label: str) -> DataFrame:
    """Last entry per key; a NULL label deletes the key."""
    return log.groupBy(key).agg(F.max_by(label, seq).alias(label)).where(F.col(label).isNotNull())


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key, as an aggregate (combined before the shuffle)."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("r")).select(*keys, "r.*")


def assign_sort_order(df: DataFrame, keys: Sequence[str], slot: Column, order: Sequence[str], start: Column | int) -> DataFrame:
    first = start if isinstance(start, Column) else F.lit(start)
    return ranked(df, keys, slot, order).withColumn("sort_order", F.col("rn") + first - 1).drop("rn")


def plan_rank(df: DataFrame, shoot: str, name: str, n: int) -> DataFrame:
    """The first ``n`` candidates in shoot order, numbered, with an output name."""
    top = df.orderBy(shoot, name).limit(n)
    top = top.withColumn("i", F.row_number().over(Window.orderBy(shoot, name)))  # n rows only
    return top


def page(df: DataFrame, order: Sequence[Column | str], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def seeded_sample(df: DataFrame, key: str, n: int, seed) -> DataFrame:
    return df.withColumn("__d", digest(seed, key)).orderBy("__d", key).limit(n).drop("__d")


def balanced_binary_sample(pos: DataFrame, neg: DataFrame, key: str, cap: int, seed, at_least: int = 20) -> DataFrame:
    """Up to ``cap`` positives and as many negatives; too few positives is an error."""
    chosen = seeded_sample(pos, key, cap, seed)
    n_pos = total_of(chosen, F.count(F.lit(1)).alias("__n"))
    pool = neg.withColumn("__d", digest(seed, key)).orderBy("__d", key).limit(cap)
    pool = pool.withColumn("__rn", F.row_number().over(Window.orderBy("__d", key)))  # cap rows only
    enough = F.when(
        F.col("__n") < at_least, F.raise_error(F.lit("not enough positives")).cast("boolean")
    ).otherwise(F.col("__rn") <= F.col("__n"))
    other = with_total(pool, n_pos).where(enough).drop("__d", "__rn", "__n")
    return chosen.withColumn("label", F.lit(1)).unionByName(other.withColumn("label", F.lit(0)))
