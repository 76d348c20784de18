"""Exposure brackets: catalog, duplicates, clusters, triplets, orphans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions import capture as C
from lumenframe.plans.lineage import stored
from lumenframe.plans.ordered import number_slot, numbered_runs, time_slot

MID_LIMIT = 1.0
SIDE_LIMIT = 1.0
MAX_GAP_SECONDS = 60.0


def frame_catalog(files: DataFrame, shoot: str = "shoot", name: str = "name") -> DataFrame:
    """Photos of a folder, one per camera counter (RAW before others), free-form names kept.

    ``place`` orders numbered files first, as a listing would.
    """
    listed = files.where(C.is_photo(F.col(name))).withColumn("number", C.frame_number(F.col(name)))
    best = F.min(F.struct((~C.is_raw(F.col(name))).alias("k"), F.col(name).alias("name")))
    numbered = (
        listed.where("number IS NOT NULL")
        .groupBy(shoot, "number")
        .agg(best.alias("b"))
        .select(shoot, "number", F.col("b.name").alias(name), F.lit(0).alias("place"))
    )
    extras = listed.where("number IS NULL").select(
        shoot, F.lit(None).cast("int").alias("number"), name, F.lit(1).alias("place")
    )
    return numbered.unionByName(extras)


def dedupe_frames(frames: DataFrame) -> DataFrame:
    """One frame per shutter press: same millisecond and same EV is a repeated upload."""
    known = frames.where(F.col("ev").isNotNull() & F.col("t_us").isNotNull())
    rank = F.struct(
        (~C.is_raw(F.col("name"))).alias("a"),
        C.is_copy_name(F.col("name")).alias("b"),
        (-F.col("size")).alias("c"),
        F.col("name").alias("d"),
    )
    row = F.struct(*[F.col(x) for x in frames.columns if x != "shoot"])
    return (
        known.groupBy(
            "shoot",
            F.bround(F.col("t_us") / 1000, 0).alias("__ms"),
            F.bround("ev", 3).alias("__ev"),
        )
        .agg(F.min_by(row, rank).alias("f"))
        .select("shoot", "f.*")
    )


def bracket_clusters(frames: DataFrame, max_gap_s: float = MAX_GAP_SECONDS, slot_hours: int = 1) -> DataFrame:
    """Number the brackets of each shoot along time.

    A new bracket opens when the EV falls below the previous frame's or the pause is too
    long.  Shoots are walked in time slots, so one endless shoot is still many tasks.
    """
    gap = F.lit(int(max_gap_s * 1_000_000))

    def opens(row: Column, before: Column) -> Column:
        return (row["ev"] < before["ev"]) | (row["t_us"] - before["t_us"] > gap)

    return numbered_runs(frames, ["shoot"], time_slot("t_us", slot_hours), ["t_us", "name"], ["ev", "t_us"], opens, "cluster")


def _pick(cond: Column, *order: Column) -> Column:
    return F.min(F.when(cond, F.struct(*order, F.col("t_us"), F.col("name"), F.col("frame_id"))))


def bracket_outcomes(clusters: DataFrame) -> DataFrame:
    """One row per cluster: the chosen frames, or the reason why there is no triplet."""
    ev = F.col("ev")
    agg = clusters.groupBy("shoot", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("t_us", "name")).alias("first"),
        F.max(F.struct("t_us", "name")).alias("last"),
        _pick(F.abs(ev) <= MID_LIMIT, F.abs(ev).alias("k")).alias("mid"),
        _pick(ev <= -SIDE_LIMIT, (-ev).alias("k")).alias("under"),
        _pick(ev >= SIDE_LIMIT, ev.alias("k")).alias("over"),
    )

    def same(a: str, b: str) -> Column:
        return (F.col(f"{a}.t_us") == F.col(f"{b}.t_us")) & (F.col(f"{a}.name") == F.col(f"{b}.name"))

    reason = (
        F.when(F.col("n") < 3, F.format_string("only %d frame(s)", "n"))
        .when(F.col("mid").isNull(), "no mid frame")
        .when(F.col("under").isNull(), "no under-exposed frame")
        .when(F.col("over").isNull(), "no over-exposed frame")
        .when(same("mid", "under") | same("mid", "over") | same("under", "over"), "same frame in two slots")
    )
    return agg.withColumn("reason", reason)


def select_triplets(clusters: DataFrame) -> DataFrame:
    """(shoot, cluster, under, mid, over) frame ids of complete brackets."""
    return bracket_outcomes(clusters).where("reason IS NULL").select(
        "shoot",
        "cluster",
        F.col("under.frame_id").alias("under"),
        F.col("mid.frame_id").alias("mid"),
        F.col("over.frame_id").alias("over"),
    )


def bracket_failures(clusters: DataFrame, frames: DataFrame) -> DataFrame:
    """Incomplete brackets with their reason, then the frames without EV or time.

    ``first`` and ``last`` name the window; the EVs of a window are the rows of ``clusters``
    with the same key, kept long because a window may have any length.
    """
    failed = bracket_outcomes(clusters).where("reason IS NOT NULL").select(
        "shoot", "cluster", F.col("first.name").alias("first"), F.col("last.name").alias("last"), "n", "reason"
    )
    missing = frames.where(F.col("ev").isNull() | F.col("t_us").isNull()).select(
        "shoot",
        F.lit(None).cast("long").alias("cluster"),
        F.col("name").alias("first"),
        F.col("name").alias("last"),
        F.lit(1).cast("long").alias("n"),
        F.when(F.col("ev").isNull(), "EV missing").otherwise("capture time missing").alias("reason"),
    )
    return failed.unionByName(missing)


def orphan_frames(frames: DataFrame, triplets: DataFrame) -> DataFrame:
    """Frames that no triplet uses."""
    used = triplets.select("shoot", F.explode(F.array("under", "mid", "over")).alias("frame_id"))
    return frames.join(used, ["shoot", "frame_id"], "left_anti")


def bracket_report(frames: DataFrame, max_gap_s: float) -> DataFrame:
    """Per shoot: complete brackets, failed ones by kind, frames left over."""
    clusters = bracket_clusters(dedupe_frames(frames), max_gap_s)
    outcomes = bracket_outcomes(clusters)

    def n(cond: Column) -> Column:
        return F.count_if(F.coalesce(cond, F.lit(False)))

    per_shoot = outcomes.groupBy("shoot").agg(
        F.sum("n").alias("frames_kept"),
        F.count(F.lit(1)).alias("brackets"),
        n(F.col("reason").isNull()).alias("complete"),
        n(F.col("reason").startswith("only")).alias("too_short"),
        n(F.col("reason").startswith("no ")).alias("role_missing"),
        n(F.col("reason").startswith("same")).alias("same_frame"),
        F.sum(F.when(F.col("reason").isNull(), F.col("n") - 3).otherwise(F.col("n"))).alias("orphans"),
    )
    unusable = frames.groupBy("shoot").agg(
        F.count(F.lit(1)).alias("uploads"),
        n(F.col("ev").isNull() | F.col("t_us").isNull()).alias("unusable"),
    )
    zero = {k: 0 for k in ("frames_kept", "brackets", "complete", "too_short", "role_missing", "same_frame", "orphans")}
    return unusable.join(per_shoot, "shoot", "left").fillna(zero)


# ---- counter-based detection ---------------------------------------------------------------


def _windows(frames: DataFrame) -> DataFrame:
    """All runs of three consecutive counters with their verdict; one shuffle, no self-join."""
    part = F.struct("ev", "name")
    spread = frames.select(
        "shoot", "number", part.alias("f"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("pos")
    ).withColumn("start", (F.col("number") - F.col("pos")).cast("long"))
    slots = [F.max(F.when(F.col("pos") == i, F.col("f"))).alias(f"f{i}") for i in range(3)]
    trio = spread.groupBy("shoot", "start").agg(*slots).dropna(subset=["f0", "f1", "f2"])
    evs = F.array("f0.ev", "f1.ev", "f2.ev")
    lo, hi = F.array_min(evs), F.array_max(evs)
    middle = F.col("f0.ev") + F.col("f1.ev") + F.col("f2.ev") - lo - hi
    verdict = (
        F.when(F.exists(evs, lambda v: v.isNull()), "EV missing")
        .when(lo == hi, "flat")
        .when(lo >= 0, "no under-exposed frame")
        .when(hi <= 0, "no over-exposed frame")
        .when(F.abs(middle) > MID_LIMIT, "mid frame out of range")
        .otherwise("ok")
    )

    def at(value: Column) -> Column:
        return F.array_position(evs, value)

    u, o = at(lo), at(hi)
    names = F.array("f0.name", "f1.name", "f2.name")
    return trio.select(
        "shoot",
        "start",
        verdict.alias("verdict"),
        F.when(verdict == "ok", F.element_at(names, u.cast("int"))).alias("under"),
        F.when(verdict == "ok", F.element_at(names, (6 - u - o).cast("int"))).alias("mid"),
        F.when(verdict == "ok", F.element_at(names, o.cast("int"))).alias("over"),
    )


_CHAIN = 64


def _walked(entry: Column, first: Column) -> Column:
    """The maps ``m`` of a group of blocks walked from state ``entry``: last block, state behind it, and the states on entry.

    A block without a map leaves nothing taken.
    """
    seen = F.array().cast("array<struct<block:bigint,state:bigint>>")
    start = F.struct((first - 1).alias("block"), entry.cast("long").alias("state"), seen.alias("seen"))

    def link(acc: Column, m: Column) -> Column:
        state = F.when(m["block"] == acc["block"] + 1, acc["state"]).otherwise(F.lit(0).cast("long"))
        after = F.when(state == 0, m["s0"]).when(state == 1, m["s1"]).otherwise(m["s2"]).cast("long")
        here = F.struct(m["block"].alias("block"), state.alias("state"))
        return F.struct(m["block"].alias("block"), after.alias("state"), F.concat(acc["seen"], F.array(here)).alias("seen"))

    return F.aggregate("m", start, link)


def _entry_states(maps: DataFrame) -> DataFrame:
    """``shoot``, ``block``, ``state``: how many counters are taken where each block begins.

    Maps of 64 blocks are composed to one, as often as it takes to have one per shoot; the states then come
    down level by level, so no row holds more than 64 blocks.
    """
    maps = stored(maps, "block-maps")
    top, levels, level = maps.agg(F.max("block")).first()[0] or 0, [], maps
    while True:
        group = F.floor(F.col("block") / _CHAIN).cast("long")
        packed = level.groupBy("shoot", group.alias("group")).agg(F.sort_array(F.collect_list(F.struct("block", "s0", "s1", "s2"))).alias("m"))
        levels.append(packed)
        top //= _CHAIN
        if not top:
            break
        first = F.col("group") * _CHAIN

        def behind(i: int) -> Column:
            end = _walked(F.lit(i), first)
            return F.when(end["block"] == first + _CHAIN - 1, end["state"]).otherwise(F.lit(0).cast("long"))

        level = packed.select("shoot", F.col("group").alias("block"), *[behind(i).alias(f"s{i}") for i in range(3)])
    state = levels[-1].select("shoot", "group", F.lit(0).cast("long").alias("state"))
    for packed in reversed(levels):
        rows = packed.join(state, ["shoot", "group"])
        state = rows.select("shoot", F.inline(_walked(F.col("state"), F.col("group") * _CHAIN)["seen"])).withColumnRenamed("block", "group")
    return state.withColumnRenamed("group", "block")


def sliding_triplets(frames: DataFrame, width: int = 4096) -> DataFrame:
    """Triplets and failures of the counter mode: a hit consumes three counters, a miss one.

    Which hits count depends on all earlier hits of the shoot, but only through "how many
    counters are still taken" (0, 1 or 2).  So each block of ``width`` counters is folded
    once per entry state, blocks are chained per shoot on that small table, and every block
    is then resolved on its own.
    """
    wins = _windows(frames).withColumn("block", number_slot("start", width))
    hits = (
        wins.where("verdict = 'ok'")
        .groupBy("shoot", "block")
        .agg(F.sort_array(F.collect_list("start")).alias("starts"))  # at most ``width`` counters
    )

    def free_after(entry: Column) -> Column:
        return F.aggregate("starts", entry, lambda free, s: F.when(s >= free, s + 3).otherwise(free))

    first = F.col("block") * width
    after = [
        F.greatest(free_after(first + i) - (first + width), F.lit(0)).alias(f"s{i}") for i in range(3)
    ]
    entry = _entry_states(hits.select("shoot", "block", *after))
    taken0 = F.struct((first + F.col("state")).alias("free"), F.array().cast("array<bigint>").alias("took"))

    def take(acc: Column, s: Column) -> Column:
        ok = s >= acc["free"]
        return F.struct(
            F.when(ok, s + 3).otherwise(acc["free"]).alias("free"),
            F.when(ok, F.concat(acc["took"], F.array(s))).otherwise(acc["took"]).alias("took"),
        )

    took = (
        hits.join(entry, ["shoot", "block"])
        .select("shoot", F.explode(F.aggregate("starts", taken0, take)["took"]).alias("start"))
    )
    blocked = took.select(
        "shoot", F.explode(F.array(F.col("start") + 1, F.col("start") + 2)).alias("start")
    )
    visited = wins.where("verdict <> 'flat'").join(blocked, ["shoot", "start"], "left_anti")
    return visited.select("shoot", "start", "verdict", "under", "mid", "over")
