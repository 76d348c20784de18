"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source queues its documents in a digest order, once per epoch.  An item's virtual finish
time is the tokens its source has queued up to and with it, divided by the source's target; items
are taken in the order of finish time until the total budget is spent.  A queue of any length is
summed by leaves of the digest, a global order by slots of virtual time: no window holds a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import before, leaf_digits, stash, word_count
from lumenframe.plans.ordered import digest, prior, ranked

_EMPTY = "source_key string, source_size bigint, n bigint, target double"


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """``source_key``, ``source_size``, ``n``, ``target`` from one row per (source_key, digest leaf).

    Sources are ranked by ``source_key`` and weighted by ``weights`` in turn.  They share ``share``
    times all tokens by weight; no target exceeds ``epochs`` times its source, and what is cut off
    goes to the others by weight, until none is above: one sort of the ratios of size to weight with running
    sums gives the common level.
    """
    per = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.sum("n").alias("n"))
    per = ranked(per, [], F.substring("source_key", 1, 4), ["source_key"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    per = stash(per.select("source_key", "source_size", "n", weight.alias("weight")), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    budget = share * total
    cap, weight = F.col("source_size") * F.lit(float(epochs)), F.col("weight")
    ratio = cap / weight
    # where all sources of a smaller ratio are filled, the others share the rest at one level
    slot = F.when(ratio > 0, F.floor(F.log2(ratio) * 16)).otherwise(F.lit(-(1 << 20))).cast("long")
    run = prior(per, [], slot, [ratio, F.col("source_key")], {"spent": ("sum", cap), "used": ("sum", weight)})
    here = (F.lit(budget) - F.col("spent")) / (F.lit(per.agg(F.sum("weight")).first()[0]) - F.col("used"))
    level = run.agg(F.min_by(here, F.when(ratio >= here, F.struct(ratio, F.col("source_key"))))).first()[0]
    # without such a level every source is filled
    target = cap if level is None else F.least(cap, weight * F.lit(level))
    return per.select("source_key", "source_size", "n", target.alias("target"))


def mix(
    docs: DataFrame,
    keep: Sequence[str],
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: ``doc`` (a struct of ``keep``), ``size``, ``source_size``, ``target``,
    ``finish`` (array of the virtual finish times of its taken copies), ``taken`` (words).

    A NULL source is a source of its own, ranked last; a NULL or empty text has size 0 and is never
    taken, as it adds nothing.  Repeated rows queue one behind the other; rows equal in key, size
    and text are interchangeable.  An empty table gives no row.  The order is that of a digest of
    the key, so reruns agree; whole documents are taken, at most ``epochs`` times each.
    """
    source_key = F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))
    sized = docs.select(
        F.struct(*keep).alias("doc"),
        source_key.alias("source_key"),
        word_count(F.col(text)).alias("size"),
        digest(seed, F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("turn"),
        F.xxhash64(text).alias("tie"),
    )
    if text not in keep:
        sized = stash(sized, "mix-sized")
    # leaves as fine as any size of the table may ask for; merged to fewer once the sizes are known
    fine = stash(
        sized.groupBy("source_key", F.substring("turn", 1, 8).alias("fine")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")
        ),
        "mix-leaves",
    )
    targets = stash(source_targets(fine, weights, share, epochs), "mix-targets")
    totals = targets.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    digits = min(8, leaf_digits(totals[0]))
    leaves = fine.groupBy("source_key", F.substring("fine", 1, digits).alias("leaf")).agg(F.sum("size").alias("size"))
    ahead = before(leaves, ["source_key"], "leaf", "size", "ahead").join(targets.drop("n"), "source_key")
    ahead = stash(ahead, "mix-ahead")

    w = Window.partitionBy("source_key", "leaf").orderBy("turn", "size", "tie")
    queued = F.col("ahead") + F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = sized.withColumn("leaf", F.substring("turn", 1, digits)).join(ahead, ["source_key", "leaf"])
    rows = rows.withColumn("queued", queued)

    def times(epoch: int) -> Column:
        return F.when(F.col("target") > 0, (F.col("queued") + epoch * F.col("source_size")) / F.col("target"))

    # slots of virtual time hold about a thousand items each, as all sources are served evenly over it
    slots = max(16, totals[1] * epochs // 1000)
    budget = share * totals[2]

    def items(frame: DataFrame) -> DataFrame:
        made = F.explode(F.array(*[F.struct(F.lit(e).alias("epoch"), times(e).alias("finish")) for e in range(epochs)]))
        got = frame.where("size > 0").select("turn", "size", "tie", made.alias("i"))
        got = got.select("turn", "size", "tie", "i.epoch", "i.finish").where("finish IS NOT NULL")
        return got.withColumn("slot", F.floor(F.col("finish") * slots).cast("long"))

    bare = sized.drop("doc").withColumn("leaf", F.substring("turn", 1, digits)).join(ahead, ["source_key", "leaf"])
    bare = items(bare.withColumn("queued", queued))
    bare = stash(bare, "mix-items")
    last = _last_taken(bare, budget)

    def taken(epoch: int) -> Column:
        t = times(epoch)
        if last is None:
            return F.when(F.col("size") > 0, t)
        at = F.struct(t.alias("a"), F.col("turn").alias("b"), F.col("size").alias("c"), F.col("tie").alias("d"), F.lit(epoch).alias("e"))
        end = F.struct(
            F.lit(last.finish).alias("a"), F.lit(last.turn).alias("b"), F.lit(last["size"]).cast("long").alias("c"),
            F.lit(last.tie).cast("long").alias("d"), F.lit(last.epoch).alias("e"),
        )
        return F.when((F.col("size") > 0) & (at <= end), t)

    finish = F.filter(F.array(*[taken(e) for e in range(epochs)]), lambda t: t.isNotNull())
    rows = rows.withColumn("finish", finish)
    return rows.select(
        "doc", "size", "source_size", "target", "finish", (F.col("size") * F.size("finish")).cast("long").alias("taken")
    )


def _last_taken(items: DataFrame, budget: float):
    """The last item, in the order of finish time, up to which the sizes fit the budget; None if all fit."""
    spent, found = 0, items
    for width in (1024, 1):
        step = F.floor(F.col("slot") / width).alias("part")
        sums = found.groupBy(step).agg(F.sum("size").alias("s"))
        run = F.sum("s").over(Window.partitionBy(F.lit(0)).orderBy("part"))
        over = sums.select("part", "s", run.alias("run")).where(F.col("run") + spent > budget)
        first = over.orderBy("part").first()
        if first is None:
            return None
        spent += first.run - first.s
        found = found.where(F.floor(F.col("slot") / width) == first.part)
    order = ["finish", "turn", "size", "tie", "epoch"]
    run = F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = found.withColumn("run", run).where(F.col("run") + spent <= budget).orderBy(*[F.col(c).desc() for c in order]).first()
    if fits is not None:
        return fits
    # nothing of the slot fits: the last item of the slots before it
    edge = found.agg(F.min("slot")).first()[0]
    return items.where(F.col("slot") < edge).orderBy(*[F.col(c).desc() for c in order]).first() or _nothing()


class _Nothing(dict):
    __getattr__ = dict.__getitem__


def _nothing() -> _Nothing:
    return _Nothing(finish=-1.0, turn="", size=0, tie=0, epoch=0)


def mixed(docs: DataFrame, keep: Sequence[str], **how) -> DataFrame:
    """The mix itself: ``doc``, ``finish``, one row per taken copy, in the order of finish time."""
    got = mix(docs, keep, **how).select("doc", F.explode("finish").alias("finish"))
    return got.orderBy("finish")
