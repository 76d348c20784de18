"""Keyed writes and queue steps as table-to-table operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.plans.lineage import stored
from lumenframe.streaming.ledger import Ledger

_P = "__patch"


def _last(patch: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """``keys`` and ``patch`` (a struct of the rest), one row per key: the last by ``order``, then by content."""
    whole = F.struct(*[c for c in patch.columns if c not in keys])
    text = F.to_json(whole)
    rank = F.struct(F.col(order), text) if order else text
    return patch.groupBy(*keys).agg(F.max_by(whole, rank).alias("patch"))


def guarded_update(
    base: DataFrame, patch: DataFrame, keys: Sequence[str], guard: Column, sets: Mapping[str, Column], order: str | None = None
) -> DataFrame:
    """Set columns on rows that have a patch and pass the guard; ``updated`` tells which.

    ``sets`` are expressions over base columns and ``patch.<column>``; a guard may use both.  Of
    several patches of a key the last by ``order`` counts; rows of ``base`` are never multiplied.
    """
    keys = list(keys)
    packed = _last(patch, keys, order)
    rows = base.join(packed, keys, "left")
    hit = F.col("patch").isNotNull() & F.coalesce(guard, F.lit(False))
    out = [
        F.when(hit, sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in base.columns
    ]
    return rows.select(*out, hit.alias("updated"))


def merge_json(old: Column, patch: Column) -> Column:
    """Right-biased merge of two JSON objects, members in key order; numbers, booleans, NULLs and
    nested values keep their types.  NULL or anything but an object counts as empty."""
    empty = F.expr("CAST(map() AS map<string,variant>)")

    def bag(text: Column) -> Column:
        return F.coalesce(F.from_json(text, "map<string,variant>"), empty)

    def merged(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        names = F.array_sort(F.array_union(F.map_keys(a), F.map_keys(b)))
        values = F.transform(names, lambda k: F.when(F.map_contains_key(b, k), F.try_element_at(b, k)).otherwise(F.try_element_at(a, k)))
        return F.to_json(F.map_from_arrays(names, values))

    return F.get(F.transform(F.array(F.struct(bag(old).alias("a"), bag(patch).alias("b"))), merged), F.lit(0))


def partial_upsert(
    base: DataFrame, patches: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str | None = None
) -> DataFrame:
    """Upsert by key; ``patches`` carries a map ``patch`` of text values.

    A column missing from the map keeps its value, one mapped to NULL is overwritten with NULL.  Of
    several patches of a key the last by ``order`` counts.
    """
    keys = list(keys)
    last = _last(patches.select(*keys, "patch", *([order] if order else [])), keys, order)
    both = base.join(last.select(*keys, F.col("patch.patch").alias("patch")), keys, "full_outer")
    out = []
    for c in columns:
        given = F.coalesce(F.map_contains_key("patch", c), F.lit(False))
        value = F.try_element_at("patch", F.lit(c)).cast(base.schema[c].dataType)
        out.append(F.when(given, value).otherwise(F.col(c)).alias(c))
    return both.select(*keys, *out)


def compare_and_set(base: DataFrame, changes: DataFrame, key: str, expect: str, limit: int = 500) -> DataFrame:
    """Move rows from an expected status to the requested one; late comers change nothing."""
    return guarded_update(
        base,
        changes,
        [key],
        F.col("status") == expect,
        {"status": F.col("patch.status"), "error": F.substring("patch.error", 1, limit)},
    )


def result_rows(requests: DataFrame, failed: Column, message: Column, limit: int = 200) -> DataFrame:
    """One result per request id: done, or error with a shortened text."""
    one = requests.groupBy("id").agg(F.min(F.struct(*[c for c in requests.columns if c != "id"])).alias("r"))
    rows = one.select("id", "r.*")
    return rows.select(
        "id",
        F.when(failed, "error").otherwise("done").alias("status"),
        F.when(failed, F.substring(message, 1, limit)).alias("error"),
    )


def drain_queue(requests: DataFrame, done: DataFrame, failed: Column, message: Column) -> DataFrame:
    """Outcome of one pass over a queue: finished ids are cleared, the others answered."""
    ghosts = requests.join(done, "id", "left_semi").select("id").distinct()
    cleared = ghosts.select("id", F.lit("cleared").alias("status"), F.lit(None).cast("string").alias("error"))
    fresh = requests.join(done, "id", "left_anti")
    return result_rows(fresh, failed, message).unionByName(cleared)


def drain_ledger(requests: DataFrame, ledger: Ledger, part: str, failed: Column, message: Column) -> DataFrame:
    """``drain_queue`` against a durable ledger, which then holds the ids answered in this pass.

    ``part`` names the pass; a pass that is run again under its name gives the same outcome.
    """
    done = ledger.known(ledger.buckets_of(requests), but=part)
    if done is None:
        done = requests.select("id").limit(0)
    got = stored(drain_queue(requests, done, failed, message), "drained")
    ledger.add(got.where("status <> 'cleared'"), part)
    ledger.merge(ledger.buckets_of(got), but=part)
    return got


def append_results(table: DataFrame, rows: DataFrame, at_us: Column | int) -> DataFrame:
    """New rows enter as pending with a creation time and no completion."""
    at = at_us if isinstance(at_us, Column) else F.lit(at_us)
    new = rows.select(
        "*", F.lit("pending").alias("status"), at.cast("long").alias("created_us"), F.lit(None).cast("long").alias("completed_us")
    )
    return table.unionByName(new.select(*table.columns))


def complete_results(table: DataFrame, finished: DataFrame, key: str) -> DataFrame:
    """Fill status and completion of rows that are still pending."""
    return guarded_update(
        table,
        finished,
        [key],
        F.col("status") == "pending",
        {"status": F.col("patch.status"), "completed_us": F.col("patch.completed_us")},
    ).drop("updated")
