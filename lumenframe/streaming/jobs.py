"""Streams over request queues, heartbeats and progress deltas.

Every function maps a streaming DataFrame (and, in tests, a static one) to a DataFrame.
Event time is the column ``t``; how late a row may be is the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.review import hash_shard


def with_event_time(df: DataFrame, t_us: str = "t_us") -> DataFrame:
    return df.withColumn("t", F.timestamp_micros(t_us))


def request_results(requests: DataFrame, failed: Column, message: Column, limit: int = 200) -> DataFrame:
    """A result per request, however old; bad requests become error rows.

    Nothing is kept in state: the ledger knows which ids were answered (``ledger.answer``).
    """
    return requests.select(
        "id",
        F.when(failed, "error").otherwise("done").alias("status"),
        F.when(failed, F.substring(message, 1, limit)).alias("error"),
    )


def shard(requests: DataFrame, index: int, shards: int) -> DataFrame:
    """The part of a queue that one of several readers owns."""
    return requests.where(hash_shard(F.col("id"), shards) == index)


def _bounded(rows: DataFrame, late: str | None) -> DataFrame:
    """Rows with a watermark, or without one where every late row must count."""
    return rows.withWatermark("t", late) if late else rows


def heartbeat_windows(beats: DataFrame, width: str, late: str | None = "10 minutes") -> DataFrame:
    """Per worker and tumbling window: load and memory, restarts, failed services.

    ``late`` bounds the state of a stream that never ends; None keeps every window open.
    """
    rows = _bounded(beats, late).groupBy("worker", F.window("t", width).alias("w"))
    got = rows.agg(
        F.count(F.lit(1)).alias("beats"),
        F.max("load").alias("max_load"),
        F.sum("mem_pct").alias("mem_sum"),
        F.max("mem_pct").alias("max_mem"),
        F.sum("restarts").alias("restarts"),
    )
    return got.select(
        "worker",
        F.unix_micros("w.start").alias("start_us"),
        "beats",
        "max_load",
        (F.col("mem_sum") / F.col("beats")).alias("avg_mem"),
        "max_mem",
        "restarts",
    )


def service_windows(beats: DataFrame, width: str, late: str | None = "10 minutes") -> DataFrame:
    """Per worker, service and window: beats and failures (``services`` is an array of structs)."""
    rows = _bounded(beats, late).select("worker", "t", F.explode("services").alias("s"))
    got = rows.groupBy("worker", F.col("s.name").alias("service"), F.window("t", width).alias("w")).agg(
        F.count(F.lit(1)).alias("beats"), F.count_if(F.col("s.status") == "failed").alias("failures")
    )
    return got.select("worker", "service", F.unix_micros("w.start").alias("start_us"), "beats", "failures")


def worker_latest(beats: DataFrame) -> DataFrame:
    """The newest beat of every worker, as state of constant size (update mode)."""
    newest = F.max(F.struct("t_us", "seq", "load", "service"))
    return beats.groupBy("worker").agg(newest.alias("b")).select("worker", "b.*")


def worker_status(latest: DataFrame, now_us: int, silent_after_s: int = 180) -> DataFrame:
    """idle or processing, and whether the worker has gone silent."""
    return latest.select(
        "worker",
        "seq",
        "t_us",
        F.when(F.col("service").isin("click", "purchase"), "processing").otherwise("idle").alias("state"),
        (F.lit(now_us) - F.col("t_us") > silent_after_s * 1_000_000).alias("silent"),
    )


def progress(deltas: DataFrame) -> DataFrame:
    """Running sums of progress deltas per job (update mode)."""
    return deltas.groupBy("job").agg(*[F.sum(c).alias(c) for c in ("processed", "detected", "repaired", "failed")])


def throughput_sliding(done: DataFrame, width: str = "1 hour", slide: str = "10 minutes", late: str | None = "1 hour") -> DataFrame:
    """Results per worker in sliding windows."""
    rows = _bounded(done, late).groupBy("worker", F.window("t", width, slide).alias("w"))
    return rows.agg(F.count(F.lit(1)).alias("n")).select("worker", F.unix_micros("w.start").alias("start_us"), "n")


def last_actions(log: DataFrame) -> DataFrame:
    """The newest request and the newest execution of every worker, as state of constant size (update mode).

    ``log`` has worker, t_us, seq, action and kind (request or executed).
    """
    at = F.struct("t_us", "seq", "action")
    return log.groupBy("worker").agg(
        F.max(F.when(F.col("kind") == "request", at)).alias("ask"),
        F.max(F.when(F.col("kind") == "executed", F.struct("t_us", "seq"))).alias("ran"),
    )


def pending_actions(last: DataFrame, started: DataFrame) -> DataFrame:
    """Newest action per worker that was not executed and is newer than the worker's start.

    ``last`` is the table of ``last_actions``; an execution clears every earlier request.
    """
    open_ = last.where("ask IS NOT NULL").where(
        F.col("ran").isNull() | (F.struct("ask.t_us", "ask.seq") > F.col("ran"))
    )
    fresh = open_.join(started, "worker", "left").where("started_us IS NULL OR ask.t_us > started_us")
    return fresh.select("worker", "ask.action", "ask.t_us", "ask.seq")
