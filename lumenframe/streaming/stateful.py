"""Streams with state and event-time timers: silent workers, brackets as frames arrive.

Rows wait in state until the watermark has passed them, so late ones within the allowed time fall into
place; a timeout settles what has become certain.  A call of Python with its state costs about 10 ms, so
keys share a state by hash and are settled together.  ``drain(..., settings=STORE)`` keeps the states in RocksDB.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

SILENCE_ROW = "worker bigint, kind string, t_us bigint"
SILENCE_STATE = "worker array<bigint>, start array<bigint>, end array<bigint>, silent array<boolean>"

#: Start of a run whose first beat is certain: all that comes before its end belongs to it.
_BEGUN = -(2**62)


def _runs(worker: np.ndarray, start: np.ndarray, end: np.ndarray, silent: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """Pieces of beats joined where no pause beyond ``limit`` parts them, by worker and time."""
    order = np.lexsort((start, worker))
    worker, start, end, silent = worker[order], start[order], end[order], silent[order]
    reach = pd.Series(end).groupby(worker).cummax().to_numpy()
    opens = np.ones(len(worker), bool)
    opens[1:] = (worker[1:] != worker[:-1]) | (start[1:] - reach[:-1] > limit)
    at = np.flatnonzero(opens)
    return worker[at], start[at], np.maximum.reduceat(end, at), np.maximum.reduceat(silent, at)


def _silences(limit: int, key: tuple[Any, ...], rows: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Workers of one bucket: per worker the run it is in, whether it is silent, and the runs beyond the watermark."""
    mark = state.getCurrentWatermarkMs() * 1000
    held = state.getOption or ([], [], [], [])
    pieces = [tuple(np.array(v, d) for v, d in zip(held, ("int64", "int64", "int64", "bool")))]
    for b in () if state.hasTimedOut else rows:
        w, t = b["worker"].to_numpy(), b["t_us"].to_numpy()
        pieces.append(_runs(w, t, t, np.zeros(len(t), bool), limit))  # a chunk of rows leaves its runs alone
    worker, start, end, silent = _runs(*map(np.concatenate, zip(*pieces)), limit)
    same = np.r_[worker[1:] == worker[:-1], False]  # a later run of the worker follows
    sure = start <= mark
    back = sure & (start != _BEGUN) & np.r_[False, same[:-1]]
    quiet = sure & ~silent & (end + limit < mark)
    keep = ~(same & np.r_[sure[1:], False])
    over = (
        pd.DataFrame({"worker": worker[quiet], "kind": "silent", "t_us": end[quiet] + limit}),
        pd.DataFrame({"worker": worker[back], "kind": "back", "t_us": start[back]}),
    )
    worker, start, end, silent = worker[keep], np.where(sure, _BEGUN, start)[keep], end[keep], (silent | quiet)[keep]
    state.update((worker.tolist(), start.tolist(), end.tolist(), silent.tolist()))
    # the next moment at which something is certain; a timeout fires once the watermark is beyond it
    due = np.r_[-(-start[start != _BEGUN] // 1000) - 1, (end + limit)[(start == _BEGUN) & ~silent] // 1000]
    if len(due):
        state.setTimeoutTimestamp(max(int(due.min()), 1))
    yield from (o for o in over if len(o))


def silence(beats: DataFrame, silent_after_s: float = 180.0, late: str = "2 minutes", buckets: int = 1024) -> DataFrame:
    """``worker``, ``kind``, ``t_us``: "silent" when a worker has sent nothing for ``silent_after_s`` (at that
    moment), "back" at its next beat.

    ``beats`` has ``worker``, ``t_us`` and event time ``t``.  Beats may come out of order within ``late``; later
    ones are left out.  State holds one beat per worker and, of the lateness window, first and last beat of
    each run without a silence.  A call of Python costs milliseconds, so workers share states: ``buckets`` of
    them by hash, as many for the life of a checkpoint.
    """
    bucket = F.pmod(F.xxhash64("worker"), F.lit(buckets)).alias("bucket")
    rows = beats.where("worker IS NOT NULL AND t IS NOT NULL").select(bucket, "worker", "t_us", "t").withWatermark("t", late)
    step = partial(_silences, int(silent_after_s * 1_000_000))
    return rows.groupBy("bucket").applyInPandasWithState(step, SILENCE_ROW, SILENCE_STATE, "append", "EventTimeTimeout")


BRACKET_ROW = "shoot bigint, cluster bigint, frame_id bigint, name string, t_us bigint, ev double"


BRACKET_STATE = "shoot array<bigint>, t_us array<bigint>, name array<string>, frame_id array<bigint>, ev array<double>"


def _brackets(gap: int, key: tuple[Any, ...], rows: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Shoots of one bucket: per shoot the frames of the one open bracket and those beyond the watermark."""
    mark = state.getCurrentWatermarkMs() * 1000
    columns = [c.split()[0] for c in BRACKET_STATE.split(", ")]
    held = [pd.DataFrame(dict(zip(columns, state.get)))] if state.exists else []
    new = [] if state.hasTimedOut else [b[columns] for b in rows]
    frames = pd.concat([*held, *new]).sort_values(columns[:4], ignore_index=True)
    sure = (frames["t_us"] < mark).to_numpy()
    f, rest = frames[sure], frames[~sure]
    shoot, t, ev = (f[c].to_numpy() for c in ("shoot", "t_us", "ev"))
    opens = np.ones(len(f), bool)
    opens[1:] = (shoot[1:] != shoot[:-1]) | (ev[1:] < ev[:-1]) | (t[1:] - t[:-1] > gap)
    first = np.flatnonzero(opens)
    size = np.diff(np.r_[first, len(f)])
    end = t[first + size - 1] + gap
    ended = end < mark
    ended[:-1] |= shoot[first[1:]] == shoot[first[:-1]]
    closed = np.repeat(ended, size)
    out = f.assign(cluster=np.repeat(t[first], size))[closed]
    keep = pd.concat([f[~closed], rest])
    # the next moment at which something is certain; a timeout fires once the watermark is beyond it
    due = np.r_[rest["t_us"].to_numpy(), end[~ended]]
    if len(due):
        state.update(tuple(keep[c].tolist() for c in columns))
        state.setTimeoutTimestamp(max(int(due.min()) // 1000, 1))
    elif state.exists:
        state.remove()
    if len(out):
        yield out[[c.split()[0] for c in BRACKET_ROW.split(", ")]]


def bracket_stream(frames: DataFrame, max_gap_s: float = 60.0, late: str = "2 minutes", buckets: int = 1024) -> DataFrame:
    """Frames labelled with their bracket (named by its first capture time) once it has closed.

    A bracket closes when a frame with a lower EV or after too long a pause follows, or when the
    watermark is a full pause beyond its last frame.  Frames without an EV are left out.  Shoots share
    states: ``buckets`` of them by hash, as many for the life of a checkpoint.
    """
    bucket = F.pmod(F.xxhash64("shoot"), F.lit(buckets)).alias("bucket")
    rows = frames.where("ev IS NOT NULL AND shoot IS NOT NULL").select(bucket, "shoot", "frame_id", "name", "t_us", "ev", "t")
    step = partial(_brackets, int(max_gap_s * 1_000_000))
    grouped = rows.withWatermark("t", late).groupBy("bucket")
    return grouped.applyInPandasWithState(step, BRACKET_ROW, BRACKET_STATE, "append", "EventTimeTimeout")


def bracket_sessions(frames: DataFrame, max_gap_s: float = 60.0, late: str = "2 minutes") -> DataFrame:
    """Brackets by pauses alone: ``shoot``, ``cluster`` (first capture time), ``n``, ``last_us``, ``under``, ``mid``, ``over``.

    A session ends after a pause of more than ``max_gap_s``.  ``mid`` is the frame nearest to EV 0 (within
    1), ``under`` and ``over`` the nearest ones at -1 and below, 1 and above; ties go to the earlier frame.
    """
    ev, order = F.col("ev"), ("t_us", "name")
    rows = frames.where("ev IS NOT NULL AND shoot IS NOT NULL").withWatermark("t", late)
    gap = F.session_window("t", f"{int(max_gap_s * 1_000_000) + 1} microseconds")

    def nearest(where, by):
        return F.min(F.when(where, F.struct(by.alias("by"), *order, "frame_id")))["frame_id"]

    got = rows.groupBy("shoot", gap).agg(
        F.min("t_us").alias("cluster"),
        F.count(F.lit(1)).alias("n"),
        F.max("t_us").alias("last_us"),
        nearest(ev <= -1, -ev).alias("under"),
        nearest(F.abs(ev) <= 1, F.abs(ev)).alias("mid"),
        nearest(ev >= 1, ev).alias("over"),
    )
    return got.select("shoot", "cluster", "n", "last_us", "under", "mid", "over")


def unanswered(requests: DataFrame, executions: DataFrame, within: str = "10 minutes", late: str = "2 minutes") -> DataFrame:
    """Requests that no execution of the same worker and action followed within ``within``; each comes out once.

    ``requests`` has ``worker``, ``action``, ``t_us``, ``seq`` and event time ``t``; ``executions`` has ``worker``,
    ``action`` and ``t``.  An outer join of two streams: state holds the requests whose time is not up.
    """
    ask = requests.withWatermark("t", late)
    ran = executions.select(F.col("worker").alias("w"), F.col("action").alias("a"), F.col("t").alias("ran")).withWatermark("ran", late)
    near = (F.col("worker") == F.col("w")) & (F.col("action") == F.col("a"))
    near = near & (F.col("ran") >= F.col("t")) & (F.col("ran") <= F.col("t") + F.expr(f"INTERVAL {within}"))
    return ask.join(ran, near, "left_outer").where("ran IS NULL").select("worker", "action", "t_us", "seq")
