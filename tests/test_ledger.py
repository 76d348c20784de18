"""Requests are answered once, whatever stops in between."""

import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lumenframe.operators import writes as W
from lumenframe.sources import tables as T
from lumenframe.streaming import jobs as J
from lumenframe.streaming.ledger import Ledger, answer, one_per_key


def feed(folder, name, rows):
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))
    time.sleep(0.05)


def requests(*ids):
    return [{"id": i, "job": 1, "k": len(i), "t_us": 1} for i in ids]


def run(spark, src, out, checkpoint, then=None, archive=None):
    stream = T.stream_requests(spark, str(src), files_per_batch=1, archive=archive)
    results = J.request_results(stream, F.col("k") == 3, F.lit("bad"))
    return sorted(r.id for r in answer(results, ["id"], str(out), str(checkpoint), then, buckets=8).collect())


@pytest.mark.parametrize("stop_after_results", [False, True])
def test_a_stopped_stream_answers_every_request_once(spark, tmp_path, monkeypatch, stop_after_results):
    src = tmp_path / "q"
    src.mkdir()
    feed(src, "1", requests("a", "bb", "ccc"))
    feed(src, "2", requests("bb", "dddd"))
    calls = []

    def stops(rows):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return rows

    if stop_after_results:
        add = Ledger.add
        monkeypatch.setattr(Ledger, "add", lambda self, rows, part: add(self, stops(rows), part))
    with pytest.raises(StreamingQueryException, match="stopped"):
        run(spark, src, tmp_path / "out", tmp_path / "check", None if stop_after_results else stops)
    monkeypatch.undo()
    feed(src, "3", requests("a", "dddd", "eeeee"))  # replayed and new
    assert run(spark, src, tmp_path / "out", tmp_path / "check") == ["a", "bb", "ccc", "dddd", "eeeee"]
    feed(src, "4", requests("eeeee"))
    assert run(spark, src, tmp_path / "out", tmp_path / "check") == ["a", "bb", "ccc", "dddd", "eeeee"]
    # a new checkpoint sees all files again and answers nothing twice
    assert run(spark, src, tmp_path / "out", tmp_path / "other") == ["a", "bb", "ccc", "dddd", "eeeee"]


def test_answered_files_are_archived(spark, tmp_path):
    src = tmp_path / "q"
    src.mkdir()
    for k in range(4):
        feed(src, str(k), requests("x" * (k + 1)))
    # files of a batch go when the batch after it has begun
    assert len(run(spark, src, tmp_path / "out", tmp_path / "check", archive=str(tmp_path / "done"))) == 4
    gone = [p.name for p in (tmp_path / "done").rglob("*.json")]
    left = [p.name for p in src.glob("*.json")]
    assert sorted(gone + left) == [f"{k}.json" for k in range(4)] and len(gone) >= 2


def test_a_batch_opens_its_own_buckets_only(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), ["id"], buckets=16, parts=3)
    ids = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))
    mine = ids.where(ledger.bucket() == 5).limit(10).persist()
    ledger.add(mine, "first")
    before = ledger.opened([5])
    for k in range(10):
        others = ids.where((ledger.bucket() != 5) & (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) == k))
        ledger.add(ledger.fresh(others, f"b{k}"), f"b{k}")
        ledger.merge(ledger.buckets_of(others), but=f"b{k}")
    assert ledger.opened([5]) == before and ledger.buckets_of(mine) == [5]
    assert ledger.fresh(mine, "later").count() == 0 and ledger.fresh(mine, "first").count() == 10
    # merged: no bucket keeps more parts than allowed beside the newest
    assert max(len(ledger._held(b)) for b in range(16)) <= 3 + 1
    assert ledger.known(range(16)).count() == ids.where(ledger.bucket() != 5).count() + 10
    wide = ledger.widened(str(tmp_path / "wide"), 64)
    assert wide.known(range(64)).count() == ledger.known(range(16)).count()
    assert wide.opened([3]) < ledger.opened(range(16)) / 8


def test_null_keys_and_repeats(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), ["id"])
    rows = spark.createDataFrame([("a", 2), ("a", 1), (None, 3)], "id string, k int")
    assert ledger.fresh(rows, "p").count() == 2
    assert [tuple(r) for r in one_per_key(rows.dropna(), ["id"]).collect()] == [("a", 1)]
    empty = rows.limit(0)
    ledger.add(empty, "e")
    assert ledger.fresh(empty, "f").count() == 0


def test_queue_is_drained_against_the_ledger(spark, tmp_path):
    """Two passes over one queue: the second answers what is new and clears the rest."""
    ledger = Ledger(spark, str(tmp_path / "l"), ["id"])
    first = spark.createDataFrame([("a", 1), ("b", 10)], "id string, k int")
    got = W.drain_ledger(first, ledger, "pass-1", F.col("k") % 10 == 0, F.lit("no"))
    assert {(r.id, r.status) for r in got.collect()} == {("a", "done"), ("b", "error")}
    again = W.drain_ledger(first, ledger, "pass-1", F.col("k") % 10 == 0, F.lit("no"))  # replayed
    assert {(r.id, r.status) for r in again.collect()} == {("a", "done"), ("b", "error")}
    second = first.unionByName(spark.createDataFrame([("c", 3)], "id string, k int"))
    got = W.drain_ledger(second, ledger, "pass-2", F.col("k") % 10 == 0, F.lit("no"))
    assert {(r.id, r.status) for r in got.collect()} == {("a", "cleared"), ("b", "cleared"), ("c", "done")}
