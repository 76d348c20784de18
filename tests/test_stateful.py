"""Timers and joins of streams: silences, sessions, unanswered requests, over several batches."""

import json
import random
import time

import pytest

from lumenframe.streaming import jobs as J
from lumenframe.streaming import stateful as K
from lumenframe.streaming.sinks import drain

S = 1_000_000


def source(spark, folder, schema, batches):
    folder.mkdir()
    for k, rows in enumerate(batches):
        (folder / f"{k:03d}.json").write_text("\n".join(json.dumps(r) for r in rows))
        time.sleep(0.03)
    return J.with_event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder)))


def islands(beats, limit, mark):
    """What the beats up to the final watermark say."""
    out = set()
    for worker in {w for w, _ in beats}:
        times = sorted({t for w, t in beats if w == worker})
        for a, b in zip(times, [*times[1:], None]):
            if (b is None or b - a > limit) and a + limit < mark:
                out.add((worker, "silent", a + limit))
            if b is not None and b - a > limit and b <= mark:
                out.add((worker, "back", b))
    return out


def test_silences_equal_gaps_and_islands(spark, tmp_path):
    rng = random.Random(1)
    beats, now = [], 10_000
    for _ in range(400):
        now += rng.choice([1, 5, 20, 20, 61])
        beats.append((rng.randrange(3), (now - rng.randrange(30)) * S))  # out of order within the lateness
    beats += [(9, 10_000 * S)]  # never comes back
    order = sorted(beats, key=lambda b: (b[1] // (400 * S), rng.random()))
    cut = [order[k : k + 60] for k in range(0, len(order), 60)]
    # within a batch any order; a batch never holds beats older than the watermark of the one before
    mark, batches = 0, []
    for part in cut:
        batches.append([{"worker": w, "t_us": t} for w, t in part if t >= mark])
        mark = max([mark, *(t - 500 * S for _, t in part)])
    sent = [(r["worker"], r["t_us"]) for b in batches for r in b]
    assert len(sent) == len(beats)
    stream = source(spark, tmp_path / "b", "worker bigint, t_us bigint", batches)
    got = drain(K.silence(stream, 180, "500 seconds"), ["worker", "kind", "t_us"], "append", settings=K.STORE).collect()
    final = max(t for _, t in sent) - 500 * S
    want = islands(sent, 180 * S, final)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert {k for _, k, _ in want} == {"silent", "back"} and (9, "silent", 10_180 * S) in want


def test_workers_share_a_few_states(spark, tmp_path):
    rng = random.Random(2)
    beats = [(w, (10_000 + rng.randrange(1500)) * S) for w in range(300) for _ in range(rng.randrange(1, 12))]
    beats += [(7, t * S) for t in range(10_000, 11_500)]  # one that never pauses
    cut = [[b for b in beats if b[1] // (300 * S) % 50 == k] for k in range(50)]
    batches = []
    for part in filter(None, cut):
        rng.shuffle(part)
        batches.append([{"worker": w, "t_us": t} for w, t in part])
    stream = source(spark, tmp_path / "b", "worker bigint, t_us bigint", batches)
    got = K.silence(stream, 180, "500 seconds", buckets=4)
    q = got.writeStream.format("memory").queryName("shared").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = [tuple(r) for r in spark.table("shared").collect()]
    want = islands(beats, 180 * S, max(t for _, t in beats) - 500 * S)
    assert set(rows) == want and len(rows) == len(want) > 300
    assert q.lastProgress.stateOperators[0].numRowsTotal == 4  # a call of Python per bucket, not per worker


def test_silences_at_the_very_watermark(spark, tmp_path):
    mark = 2000 * S
    beats = [(1, 1000 * S), (1, mark), (2, 1000 * S), (2, mark + 1), (3, mark - 180 * S - 1), (4, mark - 180 * S), (5, mark + 60 * S)]
    batches = [[{"worker": w, "t_us": t} for w, t in beats]]
    stream = source(spark, tmp_path / "b", "worker bigint, t_us bigint", batches)
    got = drain(K.silence(stream, 180, "60 seconds"), ["worker", "kind", "t_us"], "append", settings=K.STORE).collect()
    assert {tuple(r) for r in got} == islands(beats, 180 * S, mark)
    assert {(r.worker, r.kind) for r in got} == {(1, "silent"), (1, "back"), (2, "silent"), (3, "silent")}


def test_late_beats_are_left_out_with_a_warning(spark, tmp_path):
    beat = lambda w, t: {"worker": w, "t_us": t * S}
    batches = [[beat(1, 1000)], [beat(2, 5000)], [beat(2, 5001)], [beat(1, 1100), beat(2, 5002)], [beat(2, 9000)], [beat(2, 9001)]]
    stream = source(spark, tmp_path / "b", "worker bigint, t_us bigint", batches)
    with pytest.warns(UserWarning, match="1 rows came behind"):
        got = drain(K.silence(stream, 180, "60 seconds"), ["worker", "kind", "t_us"], "append", settings=K.STORE).collect()
    assert {tuple(r) for r in got} == {(1, "silent", 1180 * S), (2, "silent", 5182 * S)}
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")  # set for the one stream only


def test_a_bracket_ends_while_a_later_frame_waits(spark, tmp_path):
    frame = lambda i, t, ev, shoot=1: {"shoot": shoot, "frame_id": i, "name": f"f{i}", "t_us": t * S, "ev": ev}
    batches = [
        [frame(2, 1030, 0.0), frame(1, 1000, -2.0), frame(3, 1060, 2.0), frame(4, 1080, -2.0), frame(5, 1150, 1.0, 2)],
        [frame(6, 1145, 2.0), frame(7, 1130, 0.0), frame(8, 1240, -2.0)],  # the watermark after it, 1180 s, is within a pause of the frame at 1145 s
        [frame(9, 1280, 0.0, 2)],
        [frame(10, 1279, 0.0, 2)],
    ]
    schema = "shoot bigint, frame_id bigint, name string, t_us bigint, ev double"
    stream = source(spark, tmp_path / "f", schema, batches)
    got = drain(K.bracket_stream(stream, 60.0, "60 seconds", buckets=1), ["shoot", "cluster", "frame_id"], "append", settings=K.STORE)
    rows = {(r.shoot, r.cluster // S, r.frame_id) for r in got.collect()}
    # the last watermark is 1220 s: the frame at 1240 s waits, the brackets before it are a full pause behind the watermark
    assert rows == {(1, 1000, 1), (1, 1000, 2), (1, 1000, 3), (1, 1080, 4), (1, 1080, 7), (1, 1080, 6), (2, 1150, 5)}


def test_unanswered_requests_come_out_once(spark, tmp_path):
    ask = lambda seq, w, a, t: {"seq": seq, "worker": w, "action": a, "t_us": t * S}
    asks = [
        [ask(1, 1, "restart", 100), ask(2, 1, "restart", 130)],  # the later one does not hide the first
        [ask(3, 1, "reboot", 300), ask(4, 2, "restart", 310)],
        [ask(5, 3, "restart", 9000)],
        [ask(6, 3, "restart", 9001)],
    ]
    runs = [
        [ask(0, 1, "restart", 155)],  # within a minute of the first two
        [ask(0, 1, "restart", 310), ask(0, 2, "restart", 371)],  # another action; a second late
        [ask(0, 3, "restart", 9010)],
        [ask(0, 3, "restart", 9011)],
    ]
    schema = "seq bigint, worker bigint, action string, t_us bigint"
    requests, executions = source(spark, tmp_path / "a", schema, asks), source(spark, tmp_path / "r", schema, runs)
    got = drain(K.unanswered(requests, executions, "1 minute", "30 seconds"), ["seq"], "append").collect()
    assert sorted(r.seq for r in got) == [3, 4]


def test_sessions_keep_a_pause_of_just_the_gap(spark, tmp_path):
    frame = lambda i, t, ev, shoot=1: {"shoot": shoot, "frame_id": i, "name": f"f{i}", "t_us": t * S, "ev": ev}
    batches = [
        [frame(1, 1000, -2.0), frame(3, 1120, 2.0), frame(2, 1060, 0.0), frame(4, 1181, 0.5), frame(5, 1000, None)],
        [frame(9, 50_000, -9.0, 2)], [frame(10, 90_000, -9.0, 2)], [frame(11, 90_001, -9.0, 2)],
    ]
    schema = "shoot bigint, frame_id bigint, name string, t_us bigint, ev double"
    got = drain(K.bracket_sessions(source(spark, tmp_path / "f", schema, batches)), ["shoot", "cluster"], "append")
    rows = {(r.cluster // S, r.n, r.under, r.mid, r.over) for r in got.where("shoot = 1").collect()}
    assert rows == {(1000, 3, 1, 2, 3), (1181, 1, None, 4, None)}
