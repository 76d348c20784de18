"""Incident cases of bracket detection."""

import itertools

import pytest

from lumenframe.operators import brackets as B

COLS = "shoot bigint, frame_id bigint, name string, ext string, t_us bigint, ev double, size bigint"


def frames(spark, rows, shoot=1):
    data = [
        (shoot, i, r[2] if len(r) > 2 else f"DSC{i:05d}.ARW", "ARW", int(r[0] * 1_000_000), r[1], 100) for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, COLS)


def triplets(spark, rows, gap=60.0, slot_hours=24):
    f = frames(spark, rows)
    clusters = B.bracket_clusters(B.dedupe_frames(f), gap, slot_hours)
    got = B.select_triplets(clusters).orderBy("cluster").collect()
    evs = {r.frame_id: r.ev for r in f.collect()}
    return [(evs[r.under], evs[r.mid], evs[r.over]) for r in got], f, clusters


def test_slow_long_exposure_stays_in_its_bracket(spark):
    got, *_ = triplets(spark, [(0, -3.0), (1, 0.0), (9, 3.0)])
    assert got == [(-3.0, 0.0, 3.0)]


def test_five_frames_give_the_inner_three(spark):
    got, *_ = triplets(spark, [(i, ev) for i, ev in enumerate([-4.0, -2.0, 0.0, 2.0, 4.0])])
    assert got == [(-2.0, 0.0, 2.0)]


def test_back_to_back_brackets_are_split_by_ev(spark):
    got, *_ = triplets(spark, [(i, ev) for i, ev in enumerate([-2.0, 0.0, 2.0, -2.0, 0.0, 2.0])])
    assert got == [(-2.0, 0.0, 2.0)] * 2


def test_a_long_pause_splits(spark):
    got, f, clusters = triplets(spark, [(0, -2.0), (1, 0.0), (70, 2.0)])
    assert got == []
    reasons = sorted(r.reason for r in B.bracket_failures(clusters, f).collect())
    assert reasons == ["only 1 frame(s)", "only 2 frame(s)"]


def test_one_frame_cannot_fill_two_slots(spark):
    got, f, clusters = triplets(spark, [(0, -1.0), (1, -1.0), (2, 1.0)])
    assert got == []
    assert [r.reason for r in B.bracket_failures(clusters, f).collect()] == ["same frame in two slots"]


def test_missing_roles_and_missing_data(spark):
    f = frames(spark, [(0, -2.0), (1, -1.5), (2, -1.2), (300, None)])
    clusters = B.bracket_clusters(B.dedupe_frames(f))
    assert sorted(r.reason for r in B.bracket_failures(clusters, f).collect()) == ["EV missing", "no mid frame"]


def test_duplicate_upload_keeps_the_plain_raw(spark):
    rows = [(0, 0.0, "x (1).ARW"), (0, 0.0, "x.JPG"), (0.0004, 0.0, "x.ARW")]
    assert [r.name for r in B.dedupe_frames(frames(spark, rows)).collect()] == ["x.ARW"]


@pytest.mark.parametrize("slot_hours", [1, 24])
def test_brackets_across_slot_borders(spark, slot_hours):
    start = 86_400 - 3  # the bracket crosses midnight
    rows = [(start + i * 2, ev) for i, ev in enumerate([-2.0, 0.0, 2.0, -2.0, 0.0, 2.0])]
    assert triplets(spark, rows, slot_hours=slot_hours)[0] == [(-2.0, 0.0, 2.0)] * 2


def test_clusters_do_not_depend_on_partitions_or_slots(spark):
    evs = [-2.0, 0.0, 2.0, 1.0, -3.0, 0.0, 0.0, 3.0]
    rows = [(i * 1700, evs[i % 8]) for i in range(120)]
    base = None
    for parts, hours in itertools.product((1, 16), (1, 24)):
        f = frames(spark, rows).repartition(parts)
        got = sorted((r.frame_id, r.cluster) for r in B.bracket_clusters(f, 2000.0, hours).collect())
        base = base or got
        assert got == base


def counters(spark, evs, skip=()):
    rows = [(1, n, f"DSC{n:05d}.ARW", ev) for n, ev in enumerate(evs) if n not in skip]
    return spark.createDataFrame(rows, "shoot bigint, number bigint, name string, ev double")


def walk(evs, skip=()):
    """The counter rule in plain Python."""
    have = {n: ev for n, ev in enumerate(evs) if n not in skip}
    order, out, i = sorted(have), [], 0
    while i + 2 < len(order):
        a, b, c = order[i : i + 3]
        if (b, c) == (a + 1, a + 2):
            trio = [have[a], have[b], have[c]]
            lo, hi = min(trio), max(trio)
            if lo != hi:
                mid = sum(trio) - lo - hi
                bad = "no under" if lo >= 0 else "no over" if hi <= 0 else "mid" if abs(mid) > 1 else "ok"
                out.append((a, bad))
                if bad == "ok":
                    i += 3
                    continue
        i += 1
    return out


@pytest.mark.parametrize("width", [2, 3, 7, 4096])
def test_counter_mode_consumes_like_a_walk(spark, width):
    pattern = [-2.0, 0.0, 2.0, -2.0, 0.0, 2.0, 0.5, -2.0, 0.0, 2.0, 3.0, 0.0, -1.0, 2.0, 0.0]
    evs, skip = pattern * 3, {17, 31}
    got = B.sliding_triplets(counters(spark, evs, skip), width).orderBy("start").collect()
    short = {"no under-exposed frame": "no under", "no over-exposed frame": "no over", "mid frame out of range": "mid", "ok": "ok"}
    assert [(r.start, short[r.verdict]) for r in got] == walk(evs, skip)


@pytest.mark.parametrize("chain", [2, 3])
def test_blocks_are_chained_by_levels(spark, monkeypatch, chain):
    monkeypatch.setattr(B, "_CHAIN", chain)
    pattern = [-2.0, 0.0, 2.0, -2.0, 0.0, 2.0, 0.5, -2.0, 0.0, 2.0, 3.0, 0.0, -1.0, 2.0, 0.0]
    evs, skip = pattern * 4, {17, *range(31, 40)}
    got = B.sliding_triplets(counters(spark, evs, skip), 2).orderBy("start").collect()
    assert [r.start for r in got] == [a for a, _ in walk(evs, skip)]


def test_catalog_prefers_raw_and_keeps_free_names(spark):
    names = ["DSC02600.JPG", "DSC02600.ARW", "IMG_0007.jpg", "Photo May 04.arw", "notes.txt", "dsc02601.dng"]
    got = B.frame_catalog(spark.createDataFrame([(1, n) for n in names], "shoot bigint, name string")).collect()
    assert sorted((r.place, r.number, r.name) for r in got if r.place == 0) == [
        (0, 7, "IMG_0007.jpg"), (0, 2600, "DSC02600.ARW"), (0, 2601, "dsc02601.dng"),
    ]
    assert [r.name for r in got if r.place == 1] == ["Photo May 04.arw"]
