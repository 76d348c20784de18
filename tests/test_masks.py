"""Masks: morphology, components, IoU edge cases, resampling."""

import random

import pytest
from pyspark.sql import functions as F

from lumenframe.operators import evaluation as E
from lumenframe.operators import masks as M

W, H = 13, 9


@pytest.fixture(scope="module")
def mask(spark):
    rng = random.Random(1)
    px = {(i, x, y) for i in (1, 2) for x in range(W) for y in range(H) if rng.random() < 0.55}
    dims = spark.createDataFrame([(1, W, H), (2, W, H), (3, W, H)], "image_id bigint, w int, h int")
    return px, spark.createDataFrame(sorted(px), "image_id bigint, x int, y int"), dims


def disk(r):
    return [(dx, dy) for dx in range(-r, r + 1) for dy in range(-r, r + 1) if dx * dx + dy * dy <= r * r]


def inside(x, y):
    return 0 <= x < W and 0 <= y < H


def dilate(px, r):
    return {(i, x + dx, y + dy) for i, x, y in px for dx, dy in disk(r) if inside(x + dx, y + dy)}


def erode(px, r):
    full = {(i, x, y) for i in (1, 2, 3) for x in range(W) for y in range(H)}
    return {p for p in full if all((p[0], p[1] + dx, p[2] + dy) in px for dx, dy in disk(r) if inside(p[1] + dx, p[2] + dy))}


def as_set(df):
    return {(r.image_id, r.x, r.y) for r in df.collect()}


@pytest.mark.parametrize("r", [1, 2, 3])
def test_open_and_close(mask, r):
    px, df, dims = mask
    assert as_set(M.morph_open_close(df, dims, r, 0)) == dilate(erode(px, r), r)
    assert as_set(M.morph_open_close(df, dims, 0, r)) == erode(dilate(px, r), r)


def test_closing_is_idempotent(mask):
    _, df, dims = mask
    once = M.morph_open_close(df, dims, 0, 2)
    assert as_set(M.morph_open_close(once, dims, 0, 2)) == as_set(once)


def flood(px):
    seen, out = set(), set()
    for p in sorted(px):
        if p in seen:
            continue
        todo, comp = [p], set()
        while todo:
            q = todo.pop()
            if q in seen or q not in px:
                continue
            seen.add(q)
            comp.add(q)
            i, x, y = q
            todo += [(i, x + 1, y), (i, x - 1, y), (i, x, y + 1), (i, x, y - 1)]
        out.add(frozenset(comp))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_components(mask, parts):
    px, df, _ = mask
    got = {}
    for r in M.connected_components(df.repartition(parts)).collect():
        got.setdefault((r.image_id, r.component), set()).add((r.image_id, r.x, r.y))
    assert {frozenset(v) for v in got.values()} == flood(px)


def test_a_long_snake_is_one_component(spark):
    snake = [(1, x, y) for y in range(0, 40, 2) for x in range(30)]
    snake += [(1, 29 if y % 4 == 1 else 0, y) for y in range(1, 39, 2)]
    df = spark.createDataFrame(snake, "image_id bigint, x int, y int")
    assert M.connected_components(df).select("component").distinct().count() == 1


def test_iou_edges(spark):
    none = spark.createDataFrame([], "image_id bigint, x int, y int")
    one = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, 0, 0)], "image_id bigint, x int, y int")
    images = spark.createDataFrame([(1,), (2,), (3,)], "image_id bigint")
    assert {r.image_id: r.iou for r in M.mask_iou(none, none, images).collect()} == {1: 1.0, 2: 1.0, 3: 1.0}
    assert {r.image_id: r.iou for r in M.mask_iou(one, none, images).collect()} == {1: 0.0, 2: 0.0, 3: 1.0}
    half = one.where("x = 0")
    a = {r.image_id: r.iou for r in M.mask_iou(one, half, images).collect()}
    assert a == {1: 0.5, 2: 1.0, 3: 1.0}
    assert a == {r.image_id: r.iou for r in M.mask_iou(half, one, images).collect()}


def test_resize_reads_one_source_pixel_per_target(mask):
    px, df, dims = mask
    for w, h in ((5, 4), (13, 9), (30, 20)):
        want = {
            (i, x, y) for i in (1, 2) for x in range(w) for y in range(h)
            if (i, (2 * x + 1) * W // (2 * w), (2 * y + 1) * H // (2 * h)) in px
        }
        assert as_set(M.resize_nearest(df, dims, w, h)) == want


def test_empty_mask_takes_the_whole_frame_as_roi(mask):
    _, df, dims = mask
    roi = {r.image_id: (r.x0, r.y0, r.x1, r.y1) for r in M.mask_roi(df, dims).collect()}
    assert roi[3] == (0, 0, W, H)


BOX = "image bigint, cls int, box_id string, x0 int, y0 int, x1 int, y1 int, score double"


def test_average_precision_by_hand(spark):
    truth = spark.createDataFrame([(1, 1, "t1", 0, 0, 10, 10, 0.0), (1, 1, "t2", 50, 50, 60, 60, 0.0)], BOX)
    det = spark.createDataFrame(
        [(1, 1, "a", 0, 0, 10, 10, 0.9), (1, 1, "b", 1, 0, 11, 10, 0.8), (1, 1, "c", 50, 51, 60, 61, 0.7), (1, 2, "d", 0, 0, 5, 5, 0.5)], BOX
    )
    ap = {r.cls: r for r in E.average_precision(det, truth).collect()}
    assert ap[1].tp == 2 and abs(ap[1].ap - (1.0 * 0.5 + 2 / 3 * 0.5)) < 1e-9
    assert ap[2].n_pos == 0 and ap[2].ap != ap[2].ap
    m = E.mean_average_precision(E.average_precision(det, truth)).first()
    assert abs(m.map - ap[1].ap) < 1e-9 and abs(m.map_half - ap[1].ap / 2) < 1e-9


def test_detector_reason_is_cut_like_the_whole_list(spark):
    rows = [(1, 1, f"b{i:03d}", 0, 0, 5, 5, 0.5 + i % 50 / 100) for i in range(300)]
    det = spark.createDataFrame(rows, BOX).withColumn("label", F.lit("x"))
    images = spark.createDataFrame([(1,), (2,)], "image bigint")
    got = {r.image: r for r in E.detector_summary(det, images, "image").collect()}
    order = sorted(rows, key=lambda r: (-r[7], r[2]))
    assert got[1].reason == ", ".join(f"x {r[7]:.2f}" for r in order)[:480]
    assert (got[2].positive, got[2].confidence, got[2].reason) == (False, None, "")


def test_overlays_of_runs_equal_sets_of_pixels(spark):
    rng = random.Random(12)

    def mask():
        return [(i, x0, y, min(29, x0 + rng.randrange(6))) for i in range(3) for y in range(4) for x0 in rng.sample(range(30), rng.randrange(5))]

    def pixels(runs):
        return {(i, x, y) for i, x0, y, x1 in runs for x in range(x0, x1 + 1)}

    for _ in range(4):
        a, b = mask(), mask()
        df = [spark.createDataFrame(m or [(9, 0, 0, -1)], "image_id int, x0 int, y int, x1 int").where("x1 >= x0") for m in (a, b)]
        pa, pb = pixels(a), pixels(b)
        for mode, want in (("and", pa & pb), ("or", pa | pb), ("only_a", pa), ("only_b", pb)):
            got = M.combine_runs(*df, mode)
            assert {tuple(r) for r in M.to_pixels(got).select("image_id", "x", "y").collect()} == want
            # merged: a row never has two runs that touch
            assert got.count() == M.to_runs(M.to_pixels(got)).count()
        images = spark.range(4).select(F.col("id").cast("int").alias("image_id"))
        iou = {r.image_id: r.iou for r in M.run_iou(*df, images).collect()}
        for i in range(4):
            x, y = {p for p in pa if p[0] == i}, {p for p in pb if p[0] == i}
            assert iou[i] == (len(x & y) / len(x | y) if x | y else 1.0)


def test_repeated_pixels_count_once(spark):
    m = spark.createDataFrame([(1, 2, 0), (1, 3, 0), (1, 3, 0), (1, 5, 0)], "image_id int, x int, y int")
    assert sorted(tuple(r) for r in M.to_runs(m).select("x0", "x1").collect()) == [(2, 3), (5, 5)]
    assert M.mask_iou(m, m, m.select("image_id").distinct()).first().iou == 1.0


def test_overlays_move_runs_not_pixels(spark):
    """Two rows of a million pixels each: a handful of events."""
    a = spark.createDataFrame([(1, 0, 0, 999_999), (1, 0, 1, 999_999)], "image_id int, x0 int, y int, x1 int")
    b = spark.createDataFrame([(1, 500_000, 0, 2_000_000)], "image_id int, x0 int, y int, x1 int")
    parts = M.overlay(a, b)
    assert parts.count() == 4
    assert M.run_iou(a, b, spark.createDataFrame([(1,)], "image_id int")).first().iou == 500_000 / 3_000_001


def test_tasks_of_a_raster_follow_the_boxes(spark):
    """Every covered pixel once, however boxes overlap; more boxes make more tasks, not larger ones."""
    rng = random.Random(4)
    rows = [(i % 7, rng.random() * 0.8, rng.random() * 0.8, rng.random() * 0.3, rng.random() * 0.3) for i in range(400)]
    boxes = spark.createDataFrame(rows, "image_id int, x double, y double, w double, h double")
    dims = spark.createDataFrame([(i, 20, 12) for i in range(7)], "image_id int, w int, h int")
    got = M.rasterize_boxes(boxes, dims, False, per_task=10)
    want = set()
    for i, x, y, w, h in rows:
        want |= {(i, a, b) for a in range(int(x * 20), min(20, int((x + w) * 20))) for b in range(int(y * 12), min(12, int((y + h) * 12)))}
    cells = [(r.image_id, r.x, r.y) for r in got.collect()]
    assert len(cells) == len(set(cells)) and set(cells) == want
    assert got.rdd.getNumPartitions() == 40
