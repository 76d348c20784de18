"""Stencils over tiles against whole images."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import pixels as X
from lumenframe.plans.tiles import box_sums, laplacian_of, over_tiles, together


def planes(spark, shapes, seed=1):
    rng = np.random.default_rng(seed)
    images = [rng.integers(0, 256, (2, h, w)) for h, w in shapes]
    rows = [(k, x, y, int(m[0, y, x]), int(m[1, y, x])) for k, m in enumerate(images) for y in range(m.shape[1]) for x in range(m.shape[2])]
    return images, spark.createDataFrame(rows, "image int, x int, y int, a int, b int").repartition(5)


@pytest.mark.parametrize("size", [5, 16, 256])
def test_tiles_equal_whole_images(spark, size):
    images, df = planes(spark, [(23, 31), (7, 7), (3, 40), (1, 1)])
    for mirrored in (False, True):
        stencil = together(box_sums("a", "b", 7, mirrored), laplacian_of("a"))
        outputs = {**dict.fromkeys(("sa", "sb", "saa", "sbb", "sab"), "bigint"), "lap": "double"}
        got = {(r.image, r.x, r.y): r for r in over_tiles(df, ["image"], ["a", "b"], stencil, outputs, 3, size).collect()}
        assert len(got) == sum(m[0].size for m in images)
        for k, (a, b) in enumerate(images):
            h, w = a.shape
            pa_, pb = (np.pad(v, 3, mode="symmetric") for v in (a, b))
            edge = lambda i, n: i if 0 <= i < n else (-i if i < 0 else 2 * n - 2 - i) if n > 1 else 0
            for y in range(h):
                for x in range(w):
                    r = got[k, x, y]
                    inside = 3 <= y < h - 3 and 3 <= x < w - 3
                    if mirrored or inside:
                        p, q = pa_[y : y + 7, x : x + 7], pb[y : y + 7, x : x + 7]
                        assert (r.sa, r.sb, r.saa, r.sbb, r.sab) == (p.sum(), q.sum(), (p * p).sum(), (q * q).sum(), (p * q).sum())
                    else:
                        assert r.sa is None
                    lap = sum(a[edge(y + d, h), x] + a[y, edge(x + d, w)] for d in (-1, 1)) - 4 * a[y, x]
                    assert r.lap == lap


def test_one_exchange_for_all_metrics(spark):
    images, df = planes(spark, [(20, 20), (9, 30)])
    got = X.pair_metrics(df, 0.5, mirrored=True)
    rows = {r.image: r for r in got.collect()}
    sharp = {r.image: r.sharpness for r in X.sharpness(df, "a").collect()}
    ssim = {r.image: r for r in X.ssim_mean(X.ssim_map(df, mirrored=True), 0.5).collect()}
    for k in range(2):
        assert (rows[k].ssim, rows[k].changed) == (ssim[k].ssim, ssim[k].changed) and abs(rows[k].sharpness_a - sharp[k]) < 1e-6
    plan = X.ssim_map(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_empty_plane(spark):
    _, df = planes(spark, [(2, 2)])
    assert X.ssim_map(df.limit(0)).collect() == [] and X.laplacian(df.where(F.lit(False)), "a").collect() == []
