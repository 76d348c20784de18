import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def vectors(n, d, seed=1, scale=None):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * (np.ones(d) if scale is None else scale)
    return x.astype(np.float32)


def reference(x):
    """Dense eigenvectors of the exact covariance."""
    f = np.floor(64 * x.astype(np.float64))
    n = len(f)
    whole = [[int(v) for v in r] for r in f]
    sums = [sum(c) for c in zip(*whole)]
    centred = np.array([[n * v - s for v, s in zip(r, sums)] for r in whole], float) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * v - s) ** 2 for v, s in zip(r, sums)) for r in whole]
    return values[::-1], basis[:, ::-1], centred, deviation


def compare(got, x, components):
    values, basis, centred, deviation = reference(x)
    n = len(x)
    by = {(r.vec_id, r.component): r for r in got}
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == len(by) == n * k
    for j in range(k):
        want = centred @ basis[:, j] / math.sqrt(values[j])
        mine = np.array([by[i, j + 1].whitened for i in range(n)])
        sign = np.sign(mine @ want)
        assert np.abs(mine * sign - want).max() < 1e-8
        assert abs(by[0, j + 1].explained / (values[j] / values.sum()) - 1) < 1e-10
    assert {r.n for r in got} == {n}
    assert all(by[i, 1].deviation == deviation[i] for i in range(n))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


@pytest.mark.parametrize("scale", [None, np.geomspace(1, 1e-3, 70), np.where(np.arange(70) < 3, 9, 1)])
def test_equals_dense_solver(spark, scale):
    x = vectors(400, 70, scale=scale)
    got = whitening.whiten(table(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(5)).collect()
    compare(got, x, 32)


def test_filter_passes_are_few_on_a_flat_spectrum():
    x = vectors(3000, 120, seed=4).astype(float)
    v, passes = x.T @ x / len(x), []

    def product(block):
        passes.append(block.shape[1])
        return v @ block

    values, basis, worst = whitening.eigenpairs(product, 120, 32)
    want = np.linalg.eigh(v)
    assert np.allclose(values, want[0][::-1][:32], rtol=1e-12)
    assert np.abs(np.abs(want[1][:, ::-1][:, :32].T @ basis) - np.eye(32)).max() < 1e-9
    assert worst < 1e-11 and len(passes) < 150 and max(passes) <= 49


def test_bad_rows_repeats_and_names(spark):
    x = vectors(60, 6, seed=2)
    x[10] = x[11]
    good = [(i, v.tolist()) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, []), (102, [1.0] * 5), (103, [None] + [1.0] * 5), (104, [nan] + [1.0] * 5), (105, [-inf] * 6), (None, None)]
    df = table(spark, good + bad)
    for name in ("key", "component", "f", "v", "n", "count", "d"):
        df = df.withColumn(name, F.lit("x"))
    got = whitening.whiten(df, components=4).collect()
    compare(got, x, 4)
    assert sorted({r.vec_id for r in got}) == list(range(60))


def test_fewer_directions_than_components(spark):
    x = vectors(5, 8, seed=3)
    got = whitening.whiten(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()
    compare(got, x, 32)
    assert {r.component for r in got} == {1, 2, 3, 4}
    x = np.tile(vectors(50, 1, seed=5), (1, 40))
    got = whitening.whiten(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()
    assert {r.component for r in got} == {1} and len(got) == 50


def test_no_variance_and_empty(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)]):
        got = whitening.whiten(table(spark, rows))
        assert got.columns == names and got.collect() == []


def test_huge_entries_keep_exact_sums(spark):
    rows = [(1, [3e17, 1.0]), (2, [-3e17, 2.0]), (3, [1e30, 3.0]), (4, [0.0, 4.0])]
    df = table(spark, rows)
    got = whitening.whiten(df).collect()
    assert {r.n for r in got} == {4} and all(r.deviation is None for r in got if r.vec_id == 3)
    f = [[min(max(math.floor(64 * float(np.float32(c))), -(2**62)), 2**62) for c in v] for _, v in rows]
    n, sums, squares = whitening.moments(*whitening.rows_of(df, "vec_id", "embedding"))
    assert n == 4 and sums == [sum(c) for c in zip(*f)] and squares == [sum(v * v for v in c) for c in zip(*f)]
