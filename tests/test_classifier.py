"""Distributed Newton steps against a plain solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import classifier as C


def data(n=600, d=7, classes=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * np.linspace(0.2, 3, d)
    centre = rng.standard_normal((classes, d))
    y = rng.choice(classes, n, p=[0.7, 0.2, 0.08, 0.02])
    return x + centre[y], y


def plain(x, y, ridge):
    """Gradient descent, then Newton, in plain numpy."""
    n, d = x.shape
    x = np.column_stack([x, np.ones(n)])
    share = np.where(y, n / 2 / y.sum(), n / 2 / (n - y.sum()))
    keep = np.append(np.full(d, ridge), 0)
    w = np.zeros(d + 1)
    for k in range(3000):
        p = 1 / (1 + np.exp(-(x @ w)))
        g = x.T @ (share * (p - y)) / n + keep * w
        h = x.T @ (x * (share * p * (1 - p))[:, None]) / n + np.diag(keep)
        w = w - (0.02 * g if k < 2900 else np.linalg.solve(h, g))
    return w


def table(spark, x, y):
    return spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))], "id bigint, v array<double>, label int")


@pytest.mark.parametrize("ridge", [0.1, 1e-3])
def test_weights_equal_a_plain_solver(spark, ridge):
    x, y = data()
    models = C.fit(table(spark, x, y).repartition(5), "v", "label", [0, 1, 2, 3], ridge)
    for m in models:
        want = plain(x, y == m.condition, ridge)
        assert np.abs(np.append(m.weights, m.intercept) - want).max() < 1e-6 and m.gradient <= 1e-10 and m.steps < 15


def test_steps_are_halved_where_they_overshoot(spark):
    x = np.array([[100.0], [-100.0], [0.1], [-90.0], [80.0]])
    y = np.array([1, 0, 1, 0, 0])
    (m,) = C.fit(table(spark, x, y), "v", "label", [1], 1e-4)
    w, rows = np.append(m.weights, m.intercept), np.column_stack([x, np.ones(5)])
    share = np.where(y, 5 / 2 / 2, 5 / 2 / 3)
    slope = rows.T @ (share * (0.5 * (1 + np.tanh(rows @ w / 2)) - y)) / 5 + np.array([1e-4, 0]) * w
    assert np.abs(slope).max() < 1e-8


def test_one_class_and_no_rows(spark):
    x, y = data(40)
    df = table(spark, x, np.zeros(40, int))
    there, other = C.fit(df, "v", "label", [0, 5])
    assert (there.intercept, other.intercept) == (1.0, -1.0) and set(there.weights) == {0.0}
    rows = {r.condition: r for r in C.evaluate(df, "v", "label", [there, other]).collect()}
    assert rows[0].accuracy == rows[5].accuracy == 1.0 and rows[5].f1 == 0.0
    (empty,) = C.fit(df.limit(0), "v", "label", [0])
    assert empty.intercept == -1.0 and empty.weights == ()


def test_bad_rows_and_clashing_names(spark):
    x, y = data(200)
    df = table(spark, x, y)
    bad = spark.createDataFrame(
        [(1, None, 1), (2, [], 1), (3, [1.0], 1), (4, [None] * 7, 1), (5, [float("nan")] * 7, 2), (6, [0.0] * 7, None)], df.schema
    )
    both = df.unionByName(bad).withColumn("x", F.lit(1)).withColumn("y", F.lit("z")).withColumn("y0", F.lit(0))
    a, b = C.fit(df, "v", "label", [1]), C.fit(both, "v", "label", [1])
    assert np.allclose(a[0].weights, b[0].weights, atol=1e-9)
    assert C.evaluate(both, "v", "label", b).first().tp + C.evaluate(both, "v", "label", b).first().fn == int((y == 1).sum()) + 4


def test_hold_out_is_scored(spark):
    x, y = data(900, seed=3)
    got = C.condition_classifiers(table(spark, x, y), "id", "v", "label", [0, 1]).collect()
    assert sorted(r.condition for r in got) == [0, 1] and all(r.f1 > 0.5 and 0 < r.tp < 180 for r in got)
