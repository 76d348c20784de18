"""Binary classifiers of several conditions at once: class-weighted ridge logistic regression.

Newton steps in Spark: a pass adds up, for every condition, the loss, the gradient and the Hessian of
the rows it reads; the driver solves systems of dimensions times dimensions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.evaluation import binary_prf
from lumenframe.operators.sampling import random_split
from lumenframe.plans.lineage import stored
from lumenframe.plans.passes import matrix, summed


@dataclass(frozen=True)
class Model:
    """A rule ``w . x + intercept > 0`` for one condition; ``steps`` is 0 where one class was missing."""

    condition: object
    weights: tuple[float, ...]
    intercept: float
    steps: int
    gradient: float

    def score(self, vector: Column | str) -> Column:
        v = F.col(vector) if isinstance(vector, str) else vector
        w = F.array(*[F.lit(x) for x in self.weights])
        return F.aggregate(F.zip_with(v, w, lambda a, b: a.cast("double") * b), F.lit(self.intercept), lambda s, x: s + x)


def usable(rows: DataFrame, vector: str, label: str) -> tuple[DataFrame, int]:
    """``x`` and ``y`` of the rows that have a label and a whole vector of the usual length, written, and that length.

    The usual length is the most frequent one (ties: the longer).
    """
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    some = rows.select(v.cast("array<double>").alias("x"), F.col(label).alias("y")).where(v.isNotNull() & F.col("y").isNotNull() & ~bad)
    lengths = some.groupBy(F.size("x").alias("d")).count().agg(F.max(F.struct("count", "d")).alias("m")).first().m
    d = lengths.d if lengths else 0
    return stored(some.where(F.size("x") == d), "labelled-vectors"), d


def fit(
    rows: DataFrame, vector: str, label: str, conditions: Sequence, ridge: float = 0.1, tolerance: float = 1e-10, most: int = 50
) -> list[Model]:
    """A model per condition: is ``label`` that condition or another?

    Minimises the mean loss, each class weighing the same, plus ``ridge / 2`` times the squared
    weights (not the intercept).  A condition stops when its gradient is below ``tolerance``; a step that
    does not lower the loss is halved.  All conditions share the passes.  A condition without rows of
    both classes gets the constant rule of the class that is there; without any rows, "no".
    """
    train, d = usable(rows, vector, label)
    k = len(conditions)
    n_all = train.count()
    ones = train.agg(*[F.count_if(F.col("y") == c).alias(f"c{i}") for i, c in enumerate(conditions)]).first()
    pos = np.array([ones[i] for i in range(k)], float)
    both = (pos > 0) & (pos < n_all)
    heavy = np.where(both, n_all / 2 / np.maximum(pos, 1), 0.0)
    light = np.where(both, n_all / 2 / np.maximum(n_all - pos, 1), 0.0)
    width = d + 1
    cell = 1 + width + width * width
    columns = train.select("x", *[(F.col("y") == c).alias(f"y{i}") for i, c in enumerate(conditions)])

    def passed(w: np.ndarray, which: np.ndarray) -> np.ndarray:
        def make(batch: pa.RecordBatch) -> np.ndarray:
            x = np.column_stack([matrix(batch.column(0), d), np.ones(batch.num_rows)])
            out = np.zeros((k, cell))
            for i in np.flatnonzero(which):
                y = batch.column(1 + int(i)).to_numpy(zero_copy_only=False).astype(bool)
                z = x @ w[i]
                p = 0.5 * (1 + np.tanh(z / 2))
                share = np.where(y, heavy[i], light[i])
                out[i, 0] = share @ np.logaddexp(0, np.where(y, -z, z))
                out[i, 1 : 1 + width] = x.T @ (share * (p - y))
                out[i, 1 + width :] = (x.T @ (x * (share * p * (1 - p))[:, None])).ravel()
            return out.ravel()

        return summed(columns, make, k * cell).reshape(k, cell) / max(n_all, 1)

    keep = np.append(np.full(d, ridge), 0.0)
    at, step = np.zeros((k, width)), np.zeros((k, width))
    loss, gap, size = np.full(k, np.inf), np.full(k, np.inf), np.ones(k)
    steps, open_ = np.zeros(k, int), both.copy()
    slope = np.zeros(k)
    for _ in range(most):
        if not open_.any():
            break
        trial = at - size[:, None] * step
        got = passed(trial, open_)
        for i in np.flatnonzero(open_):
            new = got[i, 0] + (keep * trial[i] ** 2).sum() / 2
            # Armijo's rule, with room for rounding
            if not new <= loss[i] - 1e-4 * size[i] * slope[i] + 1e-14 * max(abs(new), 1):
                size[i] /= 2
                continue
            at[i], loss[i], size[i] = trial[i], new, 1.0
            grad = got[i, 1 : 1 + width] + keep * at[i]
            gap[i] = np.abs(grad).max()
            if gap[i] <= tolerance:
                open_[i] = False
                continue
            hess = got[i, 1 + width :].reshape(width, width) + np.diag(keep) + 1e-12 * np.eye(width)
            step[i] = np.linalg.solve(hess, grad)
            slope[i] = grad @ step[i]
            steps[i] += 1
    if open_.any():
        raise ArithmeticError(f"conditions {[conditions[i] for i in np.flatnonzero(open_)]} did not converge in {most} passes")
    models = []
    for i, c in enumerate(conditions):
        if both[i]:
            models.append(Model(c, tuple(at[i, :d].tolist()), float(at[i, d]), int(steps[i]), float(gap[i])))
        else:
            models.append(Model(c, (0.0,) * d, 1.0 if pos[i] > 0 else -1.0, 0, 0.0))
    return models


def evaluate(rows: DataFrame, vector: str, label: str, models: Sequence[Model]) -> DataFrame:
    """``condition``, tp, fp, fn, precision, recall, f1, accuracy of each model on ``rows``, in one pass.

    Scores are rounded to nine digits; a row whose vector does not fit the model counts as "no".
    """
    cases = [
        F.struct(
            F.lit(m.condition).alias("condition"),
            (F.col(label) == m.condition).alias("truth"),
            F.coalesce(F.round(m.score(vector), 9) > 0, F.lit(False)).alias("hit"),
        )
        for m in models
    ]
    each = rows.where(F.col(label).isNotNull()).select(F.inline(F.array(*cases)))
    return binary_prf(each.groupBy("condition"), F.col("truth"), F.col("hit"))


def condition_classifiers(
    df: DataFrame, key: str, vector: str, label: str, conditions: Sequence, val_frac: float = 0.2, seed=0, ridge: float = 0.1
) -> DataFrame:
    """Fit on the seeded training rows, score on the hold-out: a row per condition."""
    rows = random_split(df, key, F.floor(F.col("total") * val_frac), seed)
    rows = stored(rows.select(key, vector, label, "split"), "condition-split")
    models = fit(rows.where("split = 'train'"), vector, label, conditions, ridge)
    return evaluate(rows.where("split = 'val'"), vector, label, models)
