"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed: Spark passes over the written rows multiply it by a narrow block,
``Xᵀ(XQ)`` of centred rows.  A round puts the block through a Chebyshev recurrence that damps the
unwanted end of the spectrum, orthonormalises it (QR), takes Ritz pairs and tests their residuals;
rounds go on until the wanted pairs are certified.  The driver holds blocks of dimensions times
block width only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import stash

#: Added to every entry by the contract; it changes no covariance.
SHIFT = 1_000_000
#: Entries are scaled by 64 and rounded down; beyond this size they are taken as this size.
LARGEST = float(1 << 62)
_LOW = (1 << 64) - 1
_SAFE = 1 << 62


def rows_of(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """``key`` and ``f`` = floor(64 * entry) of the usable rows, and the number of dimensions.

    Usable is a vector without NULL and non-finite entries, of the most frequent length (ties: the
    longer); an empty vector is not.
    """
    c = F.col(vector)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    usable = vectors.select(F.col(key).alias("key"), c.alias("v")).where(c.isNotNull() & (F.size(c) > 0) & ~bad)
    lengths = usable.groupBy(F.size("v").alias("d")).count()
    best = lengths.agg(F.max(F.struct("count", "d")).alias("m")).first().m
    d = best.d if best else 0
    scaled = F.transform("v", lambda x: F.floor(F.least(F.greatest(x.cast("double") * 64, F.lit(-LARGEST)), F.lit(LARGEST))))
    return stash(usable.where(F.size("v") == d).select("key", scaled.alias("f")), "vectors"), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _powers(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Exact sums and sums of squares per dimension, squares in two parts of 64 bits."""
    n, first, second = 0, [0] * d, [0] * d
    for batch in batches:
        m = _matrix(batch.column(0), d)
        if not len(m):
            continue
        n += len(m)
        if int(np.abs(m).max()) ** 2 * len(m) < _SAFE:
            one, two = m.sum(axis=0).tolist(), (m * m).sum(axis=0).tolist()
        else:
            wide = m.astype(object)
            one, two = wide.sum(axis=0).tolist(), (wide * wide).sum(axis=0).tolist()
        first = [a + b for a, b in zip(first, one)]
        second = [a + b for a, b in zip(second, two)]
    if n:
        cells = [str(n)] + [str(x) for x in first] + [str(x >> 64) for x in second] + [str(x & _LOW) for x in second]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(cells)], ["pos", "v"])


def moments(rows: DataFrame, d: int) -> tuple[int, list[int], list[int]]:
    """Number of rows, and per dimension the exact sum and sum of squares of ``f``."""
    parts = rows.select("f").mapInArrow(partial(_powers, d=d), "pos int, v string")
    got = {r.pos: int(r.s) for r in parts.groupBy("pos").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()}
    if not got:
        return 0, [0] * d, [0] * d
    sums = [got[1 + k] for k in range(d)]
    squares = [(got[1 + d + k] << 64) + got[1 + 2 * d + k] for k in range(d)]
    return got[0], sums, squares


def _summed(rows: DataFrame, make: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], d: int) -> np.ndarray:
    """The sum of ``make(rows)`` over all rows: one matrix a task, added up by entry in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += make(_matrix(batch.column(0), d))
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["pos", "v"])

    got = rows.select("f").mapInArrow(run, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("s")).toArrow()
    out = np.zeros(shape[0] * shape[1])
    out[got["pos"].to_numpy()] = got["s"].to_numpy()
    return out.reshape(shape)


def _lower_end(alpha: list[float], beta: list[float]) -> float:
    """The lower end of a spectrum from a Lanczos recurrence: smallest Ritz value less its residual."""
    t = np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return float(values[0] - abs(beta[len(alpha) - 1] * vectors[-1, 0]))


def _degree(top: float, wanted: float, a: float, b: float, most: int = 14, ratio: float = 1e8) -> int:
    """The highest degree at which the filter favours ``top`` over ``wanted`` by ``ratio`` at most."""
    rate = [np.arccosh(max(1.0, (2 * x - a - b) / max(b - a, 1e-300))) for x in (top, wanted)]
    return int(np.clip(np.log(ratio) / max(rate[0] - rate[1], 1e-9), 2, most))


def eigenpairs(
    product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, guard: int = 16, tolerance: float = 3e-14, rounds: int = 60
) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues, their unit vectors (columns) and the largest relative residual.

    ``product`` multiplies a symmetric positive semidefinite matrix by a block.  A pair is certified
    when its residual is below ``tolerance`` times the largest eigenvalue, or when the largest
    residual, below 1e-11, no longer falls.  Pairs that are not certified after ``rounds`` raise.
    """
    k = min(d, wanted + guard)
    rng = np.random.Generator(np.random.PCG64(311))
    q = np.linalg.qr(rng.standard_normal((d, k)))[0]
    probe = rng.standard_normal(d)
    probe, last, alpha, beta = probe / np.linalg.norm(probe), np.zeros(d), [], []

    def times(block: np.ndarray) -> np.ndarray:
        """The product; a Lanczos recurrence for the lower end of the spectrum rides along at first."""
        nonlocal probe, last
        if len(alpha) >= 10 or (beta and beta[-1] == 0):
            return product(block)
        got = product(np.column_stack([block, probe]))
        more = got[:, -1] - (beta[-1] if beta else 0.0) * last
        alpha.append(float(more @ probe))
        more = more - alpha[-1] * probe
        beta.append(float(np.linalg.norm(more)))
        if beta[-1] <= 1e-12 * abs(alpha[0]):
            beta[-1] = 0.0
        else:
            last, probe = probe, more / beta[-1]
        return got[:, :-1]

    best = np.inf
    for _ in range(rounds):
        vq = times(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        if top == 0:
            return np.zeros(wanted), q[:, :wanted], 0.0
        worst = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max()) / top
        if worst <= tolerance or (worst <= 1e-11 and worst > best / 2) or k == d:
            return values[:wanted], q[:, :wanted], worst
        best = min(best, worst)
        b = float(values[-1])
        a = min(max(_lower_end(alpha, beta), 0.0), 0.999 * b) if len(alpha) >= 10 else 0.0
        c, h = (a + b) / 2, max((b - a) / 2, 1e-9 * top)
        before, now = q, (vq - c * q) / h
        for _ in range(_degree(top, float(values[min(wanted, k) - 1]), a, b) - 1):
            before, now = now, (2 / h) * (times(now) - c * now) - before
            # one factor for each column keeps the numbers near 1 and the recurrence as it is
            size = np.maximum(np.abs(now).max(axis=0), 1e-300)
            before, now = before / size, now / size
        q = np.linalg.qr(now)[0]
    raise ArithmeticError(f"no certificate after {rounds} rounds: residual {worst:.1e}")


def _out(batches: Iterator[pa.RecordBatch], d: int, n: int, sums: list[int], basis: np.ndarray, explained: list[float], error: float):
    """Rows (key, f): per component the projection of the centred row."""
    k = basis.shape[1]
    reach = max(map(abs, sums))
    s = np.array(sums, np.int64) if reach < _SAFE else None
    for batch in batches:
        for a in range(0, batch.num_rows, 2048):
            part = batch.slice(a, 2048)
            f = _matrix(part.column(1), d)
            far = n * int(np.abs(f).max()) + reach
            if s is not None and far * far * d < _SAFE:
                off = n * f - s
                deviation = (off * off).sum(axis=1).tolist()
            else:
                off = n * f.astype(object) - np.array(sums, object)
                deviation = [x if x < 1 << 63 else None for x in (off * off).sum(axis=1).tolist()]
            white = (off / n).astype(np.float64) @ basis
            rows = len(f)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """``key``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``: a row for
    each usable row and component.

    Rows whose vector is NULL, empty, of another length than most, or holds NULL or non-finite entries
    are left out; the others, repeated rows included, are the list that is fitted.  Components are
    numbered by falling eigenvalue, their largest entry positive; equal eigenvalues leave the basis of
    their space open.  Directions without variance (below 1e-12 of the largest) have no component, so
    a single row gives none, and neither does an empty table.  A ``deviation`` beyond 64 bits is NULL.
    A NULL or repeated key is carried as it is; further columns, whatever their names, are not read.
    """
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    schema = f"key {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows, d = rows_of(vectors, key, vector)
    n, sums, squares = moments(rows, d) if d else (0, [], [])
    spread = sum(n * q - s * s for q, s in zip(squares, sums))
    if not spread:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    mean = np.array([s / n for s in sums])
    trace = spread / n / n

    def product(block: np.ndarray) -> np.ndarray:
        def make(f: np.ndarray) -> np.ndarray:
            x = f - mean
            return x.T @ (x @ block)

        return _summed(rows, make, block.shape, d) / n

    values, basis, _ = eigenpairs(product, d, min(components, d))
    real = values > 1e-12 * values[0]
    values, basis = values[real], basis[:, real]
    basis = basis * np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(len(values))])
    scaled = basis / np.sqrt(values)

    def gram(f: np.ndarray) -> np.ndarray:
        w = np.column_stack([(f - mean) @ scaled, np.ones(len(f))])
        return w.T @ w

    k = len(values)
    g = _summed(rows, gram, (k + 1, k + 1), d) / n
    error = float(np.abs(g[:k, :k] - np.outer(g[:k, k], g[:k, k]) - np.eye(k)).max())
    run = partial(_out, d=d, n=n, sums=sums, basis=scaled, explained=(values / trace).tolist(), error=error)
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
