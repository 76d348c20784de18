"""Similarity of feature vectors to banks, prompts and their counterparts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions import vectors as V
from lumenframe.plans.lineage import stored
from lumenframe.plans.ordered import total_of, with_total

BANK_ROWS = 32_768
BANK_BYTES = 64 << 20
BLOCK_BYTES = 16 << 20  # of vectors that one side of a meeting holds
TILE = 1 << 20  # cosines held at a time


def _units(column) -> np.ndarray:
    m = np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))
    n = np.linalg.norm(m, axis=1, keepdims=True) if m.size else 1.0
    return m / np.where(n == 0, 1.0, n) if m.size else m


def _top(values: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest values of every row, in any order; ``values`` is overwritten."""
    n = values.shape[1]
    if k < n:
        values.partition(n - k, axis=1)
    return values[:, max(0, n - k) :]


def _best(queries: np.ndarray, bank: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest cosines of every query, rising; one tile of cosines is held, whatever the sizes."""
    k = min(k, len(bank))
    wide = min(len(bank), 4096)
    tall = max(1, TILE // wide)
    out = np.empty((len(queries), k))
    for i in range(0, len(queries), tall):
        some = queries[i : i + tall]
        best = np.empty((len(some), 0))
        for j in range(0, len(bank), wide):
            top = _top(some @ bank[j : j + wide].T, k)
            best = _top(np.hstack([best, top]), k)
        out[i : i + tall] = np.sort(best, axis=1)
    return out


def topk_mean(queries: DataFrame, bank: DataFrame, key: str, vector: str, k: int, bank_rows: int = BANK_ROWS) -> DataFrame:
    """(key, score): mean of the ``k`` largest cosines to a bank; an empty bank gives 0.

    A bank whose row count and width were checked to be small is sent to every executor once
    and scored in Arrow batches.  A larger one is searched by cells (``pruned_topk``), with the
    same result.  Either way each query row gives one row, and the bank needs nothing but its vectors.
    """
    head = bank.select(vector).limit(bank_rows + 1)
    n, width = head.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vector)), F.lit(0))).first()
    if n == 0:
        return queries.select(key, F.lit(0.0).alias("score"))
    if n <= bank_rows and n * width * 8 <= BANK_BYTES:
        rows = head.toPandas()[vector]
        sent = queries.sparkSession.sparkContext.broadcast(_units(rows))

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    top = _best(_units(b[vector]), sent.value, k)
                    yield pd.DataFrame({key: b[key], "score": top.mean(axis=1)})

        schema = f"{key} {queries.schema[key].dataType.simpleString()}, score double"
        return queries.select(key, vector).mapInPandas(score, schema)
    best = pruned_topk(queries, bank, key, vector, k, bank_rows)
    return best.select(key, (F.aggregate("best", F.lit(0.0), lambda s, v: s + v) / F.size("best")).alias("score"))


class _Pivots:
    """Directions that part a bank in cells, and what is known of each cell: rows, least and largest angle.

    The last cell holds vectors of length zero, of which angles say nothing.
    """

    def __init__(self, axes: np.ndarray) -> None:
        self.axes = axes
        n = len(axes) + 1
        self.rows, self.low, self.high = np.zeros(n, np.int64), np.zeros(n), np.full(n, np.pi)

    def angles(self, units: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(units @ self.axes.T, -1, 1))

    def place(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector and its angle there."""
        angles = self.angles(units)
        cell = angles.argmin(axis=1)
        zero = ~units.any(axis=1)
        return np.where(zero, len(self.axes), cell), angles[np.arange(len(cell)), cell]

    def bounds(self, units: np.ndarray) -> np.ndarray:
        """The largest cosine that a vector of each cell can have (empty cells: -2)."""
        angles = self.angles(units)
        apart = np.maximum(0, np.maximum(angles - self.high[:-1], self.low[:-1] - angles))
        got = np.column_stack([np.cos(np.minimum(apart, np.pi)), np.ones(len(units))])
        return np.where(self.rows > 0, got, -2.0)

    def first(self, units: np.ndarray, k: int) -> list[list[int]]:
        """The nearest cells that hold ``k`` rows together."""
        out = []
        for row in np.argsort(-self.bounds(units), axis=1, kind="stable"):
            row = row[self.rows[row] > 0]
            need = int(np.searchsorted(np.cumsum(self.rows[row]), k)) + 1
            out.append(row[:need].tolist())
        return out


class _Shelves:
    """Cells side by side in shelves of about ``size`` rows; a larger cell fills several shelves of its own.

    A query goes once to a shelf, with the cells of it that it wants, however many they are.
    """

    def __init__(self, rows: np.ndarray, size: int) -> None:
        self.first, self.parts = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64)
        at, held = 0, 0
        for cell, n in enumerate(rows.tolist()):
            if held and held + n > size:
                at, held = at + 1, 0
            self.first[cell], self.parts[cell] = at, max(1, -(-n // size))
            held += n
            if n > size:
                at, held = at + int(self.parts[cell]), 0
        self.count = at + 1
        self.cells = [np.flatnonzero((self.first <= s) & (s < self.first + self.parts) & (rows > 0)) for s in range(self.count)]

    def asks(self, rows: np.ndarray, units: np.ndarray, wanted: np.ndarray) -> Iterator[pd.DataFrame]:
        """``__row``, ``shelf``, ``cells``, ``vec`` of queries that want cells (a row of flags each), a shelf at a time."""
        for shelf, cells in enumerate(self.cells):
            mine = wanted[:, cells]
            at = np.flatnonzero(mine.any(axis=1))
            if len(at):
                lists = pd.Series([cells[m] for m in mine[at]], dtype=object)
                yield pd.DataFrame({"__row": rows[at], "shelf": shelf, "cells": lists, "vec": pd.Series(list(units[at]), dtype=object)})


ASK = "__row bigint, shelf int, cells array<int>, vec array<double>"


def _slices(batches: Iterator[pd.DataFrame], rows: int = 2_048) -> Iterator[pd.DataFrame]:
    for b in batches:
        for i in range(0, len(b), rows):
            yield b.iloc[i : i + rows]


def _meet(asks: DataFrame, cells: DataFrame, k: int, chunk_rows: int) -> DataFrame:
    """``__row``, ``best`` (the ``k`` largest cosines of a meeting), ``seen`` (rows met): the queries of ``asks`` against the
    bank rows of the cells they want, a chunk of queries and a shelf in a task."""
    asked = {r.shelf: r.n for r in asks.groupBy("shelf").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per shelf
    parts = {int(s): -(-int(n) // chunk_rows) for s, n in asked.items()}
    chunks = F.coalesce(F.create_map(*[F.lit(x) for p in parts.items() for x in p])[F.col("shelf")], F.lit(0)) if parts else F.lit(0)
    q = asks.withColumn("chunk", F.pmod(F.xxhash64("__row"), chunks).cast("int")).groupBy("shelf", "chunk")
    b = cells.withColumn("__n", chunks).where("__n > 0")
    b = b.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n").groupBy("shelf", "chunk")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"__row": pd.Series(dtype="int64"), "best": pd.Series(dtype=object), "seen": pd.Series(dtype="int64")})
        queries, bank = np.stack(left["vec"].to_numpy()), np.stack(right["vec"].to_numpy())
        wanted = left["cells"].to_numpy()
        at, cell = np.repeat(np.arange(len(left)), [len(c) for c in wanted]), np.concatenate(wanted)
        names, place = np.unique(right["cell"].to_numpy(), return_inverse=True)
        asks_for = np.zeros((len(left), len(names)), bool)
        here = np.isin(cell, names)
        asks_for[at[here], np.searchsorted(names, cell[here])] = True
        best, seen = np.full((len(left), k), -np.inf), np.zeros(len(left), np.int64)
        for i in range(len(names)):
            mine, rows = np.flatnonzero(asks_for[:, i]), bank[place == i]
            if len(mine):
                best[mine] = _top(np.hstack([best[mine], _best(queries[mine], rows, k)]), k)
                seen[mine] += len(rows)
        met = np.flatnonzero(seen)
        top = pd.Series([v[np.isfinite(v)] for v in best[met]], dtype=object)
        return pd.DataFrame({"__row": left["__row"].to_numpy()[met], "best": top, "seen": seen[met]})

    return q.cogroup(b).applyInPandas(meet, "__row bigint, best array<double>, seen bigint")


def pruned_topk(queries: DataFrame, bank: DataFrame, key: str, vector: str, k: int, block_rows: int, pivots: int = 256) -> DataFrame:
    """``key``, ``best`` (the ``k`` largest cosines to the bank, falling), ``seen`` (bank rows compared), exact.

    Memory of a task is bounded by ``block_rows`` and ``BLOCK_BYTES``; where angles exclude nothing the search
    compares all pairs, but a query travels once for ``block_rows`` rows of the bank, not for every cell.

    The bank is dealt to the nearest of at most ``pivots`` of its own rows, taken by a hash; a cell knows
    the angles of its rows to its pivot.  A query first meets the nearest cells that hold ``k`` rows, then
    only those cells that could hold a cosine above its ``k``-th so far: an angle to a row is never
    less than the difference of the angles to the pivot.
    """
    spark = queries.sparkSession
    some = bank.select(vector).where(F.col(vector).isNotNull()).orderBy(F.xxhash64(vector)).limit(pivots).toPandas()
    axes = _units(some[vector])
    known = _Pivots(axes[axes.any(axis=1)] if axes.any() else np.eye(1, axes.shape[1]))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                units = _units(b[vector])
                cell, angle = known.place(units)
                yield pd.DataFrame({"cell": cell, "angle": angle, "vec": list(units)})

    cells = stored(bank.select(vector).mapInPandas(deal, "cell int, angle double, vec array<double>"), "bank-cells")
    last = len(known.axes)
    for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")).collect():
        known.rows[r.cell] = r.n
        if r.cell != last:
            known.low[r.cell], known.high[r.cell] = r.low, r.high
    most = max(1, BLOCK_BYTES // (8 * max(1, axes.shape[1])))
    shelves = _Shelves(known.rows, min(block_rows, most))
    first, parts = (F.array(*[F.lit(int(x)) for x in v])[F.col("cell")] for v in (shelves.first, shelves.parts))
    cells = cells.select("cell", "vec", (first + F.pmod(F.xxhash64("vec", "angle", F.monotonically_increasing_id()), parts)).cast("int").alias("shelf"))

    def near_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches):
            units = _units(b[vector])
            yield pd.DataFrame({"__row": b["__row"], key: b[key], "vec": list(units), "cells": known.first(units, k)})

    def flags(lists) -> np.ndarray:
        got = np.zeros((len(lists), len(known.rows)), bool)
        for i, some in enumerate(lists):
            got[i, list(some)] = True
        return got

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches):
            yield from shelves.asks(b["__row"].to_numpy(), np.stack(b["vec"].to_numpy()), flags(b["cells"]))

    kind = queries.schema[key].dataType.simpleString()
    rows = queries.select(F.monotonically_increasing_id().alias("__row"), key, vector)
    rows = stored(rows.mapInPandas(near_cells, f"__row bigint, `{key}` {kind}, vec array<double>, cells array<int>"), "nearest-cells")
    near = _meet(rows.select("__row", "vec", "cells").mapInPandas(ask, ASK), cells, k, most)

    def merged(parts: DataFrame) -> DataFrame:
        best = F.slice(F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, k)  # k values per meeting
        return parts.groupBy("__row").agg(best.alias("best"), F.sum("seen").alias("seen"))

    near = stored(merged(near), "nearest-best")

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches):
            units = np.stack(b["vec"].to_numpy())
            least = np.array([x[-1] if len(x) >= k else -2.0 for x in b["best"]])
            open_ = (known.bounds(units) + 1e-9 >= least[:, None]) & (known.rows > 0) & ~flags(b["cells"])
            yield from shelves.asks(b["__row"].to_numpy(), units, open_)

    asks = rows.join(near, "__row").select("__row", "vec", "cells", "best").mapInPandas(rest, ASK)
    far = _meet(stored(asks, "farther-cells"), cells, k, most)
    both = merged(far.unionByName(near.select("__row", "best", "seen")))
    return rows.select("__row", key).join(both, "__row").drop("__row")


def knn_score(
    queries: DataFrame, positive: DataFrame, negative: DataFrame | None, key: str, vector: str, k_pos: int, k_neg: int
) -> DataFrame:
    """Closeness to the positive bank, minus that to the negative bank if there is one."""
    pos = topk_mean(queries, positive, key, vector, k_pos)
    if negative is None:
        return pos
    neg = topk_mean(queries, negative, key, vector, k_neg).withColumnRenamed("score", "__neg")
    return pos.join(neg, key).select(key, (F.col("score") - F.col("__neg")).alias("score"))


def zero_shot_label(images: DataFrame, prompts: DataFrame, key: str, vector: str, temperature: float = 30.0, floor: float = 0.55, most: int = 10_000) -> DataFrame:
    """Label whose prompts are closest on average, with a softmax confidence.

    The labels travel to every task as one row; more than ``most`` of them are an error.

    The mean cosine to the prompts of a label is the product with the mean of their unit
    vectors, so each image meets one vector per label instead of every prompt.
    """
    parts = prompts.select("label", F.posexplode(V.unit(F.col(vector))).alias("pos", "v"))
    means = parts.groupBy("label", "pos").agg(F.avg("v").alias("v"))
    rows = means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda p: p["v"]).alias("mean")  # one entry per dimension
    )
    table = total_of(rows, F.array_sort(F.collect_list(F.struct("label", "mean"))).alias("__labels"))  # one entry per label
    fits = F.when(F.size("__labels") <= most, F.col("__labels")).otherwise(F.raise_error("more labels than one row may hold"))
    scored = with_total(images.select(key, V.unit(F.col(vector)).alias("__u")), table.select(fits.alias("__labels")))
    scored = scored.withColumn("__s", F.transform("__labels", lambda p: V.dot(F.col("__u"), p["mean"])))
    probs = scored.withColumn("__p", V.softmax(F.col("__s"), temperature))
    top = V.argmax(F.col("__p"))
    best = F.array_max("__p")
    name = F.get("__labels", top.cast("int"))["label"]
    return probs.select(key, F.when(best >= floor, name).alias("label"), best.alias("confidence"))


def patch_change_mask(patches: DataFrame, a: str, b: str, threshold: float) -> DataFrame:
    """Patches ``(image_id, x, y)`` whose two feature vectors differ by more than the threshold."""
    return patches.where(1 - V.cosine(F.col(a), F.col(b)) > threshold).select("image_id", "x", "y")
