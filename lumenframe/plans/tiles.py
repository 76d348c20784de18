"""Neighbourhoods of pixels: tiles with a halo, one exchange for every stencil of a plane."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A stencil takes the dense values by column, which cells are there, and gives values by output name.
Stencil = Callable[[Mapping[str, np.ndarray], np.ndarray], Mapping[str, np.ndarray]]


def _places(at: str, size: int, halo: int) -> Column:
    """The tiles along one axis that a pixel belongs to or borders on."""
    return F.sequence(F.floor((F.col(at) - halo) / size), F.floor((F.col(at) + halo) / size))


def over_tiles(
    plane: DataFrame, keys: Sequence[str], values: Sequence[str], stencil: Stencil, outputs: Mapping[str, str], halo: int, size: int = 256
) -> DataFrame:
    """``keys``, ``x``, ``y`` and ``outputs`` (name and type) of every pixel of ``plane``.

    An image is cut in tiles of ``size`` by ``size``; border pixels go to the neighbouring tiles too, so a
    stencil that reaches no farther than ``halo`` sees all it needs.  A task holds one tile.
    """
    keys = list(keys)
    rows = plane.select(*keys, "x", "y", *[F.col(v).cast("double").alias(f"__{v}") for v in values])
    rows = rows.withColumn("__tx", F.explode(_places("x", size, halo))).withColumn("__ty", F.explode(_places("y", size, halo)))
    own = (F.floor(F.col("x") / size) == F.col("__tx")) & (F.floor(F.col("y") / size) == F.col("__ty"))
    tile = [*keys, "__tx", "__ty"]
    rows = rows.withColumn("__own", own).withColumn("__tile", F.xxhash64(*tile))
    rows = rows.repartition(*tile).sortWithinPartitions(*tile)
    rows = rows.select(*keys, "x", "y", "__own", "__tile", *[f"__{v}" for v in values])
    out = [*keys, "x", "y"]

    def one(t: pa.Table) -> Iterator[pa.RecordBatch]:
        x, y = (t[c].to_numpy().astype(np.int64) for c in ("x", "y"))
        at = (y - y.min(), x - x.min())
        there = np.zeros((at[0].max() + 1, at[1].max() + 1), bool)
        there[at] = True
        dense = {}
        for v in values:
            dense[v] = np.zeros(there.shape)
            dense[v][at] = t[f"__{v}"].to_numpy()
        got = stencil(dense, there)
        mine = np.flatnonzero(t["__own"].to_numpy(zero_copy_only=False))
        if not len(mine):
            return
        here = t.select(out).take(pa.array(mine)).combine_chunks()
        for name, kind in outputs.items():
            cells = got[name][at][mine]
            # a masked cell is NULL
            array = pa.array(np.ma.getdata(cells), mask=np.ma.getmaskarray(cells))
            here = here.append_column(name, array.cast(pa.int64() if kind == "bigint" else pa.float64()))
        yield from here.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            tiles = t["__tile"].to_numpy()
            cuts = [0, *(np.flatnonzero(tiles[1:] != tiles[:-1]) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                yield from one(t.slice(a, b - a))
            held = t.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from one(held)

    schema = [f"`{c}` {plane.schema[c].dataType.simpleString()}" for c in out] + [f"{n} {k}" for n, k in outputs.items()]
    return rows.mapInArrow(run, ", ".join(schema))


def laplacian_of(value: str) -> Stencil:
    """The 4-neighbour Laplacian; a neighbour that is not there is mirrored, or the pixel itself."""

    def stencil(dense: Mapping[str, np.ndarray], there: np.ndarray) -> Mapping[str, np.ndarray]:
        v = dense[value]
        total = -4 * v
        for axis in (0, 1):
            sides = []
            for step in (1, -1):
                moved, known = np.roll(v, step, axis), np.roll(there, step, axis).copy()
                edge = [slice(None)] * 2
                edge[axis] = 0 if step == 1 else -1
                known[tuple(edge)] = False
                sides.append((moved, known))
            (a, has_a), (b, has_b) = sides
            total = total + np.where(has_a, a, np.where(has_b, b, v)) + np.where(has_b, b, np.where(has_a, a, v))
        return {"lap": total}

    return stencil


def box_sums(a: str, b: str, win: int, mirrored: bool) -> Stencil:
    """Sums of two planes, their squares and their product over windows of ``win`` by ``win``.

    Windows that leave the image are masked; ``mirrored`` reflects the image about its edges instead.
    """
    half = win // 2

    def boxed(v: np.ndarray) -> np.ndarray:
        s = np.pad(v, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
        return s[win:, win:] - s[:-win, win:] - s[win:, :-win] + s[:-win, :-win]

    def stencil(dense: Mapping[str, np.ndarray], there: np.ndarray) -> Mapping[str, np.ndarray]:
        pad = {"mode": "symmetric"} if mirrored else {}
        x, y, n = (np.pad(np.trunc(v).astype(np.int64), half, **pad) for v in (dense[a], dense[b], there))
        part = boxed(n) < win * win
        return {k: np.ma.array(boxed(v), mask=part) for k, v in (("sa", x), ("sb", y), ("saa", x * x), ("sbb", y * y), ("sab", x * y))}

    return stencil


def together(*stencils: Stencil) -> Stencil:
    """Several stencils in one pass over a tile."""
    return lambda dense, there: {k: v for s in stencils for k, v in s(dense, there).items()}
