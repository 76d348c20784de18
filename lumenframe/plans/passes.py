"""Sums of small matrices over all rows, one Spark pass at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summed(rows: DataFrame, make: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of the vectors ``make(batch)`` of ``size`` numbers over all Arrow batches of ``rows``.

    A task adds up its batches and returns one vector; Spark adds these up by entry, so neither a task
    nor the driver holds more than ``size`` numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += make(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["pos", "v"])

    got = rows.mapInArrow(run, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("s")).toArrow()
    out = np.zeros(size)
    out[got["pos"].to_numpy()] = got["s"].to_numpy()
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` numbers as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
