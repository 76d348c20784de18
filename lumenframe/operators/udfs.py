"""User code inside Spark: batch scoring and ordered walks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def score_batch(df: DataFrame, key: str, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Score Arrow batches with a user model.

    ``load`` runs once per task and returns the model, a function from a batch to the columns
    of ``schema``.  A batch that fails is halved and tried again, so only the bad rows come
    back empty, with the error as ``reason``.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def attempt(model, batch: pd.DataFrame) -> list[pd.DataFrame]:
        try:
            return [model(batch)[names].assign(reason=None).astype(object)]
        except Exception as e:
            if len(batch) == 1:
                return [pd.DataFrame({**{n: [None] for n in names}, "reason": [str(e)[:200]]})]
        half = len(batch) // 2
        return attempt(model, batch.iloc[:half]) + attempt(model, batch.iloc[half:])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            if len(batch):
                got = pd.concat(attempt(model, batch), ignore_index=True)
                got.insert(0, key, batch[key].to_numpy())
                yield got

    kind = df.schema[key].dataType.simpleString()
    return df.mapInPandas(run, f"{key} {kind}, {schema}, reason string")


def largest_feature_model() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A stand-in model: the largest feature names the class."""

    def model(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["vec_id"] % 23 == 0).any():
            raise ValueError("unreadable image")
        m = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
        top = m.argmax(axis=1)
        return pd.DataFrame({"label": [f"class-{i}" for i in top], "confidence": m.max(axis=1), "version": "probe-1"})

    return model


def per_group_in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], start: Callable[[], Callable], schema: str
) -> DataFrame:
    """Run a sequential step over the ordered rows of every group.

    ``start()`` gives a fresh step per group; the step takes a row and returns output tuples.
    Rows stream through in sorted partitions, so no group is ever held in memory.
    """
    keys = list(keys)
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = step = None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                key = tuple(getattr(row, k) for k in keys)
                if key != group:
                    group, step = key, start()
                out.extend(step(row))
            yield pd.DataFrame(out, columns=columns)

    rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return rows.mapInPandas(run, schema)
