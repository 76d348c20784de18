"""Idempotent keyed sink: each micro-batch owns one folder, the newest batch wins a key."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.plans.lineage import scratch


def write_keyed(rows: DataFrame, path: str, batch_id: int) -> None:
    """A replay of the same batch overwrites its own folder."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_keyed(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The latest row per key over all batches that were written; at least one was."""
    rows = spark.read.option("basePath", path).parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*rest), "batch") if rest else F.max("batch")
    got = rows.groupBy(*keys).agg(last.alias("r"))
    return got.select(*keys, "r.*") if rest else got.select(*keys)


def drain(
    stream: DataFrame,
    keys: Sequence[str],
    mode: str,
    then: Callable[[DataFrame], DataFrame] | None = None,
    label: str = "stream",
    settings: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run a stream over everything available and return its keyed table.

    A source without rows gives an empty table.  Rows that came behind a watermark and were left out
    are reported as a warning.  ``settings`` hold for this stream only.  For one answer per key across runs see ``ledger.answer``.
    """
    spark = stream.sparkSession
    path = scratch(spark, label)
    written: list[int] = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = then(batch) if then else batch
        write_keyed(rows, f"{path}/out", batch_id)
        written.append(batch_id)

    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .foreachBatch(sink)
    )
    before = {k: spark.conf.get(k, None) for k in settings or {}}
    try:
        for k, v in (settings or {}).items():
            spark.conf.set(k, v)
        q = writer.start()  # a stream keeps the settings it was started with
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    late = sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators)
    if late:
        warnings.warn(f"{label}: {late} rows came behind the watermark and were left out", stacklevel=2)
    if not written:
        empty = spark.createDataFrame([], stream.schema)
        return then(empty) if then else empty
    return read_keyed(spark, f"{path}/out", keys)
