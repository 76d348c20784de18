"""A durable ledger of answered keys: one answer per request, across restarts.

The ledger is a folder of its own, in buckets of the key's hash.  A batch opens only the buckets of its
own keys, and leaves its new keys there under its own name, so a replayed batch overlooks what it
wrote before and overwrites it.  A bucket with many small parts is merged when a batch opens it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The partition columns of a ledger.
_BUCKET, _PART = "ledger_bucket", "ledger_part"


def _file(spark: SparkSession, name: str):
    """The file system of a path, and the path, as the session's Hadoop settings say."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


@dataclass(frozen=True)
class Ledger:
    """``folder`` is shared by all executors and outlives the session; one writer at a time.

    ``buckets`` belongs to the folder and never changes (see ``widened``); ``parts`` is the number of
    parts of a bucket beyond which it is merged.
    """

    spark: SparkSession
    folder: str
    keys: Sequence[str]
    buckets: int = 256
    parts: int = 8

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _path(self, *names: str):
        return _file(self.spark, "/".join([self.folder.rstrip("/"), *names]))

    def _held(self, bucket: int) -> list[str]:
        """Names of the parts of a bucket."""
        fs, path = self._path(f"{_BUCKET}={bucket}")
        return [f.getPath().getName().split("=", 1)[1] for f in fs.listStatus(path)] if fs.exists(path) else []

    def opened(self, buckets: Sequence[int]) -> int:
        """Bytes that a batch with keys in ``buckets`` reads."""
        total = 0
        for b in buckets:
            fs, path = self._path(f"{_BUCKET}={b}")
            total += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
        return total

    def known(self, buckets: Sequence[int], but: str | None = None) -> DataFrame | None:
        """The keys in some buckets, without the part named ``but``; None if there are none."""
        paths = [f"{self.folder}/{_BUCKET}={b}" for b in buckets if set(self._held(b)) - {but}]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", self.folder).parquet(*paths)
        return (rows.where(F.col(_PART) != but) if but else rows).select(*self.keys)

    def buckets_of(self, rows: DataFrame) -> list[int]:
        return sorted(r.b for r in rows.select(self.bucket().alias("b")).distinct().collect())  # at most ``buckets``

    def fresh(self, rows: DataFrame, part: str) -> DataFrame:
        """The rows whose keys were not answered before the part ``part``; NULL keys are never answered."""
        some = rows.dropna(subset=list(self.keys))
        done = self.known(self.buckets_of(some), but=part)
        return some if done is None else some.join(done, list(self.keys), "left_anti")

    def add(self, rows: DataFrame, part: str) -> None:
        """Enter the keys of ``rows`` as part ``part``; doing it again replaces the part."""
        out = rows.select(*self.keys, self.bucket().alias(_BUCKET), F.lit(part).alias(_PART)).distinct()
        out = out.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(_BUCKET, _PART).parquet(self.folder)

    def merge(self, buckets: Sequence[int], but: str) -> None:
        """Merge the parts, without ``but``, of those of ``buckets`` that have too many.

        The merged part is written before the others go: a crash in between leaves keys twice, never none.
        """
        old = {b: [p for p in self._held(b) if p != but] for b in buckets}
        old = {b: p for b, p in old.items() if len(p) > self.parts}
        if not old:
            return
        rows = self.spark.read.option("basePath", self.folder).parquet(*[f"{self.folder}/{_BUCKET}={b}" for b in old])
        rows = rows.where(F.col(_PART) != but).select(*self.keys, _BUCKET, F.lit(f"merged-{uuid.uuid4().hex}").alias(_PART)).distinct()
        rows.repartition(_BUCKET).write.mode("append").partitionBy(_BUCKET, _PART).parquet(self.folder)
        for b, parts in old.items():
            for p in parts:
                fs, path = self._path(f"{_BUCKET}={b}", f"{_PART}={p}")
                fs.delete(path, True)

    def widened(self, folder: str, buckets: int) -> Ledger:
        """The same keys in a new folder of more buckets, for a ledger whose buckets have grown large."""
        new = Ledger(self.spark, folder, self.keys, buckets, self.parts)
        new.add(self.spark.read.parquet(self.folder).select(*self.keys), "widened")
        return new


def one_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of rows with one key the smallest, so that a replay picks the same."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    got = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("r"))
    return got.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in rows.columns])


def answer_batch(rows: DataFrame, ledger: Ledger, results: str, part: str) -> None:
    """Answer the keys of ``rows`` that the ledger does not hold: results first, then the ledger.

    Both are written under the name of the batch, so a batch that stopped anywhere can be run again.
    """
    rows = rows.persist()
    try:
        new = one_per_key(ledger.fresh(rows, part), ledger.keys)
        new.write.mode("overwrite").parquet(f"{results}/part={part}")
        written = ledger.spark.read.schema(new.schema).parquet(f"{results}/part={part}")
        ledger.add(written, part)
        ledger.merge(ledger.buckets_of(written), but=part)
    finally:
        rows.unpersist()


def read_answers(spark: SparkSession, results: str, schema) -> DataFrame:
    """Every result written so far, one per key."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(results)


def answer(
    stream: DataFrame,
    keys: Sequence[str],
    folder: str,
    checkpoint: str,
    then: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = 256,
) -> DataFrame:
    """Answer everything available in ``stream`` once per key and return all results of ``folder``.

    ``folder`` (ledger and results) and ``checkpoint`` are the caller's and outlive the run.  Stopped
    anywhere and started again, with replayed or new files, the stream leaves one result per key;
    a new checkpoint over an old folder answers only what is new.  Rows with a NULL key get no answer.
    """
    spark = stream.sparkSession
    ledger = Ledger(spark, f"{folder}/answered", keys, buckets)
    results = f"{folder}/results"

    def sink(batch: DataFrame, batch_id: int) -> None:
        # the query's id is kept in its checkpoint, so names never meet those of another checkpoint
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        answer_batch(then(batch) if then else batch, ledger, results, f"{query}-{batch_id:09d}")

    q = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
    shape = then(stream).schema if then else stream.schema
    fs, path = _file(spark, results)
    return read_answers(spark, results, shape) if fs.exists(path) else spark.createDataFrame([], shape)
