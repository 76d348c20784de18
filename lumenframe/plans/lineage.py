"""Durable cuts for iterative plans.

Loops must survive the loss of an executor, so a cut is always a reliable
checkpoint in the shared folder the session names; a private folder is made
only when the session names none and runs on one machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lumenframe-"))
    return sc.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and forget how it was made."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for written intermediate tables."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder as a table and read back."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
