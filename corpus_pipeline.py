"""The corpus pipeline: documents through the training-data operators, one stage after another.

Every stage takes the documents that the stage before it kept and returns the columns of
``documents``; the last returns token ids.  NULL texts and hosts, repeated rows, ties and texts of any
length are handled as the operators say; an empty table stays empty; columns beside those of
``documents``, whatever their names, are not read and go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import bpe, mixing, neardup, rules, secrets
from lumenframe.llm.common import DOCUMENT, stash, table


def _with_length(docs: DataFrame, changed: Column) -> DataFrame:
    n = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return docs.withColumn("n_chars", n).select(*DOCUMENT)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their boilerplate lines."""
    got = rules.judge(docs, DOCUMENT).where("kept").select("doc.*", "removed_lines")
    lost = F.col("removed_lines").isNotNull()
    clean = F.when(lost, rules.without_lines(F.col("text"), F.col("removed_lines"))).otherwise(F.col("text"))
    return _with_length(got.withColumn("text", clean), lost)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.dedupe(docs, DOCUMENT, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; the base rules are scanned first, the others against their ledger."""
    blobs = secrets.blobs_of(docs)
    ledger = secrets.record(blobs, rules=secrets.BASE)
    got = secrets.redact(docs.withColumn("before", F.col("text")), (*DOCUMENT, "before"), ledger=ledger, blobs=blobs)
    return _with_length(got, F.col("text") != F.col("before"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their targets, a document once per copy taken."""
    return mixing.mixed(docs, DOCUMENT).select("doc.*")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, with the digests of the ids and of their decoding."""
    return bpe.encode(docs)


STAGES = [
    ("quality rules", rules_stage),
    ("MinHash near-dedup", neardup_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mix_stage),
    ("byte-level BPE encoding and decoding", bpe_stage),
]

#: Near-duplicate groups and BPE ids are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stash(docs, f"pipeline-{k}")
    return docs
