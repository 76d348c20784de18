"""What several operators share: words, row digests, durable tables, sums before a leaf."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenframe.plans.lineage import scratch

#: A word, and the white space around it.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def stash(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: no lineage, no second computation.

    Such tables stay until the job is over and often hold texts, so they are compressed well.
    """
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def before(sums: DataFrame, keys: Sequence[str], leaf: str, value: str, out: str, step: int = 3) -> DataFrame:
    """Per (keys, leaf): the sum of ``value`` over all earlier leaves of the same keys.

    ``leaf`` is a string; leaves are ordered by it and grouped by ever shorter prefixes, ``step``
    characters at a time, so that no window holds more than the children of one prefix, whatever
    the number of leaves.  ``sums`` has one row per (keys, leaf).
    """
    keys = list(keys)
    longest = sums.agg(F.max(F.length(leaf))).first()[0] or 0
    cuts = list(range(max(longest - step, 0), 0, -step))
    total = sums.withColumn("__w0", F.lit(0).cast("long"))
    level = sums.select(*keys, F.col(leaf).alias("__p"), F.col(value).alias("__v"))
    done = total.select(*keys, leaf)
    parts = []
    for cut in [*cuts, 0]:
        parent = F.substring("__p", 1, cut) if cut else F.lit("")
        here = level.withColumn("__up", parent)
        w = Window.partitionBy(*keys, "__up").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
        parts.append(here.select(*keys, "__p", F.coalesce(F.sum("__v").over(w), F.lit(0)).alias("__b")))
        level = here.groupBy(*keys, "__up").agg(F.sum("__v").alias("__v")).withColumnRenamed("__up", "__p")
    lengths = [None, *cuts]
    got = done.withColumn(out, F.lit(0).cast("long"))
    for cut, part in zip(lengths, parts):
        at = F.col(leaf) if cut is None else F.substring(leaf, 1, cut)
        got = (
            got.withColumn("__p", at)
            .join(part, [*keys, "__p"])
            .select(*keys, leaf, (F.col(out) + F.col("__b")).alias(out))
        )
    return got


def leaf_digits(rows: int, per_leaf: int = 1000) -> int:
    """Hex digits of a digest that part ``rows`` rows in leaves of about ``per_leaf`` rows."""
    digits = 1
    while 16**digits * per_leaf < rows:
        digits += 1
    return digits


def pieces(rows: Iterator, most: int) -> Iterator[list]:
    """Lists of (size, item) pairs whose sizes add up to about ``most``."""
    held, total = [], 0
    for size, item in rows:
        held.append(item)
        total += size
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held
