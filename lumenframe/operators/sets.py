"""Set operations on keyed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_keep_first(parts: Sequence[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Each key once, with the status of the first source that has it."""
    tagged = [
        df.select(key, F.struct(F.lit(i).alias("place"), F.lit(status).alias("status")).alias("s"))
        for i, (status, df) in enumerate(parts)
    ]
    both = reduce(DataFrame.unionByName, tagged)
    return both.groupBy(key).agg(F.min("s").alias("s")).select(key, "s.status")


def union_labelled(parts: Mapping[int, DataFrame]) -> DataFrame:
    """Disjoint sources stacked with their class."""
    return reduce(DataFrame.unionByName, [df.withColumn("label", F.lit(k)) for k, df in parts.items()])
