"""Greedy one-to-one assignment: in rank order, each proposer takes its first free target."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.plans.components import components
from lumenframe.plans.lineage import stored


def _fold(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Rows (part.., proposer, target) in order; the state is the targets taken in the current part."""
    part, taken, asking, served = None, set(), None, False
    for batch in batches:
        keep = []
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for i, (*here, proposer, target) in enumerate(zip(*columns)):
            if here != part:
                part, taken, asking = here, set(), None
            if proposer != asking:
                asking, served = proposer, False
            if not served and target not in taken:
                taken.add(target)
                served = True
                keep.append(i)
        if keep:
            yield batch.take(pa.array(keep)).select(list(names))


def greedy_match(
    cands: DataFrame, keys: Sequence[str], rank: str, proposer: str, target: str, small: int = 100_000
) -> DataFrame:
    """``cands`` has one row per allowed (proposer, target); targets are tried in their own order.

    A group of candidates is folded in rank order in one pass over sorted rows.  A group of more than
    ``small`` candidates is first cut where nothing contends: into connected components of proposers and
    targets, which are folded each on its own.  A proposer's rank must be its own.
    """
    keys = list(keys)
    rows = stored(cands.select(*keys, rank, proposer, target), "candidates")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > small)
    large = stored(sizes.select(*keys), "large-groups")
    parts = [*keys, "__part"]
    if large.isEmpty():
        rows = rows.withColumn("__part", F.lit(None).cast("binary"))
    else:
        here = F.struct(*keys)

        def node(kind: str, name: str):
            return F.unhex(F.sha2(F.to_json(F.struct(here.alias("k"), F.lit(kind).alias("s"), F.col(name).alias("v")), {"ignoreNullFields": "false"}), 256))

        inside = rows.join(large, keys, "left_semi")
        cut = components(inside.select(node("p", proposer).alias("a"), node("t", target).alias("b")))
        placed = inside.withColumn("node", node("p", proposer)).join(cut, "node").withColumn("__part", F.col("root"))
        rest = rows.join(large, keys, "left_anti").withColumn("__part", F.lit(None).cast("binary"))
        rows = rest.unionByName(placed.select(*rest.columns))
    order = [F.col(c) for c in (*parts, rank, proposer, target)]
    rows = rows.repartition(*parts).sortWithinPartitions(*order).select(*parts, proposer, target)
    out = [*keys, proposer, target]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _fold(batches, out)

    return rows.mapInArrow(run, schema)
