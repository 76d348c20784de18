"""SimHash groups by the generalised pigeonhole principle.

Different fingerprints are indexed once.  Correlated bits share a partition; each partition has a
threshold of its own, and the thresholds, which add up to ``limit - partitions + 1``, come from
dynamic programming over the rows to probe and the candidates to expect.  Two fingerprints within
the limit then agree, within its threshold, on at least one partition: every fingerprint is put at
its own value and probes the values around it, and what meets is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import stash
from lumenframe.llm.components import components

BITS = 64
#: Words a shingle, seed of its hash.
WIDTH, SEED = 4, 42
#: Cost of comparing two fingerprints, in rows dealt.
COMPARISON = 0.003


def fingerprint(text: bytes) -> int:
    """The fingerprint of a UTF-8 text; 0 without words."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    last = ends[min(WIDTH, len(words)) - 1 :]
    first = (ends - sizes)[: len(last)]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(last), 1 << 16):
        spans = zip(first[k : k + (1 << 16)].tolist(), last[k : k + (1 << 16)].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(last), bitorder="little").tobytes(), "little")


def sign(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fp`` (64 bits as a long) of every row; a NULL text has no words."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.fromiter((fingerprint(x.as_py()) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], ["key", "fp"])

    return rows.mapInArrow(run, f"key {kind}, fp bigint")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both of two bits, for all pairs of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1))
        for batch in batches:
            b = np.column_stack([_bits(batch.column(0).to_numpy()), np.ones(batch.num_rows, np.uint8)]).astype(np.float64)
            total += b.T @ b
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["pos", "v"])

    parts = fps.select("fp").mapInArrow(run, "pos int, v double")
    got = parts.groupBy("pos").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((BITS + 1) ** 2)
    out[got["pos"].to_numpy()] = got["v"].to_numpy()
    out = out.reshape(BITS + 1, BITS + 1)
    return int(out[-1, -1]), out


def correlated(counts: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of nearly equal size, most correlated bits together."""
    n = max(counts[-1, -1], 1)
    p = counts[-1, :BITS] / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    c = np.abs(counts[:BITS, :BITS] / n - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(c, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        rest = sorted(left)
        seed = max(rest, key=lambda i: c[i, rest].max())
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            best = max(sorted(left), key=lambda i: c[i, group].sum())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def within(rates: Sequence[float], most: int) -> list[float]:
    """Chance that at most 0 .. ``most`` of independent bits differ, given the chance of each."""
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for r in rates:
        chance[1:] = chance[1:] * (1 - r) + chance[:-1] * r
        chance[0] *= 1 - r
    return np.cumsum(chance).tolist()


def ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def allocate(costs: Sequence[Sequence[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 (not probed, cost 0) that add up to ``total`` at least cost.

    ``costs[i][t]`` is the cost of threshold ``t`` of partition ``i``.
    """
    best = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t in range(-1, len(cost)):
                new = (c + (cost[t] if t >= 0 else 0.0), [*ts, t])
                if s + t not in step or new < step[s + t]:
                    step[s + t] = new
        best = step
    return best[total]


@dataclass(frozen=True)
class Scheme:
    groups: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]
    cost: float


def _values(fps: np.ndarray, group: Sequence[int]) -> np.ndarray:
    """The bits of ``group`` as a number."""
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(group):
        out |= ((fps >> np.int64(b)) & np.int64(1)) << np.int64(k)
    return out


def _placed(batches: Iterator[pa.RecordBatch], groups: Sequence[Sequence[int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(groups), dtype=np.int32), len(fps))), pa.array(np.concatenate([_values(fps, g) for g in groups]))],
            ["part", "value"],
        )


def plan(fps: DataFrame, limit: int = 4, choices: Sequence[int] = (2, 3, 4, 5)) -> Scheme:
    """The partitions and thresholds of least estimated cost for the different fingerprints ``fps``.

    Counts of bits, pairs of bits and equal partition values cover all fingerprints.  Candidates at a
    distance are estimated from the equal ones, as if the bits of a partition differed independently.
    """
    n, counts = bit_counts(fps)
    grouped = [correlated(counts, m) for m in choices]
    flat = [g for groups in grouped for g in groups]
    per = fps.select("fp").mapInArrow(partial(_placed, groups=flat), "part int, value bigint").groupBy("part", "value").count()
    same = {r.part: r.s for r in per.groupBy("part").agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("s")).collect()}
    p = counts[-1, :BITS] / max(n, 1)
    best, at = None, 0
    for m, groups in zip(choices, grouped):
        total = limit - m + 1
        costs = []
        for k, g in enumerate(groups):
            chance = within([2 * p[b] * (1 - p[b]) for b in g], max(total + m - 1, 0))
            equal = same.get(at + k, 0.0) / 2
            ratio = [c / max(chance[0], 1e-300) for c in chance]
            probes = [1 + (len(ball(len(g), t)) - 1) / 2 if t <= 3 else np.inf for t in range(len(chance))]
            costs.append([float(n * a + COMPARISON * min(equal * r, n * n / 2)) for a, r in zip(probes, ratio)])
        at += m
        cost, thresholds = allocate(costs, total)
        if best is None or cost < best.cost:
            best = Scheme(tuple(map(tuple, groups)), tuple(thresholds), cost)
    return best


def _probes(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    """Rows (part, value, probe, fp): the own value, and larger values within the threshold."""
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for part, (group, radius) in enumerate(zip(scheme.groups, scheme.thresholds)):
            own = _values(fps, group)
            for mask in ball(len(group), radius):
                value = own ^ mask
                ask = value > own if mask else np.ones(len(fps), bool)
                m = int(ask.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, part, np.int32)), pa.array(value[ask]), pa.array(np.full(m, bool(mask))), pa.array(fps[ask])],
                    ["part", "value", "probe", "fp"],
                )


def _joined(bucket: np.ndarray, kind: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all rows of each bucket that are within ``limit``; rows of a bucket are neighbours.

    Kind 0 meets 1 and 2, kind 1 meets all, kind 2 meets 0 and 1.
    """
    up = np.arange(len(fps))
    a_out, b_out = [], []

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    at = np.arange(len(fps))
    for off in range(1, len(fps)):
        at = at[at < len(fps) - off]
        at = at[bucket[at] == bucket[at + off]]
        if not len(at):
            break
        to = at + off
        fit = (np.bitwise_count((fps[at] ^ fps[to]).view(np.uint64)) <= limit) & ~((kind[at] == kind[to]) & (kind[at] != 1))
        if not fit.any():
            continue
        while True:
            higher = up[up]
            if (higher == up).all():
                break
            up = higher
        a, b = at[fit], to[fit]
        new = up[a] != up[b]
        for x, y in zip(a[new].tolist(), b[new].tolist()):
            u, v = find(x), find(y)
            if u != v:
                up[v] = u
                a_out.append(x)
                b_out.append(y)
    return fps[a_out], fps[b_out]


def _met(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows (part, value, i, j, kind, fp), those of a bucket together: links between fingerprints."""
    held = None
    names = ("part", "value", "i", "j", "kind", "fp")

    def links(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        change = np.zeros(len(rows[0]), np.int64)
        for c in rows[:4]:
            change[1:] |= c[1:] != c[:-1]
        a, b = _joined(np.cumsum(change), rows[4], rows[5], limit)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        rows = [batch.column(k).to_numpy() for k in range(len(names))]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        if not len(rows[0]):
            continue
        tail = np.flatnonzero(np.any([c != c[-1] for c in rows[:4]], axis=0))
        cut = int(tail[-1]) + 1 if len(tail) else 0
        held = [c[cut:] for c in rows]
        if cut:
            yield from links([c[:cut] for c in rows])
    if held is not None:
        yield from links(held)


def links(fps: DataFrame, scheme: Scheme, limit: int = 4, block: int = 4096) -> DataFrame:
    """``a``, ``b``: links that connect all fingerprints within ``limit`` bits.

    A bucket of more than ``block`` rows is dealt in blocks, each pair of blocks to a task of its own,
    so no task holds more than two blocks, and a task returns only links that join something new.
    """
    rows = fps.select("fp").mapInArrow(partial(_probes, scheme=scheme), "part int, value bigint, probe boolean, fp bigint")
    big = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.sum((~F.col("probe")).cast("int")).alias("own"))
    big = big.where((F.col("n") > block) & (F.col("own") > 0)).select("part", "value", F.ceil(F.col("n") / block).cast("int").alias("b"))
    big = stash(big, "crowded-values")
    rows = rows.join(big, ["part", "value"], "left").withColumn("b", F.coalesce("b", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("b")).cast("int")
    every = F.sequence(F.lit(0), F.col("b") - 1)

    def at(i, j, kind):
        return F.struct(i.alias("i"), j.alias("j"), kind.alias("kind"))

    # an own row asks in all pairs of its block, and is asked by the blocks before; a probe is asked by all
    own = F.concat(
        F.transform(every, lambda j: at(F.col("mine"), j, F.when(j == F.col("mine"), F.lit(1)).otherwise(F.lit(0)))),
        F.transform(F.filter(every, lambda i: i < F.col("mine")), lambda i: at(i, F.col("mine"), F.lit(2))),
    )
    asked = F.transform(every, lambda i: at(i, F.col("mine"), F.lit(2)))
    rows = rows.withColumn("mine", mine).select("part", "value", F.inline(F.when(F.col("probe"), asked).otherwise(own)), "fp")
    rows = rows.repartition("part", "value", "i", "j").sortWithinPartitions("part", "value", "i", "j", "kind")
    return rows.select("part", "value", "i", "j", "kind", "fp").mapInArrow(partial(_met, limit=limit), "a bigint, b bigint")


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 4) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits), ``component_id`` of every row of ``docs``.

    Fingerprints link at ``limit`` or fewer differing bits; ``component_id`` is the smallest key
    reachable.  A text that is NULL, empty or without words has the fingerprint zero, linked like any
    other; a text of any length is read whole.  Rows with equal texts, and rows repeated whole, have
    equal results.  A NULL key is a component's id only where no other key is in it.  An empty table
    gives no row.  Further columns, whatever their names, are not read.
    """
    signed = stash(sign(docs, key, text), "simhash")
    low = F.min(F.struct(F.col("key").isNull().alias("no"), F.col("key").alias("id"))).alias("low")
    fps = stash(signed.groupBy("fp").agg(low), "simhash-fingerprints")
    found = components(links(fps, plan(fps, limit), limit))
    placed = fps.join(found, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    placed = stash(placed, "simhash-roots")
    lowest = placed.groupBy("root").agg(F.min("low").alias("low")).select("root", F.col("low.id").alias("component_id"))
    placed = placed.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    rows = signed.join(placed, "fp")
    hex_ = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select(F.col("key").alias(key), hex_.alias("fingerprint"), "component_id")
