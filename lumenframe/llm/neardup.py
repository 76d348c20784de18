"""Near-duplicate groups with HyperMinHash registers and exact confirmation.

Equal shingle sets are one class.  A class has 128 registers: per bucket the leading zeros of its
smallest hash and ten bits of mantissa.  Bands of four registers find candidates; a candidate pair
is estimated from its registers, corrected for accidental agreement, and confirmed on the full sets.

Buckets of a band are never expanded into pairs.  The member of a bucket that meets most others is
its hub; all buckets of a hub form its cell, and every member is held against the hub.  Only members
that do not link to their hub are held against the rest of their cell, in blocks, and only links
that join something new are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import stash
from lumenframe.llm.components import components
from lumenframe.llm.shingles import overlap, sets_of

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA = 10
ROWS = 4
BANDS = BUCKETS // ROWS
_U = np.uint64
#: Fixed value: the accidental agreement of two registers, for one bucket and no mantissa bit.
COLLISION = 0.169919487159739093975315012348630288992889


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed registers of a sorted set; 0 where a bucket is empty."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(hashes):
        return out
    bucket = (hashes >> _U(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    low = hashes[first] << _U(BUCKET_BITS)
    # exact position of the leading one: split in halves that a double holds exactly
    high = (low >> _U(32)).astype(np.float64)
    rest = (low & _U(0xFFFFFFFF)).astype(np.float64)
    bits = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(rest)[1])
    zeros = np.minimum(64 - bits, 62 - BUCKET_BITS)
    left = np.minimum(zeros + 1, 63).astype(np.uint64)
    mantissa = (low << left) >> _U(64 - MANTISSA)
    out[bucket[first]] = ((zeros + 1).astype(np.uint64) << _U(MANTISSA) | mantissa).astype(np.uint16)
    return out


def filled(regs: np.ndarray) -> np.ndarray:
    """Registers whose empty buckets borrow from the next full one, marked by the distance."""
    full = np.flatnonzero(regs)
    if not len(full):
        return regs
    at = np.arange(BUCKETS)
    to = np.searchsorted(full, at)
    source = np.append(full, full[0] + BUCKETS)[to]
    gap = (source - at).astype(np.uint32)
    return ((regs[source % BUCKETS].astype(np.uint32) + gap * np.uint32(0x9E37)) & np.uint32(0xFFFF)).astype(np.uint16)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    return filled(registers(hashes)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray | int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows ``a`` against ``b``, less the expected accidental agreement,
    and the number of buckets that they rest on."""
    used = np.maximum(((a != 0) | (b != 0)).sum(axis=-1), 1)
    same = ((a == b) & (a != 0)).sum(axis=-1)
    big, little = np.maximum(n_a, n_b), np.minimum(n_a, n_b)
    ratio = big / np.maximum(little, 1)
    accident = COLLISION * 2.0 ** (BUCKET_BITS - MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(same - accident, 0) / used, used


def likely(est: np.ndarray, used: np.ndarray, least: float) -> np.ndarray:
    """False only where a pair as alike as ``least`` would be seven standard errors off."""
    return est >= least - 7 * np.sqrt(least * (1 - least) / used) - 0.01


def alike(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def sign(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``mark`` (hash of the text), ``n`` (set size), ``cls`` (digest of the set), ``bands``."""
    rows = docs.select(key, F.xxhash64(text).alias("mark"), F.coalesce(text, F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, bands = [], [], []
            for s in sets_of(batch.column(2)):
                n.append(len(s))
                cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                [key, "mark", "n", "cls", "bands"],
            )

    return rows.mapInArrow(run, f"{key} {kind}, mark bigint, n bigint, cls binary, bands array<bigint>")


def cells(classes: DataFrame) -> DataFrame:
    """``hub``, ``cls``, ``n``: for each hub the classes that share a bucket with it."""
    rows = classes.select("cls", "n", F.posexplode("bands").alias("band", "key"))
    crowded = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    rows = stash(rows.join(crowded, ["band", "key"]), "buckets")
    meets = rows.groupBy("cls").agg(F.sum("met").alias("meets"))
    hubs = rows.join(meets, "cls").groupBy("band", "key").agg(F.max(F.struct("meets", "cls")).alias("h"))
    found = rows.join(hubs.select("band", "key", F.col("h.cls").alias("hub")), ["band", "key"])
    return found.where(F.col("hub") != F.col("cls")).groupBy("hub", "cls").agg(F.max("n").alias("n"))


def _against_hub(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (hub, part, cls, text) with the hub first in each part; out: hub, cls, linked, likeness."""
    where, hub, regs = None, None, None
    for batch in batches:
        out: list[tuple] = []
        names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())
        for (h, part, cls), s in zip(names, sets_of(batch.column(3))):
            if cls == h:
                where, hub, regs = (h, part), s, registers(s)
                continue
            assert where == (h, part), "a part begins with its hub"
            est, used = estimate(registers(s), regs, len(s), len(hub))
            if not likely(est, used, percent / 100):
                out.append((h, cls, False, None))
                continue
            common = overlap(s, hub)
            out.append((h, cls, alike(common, len(s), len(hub), percent), common / (len(s) + len(hub) - common)))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.binary(), pa.bool_(), pa.float64()))], ["hub", "cls", "linked", "likeness"]
            )


class _Sets:
    """Union-find over names."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        while (u := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(u, u)
            x = u
        return x

    def join(self, a, b) -> None:
        self.up[self.find(a)] = self.find(b)


def _in_cell(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (hub, i, j, ask, cls, open, linked, likeness, text), those with ``ask`` first: links found.

    The asking rows of a part are held in memory, the others stream past them.
    """
    where, asks, regs, sizes, sure, sets = None, [], None, None, None, _Sets()
    least = percent / 100
    for batch in batches:
        out: list[tuple] = []
        cols = [batch.column(k).to_pylist() for k in range(8)]
        for h, i, j, ask, cls, open_, linked, likeness, s in zip(*cols, sets_of(batch.column(8))):
            if where != (h, i, j):
                where, asks, regs, sets = (h, i, j), [], None, _Sets()
            if ask:
                asks.append((cls, s, np.nan if likeness is None else likeness, registers(s)))
                regs = None
                continue
            if not asks:
                continue
            if regs is None:
                regs = np.stack([a[3] for a in asks])
                sizes = np.array([len(a[1]) for a in asks])
                sure = np.array([a[2] for a in asks])
            mine = b"" if linked else cls
            est, used = estimate(regs, registers(s), sizes, len(s))
            fit = likely(est, used, least)
            if likeness is not None:
                # Jaccard distance is a metric: what the distances to the hub rule out needs no look
                fit &= ~(np.abs(sure - likeness) > 1 - least + 1e-9)
            for k in np.flatnonzero(fit).tolist():
                other, held = asks[k][0], asks[k][1]
                if other == cls or (open_ and other > cls) or sets.find(other) == sets.find(mine):
                    continue
                if alike(overlap(held, s), len(held), len(s), percent):
                    sets.join(other, mine)
                    out.append((other, cls))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], ["a", "b"])


def _upto(count: str) -> Column:
    """A row for each number below ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count).cast("long") - 1))


def links(classes: DataFrame, docs: DataFrame, key: str, text: str, percent: int = 85, block: int = 400_000) -> DataFrame:
    """``a``, ``b``: confirmed links between classes that connect all that are linked.

    ``block`` is the number of shingles that a task holds at once.
    """
    cell = stash(cells(classes), "cells")
    need = cell.select("cls").unionByName(cell.select(F.col("hub").alias("cls"))).distinct()
    reps = need.join(classes.select("cls", "rep"), "cls").select("cls", F.col("rep.id").alias("id"), F.col("rep.mark").alias("mark"))
    texts = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("m"), F.col(text).alias("text"))
    held = texts.join(reps, F.col("k").eqNullSafe(F.col("id")) & (F.col("m") == F.col("mark")))
    held = stash(held.dropDuplicates(["cls"]).select("cls", "text"), "held")

    parts = cell.groupBy("hub").agg(F.ceil(F.sum("n") / block).cast("int").alias("parts"))
    member = cell.join(parts, "hub").select("hub", F.pmod(F.xxhash64("cls"), F.col("parts")).alias("part"), "cls")
    hub = parts.select("hub", _upto("parts").alias("part"), F.col("hub").alias("cls"))
    rows = member.unionByName(hub).join(held, "cls").select("hub", "part", "cls", "text")
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("cls") != F.col("hub"))
    star = rows.mapInArrow(partial(_against_hub, percent=percent), "hub binary, cls binary, linked boolean, likeness double")
    star = stash(star, "star")

    # the rest of each cell that has an unlinked member
    opened = star.where("NOT linked").join(cell.select("hub", "cls", "n"), ["hub", "cls"])
    asking = opened.groupBy("hub").agg(F.ceil(F.sum("n") / block).cast("int").alias("is"))
    cell = cell.join(star, ["hub", "cls"]).join(asking, "hub").join(parts, "hub")
    spread = F.pmod(F.xxhash64("cls"), F.col("parts"))
    turn = F.pmod(F.xxhash64("cls", F.lit(1)), F.col("is"))
    common = ["hub", "i", "j", "ask", "cls", "open", "linked", "likeness"]
    cell = cell.withColumn("open", ~F.col("linked"))
    ask = cell.where("open").withColumn("ask", F.lit(True)).withColumn("i", turn)
    ask = ask.withColumn("j", _upto("parts")).select(*common)
    rest = cell.withColumn("ask", F.lit(False)).withColumn("j", spread)
    rest = rest.withColumn("i", _upto("is")).select(*common)
    rows = ask.unionByName(rest).join(held, "cls").select(*common, "text")
    rows = rows.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", F.col("ask").desc())
    more = rows.mapInArrow(partial(_in_cell, percent=percent), "a binary, b binary")
    return star.where("linked").select(F.col("hub").alias("a"), F.col("cls").alias("b")).unionByName(more)


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """``key``, ``mark``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``.

    Texts link if ``100 * common >= percent * union`` over their shingle sets; ``component_id`` is the
    smallest key reachable.  NULL texts and texts without words link to nothing: they are their own
    component and kept.  Of rows with equal texts the smallest key is kept; rows repeated whole are
    all kept or all not.  A NULL key is kept only where no other key is reachable.  Texts of any length
    are read whole.  An empty table gives no row.  Further columns, whatever their names, are not read.
    """
    signed = stash(sign(docs, key, text), "signed")
    rep = F.min(F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("id"), "mark"))
    classes = signed.where("n > 0").groupBy("cls").agg(rep.alias("rep"), F.max("n").alias("n"), F.first("bands").alias("bands"))
    classes = stash(classes, "classes")
    found = components(links(classes, docs, key, text, percent))
    placed = classes.select("cls", F.col("rep.id").alias("id")).join(found, F.col("cls") == F.col("node"))
    lowest = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    placed = placed.select("cls", "root").join(lowest, "root").select("cls", "component_id")
    whole = classes.select("cls", F.col("rep.id").alias("id")).join(placed, "cls", "left")
    whole = whole.select("cls", F.coalesce("component_id", "id").alias("component_id"))
    rows = signed.select(key, "mark", "n", "cls").join(whole, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col(key)).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col(key) == component, component.isNull())
    return rows.select(key, "mark", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def dedupe(docs: DataFrame, columns: Sequence[str], key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """``columns`` of one document per component; rows without words stay, repeated rows go once."""
    got = group(docs, key, text, percent).where("kept").select(F.col(key).alias("__k"), F.col("mark").alias("__m")).distinct()
    rows = docs.select(*columns).withColumn("__h", F.xxhash64(text))
    rows = rows.join(got, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__h") == F.col("__m")))
    return rows.dropDuplicates(["__k", "__m"]).select(*columns)
