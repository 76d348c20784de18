"""MinHash fingerprints of whole texts: universal hash permutations over word shingles, in numpy.

Spark deals the documents in slices along their ids, so that a task sees each document with the
next one; likeness is the share of equal minima.  ``similar`` joins signature bands in Spark and
confirms Jaccard similarity on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import neardup
from lumenframe.llm.common import stash
from lumenframe.llm.components import components
from lumenframe.llm.shingles import sets_of

PERMUTATIONS = 128
BAND = 4
_RNG = np.random.Generator(np.random.PCG64(77))
_A = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
#: The signature of a text without shingles.
NOTHING = np.full(PERMUTATIONS, 0xFFFF, np.uint16)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 128 16-bit minima per set."""
    out = np.tile(NOTHING, (len(sets), 1))
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    joined = np.concatenate([sets[i] for i in full])
    at = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    tmp = np.empty_like(joined)
    for k in range(PERMUTATIONS):
        np.multiply(joined, _A[k], out=tmp)
        np.add(tmp, _B[k], out=tmp)
        low = np.minimum.reduceat(tmp, at)
        out[full, k] = ((low ^ (low >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal minima; 1 for two empty texts, 0 if only one is empty."""
    if (a == NOTHING).all() != (b == NOTHING).all():
        return 0.0
    return float(np.count_nonzero(a == b)) / PERMUTATIONS


def to_text(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as many first code points of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _slice(key: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at or below ``key``, by a coarse and a fine look."""
    step = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def count(array: Column) -> Column:
        return F.size(F.filter(array, lambda b: b <= key))

    if not bounds:
        return F.lit(0)
    coarse = count(F.array(*[F.lit(b[0]) for b in blocks]))
    table = F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks])
    fine = count(F.get(table, coarse - 1))
    return F.when(key.isNull() | (coarse == 0), 0).otherwise((coarse - 1) * step + fine)


def _pieces(batches: Iterator[pa.RecordBatch], most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``most`` bytes of text, or one text."""
    for batch in batches:
        sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(batch.num_columns - 1)], np.int64)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slice, tail, doc_id, text) in order; a slice ends with a tail row, its last one's successor."""
    held = None
    for batch in _pieces(batches):
        slices, tails, ids = (batch.column(k).to_pylist() for k in range(3))
        texts = batch.column(3).to_pylist()
        signs = signatures(list(sets_of(batch.column(3))))
        pairs = []
        for i in range(len(texts)):
            if held is not None:
                assert held[0] == slices[i], "a slice ends with its tail"
                pairs.append((*held[1:], texts[i], signs[i]))
            held = None if tails[i] else (slices[i], ids[i], texts[i], signs[i])
        if not pairs:
            continue
        news = [edited(p[1], p[3]) for p in pairs]
        marks = signatures(list(sets_of(pa.array(news, pa.string()))))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pairs], batch.schema.field(2).type),
                pa.array([len(p[1]) for p in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in news]),
                pa.array([to_text(p[2]) for p in pairs]),
                pa.array([to_text(m) for m in marks]),
                pa.array([likeness(p[2], m) for p, m in zip(pairs, marks)]),
                pa.array([likeness(p[2], p[4]) for p in pairs]),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def compare_next(docs: DataFrame, key: str = "doc_id", text: str = "text", per_slice: int = 2000) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` of every row.

    The next document is that of the next larger key, after the last one the first; of rows with
    one key that with the next hash of the text; a NULL key comes first.  NULL text is empty.  A
    single document follows itself; an empty table gives no row.  The texts move once; only the
    first document of each slice is read again, for the slice before.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ids = docs.select(F.col(key).alias("doc_id"))
    n = min(10_000, max(1, ids.count() // per_slice))
    bounds = ids.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []
    bounds = sorted({int(b) for b in bounds})
    rows = rows.withColumn("slice", _slice(F.col("doc_id"), bounds))
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "h")).alias("f")
    heads = rows.groupBy("slice").agg(first).select("slice", "f.doc_id", "f.h").orderBy("slice").collect()  # a row per slice
    spark = docs.sparkSession
    before = [(heads[k - 1].slice, r.doc_id, r.h) for k, r in enumerate(heads)]
    before = spark.createDataFrame(before, f"before int, id {kind}, hh bigint")
    tails = rows.join(F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hh")))
    tails = tails.dropDuplicates(["before"]).select(F.col("before").alias("slice"), F.lit(True).alias("tail"), "doc_id", "h", "text")
    dealt = rows.select("slice", F.lit(False).alias("tail"), "doc_id", "h", "text").unionByName(tails)
    dealt = dealt.repartition(max(1, len(heads)), "slice").sortWithinPartitions("slice", "tail", "doc_id", "h").drop("h")
    return dealt.mapInArrow(
        _walk,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``mark`` (hash of the text), ``n`` (shingles), ``cls`` (digest of their set), ``signature``, ``bands``.

    A row per row: NULL and repeated keys stay, NULL text is empty and has no ``cls`` and no ``bands``; a text
    of any length is read whole; an empty table gives no row; further columns are not read.
    """
    rows = docs.select(key, F.xxhash64(text).alias("mark"), F.coalesce(text, F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            sets = list(sets_of(batch.column(2)))
            signs = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([to_text(x) for x in signs]),
                    pa.array([x.view(np.int64) if len(s) else None for s, x in zip(sets, signs)], pa.list_(pa.int64())),
                ],
                [key, "mark", "n", "cls", "signature", "bands"],
            )

    return rows.mapInArrow(run, f"{key} {kind}, mark bigint, n bigint, cls binary, signature string, bands array<bigint>")


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``key``, ``mark``, ``group``: rows whose texts are linked share a group (NULL: no shingles).

    Bands of four minima meet in Spark; links are confirmed on the full sets, ``percent`` or more of
    the union.  Equal texts are in one group; a NULL or repeated key is carried as it is; an empty table
    gives no row; further columns, whatever their names, are not read.
    """
    signed = stash(fingerprint(docs, key, text), "fingerprints")
    rep = F.min(F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("id"), "mark"))
    classes = signed.where("n > 0").groupBy("cls").agg(rep.alias("rep"), F.max("n").alias("n"), F.first("bands").alias("bands"))
    classes = stash(classes, "fingerprint-classes")
    found = components(neardup.links(classes, docs, key, text, percent))
    rows = signed.select(key, "mark", "cls").join(found, F.col("cls") == F.col("node"), "left")
    return rows.select(key, "mark", F.hex(F.coalesce("root", "cls")).alias("group"))
