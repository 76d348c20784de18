"""Quality classifier: a regularised quadratic discriminant over statistics of whole texts.

Spark computes the statistics once and sums counts, vectors and outer products per class over all
labelled documents that are not held out; class covariances are shrunk towards the pooled diagonal,
factored once, and scores are differences of Gaussian log densities.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import stash

_CLASS = np.full(256, 8, np.uint8)  # non-ASCII bytes, control characters
for _k, _chars in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:", b"!?", b"#*$%&|<>", b"\"'()[]{}-_/\\@^~=+`")
):
    _CLASS[list(_chars)] = _k
NAMES = (
    "words", "chars", "word_length", "word_spread", "lower", "upper", "digits", "spaces", "stops", "calls", "symbols",
    "brackets", "other", "distinct", "top_word", "lines", "line_words", "line_repeats", "triple_repeats", "packed", "short_words",
    "bare_ends", "symbol_words", "capital_words",
)


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text; finite for every text, the empty one included."""
    raw = text.encode()
    counts = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9) / max(1, len(raw)) if raw else np.zeros(9)
    words = text.split()
    n = len(words)
    m = max(1, n)
    sizes = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1)
    each = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    k = max(1, len(lines))
    grams = list(zip(words, words[1:], words[2:]))
    head = raw[:1_000_000] if len(raw) <= 1_000_000 else None
    if head is not None:
        packed = len(zlib.compress(head, 1)) / max(64, len(head))
    else:  # a long text is packed piece by piece, all of it
        packed = sum(len(zlib.compress(raw[i : i + 1_000_000], 1)) for i in range(0, len(raw), 1_000_000)) / len(raw)
    ends = sum(w[-1] in ".!?" for w in words)
    shares = [
        len(each) / m,
        max(each.values(), default=0) / m,
    ]
    return [
        np.log1p(n),
        np.log1p(len(text)),
        np.log1p(sizes.mean()),
        np.log1p(sizes.std()),
        *np.sqrt(counts),
        *np.sqrt(shares),
        np.log1p(len(lines)),
        np.log1p(n / k),
        np.sqrt(1 - len(set(lines)) / k) if lines else 0.0,
        np.sqrt(1 - len(set(grams)) / len(grams)) if grams else 0.0,
        packed,
        np.sqrt(np.count_nonzero(sizes <= 3) / m) if n else 0.0,
        np.sqrt(ends / m),
        np.sqrt(sum(w[-1] in "#*$%&|<>!" for w in words) / m),
        np.sqrt(sum(w[0].isupper() for w in words) / m),
    ]


def held_out(key: str) -> Column:
    """True where crc32 of the key as text is 2 modulo 4."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


@dataclass(frozen=True)
class Discriminant:
    """Per class: prior, mean, inverse Cholesky factor of the covariance and its log determinant."""

    logs: tuple[float, float]
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    dets: tuple[float, float]
    heat: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for the rows of ``x``."""
        density = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.factors[k].T
            density.append(self.logs[k] - 0.5 * (z * z).sum(axis=1) - 0.5 * self.dets[k])
        gap = np.clip((density[1] - density[0]) / self.heat, -50, 50)
        return 1 / (1 + np.exp(-gap))


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float = 0.1, heat: float = 1.0) -> Discriminant | None:
    """The discriminant from count, sum and sum of outer products per class; None if one has no row."""
    if any(k not in sums or sums[k][0] < 1 for k in (0, 1)):
        return None
    means = [sums[k][1] / sums[k][0] for k in (0, 1)]
    spread = [sums[k][2] / sums[k][0] - np.outer(means[k], means[k]) for k in (0, 1)]
    total = sums[0][0] + sums[1][0]
    pooled = (sums[0][0] * spread[0] + sums[1][0] * spread[1]) / total
    floor = np.diag(np.maximum(np.diag(pooled), 1e-4))
    factors, dets = [], []
    for k in (0, 1):
        n = sums[k][0]
        keep = (1 - shrink) * n / (n + 5 * len(floor))  # few rows lean on the pooled diagonal
        low = np.linalg.cholesky(keep * spread[k] + (1 - keep) * floor)
        factors.append(np.linalg.inv(low))
        dets.append(2 * float(np.log(np.diag(low)).sum()))
    logs = tuple(float(np.log(sums[k][0] / total)) for k in (0, 1))
    return Discriminant(logs, tuple(means), tuple(factors), tuple(dets), heat)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``stats`` of every row (NULL text: empty)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], [key, "stats"])

    return docs.select(key, F.coalesce(text, F.lit("")).alias("text")).mapInArrow(run, f"{key} {kind}, stats array<double>")


def class_sums(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products of ``stats`` per ``label``: one row per label and entry."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, d)
            for k in np.unique(labels):
                own = x[labels == k]
                got = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                sums[int(k)] = sums.get(int(k), 0) + got
        for k, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(v), pa.int32()), pa.array(range(len(v)), pa.int32()), pa.array(v)], ["label", "at", "value"]
            )

    flat = rows.select(F.col("label").cast("int").alias("label"), "stats").mapInArrow(run, "label int, at int, value double")
    out: dict[int, np.ndarray] = {}
    for r in flat.groupBy("label", "at").agg(F.sum("value").alias("value")).collect():  # two labels, 601 entries each
        out.setdefault(r.label, np.zeros(1 + d + d * d))[r["at"]] = r.value
    return {k: (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for k, v in out.items()}


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", shrink: float = 0.1, heat: float = 1.0
) -> DataFrame:
    """``key``, ``held_out``, ``score``, ``predicted`` of every row.

    Labels other than 0 and 1 are ignored; a label row counts once for each document of its key and a
    document once for each label row.  Without labels of both kinds every score is that of the only
    label seen, 0.5 without any.  NULL text is empty; a NULL key meets no label.
    """
    rows = stash(measured(docs, key, text), "quality-stats").withColumn("held_out", held_out(key))
    known = labels.select(F.col(key).alias("__k"), F.col(label).alias("label")).where("label IN (0, 1)")
    taught = rows.where("NOT held_out").join(known, F.col(key) == F.col("__k"))
    sums = class_sums(taught)
    model = fit(sums, shrink, heat)
    plain = 0.5 if not sums or model is not None else float(max(sums))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), np.float64).reshape(-1, len(NAMES))
            score = np.full(len(x), plain) if model is None else model.score(x)
            score = np.round(score, 9)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.7).astype(np.int32))],
                [key, "held_out", "score", "predicted"],
            )

    return rows.select(key, "held_out", "stats").mapInArrow(run, f"{key} {kind}, held_out boolean, score double, predicted int")
