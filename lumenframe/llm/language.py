"""Language identification of mixed text: script ranges, letter-triple scores per word, Viterbi.

A word's script narrows its candidate languages; its score for each is the sum of log frequencies of
its letter triples (edges included); a Viterbi pass with a penalty per switch labels the spans.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.quality import held_out

#: First and last code points of scripts.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "ethiopic": ((0x1200, 0x139F),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
CELLS = 1 << 16
_PART = 400_000
_FAR = -1e4


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: is it part of a word, is it a letter, which script (0: another)."""
    n = sys.maxunicode + 1
    kinds = [unicodedata.category(chr(c))[0] for c in range(n)]
    letter = np.fromiter((k == "L" for k in kinds), bool, n)
    word = letter | np.fromiter((k == "M" for k in kinds), bool, n)
    script = np.zeros(n, np.uint8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a : b + 1] = k
    return word, letter, script


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end outside words, marks included, where there is such a place."""
    start, word = 0, _letters()[0]
    while len(text) - start > _PART:
        end = start + _PART
        while end < len(text) and word[ord(text[end])]:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def _words(part: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the letter triples of all words; per word: its first cell, place, letters, script."""
    word, letter, script = _letters()
    code = np.frombuffer(part.encode("utf-32-le"), np.uint32)
    low = np.frombuffer("".join(c if len(c) == 1 else c[0] for c in map(str.lower, part)).encode("utf-32-le"), np.uint32) if not part.isascii() else np.frombuffer(part.lower().encode("utf-32-le"), np.uint32)
    inside = word[code]
    c = np.zeros(len(code) + 2, np.uint64)
    c[1:-1] = np.where(inside, low, 0)
    mixed = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
    at = np.flatnonzero(inside)
    cells = ((mixed[at] * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(48)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    real = letter[code[at]].astype(np.int64)
    letters = np.add.reduceat(real, first) if len(first) else np.zeros(0, np.int64)
    return cells, first, at[first] if len(first) else at, letters, script[code[at[first]]] if len(first) else np.zeros(0, np.uint8)


@dataclass(frozen=True)
class Languages:
    """``names``; ``logs`` of letter triples by cell and language; ``fits[script, language]``."""

    names: tuple[str, ...]
    logs: np.ndarray
    fits: np.ndarray
    penalty: float

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores (a row per word), places and letter counts of the words."""
        scores, places, letters, done = [], [], [], 0
        for part in _parts(text):
            cells, first, place, count, script = _words(part)
            if len(first):
                got = np.add.reduceat(self.logs[cells], first, axis=0)
                got[~self.fits[script]] += _FAR
                scores.append(got)
                places.append(place + done)
                letters.append(count)
            done += len(part)
        if not scores:
            return np.zeros((0, len(self.names))), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(scores), np.concatenate(places), np.concatenate(letters)

    def label(self, text: str) -> tuple[list[tuple[int, int, str]], str, float]:
        """Spans (start, end, language) in code points, the language of most letters, its share."""
        scores, places, letters = self.words(text)
        if not letters.sum() or not self.names:
            return [], "und", 0.0
        path, starts = best_path(scores, self.penalty)
        bounds = np.append(places[starts], len(text))
        share = np.bincount(path, np.add.reduceat(letters, starts), len(self.names))
        top = int(share.argmax())
        spans = [(int(a), int(b), self.names[k]) for a, b, k in zip(bounds[:-1], bounds[1:], path)]
        return spans, self.names[top], float(share[top] / share.sum())


def best_path(scores: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """The labels of the best path through ``scores`` less ``penalty`` per switch, as maximal runs, and
    where they start.

    Neighbouring words whose best label is the same are taken as one step first where no switch inside
    the run can pay.  Two switches inside, or one from or to the best label, never beat the best label
    throughout; one between two others saves at most a penalty by it and gives up the run's sum of gaps
    between best and second best.  Runs whose gaps add up to less go word by word.  Ties go to the smaller
    label.
    """
    top = scores.argmax(axis=1)
    first = np.flatnonzero(np.diff(top, prepend=-1))
    if len(first) == 1:
        return top[:1], first
    if scores.shape[1] > 2:
        two = np.partition(scores, -2, axis=1)[:, -2:]
        gaps = np.add.reduceat(two[:, 1] - two[:, 0], first)
        alone = np.repeat(gaps < penalty, np.diff(first, append=len(top)))
        alone[first] = True
        first = np.flatnonzero(alone)
    steps = np.add.reduceat(scores, first, axis=0)
    n, k = steps.shape
    came = np.empty((n, k), np.int32)
    now, own = steps[0].tolist(), list(range(k))
    for t, row in enumerate(steps[1:].tolist(), 1):
        high = max(now)
        at = now.index(high)
        high -= penalty
        came[t] = [i if now[i] >= high else at for i in own]
        now = [row[i] + (now[i] if now[i] >= high else high) for i in own]
    path = np.empty(n, np.int64)
    path[-1] = now.index(max(now))
    for t in range(n - 1, 0, -1):
        path[t - 1] = came[t, path[t]]
    runs = np.flatnonzero(np.diff(path, prepend=-1))
    return path[runs], first[runs]


def learn(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    most: int = 50_000,
    penalty: float = 8.0,
    smooth: float = 0.1,
    key: str = "doc_id",
    most_languages: int = 1000,
) -> Languages:
    """Letter-triple frequencies per language from the rows of ``docs`` with a language.

    Of a language with more than ``most`` rows a share is taken by a hash of the key, about ``most`` rows
    of whole texts; of others all.  A language has the scripts of at least a hundredth of its words; triples fall in 65,536
    cells, so the model has at most that many numbers per language; more than ``most_languages`` different
    values of ``lang`` are an error.  Repeated rows count as often as they come.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = known.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("h"))
    counts = rows.groupBy("lang").count().limit(most_languages + 1).collect()
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    large = {r["lang"]: int(1_000_003 * most / r["count"]) for r in counts if r["count"] > most}
    if large:
        share = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])[F.col("lang")]
        rows = rows.where(F.pmod("h", F.lit(1_000_003)) < F.coalesce(share, F.lit(1_000_003)))
    rows = rows.select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(name, np.zeros(CELLS + 256, np.int64))
                for part in _parts(x.as_py()):
                    cells, first, _, _, script = _words(part)
                    own[:CELLS] += np.bincount(cells, minlength=CELLS)
                    own[CELLS:] += np.bincount(script, minlength=256)
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at])], ["lang", "cell", "n"]
            )

    counted = rows.mapInArrow(run, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    # a row per language, of two arrays with a number per cell that occurs
    packed = counted.groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("c"))
    got = packed.select("lang", "c.cell", "c.n").orderBy("lang").toArrow()
    names = tuple(got["lang"].to_pylist())
    table = np.zeros((CELLS + 256, len(names)))
    for k in range(len(names)):
        table[got["cell"][k].values.to_numpy(), k] = got["n"][k].values.to_numpy()
    counts, scripts = table[:CELLS], table[CELLS:]
    logs = np.log(counts + smooth) - np.log(counts.sum(axis=0) + smooth * CELLS)
    fits = scripts >= np.maximum(1, 0.01 * scripts.sum(axis=0))
    fits[~fits.any(axis=1)] = True
    return Languages(names, logs.astype(np.float32), fits, penalty)


def identify(docs: DataFrame, model: Languages, key: str = "doc_id", text: str = "text", spans: bool = True) -> DataFrame:
    """``key``, ``lang_pred``, ``score`` and ``spans`` of every row.

    NULL and empty texts and those without a letter are ``und`` with score 0; so is every text if no
    language was learned.  A text in a script of no learned language takes the best of all.  Equal shares
    go to the language first by name; repeated rows get equal results; a text of any length is read
    whole, in parts cut outside words; an empty table gives no row; further columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 65,536 numbers per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = sent.value
        for batch in batches:
            got = [languages.label(x.as_py()) for x in batch.column(1)]
            columns = [batch.column(0), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.float64())]
            if spans:
                of = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                columns.append(pa.array([[dict(zip(("start", "end", "lang"), s)) for s in g[0]] for g in got], of))
            yield pa.RecordBatch.from_arrays(columns, [key, "lang_pred", "score", "spans"][: len(columns)])

    more = ", spans array<struct<start:bigint,end:bigint,lang:string>>" if spans else ""
    rows = docs.select(key, F.coalesce(text, F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"{key} {kind}, lang_pred string, score double{more}")


def identify_held_out(docs: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """``key``, ``held_out``, ``lang_pred``, ``score``: learned from the rows that are not held out."""
    model = learn(docs.where(~held_out(key)), key=key, **how)
    return identify(docs, model, key, spans=False).select(key, held_out(key).alias("held_out"), "lang_pred", "score")
