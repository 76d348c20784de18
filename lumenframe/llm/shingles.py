"""Hashed word shingles of many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

WIDTH = 5
_CHUNK = 1 << 20
_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = _RNG.integers(0, 1 << 63, WIDTH + 1, dtype=np.uint64) * _U(2) + _U(1)
_BASE = int(_RNG.integers(0, 1 << 62)) * 4 + 3
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(n, base % 2**64, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_BASE), run(pow(_BASE, -1, 2**64))


def _word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts ``data[at[i]:at[i + 1]]``, and where each text's begin."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    data = _LOWER[data]
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    power, inverse = _powers(max(_CHUNK * 2, 1 << n.bit_length()))
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * power[:n], out=sums[1:])
    got = (sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _PLACE[WIDTH]
    return mix(got), np.searchsorted(starts, at)


def _shingles(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    words, first = _word_hashes(data, at)
    n = len(words)
    joined = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        joined[: n - k if n > k else 0] += words[k:] * _PLACE[k]
    joined = mix(joined)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WIDTH:
            yield np.unique(joined[a : b - WIDTH + 1])
        elif b > a:
            short = np.sum(words[a:b] * _PLACE[: b - a], dtype=np.uint64) + _U(b - a)
            yield mix(np.array([short], np.uint64) ^ _PLACE[WIDTH])
        else:
            yield np.empty(0, np.uint64)


def sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    """Per text of a string column without NULLs: its sorted distinct hashed shingles.

    Words are cut at ASCII white space, A-Z lower-cased.  A text of fewer than five words is one
    shingle, a text without words has none.  Work arrays hold about a megabyte of text, or one text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    wide = pa.types.is_large_string(column.type)
    _, offsets, raw = column.buffers()
    if not n:
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(at, at[a] + _CHUNK, "right")) - 1)
        b = min(b, n)
        yield from _shingles(data[at[a] : at[b]], at[a : b + 1] - at[a])
        a = b


def set_of(text: str) -> np.ndarray:
    return next(sets_of(pa.array([text])))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))
