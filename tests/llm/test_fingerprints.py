import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import fingerprints as fp
from lumenframe.llm.shingles import set_of
from test_neardup import brute, shingle_set


def texts():
    rng = random.Random(21)
    word = lambda: rng.choice(["é", "🙂"]) * rng.randrange(2) + f"w{rng.randrange(500)}"
    got = [" ".join(word() for _ in range(rng.choice([0, 1, 3, 6, 30, 200, 900]))) for _ in range(150)]
    return got + [got[3], got[3], "x " * 100_000]


def expect(rows):
    """By id: (n_chars, edited text, next text)."""
    rows = sorted(rows, key=lambda r: r[0])
    out = {}
    for k, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(t) // 4
        out[d] = (len(t), t[: len(t) - q] + nxt[:q], nxt)
    return out


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("per_slice", [2000, 7, 1])
def test_next_and_edited_texts(make_docs, per_slice):
    rng = random.Random(5)
    ids = rng.sample(range(-50, 10_000), len(texts()))
    rows = list(zip(ids, texts())) + [(20_000, None)]
    docs = make_docs(rows).repartition(6).withColumn("slice", F.lit("x")).withColumn("h", F.lit("y"))
    got = {r.doc_id: r for r in fp.compare_next(docs, per_slice=per_slice).collect()}
    want, by = expect(rows), dict(rows)
    assert set(got) == set(want)
    errors = []
    for d, (n, new, nxt) in want.items():
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(new.encode()).hexdigest())
        for text, mark in ((by[d] or "", r.fingerprint), (new, r.edited_fingerprint)):
            assert mark == fp.to_text(fp.signatures([set_of(text)])[0])
        for value, other in ((r.near_edited, new), (r.near_next, nxt)):
            assert 0 <= value <= 1
            errors.append(value - jaccard(by[d] or "", other))
    assert max(map(abs, errors)) < 0.25 and abs(np.mean(errors)) < 0.02


def test_single_row_and_empty_table(make_docs):
    (r,) = fp.compare_next(make_docs([(None, "abcd efgh")])).collect()
    assert r.near_next == 1.0 and r.n_chars == 9
    assert fp.compare_next(make_docs([])).collect() == []
    two = fp.compare_next(make_docs([(1, "a b c"), (1, "a b c"), (1, "z"), (None, None)])).collect()
    assert len(two) == 4 and len({r.fingerprint for r in two}) == 3


def test_similar_groups_equal_brute_force(make_docs):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        w = [f"w{rng.randrange(900)}" for _ in range(rng.choice([3, 20, 100, 300]))]
        rows.append((k, " ".join(w)))
        for _ in range(rng.randrange(4)):
            v = list(w)
            for _ in range(max(1, len(v) // 60)):
                v[rng.randrange(len(v))] = f"n{rng.randrange(10**6)}"
            rows.append((1000 + len(rows), " ".join(v)))
    got = {}
    for r in fp.similar(make_docs(rows + [(9999, None)])).collect():
        got.setdefault(r.group, []).append(r.doc_id)
    want = {}
    for d, _, c, _ in brute(rows, 80):
        want.setdefault(c, []).append(d)
    assert got.pop(None) == [9999]
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
