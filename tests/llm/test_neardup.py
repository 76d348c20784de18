import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lumenframe.llm import neardup
from lumenframe.llm.components import components
from lumenframe.llm.shingles import set_of

W = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    w = W.findall((text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4)))


def brute(rows, percent=85):
    """(doc_id, n, component, kept): every pair that shares a shingle of its prefix is compared."""
    sets = defaultdict(list)
    for d, t in rows:
        sets[shingle_set(t)].append(d)
    order = sorted((s for s in sets if s), key=len)
    df = Counter(g for s in order for g in s)
    up = list(range(len(order)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    seen = defaultdict(list)
    for i, s in enumerate(order):
        met = set()
        for g in sorted(s, key=lambda g: (df[g], g))[: len(s) - (percent * len(s) + 99) // 100 + 1]:
            met.update(seen[g])
            seen[g].append(i)
        for j in met:
            both = len(s & order[j])
            if 100 * both >= percent * (len(s) + len(order[j]) - both):
                up[find(i)] = find(j)
    low = {}
    for i, s in enumerate(order):
        low[find(i)] = min(low.get(find(i), 10**18), *sets[s], 10**18)
    out = []
    for i, s in enumerate(order):
        out += [(d, len(s), low[find(i)], d == low[find(i)]) for d in sets[s]]
    return sorted(out + [(d, 0, d, True) for d in sets.get(frozenset(), [])])


def corpus():
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    texts = [text(rng.choice([1, 3, 4, 5, 8, 12, 40, 150, 600])) for _ in range(250)]
    base = text(150).split()
    for _ in range(160):  # near copies around the limit, most not alike each other
        w = list(base)
        for _ in range(rng.randrange(1, 8)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    for t in rng.sample(texts[:250], 60):
        w = t.split()
        texts += [t, t.upper(), t.replace(" ", "\n\t "), " ".join(w[: len(w) - len(w) // 12])]
    passage = text(60)
    texts += [passage + " " + text(rng.choice([8, 20, 60])) for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "É é"), (5004, "É  é"), (5005, "x " * 30_000)]


def test_shingle_hashes_agree_with_sets():
    rng = random.Random(1)
    for _ in range(300):
        a = "".join(rng.choice(["a", "B", "é ", " ", "\n", "zz ", "漢 "]) for _ in range(rng.randrange(60)))
        b = a[: rng.randrange(len(a) + 1)] + " a" * rng.randrange(3)
        x, y = shingle_set(a), shingle_set(b)
        assert len(set_of(a)) == len(x) and len(np.intersect1d(set_of(a), set_of(b))) == len(x & y)


def test_registers_and_estimates():
    rng = np.random.default_rng(3)
    top, one = np.uint64(5) << np.uint64(57), np.uint64(1)
    (r,) = neardup.registers(np.array([top | one << np.uint64(56)])).nonzero()
    assert r.tolist() == [5]
    values = neardup.registers(np.sort(np.array([top | one << np.uint64(56), top | one << np.uint64(40) | one << np.uint64(39)])))
    assert values[5] == (16 + 1) << 10 | 512
    errors = []
    for _ in range(200):
        n = int(rng.integers(50, 3000))
        pool = rng.integers(0, 2**63, n * 2, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(pool[:n]), np.unique(pool[n // 10 : n + n // 10])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        est, used = neardup.estimate(neardup.registers(a), neardup.registers(b), len(a), len(b))
        assert neardup.likely(est, used, true)
        errors.append(est - true)
    assert abs(np.mean(errors)) < 0.01


@pytest.mark.parametrize("block", [400_000, 3000])
def test_groups_equal_brute_force(spark, make_docs, block, monkeypatch):
    rows = corpus()
    plain = neardup.links
    monkeypatch.setattr(neardup, "links", lambda *a: plain(*a, block=block))
    got = neardup.group(make_docs(rows).repartition(5)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows)


def test_one_document_of_each_group_stays(make_docs):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g"), (None, "a b c d e f g"), (None, "q"), (3, None), (3, None), (4, "")]
    got = neardup.dedupe(make_docs(rows), ["doc_id", "text"]).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got) == [(False, 1, rows[0][1]), (False, 3, ""), (False, 4, ""), (True, 0, "q")]


def test_empty_table(make_docs):
    assert neardup.group(make_docs([])).collect() == []


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(150)] + [(999, i) for i in range(400, 500)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want


def test_clashing_columns_change_nothing(make_docs):
    from pyspark.sql import functions as F

    rows = [(i, " ".join(f"w{(i // 3) * 100 + k}" for k in range(60)) + f" x{i % 3}") for i in range(30)]
    docs = make_docs(rows)
    more = docs
    for name in ("mark", "cls", "bands", "n", "node", "root", "hub", "component_id", "kept", "__k", "__m", "__h"):
        more = more.withColumn(name, F.lit("clash"))
    assert sorted(map(str, neardup.group(more).collect())) == sorted(map(str, neardup.group(docs).collect()))
    kept = neardup.dedupe(more, ["doc_id", "text", "cls"]).collect()
    assert sorted(r.doc_id for r in kept) == [i for i in range(30) if i % 3 == 0] and {r.cls for r in kept} == {"clash"}
