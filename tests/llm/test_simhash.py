import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lumenframe.llm import simhash
from lumenframe.llm.components import components


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, limit=4):
    fps = sorted(set(prints))
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= limit:
                up[find(a)] = find(b)
    return {f: find(f) for f in fps}


def corpus():
    rng = random.Random(3)
    word = lambda: rng.choice(["Alpha", "bETA", "é", "🙂", "x y", "İ", "ẞ"]) + str(rng.randrange(50))
    rows = []
    for i in range(120):
        words = [word() for _ in range(rng.randrange(1, 60))]
        rows.append(rng.choice([" ", "\n", "\t ", "\x0b\x0c"]).join(words))
        for _ in range(rng.randrange(3)):
            near = list(words)
            near[rng.randrange(len(near))] = word()
            rows.append(" ".join(near))
    long_ = " ".join(f"w{rng.randrange(3000)}" for _ in range(80_000))
    return rows + [None, "", " \n", "one", "One two", "a b c", "a b c d", rows[0], rows[0].upper(), long_, long_ + " tail", "a " * 5000]


def test_groups_equal_brute_force(make_docs):
    texts = corpus()
    docs = make_docs([(7 * i % 1009, t) for i, t in enumerate(texts)] + [(None, "one"), (None, "nobody else says this at all"), (0, texts[0])])
    for name in ("key", "fp", "node", "root", "low", "part", "component_id", "fingerprint"):
        docs = docs.withColumn(name, F.lit(1))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(prints)
    low = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            low[root[p]] = min(low.get(root[p], i), i)
    want = Counter((i, f"{p:016x}", low.get(root[p])) for (i, _), p in zip(rows, prints))
    assert Counter(map(tuple, simhash.group(docs).collect())) == want
    assert len(set(low.values())) < len(set(prints))


@pytest.mark.parametrize("choice", [2, 3, 4, 5])
@pytest.mark.parametrize("block", [40, 4096])
def test_links_find_every_neighbour(spark, choice, block):
    rng = random.Random(choice)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base:
        for r in range(1, 7):
            fps.add(b ^ sum(1 << k for k in rng.sample(range(64), r)))
    # a crowd around one value, bits that depend on others, and both ends
    fps |= {base[0] ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(1, 9))) for _ in range(300)}
    fps |= {0, 1, 2**64 - 1, 2**64 - 2, 2**63}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    scheme = simhash.plan(df, choices=(choice,))
    assert sorted(b for g in scheme.groups for b in g) == list(range(64)) and sum(scheme.thresholds) == 5 - choice
    links = simhash.links(df, scheme, block=block)
    pairs = [(int(np.int64(r.a).astype(np.uint64)), int(np.int64(r.b).astype(np.uint64))) for r in links.collect()]
    assert pairs and all((a ^ b).bit_count() <= 4 for a, b in pairs)
    got = {r.node: r.root for r in components(links).collect()}
    mine = {f: got.get(s, s) for f, s in zip(fps, signed)}
    want = brute_components(list(fps))
    same = lambda d: sorted(sorted(f for f in fps if d[f] == x) for x in set(d.values()))
    assert same(mine) == same(want)


def test_thresholds_are_the_cheapest():
    rng = random.Random(5)
    for _ in range(50):
        m = rng.randrange(2, 6)
        costs = [sorted(rng.randrange(100) for _ in range(5)) for _ in range(m)]
        cost, ts = simhash.allocate(costs, 5 - m)

        def every(k, left):
            if k == m:
                return [0] if left == 0 else []
            return [(costs[k][t] if t >= 0 else 0) + c for t in range(-1, 5) for c in every(k + 1, left - t)]

        assert cost == min(every(0, 5 - m)) and sum(ts) == 5 - m


def test_correlated_bits_share_a_partition(spark):
    rng = random.Random(6)
    fps = []
    for _ in range(2000):
        x = rng.getrandbits(64)
        for k in range(0, 16):  # bits 16..31 follow bits 48..63
            x = x & ~(1 << (16 + k)) | (x >> (48 + k) & 1) << (16 + k)
        fps.append(int(np.uint64(x).astype(np.int64)))
    n, counts = simhash.bit_counts(spark.createDataFrame([(f,) for f in fps], "fp bigint"))
    groups = simhash.correlated(counts, 4)
    place = {b: k for k, g in enumerate(groups) for b in g}
    assert n == 2000 and sum(place[16 + k] == place[48 + k] for k in range(16)) >= 15


def test_empty_table(make_docs):
    got = simhash.group(make_docs([]))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.collect() == []
