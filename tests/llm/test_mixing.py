import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import mixing


def brute(rows, weights=(3, 1, 2), share=1.5, epochs=2):
    """doc_id -> taken, source -> target, by sorting everything on one machine."""
    size = lambda t: len((t or "").split())
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in sources}
    w = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    left, target, free = share * sum(total.values()), {}, set(sources)
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if epochs * total[s] < level * w[s]]
        if not over:
            target |= {s: level * w[s] for s in free}
            break
        for s in over:
            target[s] = epochs * total[s]
            left -= target[s]
            free.discard(s)
    items = []
    for s in sources:
        run = 0
        turn = lambda r: hashlib.md5(f"mix|{'' if r[0] is None else r[0]}".encode()).hexdigest()
        for r in sorted((r for r in rows if r[2] == s), key=lambda r: (turn(r), size(r[1]))):
            run += size(r[1])
            for e in range(epochs):
                if target[s] and size(r[1]):
                    items.append(((run + e * total[s]) / target[s], turn(r), size(r[1]), e, r[0]))
    spent, taken = 0, {}
    for _, _, n, _, d in sorted(items):
        spent += n
        if spent > share * sum(total.values()):
            break
        taken[d] = taken.get(d, 0) + n
    return taken, target


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    names = ["a", "b", "c", "d", None, "hot", "hot", "hot"]
    return [(i, "w " * rng.choice([0, 1, 5, 20, 60, 400]), rng.choice(names)) for i in range(700)]


def test_mix_equals_sorting_everything(make_docs, rows):
    got = mixing.mix(make_docs(rows), ["doc_id", "source"]).select("doc.*", "size", "target", "taken").collect()
    taken, target = brute(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: r.taken for r in got if r.taken} == taken
    assert {r.source: pytest.approx(r.target) for r in got} == target
    assert all(r.taken <= 2 * r["size"] for r in got)


def test_targets_are_met_within_a_document(make_docs, rows):
    got = mixing.mix(make_docs(rows), ["source"]).groupBy("doc.source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"))
    assert all(abs(r.t - r.g) <= 2 * 400 for r in got.collect())


def test_extras_nulls_and_repeats(make_docs):
    docs = make_docs([(None, "a b", None), (None, None, None), (1, "x", "s"), (1, "x", "s"), (2, "", "s")])
    docs = docs.withColumn("size", F.lit("mine")).withColumn("leaf", F.lit(1)).withColumn("target", F.lit(0))
    got = mixing.mix(docs, ["doc_id", "size", "leaf"]).collect()
    assert len(got) == 5 and all(r.doc["size"] == "mine" for r in got)
    assert sum(r.taken for r in got) in (5, 6)


def test_empty_and_wordless_tables(make_docs):
    assert mixing.mix(make_docs([]), ["doc_id"]).collect() == []
    got = mixing.mix(make_docs([(1, None), (2, " ")]), ["doc_id"]).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * 2


def test_the_mix_repeats_whole_documents_in_order(make_docs, rows):
    docs = make_docs(rows)
    got = mixing.mixed(docs, ["doc_id", "text"]).collect()
    assert [r.finish for r in got] == sorted(r.finish for r in got)
    taken, _ = brute(rows)
    words = {}
    for r in got:
        words[r.doc.doc_id] = words.get(r.doc.doc_id, 0) + len(r.doc.text.split())
    assert words == taken
