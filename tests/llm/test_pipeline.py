import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from lumenframe.llm import bpe
import public_tokenizers
from test_mixing import brute as mix_brute
from test_neardup import brute as group_brute
from test_rules import brute as rules_brute
from test_secrets import brute as spans_of

FOLDER = "/root/testdata/sf0.001"
W = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(rows):
    """(doc_id, text, source) of each stage's output, computed on one machine."""
    verdicts, bad = rules_brute([(r[0], r[1], r[2]) for r in rows])
    kept = {v[0] for v in verdicts if v[-1]}
    norm = lambda x: " ".join(W.findall(x)).lower()
    cut = lambda t, s: "\n".join(x for x in t.split("\n") if not (W.search(x) and (s, norm(x)) in bad))
    one = [(d, cut(t, s), s) for d, t, s in rows if d in kept]
    yield one
    stays = {d for d, _, _, k in group_brute([(d, t) for d, t, _ in one], 80) if k}
    two = [r for r in one if r[0] in stays]
    yield two

    def masked(t):
        out, at = "", 0
        for a, _, b, _ in spans_of(t):
            if a >= at and (a > at or out == ""):
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        return out + t[at:]

    three = [(d, masked(t), s) for d, t, s in two]
    yield three
    taken, _ = mix_brute(three)
    yield [r for r in three for _ in range(taken.get(r[0], 0) // max(1, len(W.findall(r[1]))))]


@pytest.fixture(scope="module")
def rows():
    t = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text", "source"]).to_pydict()
    return list(zip(t["doc_id"], t["text"], t["source"]))


def test_every_stage_equals_brute_force(spark, rows):
    docs, columns = spark.read.parquet(f"{FOLDER}/documents.parquet"), None
    columns = docs.columns
    want = list(by_hand(rows))
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want):
        got = stage(spark, docs, FOLDER).collect()
        assert [*got[0].asDict()] == columns, name
        assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(expected), name
        assert all(r.n_chars == len(r.text) for r in got)
        docs = spark.createDataFrame(got, docs.schema)
    assert len(want[0]) < len(rows) and len(want[1]) < len(want[0])
    enc = bpe.encoding(bpe.default_ranks(), public_tokenizers.PATTERN)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in last) == Counter((d, tuple(enc.encode_ordinary(t))) for d, t, _ in want[-1])
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(map(str, whole)) == Counter(map(str, last))


def test_stages_on_an_empty_table_and_nulls(spark, make_docs):
    for docs in (make_docs([]), make_docs([(None, None, None, None), (1, "", None), (1, "", None)])):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, FOLDER).count() <= 3


def test_stages_drop_columns_that_clash(spark, make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(i, f"w{i} " + " ".join(f"v{i}x{k}" for k in range(60)) + " token=abcdef1", "s") for i in range(5)])
    more = docs
    for name in ("host", "copy", "stats", "kept", "mark", "cls", "blob", "spans", "before", "doc", "leaf", "turn", "ids"):
        more = more.withColumn(name, F.lit("clash"))
    for _, stage in corpus_pipeline.STAGES:
        assert sorted(map(str, stage(spark, more, FOLDER).collect())) == sorted(map(str, stage(spark, docs, FOLDER).collect()))
