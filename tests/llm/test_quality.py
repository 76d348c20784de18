import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import quality


def test_score_is_the_density_difference():
    rng = np.random.default_rng(1)
    d = len(quality.NAMES)
    data = {0: rng.normal(0, 1, (300, d)), 1: rng.normal(0.4, 0.5, (900, d))}
    sums = {k: (float(len(x)), x.sum(0), x.T @ x) for k, x in data.items()}
    model = quality.fit(sums, shrink=0.2)
    total, want = 1200, []
    spread = {k: np.cov(x.T, bias=True) for k, x in data.items()}
    pooled = sum(len(data[k]) * spread[k] for k in (0, 1)) / total
    for k, x in data.items():
        keep = 0.8 * len(x) / (len(x) + 5 * d)
        cov = keep * spread[k] + (1 - keep) * np.diag(np.diag(pooled))
        gap = data[1][:50] - x.mean(0)
        m = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)
        want.append(np.log(len(x) / total) - 0.5 * m - 0.5 * np.linalg.slogdet(cov)[1])
    assert model.score(data[1][:50]) == pytest.approx(1 / (1 + np.exp(np.clip(want[0] - want[1], -50, 50))), abs=1e-9)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.97


def test_held_out_labels_have_no_influence(spark, make_docs):
    rng = random.Random(4)
    docs = make_docs([(i, " ".join(rng.choice(["ab", "Cd.", "#x"]) for _ in range(rng.randrange(90)))) for i in range(200)])
    rows = [(i, rng.randrange(2)) for i in range(200)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in rows]
    a, b = (sorted(quality.classify(docs, spark.createDataFrame(r, "doc_id bigint, quality int")).collect()) for r in (rows, flipped))
    assert a == b


def test_nulls_extremes_and_missing_labels(spark, make_docs):
    docs = make_docs([(None, None), (1, ""), (2, "\n \t"), (3, "é🙂" * 400_000), (3, "x"), (3, "x")]).withColumn("stats", F.lit(1))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = quality.classify(docs, none).collect()
    assert len(got) == 6 and all(r.score == 0.5 and r.predicted == 0 for r in got)
    odd = spark.createDataFrame([(1, 1), (2, None), (3, 7), (None, 0), (1, 1)], "doc_id bigint, quality int")
    assert {r.score for r in quality.classify(docs, odd).collect()} <= {0.5, 1.0}
    two = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 1), (4, 1)], "doc_id bigint, quality int")
    assert all(0 <= r.score <= 1 for r in quality.classify(docs, two).collect())
    assert quality.classify(make_docs([]), two).collect() == []
