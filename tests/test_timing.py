"""Sketches of times: merged over any span, filled by a stream."""

import json
import time

import numpy as np
from pyspark.sql import functions as F

from lumenframe.operators import evaluation as E
from lumenframe.streaming.sinks import drain


def test_merged_sketches_are_close_and_small_groups_exact(spark):
    rng = np.random.default_rng(1)
    rows = [("slow", int(h), float(x)) for h in range(12) for x in rng.lognormal(3, 1, 4000)] + [("few", 0, float(k)) for k in range(50)]
    df = spark.createDataFrame(rows + [("few", 1, None)], "method string, hour int, ms double")
    hours = E.timing_sketches(df, ["method", "hour"], "ms")
    probs = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    got = {r.method: r for r in E.merged_quantiles(hours, ["method"], probs).collect()}
    once = {r.method: r for r in E.merged_quantiles(E.timing_sketches(df, ["method"], "ms"), ["method"], probs).collect()}
    slow = np.sort([r[2] for r in rows if r[0] == "slow"])
    for name, p in probs.items():
        for said in (got, once):
            assert abs(np.searchsorted(slow, said["slow"][name]) / len(slow) - p) < 0.0165
        assert got["few"][name] in (np.ceil(p * 50) - 1, np.floor(p * 50))
    assert (got["slow"].n, got["few"].n) == (48_000, 50)
    # any span of hours from the same table
    part = E.merged_quantiles(hours.where("hour < 3"), ["method"], {"p50": 0.5}).where("method = 'slow'").first()
    want = np.sort([r[2] for r in rows if r[0] == "slow" and r[1] < 3])
    assert part.n == 12_000 and abs(np.searchsorted(want, part.p50) / len(want) - 0.5) < 0.0165


def test_a_stream_fills_the_sketch_table(spark, tmp_path):
    src = tmp_path / "t"
    src.mkdir()
    for k in range(3):
        rows = [{"method": "m", "hour": h, "ms": float(h * 1000 + k * 100 + i)} for h in (0, 1) for i in range(60)]
        (src / f"{k}.json").write_text("\n".join(map(json.dumps, rows)))
        time.sleep(0.05)
    stream = spark.readStream.schema("method string, hour int, ms double").option("maxFilesPerTrigger", 1).json(str(src))
    table = drain(E.timing_sketches(stream, ["method", "hour"], "ms"), ["method", "hour"], "update")
    got = E.merged_quantiles(table, ["method"], {"low": 0.0, "mid": 0.5, "high": 1.0}).first()
    assert got.n == 360 and (got.low, got.high) == (0.0, 1259.0) and 200 <= got.mid <= 1060
    assert table.where(F.col("hour") == 1).first().n == 180
