"""Sources, sinks, streams and text helpers on small files."""

import json
import time

import pytest
from pyspark.sql import functions as F

from lumenframe.functions import capture as C
from lumenframe.functions import review as R
from lumenframe.operators import udfs as U
from lumenframe.operators import writes as W
from lumenframe.sources import images as I
from lumenframe.sources import tables as T
from lumenframe.streaming import jobs as J
from lumenframe.streaming import stateful as K
import __spark_entry__ as entry
from lumenframe.streaming.ledger import answer
from lumenframe.streaming.sinks import drain, read_keyed, write_keyed


def one(spark, col, **cols):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]) if cols else spark.range(1)
    return row.select(col).first()[0]


@pytest.mark.parametrize(
    "text, ev", [("+1.5", 1.5), (" -2 ", -2.0), ("++3", 3.0), ("", None), ("n/a", None), ("1.5d", None), ("1e1", 10.0)]
)
def test_parse_ev(spark, text, ev):
    assert one(spark, C.parse_ev(F.lit(text))) == ev


@pytest.mark.parametrize(
    "text, labels",
    [
        ('```json\n{"detections":[{"label":"a","score":1}]}\n```', ["a"]),
        ('hm } {"detections":[{"label":"a","box":[1,2]},{"label":"b"}]} {"x":1}', ["a", "b"]),
        ('{"detections":[', []),
        ("{'detections':[]}", []),
        ("nothing", []),
        ('é🙂 }} {"detections":[{"label":"{"}]', []),
        ('🙂{"detections":[{"label":"é🙂"}]}}{', ["é🙂"]),
        ("", []),
    ],
)
def test_salvage(spark, text, labels):
    assert [d["label"] for d in one(spark, R.salvage_detections(F.lit(text)))] == labels


def test_salvage_reads_past_a_very_long_preamble(spark):
    text = "x" * 200_000 + '{"detections":[{"label":"far"}]}'
    assert [d["label"] for d in one(spark, R.salvage_detections(F.lit(text)))] == ["far"]


def test_salvage_of_very_many_braces(spark):
    text = "}" * 30_000 + '{"detections":[' + ",".join('{"label":"x"}' for _ in range(30_000)) + "]} {"
    assert len(one(spark, R.salvage_detections(F.lit(text)))) == 30_000


def test_bad_boxes_raise(spark):
    with pytest.raises(Exception, match="four numbers"):
        one(spark, R.pixel_box_from_corners(F.array(F.lit(0.1), F.lit(0.2)), F.lit(10.0), F.lit(10.0)))


def test_journal_skips_bad_lines(spark, tmp_path):
    (tmp_path / "j.jsonl").write_text('{"slug":"a","label":"x","seq":1}\n\n{oops\n{"slug":"a","label":null,"seq":2}\n"text"\n{"label":"y"}\n')
    got = {tuple(r) for r in T.read_journal(spark, str(tmp_path)).collect()}
    assert got == {("a", "x", 1), ("a", None, 2)}


def test_annotations_keep_images_without_boxes(spark, tmp_path):
    docs = [{"path": "a", "boxes": [[0, 1, 2, 3], [4, 5, 6, 7]], "labels": [1, 2]}, {"path": "b", "boxes": [], "labels": []}]
    (tmp_path / "d.json").write_text("\n".join(json.dumps(d) for d in docs))
    got = {(r.path, r.label, r.x0, r.y1) for r in T.read_annotations(spark, str(tmp_path)).collect()}
    assert got == {("a", 1, 0.0, 3.0), ("a", 2, 4.0, 7.0), ("b", None, None, None)}


def test_requests_are_named_by_their_file(spark, tmp_path):
    (tmp_path / "r-1.json").write_text('{"job":1,"k":2,"t_us":3}')
    (tmp_path / "r-2.json").write_text('{"id":"own","job":1,"k":2,"t_us":3}')
    (tmp_path / "note.txt").write_text("not a request")
    assert sorted(r.id for r in T.read_requests(spark, str(tmp_path)).collect()) == ["own", "r-1"]


def test_image_catalog(spark, tmp_path):
    png = bytes.fromhex("89504E470D0A1A0A0000000D49484452") + (640).to_bytes(4, "big") + (480).to_bytes(4, "big") + b"\x08\x02\0\0\0"
    exif = b"\xff\xe1" + (2 + 70_000 % 65_000).to_bytes(2, "big") + b"\xff\xc0" * (70_000 % 65_000 // 2)
    sof = b"\xff\xc2\x00\x0b\x08" + (300).to_bytes(2, "big") + (400).to_bytes(2, "big") + b"\x03\x00\x00"
    (tmp_path / "a.png").write_bytes(png)
    (tmp_path / "b.jpg").write_bytes(b"\xff\xd8" + exif + sof)
    (tmp_path / "c.jpg").write_bytes(b"broken")
    got = {r.path.rsplit("/", 1)[-1]: (r.width, r.height, r.bytes) for r in I.image_catalog(spark, str(tmp_path)).collect()}
    assert got == {"a.png": (640, 480, 29), "b.jpg": (400, 300, 2 + len(exif) + len(sof)), "c.jpg": (None, None, 6)}


def test_layout_by_job_reads_one_folder(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 300).alias("job_id"), "id")
    T.write_by_job(df, str(tmp_path / "out"), "job_id", buckets=8)
    assert len(list((tmp_path / "out").glob("job_bucket=*"))) == 8
    back = T.read_jobs(spark, str(tmp_path / "out"), "job_id", [1, 2], buckets=8)
    assert sorted(r.id for r in back.collect()) == sorted(i for i in range(1000) if i % 300 in (1, 2))
    assert "PartitionFilters: [job_bucket" in back._jdf.queryExecution().toString()


def test_sizes_of_webp_and_tiff():
    riff = lambda kind, rest: b"RIFF\0\0\0\0WEBP" + kind + b"\0\0\0\0" + rest
    assert I.header_size(riff(b"VP8X", b"\0\0\0\0" + (399).to_bytes(3, "little") + (299).to_bytes(3, "little"))) == (400, 300)
    assert I.header_size(riff(b"VP8L", b"\x2f" + (399 | 299 << 14).to_bytes(4, "little"))) == (400, 300)
    assert I.header_size(riff(b"VP8 ", b"\0\0\0\x9d\x01\x2a" + (400).to_bytes(2, "little") + (300).to_bytes(2, "little"))) == (400, 300)
    assert I.header_size(riff(b"VP8X", b"")) is None
    entry = lambda tag, kind, v: tag.to_bytes(2, "little") + kind.to_bytes(2, "little") + (1).to_bytes(4, "little") + v.to_bytes(4, "little")
    tiff = b"II*\0" + (8).to_bytes(4, "little") + (3).to_bytes(2, "little") + entry(254, 4, 0) + entry(256, 3, 400) + entry(257, 4, 300)
    assert I.header_size(tiff) == (400, 300)
    assert I.header_size(tiff[:30]) is None and I.header_size(b"II*\0") is None


def test_repeated_patches_never_multiply_rows(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    patch = spark.createDataFrame([(1, "x", 5), (1, "y", 9), (1, "z", 7)], "k int, v string, at int")
    got = {(r.k, r.v, r.updated) for r in W.guarded_update(base, patch, ["k"], F.lit(True), {"v": F.col("patch.v")}, "at").collect()}
    assert got == {(1, "y", True), (2, "b", False)}
    maps = spark.createDataFrame([(1, {"v": "p"}, 2), (1, {"v": "q"}, 1)], "k int, patch map<string,string>, at int")
    assert {(r.k, r.v) for r in W.partial_upsert(base, maps, ["k"], ["v"], "at").collect()} == {(1, "p"), (2, "b")}


def test_json_merge_keeps_types(spark):
    df = spark.createDataFrame([('{"b": 1.5, "a": {"x": [1, null]}, "c": "t"}', '{"b": true, "d": null}'), (None, "{}"), ("[1]", '{"z": 0}'), ("{}", None)], "o string, p string")
    got = [r.m for r in df.select(W.merge_json(F.col("o"), F.col("p")).alias("m")).collect()]
    assert got == ['{"a":{"x":[1,null]},"b":true,"c":"t","d":null}', "{}", '{"z":0}', "{}"]


def test_explicit_null_overwrites_and_absent_keeps(spark):
    base = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, room string, path string")
    patches = spark.createDataFrame([(1, {"room": None}), (2, {"path": "z"}), (3, {"room": "new"})], "k int, patch map<string,string>")
    got = {r.k: (r.room, r.path) for r in W.partial_upsert(base, patches, ["k"], ["room", "path"]).collect()}
    assert got == {1: (None, "p"), 2: ("b", "z"), 3: ("new", None)}


def test_only_the_bad_rows_of_a_batch_fail(spark):
    df = spark.range(100).select(F.col("id").alias("vec_id"), F.array(*[F.lit(float(i)) for i in range(12)]).alias("embedding"))
    got = U.score_batch(df, "vec_id", U.largest_feature_model, "label string, confidence double, version string").collect()
    bad = {r.vec_id for r in got if r.reason}
    assert bad == set(range(0, 100, 23)) and all(r.label == "class-11" for r in got if not r.reason)


# ---- streams -----------------------------------------------------------------------------------------


def feed(folder, name, rows):
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))
    time.sleep(0.05)  # files are taken by age


def test_request_stream_survives_replays_and_bad_requests(spark, tmp_path):
    src = tmp_path / "q"
    src.mkdir()
    feed(src, "1", [{"id": "a", "job": 1, "k": 1, "t_us": 1_000_000}, {"id": "b", "job": 1, "k": 0, "t_us": 2_000_000}])
    feed(src, "2", [{"id": "a", "job": 1, "k": 1, "t_us": 3_000_000}, {"id": "c", "job": 1, "k": 5, "t_us": 4_000_000}])
    feed(src, "3", [{"id": "new", "job": 1, "k": 1, "t_us": 10**15}])
    feed(src, "4", [{"id": "newer", "job": 1, "k": 1, "t_us": 10**15 + 1}])
    feed(src, "5", [{"id": "old", "job": 1, "k": 1, "t_us": 5}])  # years behind the others
    stream = J.with_event_time(T.stream_requests(spark, str(src), files_per_batch=1))
    got = answer(J.request_results(stream, F.col("k") == 0, F.lit("e" * 500)), ["id"], str(tmp_path / "out"), str(tmp_path / "check")).collect()
    assert {r.id: r.status for r in got} == {"a": "done", "b": "error", "c": "done", "new": "done", "newer": "done", "old": "done"}
    assert {len(r.error) for r in got if r.error} == {200}


def test_keyed_sink_is_idempotent_and_newest_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, value in ((0, 1), (1, 2), (1, 2)):
        write_keyed(spark.createDataFrame([("a", value)], "id string, v int"), path, batch)
    assert [tuple(r) for r in read_keyed(spark, path, ["id"]).collect()] == [("a", 2)]


def test_late_beats_are_dropped_behind_the_watermark(spark, tmp_path):
    src = tmp_path / "h"
    src.mkdir()
    minute = 60_000_000
    schema = "worker bigint, seq bigint, t_us bigint, load double, mem_pct int, restarts int"
    beat = {"worker": 1, "load": 1.0, "mem_pct": 10, "restarts": 0}
    feed(src, "1", [{**beat, "seq": 1, "t_us": 100 * minute}])
    feed(src, "2", [{**beat, "seq": 2, "t_us": 200 * minute}])
    feed(src, "3", [{**beat, "seq": 3, "t_us": 200 * minute}])  # late rows are judged one batch later
    feed(src, "4", [{**beat, "seq": 4, "t_us": 199 * minute}, {**beat, "seq": 5, "t_us": 101 * minute}])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))
    with pytest.warns(UserWarning, match="1 rows came behind"):
        got = drain(J.heartbeat_windows(J.with_event_time(stream), "1 minute"), ["worker", "start_us"], "update").collect()
    assert {r.start_us // minute for r in got} == {100, 199, 200}
    every = drain(J.heartbeat_windows(J.with_event_time(stream), "1 minute", None), ["worker", "start_us"], "update").collect()
    assert {r.start_us // minute for r in every} == {100, 101, 199, 200}


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["t1_request_stream", "t3_heartbeat_hours", "t4_worker_latest", "t5_progress_stream", "t6_throughput_sliding", "t8_pending_actions"])
def test_streams_on_a_folder_of_parts_in_mixed_order(spark, tmp_path, name):
    query = entry.queries()[name]
    rows = spark.read.parquet(f"{FOLDER}/events.parquet")
    rows.orderBy(F.xxhash64("event_id")).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    assert sorted(query(spark, str(tmp_path)).collect()) == sorted(query(spark, FOLDER).collect())
    nothing = tmp_path / "none"
    rows.limit(0).write.parquet(str(nothing / "events.parquet"))
    assert query(spark, str(nothing)).collect() == []


def test_brackets_of_a_stream_equal_the_batch(spark, tmp_path):
    src = tmp_path / "f"
    src.mkdir()
    evs = [-2.0, 0.0, 2.0]
    rows = [
        {"shoot": 1, "frame_id": i, "name": f"f{i:03d}", "t_us": (1000 + i * 3 + (i // 6) * 200) * 1_000_000, "ev": evs[i % 3]} for i in range(24)
    ]
    feed(src, "1", rows[0:10][::-1])  # frames arrive out of order
    feed(src, "2", rows[10:24])
    end = {"shoot": 1, "frame_id": -1, "name": "end", "ev": -9.0}
    feed(src, "3", [{**end, "t_us": 10_000_000_000}])
    feed(src, "4", [{**end, "t_us": 90_000_000_000}])
    schema = "shoot bigint, frame_id bigint, name string, t_us bigint, ev double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))
    got = drain(K.bracket_stream(J.with_event_time(stream)), ["shoot", "cluster", "frame_id"], "append", settings=K.STORE).where("frame_id >= 0")
    clusters = {}
    for r in got.collect():
        clusters.setdefault(r.cluster, set()).add(r.frame_id)
    assert sorted(map(sorted, clusters.values())) == [[3 * i, 3 * i + 1, 3 * i + 2] for i in range(8)]
