"""S-queries: catalogs, scans and sinks.  Round trips write below the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import brackets as B
from lumenframe.operators import writes as W
from lumenframe.operators.sampling import assign_sort_order
from lumenframe.plans.lineage import scratch
from lumenframe.queries import views
from lumenframe.queries.base import query
from lumenframe.sources import images as I
from lumenframe.sources import tables as T
from lumenframe.streaming.ledger import Ledger, answer_batch, read_answers

c = F.col


@query(
    "s1_frame_catalog",
    """, f AS (SELECT DISTINCT shoot, stem || '.' || ext AS name, lower(ext) AS e FROM names WHERE lower(ext) IN ('arw', 'jpg', 'jpeg', 'dng', 'png')),
      n AS (SELECT *, CASE WHEN regexp_full_match(name, '(?i)[a-z_]*?[0-9]{4,5}[.][a-z]+') THEN CAST(regexp_extract(name, '([0-9]{4,5})[.]', 1) AS INT) END AS number FROM f),
      r AS (SELECT *, row_number() OVER (PARTITION BY shoot, number ORDER BY e NOT IN ('arw', 'dng'), name) AS i FROM n)
      SELECT shoot, number, name, CASE WHEN number IS NULL THEN 1 ELSE 0 END AS place FROM r WHERE number IS NULL OR i = 1""",
    "names",
)
def _(spark, sf):
    n = views.names(spark, sf).select("shoot", F.concat_ws(".", "stem", "ext").alias("name")).distinct()
    return B.frame_catalog(n)


@query("s2_read_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    return T.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus"], c("o_orderstatus") == "F")


@query("s3_read_journal", "SELECT CAST(slug AS VARCHAR) AS slug, label, seq FROM journal WHERE seq % 10 < 8", "journal")
def _(spark, sf):
    path = scratch(spark, "journal")
    j = views.journal(spark, sf)
    good = F.to_json(F.struct(c("slug").cast("string").alias("slug"), "label", "seq"), {"ignoreNullFields": "false"})
    line = F.when(c("seq") % 10 == 8, F.concat(F.lit("{broken "), good)).when(c("seq") % 10 == 9, "  ").otherwise(good)
    j.select(line.alias("value")).write.text(path)
    return T.read_journal(spark, path)


@query(
    "s4_csv_round_trip",
    "SELECT CAST(job_id AS VARCHAR) AS job_id, stem, nullif(room_worker, '') AS room, 'a \"quoted\", cell' AS note FROM reviews",
    "reviews",
)
def _(spark, sf):
    path = scratch(spark, "csv")
    r = views.reviews(spark, sf).select("job_id", "stem", c("room_worker").alias("room"), F.lit('a "quoted", cell').alias("note"), "part_no")
    T.write_csv(r, path, ["job_id", "stem", "room", "note"])
    return T.read_csv(spark, path, ["job_id", "stem", "room", "note"])


@query("s5_read_tsv", "SELECT stem || '.' || ext AS path, CAST(file_no AS VARCHAR) AS key, sha FROM names WHERE file_no % 7 < 5", "names")
def _(spark, sf):
    path = scratch(spark, "tsv")
    n = views.names(spark, sf)
    name = F.concat_ws(".", "stem", "ext")
    good = F.concat_ws("\t", name, c("file_no").cast("string"), "sha")
    line = F.when(c("file_no") % 7 == 5, F.concat(F.lit("# "), good)).when(c("file_no") % 7 == 6, name).otherwise(good)
    n.select(line.alias("value")).write.text(path)
    return T.read_tsv(spark, path, ["path", "key", "sha"])


@query(
    "s6_json_annotations",
    "SELECT 'img-' || image || '.jpg' AS path, CAST(cls AS INT) AS label, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1 FROM boxes WHERE is_truth",
    "boxes",
)
def _(spark, sf):
    path = scratch(spark, "annotations")
    b = views.boxes(spark, sf).where("is_truth")
    T.write_annotations(b.select(F.expr("concat('img-', image, '.jpg')").alias("path"), c("cls").alias("label"), "x0", "y0", "x1", "y1", "box_id"), path, "box_id", 2)
    return T.read_annotations(spark, path)


@query(
    "s6_run_metadata",
    "SELECT event_id AS shoot, 1 AS n_triplets, 'u' || k AS under, 'm' || k AS mid, 'o' || k AS over, CAST(floor(value) AS BIGINT) AS ms FROM ev",
    "ev",
)
def _(spark, sf):
    path = scratch(spark, "runs")
    e = views.ev(spark, sf)
    trip = F.struct(*[F.concat(F.lit(n[0]), c("k").cast("string")).alias(n) for n in ("under", "mid", "over")], F.floor("value").alias("ms"))
    e.select(c("event_id").alias("shoot"), F.lit(1).alias("n_triplets"), F.array(trip).alias("triplets")).write.json(path)
    return T.read_run_metadata(spark, path)


@query("s7_read_requests", "SELECT id, job, k, t_us FROM requests", "requests")
def _(spark, sf):
    path = scratch(spark, "requests")
    views.requests(spark, sf).select("id", "job", "k", "t_us").write.json(path)
    return T.read_requests(spark, path)


@query(
    "s8_done_sink",
    """, u AS (SELECT id, min(k) AS k FROM requests GROUP BY id)
       SELECT id, CASE WHEN k % 10 = 0 THEN 'error' ELSE 'done' END AS status, CASE WHEN k % 10 = 0 THEN substr(repeat('failed ' || k || '; ', 40), 1, 200) END AS error FROM u""",
    "requests",
)
def _(spark, sf):
    path = scratch(spark, "done")
    ledger = Ledger(spark, f"{path}/answered", ["id"], buckets=16)
    rows = W.result_rows(views.requests(spark, sf).select("id", "k"), c("k") % 10 == 0, F.expr("repeat(concat('failed ', k, '; '), 40)"))
    for part in ("pass-1", "pass-1", "pass-2"):  # a replayed pass and a second one leave one result per id
        answer_batch(rows, ledger, f"{path}/results", part)
    return read_answers(spark, f"{path}/results", rows.schema)


@query(
    "s9_image_catalog",
    """, f AS (SELECT vec_id, CASE WHEN vec_id % 10 = 9 THEN NULL ELSE 8 + vec_id % 500 END AS width, CASE WHEN vec_id % 10 = 9 THEN NULL ELSE 8 + label END AS height FROM embeddings)
       SELECT 'img-' || vec_id AS path, CASE vec_id % 10 WHEN 9 THEN 4 WHEN 8 THEN 19 WHEN 7 THEN 30 WHEN 6 THEN 34 ELSE 29 END AS bytes, CAST(width AS INT) AS width, CAST(height AS INT) AS height FROM f""",
)
def _(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "label")
    w, h = F.lpad(F.hex(c("vec_id") % 500 + 8), 8, "0"), F.lpad(F.hex(c("label") + 8), 8, "0")
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), w, h, F.lit("0802000000"))
    jpg = F.concat(F.lit("FFD8FFE000044A46FFC0000B08"), F.substring(h, 5, 4), F.substring(w, 5, 4), F.lit("0000"))
    # extended WebP holds width and height less one, low byte first; TIFF here is high byte first
    less = [F.lpad(F.hex(v - 1), 6, "0") for v in (c("vec_id") % 500 + 8, c("label") + 8)]
    low = [F.concat(F.substring(v, 5, 2), F.substring(v, 3, 2), F.substring(v, 1, 2)) for v in less]
    webp = F.concat(F.lit("524946461600000057454250565038580A00000000000000"), *low)
    tiff = F.concat(F.lit("4D4D002A0000000800020100000400000001"), w, F.lit("01010004" + "00000001"), h)
    kind = c("vec_id") % 10
    data = F.unhex(F.when(kind == 9, "00FF00FF").when(kind == 8, jpg).when(kind == 7, webp).when(kind == 6, tiff).otherwise(png))
    files = e.select(F.expr("concat('img-', vec_id)").alias("path"), data.alias("content")).withColumn("length", F.octet_length("content"))
    return I.catalog_of(files).select("path", c("bytes").cast("long").alias("bytes"), "width", "height")


@query(
    "s10_output_keys",
    """, r AS (SELECT job_id, stem, row_number() OVER (PARTITION BY job_id ORDER BY stem) AS i FROM reviews WHERE output_path IS NOT NULL)
       SELECT job_id, stem, 'tours/' || job_id || '/photos/' || lpad(CAST(i AS VARCHAR), 4, '0') || '-' || stem || '.jpg' AS key FROM r""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf).where("output_path IS NOT NULL").select("job_id", "stem")
    ordered = assign_sort_order(r, ["job_id"], F.substring("stem", 1, 7), ["stem"], 1)
    return T.output_keys(ordered, "job_id", "sort_order", "stem").select("job_id", "stem", "key")


@query(
    "s10_written_by_job",
    """, r AS (SELECT job_id, stem, row_number() OVER (PARTITION BY job_id ORDER BY stem) AS i FROM reviews WHERE output_path IS NOT NULL)
       SELECT job_id, stem, 'tours/' || job_id || '/photos/' || lpad(CAST(i AS VARCHAR), 4, '0') || '-' || stem || '.jpg' AS key FROM r""",
    "reviews",
)
def _(spark, sf):
    from lumenframe.queries.base import QUERIES

    path = scratch(spark, "by-job")
    T.write_by_job(QUERIES["s10_output_keys"](spark, sf), path, "job_id")
    return spark.read.parquet(path).drop("job_bucket")
