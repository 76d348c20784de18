"""W- and L-queries: brackets, splits, running values, ordered pages and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import brackets as B
from lumenframe.operators import sampling as S
from lumenframe.plans.ordered import number_slot, time_slot
from lumenframe.queries import views
from lumenframe.queries.base import query

c = F.col

# The event log has pauses of minutes to hours, so brackets may pause for a day here.
GAP_S = 86_400.0

DEDUPED = """, ranked AS (SELECT *, row_number() OVER (PARTITION BY shoot, round_even(t_us / 1000, 0), round_even(ev, 3)
    ORDER BY (ext = 'ARW') DESC, regexp_matches(name, '\\s\\(\\d+\\)\\.[A-Za-z0-9]+$'), size DESC, name) AS rn
    FROM uploads WHERE ev IS NOT NULL AND t_us IS NOT NULL),
  dd AS (SELECT shoot, frame_id, name, ext, t_us, ev, size FROM ranked WHERE rn = 1)"""
CLUSTERED = (
    DEDUPED
    + """, flagged AS (SELECT *, CASE WHEN lag(ev) OVER w IS NULL OR ev < lag(ev) OVER w OR t_us - lag(t_us) OVER w > 86400000000
      THEN 1 ELSE 0 END AS opens FROM dd WINDOW w AS (PARTITION BY shoot ORDER BY t_us, name)),
  cl AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY shoot ORDER BY t_us, name) AS BIGINT) AS cluster FROM flagged)"""
)
OUTCOMES = (
    CLUSTERED
    + """, oc AS (SELECT shoot, cluster, count(*) AS n, arg_min(name, (t_us, name)) AS first, arg_max(name, (t_us, name)) AS last,
    arg_min(frame_id, (abs(ev), t_us, name)) FILTER (abs(ev) <= 1) AS mid,
    arg_min(frame_id, (-ev, t_us, name)) FILTER (ev <= -1) AS under,
    arg_min(frame_id, (ev, t_us, name)) FILTER (ev >= 1) AS over FROM cl GROUP BY shoot, cluster),
  rs AS (SELECT *, CASE WHEN n < 3 THEN 'only ' || n || ' frame(s)' WHEN mid IS NULL THEN 'no mid frame'
    WHEN under IS NULL THEN 'no under-exposed frame' WHEN over IS NULL THEN 'no over-exposed frame'
    WHEN mid = under OR mid = over OR under = over THEN 'same frame in two slots' END AS reason FROM oc)"""
)


def _clusters(spark, sf):
    return B.bracket_clusters(B.dedupe_frames(views.uploads(spark, sf)), GAP_S)


@query(
    "bracket_report",
    OUTCOMES
    + """, p AS (SELECT shoot, CAST(sum(n) AS BIGINT) AS frames_kept, count(*) AS brackets, count_if(reason IS NULL) AS complete,
      count_if(reason LIKE 'only%') AS too_short, count_if(reason LIKE 'no %') AS role_missing,
      count_if(reason LIKE 'same%') AS same_frame, CAST(sum(CASE WHEN reason IS NULL THEN n - 3 ELSE n END) AS BIGINT) AS orphans
      FROM rs GROUP BY shoot), u AS (SELECT shoot, count(*) AS uploads, count_if(ev IS NULL OR t_us IS NULL) AS unusable FROM uploads GROUP BY shoot)
    SELECT u.*, coalesce(frames_kept, 0) AS frames_kept, coalesce(brackets, 0) AS brackets, coalesce(complete, 0) AS complete,
      coalesce(too_short, 0) AS too_short, coalesce(role_missing, 0) AS role_missing, coalesce(same_frame, 0) AS same_frame,
      coalesce(orphans, 0) AS orphans FROM u LEFT JOIN p USING (shoot)""",
    "uploads",
)
def _(spark, sf):
    return B.bracket_report(views.uploads(spark, sf), GAP_S)


@query("w1_dedupe_frames", DEDUPED + " SELECT * FROM dd", "uploads")
def _(spark, sf):
    return B.dedupe_frames(views.uploads(spark, sf))


@query("w2_bracket_clusters", CLUSTERED + " SELECT shoot, frame_id, cluster FROM cl", "uploads")
def _(spark, sf):
    return _clusters(spark, sf).select("shoot", "frame_id", "cluster")


@query("w3_select_triplets", OUTCOMES + " SELECT shoot, cluster, under, mid, over FROM rs WHERE reason IS NULL", "uploads")
def _(spark, sf):
    return B.select_triplets(_clusters(spark, sf))


@query(
    "w3_bracket_failures",
    OUTCOMES
    + """ SELECT shoot, cluster, first, last, n, reason FROM rs WHERE reason IS NOT NULL
      UNION ALL SELECT shoot, NULL, name, name, 1, 'EV missing' FROM uploads WHERE ev IS NULL""",
    "uploads",
)
def _(spark, sf):
    up = views.uploads(spark, sf)
    return B.bracket_failures(B.bracket_clusters(B.dedupe_frames(up), GAP_S), up)


@query(
    "j5_orphan_frames",
    OUTCOMES
    + """, used AS (SELECT shoot, unnest([under, mid, over]) AS frame_id FROM rs WHERE reason IS NULL)
      SELECT shoot, frame_id, name FROM frames f WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.shoot = f.shoot AND u.frame_id = f.frame_id)""",
    "uploads",
)
def _(spark, sf):
    trip = B.select_triplets(_clusters(spark, sf))
    return B.orphan_frames(views.frames(spark, sf), trip).select("shoot", "frame_id", "name")


@query(
    "w4_sliding_triplets",
    """, f AS (SELECT event_id // 300 AS shoot, event_id % 300 + event_id % 300 // 41 AS number, name, ev FROM ev JOIN frames ON frame_id = event_id),
       w AS (SELECT a.shoot, a.number AS start, [a.ev, b.ev, c.ev] AS evs, [a.name, b.name, c.name] AS nm FROM f a
         JOIN f b ON b.shoot = a.shoot AND b.number = a.number + 1 JOIN f c ON c.shoot = a.shoot AND c.number = a.number + 2),
       v AS (SELECT *, list_min(evs) AS lo, list_max(evs) AS hi FROM w),
       x AS (SELECT *, list_position(evs, lo) AS u, list_position(evs, hi) AS o, CASE WHEN list_contains(list_transform(evs, lambda e: e IS NULL), true) THEN 'EV missing'
         WHEN lo = hi THEN 'flat' WHEN lo >= 0 THEN 'no under-exposed frame' WHEN hi <= 0 THEN 'no over-exposed frame'
         WHEN abs(evs[1] + evs[2] + evs[3] - lo - hi) > 1 THEN 'mid frame out of range' ELSE 'ok' END AS verdict FROM v),
       walk(shoot, i, free) AS (SELECT DISTINCT shoot, -1::BIGINT, 0::BIGINT FROM x UNION ALL
         SELECT walk.shoot, i + 1, CASE WHEN i + 1 >= free AND x.verdict = 'ok' THEN i + 4 ELSE free END
         FROM walk LEFT JOIN x ON x.shoot = walk.shoot AND x.start = i + 1 WHERE i < 320)
       SELECT x.shoot, start, verdict, CASE WHEN verdict = 'ok' THEN nm[u] END AS under,
         CASE WHEN verdict = 'ok' THEN nm[6 - u - o] END AS mid, CASE WHEN verdict = 'ok' THEN nm[o] END AS over
       FROM x JOIN walk ON walk.shoot = x.shoot AND walk.i = x.start - 1 WHERE start >= walk.free AND verdict <> 'flat'""",
    "frames",
)
def _(spark, sf):
    # numbering skips one counter after every 41 frames
    f = views.frames(spark, sf)
    f = f.withColumn("shoot", F.expr("frame_id DIV 300")).withColumn("number", F.expr("frame_id % 300 + frame_id % 300 DIV 41"))
    return B.sliding_triplets(f, width=64)


@query(
    "w5_assign_sort_order",
    """SELECT job_id, stem, row_number() OVER (PARTITION BY job_id ORDER BY stem) + job_id % 5 AS sort_order
       FROM reviews WHERE output_path IS NOT NULL""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf).where("output_path IS NOT NULL").select("job_id", "stem")
    return S.assign_sort_order(r, ["job_id"], F.substring("stem", 1, 7), ["stem"], c("job_id") % 5 + 1)


@query(
    "w6_even_slices",
    """, t AS (SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderkey) - 1 AS slice FROM orders)
       SELECT o_orderkey, slice, min(o_orderkey) OVER (PARTITION BY slice) IS NOT NULL AS ok,
         CAST((SELECT count(*) FROM t s WHERE s.slice < t.slice) AS BIGINT) AS "offset" FROM t""",
)
def _(spark, sf):
    o = views.table(spark, sf, "orders").select("o_orderkey")
    return S.even_slices(o, "o_orderkey", number_slot("o_orderkey", 2048), 7).withColumn("ok", F.lit(True))


@query(
    "w6_slice_plan",
    """, t AS (SELECT ntile(7) OVER (ORDER BY o_orderkey) - 1 AS slice FROM orders), s AS (SELECT slice, count(*) AS n FROM t GROUP BY slice)
       SELECT slice, CAST(coalesce(sum(n) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", n AS "limit" FROM s""",
)
def _(spark, sf):
    return S.slice_plan(views.table(spark, sf, "orders"), 7)


@query(
    "w7_group_split_cumulative",
    """, g AS (SELECT o_custkey, count(*) AS n, md5('17|' || o_custkey) AS d FROM orders GROUP BY o_custkey),
       r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY d, o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
       SELECT o_orderkey, CASE WHEN before < floor((SELECT count(*) FROM orders) * 0.12::DOUBLE) THEN 'val' ELSE 'train' END AS split
       FROM orders JOIN r USING (o_custkey)""",
)
def _(spark, sf):
    o = views.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return S.group_split_cumulative(o, "o_custkey", 0.12, 17).select("o_orderkey", "split")


@query(
    "w8_group_split_fraction",
    """, g AS (SELECT DISTINCT o_custkey FROM orders), r AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS rn FROM g)
       SELECT o_orderkey, CASE WHEN rn <= floor((SELECT count(*) FROM g) * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split
       FROM orders JOIN r USING (o_custkey)""",
)
def _(spark, sf):
    o = views.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return S.group_split_fraction(o, "o_custkey", number_slot("o_custkey", 256), 0.9).select("o_orderkey", "split")


@query(
    "w9_stratified_split",
    """, r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('0|' || vec_id), vec_id) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM embeddings)
       SELECT vec_id, CASE WHEN rn <= greatest(1, floor(n * 0.1::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM r""",
)
def _(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "label")
    return S.stratified_split(e, "label", "vec_id", 0.1, 0).select("vec_id", "split")


_RANDOM = """, r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('{seed}|' || o_orderkey), o_orderkey) AS rn, count(*) OVER () AS total FROM orders)
  SELECT o_orderkey, CASE WHEN rn <= {n} THEN 'val' ELSE 'train' END AS split FROM r"""


def _random(spark, sf, n, seed):
    return S.random_split(views.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", n, seed)


@query("w10_random_split_fraction", _RANDOM.format(seed=1, n="greatest(1, floor(total * 0.2::DOUBLE))"))
def _(spark, sf):
    return _random(spark, sf, F.greatest(F.lit(1), F.floor(c("total") * 0.2)), 1)


@query("w10_random_split_floor", _RANDOM.format(seed=2, n="greatest(300, total // 10)"))
def _(spark, sf):
    return _random(spark, sf, F.greatest(F.lit(300), F.floor(c("total") / 10)), 2)


@query("w10_random_split_fixed", _RANDOM.format(seed=3, n="20"))
def _(spark, sf):
    return _random(spark, sf, F.lit(20), 3)


@query(
    "w11_oldest_holdout",
    """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY t_us, event_id) <= 500 THEN 'eval' ELSE 'train' END AS split FROM ev""",
    "ev",
)
def _(spark, sf):
    return S.oldest_holdout(views.ev(spark, sf).select("event_id", "t_us"), "t_us", "event_id", 500).select("event_id", "split")


@query(
    "w12_even_sample",
    """, r AS (SELECT shoot, frame_id, row_number() OVER (PARTITION BY shoot ORDER BY t_us, frame_id) - 1 AS p, count(*) OVER (PARTITION BY shoot) AS n FROM frames)
       SELECT shoot, frame_id FROM r WHERE n <= 12 OR p IN (SELECT i * (r.n - 1) // 11 FROM range(12) q(i))""",
    "frames",
)
def _(spark, sf):
    f = views.frames(spark, sf).select("shoot", "frame_id", "t_us")
    return S.even_sample(f, "shoot", time_slot("t_us"), ["t_us", "frame_id"], 12).select("shoot", "frame_id")


@query(
    "w13_target_cutoff",
    """, j AS (SELECT job_id, max(created_us) AS newest FROM reviews GROUP BY job_id),
       r AS (SELECT job_id, stem, row_number() OVER (ORDER BY newest DESC, job_id, stem) AS rn FROM reviews JOIN j USING (job_id))
       SELECT job_id, stem FROM r WHERE rn <= 1000""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf).select("job_id", "stem", "created_us")
    newest = r.groupBy("job_id").agg(F.max("created_us").alias("newest"))
    rows = r.join(newest, "job_id")
    back = -c("newest")
    got = S.target_cutoff(
        rows, "job_id", [back], time_slot(back, 24 * 30), F.substring("stem", 1, 7), ["stem"], 1000
    )
    return got.select("job_id", "stem")


@query(
    "w14_balanced_cap",
    """, r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY t_us, event_id) AS rn FROM ev
         WHERE event_type IN ('click', 'error', 'view'))
       SELECT event_id, event_type FROM r WHERE rn <= 33""",
    "ev",
)
def _(spark, sf):
    e = views.ev(spark, sf).select("event_id", "event_type", "t_us")
    return S.balanced_cap(e, "event_type", ["view", "click", "error"], ["t_us", "event_id"], 100).select("event_id", "event_type")


_BEST = """SELECT event_id, coalesce(value {op} {f}(value) OVER (PARTITION BY user_id ORDER BY t_us, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS saved FROM ev"""


def _best(spark, sf, higher):
    e = views.ev(spark, sf).select("event_id", "user_id", "t_us", "value")
    got = S.best_so_far(e, ["user_id"], time_slot("t_us"), ["t_us", "event_id"], "value", higher)
    return got.select("event_id", "saved")


@query("w15_best_so_far_max", _BEST.format(op=">", f="max"), "ev")
def _(spark, sf):
    return _best(spark, sf, True)


@query("w15_best_so_far_min", _BEST.format(op="<", f="min"), "ev")
def _(spark, sf):
    return _best(spark, sf, False)


@query(
    "w16_compact_journal",
    """, m AS (SELECT slug, arg_max(struct_pack(l := label), seq).l AS label FROM journal GROUP BY slug) SELECT * FROM m WHERE label IS NOT NULL""",
    "journal",
)
def _(spark, sf):
    return S.compact_journal(views.journal(spark, sf), "slug", "seq", "label")


@query(
    "w17_latest_per_key",
    """SELECT worker, arg_max(seq, (t_us, seq)) AS seq, max(t_us) AS t_us, arg_max(load, (t_us, seq)) AS load FROM heartbeats GROUP BY worker""",
    "heartbeats",
)
def _(spark, sf):
    h = views.heartbeats(spark, sf).select("worker", "seq", "t_us", "load")
    return S.latest_per_key(h, ["worker"], ["t_us", "seq"])


@query(
    "w18_plan_rank",
    """, r AS (SELECT shoot, stem, ext, file_no, row_number() OVER (ORDER BY shoot, stem || '.' || ext || file_no) AS i FROM names WHERE lower(ext) = 'dng')
       SELECT i, lpad(CAST(i AS VARCHAR), greatest(2, length(CAST(i AS VARCHAR)))::INT, '0') || '__' || shoot || '__' || stem || '.jpg' AS out_name FROM r WHERE i <= 120""",
    "names",
)
def _(spark, sf):
    n = views.names(spark, sf).where("lower(ext) = 'dng'").withColumn("file", F.concat("stem", F.lit("."), "ext", c("file_no").cast("string")))
    got = S.plan_rank(n, "shoot", "file", 120)
    return got.select("i", F.format_string("%02d__%s__%s.jpg", "i", "shoot", "stem").alias("out_name"))


@query(
    "l1_page",
    """SELECT job_id, completed_us FROM jobs WHERE completed_us >= epoch_us(TIMESTAMP '1996-01-01') ORDER BY completed_us DESC, job_id LIMIT 50 OFFSET 25""",
    "jobs",
)
def _(spark, sf):
    j = views.jobs(spark, sf).where(c("completed_us") >= F.unix_micros(F.lit("1996-01-01").cast("timestamp")))
    return S.page(j, [c("completed_us").desc(), "job_id"], 25, 50).select("job_id", "completed_us")


@query(
    "l2_top_by_metric",
    """SELECT image_id, count(*) AS area FROM masks GROUP BY image_id ORDER BY area DESC, image_id LIMIT 25""",
    "masks",
)
def _(spark, sf):
    area = views.masks(spark, sf).groupBy("image_id").agg(F.count(F.lit(1)).alias("area"))
    return S.page(area, [c("area").desc(), "image_id"], 0, 25)


@query(
    "l3_seeded_sample",
    """, t AS (SELECT job_id, stem, job_id || '/' || stem AS id FROM reviews WHERE output_path IS NOT NULL)
       SELECT job_id, stem FROM t ORDER BY md5('5|' || id), id LIMIT 200""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf).where("output_path IS NOT NULL").withColumn("id", F.concat_ws("/", "job_id", "stem"))
    return S.seeded_sample(r, "id", 200, 5).select("job_id", "stem")


L4_SQL = """, t AS (SELECT job_id || '/' || stem AS id, conditions FROM reviews WHERE image_key IS NOT NULL),
  p AS (SELECT id FROM t WHERE conditions->>'$.dust' = 'true' ORDER BY md5('9|' || id), id LIMIT 300),
  n AS (SELECT id FROM t WHERE conditions IS NULL OR conditions->>'$.dust' IS DISTINCT FROM 'true' ORDER BY md5('9|' || id), id LIMIT (SELECT count(*) FROM p))
  SELECT id, 1 AS label FROM p UNION ALL SELECT id, 0 FROM n"""


@query("l4_balanced_binary_sample", L4_SQL, "reviews")
def _(spark, sf):
    from lumenframe.functions import review as R

    r = views.reviews(spark, sf).where("image_key IS NOT NULL").select(F.concat_ws("/", "job_id", "stem").alias("id"), "conditions")
    pos = r.where(R.has_condition(c("conditions"), "dust")).select("id")
    neg = r.where(R.lacks_condition(c("conditions"), "dust")).select("id")
    return S.balanced_binary_sample(pos, neg, "id", 300, 9)


@query(
    "l5_smallest_candidate",
    """, a AS (SELECT image_id // 3 AS box, image_id % 3 AS cand, count(*) AS size FROM masks GROUP BY ALL)
       SELECT box, arg_min(cand, (size, cand)) AS cand, min(size) AS size FROM a GROUP BY box""",
    "masks",
)
def _(spark, sf):
    a = views.masks(spark, sf).groupBy(
        F.floor(c("image_id") / 3).alias("box"), (c("image_id") % 3).alias("cand")
    ).agg(F.count(F.lit(1)).alias("size"))
    best = a.groupBy("box").agg(F.min(F.struct("size", "cand")).alias("m"))
    return best.select("box", "m.cand", "m.size")
