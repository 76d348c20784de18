"""X-queries: guarded updates, upserts and queue passes; Y-queries: user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import brackets as B
from lumenframe.operators import classifier as C
from lumenframe.operators import udfs as U
from lumenframe.operators import writes as W
from lumenframe.plans.lineage import scratch
from lumenframe.queries import views
from lumenframe.queries.base import QUERIES, query
from lumenframe.streaming.ledger import Ledger

c = F.col


def _base(spark, sf):
    return views.reviews(spark, sf).select("job_id", "stem", "verified_by", "interior_worker", "room_worker", c("room_corrected").alias("subtype"))


@query(
    "x1_guarded_update",
    """, p AS (SELECT DISTINCT job_id, stem, CASE part_no % 6 WHEN 0 THEN 'interior' WHEN 1 THEN 'exterior' WHEN 2 THEN 'front' WHEN 3 THEN 'ambiguous' END AS verdict, 'room-' || (supp_no % 5) AS room FROM reviews WHERE part_no % 3 <> 2),
      h AS (SELECT r.*, p.verdict, p.room, p.verdict IS NOT NULL AND verified_by IS NULL AS hit FROM reviews r LEFT JOIN p USING (job_id, stem))
      SELECT job_id, stem, CASE WHEN hit THEN verdict = 'interior' ELSE interior_worker END AS interior_worker, CASE WHEN hit AND verdict = 'interior' THEN room ELSE room_worker END AS room_worker,
        CASE WHEN hit THEN CASE WHEN verdict IN ('front', 'ambiguous') THEN verdict END ELSE room_corrected END AS subtype, hit AS updated FROM h""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf).where("part_no % 3 <> 2")
    patch = r.select(
        "job_id",
        "stem",
        F.expr("CASE part_no % 6 WHEN 0 THEN 'interior' WHEN 1 THEN 'exterior' WHEN 2 THEN 'front' WHEN 3 THEN 'ambiguous' END").alias("verdict"),
        F.expr("concat('room-', supp_no % 5)").alias("room"),
    )
    v = c("patch.verdict")
    got = W.guarded_update(
        _base(spark, sf),
        patch,
        ["job_id", "stem"],
        c("verified_by").isNull() & v.isNotNull(),
        {
            "interior_worker": v == "interior",
            "room_worker": F.when(v == "interior", c("patch.room")).otherwise(c("room_worker")),
            "subtype": F.when(v.isin("front", "ambiguous"), v),
        },
    )
    return got.drop("verified_by")


@query(
    "x1_updated_count",
    "SELECT count_if(verified_by IS NULL AND part_no % 3 <> 2 AND part_no % 6 < 4) AS updated FROM reviews",
    "reviews",
)
def _(spark, sf):
    return QUERIES["x1_guarded_update"](spark, sf).agg(F.count_if("updated").alias("updated"))


@query(
    "x2_merge_json",
    """, o AS (SELECT job_id, stem, CASE WHEN supp_no % 5 = 0 THEN '[1,2]' ELSE conditions END AS old, part_no FROM reviews),
      k AS (SELECT job_id, stem, CASE WHEN old LIKE '{%' THEN old->'$.dust' END AS dust, CASE WHEN old LIKE '{%' THEN old->'$.glare' END AS glare, part_no FROM o)
      SELECT job_id, stem, '{' || concat_ws(',', '"dust":' || dust, '"glare":' || CASE WHEN part_no % 2 = 0 THEN 'true' ELSE glare::VARCHAR END, '"n":' || part_no, '"seen":{"by":["a",null],"ok":false}', '"subtype":"v1"') || '}' AS bag FROM k""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf)
    old = F.when(c("supp_no") % 5 == 0, "[1,2]").otherwise(c("conditions"))
    glare = F.when(c("part_no") % 2 == 0, F.lit(', "glare": true')).otherwise(F.lit(""))
    patch = F.concat(F.lit('{"subtype": "v1", "seen": {"by": ["a", null], "ok": false}, "n": '), c("part_no").cast("string"), glare, F.lit("}"))
    return r.select("job_id", "stem", W.merge_json(old, patch).alias("bag"))


@query(
    "x3_partial_upsert",
    """, b AS (SELECT job_id, stem, room_worker AS room, output_path AS path FROM reviews WHERE part_no % 4 <> 3),
      p AS (SELECT DISTINCT job_id, stem, part_no % 2 = 0 AS has_room, CASE WHEN supp_no % 3 = 0 THEN NULL ELSE 'attic' END AS room, supp_no % 2 = 0 AS has_path, 'new/' || part_no AS path FROM reviews WHERE part_no % 3 = 0)
      SELECT coalesce(b.job_id, p.job_id) AS job_id, coalesce(b.stem, p.stem) AS stem, CASE WHEN has_room THEN p.room ELSE b.room END AS room, CASE WHEN has_path THEN p.path ELSE b.path END AS path
      FROM b FULL JOIN p ON b.job_id = p.job_id AND b.stem = p.stem""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf)
    base = r.where("part_no % 4 <> 3").select("job_id", "stem", c("room_worker").alias("room"), c("output_path").alias("path"))
    room = F.when(c("part_no") % 2 == 0, F.create_map(F.lit("room"), F.expr("CASE WHEN supp_no % 3 = 0 THEN NULL ELSE 'attic' END")))
    path = F.when(c("supp_no") % 2 == 0, F.create_map(F.lit("path"), F.expr("concat('new/', part_no)")))
    none = F.create_map().cast("map<string,string>")
    patch = F.map_concat(F.coalesce(room, none), F.coalesce(path, none))
    patches = r.where("part_no % 3 = 0").select("job_id", "stem", patch.alias("patch"))
    return W.partial_upsert(base, patches, ["job_id", "stem"], ["room", "path"])


@query(
    "x4_compare_and_set",
    """SELECT job_id, CASE WHEN status = 'pending' AND job_id % 3 = 0 THEN CASE WHEN job_id % 2 = 0 THEN 'error' ELSE 'processing' END ELSE status END AS status,
       CASE WHEN status = 'pending' AND job_id % 3 = 0 AND job_id % 2 = 0 THEN substr(repeat('bad ' || job_id || ' ', 100), 1, 500) END AS error, status = 'pending' AND job_id % 3 = 0 AS updated FROM jobs""",
    "jobs",
)
def _(spark, sf):
    base = views.jobs(spark, sf).select("job_id", "status", F.lit(None).cast("string").alias("error"))
    changes = base.where("job_id % 3 = 0").select(
        "job_id",
        F.when(c("job_id") % 2 == 0, "error").otherwise("processing").alias("status"),
        F.when(c("job_id") % 2 == 0, F.expr("repeat(concat('bad ', job_id, ' '), 100)")).alias("error"),
    )
    return W.compare_and_set(base, changes, "job_id", "pending")


_QUEUE = """, u AS (SELECT id, min(k) AS k FROM requests GROUP BY id)"""


@query(
    "x5_drain_queue",
    _QUEUE
    + """ SELECT u.id, CASE WHEN d.id IS NOT NULL THEN 'cleared' WHEN k % 10 = 0 THEN 'error' ELSE 'done' END AS status, CASE WHEN d.id IS NULL AND k % 10 = 0 THEN substr(repeat('failed ' || k || '; ', 40), 1, 200) END AS error
      FROM u LEFT JOIN done d ON d.id = u.id""",
    "requests done",
)
def _(spark, sf):
    req = views.requests(spark, sf).select("id", "k")
    ledger = Ledger(spark, scratch(spark, "answered"), ["id"], buckets=16)
    ledger.add(views.done(spark, sf).select("id"), "earlier")
    return W.drain_ledger(req, ledger, "this-pass", c("k") % 10 == 0, F.expr("repeat(concat('failed ', k, '; '), 40)"))


@query(
    "x6_append_results",
    """, b AS (SELECT DISTINCT id FROM done), n AS (SELECT DISTINCT id FROM requests WHERE id NOT IN (SELECT id FROM b))
      SELECT id, 'done' AS status, 1 AS created_us, 2 AS completed_us FROM b UNION ALL
      SELECT id, CASE WHEN ('0x' || substr(id, 1, 8))::BIGINT % 4 = 0 THEN 'done' ELSE 'pending' END, 100, CASE WHEN ('0x' || substr(id, 1, 8))::BIGINT % 4 = 0 THEN 200 END FROM n""",
    "requests done",
)
def _(spark, sf):
    from lumenframe.functions.review import hash_shard

    base = views.done(spark, sf).select(
        "id", F.lit("done").alias("status"), F.lit(1).cast("long").alias("created_us"), F.lit(2).cast("long").alias("completed_us")
    )
    new = views.requests(spark, sf).select("id").distinct().join(base, "id", "left_anti")
    table = W.append_results(base, new, 100)
    finished = new.where(hash_shard(c("id"), 4) == 0).select("id", F.lit("done").alias("status"), F.lit(200).cast("long").alias("completed_us"))
    return W.complete_results(table, finished, "id")


# ---- user functions -----------------------------------------------------------------------------------


@query(
    "y1_score_batch",
    """, s AS (SELECT vec_id, embedding AS e FROM embeddings) SELECT vec_id, CASE WHEN vec_id % 23 <> 0 THEN 'class-' || (list_position(e, list_max(e)) - 1) END AS label,
      CASE WHEN vec_id % 23 <> 0 THEN round(CAST(list_max(e) AS DOUBLE), 6) END AS confidence, CASE WHEN vec_id % 23 <> 0 THEN 'probe-1' END AS version, CASE WHEN vec_id % 23 = 0 THEN 'unreadable image' END AS reason FROM s""",
)
def _(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return U.score_batch(e, "vec_id", U.largest_feature_model, "label string, confidence double, version string").select(
        "vec_id", "label", F.round("confidence", 6).alias("confidence"), "version", "reason"
    )


def _consume():
    """Keep every hit that does not overlap the hit kept before it."""
    free = None

    def step(row):
        nonlocal free
        if free is None or row.start >= free:
            free = row.start + 3
            return [(row.shoot, row.start)]
        return []

    return step


@query(
    "y2_per_shoot",
    """, h AS (SELECT user_id AS shoot, event_id AS start, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM ev WHERE k % 2 = 0),
      walk(shoot, i, free, start, keep) AS (SELECT shoot, i, start + 3, start, true FROM h WHERE i = 1 UNION ALL
        SELECT h.shoot, h.i, CASE WHEN h.start >= free THEN h.start + 3 ELSE free END, h.start, h.start >= free FROM walk JOIN h ON h.shoot = walk.shoot AND h.i = walk.i + 1)
      SELECT shoot, start FROM walk WHERE keep""",
    "ev",
)
def _(spark, sf):
    hits = views.ev(spark, sf).where("k % 2 = 0").select(c("user_id").alias("shoot"), c("event_id").alias("start"))
    return U.per_group_in_order(hits, ["shoot"], ["start"], _consume, "shoot bigint, start bigint")


#: Gradient steps of fixed length reach the same minimum as the Newton steps: the loss is strictly convex.
_PROBE = """, e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label, row_number() OVER (ORDER BY md5('0|' || vec_id), vec_id) AS rn, floor(count(*) OVER () * 0.2::DOUBLE) AS n_val FROM embeddings),
      cn AS (SELECT unnest({conditions}) AS condition),
      tr AS (SELECT condition, vec_id, v, (label = condition)::INT AS y, count(*) OVER (PARTITION BY condition) AS n, sum((label = condition)::INT) OVER (PARTITION BY condition) AS np FROM e, cn WHERE rn > n_val),
      tw AS (SELECT condition, vec_id, v, y, CASE WHEN y = 1 THEN 0.5::DOUBLE / np ELSE 0.5::DOUBLE / (n - np) END AS share FROM tr),
      rec(condition, step, w, b) AS (
        SELECT condition, 0, list_transform(range(64), lambda i: 0.0::DOUBLE), 0.0::DOUBLE FROM cn
        UNION ALL
        SELECT condition, step + 1, list_transform(list_zip(w, g), lambda p: p[1] - 2.5::DOUBLE * (p[2] + 0.1::DOUBLE * p[1])), b - 2.5::DOUBLE * gb FROM (
          SELECT condition, any_value(step) AS step, any_value(w) AS w, any_value(b) AS b, list(s ORDER BY i) AS g, any_value(gb) AS gb FROM (
            SELECT condition, any_value(step) AS step, any_value(w) AS w, any_value(b) AS b, sum(r) AS gb, i, sum(r * v[i]) AS s FROM (
              SELECT tw.condition, step, w, b, v, share * (1 / (1 + exp(-(list_dot_product(v, w) + b))) - y) AS r FROM rec JOIN tw ON tw.condition = rec.condition WHERE step < 120
            ), range(1, 65) d(i) GROUP BY condition, i
          ) GROUP BY condition
        )),
      p AS (SELECT rec.condition, label = rec.condition AS t, round(list_dot_product(v, w) + b, 9) > 0 AS p FROM e, rec WHERE rn <= n_val AND step = 120),
      a AS (SELECT condition, count(*) AS n, count_if(t AND p) AS tp, count_if(NOT t AND p) AS fp, count_if(t AND NOT p) AS fn, count_if(t = p) AS hit FROM p GROUP BY condition),
      r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM a)
      SELECT {columns}tp, fp, fn, precision, recall, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1, hit / n AS accuracy FROM r"""


@query("y3_linear_probe", _PROBE.format(conditions="[3]", columns=""))
def _(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return C.condition_classifiers(e, "vec_id", "embedding", "label", [3]).drop("condition")


@query("y3_condition_classifiers", _PROBE.format(conditions="[0, 1, 2, 3, 4, 5]", columns="condition, "))
def _(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return C.condition_classifiers(e, "vec_id", "embedding", "label", [0, 1, 2, 3, 4, 5])
