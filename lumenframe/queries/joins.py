"""J- and U-queries: joins, pairings, work plans and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import capture as C
from lumenframe.operators import joins as J
from lumenframe.operators import pairing as P
from lumenframe.operators import sampling as S
from lumenframe.queries import views
from lumenframe.queries.base import query

c = F.col


@query("j1_reviews_with_jobs", "SELECT job_id, stem, client, status FROM reviews JOIN jobs USING (job_id)", "reviews jobs")
def _(spark, sf):
    return views.reviews(spark, sf).join(views.jobs(spark, sf), "job_id").select("job_id", "stem", "client", "status")


@query(
    "j2_jobs_having_reviews",
    """SELECT job_id FROM jobs j WHERE EXISTS (SELECT 1 FROM reviews r WHERE r.job_id = j.job_id AND r.room_worker = 'exterior'
       AND r.conditions IS NOT NULL)""",
    "reviews jobs",
)
def _(spark, sf):
    hit = views.reviews(spark, sf).where("room_worker = 'exterior' AND conditions IS NOT NULL")
    return views.jobs(spark, sf).join(hit, "job_id", "left_semi").select("job_id")


@query(
    "j3_pending",
    "SELECT seq, id FROM requests r WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.id = r.id)",
    "requests done",
)
def _(spark, sf):
    return J.pending(views.requests(spark, sf), views.done(spark, sf), ["id"]).select("seq", "id")


@query(
    "j4_skip_delivered",
    """SELECT job_id, stem, CASE WHEN EXISTS (SELECT 1 FROM reviews d WHERE d.verified_by IS NOT NULL AND d.part_no = r.part_no AND d.job_id = r.job_id)
       THEN 'skipped' ELSE 'todo' END AS state FROM reviews r WHERE output_path IS NOT NULL""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf)
    todo, skipped = J.split_delivered(
        r.where("output_path IS NOT NULL"),
        r.where("verified_by IS NOT NULL").select("job_id", "part_no"),
        ["job_id", "part_no"],
    )
    both = todo.withColumn("state", F.lit("todo")).unionByName(skipped.withColumn("state", F.lit("skipped")))
    return both.select("job_id", "stem", "state")


_WANTED = "replace(name, '.' || ext, '') || ' , ' || 'LOST' || (frame_id % 50) || ',,'"


@query(
    "j6_single_frame_recovery",
    f""", w AS (SELECT DISTINCT shoot, trim(unnest(string_split({_WANTED}, ','))) AS stem FROM frames WHERE ev IS NULL OR frame_id % 10 = 0),
       x AS (SELECT * FROM w WHERE stem <> ''), f AS (SELECT shoot, frame_id, replace(name, '.' || ext, '') AS stem FROM frames)
       SELECT shoot, stem, frame_id FROM x LEFT JOIN f USING (shoot, stem)""",
    "frames",
)
def _(spark, sf):
    f = views.frames(spark, sf)
    lists = f.where("ev IS NULL OR frame_id % 10 = 0").select("shoot", F.expr(_WANTED).alias("text"))
    wanted = J.requested_stems(lists, "shoot", "text")
    stems = f.select("shoot", "frame_id", F.expr("replace(name, '.' || ext, '')").alias("stem"))
    found, lost = J.single_frame_recovery(stems, wanted, "shoot")
    return found.unionByName(lost.withColumn("frame_id", F.lit(None).cast("long")))


_STEMS = """, s AS (SELECT shoot, stem, max(CASE WHEN lower(ext) = 'dng' THEN stem || '.' || ext END) AS dng,
  max(CASE WHEN lower(ext) IN ('jpg', 'jpeg') THEN stem || '.' || ext END) AS jpg FROM names GROUP BY shoot, stem)"""


@query(
    "j7_drone_plan",
    _STEMS
    + """ SELECT shoot, stem, CASE WHEN dng IS NOT NULL THEN 'edit' ELSE 'passthrough' END AS action, coalesce(dng, jpg) AS source
      FROM s WHERE dng IS NOT NULL OR jpg IS NOT NULL""",
    "names",
)
def _(spark, sf):
    return J.drone_plan(views.names(spark, sf))


@query(
    "j7_drone_plan_bypass",
    _STEMS
    + """ SELECT shoot, stem, CASE WHEN dng IS NOT NULL AND jpg IS NOT NULL THEN 'jpg-beside' WHEN dng IS NOT NULL THEN 'develop'
      ELSE 'passthrough' END AS action, coalesce(jpg, dng) AS source FROM s WHERE dng IS NOT NULL OR jpg IS NOT NULL""",
    "names",
)
def _(spark, sf):
    return J.drone_plan(views.names(spark, sf), bypass=True)


@query(
    "j8_camera_backfill",
    _STEMS
    + """ SELECT shoot, stem, CASE WHEN jpg IS NOT NULL THEN 'jpg-beside' ELSE 'develop' END AS action, coalesce(jpg, dng) AS source
      FROM s WHERE dng IS NOT NULL AND shoot IN (SELECT shoot FROM names WHERE suffix = '_stage2-ext' AND size > 45)""",
    "names",
)
def _(spark, sf):
    n = views.names(spark, sf)
    edited = n.where("suffix = '_stage2-ext' AND size > 45").select("shoot").distinct()
    return J.camera_backfill(n, edited)


@query(
    "j9_pair_manifest",
    """, a AS (SELECT DISTINCT shoot || '/' || stem AS name FROM names WHERE ext = 'dng'), b AS (SELECT DISTINCT shoot || '/' || stem AS name FROM names WHERE ext IN ('JPG', 'jpeg'))
       SELECT name, name IN (SELECT name FROM b) AS paired FROM a""",
    "names",
)
def _(spark, sf):
    n = views.names(spark, sf).withColumn("name", F.concat_ws("/", "shoot", "stem"))
    a = n.where("ext = 'dng'").select("name").distinct()
    b = n.where("ext IN ('JPG', 'jpeg')").select("name").distinct()
    pairs, missing = P.pair_manifest(a, b, "name")
    return pairs.withColumn("paired", F.lit(True)).unionByName(missing.withColumn("paired", F.lit(False)))


def _sides(spark, sf):
    s = views.sides(spark, sf)
    return s.where("side = 'ours'").drop("side"), s.where("side = 'vendor'").drop("side")


_EXACT = """, o AS (SELECT shoot, name, num, replace(lower(name), '.jpg', '') AS st FROM sides WHERE side = 'ours'),
  v AS (SELECT shoot, name, num, replace(lower(name), '.jpg', '') AS st FROM sides WHERE side = 'vendor'),
  vk AS (SELECT shoot, key, min(name) AS vendor FROM (SELECT shoot, st AS key, name FROM v UNION ALL SELECT shoot, replace(st, '_', ''), name FROM v) GROUP BY shoot, key),
  ex AS (SELECT o.shoot, o.name AS ours, coalesce(a.vendor, b.vendor) AS vendor FROM o LEFT JOIN vk a ON a.shoot = o.shoot AND a.key = o.st
    LEFT JOIN vk b ON b.shoot = o.shoot AND b.key = replace(o.st, '_', '') WHERE coalesce(a.vendor, b.vendor) IS NOT NULL)"""


def _fuzzy_sql(ours: str) -> str:
    return f""", oo AS ({ours}),
  votes AS (SELECT oo.shoot, oo.num - v.num AS d, count(*) AS n FROM oo JOIN v ON v.shoot = oo.shoot AND abs(oo.num - v.num) <= 10 GROUP BY ALL),
  off AS (SELECT shoot, arg_min(d, (-n, abs(d), d)) AS d FROM votes GROUP BY shoot),
  ord AS (SELECT oo.shoot, oo.name, oo.num, d, row_number() OVER (PARTITION BY oo.shoot ORDER BY oo.num, oo.name) AS i FROM oo JOIN off USING (shoot)),
  cand AS (SELECT ord.shoot, ord.i, any_value(ord.name) AS name, list(v.name ORDER BY abs(v.num - (ord.num - d)), v.num, v.name)
     FILTER (v.name IS NOT NULL) AS c FROM ord LEFT JOIN v ON v.shoot = ord.shoot AND abs(v.num - (ord.num - d)) <= 1 GROUP BY ord.shoot, ord.i),
  walk(shoot, i, used, ours, vendor) AS (SELECT DISTINCT shoot, 0::BIGINT, []::VARCHAR[], ''::VARCHAR, NULL::VARCHAR FROM ord
    UNION ALL SELECT cand.shoot, cand.i, CASE WHEN p IS NULL THEN used ELSE list_append(used, p) END, cand.name, p
    FROM (SELECT walk.*, cand.i AS ci, cand.name AS cn, list_filter(coalesce(cand.c, []), lambda q: NOT list_contains(walk.used, q))[1] AS p
      FROM walk JOIN cand ON cand.shoot = walk.shoot AND cand.i = walk.i + 1) s JOIN cand ON cand.shoot = s.shoot AND cand.i = s.ci),
  fz AS (SELECT shoot, ours, vendor FROM walk WHERE vendor IS NOT NULL)"""


@query("j10_exact_match", _EXACT + " SELECT * FROM ex", "sides")
def _(spark, sf):
    return P.exact_match(*_sides(spark, sf))


@query(
    "j11_offset_votes",
    """, o AS (SELECT * FROM sides WHERE side = 'ours'), v AS (SELECT * FROM sides WHERE side = 'vendor')
       SELECT o.shoot, o.num - v.num AS "offset", count(*) AS votes FROM o JOIN v ON v.shoot = o.shoot AND abs(o.num - v.num) <= 10 GROUP BY ALL""",
    "sides",
)
def _(spark, sf):
    return P.offset_votes(*_sides(spark, sf))


@query("j11_fuzzy_pair", _EXACT + _fuzzy_sql("SELECT shoot, name, num FROM o") + " SELECT * FROM fz", "sides")
def _(spark, sf):
    return P.fuzzy_pair(*_sides(spark, sf))


@query(
    "j11_pair_with_fallback",
    _EXACT
    + _fuzzy_sql("SELECT shoot, name, num FROM o WHERE (shoot, name) NOT IN (SELECT (shoot, ours) FROM ex)")
    + " SELECT *, 'exact' AS kind FROM ex UNION ALL SELECT *, 'fuzzy' FROM fz",
    "sides",
)
def _(spark, sf):
    return P.pair_with_fallback(*_sides(spark, sf))


_RULES = [
    ("red ring", "brand#1", "economy"),
    ("ring", "no such maker", "economy"),
    ("blue", "brand#2", "promo"),
    ("widget", "brand#7", ""),
    ("g", "brand#11", "large"),
]


@query(
    "j12_match_rules",
    """, rules AS (SELECT * FROM (VALUES (0, 'red ring', 'brand#1', 'economy'), (1, 'ring', 'no such maker', 'economy'), (2, 'blue', 'brand#2', 'promo'),
         (3, 'widget', 'brand#7', ''), (4, 'g', 'brand#11', 'large')) r(rule, hint, maker, part)),
       dim AS (SELECT p_partkey AS dim_id, p_brand AS maker, p_type AS model FROM part),
       found AS (SELECT rule, hint, min(dim_id) AS dim_id, arg_min(dim.model, dim_id) AS dim_model FROM rules JOIN dim
         ON contains(lower(dim.maker), rules.maker) AND contains(lower(dim.model), rules.part) GROUP BY ALL),
       hit AS (SELECT p_partkey, min(rule) AS rule FROM part JOIN found ON contains(upper(p_name), upper(hint)) GROUP BY p_partkey)
       SELECT p_partkey, CAST(rule AS INT) AS rule, dim_id, dim_model FROM part LEFT JOIN hit USING (p_partkey) LEFT JOIN found USING (rule)""",
)
def _(spark, sf):
    p = views.table(spark, sf, "part")
    dim = p.select(c("p_partkey").alias("dim_id"), c("p_brand").alias("maker"), c("p_type").alias("model"))
    return J.match_rules(p.select("p_partkey", "p_name"), "p_name", _RULES, dim).select("p_partkey", "rule", "dim_id", "dim_model")


@query(
    "j13_settings_overlay",
    """, d AS (SELECT 'twilight.' || lower(r_name) AS key, 'base' AS value FROM region),
       st AS (SELECT CASE WHEN n_nationkey % 9 = 8 THEN 'other.' ELSE 'twilight.' END || CASE n_nationkey WHEN 1 THEN 'asia' WHEN 2 THEN 'europe' ELSE lower(n_name) END AS key,
         n_name AS value FROM nation)
       SELECT coalesce(d.key, s.key) AS key, coalesce(s.value, d.value) AS value FROM d FULL JOIN (SELECT * FROM st WHERE key LIKE 'twilight.%') s ON s.key = d.key""",
)
def _(spark, sf):
    defaults = views.table(spark, sf, "region").select(
        F.expr("concat('twilight.', lower(r_name))").alias("key"), F.lit("base").alias("value")
    )
    stored = views.table(spark, sf, "nation").select(
        F.expr(
            "concat(CASE WHEN n_nationkey % 9 = 8 THEN 'other.' ELSE 'twilight.' END, "
            "CASE n_nationkey WHEN 1 THEN 'asia' WHEN 2 THEN 'europe' ELSE lower(n_name) END)"
        ).alias("key"),
        c("n_name").alias("value"),
    )
    return J.settings_overlay(defaults, stored, "twilight.")


@query(
    "j13_resolve_style",
    """, st AS (SELECT 'style-' || n_nationkey AS style, CASE WHEN n_regionkey = 1 THEN NULL ELSE n_name || '.int' END AS interior, n_name || '.ext' AS exterior FROM nation),
       j AS (SELECT job_id, 'style-' || (photographer % 40) AS style FROM jobs)
       SELECT job_id, CASE WHEN s.style IS NOT NULL THEN s.interior ELSE d.interior END AS interior, CASE WHEN s.style IS NOT NULL THEN s.exterior ELSE d.exterior END AS exterior
       FROM j LEFT JOIN st s USING (style), (SELECT * FROM st WHERE style = 'style-0') d""",
    "jobs",
)
def _(spark, sf):
    styles = views.table(spark, sf, "nation").select(
        F.expr("concat('style-', n_nationkey)").alias("style"),
        F.expr("CASE WHEN n_regionkey = 1 THEN NULL ELSE concat(n_name, '.int') END").alias("interior"),
        F.expr("concat(n_name, '.ext')").alias("exterior"),
    )
    j = views.jobs(spark, sf).select("job_id", F.expr("concat('style-', photographer % 40)").alias("style"))
    return J.resolve_style(j, "style", styles, "style-0").select("job_id", "interior", "exterior")


@query(
    "j17_box_iou",
    """, p AS (SELECT t.image, t.cls, t.box_id AS truth_id, d.box_id AS det_id,
         greatest(0, least(t.x1, d.x1) - greatest(t.x0, d.x0)) * greatest(0, least(t.y1, d.y1) - greatest(t.y0, d.y0)) AS inter,
         (t.x1 - t.x0) * (t.y1 - t.y0) + (d.x1 - d.x0) * (d.y1 - d.y0) AS areas
         FROM boxes t JOIN boxes d ON t.image = d.image AND t.cls = d.cls AND t.is_truth AND NOT d.is_truth)
       SELECT image, cls, truth_id, det_id, inter / (areas - inter) AS iou FROM p WHERE inter / (areas - inter) >= 0.5""",
    "boxes",
)
def _(spark, sf):
    b = views.boxes(spark, sf)
    got = J.box_pairs(b.where("is_truth"), b.where("NOT is_truth"), ["image", "cls"], 0.5)
    return got.select("image", "cls", c("a_box_id").alias("truth_id"), c("b_box_id").alias("det_id"), "iou")


ANGLES_SQL = """, th AS (SELECT *, degrees(atan2(dy, dx)) AS th FROM segments),
  an AS (SELECT *, CASE WHEN abs(th - 90) < 25 THEN CAST(round((th - 90) * 1000000) AS BIGINT) END AS angle,
    CAST(round(sqrt(dx * dx + dy * dy) * 1000) AS BIGINT) AS weight FROM th)"""


@query(
    "j18_roll_consensus",
    ANGLES_SQL
    + """, cnt AS (SELECT image, count(angle) AS n FROM an GROUP BY image),
      cd AS (SELECT DISTINCT image, angle FROM an WHERE angle IS NOT NULL),
      nr AS (SELECT cd.image, cd.angle, sum(an.weight) AS w, sum(an.weight * an.angle) AS wa FROM cd JOIN an ON an.image = cd.image AND abs(an.angle - cd.angle) < 800000 GROUP BY ALL),
      b AS (SELECT image, arg_min(w, (-w, abs(angle), angle)) AS w, arg_min(wa, (-w, abs(angle), angle)) AS wa FROM nr GROUP BY image)
      SELECT image, n, CASE WHEN n < 3 THEN 0.0::DOUBLE ELSE -(wa::DOUBLE / w::DOUBLE) / 1000000 END AS roll_deg FROM cnt LEFT JOIN b USING (image)""",
    "segments",
)
def _(spark, sf):
    return J.roll_consensus(J.near_vertical(views.segments(spark, sf)))


@query("j19_agreement", "SELECT count(*) AS n, count_if(pred = pred_b) AS agree, count_if(pred = pred_b) / count(*) AS rate FROM preds", "preds")
def _(spark, sf):
    return J.agreement(views.preds(spark, sf), "pred", "pred_b")


@query("j19_disagreements", "SELECT image_id, pred, pred_b, confidence FROM preds WHERE pred <> pred_b ORDER BY confidence, image_id LIMIT 12", "preds")
def _(spark, sf):
    return J.disagreements(views.preds(spark, sf), "pred", "pred_b", "confidence", "image_id").limit(12).select(
        "image_id", "pred", "pred_b", "confidence"
    )


@query(
    "j20_inventory_drift",
    """, a AS (SELECT file_no AS path, CASE WHEN file_no % 13 = 0 THEN md5(sha) ELSE sha END AS sha FROM names WHERE file_no % 17 <> 0)
       SELECT n.file_no AS path, CASE WHEN a.path IS NULL THEN 'absent' ELSE 'changed' END AS state FROM names n LEFT JOIN a ON a.path = n.file_no
       WHERE a.sha IS DISTINCT FROM n.sha""",
    "names",
)
def _(spark, sf):
    n = views.names(spark, sf).select(c("file_no").alias("path"), "sha")
    actual = n.where("path % 17 <> 0").withColumn("sha", F.when(c("path") % 13 == 0, F.md5("sha")).otherwise(c("sha")))
    return J.inventory_drift(n, actual, "path", "sha").select("path", "state")


_LABELS = """, lab AS (SELECT slug, arg_max(struct_pack(l := label), seq).l AS label FROM journal GROUP BY slug),
  mani AS (SELECT c_custkey AS slug, 'set-' || c_nationkey || '/' || c_custkey || '.jpg' AS path FROM customer WHERE c_custkey % 6 <> 0),
  fil AS (SELECT 'set-' || c_nationkey || '/' || c_custkey || '.jpg' AS path FROM customer WHERE c_custkey % 5 <> 0)"""


def labelled(spark, sf):
    """Compacted journal over a customer manifest: labels whose file exists."""
    labels = S.compact_journal(views.journal(spark, sf), "slug", "seq", "label")
    cust = views.table(spark, sf, "customer").select(
        c("c_custkey").alias("slug"), F.expr("concat('set-', c_nationkey, '/', c_custkey, '.jpg')").alias("path")
    )
    files = cust.where("slug % 5 <> 0").select("path")
    return J.labelled_items(labels, cust.where("slug % 6 <> 0"), files, ["signup"])


@query(
    "j21_labelled_items",
    _LABELS
    + " SELECT slug, label, path FROM lab JOIN mani USING (slug) WHERE label <> 'signup' AND path IN (SELECT path FROM fil)",
    "journal",
)
def _(spark, sf):
    return labelled(spark, sf).select("slug", "label", "path")


def _records(spark, sf):
    r = views.reviews(spark, sf)
    rec = r.select("job_id", "stem", c("output_path").alias("object_key"), "image_key")
    cls = r.where("part_no % 3 <> 0").select(
        "job_id", "stem", c("room_worker").alias("room"), F.when(c("supp_no") % 8 != 0, c("interior_worker")).alias("is_interior")
    )
    return rec, cls


@query(
    "j22_asset_batch",
    """SELECT job_id, stem, output_path AS object_key, image_key, CASE WHEN part_no % 3 <> 0 THEN room_worker END AS room FROM reviews
       WHERE output_path IS NOT NULL AND image_key IS NOT NULL""",
    "reviews",
)
def _(spark, sf):
    rec, cls = _records(spark, sf)
    return J.asset_batch(rec, cls, ["job_id", "stem"]).select("job_id", "stem", "object_key", "image_key", "room")


@query(
    "j23_exterior_requests",
    """, pl AS (SELECT s_suppkey AS plate_id, s_name AS plate_path FROM supplier WHERE s_acctbal > 0),
       pn AS (SELECT *, row_number() OVER (ORDER BY plate_id) - 1 AS i FROM pl)
       SELECT job_id, stem, plate_id, plate_path FROM reviews JOIN pn ON i = ('0x' || substr(sha256(CAST(job_id AS VARCHAR)), 1, 8))::BIGINT % (SELECT count(*) FROM pn)
       WHERE output_path IS NOT NULL AND part_no % 3 <> 0 AND supp_no % 8 <> 0 AND NOT interior_worker""",
    "reviews",
)
def _(spark, sf):
    rec, cls = _records(spark, sf)
    plates = views.table(spark, sf, "supplier").where("s_acctbal > 0").select(
        c("s_suppkey").alias("plate_id"), c("s_name").alias("plate_path")
    )
    return J.exterior_requests(rec, cls, plates, ["job_id", "stem"]).select("job_id", "stem", "plate_id", "plate_path")


_STEPS = [
    {"key": "dust", "prompt": "remove dust"},
    {"key": "glare", "prompt": None},
    {"key": "cable", "prompt": "hide cables"},
]


@query(
    "j24_step_plan",
    """SELECT job_id, stem, s.step, s.prompt FROM reviews, (VALUES ('dust', 'remove dust'), ('cable', 'hide cables')) s(step, prompt)
       WHERE output_path IS NOT NULL""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf).select("job_id", "stem", "output_path")
    return J.step_plan(r, "output_path", _STEPS).select("job_id", "stem", "step", "prompt")


@query(
    "j24_candidate_plan",
    """, n AS (SELECT n_name AS category, ['a ' || n_name, 'b ' || n_name, 'c ' || n_name] AS p FROM nation)
       SELECT category, CAST(i AS INT) AS i, p[i % 3 + 1] AS prompt, 100 + ('0x' || substr(sha256(category || '|' || i), 1, 8))::BIGINT % 2147483648 AS seed FROM n, range(8) r(i)""",
)
def _(spark, sf):
    cats = views.table(spark, sf, "nation").select(
        c("n_name").alias("category"), F.array(*[F.concat(F.lit(f"{x} "), "n_name") for x in "abc"]).alias("prompts")
    )
    return J.candidate_plan(cats, "category", "prompts", 8, 100).select("category", "i", "prompt", "seed")


# ---- set operations -------------------------------------------------------------------------------


@query(
    "u1_union_tagged",
    """SELECT slug, seq, 'aligned' AS tag FROM journal WHERE slug % 2 = 0 UNION ALL SELECT slug, seq, 'may' FROM journal WHERE slug % 2 = 1""",
    "journal",
)
def _(spark, sf):
    j = views.journal(spark, sf).select("slug", "seq")
    a = j.where("slug % 2 = 0").withColumn("tag", F.lit("aligned"))
    return a.unionByName(j.where("slug % 2 = 1").withColumn("tag", F.lit("may")))


@query(
    "u2_union_keep_first",
    """, u AS (SELECT id, 'done' AS status, 1 AS place FROM done UNION ALL SELECT id, 'pending', 0 FROM requests)
       SELECT id, arg_min(status, place) AS status FROM u GROUP BY id""",
    "requests done",
)
def _(spark, sf):
    from lumenframe.operators.sets import union_keep_first

    return union_keep_first(
        [("pending", views.requests(spark, sf).select("id")), ("done", views.done(spark, sf).select("id"))], "id"
    )


@query(
    "u3_intersect",
    "SELECT shoot, stem FROM names WHERE lower(ext) = 'dng' INTERSECT SELECT shoot, stem FROM names WHERE lower(ext) IN ('jpg', 'jpeg')",
    "names",
)
def _(spark, sf):
    n = views.names(spark, sf)
    return n.where("lower(ext) = 'dng'").select("shoot", "stem").intersect(
        n.where("lower(ext) IN ('jpg', 'jpeg')").select("shoot", "stem")
    )


@query(
    "u4_except",
    "SELECT shoot, stem FROM names WHERE lower(ext) = 'dng' EXCEPT SELECT shoot, stem FROM names WHERE lower(ext) IN ('jpg', 'jpeg')",
    "names",
)
def _(spark, sf):
    n = views.names(spark, sf)
    return n.where("lower(ext) = 'dng'").select("shoot", "stem").subtract(
        n.where("lower(ext) IN ('jpg', 'jpeg')").select("shoot", "stem")
    )


@query(
    "u5_union_labelled",
    """SELECT job_id, stem, 1 AS label FROM reviews WHERE conditions->>'$.dust' = 'true' UNION ALL
       SELECT job_id, stem, 0 FROM reviews WHERE conditions IS NULL OR conditions->>'$.dust' IS DISTINCT FROM 'true'""",
    "reviews",
)
def _(spark, sf):
    from lumenframe.functions import review as R
    from lumenframe.operators.sets import union_labelled

    r = views.reviews(spark, sf)
    pos = r.where(R.has_condition(c("conditions"), "dust")).select("job_id", "stem")
    neg = r.where(R.lacks_condition(c("conditions"), "dust")).select("job_id", "stem")
    return union_labelled({1: pos, 0: neg})
