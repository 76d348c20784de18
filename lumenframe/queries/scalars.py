"""P-queries: projections, predicates and scalar functions over the stand-in views."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import capture as C
from lumenframe.functions import color as K
from lumenframe.functions import review as R
from lumenframe.functions import vectors as V
from lumenframe.queries import views
from lumenframe.queries.base import query

c = F.col


@query(
    "p1_ev_class",
    """SELECT frame_id, CASE WHEN abs(ev) < 0.5 THEN 'mid' WHEN ev <= -1 THEN 'under' WHEN ev >= 1 THEN 'over' END AS role
       FROM frames""",
    "frames",
)
def _(spark, sf):
    return views.frames(spark, sf).select("frame_id", C.ev_class(c("ev")).alias("role"))


_EV_TEXT = """CASE k % 7 WHEN 0 THEN '+' || k || '.5' WHEN 1 THEN ' -' || k || ' ' WHEN 2 THEN '++' || k
  WHEN 3 THEN 'n/a' WHEN 4 THEN '' WHEN 5 THEN '.' || k WHEN 6 THEN k || 'e1' END"""


@query(
    "p2_parse_ev",
    f""", t AS (SELECT event_id, {_EV_TEXT} AS s FROM ev)
       SELECT event_id, TRY_CAST(trim(ltrim(trim(s), '+')) AS DOUBLE) AS ev FROM t""",
    "ev",
)
def _(spark, sf):
    return views.ev(spark, sf).select("event_id", C.parse_ev(F.expr(_EV_TEXT)).alias("ev"))


@query(
    "p3_capture_ts",
    """, t AS (SELECT event_id, CASE WHEN k % 11 = 0 THEN '0000:00:00 00:00:00'
         ELSE strftime(make_timestamp(t_us), '%Y:%m:%d %H:%M:%S') END AS dt,
         CASE WHEN k % 13 = 0 THEN 'x' || k ELSE lpad(CAST(k AS VARCHAR), 2, '0') END AS sub FROM ev)
       SELECT event_id, epoch_us(try_strptime(dt, '%Y:%m:%d %H:%M:%S')) / 1000000
         + coalesce(CASE WHEN regexp_full_match(sub, '[0-9]+') THEN CAST('0.' || sub AS DOUBLE) END, 0.0) AS t_sec FROM t""",
    "ev",
)
def _(spark, sf):
    dt = F.when(c("k") % 11 == 0, "0000:00:00 00:00:00").otherwise(
        F.date_format(F.timestamp_micros("t_us"), "yyyy:MM:dd HH:mm:ss")
    )
    sub = F.when(c("k") % 13 == 0, F.concat(F.lit("x"), c("k").cast("string"))).otherwise(
        F.lpad(c("k").cast("string"), 2, "0")
    )
    return views.ev(spark, sf).select("event_id", C.capture_seconds(dt, sub).alias("t_sec"))


@query(
    "p4_trailing_number",
    """SELECT file_no, CAST(nullif(regexp_extract(regexp_replace(stem || suffix || '.' || ext, '(?i)\\.jpe?g$', ''),
         '(\\d+)$', 1), '') AS BIGINT) AS num FROM names""",
    "names",
)
def _(spark, sf):
    name = F.concat("stem", "suffix", F.lit("."), "ext")
    return views.names(spark, sf).select("file_no", C.trailing_number(name).alias("num"))


@query(
    "p5_mid_stem",
    """SELECT file_no, regexp_replace(stem || suffix, '_stage2-(int|ext)$', '') AS mid,
         CASE suffix WHEN '_stage2-int' THEN 'int' WHEN '_stage2-ext' THEN 'ext' ELSE 'unknown' END AS route FROM names""",
    "names",
)
def _(spark, sf):
    s = F.concat("stem", "suffix")
    return views.names(spark, sf).select("file_no", C.mid_stem(s).alias("mid"), C.stage_route(s).alias("route"))


_STORED = "CASE job_id % 4 WHEN 0 THEN 'Home Drive/' || path || '/' WHEN 1 THEN '/' || path WHEN 2 THEN 'old/' || path ELSE '/' END"


@query(
    "p6_normalize_path",
    f""", t AS (SELECT job_id, {_STORED} AS p FROM jobs), u AS (SELECT job_id, p, trim(p, '/') AS b FROM t),
       v AS (SELECT *, CASE WHEN starts_with(b, 'Home Drive/') THEN substr(b, 12) ELSE b END AS n FROM u)
       SELECT job_id, CASE WHEN n = '' THEN '' ELSE '/' || n END AS path,
         CASE WHEN starts_with(ltrim(p, '/'), 'Uploads') THEN 'team:' ELSE 'store:archive/' END || ltrim(p, '/') AS remote
       FROM v""",
    "jobs",
)
def _(spark, sf):
    p = F.expr(_STORED)
    return views.jobs(spark, sf).select(
        "job_id",
        C.normalize_path(p, "Home Drive").alias("path"),
        C.storage_route(p, "Uploads", "team:", "store:archive/").alias("remote"),
    )


_RX = r"'^(\d{2}\.\d{2}\.\d{4})\s+(\d+)\s+([^()]+?)(?:\s+\(([^)]+)\))?\s*$'"


@query(
    "p7_parse_shoot_folder",
    f""", t AS (SELECT job_id, string_split(trim(path, '/'), '/') AS p FROM jobs),
       u AS (SELECT job_id, p, p[-1] AS d FROM t)
       SELECT job_id, CASE WHEN len(p) >= 2 THEN p[-2] END AS photographer,
         nullif(regexp_extract(d, {_RX}, 1), '') AS shoot_date, nullif(regexp_extract(d, {_RX}, 2), '') AS shoot_num,
         nullif(array_to_string(list_transform(string_split(trim(regexp_extract(d, {_RX}, 3)), '-'),
           lambda w: upper(w[1]) || lower(w[2:])), ' '), '') AS address,
         nullif(regexp_extract(d, {_RX}, 4), '') AS agent FROM u""",
    "jobs",
)
def _(spark, sf):
    got = C.shoot_folder(c("path"))
    return views.jobs(spark, sf).select("job_id", *[v.alias(k) for k, v in got.items()])


@query(
    "p8_compact_json",
    """SELECT job_id, stem, '{' || concat_ws(',', '"editorJobId":"' || job_id || '"', '"path":"' || output_path || '"',
         '"vendor":"' || vendor_path || '"', '"room":"' || room_worker || '"') || '}' AS body FROM reviews""",
    "reviews",
)
def _(spark, sf):
    body = R.compact_json(
        {
            "editorJobId": c("job_id"),
            "path": c("output_path"),
            "vendor": F.coalesce(c("vendor_path"), F.lit("")),
            "room": c("room_worker"),
        }
    )
    return views.reviews(spark, sf).select("job_id", "stem", body.alias("body"))


@query(
    "p9_safe_key",
    """, t AS (SELECT file_no, 'Raw Files/' || stem || suffix || ' (' || size || ').' || ext AS p FROM names),
       u AS (SELECT file_no, string_split(p, '/')[-1] AS b FROM t)
       SELECT file_no, regexp_replace(regexp_replace(lower(b), '[^a-z0-9._-]+', '_', 'g'), '\\.[^.]*$', '') AS safe,
         substr(regexp_replace(b, '[^\\p{L}\\p{N}._-]', '_', 'g'), 1, 60) AS short FROM u""",
    "names",
)
def _(spark, sf):
    p = F.format_string("Raw Files/%s%s (%s).%s", "stem", "suffix", "size", "ext")
    return views.names(spark, sf).select("file_no", C.safe_key(p).alias("safe"), C.short_name(p).alias("short"))


@query(
    "p10_clean_labels",
    """, t AS (SELECT seq, CASE WHEN label = 'signup' THEN NULL WHEN label = 'purchase' THEN 'click' ELSE label END AS l
         FROM journal WHERE label IS NOT NULL) SELECT seq, l AS label FROM t WHERE l IN ('click', 'view')""",
    "journal",
)
def _(spark, sf):
    label = R.relabel(c("label"), ["signup"], {"purchase": "click"}, ["click", "view"])
    return views.journal(spark, sf).select("seq", label.alias("label")).where("label IS NOT NULL")


@query(
    "p11_effective_flag",
    """SELECT job_id, stem FROM reviews WHERE interior_corrected OR (interior_corrected IS NULL AND interior_worker)""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf)
    return r.where(R.effective_flag(c("interior_corrected"), c("interior_worker"))).select("job_id", "stem")


@query(
    "p12_json_predicates",
    """SELECT job_id, stem, coalesce(conditions->>'$.glare' = 'true', false) AS has_glare,
         conditions IS NULL OR conditions->>'$.glare' IS DISTINCT FROM 'true' AS lacks_glare FROM reviews""",
    "reviews",
)
def _(spark, sf):
    return views.reviews(spark, sf).select(
        "job_id",
        "stem",
        R.has_condition(c("conditions"), "glare").alias("has_glare"),
        R.lacks_condition(c("conditions"), "glare").alias("lacks_glare"),
    )


@query(
    "p13_scene_predicates",
    """SELECT job_id, stem, coalesce(room_worker <> 'exterior', false) AS interior,
         conditions IS NOT NULL AND room_worker IS NULL AS exterior_proxy FROM reviews""",
    "reviews",
)
def _(spark, sf):
    return views.reviews(spark, sf).select(
        "job_id",
        "stem",
        R.is_interior_room(c("room_worker")).alias("interior"),
        R.is_exterior_proxy(c("conditions"), c("room_worker")).alias("exterior_proxy"),
    )


@query(
    "p14_presence_filter",
    """SELECT job_id, stem FROM reviews WHERE output_path IS NOT NULL AND vendor_path IS NOT NULL
         AND image_key IS NOT NULL AND output_path LIKE 'out/1%'""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf)
    keep = R.all_present(c("output_path"), c("vendor_path"), c("image_key"))
    return r.where(keep & c("output_path").startswith("out/1")).select("job_id", "stem")


@query(
    "p15_coalesce",
    """SELECT job_id, stem, coalesce(output_path, vendor_path) AS path, coalesce(room_corrected, room_worker) AS room FROM reviews""",
    "reviews",
)
def _(spark, sf):
    return views.reviews(spark, sf).select(
        "job_id",
        "stem",
        F.coalesce("output_path", "vendor_path").alias("path"),
        F.coalesce("room_corrected", "room_worker").alias("room"),
    )


_READING = "CASE k % 5 WHEN 0 THEN 'driver not loaded' WHEN 1 THEN '' WHEN 2 THEN k || '.5' ELSE CAST(k AS STRING) END"


@query(
    "p16_numeric_guard",
    f""", t AS (SELECT event_id, {_READING} AS s FROM ev)
       SELECT event_id, CASE WHEN regexp_full_match(s, '[0-9]+') THEN CAST(s AS BIGINT) END AS reading FROM t""",
    "ev",
)
def _(spark, sf):
    return views.ev(spark, sf).select("event_id", R.digits_or_null(F.expr(_READING)).alias("reading"))


_BAG = """'{"dust":' || CASE WHEN k % 3 = 0 THEN '0.' || lpad(CAST(k AS STRING), 2, '0')
  WHEN k % 3 = 1 THEN '{"confidence":0.' || lpad(CAST(k AS STRING), 2, '0') || ',"mask":"m"}' ELSE '{"mask":"n"}' END
  || ',"glare":' || CASE WHEN k % 2 = 0 THEN '1' ELSE '{"confidence":0.25}' END || '}'"""


@query(
    "p17_normalize_scores",
    f""", t AS (SELECT event_id, CAST({_BAG} AS JSON) AS j FROM ev),
       u AS (SELECT event_id, unnest(['dust', 'glare']) AS condition, j FROM t),
       v AS (SELECT event_id, condition, json_extract(j, '$.' || condition) AS m FROM u)
       SELECT event_id, condition, CASE WHEN json_type(m) = 'OBJECT' THEN coalesce(CAST(m->>'$.confidence' AS DOUBLE), 0.0)
         ELSE CAST(m AS DOUBLE) END AS confidence FROM v""",
    "ev",
)
def _(spark, sf):
    bag = R.scores_of(F.expr(_BAG))
    return views.ev(spark, sf).select("event_id", F.explode(bag).alias("condition", "confidence"))


_ANSWER = """CASE k % 6
  WHEN 0 THEN '```json\n{"detections":[{"label":"dust","score":0.' || lpad(CAST(k AS STRING), 2, '0') || ',"box":[0,0,1,1]},{"label":"spot","score":0.5,"box":[0,0,1,1]}]}\n```'
  WHEN 1 THEN 'Sure: {"detections":[{"label":"cable","score":0.25,"box":[1,2,3,4]}]} and {more'
  WHEN 2 THEN '{"detections":['
  WHEN 3 THEN 'nothing to see'
  WHEN 4 THEN '{"detections":[}' ELSE '} {"detections":[]} {"detections":[{"label":"late"}]}' END"""


@query(
    "p18_salvage_json",
    f""", t AS (SELECT event_id, {_ANSWER.replace(chr(10) + '{', "' || chr(10) || '{").replace(chr(10) + '```', "' || chr(10) || '```")} AS s FROM ev),
       u AS (SELECT event_id, regexp_extract(s, '\\{{[^{{}}]*(\\{{[^{{}}]*\\}}[^{{}}]*)*\\}}') AS o FROM t),
       v AS (SELECT event_id, CASE WHEN json_valid(o) THEN CAST(json_extract(o, '$.detections') AS JSON[]) ELSE [] END AS d FROM u),
       w AS (SELECT event_id, len(d) AS n, unnest(CASE WHEN len(d) = 0 THEN [NULL] ELSE d END) AS b FROM v)
       SELECT event_id, n, b->>'$.label' AS label, CAST(b->>'$.score' AS DOUBLE) AS score FROM w""",
    "ev",
)
def _(spark, sf):
    found = views.ev(spark, sf).select("event_id", R.salvage_detections(F.expr(_ANSWER)).alias("d"))
    return found.select("event_id", F.size("d").cast("long").alias("n"), F.explode_outer("d").alias("b")).select(
        "event_id", "n", "b.label", "b.score"
    )


_REGION = """CASE k % 4 WHEN 0 THEN 'top' WHEN 1 THEN 'middle' WHEN 2 THEN 'bottom' ELSE 'above' END || '-' ||
  CASE k % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'center' ELSE 'right' END"""


@query(
    "p19_region_to_box",
    f""", t AS (SELECT event_id, {_REGION} AS r FROM ev), g AS (SELECT * FROM (VALUES ('top', 0.0), ('middle', 0.31), ('bottom', 0.62)) a(rn, y),
         (VALUES ('left', 0.0), ('center', 0.31), ('right', 0.62)) b(cn, x))
       SELECT event_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CASE WHEN x IS NOT NULL THEN CAST(0.38 AS DOUBLE) END AS w,
         CASE WHEN x IS NOT NULL THEN CAST(0.38 AS DOUBLE) END AS h FROM t LEFT JOIN g ON r = rn || '-' || cn""",
    "ev",
)
def _(spark, sf):
    got = views.ev(spark, sf).select("event_id", R.region_box(F.expr(_REGION)).alias("b"))
    return got.select("event_id", "b.x", "b.y", "b.w", "b.h")


@query(
    "p20_softmax",
    """, t AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS a, embedding AS f FROM embeddings),
       u AS (SELECT vec_id, f, list_transform(a, lambda v: exp((v - list_max(a)) * 30)) AS e FROM t)
       SELECT vec_id, CAST(list_position(f, list_max(f)) - 1 AS BIGINT) AS top, round(1 / list_sum(e), 9) AS top_p,
         round(e[1] / list_sum(e), 9) AS first_p FROM u""",
)
def _(spark, sf):
    v = views.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", V.softmax(c("embedding").cast("array<double>"), 30.0).alias("p")
    )
    return v.select(
        "vec_id",
        V.argmax(c("embedding")).cast("long").alias("top"),
        F.round(F.array_max("p"), 9).alias("top_p"),
        F.round(c("p")[0], 9).alias("first_p"),
    )


LAB_SQL = """, lin AS (SELECT *, {lr} AS rl, {lg} AS gl, {lb} AS bl FROM {src}),
  xyz AS (SELECT *, (rl * 0.4124564::DOUBLE + gl * 0.3575761::DOUBLE + bl * 0.1804375::DOUBLE) / 0.95047::DOUBLE AS xx,
    rl * 0.2126729::DOUBLE + gl * 0.7151522::DOUBLE + bl * 0.0721750::DOUBLE AS yy,
    (rl * 0.0193339::DOUBLE + gl * 0.1191920::DOUBLE + bl * 0.9503041::DOUBLE) / 1.08883::DOUBLE AS zz FROM lin),
  lab AS (SELECT *, 116.0::DOUBLE * {fy} - 16.0::DOUBLE AS lab_l, 500.0::DOUBLE * ({fx} - {fy}) AS lab_a,
    200.0::DOUBLE * ({fy} - {fz}) AS lab_b FROM xyz)"""


def lab_sql(src: str) -> str:
    """CTE ``lab`` over a relation with 8-bit r, g, b."""

    def lin(v: str) -> str:
        return (
            f"CASE WHEN {v} / 255.0::DOUBLE <= 0.04045::DOUBLE THEN {v} / 255.0::DOUBLE / 12.92::DOUBLE "
            f"ELSE pow(({v} / 255.0::DOUBLE + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END"
        )

    def f(t: str) -> str:
        d = "(6.0::DOUBLE / 29.0::DOUBLE)"
        return (
            f"CASE WHEN {t} > {d} * {d} * {d} THEN pow({t}, 1.0::DOUBLE / 3.0::DOUBLE) "
            f"ELSE {t} / (3 * {d} * {d}) + 4.0::DOUBLE / 29.0::DOUBLE END"
        )

    return LAB_SQL.format(
        lr=lin("r"), lg=lin("g"), lb=lin("b"), src=src, fx=f"({f('xx')})", fy=f"({f('yy')})", fz=f"({f('zz')})"
    )


@query(
    "p21_color_scalars",
    lab_sql("rgb")
    + """ SELECT image, x, y, (299 * r + 587 * g + 114 * b) / 255000 AS luma601, (2126 * r + 7152 * g + 722 * b) / 2550000 AS luma709,
         greatest(r, g, b) - least(r, g, b) AS chroma,
         CASE WHEN greatest(r, g, b) = 0 THEN 0 ELSE (greatest(r, g, b) - least(r, g, b)) * 255 // greatest(r, g, b) END AS sat,
         round(lab_l, 6) AS lab_l, round(lab_a, 6) AS lab_a, round(lab_b, 6) AS lab_b FROM lab""",
    "rgb",
)
def _(spark, sf):
    r, g, b = c("r"), c("g"), c("b")
    return K.with_lab(views.rgb(spark, sf), "r", "g", "b", "lab_").select(
        "image",
        "x",
        "y",
        (K.luma601_milli(r, g, b) / 255000).alias("luma601"),
        (K.luma709_tenmilli(r, g, b) / 2550000).alias("luma709"),
        K.chroma_range(r, g, b).alias("chroma"),
        K.hsv_saturation(r, g, b).alias("sat"),
        F.round("lab_l", 6).alias("lab_l"),
        F.round("lab_a", 6).alias("lab_a"),
        F.round("lab_b", 6).alias("lab_b"),
    )


LAB8_SQL = """, lab8 AS (SELECT * EXCLUDE (lab_l, lab_a, lab_b), CAST(least(255, greatest(0, round(lab_l * 255.0::DOUBLE / 100.0::DOUBLE))) AS INT) AS l8,
    CAST(least(255, greatest(0, round(lab_a + 128.0::DOUBLE))) AS INT) AS a8, CAST(least(255, greatest(0, round(lab_b + 128.0::DOUBLE))) AS INT) AS b8 FROM lab)"""

SKY_SQL = (
    lab_sql("rgb")
    + LAB8_SQL
    + """, sky AS (SELECT image, sum(CASE WHEN b > r THEN 1 ELSE 0 END) / count(*) AS cov,
    sum(CASE WHEN b > r THEN (greatest(r, g, b) - least(r, g, b)) * 255 // greatest(r, g, b) END) / sum(CASE WHEN b > r THEN 1 END) AS s,
    sum(CASE WHEN b > r THEN a8 - 128 END) / sum(CASE WHEN b > r THEN 1 END) AS a,
    sum(CASE WHEN b > r THEN b8 - 128 END) / sum(CASE WHEN b > r THEN 1 END) AS bb FROM lab8 GROUP BY image),
  raw AS (SELECT image, cov, greatest(0.0::DOUBLE, least(1.0::DOUBLE, s / 60)) * greatest(0.0::DOUBLE, least(1.0::DOUBLE, -bb / 25)) AS blue,
    greatest(0.0::DOUBLE, least(1.0::DOUBLE, s / 60)) * greatest(0.0::DOUBLE, least(1.0::DOUBLE, (greatest(0.0::DOUBLE, a) + greatest(0.0::DOUBLE, bb)) / 30)) AS gold FROM sky),
  scored AS (SELECT image, cov >= 0.01::DOUBLE AS has_sky, round(cov, 4) AS coverage, round(blue, 3) AS blue_score, round(gold, 3) AS golden_score,
    round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - greatest(blue, gold))), 3) AS dull_score FROM raw)"""
)


def sky_frames(spark, sf):
    """Per-image sky region (bluer than red) with its scores."""
    from lumenframe.operators.evaluation import sky_frame_scores

    return sky_frame_scores(views.rgb(spark, sf), c("b") > c("r"))


@query("p22_sky_scores", SKY_SQL + " SELECT * FROM scored", "rgb")
def _(spark, sf):
    return sky_frames(spark, sf)


@query(
    "p23_health_band",
    """SELECT seq, CASE WHEN load / cores < 0.5 THEN 'green' WHEN load / cores < 1 THEN 'yellow' ELSE 'red' END AS cpu,
         CASE WHEN mem_pct < 70 THEN 'green' WHEN mem_pct < 90 THEN 'yellow' ELSE 'red' END AS mem,
         CASE WHEN mem_pct < 80 THEN 'green' WHEN mem_pct < 90 THEN 'yellow' ELSE 'red' END AS disk,
         CASE WHEN mem_pct > 80 THEN 'red' WHEN mem_pct > 70 THEN 'yellow' ELSE 'green' END AS temp FROM heartbeats""",
    "heartbeats",
)
def _(spark, sf):
    m = c("mem_pct")
    return views.heartbeats(spark, sf).select(
        "seq",
        R.band(c("load") / c("cores"), 0.5, 1.0).alias("cpu"),
        R.band(m, 70, 90).alias("mem"),
        R.band(m, 80, 90).alias("disk"),
        R.band(m, 70, 80, strict=True).alias("temp"),
    )


@query(
    "p24_format_age",
    """, t AS (SELECT event_id, event_id * 37 AS s FROM ev)
       SELECT event_id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN s // 60 || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's'
           ELSE s // 3600 || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' END AS age,
         CASE WHEN s < 3600 THEN s // 60 || 'm' WHEN s < 86400 THEN s // 3600 || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm'
           ELSE s // 86400 || 'd' || lpad(CAST(s % 86400 // 3600 AS VARCHAR), 2, '0') || 'h' END AS uptime FROM t""",
    "ev",
)
def _(spark, sf):
    s = c("event_id") * 37
    return views.ev(spark, sf).select("event_id", R.age_text(s).alias("age"), R.uptime_text(s).alias("uptime"))


@query(
    "p25_run_tag",
    """SELECT event_id, 'diff__ssim' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') || '_dino15_' ||
         CASE WHEN k % 2 = 0 THEN 'and' ELSE 'or' END || CASE WHEN k % 4 > 0 THEN '_k' || (k % 4) ELSE '' END ||
         CASE WHEN k * 10 > 200 THEN '_a' || (k * 10) ELSE '' END AS tag FROM ev""",
    "ev",
)
def _(spark, sf):
    k = c("k")
    tag = R.run_tag(
        (k + 0.5) / 100, F.lit(0.155), F.when(k % 2 == 0, "and").otherwise("or"), k % 4, k * 10
    )
    return views.ev(spark, sf).select("event_id", tag.alias("tag"))


@query(
    "p26_hash_pick",
    """SELECT seq, ('0x' || substr(sha256(CAST(job AS VARCHAR)), 1, 8))::BIGINT % 7 AS pick,
         ('0x' || substr(id, 1, 8))::BIGINT % 16 AS shard FROM requests""",
    "requests",
)
def _(spark, sf):
    return views.requests(spark, sf).select(
        "seq", R.hash_pick(c("job"), 7).alias("pick"), R.hash_shard(c("id"), 16).alias("shard")
    )


@query(
    "p27_photo_verdict",
    """SELECT image_id, CASE WHEN image_id % 17 = 0 THEN NULL WHEN truth < 5 AND confidence >= 0.6 THEN 'interior'
         WHEN confidence < 0.55 THEN 'ambiguous' WHEN pred % 2 = 0 THEN 'front' ELSE 'back' END AS verdict FROM preds""",
    "preds",
)
def _(spark, sf):
    sub = F.when(c("pred") % 2 == 0, "front").otherwise("back")
    v = R.photo_verdict(c("image_id") % 17 == 0, c("truth") < 5, c("confidence"), sub, c("confidence"))
    return views.preds(spark, sf).select("image_id", v.alias("verdict"))


@query(
    "p28_to_pixel_box",
    """SELECT image, box_id, CASE WHEN x0 % 2 = 0 THEN x0 / 64 * 640 ELSE x0 END AS x0, CASE WHEN x0 % 2 = 0 THEN y0 / 64 * 480 ELSE y0 END AS y0,
         CASE WHEN x0 % 2 = 0 THEN (x0 / 64 + (x1 - x0) / 64) * 640 ELSE x1 END AS x1,
         CASE WHEN x0 % 2 = 0 THEN (y0 / 64 + (y1 - y0) / 64) * 480 ELSE y1 END AS y1,
         CASE WHEN x0 % 2 = 0 THEN x1 / 64 * 640 ELSE x1 END AS cx1 FROM boxes""",
    "boxes",
)
def _(spark, sf):
    even = c("x0") % 2 == 0

    def part(v):
        return F.when(even, v / F.lit(64.0)).otherwise(v.cast("double"))

    x, y, bw, bh = part(c("x0")), part(c("y0")), part(c("x1") - c("x0")), part(c("y1") - c("y0"))
    ext = R.pixel_box_from_extent(x, y, bw, bh, F.lit(640.0), F.lit(480.0))
    cor = R.pixel_box_from_corners(F.array(x, y, part(c("x1")), part(c("y1"))), F.lit(640.0), F.lit(480.0))
    got = views.boxes(spark, sf).select("image", "box_id", ext.alias("e"), cor.alias("k"))
    return got.select("image", "box_id", "e.x0", "e.y0", "e.x1", "e.y1", c("k.x1").alias("cx1"))


@query(
    "p29_other_conditions",
    """SELECT job_id, stem, array_to_string(list_filter(coalesce(json_keys(conditions), []), lambda v: v <> 'dust'), ',') AS others FROM reviews""",
    "reviews",
)
def _(spark, sf):
    others = R.other_conditions(F.json_object_keys("conditions"), F.lit("dust"))
    return views.reviews(spark, sf).select("job_id", "stem", F.array_join(others, ",").alias("others"))
