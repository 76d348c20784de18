"""A-queries: evaluation reports, detection, roll, label statistics, operations reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import evaluation as E
from lumenframe.operators import joins as J
from lumenframe.plans.lineage import stored
from lumenframe.queries import views
from lumenframe.queries.base import query
from lumenframe.queries.joins import _LABELS, ANGLES_SQL, labelled
from lumenframe.queries.scalars import SKY_SQL, sky_frames

c = F.col

# ---- roll -----------------------------------------------------------------------------------------

_MEAN = """, mn AS (SELECT image, count(angle) AS n, sum(CASE WHEN angle IS NOT NULL THEN weight END) AS w, sum(CASE WHEN angle IS NOT NULL THEN weight * angle END) AS wa FROM an GROUP BY image),
  mean_roll AS (SELECT image, n, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE -(wa::DOUBLE / w::DOUBLE) / 1000000 END AS roll_deg FROM mn)"""
_MEDIAN = """, pt AS (SELECT image, angle, sum(weight) AS w FROM an WHERE angle IS NOT NULL GROUP BY ALL),
  rn AS (SELECT *, sum(w) OVER (PARTITION BY image ORDER BY angle) AS run, sum(w) OVER (PARTITION BY image) AS total FROM pt),
  md AS (SELECT image, min(angle) AS m FROM rn WHERE run * 2 >= total GROUP BY image),
  median_roll AS (SELECT t.image, n, coalesce({sign}m / 1000000, 0.0::DOUBLE) + 0.0::DOUBLE AS roll_deg FROM (SELECT image, count(angle) AS n FROM an GROUP BY image) t LEFT JOIN md USING (image))"""


def _angles(spark, sf):
    return J.near_vertical(views.segments(spark, sf))


@query("a15_roll_weighted_mean", ANGLES_SQL + _MEAN + " SELECT * FROM mean_roll", "segments")
def _(spark, sf):
    return E.roll_weighted_mean(_angles(spark, sf))


@query("a16_roll_weighted_median", ANGLES_SQL + _MEDIAN.format(sign="-") + " SELECT * FROM median_roll", "segments")
def _(spark, sf):
    return E.roll_weighted_median(_angles(spark, sf))


_TILT = """, fo AS (SELECT *, CASE WHEN degrees(atan2(dy, dx)) > 90 THEN degrees(atan2(dy, dx)) - 180 WHEN degrees(atan2(dy, dx)) < -90 THEN degrees(atan2(dy, dx)) + 180 ELSE degrees(atan2(dy, dx)) END AS a FROM segments),
  an AS (SELECT *, CASE WHEN abs(abs(a) - 90) <= 25 THEN CAST(round(-sign(a) * (90 - abs(a)) * 1000000) AS BIGINT) END AS angle, CAST(round(sqrt(dx * dx + dy * dy) * 1000) AS BIGINT) AS weight FROM fo)"""


@query(
    "a16_rotation_estimate",
    _TILT
    + _MEDIAN.format(sign="")
    + """, sp AS (SELECT image, count(angle) AS k, sum(angle) AS s, sum(angle::HUGEINT * angle) AS q FROM an GROUP BY image)
      SELECT image, n, roll_deg, coalesce(sqrt(greatest(0.0::DOUBLE, q::DOUBLE / k - (s / k) * (s / k))) / 1000000, 0.0::DOUBLE) AS residual_std FROM median_roll JOIN sp USING (image)""",
    "segments",
)
def _(spark, sf):
    return E.rotation_estimate(E.tilt_from_vertical(views.segments(spark, sf)))


_RESID = (
    ANGLES_SQL
    + _MEAN
    + _MEDIAN.format(sign="-")
    + """, rd AS (SELECT a.image, CASE WHEN a.n > 0 THEN round(a.roll_deg, 3) END AS cur, CASE WHEN a.n > 2 THEN round(a.roll_deg - b.roll_deg, 3) END AS sim FROM mean_roll a JOIN median_roll b USING (image))"""
)


def residuals(spark, sf):
    """Roll left by the mean estimator and by the median one, NULL where too few segments."""
    return E.roll_mean_and_median(_angles(spark, sf)).select(
        "image",
        F.when(c("n") > 0, F.round("mean_deg", 3)).alias("cur"),
        F.when(c("n") > 2, F.round(c("mean_deg") - c("median_deg"), 3)).alias("sim"),
    )


@query(
    "a13_residual_histogram",
    _RESID
    + """, bk AS (SELECT CASE WHEN abs(cur) < 0.25 THEN 0 WHEN abs(cur) < 0.5 THEN 1 WHEN abs(cur) < 1 THEN 2 WHEN abs(cur) < 2 THEN 3 ELSE 4 END AS p FROM rd WHERE cur IS NOT NULL)
      SELECT bucket, count(p) AS n FROM (VALUES (0, '0_lt_0.25'), (1, '1_0.25-0.5'), (2, '2_0.5-1.0'), (3, '3_1.0-2.0'), (4, '4_gt_2.0')) v(i, bucket) LEFT JOIN bk ON p = i GROUP BY bucket""",
    "segments",
)
def _(spark, sf):
    return E.residual_histogram(residuals(spark, sf), "cur")


@query(
    "a13_residual_summary",
    _RESID
    + """ SELECT count(cur) AS n, round(avg(abs(cur)), 6) AS mean, round(quantile_cont(abs(cur), 0.5), 6) AS median, round(quantile_cont(abs(cur), 0.95), 6) AS p95, round(max(abs(cur)), 6) AS max FROM rd""",
    "segments",
)
def _(spark, sf):
    return E.residual_summary(residuals(spark, sf), "cur")


@query(
    "a14_paired_improvement",
    _RESID
    + """, d AS (SELECT abs(cur) - abs(sim) AS d FROM rd WHERE cur IS NOT NULL AND sim IS NOT NULL)
      SELECT count(*) AS n, count_if(d > 0.05::DOUBLE) AS better, count_if(d < -0.05::DOUBLE) AS worse, count_if(d <= 0.05::DOUBLE AND d >= -0.05::DOUBLE) AS tie, round(avg(d), 6) AS mean, round(quantile_cont(d, 0.5), 6) AS median FROM d""",
    "segments",
)
def _(spark, sf):
    return E.paired_improvement(residuals(spark, sf), "cur", "sim")


# ---- sky ------------------------------------------------------------------------------------------


@query(
    "a17_shoot_sky_decision",
    SKY_SQL
    + """, us AS (SELECT image % 20 AS shoot, has_sky AND dull_score IS NOT NULL AS ok, CAST(round(coverage * 10000) AS BIGINT) AS cv, CAST(round(dull_score * 1000) AS BIGINT) AS dl, dull_score,
      CAST(round(blue_score * 1000) AS BIGINT) AS bl, CAST(round(golden_score * 1000) AS BIGINT) AS gl FROM scored),
      ag AS (SELECT shoot, count(*) AS n_frames, count_if(ok) AS n_with_sky, sum(cv * dl) FILTER (ok) / sum(cv) FILTER (ok) / 1000 AS mean, count_if(ok AND dull_score >= 0.55::DOUBLE) / nullif(count_if(ok), 0) AS share,
      quantile_cont(bl, 0.5) FILTER (ok) AS mb, quantile_cont(gl, 0.5) FILTER (ok) AS mg FROM us GROUP BY shoot)
      SELECT shoot, n_frames, n_with_sky, round(mean, 3) AS weighted_mean_dull, round(share, 3) AS frac_high_dull, floor(mb + 0.5::DOUBLE) / 1000 AS median_blue, floor(mg + 0.5::DOUBLE) / 1000 AS median_golden,
      CASE WHEN n_with_sky = 0 THEN false ELSE mean >= 0.55::DOUBLE OR share >= 0.5 END AS swap, CASE WHEN n_with_sky = 0 THEN 'no_usable_sky_in_any_frame' END AS reason FROM ag""",
    "rgb",
)
def _(spark, sf):
    return E.shoot_sky_decision(sky_frames(spark, sf).withColumn("shoot", c("image") % 20), "shoot")


# ---- classifiers ------------------------------------------------------------------------------------

_CLASSES = list(range(10))


@query(
    "a18_confusion_matrix",
    "SELECT cl AS truth, " + ", ".join(f"count_if(pred = {i}) AS p_{i}" for i in _CLASSES) + " FROM range(10) r(cl) LEFT JOIN preds ON truth = cl GROUP BY cl",
    "preds",
)
def _(spark, sf):
    return E.confusion_matrix(views.preds(spark, sf), "truth", "pred", _CLASSES)


@query(
    "a18_per_class_accuracy",
    "SELECT cl AS truth, count(truth) AS n, count_if(pred = truth) AS hit, count_if(pred = truth) / greatest(1, count(truth)) AS accuracy FROM range(10) r(cl) LEFT JOIN preds ON truth = cl GROUP BY cl",
    "preds",
)
def _(spark, sf):
    return E.per_class_accuracy(views.preds(spark, sf), "truth", "pred", _CLASSES)


@query(
    "a19_binary_prf",
    """, m AS (SELECT count(*) AS n, count_if(toxic = 1 AND quality = 1) AS tp, count_if(toxic = 1 AND quality = 0) AS fp, count_if(toxic = 0 AND quality = 1) AS fn, count_if(toxic = quality) AS hit FROM labels),
       r AS (SELECT *, tp / greatest(tp + fp, 1) AS precision, tp / greatest(tp + fn, 1) AS recall FROM m)
       SELECT tp, fp, fn, precision, recall, 2 * precision * recall / greatest(precision + recall, 1e-9::DOUBLE) AS f1, hit / greatest(n, 1) AS accuracy FROM r""",
)
def _(spark, sf):
    return E.binary_prf(views.table(spark, sf, "labels"), c("quality") == 1, c("toxic") == 1)


@query(
    "a21_label_distribution",
    _LABELS
    + """, z AS (SELECT label, count(*) AS n FROM lab WHERE label IS NOT NULL GROUP BY label UNION ALL SELECT unnest(['view', 'garage']), 0) SELECT label, CAST(sum(n) AS BIGINT) AS n FROM z GROUP BY label""",
    "journal",
)
def _(spark, sf):
    from lumenframe.operators.sampling import compact_journal

    j = compact_journal(views.journal(spark, sf), "slug", "seq", "label")
    return E.label_distribution(j, "label", ["view", "garage"])


@query("a22_class_weights_inverse", "SELECT label, count(*) AS n, 1 / count(*) AS weight FROM journal WHERE label IS NOT NULL GROUP BY label", "journal")
def _(spark, sf):
    return E.class_weights(views.journal(spark, sf).where("label IS NOT NULL"), "label")


@query(
    "a22_class_weights_sqrt",
    """, w AS (SELECT label, count(*) AS n, 1 / sqrt(count(*)) AS w FROM journal WHERE label IS NOT NULL GROUP BY label) SELECT label, n, round(w / (SELECT avg(w) FROM w), 9) AS weight FROM w""",
    "journal",
)
def _(spark, sf):
    return E.class_weights(views.journal(spark, sf).where("label IS NOT NULL"), "label", "sqrt")


@query(
    "a23_tail_duplicate",
    """, s AS (SELECT *, count(*) OVER (PARTITION BY truth) AS n FROM preds) SELECT image_id, truth, CAST(k AS INT) AS copy FROM s, range(3) r(k) WHERE k <= CASE WHEN n < 45 THEN 2 WHEN n < 52 THEN 1 ELSE 0 END""",
    "preds",
)
def _(spark, sf):
    return E.tail_duplicate(views.preds(spark, sf), "truth", 45, 52).select("image_id", "truth", "copy")


# ---- detection ----------------------------------------------------------------------------------------

_AP = """, d AS (SELECT *, row_number() OVER (PARTITION BY image, cls ORDER BY score DESC, x0 DESC, y0 DESC, x1 DESC, y1 DESC, box_id) AS i FROM boxes WHERE NOT is_truth),
  p AS (SELECT d.image, d.cls, d.i, t.box_id AS target, greatest(0, least(t.x1, d.x1) - greatest(t.x0, d.x0)) * greatest(0, least(t.y1, d.y1) - greatest(t.y0, d.y0)) AS inter,
    (t.x1 - t.x0) * (t.y1 - t.y0) + (d.x1 - d.x0) * (d.y1 - d.y0) AS areas FROM d JOIN boxes t ON t.image = d.image AND t.cls = d.cls AND t.is_truth),
  cd AS (SELECT image, cls, i, list(target ORDER BY target) AS c FROM p WHERE inter / (areas - inter) >= 0.5 GROUP BY ALL),
  co AS (SELECT *, row_number() OVER (PARTITION BY image, cls ORDER BY i) AS step FROM cd),
  walk(image, cls, step, i, used, got) AS (SELECT image, cls, 0::BIGINT, 0::BIGINT, []::VARCHAR[], NULL::VARCHAR FROM co WHERE step = 1
    UNION ALL SELECT image, cls, step, i, CASE WHEN g IS NULL THEN used ELSE list_append(used, g) END, g FROM
      (SELECT co.image, co.cls, co.step, co.i, used, list_filter(co.c, lambda q: NOT list_contains(used, q))[1] AS g FROM walk JOIN co ON co.image = walk.image AND co.cls = walk.cls AND co.step = walk.step + 1) s),
  hit AS (SELECT image, cls, i FROM walk WHERE got IS NOT NULL)"""


@query("a20_match_detections", _AP + " SELECT image, cls, box_id FROM d JOIN hit USING (image, cls, i)", "boxes")
def _(spark, sf):
    b = views.boxes(spark, sf)
    return E.match_detections(b.where("NOT is_truth"), b.where("is_truth"))


_AP2 = (
    _AP
    + """, rk AS (SELECT d.cls, h.i IS NOT NULL AS tp, row_number() OVER w AS r, count(h.i) OVER (PARTITION BY d.cls ORDER BY score DESC, d.image DESC, x0 DESC, y0 DESC, x1 DESC, y1 DESC, box_id ROWS UNBOUNDED PRECEDING) AS ct
    FROM d LEFT JOIN hit h ON h.image = d.image AND h.cls = d.cls AND h.i = d.i WINDOW w AS (PARTITION BY d.cls ORDER BY score DESC, d.image DESC, x0 DESC, y0 DESC, x1 DESC, y1 DESC, box_id)),
  np AS (SELECT cls, count(*) AS n_pos FROM boxes WHERE is_truth GROUP BY cls),
  ap AS (SELECT cls, max(n_pos) AS n_pos, count(*) AS n_det, count_if(tp) AS tp, round(coalesce(sum(CASE WHEN tp THEN ct / r END), 0.0::DOUBLE) / max(n_pos), 9) AS ap FROM rk JOIN np USING (cls) GROUP BY cls)"""
)


def _ap(spark, sf):
    b = views.boxes(spark, sf)
    return E.average_precision(b.where("NOT is_truth"), b.where("is_truth"))


@query("a20_average_precision", _AP2 + " SELECT * FROM ap", "boxes")
def _(spark, sf):
    return _ap(spark, sf)


@query("a20_mean_average_precision", _AP2 + " SELECT round(sum(ap) / 2, 9) AS map_half, round(avg(ap), 9) AS map FROM ap", "boxes")
def _(spark, sf):
    return E.mean_average_precision(_ap(spark, sf))


_FRACTION = "SELECT image, box_id, x0 / 72 AS x, y0 / 72 AS y, (x1 - x0) / 72 AS w, (y1 - y0) / 72 AS h FROM boxes"


@query(
    "a34_bbox_union",
    f""", fb AS ({_FRACTION}), hl AS (SELECT image, greatest(0.0::DOUBLE, min(x) - 0.03::DOUBLE) AS x, greatest(0.0::DOUBLE, min(y) - 0.03::DOUBLE) AS y, max(x + w) AS c, max(y + h) AS d FROM fb GROUP BY image)
       SELECT image, x, y, least(1.0::DOUBLE, c + 0.03::DOUBLE) - x AS w, least(1.0::DOUBLE, d + 0.03::DOUBLE) - y AS h FROM hl""",
    "boxes",
)
def _(spark, sf):
    b = views.boxes(spark, sf)
    f = b.select("image", (c("x0") / 72).alias("x"), (c("y0") / 72).alias("y"), ((c("x1") - c("x0")) / 72).alias("w"), ((c("y1") - c("y0")) / 72).alias("h"))
    return E.bbox_union(f, "image")


@query(
    "a35_detector_summary",
    """, dt AS (SELECT image, box_id, score, CASE cls WHEN 1 THEN 'camera' ELSE 'tripod' END AS label FROM boxes WHERE NOT is_truth AND score >= 0.5),
       s AS (SELECT image, max(score) AS m, substr(string_agg(label || ' ' || printf('%.2f', score), ', ' ORDER BY score DESC, box_id), 1, 480) AS reason FROM dt GROUP BY image)
       SELECT o.o_orderkey AS image, coalesce(m >= 0.7::DOUBLE, false) AS positive, nullif(m, 0) AS confidence, coalesce(reason, '') AS reason FROM orders o LEFT JOIN s ON s.image = o.o_orderkey""",
    "boxes",
)
def _(spark, sf):
    det = views.boxes(spark, sf).where("NOT is_truth").withColumn("label", F.when(c("cls") == 1, "camera").otherwise("tripod"))
    images = views.table(spark, sf, "orders").select(c("o_orderkey").alias("image"))
    return E.detector_summary(det, images, "image", floor=0.7)


# ---- reports --------------------------------------------------------------------------------------------

_EVAL = """SELECT vec_id % 50 + 50 AS base_global, vec_id % 50 + 49 + vec_id % 4 AS fine_global, vec_id % 90 + 60 AS base_window,
  (vec_id % 90 + 60) * 55 // 100 AS fine_window, vec_id % 30 + 20 AS base_perceptual, vec_id % 30 + 20 + vec_id % 3 AS fine_perceptual FROM embeddings"""


@query(
    "a31_eval_gate",
    f""", e AS ({_EVAL}), m AS (SELECT count(*) AS n_val, sum(base_global) AS bg, sum(fine_global) AS fg, sum(base_window) AS bw, sum(fine_window) AS fw, sum(base_perceptual) AS bp, sum(fine_perceptual) AS fp FROM e),
       d AS (SELECT *, (fg - bg) / bg * 100 AS gd, (fw - bw) / bw * 100 AS wd, (fp - bp) / bp * 100 AS pd FROM m)
       SELECT n_val, bg / n_val AS base_global_mean, fg / n_val AS fine_global_mean, bw / n_val AS base_window_mean, fw / n_val AS fine_window_mean, bp / n_val AS base_perceptual_mean, fp / n_val AS fine_perceptual_mean,
         gd AS global_delta_pct, wd AS window_delta_pct, pd AS perceptual_delta_pct, CASE WHEN wd <= -40 THEN 'PASS' ELSE 'FAIL' END AS window_gate,
         CASE WHEN abs(gd) <= 5 THEN 'PASS' ELSE 'FAIL' END AS global_gate, CASE WHEN abs(pd) <= 3 THEN 'PASS' ELSE 'FAIL' END AS perceptual_gate FROM d""",
)
def _(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id")
    v = c("vec_id")
    return E.eval_gate(
        e.select(
            (v % 50 + 50).alias("base_global"),
            (v % 50 + 49 + v % 4).alias("fine_global"),
            (v % 90 + 60).alias("base_window"),
            F.floor((v % 90 + 60) * 55 / 100).alias("fine_window"),
            (v % 30 + 20).alias("base_perceptual"),
            (v % 30 + 20 + v % 3).alias("fine_perceptual"),
        )
    )


@query(
    "a32_method_timing",
    """, t AS (SELECT event_type AS method, CAST(round(value * 100) AS BIGINT) AS ms, k % 10 <> 0 AND event_type <> 'error' AS ok FROM ev)
       SELECT method, count(*) AS n, count_if(NOT ok) AS failures, sum(ms) FILTER (ok) / nullif(count_if(ok), 0) AS mean_ms, round(quantile_cont(ms, 0.95) FILTER (ok), 6) AS p95_ms FROM t GROUP BY method""",
    "ev",
)
def _(spark, sf):
    t = views.ev(spark, sf).select(
        c("event_type").alias("method"),
        F.round(c("value") * 100).cast("long").alias("ms"),
        ((c("k") % 10 != 0) & (c("event_type") != "error")).alias("ok"),
    )
    return E.method_timing(t, "method", "ms", c("ok"))


@query(
    "a32_timing_sketches",
    """, t AS (SELECT event_type AS method, t_us // 3600000000 AS hour, CAST(round(value * 100) AS BIGINT) AS ms FROM ev WHERE k % 10 <> 0),
      h AS (SELECT method, hour, count(*) AS n FROM t GROUP BY ALL)
      SELECT method, count(*) AS hours, CAST(sum(n) AS BIGINT) AS n, true AS p50_close, true AS p95_close FROM h GROUP BY method""",
    "ev",
)
def _(spark, sf):
    # a sketch per method and hour, merged per method; the exact ranks of what the merged sketch says
    t = views.ev(spark, sf).where("k % 10 <> 0").select(
        c("event_type").alias("method"), F.floor(c("t_us") / 3_600_000_000).alias("hour"), F.round(c("value") * 100).cast("long").alias("ms")
    )
    hours = stored(E.timing_sketches(t, ["method", "hour"], "ms"), "timing-sketches")
    said = E.merged_quantiles(hours, ["method"], {"p50": 0.5, "p95": 0.95})
    said = said.join(hours.groupBy("method").agg(F.count(F.lit(1)).alias("hours")), "method")
    ranks = t.join(said, "method").groupBy("method").agg(
        F.max("hours").alias("hours"),
        F.max("n").alias("n"),
        *[(F.count_if(c("ms") < c(q)) / F.max("n")).alias(f"{q}_below") for q in ("p50", "p95")],
        *[(F.count_if(c("ms") <= c(q)) / F.max("n")).alias(f"{q}_upto") for q in ("p50", "p95")],
    )

    def close(q, p):
        return ((c(f"{q}_below") <= p + 0.03) & (c(f"{q}_upto") >= p - 0.03)).alias(f"{q}_close")

    return ranks.select("method", "hours", "n", close("p50", 0.5), close("p95", 0.95))


@query(
    "a33_run_rollup",
    """, i AS (SELECT job_id, 1 AS items, CAST(vendor_path IS NOT NULL AS INT) AS matched, CAST(image_key IS NOT NULL AS INT) AS posted, CAST(output_path IS NULL AS INT) AS failures FROM reviews)
       SELECT job_id, grouping(job_id) > 0 AS is_total, CAST(sum(items) AS BIGINT) AS items, CAST(sum(matched) AS BIGINT) AS matched, CAST(sum(posted) AS BIGINT) AS posted, CAST(sum(failures) AS BIGINT) AS failures FROM i GROUP BY ROLLUP (job_id)""",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf).select(
        "job_id",
        F.lit(1).alias("items"),
        c("vendor_path").isNotNull().cast("int").alias("matched"),
        c("image_key").isNotNull().cast("int").alias("posted"),
        c("output_path").isNull().cast("int").alias("failures"),
    )
    return E.run_rollup(r, "job_id", ["items", "matched", "posted", "failures"])


@query(
    "a38_epoch_rollup",
    "SELECT user_id AS run, t_us // 86400000000 AS epoch, count(*) AS n, round(avg(k), 6) AS k FROM ev GROUP BY ALL",
    "ev",
)
def _(spark, sf):
    e = views.ev(spark, sf).select(c("user_id").alias("run"), F.floor(c("t_us") / 86_400_000_000).alias("epoch"), "k")
    return E.epoch_rollup(e, ["run", "epoch"], ["k"])


@query(
    "a39_fleet_status",
    """, m AS (SELECT worker, array_to_string(list_sort(list_distinct(coalesce(list(service || (restarts)) FILTER (restarts = 1), []))), ',') AS healed,
         array_to_string(list_sort(list_distinct(coalesce(list(service || restarts) FILTER (service_state = 'failed' AND mem_pct > 80), []))), ',') AS failed FROM heartbeats GROUP BY worker)
       SELECT worker, CASE WHEN failed <> '' THEN 'degraded' ELSE 'ok' END AS status, healed, failed FROM m""",
    "heartbeats",
)
def _(spark, sf):
    h = views.heartbeats(spark, sf).withColumn("item", F.concat("service", c("restarts").cast("string")))
    return E.fleet_status(h, "worker", "item", c("restarts") == 1, (c("service_state") == "failed") & (c("mem_pct") > 80))


@query(
    "a40_progress_totals",
    """SELECT user_id AS job, count(*) AS processed, count_if(event_type = 'click') AS detected, count_if(event_type = 'purchase') AS repaired, count_if(event_type = 'error') AS failed FROM ev GROUP BY user_id""",
    "ev",
)
def _(spark, sf):
    return E.progress_totals(progress_of(views.ev(spark, sf)), "job", ["processed", "detected", "repaired", "failed"])


def progress_of(e):
    def one(t):
        return (c("event_type") == t).cast("long")

    return e.select(
        c("user_id").alias("job"),
        F.lit(1).cast("long").alias("processed"),
        one("click").alias("detected"),
        one("purchase").alias("repaired"),
        one("error").alias("failed"),
    )


_NOW = 1_705_276_800_000_000  # 2024-01-15 00:00 UTC


@query(
    "a41_throughput",
    f"""SELECT user_id AS worker, count_if({_NOW} - t_us >= 0 AND {_NOW} - t_us < 3600000000) AS last_hour, count_if({_NOW} - t_us >= 0 AND {_NOW} - t_us < 86400000000) AS last_day FROM ev WHERE event_type = 'purchase' GROUP BY user_id""",
    "ev",
)
def _(spark, sf):
    e = views.ev(spark, sf).where("event_type = 'purchase'").select(c("user_id").alias("worker"), "t_us")
    return E.throughput(e, "worker", "t_us", _NOW)


@query(
    "a42_distinct_jobs",
    "SELECT count(DISTINCT job_id) AS jobs, count(*) AS photos FROM reviews WHERE output_path IS NOT NULL AND vendor_path IS NOT NULL",
    "reviews",
)
def _(spark, sf):
    r = views.reviews(spark, sf).where("output_path IS NOT NULL AND vendor_path IS NOT NULL")
    return r.agg(F.count_distinct("job_id").alias("jobs"), F.count(F.lit(1)).alias("photos"))
