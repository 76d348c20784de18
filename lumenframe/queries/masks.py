"""M-queries and the joins and aggregates on masks and feature vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import evaluation as E
from lumenframe.operators import masks as M
from lumenframe.operators import similarity as Y
from lumenframe.queries import views
from lumenframe.queries.base import query

c = F.col

_SE = "dsk AS (SELECT dx, dy FROM range(-{r}, {r} + 1) a(dx), range(-{r}, {r} + 1) b(dy) WHERE dx * dx + dy * dy <= {r} * {r})"


def _dilate(src: str, out: str, se: str = "dsk") -> str:
    return f""", {out} AS (SELECT DISTINCT image_id, x + dx AS x, y + dy AS y FROM {src}, {se} WHERE x + dx BETWEEN 0 AND 7 AND y + dy BETWEEN 0 AND 7)"""


def _erode(src: str, out: str, se: str = "dsk") -> str:
    return f""", {out} AS (SELECT image_id, x, y FROM gray g WHERE NOT EXISTS (SELECT 1 FROM {se} WHERE g.x + dx BETWEEN 0 AND 7 AND g.y + dy BETWEEN 0 AND 7
      AND (g.image_id, g.x + dx, g.y + dy) NOT IN (SELECT (image_id, x, y) FROM {src})))"""


@query(
    "m1_threshold_mask",
    """SELECT image_id, x, y, 'above' AS kind FROM gray WHERE g > 127 UNION ALL SELECT image_id, x, y, 'from' FROM gray WHERE g >= 150 UNION ALL SELECT image_id, x, y, 'any' FROM gray WHERE g > 0""",
    "gray",
)
def _(spark, sf):
    g = views.gray(spark, sf)
    above = M.threshold_mask(g, "g", 127).withColumn("kind", F.lit("above"))
    start = M.threshold_mask(g, "g", 150, strict=False).withColumn("kind", F.lit("from"))
    return above.unionByName(start).unionByName(M.threshold_mask(g, "g").withColumn("kind", F.lit("any")))


_OPENED = ", " + _SE.format(r=1) + _erode("masks", "er") + _dilate("er", "op")


@query("m2_morph_open", _OPENED + " SELECT * FROM op", "masks")
def _(spark, sf):
    return M.morph_open_close(views.masks(spark, sf), views.dims(spark, sf), 1, 0)


_CLOSED = ", " + _SE.format(r=2) + _dilate("masks", "di") + _erode("di", "cl")


@query("m2_morph_close", _CLOSED + " SELECT * FROM cl", "masks")
def _(spark, sf):
    return M.morph_open_close(views.masks(spark, sf), views.dims(spark, sf), 0, 2)


# labels start as pixel numbers and take the smallest number around until 64 steps are over
_CC = """, px AS (SELECT image_id, x, y, y * 8 + x AS p FROM masks),
  reach(image_id, p, q) AS (SELECT image_id, p, p FROM px UNION SELECT r.image_id, r.p, n.p FROM reach r JOIN px c ON c.image_id = r.image_id AND c.p = r.q
    JOIN px n ON n.image_id = r.image_id AND abs(n.x - c.x) + abs(n.y - c.y) = 1),
  cc AS (SELECT px.image_id, x, y, lab AS component FROM px JOIN (SELECT image_id, p, min(q) AS lab FROM reach GROUP BY ALL) l USING (image_id, p))"""


def components(spark, sf):
    """Components named by row and column of their first pixel, as one number."""
    return M.connected_components(views.masks(spark, sf))


def _number(df):
    """Component names in 8-pixel rows, to compare with the twin."""
    return df.withColumn(
        "component", F.shiftright("component", 24) * 8 + c("component").bitwiseAND(F.lit((1 << 24) - 1).cast("long"))
    )


@query("m3_connected_components", _CC + " SELECT image_id, x, y, component FROM cc", "masks")
def _(spark, sf):
    return _number(components(spark, sf))


@query(
    "m3_keep_components",
    _CC
    + """, ar AS (SELECT image_id, component, count(*) AS a FROM cc GROUP BY ALL HAVING count(*) >= 3), rk AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY a DESC, component DESC) AS r FROM ar)
      SELECT image_id, x, y FROM cc JOIN rk USING (image_id, component) WHERE r <= 2""",
    "masks",
)
def _(spark, sf):
    return M.keep_components(components(spark, sf), 3, 2)


@query(
    "m4_drop_bright_components",
    _CC
    + """, br AS (SELECT image_id, component FROM cc JOIN gray USING (image_id, x, y) GROUP BY ALL HAVING sum(g * 10000) < count(*) * 165 * 10000)
      SELECT image_id, x, y FROM cc JOIN br USING (image_id, component)""",
    "masks gray",
)
def _(spark, sf):
    g = views.gray(spark, sf).select("image_id", "x", "y", c("g").alias("r"), "g", c("g").alias("b"))
    return M.drop_bright_components(components(spark, sf), g, 165)


@query(
    "m5_grid_majority",
    "SELECT image_id, x // 2 AS gx, y // 2 AS gy FROM masks GROUP BY ALL HAVING count(*) > 2",
    "masks",
)
def _(spark, sf):
    return M.grid_majority(views.masks(spark, sf), views.dims(spark, sf), 4)


_RESIZE = "SELECT image_id, CAST(tx AS INT) AS x, CAST(ty AS INT) AS y FROM {src} JOIN range({w}) a(tx) ON (2 * tx + 1) * {sw} // (2 * {w}) = x JOIN range({h}) b(ty) ON (2 * ty + 1) * {sh} // (2 * {h}) = y"


@query("m6_resize_nearest_up", _RESIZE.format(src="masks", w=20, h=12, sw=8, sh=8), "masks")
def _(spark, sf):
    return M.resize_nearest(views.masks(spark, sf), views.dims(spark, sf), 20, 12)


@query("m6_resize_nearest_down", _RESIZE.format(src="masks", w=5, h=3, sw=8, sh=8), "masks")
def _(spark, sf):
    return M.resize_nearest(views.masks(spark, sf), views.dims(spark, sf), 5, 3)


_PATCH = """, pa AS (SELECT a.vec_id // 32 AS image_id, CAST(a.vec_id // 2 % 4 AS INT) AS x, CAST(a.vec_id // 8 % 4 AS INT) AS y, a.embedding AS u, b.embedding AS v
    FROM embeddings a JOIN embeddings b ON a.vec_id % 2 = 0 AND b.vec_id = a.vec_id + 1),
  ch AS (SELECT image_id, x, y FROM pa WHERE 1 - list_cosine_similarity(u::DOUBLE[], v::DOUBLE[]) > 0.95::DOUBLE)"""


def changed_patches(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "embedding")
    half = e.withColumn("pair", F.floor(c("vec_id") / 2))
    b = half.where("vec_id % 2 = 1").select("pair", c("embedding").alias("v"))
    p = half.where("vec_id % 2 = 0").join(b, "pair").select(
        F.expr("vec_id DIV 32").alias("image_id"),
        F.expr("CAST(vec_id DIV 2 % 4 AS INT)").alias("x"),
        F.expr("CAST(vec_id DIV 8 % 4 AS INT)").alias("y"),
        c("embedding").alias("u"),
        "v",
    )
    return Y.patch_change_mask(p, "u", "v", 0.95)


@query("m7_patch_change_mask", _PATCH + " " + _RESIZE.format(src="ch", w=8, h=8, sw=4, sh=4))
def _(spark, sf):
    ch = changed_patches(spark, sf)
    grid = ch.select("image_id").distinct().select("image_id", F.lit(4).alias("w"), F.lit(4).alias("h"))
    return M.resize_nearest(ch, grid, 8, 8)


def _raster(kind: str) -> str:
    f = "round_even({}, 0)" if kind == "rounded" else "floor({})"

    def px(v):
        return f"greatest(0, least(16, CAST({f.format(f'({v}) * 16')} AS INT)))"

    return f""", fb AS (SELECT image AS image_id, x0 / 72 AS bx, y0 / 72 AS bby, (x1 - x0) / 72 AS bw, (y1 - y0) / 72 AS bh FROM boxes WHERE NOT is_truth),
      cr AS (SELECT image_id, {px('bx')} AS x0, {px('bx + bw')} AS x1, {px('bby')} AS y0, {px('bby + bh')} AS y1 FROM fb)
      SELECT DISTINCT image_id, CAST(x AS INT) AS x, CAST(y AS INT) AS y FROM cr, range(16) a(x), range(16) b(y) WHERE x >= x0 AND x < x1 AND y >= y0 AND y < y1"""


def _rasterized(spark, sf, rounded):
    b = views.boxes(spark, sf).where("NOT is_truth")
    f = b.select(
        c("image").alias("image_id"),
        (c("x0") / 72).alias("x"),
        (c("y0") / 72).alias("y"),
        ((c("x1") - c("x0")) / 72).alias("w"),
        ((c("y1") - c("y0")) / 72).alias("h"),
    )
    d = views.table(spark, sf, "orders").select(c("o_orderkey").alias("image_id"), F.lit(16).alias("w"), F.lit(16).alias("h"))
    return M.rasterize_boxes(f, d, rounded)


@query("m8_rasterize_boxes_rounded", _raster("rounded"), "boxes")
def _(spark, sf):
    return _rasterized(spark, sf, True)


@query("m8_rasterize_boxes_truncated", _raster("truncated"), "boxes")
def _(spark, sf):
    return _rasterized(spark, sf, False)


_ADAPT = """, ex AS (SELECT image_id, greatest(3, least(5, CAST(floor(0.5::DOUBLE * least(max(x) - min(x) + 1, max(y) - min(y) + 1)) AS INT))) | 1 AS k FROM masks GROUP BY image_id),
  ds AS (SELECT image_id, dx, dy FROM ex, range(-2, 3) a(dx), range(-2, 3) b(dy) WHERE abs(dy) <= k // 2 AND abs(dx) <= round(sqrt((k // 2) * (k // 2) - dy * dy))),
  di AS (SELECT DISTINCT m.image_id, x + dx AS x, y + dy AS y FROM masks m JOIN ds USING (image_id) WHERE x + dx BETWEEN 0 AND 7 AND y + dy BETWEEN 0 AND 7),
  cl AS (SELECT image_id, x, y FROM gray g WHERE image_id IN (SELECT image_id FROM ex) AND NOT EXISTS (SELECT 1 FROM ds WHERE ds.image_id = g.image_id AND g.x + dx BETWEEN 0 AND 7 AND g.y + dy BETWEEN 0 AND 7
    AND (g.image_id, g.x + dx, g.y + dy) NOT IN (SELECT (image_id, x, y) FROM di)))"""


@query("m9_adaptive_close", _ADAPT + " SELECT * FROM cl", "masks")
def _(spark, sf):
    return M.adaptive_close(views.masks(spark, sf), views.dims(spark, sf), 0.5, 3, 5)


_AB = """, a AS (SELECT image_id // 2 AS image_id, x, y FROM masks WHERE image_id % 2 = 0), b AS (SELECT image_id // 2 AS image_id, x, y FROM masks WHERE image_id % 2 = 1)"""


def _ab(spark, sf):
    m = views.masks(spark, sf).withColumn("odd", c("image_id") % 2).withColumn("image_id", F.floor(c("image_id") / 2))
    return m.where("odd = 0").drop("odd"), m.where("odd = 1").drop("odd")


@query(
    "u6_combine_masks",
    _AB
    + """ SELECT *, 'and' AS mode FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT *, 'or' FROM (SELECT * FROM a UNION SELECT * FROM b)
      UNION ALL SELECT *, 'only_a' FROM a UNION ALL SELECT *, 'only_b' FROM b""",
    "masks",
)
def _(spark, sf):
    a, b = _ab(spark, sf)
    parts = [M.combine_masks(a, b, m).withColumn("mode", F.lit(m)) for m in ("and", "or", "only_a", "only_b")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_IOU = (
    _AB
    + """, im AS (SELECT DISTINCT vec_id // 2 AS image_id FROM embeddings),
  px AS (SELECT image_id, x, y, max(t) AS t, max(p) AS p FROM (SELECT *, 1 AS t, 0 AS p FROM a UNION ALL SELECT *, 0, 1 FROM b) GROUP BY ALL),
  iou AS (SELECT im.image_id, CASE WHEN count(px.x) = 0 THEN 1.0::DOUBLE ELSE sum(t * p) / count(px.x) END AS iou FROM im LEFT JOIN px USING (image_id) GROUP BY im.image_id)"""
).replace("max(t) AS t, max(p) AS p FROM", "max(t) AS t, max(p) AS p FROM")
_IOU = _IOU.replace("GROUP BY ALL),\n  iou", "GROUP BY image_id, x, y),\n  iou")


def _ious(spark, sf):
    a, b = _ab(spark, sf)
    images = views.dims(spark, sf).select(F.floor(c("image_id") / 2).alias("image_id")).distinct()
    return M.mask_iou(a, b, images)


@query("a11_mask_iou", _IOU + " SELECT * FROM iou", "masks")
def _(spark, sf):
    return _ious(spark, sf)


@query(
    "a12_iou_by_model",
    _IOU + " SELECT image_id % 3 AS version, count(*) AS n, round(avg(iou), 9) AS mean, max(iou) AS max, round(quantile_cont(iou, 0.5), 9) AS median FROM iou GROUP BY ALL",
    "masks",
)
def _(spark, sf):
    return E.iou_by_model(_ious(spark, sf).withColumn("version", c("image_id") % 3), "version")


@query(
    "j14_truth_against_predictions",
    """, ti AS (SELECT DISTINCT vec_id // 4 AS image_id FROM embeddings WHERE vec_id % 4 = 0 AND vec_id % 28 <> 0),
      t AS (SELECT image_id // 4 AS image_id, x, y FROM masks WHERE image_id % 4 = 0),
      rw AS (SELECT vec_id // 4 AS image_id, 'v' || (vec_id % 4) AS version, vec_id % 9 <> 0 AS has_mask FROM embeddings WHERE vec_id % 4 <> 0 AND vec_id % 11 <> 0),
      p AS (SELECT image_id // 4 AS image_id, 'v' || (image_id % 4) AS version, x, y FROM masks WHERE image_id % 4 <> 0),
      sc AS (SELECT * FROM rw WHERE image_id IN (SELECT image_id FROM ti)),
      px AS (SELECT image_id, version, x, y, max(t) AS t, max(p) AS p FROM (SELECT sc.image_id, version, x, y, 1 AS t, 0 AS p FROM t JOIN sc USING (image_id)
        UNION ALL SELECT image_id, version, x, y, 0, 1 FROM p JOIN sc USING (image_id, version) WHERE has_mask) GROUP BY image_id, version, x, y)
      SELECT sc.image_id, sc.version, CASE WHEN count(px.x) = 0 THEN 1.0::DOUBLE ELSE sum(t * p) / count(px.x) END AS iou FROM sc LEFT JOIN px USING (image_id, version) GROUP BY ALL""",
    "masks",
)
def _(spark, sf):
    m = views.masks(spark, sf).withColumn("v", c("image_id") % 4).withColumn("image_id", F.floor(c("image_id") / 4))
    ids = views.dims(spark, sf).select(c("image_id").alias("vec_id"))
    quarter = F.floor(c("vec_id") / 4).alias("image_id")
    version = F.concat(F.lit("v"), (c("vec_id") % 4).cast("string")).alias("version")
    truth_images = ids.where("vec_id % 4 = 0 AND vec_id % 28 <> 0").select(quarter).distinct()
    rows = ids.where("vec_id % 4 <> 0 AND vec_id % 11 <> 0").select(quarter, version, (c("vec_id") % 9 != 0).alias("has_mask"))
    masks = m.where("v <> 0").select("image_id", F.concat(F.lit("v"), c("v").cast("string")).alias("version"), "x", "y")
    return M.truth_against_predictions(truth_images, m.where("v = 0").select("image_id", "x", "y"), rows, masks)


@query(
    "a36_mask_area",
    "SELECT d.image_id, count(m.x) AS area, 100 * count(m.x) / 64 AS pct FROM dims d LEFT JOIN masks m USING (image_id) GROUP BY d.image_id",
    "masks dims",
)
def _(spark, sf):
    return M.mask_area(views.masks(spark, sf), views.dims(spark, sf))


@query(
    "a36_mask_roi",
    """, bx AS (SELECT image_id, min(x) AS x0, max(x) + 1 AS x1, min(y) AS y0, max(y) + 1 AS y1 FROM masks GROUP BY image_id),
      pd AS (SELECT d.image_id, bx.* EXCLUDE (image_id), greatest(1, CAST(floor(0.5::DOUBLE * greatest(x1 - x0, y1 - y0)) AS INT)) AS pad FROM dims d LEFT JOIN bx USING (image_id))
      SELECT image_id, CASE WHEN x0 IS NULL THEN 0 ELSE CAST(greatest(0, floor((x0 - pad) / 2) * 2) AS INT) END AS x0, CASE WHEN x0 IS NULL THEN 0 ELSE CAST(greatest(0, floor((y0 - pad) / 2) * 2) AS INT) END AS y0,
        CASE WHEN x0 IS NULL THEN 8 ELSE CAST(least(8, ceil((x1 + pad) / 2) * 2) AS INT) END AS x1, CASE WHEN x0 IS NULL THEN 8 ELSE CAST(least(8, ceil((y1 + pad) / 2) * 2) AS INT) END AS y1 FROM pd""",
    "masks dims",
)
def _(spark, sf):
    return M.mask_roi(views.masks(spark, sf), views.dims(spark, sf), 1, 0.5, 2)


_KNN = """, qy AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), ps AS (SELECT vec_id AS pid, embedding::DOUBLE[] AS e FROM embeddings WHERE label = 3 AND vec_id % 2 = 0), ng AS (SELECT vec_id AS pid, embedding::DOUBLE[] AS e FROM embeddings WHERE label = 7),
  sp AS (SELECT vec_id, list_cosine_similarity(qy.e, ps.e) AS s, row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(qy.e, ps.e) DESC) AS r FROM qy, ps),
  sn AS (SELECT vec_id, list_cosine_similarity(qy.e, ng.e) AS s, row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(qy.e, ng.e) DESC) AS r FROM qy, ng)"""


def _banks(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return e, e.where("label = 3 AND vec_id % 2 = 0"), e.where("label = 7")


@query("j16_topk_mean", _KNN + " SELECT vec_id, round(avg(s), 9) AS score FROM sp WHERE r <= 5 GROUP BY vec_id")
def _(spark, sf):
    e, pos, _neg = _banks(spark, sf)
    return Y.topk_mean(e, pos, "vec_id", "embedding", 5).withColumn("score", F.round("score", 9))


@query(
    "j16_knn_score",
    _KNN + " SELECT vec_id, round(p - n, 9) AS score FROM (SELECT vec_id, avg(s) AS p FROM sp WHERE r <= 5 GROUP BY vec_id) JOIN (SELECT vec_id, avg(s) AS n FROM sn WHERE r <= 3 GROUP BY vec_id) USING (vec_id)",
)
def _(spark, sf):
    return Y.knn_score(*_banks(spark, sf), "vec_id", "embedding", 5, 3).withColumn("score", F.round("score", 9))


@query(
    "a37_zero_shot_label",
    """, pr AS (SELECT label, embedding::DOUBLE[] AS e FROM embeddings WHERE label < 3 AND vec_id % 5 = 0), im AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
      sc AS (SELECT vec_id, label, avg(list_cosine_similarity(im.e, pr.e)) AS s FROM im, pr GROUP BY ALL), mx AS (SELECT vec_id, max(s) AS m, arg_max(label, (s, -label)) AS top FROM sc GROUP BY vec_id),
      p AS (SELECT vec_id, any_value(top) AS top, 1 / sum(exp((s - m) * 30)) AS conf FROM sc JOIN mx USING (vec_id) GROUP BY vec_id)
      SELECT vec_id, CASE WHEN conf >= 0.55::DOUBLE THEN top END AS label, round(conf, 9) AS confidence FROM p""",
)
def _(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    got = Y.zero_shot_label(e, e.where("label < 3 AND vec_id % 5 = 0"), "vec_id", "embedding")
    return got.withColumn("confidence", F.round("confidence", 9))
