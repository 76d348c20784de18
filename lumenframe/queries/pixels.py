"""A-queries on pixel tables: style statistics, gap reports, colour transfer, difference metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import pixels as X
from lumenframe.queries import views
from lumenframe.queries.base import query
from lumenframe.queries.scalars import LAB8_SQL, lab_sql

c = F.col

_D = "::DOUBLE"


def _std(s: str, q: str) -> str:
    return f"sqrt(greatest(0.0{_D}, {q}{_D} / n - ({s} / n) * ({s} / n)))"


def _ratio(s: str, floor: str) -> str:
    return f"CASE WHEN sg / (n * 255) > {floor}{_D} THEN {s} / sg ELSE {s} / (n * 255) / {floor}{_D} END"


STATS_601 = f""", s6 AS (SELECT image, count(*) AS n, sum(299 * r + 587 * g + 114 * b) AS sy, sum((299 * r + 587 * g + 114 * b)::BIGINT ** 2) AS syyf,
    sum((299 * r + 587 * g + 114 * b)::BIGINT * (299 * r + 587 * g + 114 * b)) AS syy, sum(r) AS sr, sum(g) AS sg, sum(b) AS sb,
    sum(CASE WHEN greatest(r, g, b) = 0 THEN 0 ELSE (greatest(r, g, b) - least(r, g, b)) * 255 // greatest(r, g, b) END) AS ss,
    quantile_cont(299 * r + 587 * g + 114 * b, 0.98) AS q98, quantile_cont(299 * r + 587 * g + 114 * b, 0.99) AS q99,
    count_if(299 * r + 587 * g + 114 * b > 242250) AS a95, count_if(299 * r + 587 * g + 114 * b > 252450) AS a99 FROM rgb GROUP BY image),
  stats6 AS (SELECT image, sy / (n * 255000) AS luminance, round({_std('sy', 'syy')} / 255000, 9) AS contrast, sr / (n * 255) AS r_mean,
    sg / (n * 255) AS g_mean, sb / (n * 255) AS b_mean, {_ratio('sr', '1e-6')} AS rg_ratio, {_ratio('sb', '1e-6')} AS bg_ratio,
    ss / (n * 255) AS saturation, round(q98 / 255000, 9) AS luma_p98, round(q99 / 255000, 9) AS luma_p99, a95 / n AS pct_above_95, a99 / n AS pct_above_99 FROM s6)"""
STATS_709 = f""", s7 AS (SELECT image, count(*) AS n, sum(2126 * r + 7152 * g + 722 * b) AS sy,
    sum((2126 * r + 7152 * g + 722 * b)::BIGINT * (2126 * r + 7152 * g + 722 * b)) AS syy, sum(r) AS sr, sum(g) AS sg, sum(b) AS sb,
    sum(greatest(r, g, b) - least(r, g, b)) AS sc FROM rgb GROUP BY image),
  stats7 AS (SELECT image, sy / (n * 2550000) AS luma_mean, round({_std('sy', 'syy')} / 2550000, 9) AS luma_std, sr / (n * 255) AS r_mean,
    sg / (n * 255) AS g_mean, sb / (n * 255) AS b_mean, {_ratio('sr', '1e-4')} AS rg_ratio, {_ratio('sb', '1e-4')} AS bg_ratio,
    sc / (n * 255) AS sat_mean FROM s7)"""
M6, M7 = X.METRICS_601, X.METRICS_709
PAIRS = (
    STATS_601
    + ", pairs AS (SELECT o.image // 2 AS pair, "
    + ", ".join(f"o.{m} AS ours_{m}, v.{m} AS vendor_{m}, o.{m} - v.{m} AS d_{m}" for m in M6)
    + " FROM stats6 o JOIN stats6 v ON o.image % 2 = 0 AND v.image = o.image + 1)"
)
LONG = (
    PAIRS
    + ", long AS ("
    + " UNION ALL ".join(f"SELECT pair, '{m}' AS metric, ours_{m} AS ours, vendor_{m} AS vendor, d_{m} AS delta FROM pairs" for m in M6)
    + """), summ AS (SELECT metric, round(avg(ours), 9) AS ours_mean, round(avg(vendor), 9) AS vendor_mean, round(avg(delta), 9) AS d_mean,
      round(stddev_pop(delta), 9) AS d_std, round(quantile_cont(delta, 0.5), 9) AS d_median FROM long GROUP BY metric)"""
)


def pairs601(spark, sf):
    s = X.image_stats_601(views.rgb(spark, sf)).withColumn("pair", F.floor(c("image") / 2))
    return X.paired_delta(s.where("image % 2 = 0"), s.where("image % 2 = 1"), "pair", M6)


def summary(spark, sf, with_median=True):
    return X.gap_summary(pairs601(spark, sf), "pair", M6, with_median)


@query("a1_image_stats_601", STATS_601 + " SELECT * FROM stats6", "rgb")
def _(spark, sf):
    return X.image_stats_601(views.rgb(spark, sf))


_SMALL = """, small AS (SELECT image, x // 2 AS x, y // 2 AS y, CAST((2 * sum(r) + count(*)) // (2 * count(*)) AS INT) AS r,
  CAST((2 * sum(g) + count(*)) // (2 * count(*)) AS INT) AS g, CAST((2 * sum(b) + count(*)) // (2 * count(*)) AS INT) AS b FROM rgb GROUP BY image, x // 2, y // 2)"""


@query("a1_downscaled_stats", _SMALL + STATS_601.replace("FROM rgb", "FROM small") + " SELECT * FROM stats6", "rgb")
def _(spark, sf):
    return X.image_stats_601(X.downscale(views.rgb(spark, sf), 2))


@query("a2_image_stats_709", STATS_709 + " SELECT * FROM stats7", "rgb")
def _(spark, sf):
    return X.image_stats_709(views.rgb(spark, sf))


@query("a3_paired_delta", PAIRS + " SELECT * FROM pairs", "rgb")
def _(spark, sf):
    return pairs601(spark, sf)


@query("a4_gap_summary", LONG + " SELECT * FROM summ", "rgb")
def _(spark, sf):
    return summary(spark, sf)


def _cell(m, col):
    return f"max(CASE WHEN metric = '{m}' THEN {col} END)"


@query(
    "a5_suggested_corrections",
    LONG
    + ", one AS (SELECT "
    + ", ".join(
        f"{_cell(m, s + '_mean')} AS {s}_{m}" for m in ("luminance", "contrast", "rg_ratio", "bg_ratio", "saturation") for s in ("ours", "vendor")
    )
    + """ FROM summ), e AS (SELECT *, log2(greatest(vendor_luminance, 1e-6::DOUBLE) / greatest(ours_luminance, 1e-6::DOUBLE)) AS ev FROM one)
    SELECT 'exposure' AS item, round(ev, 6) AS amount, CASE WHEN ev > 0 THEN 'brighten' ELSE 'darken' END AS advice FROM e
    UNION ALL SELECT 'contrast', round((vendor_contrast - ours_contrast) / greatest(ours_contrast, 1e-6::DOUBLE), 6), 'scale about the mean' FROM e
    UNION ALL SELECT 'wb_temp', round(vendor_rg_ratio - ours_rg_ratio, 6), CASE WHEN ours_rg_ratio > vendor_rg_ratio THEN 'cool down' ELSE 'warm up' END FROM e
    UNION ALL SELECT 'wb_tint', round(vendor_bg_ratio - ours_bg_ratio, 6), CASE WHEN ours_bg_ratio < vendor_bg_ratio THEN 'less magenta' ELSE 'less green' END FROM e
    UNION ALL SELECT 'saturation', round(vendor_saturation - ours_saturation, 6), CASE WHEN ours_saturation > vendor_saturation THEN 'desaturate' ELSE 'saturate' END FROM e""",
    "rgb",
)
def _(spark, sf):
    return X.suggested_corrections(summary(spark, sf, False))


@query(
    "a6_bias_verdict",
    LONG
    + """ SELECT metric, round(d_std / greatest(abs(d_mean), 1e-6::DOUBLE), 4) AS ratio,
      CASE WHEN d_std / greatest(abs(d_mean), 1e-6::DOUBLE) < 1.5 THEN 'constant' ELSE 'per-image' END AS verdict FROM summ""",
    "rgb",
)
def _(spark, sf):
    return X.bias_verdict(summary(spark, sf, False))


@query(
    "a7_per_group_bias",
    PAIRS
    + """ SELECT 'room-' || (pair % 7 // 2) AS room, count(*) AS n, round(avg(d_luminance), 9) AS d_luminance, round(avg(d_contrast), 9) AS d_contrast,
      round(avg(d_saturation), 9) AS d_saturation FROM pairs GROUP BY ALL HAVING count(*) >= 20""",
    "rgb",
)
def _(spark, sf):
    p = pairs601(spark, sf).withColumn("room", F.concat(F.lit("room-"), F.expr("pair % 7 DIV 2").cast("string")))
    return X.per_group_bias(p, "room", ["luminance", "contrast", "saturation"])


CONFIGS = ("ours", "rgb", "reinhard")
_DELTAS = (
    STATS_709
    + """, cf AS (SELECT * FROM (VALUES ('ours', 0), ('rgb', 1), ('reinhard', 2)) v(config, shift)),
  dl AS (SELECT v.image // 2 AS pair, config, """
    + ", ".join(f"s.{m} - v.{m} AS {m}" for m in M7)
    + """ FROM stats7 v, cf, stats7 s WHERE v.image % 2 = 1 AND s.image = v.image - 1 + 2 * shift),
  whole AS (SELECT *, sqrt("""
    + " + ".join(f"{m} * {m}" for m in M7)
    + """) AS l2 FROM dl WHERE pair IN (SELECT pair FROM dl GROUP BY pair HAVING count(*) = 3))"""
)


def config_deltas(spark, sf):
    """Three configurations against the vendor image of a pair; pairs lacking one are left out."""
    s = X.image_stats_709(views.rgb(spark, sf))
    vendor = s.where("image % 2 = 1").select(F.floor(c("image") / 2).alias("pair"), *[c(m).alias(f"v_{m}") for m in M7])
    roles = F.array(*[F.struct(F.lit(n).alias("config"), (F.floor(c("image") / 2) - i).alias("pair")) for i, n in enumerate(CONFIGS)])
    ours = s.where("image % 2 = 0").select(F.inline(roles), *M7)
    d = ours.join(vendor, "pair").select("pair", "config", *[(c(m) - c(f"v_{m}")).alias(m) for m in M7])
    whole = d.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n = 3").select("pair")
    return d.join(whole, "pair", "left_semi")


@query(
    "a8_config_gap",
    _DELTAS
    + " SELECT config, "
    + ", ".join(f"round(avg(abs({m})), 9) AS abs_{m}" for m in M7)
    + ", round(avg(l2), 9) AS l2_mean, round(quantile_cont(l2, 0.5), 9) AS l2_median FROM whole GROUP BY config",
    "rgb",
)
def _(spark, sf):
    return X.config_gap(config_deltas(spark, sf), "config", M7)


@query(
    "a9_win_rate",
    _DELTAS
    + """, b AS (SELECT pair, arg_min(config, (l2, shift)) AS config FROM whole JOIN cf USING (config) GROUP BY pair)
    SELECT cf.config, count(b.pair) AS wins, 100 * count(b.pair) / (SELECT count(*) FROM b) AS pct FROM cf LEFT JOIN b USING (config) GROUP BY cf.config""",
    "rgb",
)
def _(spark, sf):
    return X.win_rate(X.config_distances(config_deltas(spark, sf), M7), "pair", "config", CONFIGS)


@query(
    "a10_gap_by_scene",
    _DELTAS
    + """ SELECT config, round(avg(CASE WHEN pair % 3 = 0 THEN l2 END), 9) AS interior, round(avg(CASE WHEN pair % 3 <> 0 THEN l2 END), 9) AS exterior
    FROM whole GROUP BY config""",
    "rgb",
)
def _(spark, sf):
    d = X.config_distances(config_deltas(spark, sf), M7).withColumn("inside", c("pair") % 3 == 0)
    return X.gap_by_scene(d, "config", "inside")


# ---- transfer -------------------------------------------------------------------------------------

_CHANNELS = """, ch AS (SELECT image, x, y, 'r' AS channel, r AS value FROM rgb UNION ALL SELECT image, x, y, 'g', g FROM rgb UNION ALL SELECT image, x, y, 'b', b FROM rgb),
  src AS (SELECT image // 2 AS image, x, y, channel, value FROM ch WHERE image % 2 = 0),
  ref AS (SELECT image // 2 AS image, x, y, channel, value FROM ch WHERE image % 2 = 1)"""


def _src_ref(spark, sf):
    ch = X.channels(views.rgb(spark, sf))
    half = ch.withColumn("odd", c("image") % 2).withColumn("image", F.floor(c("image") / 2))
    return half.where("odd = 0").drop("odd"), half.where("odd = 1").drop("odd")


_CDF = (
    _CHANNELS
    + """, hs AS (SELECT image, channel, value, count(*) AS k FROM src GROUP BY ALL), hr AS (SELECT image, channel, value, count(*) AS k FROM ref GROUP BY ALL),
  cs AS (SELECT image, channel, value, sum(k) OVER (PARTITION BY image, channel ORDER BY value) / sum(k) OVER (PARTITION BY image, channel) AS q FROM hs),
  cr AS (SELECT image, channel, value, sum(k) OVER (PARTITION BY image, channel ORDER BY value) / sum(k) OVER (PARTITION BY image, channel) AS q FROM hr),
  nb AS (SELECT cs.image, cs.channel, cs.value, cs.q, max(cr.q) FILTER (cr.q <= cs.q) AS q0, max(cr.value) FILTER (cr.q <= cs.q) AS v0,
    min(cr.q) FILTER (cr.q > cs.q) AS q1, min(cr.value) FILTER (cr.q > cs.q) AS v1 FROM cs JOIN cr ON cs.image = cr.image AND cs.channel = cr.channel GROUP BY ALL),
  mp AS (SELECT image, channel, value, CAST(floor(round(least(255, greatest(0, CASE WHEN q0 IS NULL THEN v1 WHEN q1 IS NULL THEN v0
    ELSE v0 + (v1 - v0) * ((q - q0) / (q1 - q0)) END)), 9)) AS INT) AS mapped FROM nb)"""
)


@query("j15_match_channel_cdf", _CDF + " SELECT * FROM mp", "rgb")
def _(spark, sf):
    return X.match_channel_cdf(*_src_ref(spark, sf))


@query("j15_apply_mapping", _CDF + " SELECT image, channel, x, y, mapped FROM src JOIN mp USING (image, channel, value)", "rgb")
def _(spark, sf):
    src, ref = _src_ref(spark, sf)
    return X.apply_mapping(src, X.match_channel_cdf(src, ref)).select("image", "channel", "x", "y", "mapped")


def _moved(n: str) -> str:
    return f"""CAST(floor(round(least(255.0{_D}, greatest(0.0{_D}, CASE WHEN s.d{n} < 1e-6{_D} THEN {n}8 - s.m{n} + t.m{n}
        ELSE ({n}8 - s.m{n}) * (t.d{n} / s.d{n}) + t.m{n} END)), 9)) AS INT) AS {n}"""


def _back(t: str) -> str:
    return f"CASE WHEN {t} > 6.0{_D} / 29.0{_D} THEN {t} * {t} * {t} ELSE ({t} - 4.0{_D} / 29.0{_D}) * (3 * (6.0{_D} / 29.0{_D}) * (6.0{_D} / 29.0{_D})) END"


def _shown(v: str) -> str:
    v = f"greatest(0.0{_D}, least(1.0{_D}, {v}))"
    s = f"CASE WHEN {v} <= 0.0031308{_D} THEN {v} * 12.92{_D} ELSE pow({v}, 1.0{_D} / 2.4{_D}) * 1.055{_D} - 0.055{_D} END"
    return f"CAST(round(greatest(0.0{_D}, least(1.0{_D}, {s})) * 255.0{_D}) AS INT)"


@query(
    "a24_reinhard_transfer",
    lab_sql("rgb")
    + LAB8_SQL
    + f""", sm AS (SELECT image, {", ".join(f"sum({n}8) / count(*) AS m{n}, sqrt(greatest(0.0{_D}, sum({n}8 * {n}8){_D} / count(*) - (sum({n}8) / count(*)) * (sum({n}8) / count(*)))) AS d{n}" for n in "lab")} FROM lab8 GROUP BY image),
      mv AS (SELECT p.image // 2 AS image, x, y, {", ".join(_moved(n) for n in "lab")} FROM lab8 p JOIN sm s ON s.image = p.image JOIN sm t ON t.image = p.image + 1 WHERE p.image % 2 = 0),
      fs AS (SELECT image, x, y, (l * 100.0{_D} / 255.0{_D} + 16.0{_D}) / 116.0{_D} AS fy, a, b FROM mv),
      f3 AS (SELECT image, x, y, fy, fy + (a - 128) / 500.0{_D} AS fx, fy - (b - 128) / 200.0{_D} AS fz FROM fs),
      xyz3 AS (SELECT image, x, y, ({_back("fx")}) * 0.95047{_D} AS px, {_back("fy")} AS py, ({_back("fz")}) * 1.08883{_D} AS pz FROM f3),
      rgb3 AS (SELECT image, x, y, px * 3.2404542{_D} - py * 1.5371385{_D} - pz * 0.4985314{_D} AS lr, px * -0.9692660{_D} + py * 1.8760108{_D} + pz * 0.0415560{_D} AS lg,
        px * 0.0556434{_D} - py * 0.2040259{_D} + pz * 1.0572252{_D} AS lb FROM xyz3)
      SELECT image, x, y, {_shown("lr")} AS r, {_shown("lg")} AS g, {_shown("lb")} AS b FROM rgb3""",
    "rgb",
)
def _(spark, sf):
    p = views.rgb(spark, sf).withColumn("odd", c("image") % 2).withColumn("image", F.floor(c("image") / 2))
    return X.reinhard_transfer(p.where("odd = 0").drop("odd"), p.where("odd = 1").drop("odd"))


_LUT = """, lp AS (SELECT o.b, o.g, o.r, v.b AS tb, v.g AS tg, v.r AS tr FROM rgb o JOIN rgb v ON o.image % 2 = 0 AND v.image = o.image + 1 AND v.x = o.x AND v.y = o.y),
  fit AS (SELECT CAST(round_even(b / 255.0::DOUBLE * 32, 0) AS INT) AS i, CAST(round_even(g / 255.0::DOUBLE * 32, 0) AS INT) AS j, CAST(round_even(r / 255.0::DOUBLE * 32, 0) AS INT) AS k,
    count(*) AS n, sum(tb) / count(*) AS b, sum(tg) / count(*) AS g, sum(tr) / count(*) AS r FROM lp GROUP BY ALL)"""
_GRID = (
    _LUT
    + """, grid AS (SELECT CAST(a.i AS INT) AS i, CAST(b.j AS INT) AS j, CAST(c.k AS INT) AS k, coalesce(n, 0) AS n, coalesce(fit.b, a.i * 7.96875::DOUBLE) AS b,
    coalesce(fit.g, b.j * 7.96875::DOUBLE) AS g, coalesce(fit.r, c.k * 7.96875::DOUBLE) AS r FROM range(33) a(i), range(33) b(j), range(33) c(k) LEFT JOIN fit ON fit.i = a.i AND fit.j = b.j AND fit.k = c.k)"""
)


def lut_pairs(spark, sf):
    p = views.rgb(spark, sf)
    half = p.withColumn("odd", c("image") % 2).withColumn("pair", F.floor(c("image") / 2))
    v = half.where("odd = 1").select("pair", "x", "y", *[c(n).alias(f"t{n}") for n in "bgr"])
    return half.where("odd = 0").join(v, ["pair", "x", "y"])


@query("a25_lut_fit", _LUT + " SELECT * FROM fit", "rgb")
def _(spark, sf):
    return X.lut_fit(lut_pairs(spark, sf))


@query("a25_lut_grid", _GRID + " SELECT * FROM grid", "rgb")
def _(spark, sf):
    return X.lut_grid(X.lut_fit(lut_pairs(spark, sf)))


def _blur_sql(src: str, out: str, cols: list[str], sigma: float) -> str:
    """Three 1-D passes with mirrored edges, gathered per target cell."""
    import math

    radius = int(4 * sigma + 0.5)
    raw = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-radius, radius + 1)]
    taps = ", ".join(f"({d}, {w / sum(raw)!r}::DOUBLE)" for d, w in zip(range(-radius, radius + 1), raw))
    text = f", {out}_taps AS (SELECT * FROM (VALUES {taps}) t(d, w))"
    prev = src
    for axis in "ijk":
        at = f"t.{axis} + d"
        mirror = f"CASE WHEN {at} < 0 THEN -1 - ({at}) WHEN {at} > 32 THEN 65 - ({at}) ELSE {at} END"
        on = " AND ".join(f"s.{a} = t.{a}" for a in "ijk" if a != axis)
        step = f"{out}_{axis}"
        text += (
            f", {step} AS (SELECT t.i, t.j, t.k, {', '.join(f'sum(s.{x} * w) AS {x}' for x in cols)} FROM {prev} t, {out}_taps "
            f"JOIN {prev} s ON {on} AND s.{axis} = {mirror} GROUP BY t.i, t.j, t.k)"
        )
        prev = step
    return text + f", {out} AS (SELECT * FROM {prev})"


_FILL = (
    _GRID
    + """, msk AS (SELECT i, j, k, CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS den, CASE WHEN n > 0 THEN b ELSE 0 END AS b,
    CASE WHEN n > 0 THEN g ELSE 0 END AS g, CASE WHEN n > 0 THEN r ELSE 0 END AS r FROM grid)"""
    + _blur_sql("msk", "near", ["den", "b", "g", "r"], 1.0)
    + """, filled AS (SELECT grid.i, grid.j, grid.k, n, CASE WHEN n > 0 THEN grid.b ELSE near.b / greatest(den, 1e-6::DOUBLE) END AS b,
    CASE WHEN n > 0 THEN grid.g ELSE near.g / greatest(den, 1e-6::DOUBLE) END AS g, CASE WHEN n > 0 THEN grid.r ELSE near.r / greatest(den, 1e-6::DOUBLE) END AS r
    FROM grid JOIN near USING (i, j, k))"""
)


@query("a25_lut_fill", _FILL + " SELECT i, j, k, round(b, 6) AS b, round(g, 6) AS g, round(r, 6) AS r FROM filled", "rgb")
def _(spark, sf):
    f = X.lut_fill(X.lut_grid(X.lut_fit(lut_pairs(spark, sf))))
    return f.select("i", "j", "k", *[F.round(n, 6).alias(n) for n in "bgr"])


_SMOOTH = _FILL + _blur_sql("filled", "smooth", ["b", "g", "r"], 0.6)


@query("a25_lut_smooth", _SMOOTH + " SELECT i, j, k, round(b, 6) AS b, round(g, 6) AS g, round(r, 6) AS r FROM smooth", "rgb")
def _(spark, sf):
    f = X.lut_smooth(X.lut_fill(X.lut_grid(X.lut_fit(lut_pairs(spark, sf)))))
    return f.select("i", "j", "k", *[F.round(n, 6).alias(n) for n in "bgr"])


def _tri() -> str:
    p = {n: f"({n} / 255.0::DOUBLE * 32)" for n in "bgr"}
    base = {n: f"least(floor({p[n]}), 31)" for n in "bgr"}
    return (
        ", px AS (SELECT image, x, y, "
        + ", ".join(f"{n}, {base[n]} AS {n}0, {p[n]} - {base[n]} AS f{n}" for n in "bgr")
        + " FROM rgb), cn AS (SELECT * FROM range(2) a(db), range(2) b(dg), range(2) c(dr)), ap AS (SELECT image, x, y, "
        + ", ".join(
            f"CAST(floor(round(least(255.0::DOUBLE, greatest(0.0::DOUBLE, sum(w * grid.{n}))), 9)) AS INT) AS out_{n}" for n in "bgr"
        )
        + """ FROM (SELECT *, (CASE WHEN db = 1 THEN fb ELSE 1 - fb END) * (CASE WHEN dg = 1 THEN fg ELSE 1 - fg END) * (CASE WHEN dr = 1 THEN fr ELSE 1 - fr END) AS w
          FROM px, cn) s JOIN grid ON grid.i = b0 + db AND grid.j = g0 + dg AND grid.k = r0 + dr GROUP BY image, x, y)"""
    )


@query("a26_lut_apply", _GRID + _tri() + " SELECT * FROM ap", "rgb")
def _(spark, sf):
    lut = X.lut_grid(X.lut_fit(lut_pairs(spark, sf)))
    return X.lut_apply(views.rgb(spark, sf), lut).select("image", "x", "y", *[f"out_{n}" for n in "bgr"])


@query(
    "a27_near_white_shift",
    """, st AS (SELECT image // 3 AS frame, image % 3 + 1 AS stage, x, y, r, g, b FROM rgb WHERE image // 3 * 3 + 2 <= (SELECT max(image) FROM rgb)),
      w AS (SELECT frame, x, y FROM st WHERE stage = 1 AND least(r, g, b) > 110 AND greatest(r, g, b) - least(r, g, b) < 60 AND y >= 2),
      m AS (SELECT s.frame, s.stage, count(*) AS n, sum(b - r) / count(*) AS d FROM st s JOIN w USING (frame, x, y) GROUP BY ALL),
      q AS (SELECT f.frame, coalesce(max(n), 0) AS white_px, max(CASE WHEN stage = 1 AND n >= 10 THEN d END) AS s1, max(CASE WHEN stage = 2 AND n >= 10 THEN d END) AS s2,
        max(CASE WHEN stage = 3 AND n >= 10 THEN d END) AS s3 FROM (SELECT DISTINCT frame FROM st) f LEFT JOIN m ON m.frame = f.frame GROUP BY f.frame)
      SELECT *, s2 - s1 AS d2, s3 - s2 AS d3 FROM q""",
    "rgb",
)
def _(spark, sf):
    p = views.rgb(spark, sf)
    st = p.select(F.floor(c("image") / 3).alias("frame"), (c("image") % 3 + 1).alias("stage"), "x", "y", "r", "g", "b")
    whole = st.groupBy("frame").agg(F.count_distinct("stage").alias("k")).where("k = 3").select("frame")
    return X.near_white_shift(st.join(whole, "frame", "left_semi"), height=8, floor=110, spread=60, min_px=10)


_DIFF = lab_sql("rgb") + """, pr AS (SELECT o.image // 2 AS image, v.g > 140 AS masked, CAST(round(sqrt((o.lab_l - v.lab_l) * (o.lab_l - v.lab_l) + (o.lab_a - v.lab_a) * (o.lab_a - v.lab_a)
    + (o.lab_b - v.lab_b) * (o.lab_b - v.lab_b)) * 1000000) AS BIGINT) AS de, CAST(299 * (o.r - v.r) + 587 * (o.g - v.g) + 114 * (o.b - v.b) AS BIGINT) AS dy
    FROM lab o JOIN lab v ON o.image % 2 = 0 AND v.image = o.image + 1 AND v.x = o.x AND v.y = o.y)"""


@query(
    "a28_image_diff_metrics",
    _DIFF
    + """ SELECT image, round(sum(de) / count(*) / 1000000, 5) AS de_mean, round(coalesce(sum(CASE WHEN masked THEN de END) / nullif(count_if(masked), 0) / 1000000, 0.0::DOUBLE), 5) AS de_masked,
      round(quantile_cont(de, 0.95) / 1000000, 4) AS de_p95, round(10 * log10(65025.0::DOUBLE / greatest(sum(dy * dy)::DOUBLE / count(*) / 1000000, 1e-8::DOUBLE)), 6) AS psnr_y FROM pr GROUP BY image""",
    "rgb",
)
def _(spark, sf):
    p = lut_pairs(spark, sf).withColumn("image", c("pair")).withColumn("masked", c("tg") > 140)
    return X.image_diff_metrics(p)


def _lap_sql(src: str, v: str, key: str = "image") -> str:
    def pair(w):
        return f"coalesce(lag({v}) OVER {w}, lead({v}) OVER {w}, {v}) + coalesce(lead({v}) OVER {w}, lag({v}) OVER {w}, {v})"

    return f""", lp AS (SELECT *, {pair('h')} + {pair('d')} - 4 * {v} AS lap FROM {src} WINDOW h AS (PARTITION BY {key}, y ORDER BY x), d AS (PARTITION BY {key}, x ORDER BY y)),
      sh AS (SELECT {key}, sum(lap * lap) / count(*) - (sum(lap) / count(*)) * (sum(lap) / count(*)) AS sharpness FROM lp GROUP BY {key})"""


@query("a30_sharpness", _lap_sql("gray", "g", "image_id") + " SELECT * FROM sh", "gray")
def _(spark, sf):
    return X.sharpness(views.gray(spark, sf), "g", ["image_id"])


@query(
    "a30_sharpness_guard",
    _lap_sql("gray", "g", "image_id")
    + """ SELECT a.image_id // 2 AS pair, a.sharpness AS base, b.sharpness AS edited, CASE WHEN a.sharpness > 0 AND b.sharpness < 0.6::DOUBLE * a.sharpness THEN 'base' ELSE 'edited' END AS ship
      FROM sh a JOIN sh b ON a.image_id % 2 = 0 AND b.image_id = a.image_id + 1""",
    "gray",
)
def _(spark, sf):
    s = X.sharpness(views.gray(spark, sf), "g", ["image_id"]).withColumn("pair", F.floor(c("image_id") / 2))
    return X.sharpness_guard(s.where("image_id % 2 = 0"), s.where("image_id % 2 = 1"), "pair")


@query(
    "a28_laplacian_ratio",
    _lap_sql("gray", "g", "image_id")
    + """ SELECT a.image_id // 2 AS pair, a.sharpness / greatest(b.sharpness, 1e-8::DOUBLE) AS lap_ratio FROM sh a JOIN sh b ON a.image_id % 2 = 0 AND b.image_id = a.image_id + 1""",
    "gray",
)
def _(spark, sf):
    s = X.sharpness(views.gray(spark, sf), "g", ["image_id"]).withColumn("pair", F.floor(c("image_id") / 2))
    a = s.where("image_id % 2 = 0").select("pair", c("sharpness").alias("a"))
    b = s.where("image_id % 2 = 1").select("pair", c("sharpness").alias("b"))
    return a.join(b, "pair").select("pair", (c("a") / F.greatest(c("b"), F.lit(1e-8))).alias("lap_ratio"))


_SSIM = """, pr AS (SELECT a.image_id // 2 AS image, a.x, a.y, a.g AS a, b.g AS b FROM gray a JOIN gray b ON a.image_id % 2 = 0 AND b.image_id = a.image_id + 1 AND b.x = a.x AND b.y = a.y),
  bx AS (SELECT c.image, c.x, c.y, count(*) AS n, sum(p.a) AS sa, sum(p.b) AS sb, sum(p.a * p.a) AS saa, sum(p.b * p.b) AS sbb, sum(p.a * p.b) AS sab
    FROM pr c JOIN pr p ON p.image = c.image AND abs(p.x - c.x) <= 3 AND abs(p.y - c.y) <= 3 GROUP BY ALL),
  mo AS (SELECT *, sa / 49 AS ma, sb / 49 AS mb, (saa / 49 - (sa / 49) * (sa / 49)) * (49 / 48) AS va, (sbb / 49 - (sb / 49) * (sb / 49)) * (49 / 48) AS vb,
    (sab / 49 - (sa / 49) * (sb / 49)) * (49 / 48) AS vab FROM bx WHERE n = 49),
  sm AS (SELECT image, x, y, ((2 * ma * mb + 6.5025::DOUBLE) * (2 * vab + 58.5225::DOUBLE)) / ((ma * ma + mb * mb + 6.5025::DOUBLE) * (va + vb + 58.5225::DOUBLE)) AS ssim FROM mo)"""


def _gray_pairs(spark, sf):
    g = views.gray(spark, sf).withColumn("odd", c("image_id") % 2).withColumn("image", F.floor(c("image_id") / 2))
    b = g.where("odd = 1").select("image", "x", "y", c("g").alias("b"))
    return g.where("odd = 0").select("image", "x", "y", c("g").alias("a")).join(b, ["image", "x", "y"])


@query("a29_ssim_map", _SSIM + " SELECT image, x, y, round(ssim, 9) AS ssim FROM sm", "gray")
def _(spark, sf):
    return X.ssim_map(_gray_pairs(spark, sf)).withColumn("ssim", F.round("ssim", 9))


@query("a29_ssim_mean", _SSIM + " SELECT image, round(avg(ssim), 9) AS ssim, count_if(1 - ssim > 0.95::DOUBLE) AS changed FROM sm GROUP BY image", "gray")
def _(spark, sf):
    return X.ssim_mean(X.ssim_map(_gray_pairs(spark, sf)), 0.95)


_REFLECT = """, pr AS (SELECT a.image_id // 2 AS image, a.x, a.y, a.g AS a, b.g AS b FROM gray a JOIN gray b ON a.image_id % 2 = 0 AND b.image_id = a.image_id + 1 AND b.x = a.x AND b.y = a.y),
  w AS (SELECT image, x, y, x + dx AS px, y + dy AS py FROM pr, range(-3, 4) i(dx), range(-3, 4) j(dy)),
  rf AS (SELECT image, x, y, CASE WHEN px < 0 THEN -1 - px WHEN px > 7 THEN 15 - px ELSE px END AS px, CASE WHEN py < 0 THEN -1 - py WHEN py > 7 THEN 15 - py ELSE py END AS py FROM w),
  bx AS (SELECT rf.image, rf.x, rf.y, sum(a) AS sa, sum(b) AS sb, sum(a * a) AS saa, sum(b * b) AS sbb, sum(a * b) AS sab FROM rf JOIN pr ON pr.image = rf.image AND pr.x = rf.px AND pr.y = rf.py GROUP BY rf.image, rf.x, rf.y),
  mo AS (SELECT *, sa / 49 AS ma, sb / 49 AS mb, (saa / 49 - (sa / 49) * (sa / 49)) * (49 / 48) AS va, (sbb / 49 - (sb / 49) * (sb / 49)) * (49 / 48) AS vb,
    (sab / 49 - (sa / 49) * (sb / 49)) * (49 / 48) AS vab FROM bx),
  sm AS (SELECT image, x, y, ((2 * ma * mb + 6.5025::DOUBLE) * (2 * vab + 58.5225::DOUBLE)) / ((ma * ma + mb * mb + 6.5025::DOUBLE) * (va + vb + 58.5225::DOUBLE)) AS ssim FROM mo)"""


@query("a29_ssim_mirrored", _REFLECT + " SELECT image, x, y, round(ssim, 9) AS ssim FROM sm", "gray")
def _(spark, sf):
    return X.ssim_map(_gray_pairs(spark, sf), mirrored=True).withColumn("ssim", F.round("ssim", 9))


@query(
    "a29_pair_metrics",
    _REFLECT
    + _lap_sql("gray", "g", "image_id")
    + """, ss AS (SELECT image, round(avg(ssim), 9) AS ssim, count_if(1 - ssim > 0.95::DOUBLE) AS changed FROM sm GROUP BY image)
      SELECT image, ssim, changed, round(a.sharpness, 6) AS sharpness_a, round(b.sharpness, 6) AS sharpness_b FROM ss JOIN sh a ON a.image_id = 2 * image JOIN sh b ON b.image_id = 2 * image + 1""",
    "gray",
)
def _(spark, sf):
    got = X.pair_metrics(_gray_pairs(spark, sf), 0.95, mirrored=True)
    return got.select("image", "ssim", "changed", *[F.round(n, 6).alias(n) for n in ("sharpness_a", "sharpness_b")])
