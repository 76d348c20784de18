"""Image metrics on pixel tables ``(image, x, y, r, g, b)`` and ``(image, x, y, g)``.

8-bit channels are summed as integers and divided once, so results do not depend on
how the pixels are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions import color as K
from lumenframe.plans.quantiles import exact_quantiles
from lumenframe.plans.tiles import box_sums, laplacian_of, over_tiles, together

# Names of the style metrics, and below the words of advice.
METRICS_601 = (
    "luminance", "contrast", "r_mean", "g_mean", "b_mean", "rg_ratio", "bg_ratio", "saturation",
    "luma_p98", "luma_p99", "pct_above_95", "pct_above_99",
)
METRICS_709 = ("luma_mean", "luma_std", "r_mean", "g_mean", "b_mean", "rg_ratio", "bg_ratio", "sat_mean")


def _ratio(top: str, g_floor: float) -> Column:
    """Mean ratio to green with a floor below the green mean (channel sums in, one division)."""
    g_mean = F.col("sg") / (F.col("n") * 255)
    return F.when(g_mean > g_floor, F.col(top) / F.nullif(F.col("sg"), F.lit(0))).otherwise(
        F.col(top) / (F.col("n") * 255) / g_floor
    )


def _spread(total: str, squares: str, n: str = "n") -> Column:
    """Population standard deviation from an exact sum and sum of squares."""
    mean = F.col(total) / F.col(n)
    return F.sqrt(F.greatest(F.lit(0.0), F.col(squares).cast("double") / F.col(n) - mean * mean))


def downscale(pixels: DataFrame, factor: int) -> DataFrame:
    """Box means over ``factor`` by ``factor`` pixels, rounded half up; partial boxes at the edges count."""
    n = F.count(F.lit(1))
    box = pixels.groupBy("image", *[F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("x", "y")])
    return box.agg(*[F.floor((2 * F.sum(c) + n) / (2 * n)).cast("int").alias(c) for c in ("r", "g", "b")])


def image_stats_601(pixels: DataFrame) -> DataFrame:
    """The twelve style metrics with BT.601 luma.

    The luma percentiles are built-in exact ones: a group holds at most 255,001 distinct lumas.
    """
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    y = K.luma601_milli(r, g, b)
    agg = pixels.groupBy("image").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("sy"),
        F.sum((y * y).cast("decimal(20,0)")).alias("syy"),
        F.sum(r).alias("sr"),
        F.sum(g).alias("sg"),
        F.sum(b).alias("sb"),
        F.sum(K.hsv_saturation(r, g, b)).alias("ss"),
        F.percentile(y, F.array(F.lit(0.98), F.lit(0.99))).alias("p"),
        F.count_if(y > 242_250).alias("a95"),
        F.count_if(y > 252_450).alias("a99"),
    )
    n = F.col("n")
    return agg.select(
        "image",
        (F.col("sy") / (n * 255_000)).alias("luminance"),
        F.round(_spread("sy", "syy") / 255_000, 9).alias("contrast"),
        (F.col("sr") / (n * 255)).alias("r_mean"),
        (F.col("sg") / (n * 255)).alias("g_mean"),
        (F.col("sb") / (n * 255)).alias("b_mean"),
        _ratio("sr", 1e-6).alias("rg_ratio"),
        _ratio("sb", 1e-6).alias("bg_ratio"),
        (F.col("ss") / (n * 255)).alias("saturation"),
        F.round(F.col("p")[0] / 255_000, 9).alias("luma_p98"),
        F.round(F.col("p")[1] / 255_000, 9).alias("luma_p99"),
        (F.col("a95") / n).alias("pct_above_95"),
        (F.col("a99") / n).alias("pct_above_99"),
    )


def image_stats_709(pixels: DataFrame) -> DataFrame:
    """The eight-number style vector with BT.709 luma and max-min saturation."""
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    y = K.luma709_tenmilli(r, g, b)
    agg = pixels.groupBy("image").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("sy"),
        F.sum((y * y).cast("decimal(20,0)")).alias("syy"),
        F.sum(r).alias("sr"),
        F.sum(g).alias("sg"),
        F.sum(b).alias("sb"),
        F.sum(K.chroma_range(r, g, b)).alias("sc"),
    )
    n = F.col("n")
    return agg.select(
        "image",
        (F.col("sy") / (n * 2_550_000)).alias("luma_mean"),
        F.round(_spread("sy", "syy") / 2_550_000, 9).alias("luma_std"),
        (F.col("sr") / (n * 255)).alias("r_mean"),
        (F.col("sg") / (n * 255)).alias("g_mean"),
        (F.col("sb") / (n * 255)).alias("b_mean"),
        _ratio("sr", 1e-4).alias("rg_ratio"),
        _ratio("sb", 1e-4).alias("bg_ratio"),
        (F.col("sc") / (n * 255)).alias("sat_mean"),
    )


def paired_delta(ours: DataFrame, vendor: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Wide pairs: ``ours_*``, ``vendor_*`` and ``d_*`` = ours - vendor."""
    a = ours.select(key, *[F.col(m).alias(f"ours_{m}") for m in metrics])
    b = vendor.select(key, *[F.col(m).alias(f"vendor_{m}") for m in metrics])
    both = a.join(b, key)
    return both.select("*", *[(F.col(f"ours_{m}") - F.col(f"vendor_{m}")).alias(f"d_{m}") for m in metrics])


def long_deltas(pairs: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """One row per pair and metric."""
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"ours_{m}").alias("ours"),
                F.col(f"vendor_{m}").alias("vendor"),
                F.col(f"d_{m}").alias("delta"),
            )
            for m in metrics
        ]
    )
    return pairs.select(key, F.inline(cells))


def gap_summary(pairs: DataFrame, key: str, metrics: Sequence[str], with_median: bool = True) -> DataFrame:
    """Means of both sides and mean, median (on request) and spread of the delta, per metric."""
    rows = long_deltas(pairs, key, metrics)
    means = rows.groupBy("metric").agg(
        F.round(F.avg("ours"), 9).alias("ours_mean"),
        F.round(F.avg("vendor"), 9).alias("vendor_mean"),
        F.round(F.avg("delta"), 9).alias("d_mean"),
        F.round(F.stddev_pop("delta"), 9).alias("d_std"),
    )
    if not with_median:
        return means
    median = exact_quantiles(rows, ["metric"], "delta", {"d_median": 0.5})
    return means.join(median.withColumn("d_median", F.round("d_median", 9)), "metric")


def suggested_corrections(summary: DataFrame) -> DataFrame:
    """Constant corrections (exposure, contrast, white balance, saturation) from a gap summary."""

    def cell(metric: str, col: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(col)))

    row = summary.agg(
        *[
            cell(m, f"{side}_mean").alias(f"{side}_{m}")
            for m in ("luminance", "contrast", "rg_ratio", "bg_ratio", "saturation")
            for side in ("ours", "vendor")
        ]
    )

    def diff(m: str) -> Column:
        return F.col(f"ours_{m}") - F.col(f"vendor_{m}")

    floor = F.lit(1e-6)
    ev = F.log2(F.greatest(F.col("vendor_luminance"), floor) / F.greatest(F.col("ours_luminance"), floor))
    items = {
        "exposure": (ev, F.when(ev > 0, "brighten").otherwise("darken")),
        "contrast": (-diff("contrast") / F.greatest(F.col("ours_contrast"), floor), F.lit("scale about the mean")),
        "wb_temp": (-diff("rg_ratio"), F.when(diff("rg_ratio") > 0, "cool down").otherwise("warm up")),
        "wb_tint": (-diff("bg_ratio"), F.when(diff("bg_ratio") < 0, "less magenta").otherwise("less green")),
        "saturation": (-diff("saturation"), F.when(diff("saturation") > 0, "desaturate").otherwise("saturate")),
    }
    cells = F.array(
        *[
            F.struct(F.lit(k).alias("item"), F.round(v, 6).alias("amount"), w.alias("advice"))
            for k, (v, w) in items.items()
        ]
    )
    return row.select(F.inline(cells))


def bias_verdict(summary: DataFrame) -> DataFrame:
    """Does a constant fix do, or does the spread per image dominate?"""
    ratio = F.col("d_std") / F.greatest(F.abs("d_mean"), F.lit(1e-6))
    return summary.select(
        "metric",
        F.round(ratio, 4).alias("ratio"),
        F.when(ratio < 1.5, "constant").otherwise("per-image").alias("verdict"),
    )


def per_group_bias(pairs: DataFrame, group: str, metrics: Sequence[str], min_n: int = 20) -> DataFrame:
    """Mean deltas of groups with enough pairs, largest group first."""
    got = pairs.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(f"d_{m}"), 9).alias(f"d_{m}") for m in metrics]
    )
    return got.where(F.col("n") >= min_n).orderBy(F.col("n").desc(), group)


def config_distances(deltas: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """L2 distance per row of a wide delta table."""
    total = F.lit(0.0)
    for m in metrics:
        total = total + F.col(m) * F.col(m)
    return deltas.withColumn("l2", F.sqrt(total))


def config_gap(deltas: DataFrame, config: str, metrics: Sequence[str]) -> DataFrame:
    """Per configuration: mean |delta| per metric, mean and median L2."""
    rows = config_distances(deltas, metrics)
    means = rows.groupBy(config).agg(
        *[F.round(F.avg(F.abs(m)), 9).alias(f"abs_{m}") for m in metrics], F.round(F.avg("l2"), 9).alias("l2_mean")
    )
    median = exact_quantiles(rows, [config], "l2", {"l2_median": 0.5})
    return means.join(median.withColumn("l2_median", F.round("l2_median", 9)), config)


def win_rate(distances: DataFrame, pair: str, config: str, configs: Sequence[str]) -> DataFrame:
    """How often each configuration comes closest; ties go to the earlier one; all are listed."""
    place = F.array_position(F.array(*[F.lit(x) for x in configs]), F.col(config))
    best = distances.groupBy(pair).agg(F.min(F.struct(F.col("l2"), place.alias("p"), F.col(config).alias("c"))).alias("b"))
    wins = best.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("b.c") == x).alias(x) for x in configs]
    )
    cells = F.array(*[F.struct(F.lit(x).alias(config), F.col(x).alias("wins")) for x in configs])
    return wins.select("n", F.inline(cells)).select(config, "wins", (F.lit(100) * F.col("wins") / F.col("n")).alias("pct"))


def gap_by_scene(distances: DataFrame, config: str, scene: str) -> DataFrame:
    """Mean L2 per configuration, interior against exterior."""
    return distances.groupBy(config).agg(
        F.round(F.avg(F.when(F.col(scene), F.col("l2"))), 9).alias("interior"),
        F.round(F.avg(F.when(~F.col(scene), F.col("l2"))), 9).alias("exterior"),
    )


# ---- transfer ---------------------------------------------------------------------------------


def channels(pixels: DataFrame, names: Sequence[str] = ("r", "g", "b")) -> DataFrame:
    """Pixels with one row per channel."""
    cells = F.array(*[F.struct(F.lit(n).alias("channel"), F.col(n).alias("value")) for n in names])
    return pixels.select("image", "x", "y", F.inline(cells))


def _cdf(values: DataFrame) -> DataFrame:
    """Cumulative share per channel value; at most 256 rows per image and channel."""
    hist = values.groupBy("image", "channel", "value").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("image", "channel")
    cum = F.sum("k").over(w.orderBy("value"))
    return hist.select("image", "channel", "value", (cum / F.sum("k").over(w)).alias("q"))


def match_channel_cdf(src: DataFrame, ref: DataFrame) -> DataFrame:
    """Mapping (image, channel, value) -> value of the reference at the same quantile.

    Linear between reference quantiles, clipped to 8 bits and truncated.  Quotients are
    rounded to 9 digits first so that exact integers survive truncation.
    """
    curve = _cdf(ref).groupBy("image", "channel").agg(
        F.array_sort(F.collect_list(F.struct("q", "value"))).alias("curve")  # 256 entries at most
    )
    at = _cdf(src).join(curve, ["image", "channel"])
    lo = F.element_at(F.filter("curve", lambda p: p["q"] <= F.col("q")), -1)
    hi = F.get(F.filter("curve", lambda p: p["q"] > F.col("q")), F.lit(0))
    at = at.withColumn("lo", F.when(F.col("q") >= F.col("curve")[0]["q"], lo)).withColumn("hi", hi)
    share = (F.col("q") - F.col("lo.q")) / (F.col("hi.q") - F.col("lo.q"))
    value = (
        F.when(F.col("lo").isNull(), F.col("hi.value").cast("double"))
        .when(F.col("hi").isNull(), F.col("lo.value").cast("double"))
        .otherwise(F.col("lo.value") + (F.col("hi.value") - F.col("lo.value")) * share)
    )
    return at.select("image", "channel", "value", to_byte(value).alias("mapped"))


def to_byte(v: Column) -> Column:
    return F.floor(F.round(F.least(F.lit(255.0), F.greatest(F.lit(0.0), v)), 9)).cast("int")


def apply_mapping(values: DataFrame, mapping: DataFrame) -> DataFrame:
    return values.join(mapping, ["image", "channel", "value"])


def reinhard_transfer(src: DataFrame, ref: DataFrame) -> DataFrame:
    """Move mean and spread of the 8-bit Lab channels to the reference's; flat channels only shift.

    ``src`` and ``ref`` have image, x, y, r, g, b; pixels stay where they are, only one row of sums
    per image moves.
    """
    names = ("__l", "__a", "__b")

    def stats(lab: DataFrame, tag: str) -> DataFrame:
        sums = [f(n) for n in names for f in (lambda n: F.sum(n).alias(f"s{n}"), lambda n: F.sum((F.col(n) * F.col(n)).cast("long")).alias(f"q{n}"))]
        agg = lab.groupBy("image").agg(F.count(F.lit(1)).alias("n"), *sums)
        means = [(F.col(f"s{n}") / F.col("n")).alias(f"{tag}_m{n}") for n in names]
        return agg.select("image", *means, *[_spread(f"s{n}", f"q{n}").alias(f"{tag}_s{n}") for n in names])

    lab = K.with_lab8(src, "r", "g", "b", "__")
    both = stats(lab, "src").join(stats(K.with_lab8(ref, "r", "g", "b", "__"), "ref"), "image")
    rows = lab.join(both, "image")

    def moved(n: str) -> Column:
        centred = F.col(n) - F.col(f"src_m{n}")
        flat = F.col(f"src_s{n}") < 1e-6
        return F.when(flat, centred + F.col(f"ref_m{n}")).otherwise(centred * (F.col(f"ref_s{n}") / F.col(f"src_s{n}")) + F.col(f"ref_m{n}"))

    out = rows.select("image", "x", "y", *[to_byte(moved(n)).alias(n) for n in names])
    return K.with_rgb(out, "__")


LUT_SIZE = 33


def lut_fit(pairs: DataFrame, size: int = LUT_SIZE) -> DataFrame:
    """Observed cells of a colour cube: mean target per bin of the source colour.

    ``pairs`` has b, g, r (source) and tb, tg, tr (target), all 8-bit.
    """

    def cell(c: str) -> Column:
        return F.bround(F.col(c) / F.lit(255.0) * (size - 1), 0).cast("int")

    return pairs.groupBy(cell("b").alias("i"), cell("g").alias("j"), cell("r").alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        *[(F.sum(f"t{c}") / F.count(F.lit(1))).alias(c) for c in "bgr"],
    )


def lut_grid(fit: DataFrame, size: int = LUT_SIZE) -> DataFrame:
    """The whole cube (size**3 rows): fitted cells, and the identity where nothing was seen."""
    spark = fit.sparkSession
    ids = spark.range(size**3)
    step = 255.0 / (size - 1)
    grid = ids.select(
        F.floor(F.col("id") / (size * size)).cast("int").alias("i"),
        (F.floor(F.col("id") / size) % size).cast("int").alias("j"),
        (F.col("id") % size).cast("int").alias("k"),
    )
    both = grid.join(fit, ["i", "j", "k"], "left")
    return both.select(
        "i",
        "j",
        "k",
        F.coalesce("n", F.lit(0)).alias("n"),
        *[F.coalesce(F.col(c), F.col(axis) * step).alias(c) for axis, c in zip("ijk", "bgr")],
    )


def _blur_axis(cube: DataFrame, axis: str, cols: Sequence[str], sigma: float, size: int) -> DataFrame:
    """One pass of a Gaussian along an axis, mirrored at the edges; at most 9 rows per cell."""
    import math

    radius = int(4 * sigma + 0.5)
    raw = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-radius, radius + 1)]
    taps = F.array(
        *[F.struct(F.lit(d).alias("d"), F.lit(w / sum(raw)).alias("w")) for d, w in zip(range(-radius, radius + 1), raw)]
    )
    # a cell and its mirror images below (-1 - cell) and above (2 * size - 1 - cell) the cube
    # each give to the target at image - d
    images = F.array(F.col(axis), -1 - F.col(axis), 2 * size - 1 - F.col(axis))
    spread = cube.select("*", F.inline(taps))
    targets = F.filter(F.transform(images, lambda at: at - F.col("d")), lambda t: t.between(0, size - 1))
    parts = spread.withColumn("__t", F.explode(targets))
    others = [c for c in "ijk" if c != axis]
    return parts.groupBy(F.col("__t").cast("int").alias(axis), *others).agg(
        *[F.sum(F.col(c) * F.col("w")).alias(c) for c in cols]
    )


def _blur(cube: DataFrame, cols: Sequence[str], sigma: float, size: int) -> DataFrame:
    out = cube.select("i", "j", "k", *cols)
    for axis in "ijk":
        out = _blur_axis(out, axis, cols, sigma, size)
    return out


def lut_fill(grid: DataFrame, sigma: float = 1.0, size: int = LUT_SIZE) -> DataFrame:
    """Unseen cells borrow from seen neighbours: blurred values over blurred presence."""
    seen = F.col("n") > 0
    masked = grid.select(
        "i", "j", "k", F.when(seen, 1.0).otherwise(0.0).alias("den"), *[F.when(seen, F.col(c)).otherwise(0.0).alias(c) for c in "bgr"]
    )
    near = _blur(masked, ["den", "b", "g", "r"], sigma, size).select(
        "i", "j", "k", *[(F.col(c) / F.greatest(F.col("den"), F.lit(1e-6))).alias(f"__{c}") for c in "bgr"]
    )
    both = grid.join(near, ["i", "j", "k"])
    return both.select("i", "j", "k", "n", *[F.when(seen, F.col(c)).otherwise(F.col(f"__{c}")).alias(c) for c in "bgr"])


def lut_smooth(grid: DataFrame, sigma: float = 0.6, size: int = LUT_SIZE) -> DataFrame:
    out = _blur(grid, ["b", "g", "r"], sigma, size)
    return out.select("i", "j", "k", *[F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.col(c))).alias(c) for c in "bgr"])


def lut_apply(pixels: DataFrame, lut: DataFrame, size: int = LUT_SIZE) -> DataFrame:
    """Trilinear lookup.  Only distinct colours are looked up; the cube has size**3 rows."""
    colours = pixels.select("b", "g", "r").distinct()
    pos = {c: F.col(c) / F.lit(255.0) * (size - 1) for c in "bgr"}
    base = {c: F.least(F.floor(pos[c]), F.lit(size - 2)) for c in "bgr"}
    frac = {c: pos[c] - base[c] for c in "bgr"}

    def corner(db: int, dg: int, dr: int) -> Column:
        w = F.lit(1.0)
        for c, d in zip("bgr", (db, dg, dr)):
            w = w * (frac[c] if d else 1 - frac[c])
        return F.struct(
            (base["b"] + db).cast("int").alias("i"),
            (base["g"] + dg).cast("int").alias("j"),
            (base["r"] + dr).cast("int").alias("k"),
            w.alias("w"),
        )

    eight = F.array(*[corner(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)])
    spread = colours.select("b", "g", "r", F.inline(eight))
    cube = lut.select("i", "j", "k", *[F.col(c).alias(f"o{c}") for c in "bgr"])
    mapped = (
        spread.join(F.broadcast(cube), ["i", "j", "k"])
        .groupBy("b", "g", "r")
        .agg(*[to_byte(F.sum(F.col("w") * F.col(f"o{c}"))).alias(f"out_{c}") for c in "bgr"])
    )
    return pixels.join(mapped, ["b", "g", "r"])


# ---- comparison ---------------------------------------------------------------------------------


def near_white_shift(
    stages: DataFrame, height: int, floor: int = 175, spread: int = 28, top: float = 0.30, min_px: int = 50
) -> DataFrame:
    """Mean B-R per stage on pixels that are near white in stage 1, below the top band.

    ``stages`` has frame, stage, x, y, r, g, b.  One aggregate carries the stage-1 pixel to
    the other stages of the same spot, so nothing is joined.
    """
    spot = stages.groupBy("frame", "x", "y").agg(
        *[F.max(F.when(F.col("stage") == s, F.struct("r", "g", "b"))).alias(f"p{s}") for s in (1, 2, 3)]
    )
    lo, hi = F.least("p1.r", "p1.g", "p1.b"), F.greatest("p1.r", "p1.g", "p1.b")
    white = (lo > floor) & (hi - lo < spread) & (F.col("y") >= int(height * top))
    n = F.count_if(white)

    def shift(s: int) -> Column:
        return F.when(n >= min_px, F.sum(F.when(white, F.col(f"p{s}.b") - F.col(f"p{s}.r"))) / F.nullif(n, F.lit(0)))

    got = spot.groupBy("frame").agg(n.alias("white_px"), *[shift(s).alias(f"s{s}") for s in (1, 2, 3)])
    return got.select("*", (F.col("s2") - F.col("s1")).alias("d2"), (F.col("s3") - F.col("s2")).alias("d3"))


def laplacian(plane: DataFrame, value: str, keys: Sequence[str] = ("image",)) -> DataFrame:
    """``keys``, ``x``, ``y``, ``lap``: the 4-neighbour Laplacian, mirrored at the border."""
    return over_tiles(plane, keys, [value], laplacian_of(value), {"lap": "double"}, 1)


def sharpness(plane: DataFrame, value: str, keys: Sequence[str] = ("image",)) -> DataFrame:
    """Variance of the Laplacian from exact integer sums."""
    lap = F.col("lap").cast("long")
    agg = laplacian(plane, value, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(lap).alias("s"), F.sum(lap * lap).alias("q")
    )
    mean = F.col("s") / F.col("n")
    return agg.select(*keys, (F.col("q") / F.col("n") - mean * mean).alias("sharpness"))


def sharpness_guard(base: DataFrame, out: DataFrame, key: str, keep: float = 0.6) -> DataFrame:
    """Ship the base frame when the edited one lost too much sharpness."""
    both = base.select(key, F.col("sharpness").alias("base")).join(out.select(key, F.col("sharpness").alias("edited")), key)
    worse = (F.col("base") > 0) & (F.col("edited") < keep * F.col("base"))
    return both.withColumn("ship", F.when(worse, "base").otherwise("edited"))


def image_diff_metrics(pairs: DataFrame) -> DataFrame:
    """Lab difference (mean, p95, masked mean) and PSNR of luma, per image.

    ``pairs`` has image, x, y, r, g, b, tr, tg, tb and a boolean ``masked``.  Differences are
    kept in millionths, which makes every sum exact.
    """
    lab = K.with_lab(K.with_lab(pairs, "r", "g", "b", "__a"), "tr", "tg", "tb", "__t")
    gap = F.lit(0.0)
    for axis in "lab":
        gap = gap + F.pow(F.col(f"__a{axis}") - F.col(f"__t{axis}"), F.lit(2))
    y = K.luma601_milli(F.col("r"), F.col("g"), F.col("b")) - K.luma601_milli(F.col("tr"), F.col("tg"), F.col("tb"))
    rows = lab.select(
        "image", "masked", F.round(F.sqrt(gap) * 1_000_000).cast("long").alias("de"), (y * y).cast("decimal(20,0)").alias("yy")
    )
    agg = rows.groupBy("image").agg(
        (F.sum("de") / F.count(F.lit(1)) / 1_000_000).alias("de_mean"),
        F.coalesce(F.sum(F.when(F.col("masked"), F.col("de"))) / F.nullif(F.count_if("masked"), F.lit(0)) / 1_000_000, F.lit(0.0)).alias("de_masked"),
        (F.sum("yy").cast("double") / F.count(F.lit(1)) / 1_000_000).alias("mse"),
    )
    p95 = exact_quantiles(rows, ["image"], "de", {"p95": 0.95})
    return agg.join(p95, "image").select(
        "image",
        F.round("de_mean", 5).alias("de_mean"),
        F.round("de_masked", 5).alias("de_masked"),
        F.round(F.col("p95") / 1_000_000, 4).alias("de_p95"),
        F.round(10 * F.log10(F.lit(65025.0) / F.greatest(F.col("mse"), F.lit(1e-8))), 6).alias("psnr_y"),
    )


_SUMS = dict.fromkeys(("sa", "sb", "saa", "sbb", "sab"), "bigint")


def _similarity(win: int) -> Column:
    area = win * win
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    norm = area / (area - 1)
    ma, mb = F.col("sa") / area, F.col("sb") / area
    va = (F.col("saa") / area - ma * ma) * norm
    vb = (F.col("sbb") / area - mb * mb) * norm
    vab = (F.col("sab") / area - ma * mb) * norm
    top = (2 * ma * mb + c1) * (2 * vab + c2)
    bottom = (ma * ma + mb * mb + c1) * (va + vb + c2)
    return top / bottom


def ssim_map(pairs: DataFrame, win: int = 7, keys: Sequence[str] = ("image",), mirrored: bool = False) -> DataFrame:
    """Structural similarity of two grey planes ``a`` and ``b``, from exact window sums.

    Border pixels, whose window would leave the image, are left out; with ``mirrored`` the image is
    reflected about its edges (the edge pixel repeated) and every pixel is reported.
    """
    sums = over_tiles(pairs, keys, ["a", "b"], box_sums("a", "b", win, mirrored), _SUMS, win // 2)
    return sums.where("sa IS NOT NULL").select(*keys, "x", "y", _similarity(win).alias("ssim"))


def pair_metrics(pairs: DataFrame, threshold: float, win: int = 7, keys: Sequence[str] = ("image",), mirrored: bool = False) -> DataFrame:
    """``keys``, ``ssim``, ``changed`` and the sharpness of both planes, from one pass over the tiles of both."""
    names = {"a": "lap_a", "b": "lap_b"}
    laps = [lambda dense, there, v=v, n=n: {n: laplacian_of(v)(dense, there)["lap"]} for v, n in names.items()]
    outputs = {**_SUMS, "lap_a": "double", "lap_b": "double"}
    got = over_tiles(pairs, keys, ["a", "b"], together(box_sums("a", "b", win, mirrored), *laps), outputs, win // 2)
    got = got.withColumn("__s", F.when(F.col("sa").isNotNull(), _similarity(win)))

    def spread(lap: str) -> Column:
        v = F.col(lap).cast("long")
        mean = F.sum(v) / F.count(F.lit(1))
        return F.sum(v * v) / F.count(F.lit(1)) - mean * mean

    return got.groupBy(*keys).agg(
        F.round(F.avg("__s"), 9).alias("ssim"), F.count_if(1 - F.col("__s") > threshold).alias("changed"),
        spread("lap_a").alias("sharpness_a"), spread("lap_b").alias("sharpness_b"),
    )


def ssim_mean(ssim: DataFrame, threshold: float, keys: Sequence[str] = ("image",)) -> DataFrame:
    """Mean similarity and number of changed pixels (1 - ssim above the threshold)."""
    return ssim.groupBy(*keys).agg(
        F.round(F.avg("ssim"), 9).alias("ssim"), F.count_if(1 - F.col("ssim") > threshold).alias("changed")
    )
