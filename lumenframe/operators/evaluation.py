"""Scores and evaluation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, GroupedData
from pyspark.sql import functions as F

from lumenframe.functions import color as K
from lumenframe.operators.joins import box_pairs
from lumenframe.plans.lineage import stored
from lumenframe.plans.matching import greedy_match
from lumenframe.plans.ordered import number_slot, prior, total_of, with_total
from lumenframe.plans.quantiles import exact_quantiles


def sky_frame_scores(pixels: DataFrame, is_sky: Column, min_coverage: float = 0.01) -> DataFrame:
    """Coverage and sky scores of every image; scores are NULL without sky pixels.

    Means of 8-bit HSV saturation and of 8-bit Lab a and b over the sky; sums stay integer and are
    divided once.  ``has_sky`` tests the coverage before it is rounded.
    """
    rows = K.with_lab8(pixels.withColumn("__sky", is_sky), "r", "g", "b", "__")
    n = F.count_if("__sky")

    def mean(v: Column) -> Column:
        return F.sum(F.when(F.col("__sky"), v)) / F.nullif(n, F.lit(0))

    sky = rows.groupBy("image").agg(
        (n / F.count(F.lit(1))).alias("cov"),
        mean(K.hsv_saturation(F.col("r"), F.col("g"), F.col("b"))).alias("s"),
        mean(F.col("__a") - 128).alias("a"),
        mean(F.col("__b") - 128).alias("b"),
    )
    scores = K.sky_scores(F.col("s"), F.col("a"), F.col("b"))
    seen = F.col("cov") >= min_coverage
    return sky.select("image", seen.alias("has_sky"), F.round("cov", 4).alias("coverage"), *[v.alias(k) for k, v in scores.items()])


#: Fixed value: the reason given for a shoot without sky.
NO_SKY = "no_usable_sky_in_any_frame"


def shoot_sky_decision(frames: DataFrame, shoot: str, threshold: float = 0.55) -> DataFrame:
    """Should the sky of a shoot be replaced?

    Coverages and scores carry 4 and 3 decimals, so they are summed as integers.  Medians run
    over at most 1,001 distinct values per shoot.
    """
    usable = F.col("has_sky") & F.col("dull_score").isNotNull()
    cov = F.when(usable, F.round(F.col("coverage") * 10_000).cast("long"))

    def milli(c: str) -> Column:
        return F.when(usable, F.round(F.col(c) * 1000).cast("long"))

    agg = frames.groupBy(shoot).agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.count_if(usable).alias("n_with_sky"),
        F.sum(cov).alias("w"),
        F.sum(cov * milli("dull_score")).alias("ws"),
        F.count_if(usable & (F.col("dull_score") >= threshold)).alias("high"),
        F.percentile(milli("blue_score"), 0.5).alias("mb"),
        F.percentile(milli("golden_score"), 0.5).alias("mg"),
    )
    mean = F.col("ws") / F.col("w") / 1000
    share = F.col("high") / F.nullif(F.col("n_with_sky"), F.lit(0))
    none = F.col("n_with_sky") == 0
    return agg.select(
        shoot,
        "n_frames",
        "n_with_sky",
        F.round(mean, 3).alias("weighted_mean_dull"),
        F.round(share, 3).alias("frac_high_dull"),
        (F.floor(F.col("mb") + 0.5) / 1000).alias("median_blue"),
        (F.floor(F.col("mg") + 0.5) / 1000).alias("median_golden"),
        F.when(none, False).otherwise((mean >= threshold) | (share >= 0.5)).alias("swap"),
        F.when(none, NO_SKY).alias("reason"),
    )


# ---- roll of images ----------------------------------------------------------------------------


def roll_weighted_mean(angles: DataFrame) -> DataFrame:
    """Negated length-weighted mean of the near-vertical angles; 0 without any."""
    w = F.when(F.col("angle").isNotNull(), F.col("weight").cast("decimal(20,0)"))
    agg = angles.groupBy("image").agg(
        F.count("angle").alias("n"), F.sum(w).alias("w"), F.sum(w * F.col("angle").cast("decimal(12,0)")).alias("wa")
    )
    mean = -(F.col("wa").cast("double") / F.col("w").cast("double")) / 1_000_000
    return agg.select("image", "n", F.when(F.col("n") == 0, 0.0).otherwise(mean).alias("roll_deg"))


_SLOT = 10_000_000  # ten degrees


def _roll_points(angles: DataFrame) -> DataFrame:
    """Equal angles of an image merged and written once: ``image``, ``angle`` (NULL: none), ``n``, ``w``, ``slot``."""
    points = angles.groupBy("image", "angle").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    return stored(points.withColumn("slot", number_slot("angle", _SLOT)), "roll-points")


def _roll_median(points: DataFrame, *sums: Column) -> DataFrame:
    """``image``, ``n``, ``m`` (first angle at which the running length reaches half of the total), and sums over points.

    A row per image and slot of ten degrees tells in which slot that is, and only its points are sorted.
    """
    used = F.when(F.col("angle").isNotNull(), F.col("n"))
    names = [f"__s{i}" for i in range(len(sums))]
    slots = points.groupBy("image", "slot").agg(
        F.coalesce(F.sum(used), F.lit(0)).alias("n"), F.sum(F.when(F.col("angle").isNotNull(), F.col("w"))).alias("w"), *[x.alias(k) for x, k in zip(sums, names)]
    )
    cell = F.when(F.col("w").isNotNull(), F.struct("slot", "w"))
    heads = slots.groupBy("image").agg(
        F.sum("n").alias("n"), F.sum("w").alias("total"), F.array_sort(F.collect_list(cell)).alias("cells"), *[F.sum(k).alias(k) for k in names]
    )
    # the slots are at most a few dozen: those that end below half of the length lie before the wanted one
    start = F.struct(F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("slot"))

    def step(s, c):
        run = s["run"] + c["w"]
        hit = s["slot"].isNull() & (run * 2 >= F.col("total"))
        return F.struct(run.alias("run"), F.when(hit, s["run"]).otherwise(s["before"]).alias("before"), F.when(hit, c["slot"]).otherwise(s["slot"]).alias("slot"))

    heads = heads.withColumn("__at", F.aggregate("cells", start, step)).drop("cells")
    heads = heads.select("image", "n", "total", *names, F.col("__at.before").alias("before"), F.col("__at.slot").alias("slot"))
    inside = points.where("angle IS NOT NULL").select("image", "slot", "angle", "w")
    run = F.sum("w").over(Window.partitionBy("image", "slot").orderBy("angle").rowsBetween(Window.unboundedPreceding, 0))
    rows = heads.join(inside, ["image", "slot"], "left").withColumn("__run", F.col("before") + F.coalesce(run, F.lit(0)))
    first = F.min(F.when(F.col("__run") * 2 >= F.col("total"), F.col("angle"))).alias("m")
    return rows.groupBy("image", "slot").agg(F.first("n").alias("n"), first, *[F.first(k).alias(k) for k in names]).drop("slot")


def _degrees(sign: int) -> Column:
    return F.coalesce(sign * F.col("m") / 1_000_000, F.lit(0.0)) + 0.0


def roll_weighted_median(angles: DataFrame, negate: bool = True) -> DataFrame:
    """First angle at which the running length reaches half of the total.

    Equal angles are merged first, in a written table, and the running sum goes in slots of ten degrees.
    """
    return _roll_median(_roll_points(angles)).select("image", "n", _degrees(-1 if negate else 1).alias("roll_deg"))


def roll_mean_and_median(angles: DataFrame) -> DataFrame:
    """``image``, ``n``, ``mean_deg``, ``median_deg``: both estimators from one pass over the angles."""
    w = F.when(F.col("angle").isNotNull(), F.col("w").cast("decimal(20,0)"))
    got = _roll_median(_roll_points(angles), F.sum(w), F.sum(w * F.col("angle").cast("decimal(12,0)")))
    mean = -F.try_divide(F.col("__s1").cast("double"), F.col("__s0").cast("double")) / 1_000_000
    return got.select("image", "n", F.when(F.col("n") == 0, 0.0).otherwise(mean).alias("mean_deg"), _degrees(-1).alias("median_deg"))


def tilt_from_vertical(segments: DataFrame, window_deg: float = 25.0) -> DataFrame:
    """Production form: angles folded to +-90, tilt positive when rotated one way, window inclusive."""
    a = F.degrees(F.atan2("dy", "dx"))
    a = F.when(a > 90, a - 180).when(a < -90, a + 180).otherwise(a)
    tilt = -F.signum(a) * (90 - F.abs(a))
    length = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
    near = F.abs(F.abs(a) - 90) <= window_deg
    return segments.withColumn("angle", F.when(near, F.round(tilt * 1_000_000).cast("long"))).withColumn(
        "weight", F.round(length * 1000).cast("long")
    )


def rotation_estimate(tilts: DataFrame) -> DataFrame:
    """Weighted median tilt, segments used, spread of the tilts."""
    t, n = F.col("angle").cast("decimal(12,0)"), F.col("n")
    got = _roll_median(_roll_points(tilts), F.sum(n * F.col("angle")), F.sum(t * t * n.cast("decimal(12,0)")))
    mean = F.col("__s0") / F.col("n")
    var = F.greatest(F.lit(0.0), F.col("__s1").cast("double") / F.col("n") - mean * mean)
    std = F.coalesce(F.sqrt(var) / 1_000_000, F.lit(0.0))
    return got.select("image", "n", _degrees(1).alias("roll_deg"), F.when(F.col("n") == 0, 0.0).otherwise(std).alias("residual_std"))


#: Names of the buckets.
RESIDUAL_BUCKETS = ("0_lt_0.25", "1_0.25-0.5", "2_0.5-1.0", "3_1.0-2.0", "4_gt_2.0")


def residual_histogram(rows: DataFrame, value: str) -> DataFrame:
    """Counts of |value| in five buckets, zero buckets included."""
    v = F.abs(value)
    edges = (0.25, 0.5, 1.0, 2.0)
    place = F.when(v < edges[0], 0).when(v < edges[1], 1).when(v < edges[2], 2).when(v < edges[3], 3).otherwise(4)
    one = rows.where(F.col(value).isNotNull()).agg(*[F.count_if(place == i).alias(f"c{i}") for i in range(5)])
    cells = F.array(*[F.struct(F.lit(b).alias("bucket"), F.col(f"c{i}").alias("n")) for i, b in enumerate(RESIDUAL_BUCKETS)])
    return one.select(F.inline(cells))


def residual_summary(rows: DataFrame, value: str) -> DataFrame:
    """One row: n, mean, median, p95 and max of |value|."""
    abs_rows = rows.where(F.col(value).isNotNull()).select(F.abs(value).alias("v"))
    base = total_of(
        abs_rows, F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.max("v"), 6).alias("max")
    )
    q = exact_quantiles(abs_rows, [], "v", {"median": 0.5, "p95": 0.95})
    return with_total(q, base).select("n", "mean", F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"), "max")


def paired_improvement(rows: DataFrame, current: str, other: str, tie: float = 0.05) -> DataFrame:
    """One row: how often |other| beats |current|; rows lacking either are left out."""
    both = rows.where(F.col(current).isNotNull() & F.col(other).isNotNull())
    d = stored(both.select((F.abs(current) - F.abs(other)).alias("d")), "improvements")  # read by the counts and the median
    base = total_of(
        d,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("d") > tie).alias("better"),
        F.count_if(F.col("d") < -tie).alias("worse"),
        F.round(F.avg("d"), 6).alias("mean"),
    )
    q = exact_quantiles(d, [], "d", {"median": 0.5})
    return with_total(q, base).select(
        "n", "better", "worse", (F.col("n") - F.col("better") - F.col("worse")).alias("tie"), "mean", F.round("median", 6).alias("median")
    )


# ---- classifiers -------------------------------------------------------------------------------


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes: Sequence) -> DataFrame:
    """Rows are true classes, columns ``p_<class>``; every class is present on both sides."""
    counts = df.groupBy(truth).agg(*[F.count_if(F.col(pred) == c).alias(f"p_{c}") for c in classes])
    one = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias(truth))
    return one.join(counts, truth, "left").fillna(0)


def per_class_accuracy(df: DataFrame, truth: str, pred: str, classes: Sequence) -> DataFrame:
    counts = df.groupBy(truth).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth) == F.col(pred)).alias("hit"))
    one = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias(truth))
    got = one.join(counts, truth, "left").fillna(0)
    return got.withColumn("accuracy", F.col("hit") / F.greatest(F.lit(1), F.col("n")))


def binary_prf(df: DataFrame | GroupedData, truth: Column, pred: Column) -> DataFrame:
    """One row (or one per group): tp, fp, fn, precision, recall, F1, accuracy."""
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(pred & truth).alias("tp"),
        F.count_if(pred & ~truth).alias("fp"),
        F.count_if(~pred & truth).alias("fn"),
        F.count_if(pred == truth).alias("hit"),
    )
    p = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    r = F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    keys = [c for c in one.columns if c not in ("n", "tp", "fp", "fn", "hit")]
    return one.select(
        *keys,
        "tp",
        "fp",
        "fn",
        p.alias("precision"),
        r.alias("recall"),
        (2 * p * r / F.greatest(p + r, F.lit(1e-9))).alias("f1"),
        (F.col("hit") / F.greatest(F.col("n"), F.lit(1))).alias("accuracy"),
    )


def label_distribution(df: DataFrame, label: str, listed: Sequence[str] = ()) -> DataFrame:
    """Counts per label; listed labels appear even with none."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    if not listed:
        return counts
    zero = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in listed])).alias(label))
    zero = zero.withColumn("n", F.lit(0).cast("long"))
    return counts.unionByName(zero).groupBy(label).agg(F.sum("n").alias("n"))


def class_weights(df: DataFrame, label: str, kind: str = "inverse") -> DataFrame:
    """``inverse`` 1/n, or ``sqrt``: 1/sqrt(n) scaled to mean one over the classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    if kind == "inverse":
        return counts.withColumn("weight", 1 / F.col("n"))
    raw = counts.withColumn("__w", 1 / F.sqrt("n"))
    return with_total(raw, total_of(raw, F.avg("__w").alias("__m"))).select(
        label, "n", F.round(F.col("__w") / F.col("__m"), 9).alias("weight")
    )


def tail_duplicate(df: DataFrame, label: str, below3: int = 350, below2: int = 800) -> DataFrame:
    """Rows of rare classes appear two or three times; copies are numbered from 1."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    times = F.when(F.col("__n") < below3, 2).when(F.col("__n") < below2, 1).otherwise(0)
    return df.join(sizes, label).withColumn("copy", F.explode(F.sequence(F.lit(0), times))).drop("__n")


# ---- detection ------------------------------------------------------------------------------------


def match_detections(detections: DataFrame, truth: DataFrame, min_iou: float = 0.5) -> DataFrame:
    """(image, cls, box_id) of detections that win a truth box.

    In score order every detection takes the first free truth box it overlaps enough, settled
    in distributed rounds.
    """
    pairs = box_pairs(detections, truth, ["image", "cls"], min_iou)
    order = F.struct(
        (-F.col("a_score")).alias("s"), (-F.col("a_x0")).alias("a"), (-F.col("a_y0")).alias("b"),
        (-F.col("a_x1")).alias("c"), (-F.col("a_y1")).alias("d"), F.col("a_box_id").alias("e"),
    )
    cands = pairs.select("image", "cls", order.alias("rank"), F.col("a_box_id").alias("box_id"), F.col("b_box_id").alias("target"))
    return greedy_match(cands, ["image", "cls"], "rank", "box_id", "target").select("image", "cls", "box_id")


def average_precision(detections: DataFrame, truth: DataFrame) -> DataFrame:
    """AP at IoU 0.5 per class: sum of precision at every hit over the number of truth boxes.

    Detections are ranked over all images of a class by (score, image, box) descending; scores
    carry four decimals.  A class without truth boxes has AP NaN.
    """
    det = detections.withColumn("score", F.round("score", 4))
    hits = match_detections(det, truth).withColumn("hit", F.lit(1).cast("long"))
    rows = det.join(hits, ["image", "cls", "box_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(0).cast("long")))
    slot = F.struct((-F.col("score")).alias("s"), (-F.floor(F.col("image") / 65_536)).alias("i"))
    order = [-F.col(c) for c in ("score", "image", "x0", "y0", "x1", "y1")] + [F.col("box_id")]
    run = prior(rows, ["cls"], slot, order, {"seen": ("sum", F.lit(1).cast("long")), "hits": ("sum", F.col("hit"))})
    precision = (F.col("hits") + 1) / (F.col("seen") + 1)
    found = run.groupBy("cls").agg(F.count(F.lit(1)).alias("n_det"), F.sum("hit").alias("tp"), F.sum(F.when(F.col("hit") == 1, precision)).alias("p"))
    npos = truth.groupBy("cls").agg(F.count(F.lit(1)).alias("n_pos"))
    both = npos.join(found, "cls", "full_outer")
    ap = F.when(F.col("n_pos").isNull(), F.lit(float("nan"))).otherwise(F.round(F.coalesce("p", F.lit(0.0)) / F.col("n_pos"), 9))
    return both.select(
        "cls", F.coalesce("n_pos", F.lit(0)).alias("n_pos"), F.coalesce("n_det", F.lit(0)).alias("n_det"), F.coalesce("tp", F.lit(0)).alias("tp"), ap.alias("ap")
    )


def mean_average_precision(ap: DataFrame) -> DataFrame:
    """``map_half`` divides by two whatever classes exist; ``map`` by the classes that have an AP."""
    ok = F.when(~F.isnan("ap"), F.col("ap"))
    return ap.agg(F.round(F.coalesce(F.sum(ok), F.lit(0.0)) / 2, 9).alias("map_half"), F.round(F.avg(ok), 9).alias("map"))


def bbox_union(boxes: DataFrame, key: str, pad: float = 0.03) -> DataFrame:
    """Padded and clamped hull of the fractional boxes of an image."""
    hull = boxes.groupBy(key).agg(
        F.min("x").alias("a"), F.min("y").alias("b"), F.max(F.col("x") + F.col("w")).alias("c"), F.max(F.col("y") + F.col("h")).alias("d")
    )
    x, y = F.greatest(F.lit(0.0), F.col("a") - pad), F.greatest(F.lit(0.0), F.col("b") - pad)
    return hull.select(
        key, x.alias("x"), y.alias("y"), (F.least(F.lit(1.0), F.col("c") + pad) - x).alias("w"), (F.least(F.lit(1.0), F.col("d") + pad) - y).alias("h")
    )


REASON_CHARS = 480


def detector_summary(boxes: DataFrame, images: DataFrame, key: str, min_score: float = 0.5, floor: float | None = None) -> DataFrame:
    """Per image: is anything there, how sure, and which boxes say so.

    The reason is cut to 480 characters; an entry with its separator takes at least 7, so the
    first 69 entries decide it and only those are kept per image.
    """
    kept = boxes.where(F.col("score") >= min_score)
    first = Window.partitionBy(key).orderBy(F.col("score").desc(), "box_id")
    text = F.format_string("%s %.2f", "label", "score")
    lead = kept.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= REASON_CHARS // 7 + 1)
    lead = lead.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__r", text.alias("t")))).alias("l"))
    lead = lead.select(key, F.substring(F.array_join(F.transform("l", lambda e: e["t"]), ", "), 1, REASON_CHARS).alias("reason"))
    tops = kept.groupBy(key).agg(F.max("score").alias("confidence"))
    got = images.join(tops, key, "left").join(lead, key, "left")
    sure = F.col("confidence").isNotNull()
    if floor:
        sure = sure & (F.col("confidence") >= floor)
    return got.select(key, sure.alias("positive"), F.nullif(F.col("confidence"), F.lit(0.0)).alias("confidence"), F.coalesce("reason", F.lit("")).alias("reason"))


# ---- reports -------------------------------------------------------------------------------------


def eval_gate(df: DataFrame) -> DataFrame:
    """One row: base and fine means of three distances and the promotion verdicts."""
    kinds = ("global", "window", "perceptual")
    one = df.agg(
        F.count(F.lit(1)).alias("n_val"),
        *[F.sum(f"{side}_{k}").alias(f"{side}_{k}") for k in kinds for side in ("base", "fine")],
    )
    for k in kinds:
        one = one.withColumn(f"{k}_delta_pct", (F.col(f"fine_{k}") - F.col(f"base_{k}")) / F.col(f"base_{k}") * 100)

    def verdict(ok: Column) -> Column:
        return F.when(ok, "PASS").otherwise("FAIL")

    return one.select(
        "n_val",
        *[(F.col(f"{side}_{k}") / F.col("n_val")).alias(f"{side}_{k}_mean") for k in kinds for side in ("base", "fine")],
        *[f"{k}_delta_pct" for k in kinds],
        verdict(F.col("window_delta_pct") <= -40).alias("window_gate"),
        verdict(F.abs("global_delta_pct") <= 5).alias("global_gate"),
        verdict(F.abs("perceptual_delta_pct") <= 3).alias("perceptual_gate"),
    )


def method_timing(df: DataFrame, method: str, ms: str, ok: Column) -> DataFrame:
    """Frames, failures, mean and p95 time per method; times are NULL when nothing succeeded."""
    good = df.where(ok)
    base = df.groupBy(method).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~ok).alias("failures"),
        (F.sum(F.when(ok, F.col(ms))) / F.nullif(F.count_if(ok), F.lit(0))).alias("mean_ms"),
    )
    q = exact_quantiles(good, [method], ms, {"p95_ms": 0.95})
    return base.join(q.withColumn("p95_ms", F.round("p95_ms", 6)), method, "left")


def timing_sketches(df: DataFrame, keys: Sequence[str], ms: str, k: int = 200) -> DataFrame:
    """``keys``, ``n``, ``sketch``: a mergeable sketch of the times of each group (quantiles, KLL of size ``k``).

    A group is for instance a method and an hour; the table is kept, and any span is merged from it
    without reading the times again.  Ranks are off by less than 1.65 % of the rows at ``k`` = 200 (with
    99 % confidence), not at all in groups of fewer than ``k`` rows.
    """
    good = df.where(F.col(ms).isNotNull())
    return good.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(ms).cast("double"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], probs: Mapping[str, float], k: int = 200) -> DataFrame:
    """``keys``, ``n`` and a quantile per name in ``probs`` over all sketches of a group."""
    got = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("__s"))
    return got.select(*keys, "n", *[F.kll_sketch_get_quantile_double("__s", F.lit(p)).alias(name) for name, p in probs.items()])


def run_rollup(df: DataFrame, job: str, counters: Sequence[str]) -> DataFrame:
    """Counters per job and in total (``is_total`` marks the grand total)."""
    got = df.rollup(job).agg(F.grouping_id().alias("g"), *[F.sum(c).alias(c) for c in counters])
    return got.select(job, (F.col("g") > 0).alias("is_total"), *counters)


def epoch_rollup(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 6).alias(m) for m in metrics])


def fleet_status(df: DataFrame, host: str, item: str, healed: Column, failed: Column) -> DataFrame:
    """ok or degraded per host with the distinct healed and failed services."""

    def names(cond: Column) -> Column:
        return F.array_sort(F.collect_set(F.when(cond, F.col(item))))  # one entry per service name

    got = df.groupBy(host).agg(names(healed).alias("healed"), names(failed).alias("failed"))
    return got.select(
        host,
        F.when(F.size("failed") > 0, "degraded").otherwise("ok").alias("status"),
        F.array_join("healed", ",").alias("healed"),
        F.array_join("failed", ",").alias("failed"),
    )


def progress_totals(df: DataFrame, job: str, counters: Sequence[str]) -> DataFrame:
    return df.groupBy(job).agg(*[F.sum(c).alias(c) for c in counters])


def throughput(df: DataFrame, worker: str, t_us: str, now_us: Column | int) -> DataFrame:
    """Results of the last hour and day per worker, counted back from a given moment."""
    now = now_us if isinstance(now_us, Column) else F.lit(now_us)
    age = now - F.col(t_us)
    return df.groupBy(worker).agg(
        F.count_if((age >= 0) & (age < 3_600_000_000)).alias("last_hour"),
        F.count_if((age >= 0) & (age < 86_400_000_000)).alias("last_day"),
    )


def iou_by_model(scores: DataFrame, version: str) -> DataFrame:
    """n, mean, median and best IoU per model version."""
    base = scores.groupBy(version).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("iou"), 9).alias("mean"), F.max("iou").alias("max")
    )
    q = exact_quantiles(scores, [version], "iou", {"median": 0.5})
    return base.join(q.withColumn("median", F.round("median", 9)), version)
