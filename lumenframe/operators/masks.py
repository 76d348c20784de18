"""Binary masks as sparse pixel sets ``(image_id, x, y)`` or as horizontal runs
``(image_id, y, x0, x1)``; sizes come from ``dims(image_id, w, h)``.

Neighbourhood work is done on runs: a row of a mask is a handful of intervals, and a
structuring element is one half-width per row, so nothing is expanded to pixel pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions import color as K
from lumenframe.plans.lineage import cut

KEY = ("image_id", "x", "y")


def threshold_mask(plane: DataFrame, value: str, at_least: int = 0, strict: bool = True) -> DataFrame:
    """Pixels above (or, not strict, from) a grey level."""
    v = F.col(value)
    return plane.where(v > at_least if strict else v >= at_least).select(*KEY)


# ---- runs ---------------------------------------------------------------------------------------


def to_runs(mask: DataFrame) -> DataFrame:
    w = Window.partitionBy("image_id", "y").orderBy("x")
    # a repeated pixel has the rank of its twin
    rows = mask.select(*KEY).withColumn("__g", F.col("x") - F.dense_rank().over(w))
    return rows.groupBy("image_id", "y", "__g").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("__g")


def to_pixels(runs: DataFrame) -> DataFrame:
    return runs.select("image_id", F.explode(F.sequence("x0", "x1")).alias("x"), "y")


def merge_runs(runs: DataFrame) -> DataFrame:
    """Union of overlapping and touching runs.

    Runs that start together are merged before the shuffle, so a row of an image has at most
    as many runs as pixels, however many boxes cover it.
    """
    runs = runs.groupBy("image_id", "y", "x0").agg(F.max("x1").alias("x1"))
    w = Window.partitionBy("image_id", "y").orderBy("x0", "x1")
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("x0") > reach + 1), 1).otherwise(0)
    rows = runs.withColumn("__o", opens)
    rows = rows.withColumn("__g", F.sum("__o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("image_id", "y", "__g").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("__g")


def invert_runs(runs: DataFrame, dims: DataFrame) -> DataFrame:
    """The unset pixels inside the image, as runs.  ``runs`` must be merged and inside."""
    rows = dims.select("image_id", "w", F.explode(F.sequence(F.lit(0), F.col("h") - 1)).alias("y"))
    # every row gets a sentinel run left of the image; each run opens the gap that follows it
    marks = rows.select("image_id", "y", F.lit(-1).alias("x0"), F.lit(-1).alias("x1"), "w")
    marks = marks.unionByName(runs.select("image_id", "y", "x0", "x1", F.lit(None).cast("int").alias("w")))
    order = Window.partitionBy("image_id", "y").orderBy("x0")
    whole = Window.partitionBy("image_id", "y")
    gaps = marks.select(
        "image_id",
        "y",
        (F.col("x1") + 1).alias("x0"),
        (F.coalesce(F.lead("x0").over(order), F.max("w").over(whole)) - 1).alias("x1"),
    )
    return gaps.where("x0 <= x1")


def dilate_runs(runs: DataFrame, dims: DataFrame, radius: Column, round_shape: bool = False) -> DataFrame:
    """Grow by a disk of ``radius`` (an expression over ``dims``), clipped to the image.

    ``round_shape`` rounds the half-width of each row of the disk instead of truncating it.
    """
    sized = runs.join(dims.select("image_id", "w", "h", radius.cast("int").alias("r")), "image_id")
    spread = sized.withColumn("dy", F.explode(F.sequence(-F.col("r"), F.col("r"))))
    half = F.sqrt((F.col("r") * F.col("r") - F.col("dy") * F.col("dy")).cast("double"))
    half = (F.round(half) if round_shape else F.floor(half)).cast("int")
    grown = spread.select(
        "image_id",
        (F.col("y") + F.col("dy")).alias("y"),
        F.greatest(F.lit(0), F.col("x0") - half).alias("x0"),
        F.least(F.col("w") - 1, F.col("x1") + half).alias("x1"),
        "h",
    )
    return merge_runs(grown.where("y >= 0 AND y < h").drop("h"))


def erode_runs(runs: DataFrame, dims: DataFrame, radius: Column, round_shape: bool = False) -> DataFrame:
    """Shrink by a disk; outside the image counts as set."""
    return invert_runs(dilate_runs(invert_runs(runs, dims), dims, radius, round_shape), dims)


def morph_open_close(mask: DataFrame, dims: DataFrame, r_open: int, r_close: int) -> DataFrame:
    """Opening, then closing, with disks; a radius of 0 skips the step."""
    runs = to_runs(mask)
    if r_open > 0:
        runs = dilate_runs(erode_runs(runs, dims, F.lit(r_open)), dims, F.lit(r_open))
    if r_close > 0:
        runs = erode_runs(dilate_runs(runs, dims, F.lit(r_close)), dims, F.lit(r_close))
    return to_pixels(runs)


def adaptive_close(mask: DataFrame, dims: DataFrame, share: float = 0.25, low: int = 31, high: int = 81) -> DataFrame:
    """Closing with a round kernel sized by the smaller extent of the mask; empty masks stay."""
    runs = to_runs(mask)
    box = runs.groupBy("image_id").agg(
        (F.max("x1") - F.min("x0") + 1).alias("bw"), (F.max("y") - F.min("y") + 1).alias("bh")
    )
    k = F.greatest(F.lit(low), F.least(F.lit(high), F.floor(F.least("bw", "bh") * share).cast("int")))
    k = k.bitwiseOR(F.lit(1))
    sized = dims.join(box.select("image_id", F.floor(k / 2).cast("int").alias("r")), "image_id")
    r = F.col("r")
    return to_pixels(erode_runs(dilate_runs(runs, sized, r, True), sized, r, True))


BOXES_PER_TASK = 200_000


def new_pixels(runs: DataFrame) -> DataFrame:
    """Pixels of overlapping runs, each once: a run gives what no run before it in its row has reached."""
    w = Window.partitionBy("image_id", "y").orderBy("x0", "x1").rowsBetween(Window.unboundedPreceding, -1)
    start = F.greatest(F.col("x0"), F.max("x1").over(w) + 1)
    return to_pixels(runs.select("image_id", "y", start.alias("x0"), "x1").where("x0 <= x1"))


def rasterize_boxes(boxes: DataFrame, dims: DataFrame, rounded: bool, per_task: int = BOXES_PER_TASK) -> DataFrame:
    """Pixels covered by any fractional box ``x, y, w, h`` (corners rounded or truncated, clamped).

    Boxes are counted first and dealt by image to tasks of about ``per_task``, so the memory of a task does
    not follow their number; a row of an image is sorted once and nothing is hashed.
    """
    spark = boxes.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-boxes.count() // per_task))
    b = boxes.select("image_id", "x", "y", F.col("w").alias("bw"), F.col("h").alias("bh")).join(dims, "image_id")

    def px(v: Column, size: Column) -> Column:
        scaled = v * size
        whole = F.bround(scaled, 0) if rounded else F.floor(scaled)
        return F.greatest(F.lit(0), F.least(size, whole.cast("int")))

    corner = b.select(
        "image_id",
        px(F.col("x"), F.col("w")).alias("x0"),
        (px(F.col("x") + F.col("bw"), F.col("w")) - 1).alias("x1"),
        px(F.col("y"), F.col("h")).alias("y0"),
        (px(F.col("y") + F.col("bh"), F.col("h")) - 1).alias("y1"),
    )
    corner = corner.where("x0 <= x1 AND y0 <= y1").repartition(tasks, "image_id")  # after the join, which deals anew
    rows = corner.select(
        "image_id", F.explode(F.sequence("y0", "y1")).alias("y"), "x0", "x1"
    )
    return new_pixels(rows)


# ---- components ---------------------------------------------------------------------------------


def connected_components(mask: DataFrame) -> DataFrame:
    """Label 4-connected components: ``(image_id, x, y, component)``.

    Nodes are runs, joined where runs of neighbouring rows overlap.  Each round takes the
    smallest label around and then the label of that label, so long snakes need a
    logarithmic number of rounds.  The component is named by its first run.
    """
    runs = cut(
        to_runs(mask).select(
            "image_id", "y", "x0", "x1", F.shiftleft(F.col("y").cast("long"), 24).bitwiseOR(F.col("x0").cast("long")).alias("node")
        )
    )
    edges = cut(_touching(runs))
    labels = cut(runs.select("image_id", "node", F.col("node").alias("label")))
    while True:
        around = edges.join(
            labels.select("image_id", F.col("node").alias("other"), "label"), ["image_id", "other"]
        )
        around = around.groupBy("image_id", "node").agg(F.min("label").alias("__near"))
        near = labels.join(around, ["image_id", "node"], "left").withColumn("__l", F.least("label", "__near"))
        hop = labels.select("image_id", F.col("node").alias("__l"), F.col("label").alias("__hop"))
        step = near.join(hop, ["image_id", "__l"], "left").select(
            "image_id",
            "node",
            F.least("__l", "__hop").alias("label"),
            (F.least("__l", "__hop") < F.col("label")).alias("moved"),
        )
        step = cut(step)
        labels = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    return runs.join(labels, ["image_id", "node"]).select(
        "image_id", F.explode(F.sequence("x0", "x1")).alias("x"), "y", F.col("label").alias("component")
    )


def _touching(runs: DataFrame) -> DataFrame:
    """Both directions of every pair of overlapping runs in neighbouring rows.

    Runs of a row are disjoint, so a run meets only a few of the next row; runs are met in
    shared 64-pixel columns and reported where their overlap begins.
    """
    cells = F.explode(F.sequence(F.floor(F.col("x0") / 64), F.floor(F.col("x1") / 64)))
    up = runs.select("image_id", (F.col("y") + 1).alias("y"), "node", F.col("x0").alias("a0"), F.col("x1").alias("a1"), cells.alias("cell"))
    down = runs.select("image_id", "y", F.col("node").alias("other"), "x0", "x1", cells.alias("cell"))
    start = F.greatest("a0", "x0")
    met = up.join(down, ["image_id", "y", "cell"]).where(
        (start <= F.least("a1", "x1")) & (F.floor(start / 64) == F.col("cell"))
    )
    one = met.select("image_id", "node", "other")
    return one.unionByName(met.select("image_id", F.col("other").alias("node"), F.col("node").alias("other")))


def keep_components(labelled: DataFrame, min_area: int = 0, largest: int = 0) -> DataFrame:
    """Drop components below an area, then keep only the N largest (later ones win ties)."""
    areas = labelled.groupBy("image_id", "component").agg(F.count(F.lit(1)).alias("area"))
    kept = areas.where(F.col("area") >= min_area)
    if largest > 0:
        w = Window.partitionBy("image_id").orderBy(F.col("area").desc(), F.col("component").desc())
        kept = kept.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= largest)
    return labelled.join(kept.select("image_id", "component"), ["image_id", "component"], "left_semi").select(*KEY)


def drop_bright_components(labelled: DataFrame, pixels: DataFrame, max_luma: int) -> DataFrame:
    """Keep components whose mean BT.709 luma (0-255) is below the limit."""
    lum = pixels.select(*KEY, K.luma709_tenmilli(F.col("r"), F.col("g"), F.col("b")).alias("l"))
    dark = (
        labelled.join(lum, list(KEY))
        .groupBy("image_id", "component")
        .agg(F.sum("l").alias("s"), F.count(F.lit(1)).alias("n"))
        .where(F.col("s") < F.col("n") * (max_luma * 10_000))
    )
    return labelled.join(dark, ["image_id", "component"], "left_semi").select(*KEY)


# ---- resampling and combination ------------------------------------------------------------------


def grid_majority(mask: DataFrame, dims: DataFrame, grid: int) -> DataFrame:
    """Cells ``(image_id, gx, gy)`` of a grid that are covered by more than half."""
    sized = mask.join(dims, "image_id")
    cells = sized.groupBy(
        "image_id",
        F.floor(F.col("x") * grid / F.col("w")).cast("int").alias("gx"),
        F.floor(F.col("y") * grid / F.col("h")).cast("int").alias("gy"),
    ).agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w"), F.max("h").alias("h"))

    def width(g: str, size: str) -> Column:
        return F.ceil((F.col(g) + 1) * F.col(size) / grid) - F.ceil(F.col(g) * F.col(size) / grid)

    return cells.where(2 * F.col("n") > width("gx", "w") * width("gy", "h")).select("image_id", "gx", "gy")


def resize_nearest(mask: DataFrame, dims: DataFrame, w: Column | int, h: Column | int) -> DataFrame:
    """Nearest-neighbour resize; every set pixel is written to the target span it feeds."""
    to_w = w if isinstance(w, Column) else F.lit(w)
    to_h = h if isinstance(h, Column) else F.lit(h)

    def span(p: str, size: Column, to: Column) -> tuple[Column, Column]:
        def first(v: Column) -> Column:
            return F.ceil((2 * v * to - size) / (2 * size)).cast("int")

        return F.greatest(F.lit(0), first(F.col(p))), F.least(to, first(F.col(p) + 1)) - 1

    sized = mask.join(dims.select("image_id", F.col("w").alias("__w"), F.col("h").alias("__h")), "image_id")
    x0, x1 = span("x", F.col("__w"), to_w)
    y0, y1 = span("y", F.col("__h"), to_h)
    spans = sized.select("image_id", x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))
    rows = spans.where("x0 <= x1 AND y0 <= y1")
    rows = rows.select("image_id", "x0", "x1", F.explode(F.sequence("y0", "y1")).alias("y"))
    return to_pixels(rows)


def overlay(a: DataFrame, b: DataFrame) -> DataFrame:
    """``image_id``, ``y``, ``x0``, ``x1``, ``a``, ``b``: stretches of each row and which of two masks of runs cover them.

    A run is an event where it begins and one behind its end; between two events nothing changes.  No run
    is expanded to pixels.
    """

    def events(runs: DataFrame, da: int, db: int) -> DataFrame:
        def at(x: Column, sign: int) -> Column:
            return F.struct(x.alias("x"), F.lit(sign * da).alias("da"), F.lit(sign * db).alias("db"))

        return runs.select("image_id", "y", F.inline(F.array(at(F.col("x0"), 1), at(F.col("x1") + 1, -1))))

    both = events(a, 1, 0).unionByName(events(b, 0, 1))
    both = both.groupBy("image_id", "y", "x").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    w = Window.partitionBy("image_id", "y").orderBy("x")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = both.select(
        "image_id", "y", F.col("x").alias("x0"), (F.lead("x").over(w) - 1).alias("x1"),
        (F.sum("da").over(upto) > 0).alias("a"), (F.sum("db").over(upto) > 0).alias("b"),
    )
    return parts.where("(a OR b) AND x1 IS NOT NULL")


def combine_runs(a: DataFrame, b: DataFrame, mode: str) -> DataFrame:
    """``and``, ``or``, ``only_a`` or ``only_b`` of two masks of runs, as merged runs."""
    if mode in ("only_a", "only_b"):
        return merge_runs((a if mode == "only_a" else b).select("image_id", "y", "x0", "x1"))
    parts = overlay(a, b)
    return merge_runs((parts.where("a AND b") if mode == "and" else parts).select("image_id", "y", "x0", "x1"))


def combine_masks(a: DataFrame, b: DataFrame, mode: str) -> DataFrame:
    """``and``, ``or``, ``only_a`` or ``only_b`` of two masks."""
    if mode in ("only_a", "only_b"):
        return (a if mode == "only_a" else b).select(*KEY).distinct()
    return to_pixels(combine_runs(to_runs(a), to_runs(b), mode)).select(*KEY)


# ---- measures -------------------------------------------------------------------------------------


def run_iou(truth: DataFrame, pred: DataFrame, images: DataFrame) -> DataFrame:
    """IoU of every image listed, of masks of runs; both empty is 1."""
    size = F.col("x1") - F.col("x0") + 1
    parts = overlay(truth, pred)
    sums = parts.groupBy("image_id").agg(F.sum(F.when(F.col("a") & F.col("b"), size)).alias("inter"), F.sum(size).alias("union"))
    got = images.join(sums, "image_id", "left")
    inter, union = F.coalesce("inter", F.lit(0)), F.coalesce("union", F.lit(0))
    return got.withColumn("iou", F.when(union == 0, 1.0).otherwise(inter / union)).drop("inter", "union")


def mask_iou(truth: DataFrame, pred: DataFrame, images: DataFrame) -> DataFrame:
    """IoU of every image listed; both empty is 1."""
    return run_iou(to_runs(truth), to_runs(pred), images)


def truth_against_predictions(truth_images: DataFrame, truth: DataFrame, rows: DataFrame, masks: DataFrame) -> DataFrame:
    """IoU per truth image and model version.

    ``rows`` lists predictions; one without a mask counts as an empty mask, and a truth
    image without any prediction row, or a row without truth, is skipped.
    """
    scored = rows.join(truth_images, "image_id", "left_semi")
    key = F.struct("image_id", "version")
    # the runs of a truth mask, not its pixels, meet the versions
    t = to_runs(truth).join(scored.select("image_id", "version"), "image_id")
    t = t.select(key.alias("image_id"), "y", "x0", "x1")
    p = masks.join(scored.where("has_mask").select("image_id", "version"), ["image_id", "version"], "left_semi")
    p = to_runs(p.select(key.alias("image_id"), "x", "y"))
    got = run_iou(t, p, scored.select(key.alias("image_id")))
    return got.select("image_id.image_id", "image_id.version", "iou")


def mask_area(mask: DataFrame, dims: DataFrame) -> DataFrame:
    n = mask.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    got = dims.join(n, "image_id", "left")
    area = F.coalesce("n", F.lit(0))
    return got.select("image_id", area.alias("area"), (100 * area / (F.col("w") * F.col("h"))).alias("pct"))


def mask_roi(mask: DataFrame, dims: DataFrame, pad_min: int = 128, factor: float = 1.5, align: int = 64) -> DataFrame:
    """Padded and aligned bounding rectangle; an empty mask takes the whole frame."""
    box = mask.groupBy("image_id").agg(
        F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"), F.min("y").alias("y0"), (F.max("y") + 1).alias("y1")
    )
    got = dims.join(box, "image_id", "left")
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    pad = F.greatest(F.lit(pad_min), F.floor(size * factor))

    def low(v: str) -> Column:
        return F.greatest(F.lit(0), F.floor((F.col(v) - pad) / align) * align).cast("int")

    def high(v: str, limit: str) -> Column:
        return F.least(F.col(limit), F.ceil((F.col(v) + pad) / align) * align).cast("int")

    whole = F.col("x0").isNull()
    return got.select(
        "image_id",
        F.when(whole, 0).otherwise(low("x0")).alias("x0"),
        F.when(whole, 0).otherwise(low("y0")).alias("y0"),
        F.when(whole, F.col("w")).otherwise(high("x1", "w")).alias("x1"),
        F.when(whole, F.col("h")).otherwise(high("y1", "h")).alias("y1"),
    )
