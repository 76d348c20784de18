"""Work plans and lookups built on joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions import review as R
from lumenframe.plans.lineage import stored
from lumenframe.plans.ordered import number_slot, range_sums, ranked, total_of, with_total


def pending(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no result yet."""
    return df.join(done, list(keys), "left_anti")


def split_delivered(df: DataFrame, delivered: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows still to do, rows skipped because they were delivered)."""
    return df.join(delivered, list(keys), "left_anti"), df.join(delivered, list(keys), "left_semi")


def requested_stems(lists: DataFrame, shoot: str, text: str) -> DataFrame:
    """Stems named in comma-separated lists, trimmed, without blanks and repeats."""
    parts = lists.select(shoot, F.explode(F.split(text, ",")).alias("stem"))
    return parts.select(shoot, F.trim("stem").alias("stem")).where("stem <> ''").distinct()


def single_frame_recovery(frames: DataFrame, wanted: DataFrame, shoot: str) -> tuple[DataFrame, DataFrame]:
    """(frames asked for by stem, stems that do not exist)."""
    return frames.join(wanted, [shoot, "stem"]), wanted.join(frames, [shoot, "stem"], "left_anti")


def drone_plan(files: DataFrame, bypass: bool = False) -> DataFrame:
    """What happens to every stem of a mixed DNG and JPG folder."""
    ext = F.lower("ext")
    name = F.concat("stem", F.lit("."), "ext")
    stems = files.groupBy("shoot", "stem").agg(
        F.max(F.when(ext == "dng", name)).alias("dng"),
        F.max(F.when(ext.isin("jpg", "jpeg"), name)).alias("jpg"),
    )
    stems = stems.where("dng IS NOT NULL OR jpg IS NOT NULL")
    raw, cam = F.col("dng").isNotNull(), F.col("jpg").isNotNull()
    if bypass:
        action = F.when(raw & cam, "jpg-beside").when(raw, "develop").otherwise("passthrough")
        source = F.coalesce("jpg", "dng")
    else:
        action = F.when(raw, "edit").otherwise("passthrough")
        source = F.coalesce("dng", "jpg")
    return stems.select("shoot", "stem", action.alias("action"), source.alias("source"))


def camera_backfill(files: DataFrame, edited_shoots: DataFrame) -> DataFrame:
    """DNGs of shoots that already have an edited set: camera JPG if there is one, else develop."""
    plan = drone_plan(files.join(edited_shoots, "shoot", "left_semi"), bypass=True)
    return plan.where("action <> 'passthrough'")


def match_rules(df: DataFrame, model: str, rules: Sequence[tuple[str, str, str]], dimension: DataFrame) -> DataFrame:
    """First rule whose hint occurs in the model and which has a dimension row.

    ``rules`` are (hint, maker part, model part).  Every rule finds its first dimension row
    (by ``dim_id``) once; that gives one row with as many entries as there are rules, which
    travels to the big side, where choosing is a fold and needs no shuffle.
    """
    lower_maker, lower_model = F.lower("maker"), F.lower("model")
    hits = [
        F.min(
            F.when(
                lower_maker.contains(maker.lower()) & lower_model.contains(part.lower()),
                F.struct("dim_id", "maker", "model"),
            )
        )
        for _, maker, part in rules
    ]
    found = total_of(dimension, F.array(*hits).alias("__dims"))
    text = F.upper(F.coalesce(F.col(model), F.lit("")))
    usable = [
        F.when(text.contains(hint.upper()) & F.col("__dims")[i].isNotNull(), F.lit(i))
        for i, (hint, _, _) in enumerate(rules)
    ]
    rows = with_total(df, found).withColumn("rule", F.coalesce(*usable))
    dim = F.col("__dims")[F.col("rule")]
    return rows.withColumn("dim_id", dim["dim_id"]).withColumn("dim_model", dim["model"]).drop("__dims")


def settings_overlay(defaults: DataFrame, stored: DataFrame, prefix: str) -> DataFrame:
    """Stored settings below a prefix win over the defaults; unknown stored keys are added."""
    own = stored.where(F.col("key").startswith(prefix)).select("key", F.col("value").alias("own"), F.lit(True).alias("has"))
    both = defaults.join(own, "key", "full_outer")
    return both.select("key", F.when(F.col("has"), F.col("own")).otherwise(F.col("value")).alias("value"))


def resolve_style(df: DataFrame, style: str, styles: DataFrame, default: str) -> DataFrame:
    """Interior and exterior entry of a style; an unknown style uses the default one."""
    fallback = total_of(
        styles.where(F.col("style") == default),
        F.max(F.struct("interior", "exterior")).alias("__default"),
    )
    own = styles.select(F.col("style").alias(style), F.struct("interior", "exterior").alias("__own"))
    rows = with_total(df.join(own, style, "left"), fallback)
    entry = F.coalesce("__own", "__default")
    return (
        rows.withColumn("interior", entry["interior"]).withColumn("exterior", entry["exterior"]).drop("__own", "__default")
    )


_BOX = ("box_id", "x0", "y0", "x1", "y1")


def _named(df: DataFrame, tag: str, keys: Sequence[str]) -> DataFrame:
    """The boxes with an area, columns prefixed by ``tag``."""
    got = df.select(*keys, *[F.col(x).alias(f"{tag}_{x}") for x in _BOX], *[F.col(x).alias(f"{tag}_{x}") for x in df.columns if x not in _BOX and x not in keys])
    return got.where((F.col(f"{tag}_x1") > F.col(f"{tag}_x0")) & (F.col(f"{tag}_y1") > F.col(f"{tag}_y0")))


def _near_cells(tag: str, lo: str, hi: str, min_iou: float) -> Column:
    """The (level, cell) pairs along one axis in which a box that overlaps enough can begin.

    Its length is within the bound of the own one, and its begin within the part of the longer of
    both that the overlap leaves.
    """
    size = (F.col(f"{tag}_{hi}") - F.col(f"{tag}_{lo}")).cast("double")
    begin = F.col(f"{tag}_{lo}").cast("double")
    levels = F.sequence(F.floor(F.log2(size * min_iou) - 1e-9), F.floor(F.log2(size / min_iou) + 1e-9))

    def cells(level: Column) -> Column:
        side = F.pow(F.lit(2.0), level)
        reach = (1 - min_iou) * F.greatest(size, F.least(2 * side, size / min_iou)) * (1 + 1e-9)
        first, last = F.floor((begin - reach) / side), F.floor((begin + reach) / side)
        return F.transform(F.sequence(first, last), lambda c: F.struct(level.alias("level"), c.alias("cell")))

    return F.flatten(F.transform(levels, cells))


def _own_cell(tag: str, lo: str, hi: str) -> Column:
    level = F.floor(F.log2((F.col(f"{tag}_{hi}") - F.col(f"{tag}_{lo}")).cast("double")))
    return F.struct(level.alias("level"), F.floor(F.col(f"{tag}_{lo}").cast("double") / F.pow(F.lit(2.0), level)).alias("cell"))


def _by_cells(a: DataFrame, b: DataFrame, keys: Sequence[str], min_iou: float, block: int) -> DataFrame:
    """Candidate pairs of crowded groups: a box of ``b`` lies in one cell of size and place, one of ``a`` asks the
    cells around it.  The pairs of a cell are dealt in blocks of ``block`` by ``block``."""
    at = [*keys, "__x", "__y"]
    a = a.withColumn("__x", F.explode(_near_cells("a", "x0", "x1", min_iou))).withColumn("__y", F.explode(_near_cells("a", "y0", "y1", min_iou)))
    b = b.withColumn("__x", _own_cell("b", "x0", "x1")).withColumn("__y", _own_cell("b", "y0", "y1"))

    def parts(df: DataFrame, out: str) -> DataFrame:
        return df.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(out))

    # a cell that only one side has falls out here
    cells = stored(parts(a, "__na").join(parts(b, "__nb"), at), "box-cells")

    def dealt(df: DataFrame, tag: str, own: str, other: str) -> DataFrame:
        rows = df.join(cells, at)
        mine = F.pmod(F.xxhash64(f"{tag}_box_id", f"{tag}_x0", f"{tag}_y0"), F.col(f"__n{own}")).cast("int")
        return rows.withColumn(f"__i{own}", mine).withColumn(f"__i{other}", F.explode(F.sequence(F.lit(0), F.col(f"__n{other}") - 1))).drop("__na", "__nb")

    return dealt(a, "a", "a", "b").join(dealt(b, "b", "b", "a"), [*at, "__ia", "__ib"]).drop("__x", "__y", "__ia", "__ib")


def box_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], min_iou: float, crowd: int = 10_000, block: int = 1024) -> DataFrame:
    """Pairs of boxes of the same group with IoU >= ``min_iou`` > 0 (columns ``a_*``, ``b_*``, ``iou``).

    The boxes of a group meet directly where they make at most ``crowd`` pairs.  In a crowded group they
    meet on a grid that follows their sizes: the IoU bounds how much width, height and place of two
    boxes may differ, so only near boxes of near sizes meet, each pair once, and a cell of very many
    boxes is dealt over tasks in blocks.  Boxes without area have no pair.
    """
    keys = list(keys)
    a, b = _named(a, "a", keys), _named(b, "b", keys)
    sizes = a.select(*keys, F.lit(1).alias("na"), F.lit(0).alias("nb")).unionByName(b.select(*keys, F.lit(0).alias("na"), F.lit(1).alias("nb")))
    sizes = sizes.groupBy(*keys).agg(F.sum("na").alias("na"), F.sum("nb").alias("nb")).where(F.col("na") * F.col("nb") > crowd)
    crowded = stored(sizes.select(*keys), "crowded-groups")
    if crowded.isEmpty():
        met = a.join(b, keys)
    else:
        inside = [x.join(crowded, keys, "left_semi") for x in (a, b)]
        met = a.join(crowded, keys, "left_anti").join(b, keys)
        met = met.unionByName(_by_cells(*inside, keys, min_iou, block).select(*met.columns))

    def area(t: str) -> Column:
        return (F.col(f"{t}_x1") - F.col(f"{t}_x0")) * (F.col(f"{t}_y1") - F.col(f"{t}_y0"))

    iw = F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")
    ih = F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0")
    inter = F.when((iw > 0) & (ih > 0), iw * ih)
    return met.withColumn("iou", inter / (area("a") + area("b") - inter)).where(F.col("iou") >= min_iou)


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: how many rows, how many agree, the rate."""
    same = F.count_if(F.col(a) == F.col(b))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), same.alias("agree"), (same / n).alias("rate"))


def disagreements(df: DataFrame, a: str, b: str, confidence: str, key: str) -> DataFrame:
    """Rows on which two models differ, least confident first."""
    return df.where(~F.col(a).eqNullSafe(F.col(b))).orderBy(confidence, key)


def inventory_drift(expected: DataFrame, actual: DataFrame, key: str, sha: str) -> DataFrame:
    """Expected files that are absent or have another checksum."""
    have = actual.select(key, F.col(sha).alias("__have"))
    drift = expected.join(have, key, "left").where(~F.col(sha).eqNullSafe(F.col("__have")))
    return drift.withColumn("state", F.when(F.col("__have").isNull(), "absent").otherwise("changed")).drop("__have")


def labelled_items(labels: DataFrame, manifest: DataFrame, files: DataFrame, drop: Sequence[str]) -> DataFrame:
    """Usable labels whose slug is in the manifest and whose file exists."""
    usable = labels.where(~F.col("label").isin(*drop)).join(manifest, "slug")
    return usable.join(files, "path", "left_semi")


def asset_batch(records: DataFrame, classes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delivered records (object key and image id present) with their classification, if any."""
    ready = records.where("object_key IS NOT NULL AND image_key IS NOT NULL")
    return ready.join(classes, list(keys), "left")


def exterior_requests(records: DataFrame, classes: DataFrame, plates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A request per exterior photo; one plate per job, picked by a hash of the job.

    Unknown photos are left alone.  Every plate takes part: plates are numbered by ``plate_id``
    and a photo meets the one whose number the hash gives.
    """
    shelf = ranked(plates.select("plate_id", "plate_path"), [], number_slot("plate_id"), ["plate_id", "plate_path"], "__n")
    outside = records.where("object_key IS NOT NULL").join(
        classes.where(~F.col("is_interior")).select(*keys), list(keys), "left_semi"
    )
    counted = with_total(outside, total_of(plates, F.count(F.lit(1)).alias("__plates"))).where("__plates > 0")
    picked = counted.withColumn("__n", R.hash_pick(F.col("job_id"), F.col("__plates")).cast("long") + 1)
    return picked.join(shelf, "__n").drop("__n", "__plates")


def step_plan(images: DataFrame, source: str, steps: Sequence[Mapping[str, str | None]]) -> DataFrame:
    """Images with a source times configured steps; steps without a prompt are skipped."""
    usable = [s for s in steps if s.get("prompt")]
    table = F.array(*[F.struct(F.lit(s["key"]).alias("step"), F.lit(s["prompt"]).alias("prompt")) for s in usable])
    return images.where(F.col(source).isNotNull()).select("*", F.inline(table))


def candidate_plan(categories: DataFrame, category: str, prompts: str, per_category: int, seed: int) -> DataFrame:
    """``per_category`` numbered candidates per category with rotating prompt and stable seed."""
    rows = categories.select("*", F.explode(F.sequence(F.lit(0), F.lit(per_category - 1))).alias("i"))
    prompt = F.col(prompts)[F.col("i") % F.size(prompts)]
    mix = R.hash_number(F.concat_ws("|", category, "i")) % (2**31)
    return rows.withColumn("prompt", prompt).withColumn("seed", F.lit(seed) + mix)


def near_vertical(segments: DataFrame, window_deg: float = 25.0) -> DataFrame:
    """Angle off vertical in whole micro-degrees (NULL outside the window) and milli-pixel length."""
    theta = F.degrees(F.atan2("dy", "dx"))
    delta = F.when(theta < 0, theta + 180).otherwise(theta) - 90
    length = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
    return segments.withColumn(
        "angle", F.when(F.abs(delta) < window_deg, F.round(delta * 1_000_000).cast("long"))
    ).withColumn("weight", F.round(length * 1000).cast("long"))


def angle_points(angles: DataFrame) -> DataFrame:
    """Equal angles of an image merged: count, weight, weighted angle (exact integers)."""
    return angles.where("angle IS NOT NULL").groupBy("image", "angle").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")
    ).withColumn("wa", F.col("w").cast("decimal(20,0)") * F.col("angle").cast("decimal(10,0)"))


def roll_consensus(angles: DataFrame, reach_udeg: int = 799_999) -> DataFrame:
    """Roll by consensus: the angle with the heaviest surroundings, refined by their mean.

    Every angle is a candidate; ties go to the angle nearest zero, then the lower one.
    Images with fewer than three usable angles give 0.
    """
    near = range_sums(angle_points(angles), ["image"], "angle", ["w", "wa"], reach_udeg, 10_000_000)
    rank = F.struct((-F.col("near_w")).alias("a"), F.abs("angle").alias("b"), F.col("angle").alias("c"))
    best = near.groupBy("image").agg(F.min_by(F.struct("near_w", "near_wa"), rank).alias("b"))
    sizes = angles.groupBy("image").agg(F.count("angle").alias("n"))
    mean = -(F.col("b.near_wa").cast("double") / F.col("b.near_w").cast("double")) / 1_000_000
    return sizes.join(best, "image", "left").select(
        "image", "n", F.when(F.col("n") < 3, F.lit(0.0)).otherwise(mean).alias("roll_deg")
    )
