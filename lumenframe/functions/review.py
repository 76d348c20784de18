"""Predicates and labels over review rows, JSON bags, fleet health and small text formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def compact_json(fields: Mapping[str, Column]) -> Column:
    """JSON object without NULL and empty members."""
    return F.to_json(F.struct(*[F.nullif(c.cast("string"), F.lit("")).alias(k) for k, c in fields.items()]))


def relabel(label: Column, drop: Sequence[str], merge: Mapping[str, str], allow: Sequence[str]) -> Column:
    """Dropped or unlisted labels become NULL; merged ones are renamed first."""
    merged = label
    if merge:
        table = F.create_map(*[F.lit(x) for kv in merge.items() for x in kv])
        merged = F.coalesce(F.try_element_at(table, label), label)
    kept = F.when(~label.isin(*drop), merged) if drop else merged
    return F.when(kept.isin(*allow), kept)


def effective_flag(corrected: Column, worker: Column) -> Column:
    """The editor's word wins, else the worker's; NULL counts as false."""
    return F.coalesce(corrected, worker, F.lit(False))


def has_condition(bag: Column, name: str) -> Column:
    return F.coalesce(F.get_json_object(bag, f"$.{name}") == "true", F.lit(False))


def lacks_condition(bag: Column, name: str) -> Column:
    """No bag at all, or anything but an explicit ``true``."""
    return bag.isNull() | ~F.get_json_object(bag, f"$.{name}").eqNullSafe(F.lit("true"))


def is_interior_room(room: Column) -> Column:
    return F.coalesce(room.isNotNull() & (room != "") & (room != "exterior"), F.lit(False))


def is_exterior_proxy(bag: Column, room: Column) -> Column:
    """Classified (the bag is there) but no room came out."""
    return bag.isNotNull() & room.isNull()


def all_present(*cols: Column) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & c.isNotNull()
    return cond


def digits_or_null(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("long"))


def scores_of(bag_json: Column) -> Column:
    """Map of condition to confidence; a member may be a number or an object."""
    raw = F.from_json(bag_json, T.MapType(T.StringType(), T.StringType()))
    return F.transform_values(
        raw,
        lambda _, v: F.when(
            F.substring(v, 1, 1) == "{",
            F.coalesce(F.get_json_object(v, "$.confidence").try_cast("double"), F.lit(0.0)),
        ).otherwise(v.try_cast("double")),
    )


DETECTIONS = T.StructType(
    [
        T.StructField(
            "detections",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("score", T.DoubleType()),
                        T.StructField("box", T.ArrayType(T.DoubleType())),
                    ]
                )
            ),
        )
    ]
)


def first_object(text: Column) -> Column:
    """The first balanced ``{...}`` of a text, NULL when there is none.

    The text is cut before every brace; the fold has one step per brace and carries the depth and three
    positions, and the object is cut from the text once.
    """
    pieces = F.split(text, r"(?=[{}])")
    none = F.lit(None).cast("int")
    start = F.struct(F.lit(0).alias("depth"), F.lit(1).alias("at"), none.alias("begin"), none.alias("end"))

    def step(s: Column, piece: Column) -> Column:
        lead = F.substring(piece, 1, 1)
        opens, closes = lead == "{", lead == "}"
        skip = s["end"].isNotNull() | ((s["depth"] == 0) & ~opens)
        ends = ~skip & closes & (s["depth"] == 1)
        return F.struct(
            F.when(skip, s["depth"]).otherwise(s["depth"] + opens.cast("int") - closes.cast("int")).alias("depth"),
            (s["at"] + F.length(piece)).alias("at"),
            F.when(~skip & opens & (s["depth"] == 0), s["at"]).otherwise(s["begin"]).alias("begin"),
            F.when(ends, s["at"]).otherwise(s["end"]).alias("end"),
        )

    done = F.aggregate(pieces, start, step)
    return F.when(done["end"].isNotNull(), F.substr(text, done["begin"], done["end"] - done["begin"] + 1))


def salvage_detections(text: Column) -> Column:
    """Detections from a chatty model answer; anything unreadable gives an empty list."""
    parsed = F.from_json(first_object(text), DETECTIONS, {"allowSingleQuotes": "false"})
    return F.coalesce(parsed["detections"], F.array().cast(DETECTIONS["detections"].dataType))


_ROWS = {"top": 0.0, "middle": 0.31, "bottom": 0.62}
_COLS = {"left": 0.0, "center": 0.31, "right": 0.62}


def region_box(region: Column) -> Column:
    """Fractional box of a 3x3 cell name such as ``top-left``; NULL if unknown."""
    cells = {
        f"{r}-{c}": (x, y) for r, y in _ROWS.items() for c, x in _COLS.items()
    }
    pairs = []
    for name, (x, y) in cells.items():
        box = F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(0.38).alias("w"), F.lit(0.38).alias("h")
        )
        pairs += [F.lit(name), box]
    return F.try_element_at(F.create_map(*pairs), region)


def band(value: Column, warn: float, bad: float, strict: bool = False) -> Column:
    """green / yellow / red; ``strict`` moves the limits into the better band."""
    if strict:
        return F.when(value > bad, "red").when(value > warn, "yellow").otherwise("green")
    return F.when(value < warn, "green").when(value < bad, "yellow").otherwise("red")


def age_text(sec: Column) -> Column:
    m, h = F.floor(sec / 60), F.floor(sec / 3600)
    return (
        F.when(sec < 60, F.format_string("%ds", sec))
        .when(sec < 3600, F.format_string("%dm%02ds", m, sec % 60))
        .otherwise(F.format_string("%dh%02dm", h, F.floor((sec % 3600) / 60)))
    )


def uptime_text(sec: Column) -> Column:
    m, h, d = F.floor(sec / 60), F.floor(sec / 3600), F.floor(sec / 86400)
    return (
        F.when(sec < 3600, F.format_string("%dm", m))
        .when(sec < 86400, F.format_string("%dh%02dm", h, F.floor((sec % 3600) / 60)))
        .otherwise(F.format_string("%dd%02dh", d, F.floor((sec % 86400) / 3600)))
    )


def run_tag(similarity: Column, feature: Column, combine: Column, keep: Column, min_area: Column) -> Column:
    """Version tag of a difference mask; thresholds in percent, default parts left out."""

    def pct(c: Column) -> Column:
        return F.lpad(F.floor(c * 100).cast("int").cast("string"), 2, "0")

    return F.concat(
        F.lit("diff__ssim"),
        pct(similarity),
        F.lit("_dino"),
        pct(feature),
        F.lit("_"),
        combine,
        F.when(keep > 0, F.concat(F.lit("_k"), keep.cast("string"))).otherwise(""),
        F.when(min_area > 200, F.concat(F.lit("_a"), min_area.cast("string"))).otherwise(""),
    )


def hash_number(key: Column) -> Column:
    """The first 32 bits of the SHA-256 of a key as a long."""
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("long")


def hash_pick(key: Column, n: int | Column) -> Column:
    return hash_number(key) % n


def hash_shard(hex_id: Column, n: int) -> Column:
    """Shard of an id that is already hexadecimal."""
    return F.conv(F.substring(hex_id, 1, 8), 16, 10).cast("long") % n


INTERIOR_MIN = 0.6
SUBTYPE_MIN = 0.55


def photo_verdict(failed: Column, is_interior: Column, conf: Column, subtype: Column, sub_conf: Column) -> Column:
    """interior, a subtype, ambiguous, or NULL when the photo could not be read."""
    return (
        F.when(failed, None)
        .when(is_interior & (conf >= INTERIOR_MIN), "interior")
        .when(sub_conf < SUBTYPE_MIN, "ambiguous")
        .otherwise(subtype)
    )


def pixel_box_from_extent(x: Column, y: Column, bw: Column, bh: Column, w: Column, h: Column) -> Column:
    """Corner box in pixels from x, y, width, height given in fractions or pixels."""
    frac = F.greatest(x + bw, y + bh) <= 1.5
    sx, sy = F.when(frac, w).otherwise(F.lit(1)), F.when(frac, h).otherwise(F.lit(1))
    return F.struct(
        (x * sx).alias("x0"), (y * sy).alias("y0"), ((x + bw) * sx).alias("x1"), ((y + bh) * sy).alias("y1")
    )


def pixel_box_from_corners(box: Column, w: Column, h: Column) -> Column:
    """Corner box in pixels from a 4-element array; any other length is an error."""
    frac = F.array_max(box) <= 1.5
    sx, sy = F.when(frac, w).otherwise(F.lit(1)), F.when(frac, h).otherwise(F.lit(1))
    ok = F.struct(
        (box[0] * sx).alias("x0"), (box[1] * sy).alias("y0"), (box[2] * sx).alias("x1"), (box[3] * sy).alias("y1")
    )
    return F.when(F.size(box) == 4, ok).otherwise(F.raise_error(F.lit("a box needs four numbers")))


def other_conditions(all_of: Column, current: Column) -> Column:
    return F.array_remove(F.coalesce(all_of, F.array().cast("array<string>")), current)
