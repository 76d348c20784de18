"""Exposure values, capture times and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which file extensions count as photos and which of them are RAW.
PHOTO_EXTENSIONS = (
    "arw", "nef", "cr2", "cr3", "dng", "raf", "rw2",
    "jpg", "jpeg", "tif", "tiff", "png", "jxl", "webp",
)
RAW_EXTENSIONS = ("arw", "cr2", "cr3", "nef", "dng", "raf", "rw2")

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_FRAME_NUMBER = r"(?i)^[a-z_]*?(\d{4,5})\.(" + "|".join(PHOTO_EXTENSIONS) + r")$"


def ev_class(ev: Column) -> Column:
    """mid below half a stop, under/over from a full stop on, NULL in between."""
    return (
        F.when(F.abs(ev) < 0.5, "mid").when(ev <= -1, "under").when(ev >= 1, "over")
    )


def parse_ev(text: Column) -> Column:
    """Exposure text to double; leading plus signs are dropped, anything else bad is NULL."""
    bare = F.trim(F.regexp_replace(F.trim(text), r"^\++", ""))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def capture_seconds(taken: Column, subsec: Column) -> Column:
    """Capture time in epoch seconds with the sub-second digits as a fraction."""
    base = F.try_to_timestamp(taken, F.lit("yyyy:MM:dd HH:mm:ss"))
    part = F.when(subsec.rlike(r"^\d+$"), F.concat(F.lit("0."), subsec).cast("double"))
    return F.unix_micros(base) / F.lit(1_000_000) + F.coalesce(part, F.lit(0.0))


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))


def is_photo(name: Column) -> Column:
    return extension(name).isin(*PHOTO_EXTENSIONS)


def is_raw(name: Column) -> Column:
    return extension(name).isin(*RAW_EXTENSIONS)


def frame_number(name: Column) -> Column:
    """The 4-5 digit camera counter, NULL for free-form names."""
    return F.nullif(F.regexp_extract(name, _FRAME_NUMBER, 1), F.lit("")).cast("int")


def is_copy_name(name: Column) -> Column:
    """True for renamed duplicates such as ``x (1).ARW``."""
    # fixed value: the mark of a renamed duplicate
    return name.rlike(r"\s\(\d+\)\.[A-Za-z0-9]+$")


def jpg_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?i)\.jpe?g$", "")


def trailing_number(name: Column) -> Column:
    """Digits at the end of the stem, NULL if there are none."""
    digits = F.regexp_extract(jpg_stem(name), r"(\d+)$", 1)
    return F.nullif(digits, F.lit("")).try_cast("long")


def drop_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def mid_stem(stem: Column) -> Column:
    return F.regexp_replace(stem, r"_stage2-(int|ext)$", "")


def stage_route(stem: Column) -> Column:
    return (
        F.when(stem.endswith("_stage2-int"), "int")
        .when(stem.endswith("_stage2-ext"), "ext")
        .otherwise("unknown")
    )


def normalize_path(path: Column, personal_root: str) -> Column:
    """Absolute path without the personal root; empty stays empty."""
    bare = F.trim(path, F.lit("/"))
    cut = F.when(
        bare.startswith(personal_root + "/"), F.substr(bare, F.lit(len(personal_root) + 2))
    ).otherwise(bare)
    return F.when(cut == "", "").otherwise(F.concat(F.lit("/"), cut))


def storage_route(path: Column, team_prefix: str, team: str, archive: str) -> Column:
    """Full remote key: team paths live in one store, all others in the archive."""
    bare = F.ltrim(path, F.lit("/"))
    store = F.when(bare.startswith(team_prefix), team).otherwise(archive)
    return F.concat(store, bare)


# Fixed value: date, number, address and, in brackets, a note.
_SHOOT = r"^(\d{2}\.\d{2}\.\d{4})\s+(\d+)\s+([^()]+?)(?:\s+\(([^)]+)\))?\s*$"


def shoot_folder(path: Column) -> dict[str, Column]:
    """Photographer, date, number, address and agent read from a shoot path."""
    parts = F.split(F.trim(path, F.lit("/")), "/")
    last = F.element_at(parts, -1)

    def group(i: int) -> Column:
        return F.nullif(F.regexp_extract(last, _SHOOT, i), F.lit(""))

    return {
        "photographer": F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2))),
        "shoot_date": group(1),
        "shoot_num": group(2),
        "address": F.initcap(F.replace(F.trim(group(3)), F.lit("-"), F.lit(" "))),
        "agent": group(4),
    }


def safe_key(name: Column) -> Column:
    """Lower-case object key without its last extension."""
    base = F.lower(F.element_at(F.split(name, "/"), -1))
    return drop_extension(F.regexp_replace(base, r"[^a-z0-9._-]+", "_"))


def short_name(path: Column, limit: int = 60) -> Column:
    """Last path segment with only letters, digits and ``-_.``, cut to a length."""
    base = F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)
    return F.substring(F.regexp_replace(base, r"[^\p{L}\p{N}._-]", "_"), 1, limit)
