"""Colour arithmetic on 8-bit channel columns.

Weighted lumas are integers (thousandths, ten-thousandths) so that sums stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def luma601_milli(r: Column, g: Column, b: Column) -> Column:
    return (r * 299 + g * 587 + b * 114).cast("long")


def luma709_tenmilli(r: Column, g: Column, b: Column) -> Column:
    return (r * 2126 + g * 7152 + b * 722).cast("long")


def chroma_range(r: Column, g: Column, b: Column) -> Column:
    return F.greatest(r, g, b) - F.least(r, g, b)


def hsv_saturation(r: Column, g: Column, b: Column) -> Column:
    """8-bit HSV saturation, truncated as an 8-bit image stores it."""
    top = F.greatest(r, g, b)
    return F.when(top == 0, F.lit(0)).otherwise(F.floor(chroma_range(r, g, b) * 255 / top)).cast("int")


def _linear(c: Column) -> Column:
    v = c / F.lit(255.0)
    return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))


def _lab_f(t: Column) -> Column:
    d = 6.0 / 29.0
    return F.when(t > d**3, F.pow(t, F.lit(1.0 / 3.0))).otherwise(t / (3 * d * d) + 4.0 / 29.0)


def with_lab(df: DataFrame, r: str, g: str, b: str, prefix: str) -> DataFrame:
    """Add CIE Lab (D65) columns ``<prefix>l``, ``<prefix>a``, ``<prefix>b``.

    Built in stages, so that every power is computed once per pixel instead of being
    copied into each place that uses it.
    """
    keep = df.columns
    rows = df.select("*", *[_linear(F.col(c)).alias(f"__{n}") for n, c in zip("rgb", (r, g, b))])
    rl, gl, bl = F.col("__r"), F.col("__g"), F.col("__b")
    # sRGB primaries to XYZ and the D65 white.
    rows = rows.select(
        *keep,
        ((rl * 0.4124564 + gl * 0.3575761 + bl * 0.1804375) / 0.95047).alias("__x"),
        (rl * 0.2126729 + gl * 0.7151522 + bl * 0.0721750).alias("__y"),
        ((rl * 0.0193339 + gl * 0.1191920 + bl * 0.9503041) / 1.08883).alias("__z"),
    )
    rows = rows.select(*keep, *[_lab_f(F.col(f"__{n}")).alias(f"__f{n}") for n in "xyz"])
    return rows.select(
        *keep,
        (F.col("__fy") * 116.0 - 16.0).alias(f"{prefix}l"),
        ((F.col("__fx") - F.col("__fy")) * 500.0).alias(f"{prefix}a"),
        ((F.col("__fy") - F.col("__fz")) * 200.0).alias(f"{prefix}b"),
    )


def with_lab8(df: DataFrame, r: str, g: str, b: str, prefix: str) -> DataFrame:
    """Lab as an 8-bit image stores it: L on 0 to 255, a and b moved by 128, whole numbers."""

    def byte(v: Column) -> Column:
        return F.least(F.lit(255), F.greatest(F.lit(0), F.round(v, 0).cast("int")))

    return with_lab(df, r, g, b, "__").select(
        *df.columns,
        byte(F.col("__l") * 255.0 / 100.0).alias(f"{prefix}l"),
        byte(F.col("__a") + 128.0).alias(f"{prefix}a"),
        byte(F.col("__b") + 128.0).alias(f"{prefix}b"),
    )


def with_rgb(df: DataFrame, prefix: str) -> DataFrame:
    """8-bit ``r``, ``g``, ``b`` from 8-bit Lab columns ``<prefix>l``, ``<prefix>a``, ``<prefix>b``, which go."""
    names = [f"{prefix}{n}" for n in "lab"]
    keep = [c for c in df.columns if c not in names]
    l, a, b = (F.col(n) for n in names)
    d = 6.0 / 29.0
    rows = df.select(*keep, a, b, ((l * 100.0 / 255.0 + 16.0) / 116.0).alias("__fy"))
    rows = rows.select(*keep, "__fy", (F.col("__fy") + (a - 128) / 500.0).alias("__fx"), (F.col("__fy") - (b - 128) / 200.0).alias("__fz"))

    def back(t: Column) -> Column:
        return F.when(t > d, t * t * t).otherwise((t - 4.0 / 29.0) * (3 * d * d))

    # The D65 white, XYZ to sRGB primaries.
    rows = rows.select(*keep, (back(F.col("__fx")) * 0.95047).alias("__x"), back(F.col("__fy")).alias("__y"), (back(F.col("__fz")) * 1.08883).alias("__z"))
    x, y, z = F.col("__x"), F.col("__y"), F.col("__z")
    rows = rows.select(
        *keep,
        (x * 3.2404542 - y * 1.5371385 - z * 0.4985314).alias("__r"),
        (x * -0.9692660 + y * 1.8760108 + z * 0.0415560).alias("__g"),
        (x * 0.0556434 - y * 0.2040259 + z * 1.0572252).alias("__b"),
    )

    def byte(v: Column) -> Column:
        v = _clamp01(v)
        shown = F.when(v <= 0.0031308, v * 12.92).otherwise(F.pow(v, F.lit(1.0 / 2.4)) * 1.055 - 0.055)
        return F.round(_clamp01(shown) * 255.0, 0).cast("int")

    return rows.select(*keep, *[byte(F.col(f"__{n}")).alias(n) for n in "rgb"])


def _clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def sky_scores(s: Column, a: Column, b: Column) -> dict[str, Column]:
    """Blue, golden and dull score of a sky region, rounded before any aggregation."""
    sat = _clamp01(s / 60.0)
    blue = sat * _clamp01(-b / 25.0)
    warm = F.greatest(F.lit(0.0), a) + F.greatest(F.lit(0.0), b)
    golden = sat * _clamp01(warm / 30.0)
    dull = _clamp01(1.0 - F.greatest(blue, golden))
    return {
        "blue_score": F.round(blue, 3),
        "golden_score": F.round(golden, 3),
        "dull_score": F.round(dull, 3),
    }
