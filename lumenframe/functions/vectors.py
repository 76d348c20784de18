"""Array arithmetic: dot products, softmax, arg-max."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also inside higher-order functions."""
    return F.transform(F.array(value), use)[0]


def unit(a: Column) -> Column:
    """The array scaled to length one; a zero array stays zero."""
    return let(
        norm(a),
        lambda n: F.transform(a, lambda v: F.when(n == 0, 0.0).otherwise(v.cast("double") / n)),
    )


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def softmax(scores: Column, temperature: float = 1.0) -> Column:
    powers = let(
        F.array_max(scores),
        lambda top: F.transform(scores, lambda v: F.exp((v - top).cast("double") * temperature)),
    )
    return let(
        F.struct(powers.alias("e"), F.aggregate(powers, F.lit(0.0), lambda s, v: s + v).alias("total")),
        lambda p: F.transform(p["e"], lambda v: v / p["total"]),
    )


def argmax(scores: Column) -> Column:
    """Zero-based position of the first maximum."""
    return F.array_position(scores, F.array_max(scores)) - 1
