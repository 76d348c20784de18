"""Exact quantiles of groups of any size.

The built-in exact percentile keeps a map of all distinct values of a group in one task.  That is
fine where the domain is bounded (8-bit pixels).  For free doubles the values are counted once, in a
written table; a group with very many distinct values is cut in bins by sketch cut points, only the
bins that hold a wanted rank stay, and they are cut again until every bin is small enough to sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.plans.lineage import stored


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    bins: int = 64,
    small: int = 50_000,
) -> DataFrame:
    """One row per group with a linearly interpolated quantile per name in ``probs``.

    ``small`` is the number of distinct values that one task sorts.
    """
    keys = list(keys)
    by = keys or ["__all"]
    rows = df if keys else df.withColumn("__all", F.lit(0))
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    live = stored(counts.withColumn("__bin", F.lit("")), "quantile-counts")

    def place(p: float):
        return F.lit(p) * (F.col("__total") - 1)

    asked = [
        F.struct(F.lit(f"__{tag}_{name}").alias("__name"), f(place(p)).cast("long").alias("__rank"))
        for name, p in probs.items()
        for tag, f in (("lo", F.floor), ("hi", F.ceil))
    ]
    totals = live.groupBy(*by, "__bin").agg(F.sum("__n").alias("__total"))
    want = totals.select(*by, "__bin", "__total", F.inline(F.array(*asked)))
    grid = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    within = [*by, "__bin"]
    while (live.groupBy(*within).count().agg(F.max("count")).first()[0] or 0) > small:
        cuts = live.groupBy(*within).agg(F.percentile_approx("__v", grid, F.lit(2000)).alias("__cuts"))
        number = F.size(F.filter("__cuts", lambda c: c < F.col("__v")))
        finer = live.join(cuts, within).withColumn("__next", F.concat("__bin", F.lpad(number.cast("string"), 5, "0")))
        sizes = finer.groupBy(*within, "__next").agg(F.sum("__n").alias("__size"))
        before = Window.partitionBy(*within).orderBy("__next").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("__start", F.coalesce(F.sum("__size").over(before), F.lit(0)))
        here = (F.col("__rank") >= F.col("__start")) & (F.col("__rank") < F.col("__start") + F.col("__size"))
        want = want.join(sizes, within).where(here).withColumn("__rank", F.col("__rank") - F.col("__start"))
        want = stored(want.select(*by, F.col("__next").alias("__bin"), "__total", "__name", "__rank"), "quantile-ranks")
        finer = finer.select(*by, F.col("__next").alias("__bin"), "__v", "__n")
        live = stored(finer.join(want.select(*within).distinct(), within, "left_semi"), "quantile-counts")

    end = F.sum("__n").over(Window.partitionBy(*within).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    found = live.withColumn("__end", end).join(want, within)
    found = found.where((F.col("__rank") < F.col("__end")) & (F.col("__rank") >= F.col("__end") - F.col("__n")))
    cells = [F.max(F.when(F.col("__name") == f"__{tag}_{name}", F.col("__v"))).alias(f"__{tag}_{name}") for name in probs for tag in ("lo", "hi")]
    got = found.groupBy(*by).agg(F.max("__total").alias("__total"), *cells)
    out = []
    for name, p in probs.items():
        lo, hi = F.col(f"__lo_{name}").cast("double"), F.col(f"__hi_{name}").cast("double")
        out.append((lo + (hi - lo) * (place(p) - F.floor(place(p)))).alias(name))
    return got.select(*keys, *out)
