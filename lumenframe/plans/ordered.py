"""Running values over a long order without a long task.

A plain window over one hot key, or over no key, sorts the whole group in one
task.  Here every order is cut into *slots*: a slot is any expression that never
decreases along the order (an hour of a timestamp, a prefix of a name, the high
part of a number).  Work inside a slot is an ordinary window on (keys, slot); what
the slots before it contribute comes from a summary with one row per slot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLOT = "__slot"


def _order(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _combine(how: str, carried: Column, inside: Column) -> Column:
    if how == "sum":
        return F.coalesce(carried, F.lit(0)) + F.coalesce(inside, F.lit(0))
    if how == "max":
        return F.greatest(carried, inside)
    if how == "min":
        return F.least(carried, inside)
    return F.coalesce(inside, carried)


_FOLD = {"sum": F.sum, "max": F.max, "min": F.min}


def prior(
    df: DataFrame,
    keys: Sequence[str],
    slot: Column,
    order: Sequence[Column | str],
    specs: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Add, per spec, the value folded over all rows *before* the current one.

    ``specs`` maps an output name to ``(how, value)``; ``how`` is sum, max, min or
    last.  ``last`` wants a value that is never NULL (wrap it in a struct) and, like
    the slots, an ascending order.  With no row before, sum gives 0 and the others NULL.
    """
    keys = list(keys)
    parts = [*keys, _SLOT]
    by = _order(order)
    rows = df.withColumn(_SLOT, slot)
    for name, (_, value) in specs.items():
        rows = rows.withColumn(f"__v_{name}", value)

    sums = []
    for name, (how, _) in specs.items():
        v = F.col(f"__v_{name}")
        total = F.max_by(v, F.struct(*by)) if how == "last" else _FOLD[how](v)
        sums.append(total.alias(f"__t_{name}"))
    across = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(_SLOT)
    across = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*parts).agg(*sums)
    carried = carried.select(
        *parts,
        *[
            (
                F.last(f"__t_{n}", ignorenulls=True)
                if how == "last"
                else _FOLD[how](F.col(f"__t_{n}"))
            )
            .over(across)
            .alias(f"__c_{n}")
            for n, (how, _) in specs.items()
        ],
    )

    inside = Window.partitionBy(*parts).orderBy(*by)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(c) for c in df.columns]
    for name, (how, _) in specs.items():
        v = F.col(f"__v_{name}")
        local = F.lag(v).over(inside) if how == "last" else _FOLD[how](v).over(upto)
        cols.append(_combine(how, F.col(f"__c_{name}"), local).alias(name))
    return rows.join(carried, parts).select(*cols)


def numbered_runs(
    df: DataFrame,
    keys: Sequence[str],
    slot: Column,
    order: Sequence[Column | str],
    fields: Sequence[str],
    opens: Callable[[Column, Column], Column],
    out: str,
) -> DataFrame:
    """Number the runs of each order from 1; ``opens(row, row before)`` tells where a run begins.

    Both arguments are structs of ``fields``; the first row of an order always begins a run.  What
    the head of a slot compares with, and how many runs began before, come from one summary with
    a row per slot, so the order is walked once.
    """
    keys = list(keys)
    parts = [*keys, _SLOT]
    by = _order(order)
    inside = Window.partitionBy(*parts).orderBy(*by)
    rows = df.withColumn(_SLOT, slot).withColumn("__here", F.struct(*fields))
    rows = rows.withColumn("__before", F.lag("__here").over(inside))
    flag = F.when(F.col("__before").isNotNull(), opens(F.col("__here"), F.col("__before")))
    rows = rows.withColumn("__open", F.coalesce(flag, F.lit(False)).cast("long"))
    rows = rows.withColumn("__count", F.sum("__open").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    heads = rows.groupBy(*parts).agg(
        F.min_by("__here", F.struct(*by)).alias("__first"), F.max_by("__here", F.struct(*by)).alias("__last"), F.sum("__open").alias("__inner")
    )
    across = Window.partitionBy(*keys).orderBy(_SLOT)
    heads = heads.withColumn("__prior", F.lag("__last").over(across))
    begins = F.when(F.col("__prior").isNull(), F.lit(True)).otherwise(F.coalesce(opens(F.col("__first"), F.col("__prior")), F.lit(False)))
    heads = heads.withColumn("__head", begins.cast("long"))
    earlier = F.sum(F.col("__inner") + F.col("__head")).over(across.rowsBetween(Window.unboundedPreceding, -1))
    heads = heads.select(*parts, (F.coalesce(earlier, F.lit(0)) + F.col("__head")).alias("__start"))
    return rows.join(heads, parts).select(*df.columns, (F.col("__start") + F.col("__count")).alias(out))


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    slot: Column,
    order: Sequence[Column | str],
    out: str = "rn",
) -> DataFrame:
    """``row_number`` over (slot, order) within ``keys``; the slot must follow the order."""
    got = prior(df, keys, slot, order, {out: ("sum", F.lit(1).cast("long"))})
    return got.withColumn(out, F.col(out) + 1)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    slot: Column,
    order: Sequence[Column | str],
    value: Column,
    out: str,
) -> DataFrame:
    """Inclusive running sum."""
    got = prior(df, keys, slot, order, {out: ("sum", value)})
    return got.withColumn(out, F.col(out) + value)


def range_sums(
    points: DataFrame,
    keys: Sequence[str],
    pos: str,
    values: Sequence[str],
    reach: int,
    slot_width: int,
) -> DataFrame:
    """For every point, the sums of ``values`` over all points of its group within ``reach``.

    ``pos`` is an integer and unique in its group.  Each point asks for two prefix sums, so
    the cost is linear: no pair of points is ever formed.
    """
    keys = list(keys)

    def mark(at: Column, kind: int, sign: int) -> Column:
        carried = [F.col(v) if kind == 0 else F.lit(0).cast(points.schema[v].dataType) for v in values]
        return F.struct(
            at.alias("__at"),
            F.lit(kind).alias("__kind"),
            F.lit(sign).alias("__sign"),
            *[c.alias(f"__x_{v}") for c, v in zip(carried, values)],
        )

    # the point itself, and the two places where it asks for the sum so far
    marks = F.array(mark(F.col(pos), 0, 0), mark(F.col(pos) - reach - 1, 1, -1), mark(F.col(pos) + reach, 1, 1))
    events = points.select(*keys, F.col(pos).alias("__of"), F.inline(marks))
    run = prior(
        events,
        keys,
        number_slot("__at", slot_width),
        ["__at", "__kind", "__of", "__sign"],
        {f"__s_{v}": ("sum", F.col(f"__x_{v}")) for v in values},
    )
    got = run.where("__kind = 1").groupBy(*keys, F.col("__of").alias(pos))
    return got.agg(*[F.sum(F.col(f"__s_{v}") * F.col("__sign")).alias(f"near_{v}") for v in values])


def digest(seed: int | str, *key: Column | str) -> Column:
    """The seeded order that stands in for a random one."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *_order(key)))


def digest_slot(col: Column | str, digits: int = 3) -> Column:
    """Even slots along a digest: 16**digits of them."""
    return F.substring(col, 1, digits)


def time_slot(t_us: Column | str, hours: int = 1) -> Column:
    c = F.col(t_us) if isinstance(t_us, str) else t_us
    return F.floor(c / F.lit(hours * 3_600_000_000)).cast("long")


def number_slot(n: Column | str, width: int = 4096) -> Column:
    c = F.col(n) if isinstance(n, str) else n
    return F.floor(c / F.lit(width)).cast("long")


def total_of(df: DataFrame, *aggs: Column) -> DataFrame:
    """A global aggregate: one row by construction."""
    return df.agg(*aggs)


def with_total(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach a one-row total to every row, as a scalar subquery: no join, no shuffle."""
    names = totals.columns
    one = totals.select(F.struct(*names)).scalar()
    return df.select("*", one.alias("__total_row")).select(*df.columns, *[F.col(f"__total_row.{n}").alias(n) for n in names])
