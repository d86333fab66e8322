"""Exact ranks of large groups: quantiles, and the rows up to a rank.

``percentile`` keeps every distinct value of a group in one aggregation buffer. Here the
values of all groups are counted in bins first (a histogram per group, merged on the way), a
window over the bins finds those that hold the wanted ranks, and only rows of those bins are
read again, in finer ones. Bins are taken on ``asinh`` so that their number is bounded for any
spread of values: each level has at most about 1,400 x ``bins_per_unit`` bins on the first
level and ``fan_out`` below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.session import settle

V = "__v"
RANK = "__rank"
TOTAL = "__total"
COUNTED = 4096


def _targets(df: DataFrame, by: list[str], bin_cols: list[str], wanted: DataFrame | None,
             qs: list[float]) -> DataFrame:
    """Bins that contain a wanted rank, with the number of rows before each bin."""
    counts = df.groupBy(*by, *bin_cols).agg(F.count(F.lit(1)).alias("__n"))
    if wanted is None:
        totals = counts.groupBy(*by).agg(F.sum("__n").alias(TOTAL))
        last = F.col(TOTAL) - 1
        spots = F.array(*[f(F.lit(q) * last) for q in qs for f in (F.floor, F.ceil)])
        wanted = totals.select(
            *by, TOTAL, F.explode(F.array_distinct(spots)).alias(RANK), F.lit(0).cast("long").alias("__base")
        )
    upper = [*by, *bin_cols[:-1]]
    ranked = counts.join(wanted, upper) if upper else counts.crossJoin(F.broadcast(wanted))
    order = Window.partitionBy(*upper, RANK).orderBy(bin_cols[-1])
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranked.withColumn("__start", F.col("__base") + F.sum("__n").over(upto) - F.col("__n"))
    hit = (F.col(RANK) >= F.col("__start")) & (F.col(RANK) < F.col("__start") + F.col("__n"))
    return placed.filter(hit).select(*by, TOTAL, *bin_cols, RANK, F.col("__start").alias("__base"))


def exact_quantiles(df: DataFrame, by: list[str], value: Column, qs: dict[str, float],
                    bins_per_unit: int = 64, fan_out: int = 4096) -> DataFrame:
    """One row per group with linearly interpolated quantiles named by ``qs``.

    Null, NaN and infinite values are left out. ``df`` is read three times, so it should be a
    table or a settled result. With no group columns the wanted ranks are at most two rows per
    quantile, so pairing them with the bins is bounded.
    """
    finite = F.abs(value) < float("inf")  # NaN sorts above infinity, null gives null
    rows = df.filter(finite).select(*by, value.cast("double").alias(V))
    scaled = F.asinh(F.col(V)) * bins_per_unit
    binned = rows.select(
        *by, V,
        F.floor(scaled).alias("__b1"),
        F.floor((scaled - F.floor(scaled)) * fan_out).alias("__b2"),
    )
    levels = list(qs.values())
    first = _targets(binned, by, ["__b1"], None, levels)
    keys1, keys2 = [*by, "__b1"], [*by, "__b1", "__b2"]
    second = _targets(binned.join(first.select(*keys1).distinct(), keys1, "left_semi"), by, ["__b1", "__b2"],
                      first, levels)
    third = _targets(binned.join(second.select(*keys2).distinct(), keys2, "left_semi"), by, ["__b1", "__b2", V],
                     second, levels)

    def at(q: float) -> Column:
        spot = F.lit(q) * (F.col(TOTAL) - 1)
        low = F.max(F.when(F.col(RANK) == F.floor(spot), F.col(V)))
        high = F.max(F.when(F.col(RANK) == F.ceil(spot), F.col(V)))
        return low + (high - low) * F.max(spot - F.floor(spot))

    return third.groupBy(*by).agg(*[at(q).alias(n) for n, q in qs.items()])


def _ranked(df: DataFrame, column: str, n: int, newest: bool) -> int:
    """The ``n``-th value of a BIGINT column, from the greatest or the least on; ``df`` has at least ``n`` rows.

    The range that holds it is cut into ``COUNTED`` bins and counted until a bin is one value.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) // COUNTED + 1
        place = F.floor((F.col(column) - low) / width) if width < 2**20 else F.expr(f"({column} - {low}) div {width}")
        counts = df.where(F.col(column).between(low, high)).groupBy(place.cast("long").alias("b")).count().collect()
        for b, count in sorted(((r["b"], r["count"]) for r in counts), reverse=newest):
            if count >= n:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            n -= count
    return low


def first_rows(df: DataFrame, n: int, order: list[tuple[str, bool]]) -> DataFrame:
    """The first ``n`` rows by BIGINT columns, each given with whether its greatest values come first.

    No task sorts more than its own rows: column by column the value at the rank is found by
    counting, the rows before it stay, and the next column decides among those that share it.
    Rows equal in all columns are taken or left together if the rank falls among them.
    """
    rows, kept, left = settle(df), [], n
    for column, newest in order:
        if rows.count() <= left:
            break
        value = _ranked(rows, column, left, newest)
        ahead = rows.where(F.col(column) > value if newest else F.col(column) < value)
        kept.append(ahead)
        left -= ahead.count()
        rows = rows.where(F.col(column) == value)
    for part in kept:
        rows = rows.unionByName(part)
    return rows
