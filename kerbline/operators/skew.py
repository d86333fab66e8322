"""Equi-join that splits hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART, PARTS = "__part", "__parts"


def hot_key_join(many: DataFrame, few: DataFrame, keys: list[str], hot_rows: int, by_few: bool = False) -> DataFrame:
    """Inner join in which a key with many rows of ``many`` is cut into parts.

    Rows are counted per key first (partial aggregation, one small row per key and task). A
    key with more than ``hot_rows`` rows is cut into parts of about that size, whatever the
    size of the table. The rows of a hot key get a part number by hash and the matching rows of
    ``few`` are copied to every part, so the result is whole and no task receives the whole key.
    The list of hot keys has at most one row per ``hot_rows`` rows of ``many``: it is broadcast,
    so that both sides are shuffled once, for the join itself.

    ``few`` usually comes from an ``explode``, which Spark's size estimates do not see: rows
    that are many times the table they stem from would be broadcast through the driver. The
    join is therefore asked for as a sort-merge join. With ``by_few`` the rows of
    ``few`` are the outer side, so that all partners of one come in a row; without it those
    of ``many`` are.
    """
    counts = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    load = counts.select(*keys, F.ceil(F.col("__n") / hot_rows).cast("long").alias(PARTS))
    hot = F.broadcast(load.filter(F.col(PARTS) > 1))
    zero = F.lit(0).cast("long")
    copies = few.join(hot, keys, "left").withColumn(
        PART, F.explode(F.sequence(zero, F.coalesce(F.col(PARTS) - 1, zero)))
    ).drop(PARTS)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in many.columns]), F.col(PARTS))
    salted = many.join(hot, keys, "left").withColumn(PART, F.coalesce(salt, zero)).drop(PARTS)
    outer, inner = (copies, salted) if by_few else (salted, copies)
    return outer.hint("merge").join(inner, [*keys, PART]).drop(PART)
