"""Greedy chains: from each taken row on to the first one at least a step further.

The next taken row depends on the last, but each row knows its own successor, the first row
whose value is at least a step above its own. Successors form a forest, and the chain is the
path from the start. Rows are numbered along each key, so blocks of equal length cut it
anywhere; each block contracts its inside to one edge per row, to the first row beyond it. Of
these only the edges of rows that some edge leads to matter, few, as paths run together. Which
of them the start reaches is found by pointer doubling, in as many joins as the number of
blocks has binary digits, and each block then follows its one path from where it is entered.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.operators.ordered import PART_ROWS, match, row_index, scan
from kerbline.session import settle

POS, SUCC, BLOCK = "__pos", "__succ", "__block"
#: How finely values are told apart when rows are dealt to parts, in shares of a step.
FINE = 64


def _successors(placed: DataFrame, by: list[str], value: str, step: float, part_rows: int) -> DataFrame:
    """``by``, ``POS`` and ``SUCC`` (null at the end) of each row."""
    own = placed.select(*by, F.col(value).cast("double").alias("__v"), F.lit(1).alias("__side"), POS)
    asked = placed.select(*by, (F.col(value) + F.lit(step)).cast("double").alias("__v"), F.lit(0).alias("__side"), POS)
    both = own.unionByName(asked).withColumn("__at", F.floor(F.col("__v") / step * FINE).cast("long"))
    found = scan(both, by, ["__at", "__v", "__side", POS], ahead={SUCC: F.when(F.col("__side") == 1, F.col(POS))}, part_rows=part_rows)
    return found.where("__side = 0").select(*by, POS, SUCC)


def _contract(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(POS, ignore_index=True)
    first, ahead = int(frame[POS].iloc[0]), frame[SUCC].tolist()
    beyond = [None] * len(frame)
    for i in range(len(frame) - 1, -1, -1):
        to = ahead[i]
        if to == to and to is not None:  # pandas marks a null as NaN
            to = int(to)
            beyond[i] = beyond[to - first] if to - first < len(frame) else to
    return frame.drop(columns=[SUCC]).assign(__beyond=pd.array(beyond, "Int64"))


def greedy_chain(df: DataFrame, by: list[str], order: list[str], value: str, step: float, start: float | None = None,
                 part_rows: int = PART_ROWS) -> DataFrame:
    """The rows of ``df`` on the chain of each key.

    ``value`` must not fall along ``order``. The chain begins with the first row, or with the
    first whose value is at least ``start``, and goes on with the first row whose value is at
    least ``step`` above that of the last one taken. Rows without a value come first and are
    never taken.
    """
    rows = df.where(F.col(value).isNotNull())
    placed = settle(row_index(rows, by, order, POS, part_rows))
    edges = _successors(placed, by, value, step, part_rows).withColumn(BLOCK, F.expr(f"{POS} div {part_rows}"))
    edges = settle(edges)
    keys = [edges.schema[c] for c in by]
    long = T.LongType()
    beyond = T.StructType([*keys, T.StructField(POS, long), T.StructField(BLOCK, long), T.StructField("__beyond", long)])
    away = settle(edges.groupBy(*by, BLOCK).applyInPandas(_contract, beyond))
    begun = placed if start is None else placed.where(F.col(value) >= start)
    heads = settle(begun.groupBy(*by).agg(F.min(POS).alias("__at")))
    gates = heads.unionByName(away.where("__beyond IS NOT NULL").select(*by, F.col("__beyond").alias("__at"))).distinct()
    hops = match(away.select(*by, F.col(POS).alias("__at"), "__beyond"), gates, [*by, "__at"], "left_semi").where("__beyond IS NOT NULL")
    hops = settle(hops.select(*by, "__at", F.col("__beyond").alias("__to")))
    reached = heads
    blocks = (edges.agg(F.max(BLOCK)).first()[0] or 0) + 1
    for _ in range(blocks.bit_length()):
        landed = match(reached, hops, [*by, "__at"]).select(*by, F.col("__to").alias("__at"))
        reached = settle(reached.unionByName(landed).distinct())
        twice = hops.select(*by, F.col("__at").alias("__from"), F.col("__to").alias("__at"))
        hops = settle(match(twice, hops, [*by, "__at"]).select(*by, F.col("__from").alias("__at"), "__to"))

    def follow(inside: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        if inside.empty or entered.empty:
            return inside.head(0).drop(columns=[SUCC, BLOCK])
        inside = inside.sort_values(POS, ignore_index=True)
        first, ahead, taken = int(inside[POS].iloc[0]), inside[SUCC].tolist(), []
        for at in entered["__at"]:
            at = int(at) - first
            while at < len(ahead):
                taken.append(at)
                if ahead[at] is None or ahead[at] != ahead[at]:
                    break
                at = int(ahead[at]) - first
        return inside.iloc[taken].drop(columns=[SUCC, BLOCK])

    entered = reached.withColumn(BLOCK, F.expr(f"__at div {part_rows}"))
    taken = edges.groupBy(*by, BLOCK).cogroup(entered.groupBy(*by, BLOCK)).applyInPandas(follow, T.StructType([*keys, T.StructField(POS, long)]))
    taken = settle(taken)
    return match(placed, taken, [*by, POS], "left_semi").select(*df.columns)
