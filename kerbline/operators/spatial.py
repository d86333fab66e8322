"""Radius joins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions.geo import as_col, distance
from kerbline.operators.skew import hot_key_join

HOT_CELL_ROWS = 200_000

#: Rows of one place that travel together.
PLACE_ROWS = 1_000


def gathered(props: DataFrame, most: int = PLACE_ROWS) -> DataFrame:
    """The rows of ``props`` by place: ``x, y, rows``, so that a place meets a frame once, not each of its rows.

    ``rows`` holds the other columns. A place with more than ``most`` rows is cut by hash into parts
    of about that size; their list is broadcast and has at most one row per ``most`` of ``props``.
    :func:`unfolded` makes rows of the pairs again. Rows without a place are near nothing and left out.
    """
    own = [c for c in props.columns if c not in ("x", "y")]
    placed = props.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    load = placed.groupBy("x", "y").agg(F.ceil(F.count(F.lit(1)) / most).cast("long").alias("__parts"))
    many = F.broadcast(load.filter(F.col("__parts") > 1))
    part = F.coalesce(F.pmod(F.xxhash64(*own), F.col("__parts")), F.lit(0).cast("long"))
    cut = placed.join(many, ["x", "y"], "left").select("x", "y", F.struct(*own).alias("__row"), part.alias("__part"))
    return cut.groupBy("x", "y", "__part").agg(F.collect_list("__row").alias("rows")).drop("__part")


def unfolded(pairs: DataFrame) -> DataFrame:
    """One row per (frame, property) from pairs of frames and :func:`gathered` places: ``p_rows`` gives ``p_`` columns."""
    if "p_rows" not in pairs.columns:
        return pairs
    each = pairs.select(*[c for c in pairs.columns if c != "p_rows"], F.explode("p_rows").alias("__row"))
    own = pairs.schema["p_rows"].dataType.elementType.names
    return each.select(*[c for c in each.columns if c != "__row"], *[F.col("__row")[c].alias(f"p_{c}") for c in own])


def grid_radius_join(frames: DataFrame, props: DataFrame, radius: float, cell: float | None = None,
                     window: int | None = None, by: list[str] | None = None,
                     hot_rows: int | None = HOT_CELL_ROWS) -> DataFrame:
    """Pairs within ``radius`` by an equi-join on grid cells, exact distance last.

    ``window`` is the number of neighbour cells on each side; the default reaches the whole
    radius, ``window=1`` with 50 m cells gives a 3x3 block that can miss pairs beyond 50 m.
    The default cell is half the radius: 5x5 cells that hold 2.0 times the area of the circle. Properties are the smaller side, so they
    are copied to the cells around them that have a place within the radius. A cell with
    more than ``hot_rows`` frames (a parked vehicle) is split: its frames get a part number
    and its properties are copied to every part, so no task receives the whole cell.
    ``hot_rows=None`` leaves skew to adaptive execution.
    """
    by, cell = by or [], cell or radius / 2
    reach = math.ceil(radius / cell) if window is None else window
    offsets = F.array(*[F.lit(i) for i in range(-reach, reach + 1)])
    placed = frames.withColumn("__gx", F.floor(F.col("x") / cell)).withColumn(
        "__gy", F.floor(F.col("y") / cell)
    )
    cells = ["__gx", "__gy"]
    own = [c for c in props.columns if c not in by]
    spread = (
        props.select(*by, *[F.col(c).alias(f"p_{c}") for c in own])
        .withColumn("__ox", F.explode(offsets))
        .withColumn("__oy", F.explode(offsets))
        .withColumn("__gx", F.floor(F.col("p_x") / cell) + F.col("__ox"))
        .withColumn("__gy", F.floor(F.col("p_y") / cell) + F.col("__oy"))
        .drop("__ox", "__oy")
    )
    # distance to the nearest place of the cell, with room for rounding at its edges
    aside, ahead = (F.greatest(F.col(g) * cell - F.col(p), F.col(p) - (F.col(g) + 1) * cell, F.lit(0.0)) for g, p in zip(cells, ("p_x", "p_y"), strict=True))
    slack = (F.abs("p_x") + F.abs("p_y") + radius) * 1e-9
    spread = spread.filter(F.sqrt(aside * aside + ahead * ahead) <= radius + slack)
    keys = [*by, *cells]
    # property by property, so that what is counted or picked per property comes in a row
    pairs = hot_key_join(placed, spread, keys, hot_rows, by_few=True) if hot_rows else placed.join(spread.hint("merge"), keys)
    gap = distance("x", "y", "p_x", "p_y")
    return (
        pairs
        .withColumn("distance_m", gap)
        .filter(F.col("distance_m") <= radius)
        .select(*frames.columns, *[f"p_{c}" for c in own], "distance_m")
    )


def radius_join_small(frames: DataFrame, props: DataFrame, radius: float) -> DataFrame:
    """All pairs within a radius, at any number of properties: the grid join with cells of that size."""
    return grid_radius_join(frames, props, radius, cell=max(radius, 1.0))
