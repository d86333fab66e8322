"""Ground split of a scan by concentric zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions.labels import sector_of, zone_of
from kerbline.functions.linear import SIX, plane_normal
from kerbline.operators.points import _finite
from kerbline.operators.windows import top_k
from kerbline.session import settle


def ground_split(points: DataFrame, scan: list[str], point_id: str, min_range: float = 2.0,
                 max_range: float = 80.0, zones: int = 4, sectors: int = 16, seeds: int = 20,
                 uprightness: float = 0.7) -> DataFrame:
    """Adds ``is_ground``; invalid or far points are never ground.

    Seeds are the lowest points of each (scan, zone, sector): at most ``seeds`` and at most a
    third of the cell. The rank is cut to ``seeds`` before the shuffle, the plane comes from
    six sums per cell in closed form. A cell whose seeds fit more than one plane has no ground.
    """
    valid = _finite("x") & _finite("y") & _finite("z")
    cut = points.withColumn(
        "__zone", F.when(valid, zone_of("x", "y", min_range, max_range, zones))
    ).withColumn("__sector", F.when(valid, sector_of("x", "y", sectors)))
    cell = [*scan, "__zone", "__sector"]
    placed = cut.filter(F.col("__zone").isNotNull())
    sizes = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n"))
    low = top_k(placed.select(*cell, "x", "y", "z", point_id), cell, [F.asc("z"), F.asc(point_id)], seeds)
    low = low.join(sizes, cell).filter(F.col("rank") <= F.floor(F.col("__n") / 3))
    fit = low.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("__k"), *[F.avg(a).alias(f"__c{a}") for a in "xyz"],
        *[F.covar_pop(F.col(k[0]).cast("double"), F.col(k[1]).cast("double")).alias(f"__m{k}") for k in SIX],
    ).filter(F.col("__k") >= 3)
    normal = ("__nx", "__ny", "__nz")
    # one small row per cell; settled, since a filter would be pushed into the closed form and repeat it
    fit = settle(plane_normal(fit, {k: F.col(f"__m{k}") for k in SIX}, normal).select(*cell, *[f"__c{a}" for a in "xyz"], *normal))
    planes = fit.filter(F.col("__nz") >= uprightness)
    rows = cut.join(planes, cell, "left")
    off = sum(((F.col(a) - F.col(f"__c{a}")) * F.col(f"__n{a}") for a in "yz"), (F.col("x") - F.col("__cx")) * F.col("__nx"))
    limit = (0.1 + 0.05 * F.col("__zone")) * (1 + F.col("__zone") * 0.2)
    ground = F.coalesce(F.abs(off) < limit, F.lit(False))
    return rows.select(*points.columns, ground.alias("is_ground"))
