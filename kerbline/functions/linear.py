"""Small linear algebra as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIX = ("xx", "xy", "xz", "yy", "yz", "zz")


def plane_normal(df: DataFrame, moments: dict[str, Column], names: tuple[str, str, str] = ("nx", "ny", "nz")) -> DataFrame:
    """Add the upward unit normal of the best plane, from the six entries of a covariance matrix.

    The least eigenvalue of a symmetric 3x3 matrix has a closed form by the cosine of a third of
    an angle; its eigenvector is orthogonal to all rows of the matrix less that eigenvalue, so it
    is the cross product of two of them, the longest of the three. The normal is null where
    the points fit more than one plane (on a line or in one place) or an entry is null.
    """
    rows = df.withColumns({f"__{k}": moments[k].cast("double") for k in SIX})
    xx, xy, xz, yy, yz, zz = (F.col(f"__{k}") for k in SIX)
    rows = rows.withColumn("__q", (xx + yy + zz) / 3)
    a, b, c = xx - F.col("__q"), yy - F.col("__q"), zz - F.col("__q")
    rows = rows.withColumn("__p", F.sqrt((a * a + b * b + c * c + 2 * (xy * xy + xz * xz + yz * yz)) / 6))
    half = (a * (b * c - yz * yz) - xy * (xy * c - yz * xz) + xz * (xy * yz - b * xz)) / (2 * F.pow("__p", F.lit(3.0)))
    turn = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), half))) / 3
    rows = rows.withColumn("__l", F.when(F.col("__p") > 0, F.col("__q") + 2 * F.col("__p") * F.cos(turn + 2 * math.pi / 3)))
    first, second, third = (xx - F.col("__l"), xy, xz), (xy, yy - F.col("__l"), yz), (xz, yz, zz - F.col("__l"))
    for i, (u, v) in enumerate(((first, second), (first, third), (second, third))):
        cross = (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
        rows = rows.withColumns({f"__{n}{i}": w for n, w in zip("uvw", cross)})
        rows = rows.withColumn(f"__s{i}", sum((F.col(f"__{n}{i}") * F.col(f"__{n}{i}") for n in "vw"), F.col(f"__u{i}") * F.col(f"__u{i}")))
    longest = F.greatest("__s0", "__s1", "__s2")
    rows = rows.withColumn("__len", F.when(longest > F.pow("__p", F.lit(4.0)) * 1e-12, F.sqrt(longest)))
    axis = [F.when(F.col("__s0") == longest, F.col(f"__{n}0")).when(F.col("__s1") == longest, F.col(f"__{n}1")).otherwise(F.col(f"__{n}2")) for n in "uvw"]
    up = F.when(axis[2] < 0, -F.col("__len")).otherwise(F.col("__len"))
    return rows.select(*df.columns, *[(x / up).alias(n) for n, x in zip(names, axis)])
