"""Fix and pose validity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RTK_STATUS, RTK_VARIANCE = 2, 0.1


def valid_fix(df: DataFrame) -> DataFrame:
    """The receiver has a fix and the place is not near zero."""
    return df.filter((F.col("status") >= 0) & (F.abs("lat") >= 0.1) & (F.abs("lon") >= 0.0001))


def is_rtk(df: DataFrame) -> DataFrame:
    """RTK status with a small horizontal variance; a fix without covariance is not RTK."""
    worst = F.greatest(F.get("covariance", F.lit(0)), F.get("covariance", F.lit(4)))
    test = (F.col("status") >= RTK_STATUS) & (worst < RTK_VARIANCE)
    return df.withColumn("is_rtk", F.coalesce(test, F.lit(False)))


def valid_pose(df: DataFrame) -> DataFrame:
    """Finite position and a quaternion of about unit length."""
    norm = F.sqrt(sum((F.col(f"q{a}") * F.col(f"q{a}") for a in "yzw"), F.col("qx") * F.col("qx")))
    finite = F.greatest(*[F.abs(c) for c in "xyz"]) < float("inf")
    return df.filter(finite & norm.between(0.9, 1.1))
