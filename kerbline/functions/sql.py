"""Scalar helpers as temporary SQL functions (X3); Catalyst inlines their bodies."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "plan_distance": (
        "x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE", "DOUBLE",
        "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))",
    ),
    "plan_bearing": (
        "x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE", "DOUBLE",
        "pmod(degrees(atan2(x2 - x1, y2 - y1)), 360D)",
    ),
    "relative_angle": ("heading DOUBLE, target DOUBLE", "DOUBLE", "pmod(heading - target, 360D)"),
    "camera_perp_angle": (
        "rel DOUBLE, side STRING", "DOUBLE",
        "CASE side WHEN 'left' THEN least(abs(rel - 90), 360 - abs(rel - 90)) "
        "WHEN 'right' THEN least(abs(rel - 270), 360 - abs(rel - 270)) ELSE 180D END",
    ),
    "hero_score": ("perp DOUBLE, dist DOUBLE", "DOUBLE", "perp + abs(dist - 32.5D) * 0.3D"),
    "wrap180": (
        "d DOUBLE", "DOUBLE",
        "CASE WHEN d > 180 THEN d - 360 WHEN d < -180 THEN d + 360 ELSE d END",
    ),
    "uuid5_digest": ("name STRING", "STRING", "sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(name, 'UTF-8'))"),
    "uuid5_dns": (
        "name STRING", "STRING",
        "concat_ws('-', substr(uuid5_digest(name), 1, 8), substr(uuid5_digest(name), 9, 4), '5' || substr(uuid5_digest(name), 14, 3), "
        "lower(hex(CAST(conv(substr(uuid5_digest(name), 17, 1), 16, 10) AS INT) % 4 + 8)) || substr(uuid5_digest(name), 18, 3), "
        "substr(uuid5_digest(name), 21, 12))",
    ),
    "quat_yaw": (
        "qx DOUBLE, qy DOUBLE, qz DOUBLE, qw DOUBLE", "DOUBLE",
        "atan2(2 * (qw * qz + qx * qy), 1 - 2 * (qy * qy + qz * qz))",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create every helper as a temporary function and return their names."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
