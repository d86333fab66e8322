"""Camera projection models as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbline.functions.geo import as_col
from kerbline.functions.pose import apply_t

MIN_DEPTH_M = 0.1


def _camera_frame(p, rotation, translation):
    return apply_t((rotation, translation), p)


def bend_pinhole(a, b, r2, k, d) -> tuple[Column, Column]:
    """F18 after the division by depth: (u, v) of the direction (a, b) with ``r2 = a * a + b * b``."""
    a, b, r2 = map(as_col, (a, b, r2))
    fx, fy, cx, cy = map(as_col, k)
    k1, k2, p1, p2, k3 = map(as_col, d)
    radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    u = a * radial + 2 * p1 * a * b + p2 * (r2 + 2 * a * a)
    v = b * radial + p1 * (r2 + 2 * b * b) + 2 * p2 * a * b
    return fx * u + cx, fy * v + cy


def bend_fisheye(a, b, r, theta, k, d) -> tuple[Column, Column]:
    """F19 after the division by depth: (u, v) of the direction (a, b) with ``r`` its length, ``theta`` its angle."""
    a, b, r, theta = map(as_col, (a, b, r, theta))
    fx, fy, cx, cy = map(as_col, k)
    k1, k2, k3, k4 = map(as_col, d)
    t2 = theta * theta
    bent = theta * (1 + t2 * (k1 + t2 * (k2 + t2 * (k3 + t2 * k4))))
    scale = F.when(r > 1e-8, bent / r).otherwise(F.lit(1.0))
    return fx * a * scale + cx, fy * b * scale + cy


def project_pinhole(p, rotation, translation, k, d) -> tuple[Column, Column, Column]:
    """(u, v, depth) with the published radial-tangential model.

    ``k`` = (fx, fy, cx, cy), ``d`` = (k1, k2, p1, p2, k3).
    """
    xc, yc, zc = _camera_frame(p, rotation, translation)
    a, b = xc / zc, yc / zc
    return (*bend_pinhole(a, b, a * a + b * b, k, d), zc)


def project_fisheye(p, rotation, translation, k, d) -> tuple[Column, Column, Column]:
    """(u, v, depth) with the equidistant model, ``d`` = (k1, k2, k3, k4)."""
    xc, yc, zc = _camera_frame(p, rotation, translation)
    a, b = xc / zc, yc / zc
    r = F.sqrt(a * a + b * b)
    return (*bend_fisheye(a, b, r, F.atan(r), k, d), zc)


def in_image(u, v, depth, width, height) -> Column:
    """In front of the camera and inside the picture."""
    u, v = as_col(u), as_col(v)
    return (
        (as_col(depth) > MIN_DEPTH_M)
        & (u >= 0) & (u < as_col(width)) & (v >= 0) & (v < as_col(height))
    )
