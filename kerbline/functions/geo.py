"""Planar and geographic helpers as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str | float | int

# Camera sectors in degrees, hero scoring.
FOV_SECTORS = {"left": (30, 150), "right": (210, 330), "rear": (120, 240)}
SIDE_AXIS_DEG = {"left": 90, "right": 270}
PERPENDICULAR_LIMIT_DEG = 15.0
HERO_DISTANCE_M = 32.5
HERO_DISTANCE_WEIGHT = 0.3
METRES_PER_DEGREE = 111000.0
METRES_PER_DEGREE_LOCAL = 111320.0


def as_col(value: ColumnLike) -> Column:
    """Names become columns, numbers become literals."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def degrees_360(angle: Column) -> Column:
    """Fold an angle in degrees into [0, 360)."""
    return F.pmod(angle, F.lit(360.0))


def distance(x1: ColumnLike, y1: ColumnLike, x2: ColumnLike, y2: ColumnLike) -> Column:
    dx, dy = as_col(x2) - as_col(x1), as_col(y2) - as_col(y1)
    return F.sqrt(dx * dx + dy * dy)


def distance3(x1, y1, z1, x2, y2, z2) -> Column:
    dx, dy, dz = (as_col(b) - as_col(a) for a, b in ((x1, x2), (y1, y2), (z1, z2)))
    return F.sqrt(dx * dx + dy * dy + dz * dz)


def bearing(x1: ColumnLike, y1: ColumnLike, x2: ColumnLike, y2: ColumnLike) -> Column:
    """Compass bearing from point 1 to point 2: 0 is north, clockwise."""
    return degrees_360(F.degrees(F.atan2(as_col(x2) - as_col(x1), as_col(y2) - as_col(y1))))


def relative_angle(
    heading: ColumnLike, target_bearing: ColumnLike, convention: str = "heading_minus_bearing"
) -> Column:
    """Angle of a target against the heading; 90 is left in the default convention."""
    h, b = as_col(heading), as_col(target_bearing)
    if convention == "heading_minus_bearing":
        return degrees_360(h - b)
    if convention == "bearing_minus_heading":
        return degrees_360(b - h)
    raise ValueError(f"unknown angle convention: {convention}")


def in_fov(rel: ColumnLike, side: ColumnLike) -> Column:
    """Is a relative angle inside the sector of the camera on ``side``?"""
    rel, side = as_col(rel), as_col(side)
    hit = F.lit(False)
    for name, (low, high) in FOV_SECTORS.items():
        hit = F.when(side == name, rel.between(low, high)).otherwise(hit)
    return hit


def fov_axis(heading: ColumnLike, side: ColumnLike, convention: str = "heading_minus_bearing") -> tuple[Column, Column, Column]:
    """Unit vector along the middle of the camera's sector, and the cosine of half its width.

    Null for other sides, and for headings so large that their angles are no longer exact.
    """
    turn = {"heading_minus_bearing": -1, "bearing_minus_heading": 1}.get(convention)
    if turn is None:
        raise ValueError(f"unknown angle convention: {convention}")
    heading, side = as_col(heading), as_col(side)
    middle, wide = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (low, high) in FOV_SECTORS.items():
        middle = F.when(side == name, F.lit(turn * (low + high) / 2)).otherwise(middle)
        wide = F.when(side == name, F.lit(math.cos(math.radians((high - low) / 2)))).otherwise(wide)
    ahead = F.radians(F.when(F.abs(heading) <= 100_000, heading) + middle)
    return F.sin(ahead), F.cos(ahead), wide


def in_fov_by_axis(dx: Column, dy: Column, ax: ColumnLike, ay: ColumnLike, wide: ColumnLike) -> Column:
    """:func:`in_fov` without an angle: null where the target is too near the edge of the sector to tell."""
    far = F.sqrt(dx * dx + dy * dy)
    gap = dx * as_col(ax) + dy * as_col(ay) - far * as_col(wide)
    return F.when((gap > far * 1e-7) & (gap <= far * 4), F.lit(True)).when(gap < far * -1e-7, F.lit(False))


def perp_angle(rel: ColumnLike, side: ColumnLike) -> Column:
    """Degrees away from looking straight sideways; 180 for any other camera."""
    rel, side = as_col(rel), as_col(side)
    axis = F.when(side == "left", F.lit(90.0)).when(side == "right", F.lit(270.0))
    off = F.abs(rel - axis)
    return F.coalesce(F.least(off, 360 - off), F.lit(180.0))


def hero_score(perp: ColumnLike, dist: ColumnLike) -> Column:
    """Lower is better: square-on and near the ideal distance."""
    return as_col(perp) + F.abs(as_col(dist) - HERO_DISTANCE_M) * HERO_DISTANCE_WEIGHT


def local_to_grid(x, y, z, theta_deg, ox, oy, oz) -> tuple[Column, Column, Column]:
    """rotate by the heading offset about z, then add the grid origin."""
    theta = F.radians(as_col(theta_deg))
    c, s = F.cos(theta), F.sin(theta)
    x, y = as_col(x), as_col(y)
    return c * x - s * y + as_col(ox), s * x + c * y + as_col(oy), as_col(z) + as_col(oz)


def wrap180(diff: ColumnLike) -> Column:
    """fold an angle difference of less than one turn into (-180, 180]."""
    d = as_col(diff)
    return F.when(d > 180, d - 360).when(d < -180, d + 360).otherwise(d)


def fix_distance(lat1, lon1, lat2, lon2) -> Column:
    """equirectangular metres, scaled at the second latitude."""
    dlat = (as_col(lat2) - as_col(lat1)) * METRES_PER_DEGREE
    dlon = (as_col(lon2) - as_col(lon1)) * METRES_PER_DEGREE * F.cos(F.radians(as_col(lat2)))
    return F.sqrt(dlat * dlat + dlon * dlon)


def arrow_end(lat, lon, heading_deg, length_m: float = 20.0) -> tuple[Column, Column]:
    """F16: (lat, lon) of a short arrow along the heading."""
    lat, lon, h = as_col(lat), as_col(lon), F.radians(as_col(heading_deg))
    end_lat = lat + length_m * F.cos(h) / METRES_PER_DEGREE_LOCAL
    end_lon = lon + length_m * F.sin(h) / (METRES_PER_DEGREE_LOCAL * F.cos(F.radians(lat)))
    return end_lat, end_lon


def bng_to_wgs84_local(x, y, ref: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """linear conversion around ``ref`` = (x, y, lat, lon); good within about 1 km."""
    rx, ry, rlat, rlon = ref
    lat = rlat + (as_col(y) - ry) / METRES_PER_DEGREE_LOCAL
    lon = rlon + (as_col(x) - rx) / (METRES_PER_DEGREE_LOCAL * math.cos(math.radians(rlat)))
    return F.round(lat, 7), F.round(lon, 7)


# Published Ordnance Survey constants for the British National Grid.
AIRY = (6377563.396, 6356256.909)
WGS84 = (6378137.0, 6356752.314245)
BNG_SCALE = 0.9996012717
BNG_TRUE_ORIGIN = (math.radians(49.0), math.radians(-2.0))
BNG_FALSE_ORIGIN = (400000.0, -100000.0)
# WGS84 -> OSGB36 shift: metres, seconds of arc, parts per million.
HELMERT_T = (-446.448, 125.157, -542.060)
HELMERT_R = (-0.1502, -0.2470, -0.8421)
HELMERT_S = 20.4894


def _to_cartesian(lat, lon, ellipsoid):
    a, b = ellipsoid
    e2 = 1 - (b * b) / (a * a)
    sin_lat = F.sin(lat)
    nu = a / F.sqrt(1 - e2 * sin_lat * sin_lat)
    return nu * F.cos(lat) * F.cos(lon), nu * F.cos(lat) * F.sin(lon), nu * (1 - e2) * sin_lat


def _to_geodetic(x, y, z, ellipsoid):
    """Bowring's closed form: sub-millimetre near the ground, no iteration needed."""
    a, b = ellipsoid
    e2 = 1 - (b * b) / (a * a)
    ep2 = (a * a) / (b * b) - 1
    p = F.sqrt(x * x + y * y)
    u = F.atan2(z * a, p * b)
    sin_u, cos_u = F.sin(u), F.cos(u)
    lat = F.atan2(z + ep2 * b * sin_u * sin_u * sin_u, p - e2 * a * cos_u * cos_u * cos_u)
    return lat, F.atan2(y, x)


def _helmert(x, y, z, inverse: bool):
    sign = -1.0 if inverse else 1.0
    tx, ty, tz = (sign * t for t in HELMERT_T)
    rx, ry, rz = (sign * math.radians(r / 3600.0) for r in HELMERT_R)
    scale = 1 + sign * HELMERT_S * 1e-6
    return (
        tx + scale * x - rz * y + ry * z,
        ty + rz * x + scale * y - rx * z,
        tz - ry * x + rx * y + scale * z,
    )


def _meridian_arc(lat):
    a, b = AIRY
    lat0 = BNG_TRUE_ORIGIN[0]
    n = (a - b) / (a + b)
    d, s = lat - lat0, lat + lat0
    return (b * BNG_SCALE) * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * d
        - (3 * n + 3 * n**2 + 2.625 * n**3) * F.sin(d) * F.cos(s)
        + (1.875 * n**2 + 1.875 * n**3) * F.sin(2 * d) * F.cos(2 * s)
        - (35.0 / 24.0) * n**3 * F.sin(3 * d) * F.cos(3 * s)
    )


def _radii(lat):
    a, b = AIRY
    e2 = 1 - (b * b) / (a * a)
    w = 1 - e2 * F.sin(lat) * F.sin(lat)
    nu = a * BNG_SCALE / F.sqrt(w)
    rho = a * BNG_SCALE * (1 - e2) / (w * F.sqrt(w))
    return nu, rho, nu / rho - 1


def _staged(df: DataFrame, stages: list[dict[str, Column]], keep: list[str]) -> DataFrame:
    """Add columns stage by stage, so that each intermediate is computed once, then drop them."""
    start = df.columns
    for stage in stages:
        df = df.withColumns(stage)
    return df.select(*[c for c in start if c not in keep], *keep)


def _c(*names: str) -> tuple[Column, ...]:
    return tuple(F.col(f"__g_{n}") for n in names)


def _stage(**cols: Column) -> dict[str, Column]:
    return {f"__g_{n}": c for n, c in cols.items()}


def wgs84_to_bng(df: DataFrame, lat: str = "lat", lon: str = "lon",
                 names: tuple[str, str] = ("x", "y")) -> DataFrame:
    """add easting and northing by Helmert shift and Transverse Mercator series; metre-level."""
    x, y, z = _c("x", "y", "z")
    u, v, w = _c("u", "v", "w")
    phi, lam, nu, rho, eta2, d = _c("phi", "lam", "nu", "rho", "eta2", "d")
    s, c, t2, d2 = _c("s", "c", "t2", "d2")
    c3, c5, t4 = c * c * c, c * c * c * c * c, t2 * t2
    stages = [
        _stage(**dict(zip("xyz", _to_cartesian(F.radians(lat), F.radians(lon), WGS84)))),
        _stage(**dict(zip("uvw", _helmert(x, y, z, inverse=False)))),
        _stage(**dict(zip(("phi", "lam"), _to_geodetic(u, v, w, AIRY)))),
        _stage(**dict(zip(("nu", "rho", "eta2"), _radii(phi))), s=F.sin(phi), c=F.cos(phi),
               t2=F.tan(phi) * F.tan(phi), d=lam - BNG_TRUE_ORIGIN[1]),
        _stage(d2=d * d, m=_meridian_arc(phi)),
        {
            names[0]: BNG_FALSE_ORIGIN[0] + d * nu * c + d * d2 * (nu / 6) * c3 * (nu / rho - t2)
            + d * d2 * d2 * (nu / 120) * c5 * (5 - 18 * t2 + t4 + 14 * eta2 - 58 * t2 * eta2),
            names[1]: F.col("__g_m") + BNG_FALSE_ORIGIN[1] + d2 * (nu / 2) * s * c
            + d2 * d2 * (nu / 24) * s * c3 * (5 - t2 + 9 * eta2)
            + d2 * d2 * d2 * (nu / 720) * s * c5 * (61 - 58 * t2 + t4),
        },
    ]
    return _staged(df, stages, list(names))


def bng_to_wgs84(df: DataFrame, x: str = "x", y: str = "y", names: tuple[str, str] = ("lat", "lon"),
                 rounds: int = 4) -> DataFrame:
    """F13 inverse: add latitude and longitude; ``rounds`` foot-point steps reach below 1 mm."""
    east, north = F.col(x), F.col(y)
    scale = AIRY[0] * BNG_SCALE
    foot, nu, rho, eta2, t, t2, sec, d, d2 = _c("foot", "nu", "rho", "eta2", "t", "t2", "sec", "d", "d2")
    phi, lam = _c("phi", "lam")
    t4, t6, nu3 = t2 * t2, t2 * t2 * t2, nu * nu * nu
    stages = [_stage(foot=(north - BNG_FALSE_ORIGIN[1]) / scale + BNG_TRUE_ORIGIN[0])]
    stages += [_stage(foot=foot + (north - BNG_FALSE_ORIGIN[1] - _meridian_arc(foot)) / scale)] * rounds
    stages += [
        _stage(**dict(zip(("nu", "rho", "eta2"), _radii(foot))), t=F.tan(foot), t2=F.tan(foot) * F.tan(foot),
               sec=1 / F.cos(foot), d=east - BNG_FALSE_ORIGIN[0]),
        _stage(d2=d * d),
        _stage(
            phi=foot - d2 * t / (2 * rho * nu)
            + d2 * d2 * t / (24 * rho * nu3) * (5 + 3 * t2 + eta2 - 9 * t2 * eta2)
            - d2 * d2 * d2 * t / (720 * rho * nu3 * nu * nu) * (61 + 90 * t2 + 45 * t4),
            lam=BNG_TRUE_ORIGIN[1] + d * sec / nu - d * d2 * sec / (6 * nu3) * (nu / rho + 2 * t2)
            + d * d2 * d2 * sec / (120 * nu3 * nu * nu) * (5 + 28 * t2 + 24 * t4)
            - d * d2 * d2 * d2 * sec / (5040 * nu3 * nu3 * nu) * (61 + 662 * t2 + 1320 * t4 + 720 * t6),
        ),
        _stage(**dict(zip("xyz", _to_cartesian(phi, lam, AIRY)))),
        _stage(**dict(zip("uvw", _helmert(*_c("x", "y", "z"), inverse=True)))),
        _stage(**dict(zip(("phi", "lam"), _to_geodetic(*_c("u", "v", "w"), WGS84)))),
        {names[0]: F.degrees(phi), names[1]: F.degrees(lam)},
    ]
    return _staged(df, stages, list(names))
