"""Classification, naming and parsing helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbline.functions.geo import as_col

# km/h limit -> keyframe spacing in metres.
KEYFRAME_SPACING_M = ((5, 2.0), (30, 5.0), (60, 10.0))
KEYFRAME_SPACING_TOP_M = 20.0
# Fixed values: (acceleration excess RMS m/s^2, gyro RMS rad/s, class).
MOTION_LIMITS = ((0.35, 0.025, "STATIC"), (0.80, 0.100, "MICRO"), (3.00, 0.400, "URBAN"))
MOTION_TOP = "HIGHWAY"
# Receiver status code -> name, and device fix-type code -> name.
FIX_STATUS = {-1: "nofix", 0: "gps", 1: "sbas", 2: "rtk"}
FIX_TYPE = {0: "3D", 1: "2D", 2: "Time", 3: "None", 4: "Invalid", 5: "RTKFloat", 6: "RTKFixed"}
# RSRP floor in dBm -> grade.
SIGNAL_GRADES = ((-95, "Excellent"), (-105, "Good"), (-115, "Fair"))
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def keyframe_distance(speed_mps) -> Column:
    """spacing between keyframes for a speed in m/s."""
    kmh = as_col(speed_mps) * 3.6
    out = F.lit(KEYFRAME_SPACING_TOP_M)
    for limit, spacing in reversed(KEYFRAME_SPACING_M):
        out = F.when(kmh <= limit, F.lit(spacing)).otherwise(out)
    return out


def motion_class(accel_rms, gyro_rms) -> Column:
    """STATIC, MICRO, URBAN or HIGHWAY."""
    accel, gyro = as_col(accel_rms), as_col(gyro_rms)
    out = F.lit(MOTION_TOP)
    for a_max, g_max, label in reversed(MOTION_LIMITS):
        out = F.when((accel <= a_max) & (gyro <= g_max), F.lit(label)).otherwise(out)
    return out


def stamp_name(t_ns) -> Column:
    """nanoseconds to ``YYYYMMDD_HHMMSS_mmm`` in UTC, without going through a time zone."""
    t = as_col(t_ns).cast("long")
    in_second = F.pmod(t, F.lit(1_000_000_000))
    whole_s = F.floor((t - in_second) / 1_000_000_000)  # exact: a multiple of 2^9 fits a double
    days = F.floor(whole_s / 86400)
    in_day = whole_s - days * 86400
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")), "yyyyMMdd")

    def two(value, width=2):
        return F.lpad(F.floor(value).cast("long").cast("string"), width, "0")

    return F.concat(
        day, F.lit("_"),
        two(in_day / 3600), two(F.pmod(in_day / 60, F.lit(60.0))), two(F.pmod(in_day, F.lit(60))),
        F.lit("_"), two(in_second / 1_000_000, 3),
    )


def recording_id(pass_name, prefix: str, year: int) -> Column:
    """``pass1_mar24`` -> ``<prefix>-pass1-<year>0324``; unknown months give 00."""
    parts = F.split(as_col(pass_name), "_")
    word = F.get(parts, F.lit(1))
    month = F.lit("00")
    for number, name in enumerate(MONTHS, start=1):
        month = F.when(F.substring(word, 1, 3) == name, F.lit(f"{number:02d}")).otherwise(month)
    return F.concat(
        F.lit(f"{prefix}-"), F.get(parts, F.lit(0)), F.lit(f"-{year}"), month, F.substring(word, 4, 99)
    )


def uuid5(name, namespace_hex: str = DNS_NAMESPACE) -> Column:
    """RFC 4122 version 5 identifier of a name."""
    raw = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(as_col(name), "UTF-8")))
    nibble = F.conv(F.substring(raw, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(F.pmod(nibble, F.lit(4)) + 8))
    return F.concat_ws(
        "-",
        F.substring(raw, 1, 8),
        F.substring(raw, 9, 4),
        F.concat(F.lit("5"), F.substring(raw, 14, 3)),
        F.concat(variant, F.substring(raw, 18, 3)),
        F.substring(raw, 21, 12),
    )


def camera_side(name) -> Column:
    """left, right, rear or unknown from the camera name."""
    name, out = as_col(name), F.lit("unknown")
    for side in ("rear", "right", "left"):
        out = F.when(name.contains(side), F.lit(side)).otherwise(out)
    return out


def _lookup(code, table: dict) -> Column:
    code = as_col(code)
    out = code.cast("string")
    for key, label in table.items():
        out = F.when(code == key, F.lit(label)).otherwise(out)
    return out


def fix_name(code) -> Column:
    """receiver status code to name; unknown codes stay as text."""
    return _lookup(code, FIX_STATUS)


def fix_type_name(code) -> Column:
    """device fix-type code to name."""
    return _lookup(code, FIX_TYPE)


def signal_grade(rsrp) -> Column:
    """modem signal grade."""
    rsrp, out = as_col(rsrp), F.lit("Poor")
    for floor, label in reversed(SIGNAL_GRADES):
        out = F.when(rsrp >= floor, F.lit(label)).otherwise(out)
    return out


def fix_covariance(accuracy) -> Column:
    """F32: diagonal 3x3 covariance from a horizontal accuracy, at least 1 m."""
    sigma = F.greatest(as_col(accuracy), F.lit(1.0))
    zero = F.lit(0.0)
    return F.array(
        sigma * sigma, zero, zero, zero, sigma * sigma, zero, zero, zero, 4 * sigma * sigma
    )


def num(value, default: float | None = None) -> Column:
    """number from text, or the default."""
    return F.coalesce(as_col(value).try_cast("double"), F.lit(default).cast("double"))


def voxel_of(x, y, z, size) -> tuple[Column, Column, Column]:
    """three BIGINT cell numbers; never packed into one, so they cannot collide."""
    return tuple(F.floor(as_col(v) / as_col(size)) for v in (x, y, z))


def tile_of(x, y, tile_m) -> tuple[Column, Column]:
    return F.floor(as_col(x) / tile_m), F.floor(as_col(y) / tile_m)


#: Shifts and masks that put a zero between the bits of a 32-bit number (fixed values).
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def morton(cx, cy) -> Column:
    """Place of a cell on a space-filling curve: the bits of both numbers in turn, each within 2**30 of zero."""

    def spread(cell) -> Column:
        v = (as_col(cell) + (1 << 30)).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))
        for shift, mask in SPREAD:
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(cx).bitwiseOR(F.shiftleft(spread(cy), 1))


def ring_of(x, y, max_radius: float, rings: int) -> Column:
    """Ring number by planar range; null outside the radius."""
    x, y = as_col(x), as_col(y)
    reach = F.sqrt(x * x + y * y)
    ring = F.least(F.floor(reach / (max_radius / rings)), F.lit(rings - 1))
    return F.when(reach < max_radius, ring)


def sector_of(x, y, sectors: int) -> Column:
    """Sector number by azimuth, counted from -180 degrees."""
    turn = F.atan2(as_col(y), as_col(x)) + math.pi
    return F.least(F.floor(turn / (2 * math.pi / sectors)), F.lit(sectors - 1))


def zone_edges(min_range: float, max_range: float, zones: int) -> list[float]:
    """Zone borders grow with the power 1.5 of the zone share."""
    span = max_range - min_range
    return [min_range + span * (i / zones) ** 1.5 for i in range(zones + 1)]


def zone_of(x, y, min_range: float, max_range: float, zones: int) -> Column:
    x, y = as_col(x), as_col(y)
    reach = F.sqrt(x * x + y * y)
    edges = zone_edges(min_range, max_range, zones)
    out = F.lit(None).cast("int")
    for zone in range(zones):
        out = F.when((reach >= edges[zone]) & (reach < edges[zone + 1]), F.lit(zone)).otherwise(out)
    return out


def height_color(t, brightness) -> tuple[Column, Column, Column]:
    """red, green, blue 0-255 of a height share in [0, 1] under a brightness."""
    t, b = as_col(t), as_col(brightness)

    def byte(value):
        return F.floor(F.least(F.greatest(value, F.lit(0.0)), F.lit(255.0)))

    ramp = (
        (t * 4 - 2) * 255,
        F.least(t * 4, 4 - t * 4) * 255,
        (1 - t * 4) * 255,
    )
    return tuple(byte(byte(channel) * b) for channel in ramp)


def accuracy_block(**fields) -> Column:
    """one JSON object from named columns, nulls kept."""
    named = [as_col(value).alias(name) for name, value in fields.items()]
    return F.to_json(F.struct(*named), {"ignoreNullFields": "false"})


def meta_field(json_text, path: str) -> Column:
    """one field of a JSON text by path, for example ``$.gps.lat``."""
    return F.get_json_object(as_col(json_text), path)
