"""Quaternions and rigid transforms as scalar columns.

A quaternion is a tuple ``(x, y, z, w)``; a rotation is nine columns in row order; a
transform is ``(rotation, (tx, ty, tz))``. Everything stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbline.functions.geo import as_col

LERP_ABOVE = 0.9995

# Sensor mounting, rotation rows then translation in metres.
EXTRINSIC_PRESETS = {
    "identity": ((1, 0, 0, 0, 1, 0, 0, 0, 1), (0.0, 0.0, 0.0)),
    "fast_lio": ((-1, 0, 0, 0, -1, 0, 0, 0, 1), (0.0024, 0.0097, 0.0307)),
    "dlio": ((-1, 0, 0, 0, -1, 0, 0, 0, 1), (0.0, 0.0, 0.0382)),
}


def quat_cols(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(f"{prefix}q{axis}") for axis in "xyzw")


def yaw(q) -> Column:
    """heading angle about z in radians."""
    x, y, z, w = map(as_col, q)
    return F.atan2(2.0 * (w * z + x * y), 1.0 - 2.0 * (y * y + z * z))


def quat_dot(a, b) -> Column:
    ax, ay, az, aw = map(as_col, a)
    bx, by, bz, bw = map(as_col, b)
    return ax * bx + ay * by + az * bz + aw * bw


def rotation_angle(a, b) -> Column:
    """Angle in radians between two unit quaternions; q and -q count as equal."""
    return 2 * F.acos(F.least(F.lit(1.0), F.abs(quat_dot(a, b))))


def lerp(a, b, alpha) -> Column:
    a, b, alpha = as_col(a), as_col(b), as_col(alpha)
    return a * (1 - alpha) + b * alpha


def slerp_weights(q0, q1, alpha) -> tuple[Column, Column]:
    """Weights of both quaternions on the shortest path; linear for nearly equal inputs."""
    alpha = as_col(alpha)
    raw = quat_dot(q0, q1)
    sign = F.when(raw < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    theta = F.acos(F.least(F.abs(raw), F.lit(1.0)))
    near = F.abs(raw) > LERP_ABOVE
    w0 = F.when(near, 1 - alpha).otherwise(F.sin((1 - alpha) * theta) / F.sin(theta))
    w1 = F.when(near, alpha).otherwise(F.sin(alpha * theta) / F.sin(theta)) * sign
    return w0, w1


def blend(q0, q1, w0, w1) -> tuple[Column, Column, Column, Column]:
    """Weighted sum of two quaternions, scaled to unit length."""
    w0, w1 = as_col(w0), as_col(w1)
    mixed = [w0 * as_col(a) + w1 * as_col(b) for a, b in zip(q0, q1)]
    norm = F.sqrt(sum((m * m for m in mixed[1:]), mixed[0] * mixed[0]))
    return tuple(m / norm for m in mixed)


def slerp(q0, q1, alpha) -> tuple[Column, Column, Column, Column]:
    """shortest-path spherical interpolation of unit quaternions."""
    return blend(q0, q1, *slerp_weights(q0, q1, alpha))


def quat_to_rot(q) -> tuple[Column, ...]:
    """F8: nine rotation entries in row order."""
    x, y, z, w = map(as_col, q)
    return (
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    )


def rot_to_quat(r) -> tuple[Column, Column, Column, Column]:
    """quaternion of a rotation; the largest of w, x, y, z sets the divisor."""
    m = [as_col(v) for v in r]
    diag = (m[0], m[4], m[8])
    trace = m[0] + m[4] + m[8]
    lead = {
        "w": F.sqrt(F.greatest(F.lit(0.0), 1 + trace)) / 2,
        "x": F.sqrt(F.greatest(F.lit(0.0), 1 + diag[0] - diag[1] - diag[2])) / 2,
        "y": F.sqrt(F.greatest(F.lit(0.0), 1 - diag[0] + diag[1] - diag[2])) / 2,
        "z": F.sqrt(F.greatest(F.lit(0.0), 1 - diag[0] - diag[1] + diag[2])) / 2,
    }
    diff = {"x": m[7] - m[5], "y": m[2] - m[6], "z": m[3] - m[1]}
    pair = {"xy": m[1] + m[3], "xz": m[2] + m[6], "yz": m[5] + m[7]}

    def shared(a: str, b: str) -> Column:
        if a == b:
            return lead[a]
        if "w" in (a, b):
            other = b if a == "w" else a
            return diff[other] / (4 * lead[a])
        return pair["".join(sorted((a, b)))] / (4 * lead[a])

    use_w = trace > 0
    use_x = (diag[0] > diag[1]) & (diag[0] > diag[2])
    use_y = diag[1] > diag[2]
    return tuple(
        F.when(use_w, shared("w", part))
        .when(use_x, shared("x", part))
        .when(use_y, shared("y", part))
        .otherwise(shared("z", part))
        for part in "xyzw"
    )


def rotate(r, p) -> tuple[Column, Column, Column]:
    r, (x, y, z) = [as_col(v) for v in r], map(as_col, p)
    return tuple(r[3 * i] * x + r[3 * i + 1] * y + r[3 * i + 2] * z for i in range(3))


def apply_t(transform, p) -> tuple[Column, Column, Column]:
    """map a point by a rigid transform."""
    r, t = transform
    return tuple(a + as_col(b) for a, b in zip(rotate(r, p), t))


def transpose(r):
    return tuple(r[3 * j + i] for i in range(3) for j in range(3))


def invert_t(transform):
    r, t = transform
    back = transpose(r)
    return back, tuple(-v for v in rotate(back, t))


def compose_t(first, second):
    """The transform that applies ``second`` and then ``first``."""
    (r1, t1), (r2, t2) = first, second
    r1c, r2c = [as_col(v) for v in r1], [as_col(v) for v in r2]
    rot = tuple(
        sum((r1c[3 * i + k] * r2c[3 * k + j] for k in (1, 2)), r1c[3 * i] * r2c[j])
        for i in range(3)
        for j in range(3)
    )
    return rot, apply_t((r1, t1), t2)


def pose_t(prefix: str = ""):
    """Transform columns of a pose row ``x, y, z, qx, qy, qz, qw`` with a name prefix."""
    return quat_to_rot(quat_cols(prefix)), tuple(F.col(f"{prefix}{a}") for a in "xyz")


def extrinsic(preset: str = "identity"):
    """sensor-to-body transform as literals."""
    r, t = EXTRINSIC_PRESETS[preset]
    return tuple(F.lit(float(v)) for v in r), tuple(F.lit(v) for v in t)


def yaw_rate(speed, steer_rad, wheelbase: float) -> Column:
    """bicycle-model yaw rate; zero for an almost straight wheel."""
    steer = as_col(steer_rad)
    turning = as_col(speed) * F.tan(steer) / wheelbase
    return F.when(F.abs(steer) > 0.001, turning).otherwise(F.lit(0.0))
