"""Step functions of the order-dependent operators.

A step takes the state (a plain list or None) and one input row (a tuple in the order of
``inputs``) and returns the new state and the output values, or None to emit nothing. The
batch and the stream form both call these, so they agree by construction.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from kerbline.functions.geo import METRES_PER_DEGREE

NS = 1_000_000_000


@dataclass(frozen=True)
class Step:
    """An order-dependent operator: what it reads, what it adds and how it moves on.

    ``idle(state, n)`` is the state after ``n`` rows without effect; ``carried`` are the
    places of the state that rows add to whatever they hold. Both only speed up the batch form.
    """

    inputs: tuple[str, ...]
    outputs: str  # DDL of the added columns
    advance: Callable
    idle: Callable = lambda state, n: state
    carried: tuple[int, ...] = ()


def monotonic_guard(min_increment_ns: int) -> Step:
    """Output stamps never go back; a stamp that does is set just after the last output."""

    def advance(state, row):
        (raw,) = row
        if state is None or raw > state[0]:
            return [raw], (raw, False)
        out = state[0] + min_increment_ns
        return [out], (out, True)

    return Step(("t_ns",), "out_ns long, corrected boolean", advance, idle=lambda state, n: [state[0] + n * min_increment_ns])


def offset_guard(min_increment_ns: int, jump_ns: int) -> Step:
    """Corrections are carried on as an offset; a jump over ``jump_ns`` starts an epoch."""

    def advance(state, row):
        (raw,) = row
        if state is None:
            return [raw, raw, 0, 0], (raw, False, 0, 0)
        last_raw, last_out, offset, epoch = state
        corrected = False
        if abs(raw - last_raw) > jump_ns:
            epoch += 1
            out = last_out + min_increment_ns
            offset = out - raw
        else:
            out = raw + offset
            if out <= last_out:
                corrected = True
                out = last_out + min_increment_ns
                offset = out - raw
        return [raw, out, offset, epoch], (out, corrected, offset, epoch)

    return Step(("t_ns",), "out_ns long, corrected boolean, offset_ns long, epoch long", advance, carried=(1, 2, 3))


def gnss_track(max_speed: float = 30.0, rtk_move_m: float = 0.5, plain_move_m: float = 10.0) -> Step:
    """Reject fixes that imply an impossible speed against the last accepted one; heading
    from the movement since the last heading anchor."""

    def advance(state, row):
        t, lat, lon, x, y, rtk = row
        speed, heading, anchor = 0.0, None, None
        if state is not None:
            p_t, p_lat, p_lon, speed, heading, anchor = state
            dt = (t - p_t) / NS
            if dt > 0.01:
                dlat = (lat - p_lat) * METRES_PER_DEGREE
                dlon = (lon - p_lon) * METRES_PER_DEGREE * math.cos(math.radians(lat))
                implied = math.sqrt(dlat * dlat + dlon * dlon) / dt
                if implied > max_speed:
                    return state, None
                speed = implied
        if anchor is None:
            anchor = [x, y]
        else:
            dx, dy = x - anchor[0], y - anchor[1]
            if math.sqrt(dx * dx + dy * dy) > (rtk_move_m if rtk else plain_move_m):
                heading = math.degrees(math.atan2(dx, dy)) % 360
                anchor = [x, y]
        return [t, lat, lon, speed, heading, anchor], (speed, heading)

    return Step(("t_ns", "lat", "lon", "x", "y", "is_rtk"), "speed_mps double, heading_deg double", advance)


def datum_heading(park_m: float = 2.0, datum_m: float = 2.0, rtk_move_m: float = 0.5, plain_move_m: float = 10.0) -> Step:
    """Headings for the calibration, the better ones from a place where the vehicle stood.

    A survey-grade fix within ``park_m`` of the last place on the way is kept as a datum. The
    next heading from such fixes is taken over the distance from the datum when that is more
    than ``datum_m``, which uses the datum up; otherwise, as for plain fixes, over the movement
    since the last heading. Rows with a heading are emitted.
    """

    def away(x, y, place) -> float:
        return math.hypot(x - place[0], y - place[1])

    def towards(x, y, place) -> float:
        return math.degrees(math.atan2(x - place[0], y - place[1])) % 360

    def advance(state, row):
        _, x, y, rtk = row
        here = [x, y]
        way, datum, sure, last = state or [here, False, None, None]
        moving = away(x, y, way) > park_m
        if rtk and not moving:
            datum, sure = True, here
        found = None
        if last is None:
            last = here
        elif away(x, y, last) > (rtk_move_m if rtk else plain_move_m):
            found = (towards(x, y, last), "movement")
            last = here
            if rtk:
                if datum and away(x, y, sure) > datum_m:
                    found, datum = (towards(x, y, sure), "datum"), False
                sure = here
        return [here if moving else way, datum, sure, last], found

    return Step(("t_ns", "x", "y", "is_rtk"), "heading_deg double, heading_from string", advance)


def circular_mean_std(angles: list[float]) -> tuple[float, float]:
    n = len(angles)
    s = sum(math.sin(math.radians(a)) for a in angles) / n
    c = sum(math.cos(math.radians(a)) for a in angles) / n
    r = math.sqrt(s * s + c * c)
    std = 0.0 if r >= 1.0 else math.degrees(math.sqrt(-2.0 * math.log(r)))
    return math.degrees(math.atan2(s, c)) % 360, std


def heading_calibration(size: int = 20, seed: int = 5, sigma: float = 3.0, min_reject_deg: float = 5.0,
                        max_rejects: int = 20, converge_deg: float = 2.0, drift_deg: float = 25.0) -> Step:
    """T4: offset between compass heading and odometry yaw from a buffer of samples.

    Outliers are rejected; enough rejections in a row clear the buffer. Once the deviation is
    small the offset is locked: dual-antenna samples then only watch for drift, fix-based
    samples (``from_dual`` false) are ignored.
    """

    def off(a: float, b: float) -> float:
        d = a - b
        return d - 360 if d > 180 else d + 360 if d < -180 else d

    def advance(state, row):
        _, heading, yaw, from_dual = row
        buffer, converged, rejects, mean, std, n = state or [[], False, 0, None, 999.0, 0]
        sample = (heading - yaw % 360 + 360) % 360

        def result(action):
            return [buffer, converged, rejects, mean, std, n], (mean, std, converged, rejects, action)

        if converged:
            if not from_dual:
                return result("locked")
            if abs(off(sample, mean)) <= drift_deg:
                rejects = 0
                return result("locked")
            rejects += 1
            if rejects < max_rejects:
                return result("rejected")
            buffer, converged, rejects = [], False, 0
        action = "accepted"
        if len(buffer) >= seed:
            centre, spread = circular_mean_std(buffer)
            if abs(off(sample, centre)) > max(sigma * spread, min_reject_deg):
                rejects += 1
                if rejects < max_rejects:
                    return result("rejected")
                buffer, converged, rejects, action = [], False, 0, "reset"
        buffer = [*buffer, sample][-size:]
        rejects, n = 0, n + 1
        mean, std = circular_mean_std(buffer)
        if not converged and len(buffer) >= seed and std < converge_deg:
            converged = True
        return result(action)

    return Step(
        ("t_ns", "heading_deg", "yaw_deg", "from_dual"),
        "offset_deg double, offset_std_deg double, converged boolean, rejects long, action string",
        advance, carried=(5,),
    )


def trajectory_gate(min_move_m: float = 2.0) -> Step:
    """T5: emit the first row and every row more than ``min_move_m`` from the last emitted."""

    def advance(state, row):
        _, x, y = row
        if state is not None:
            dx, dy = x - state[0], y - state[1]
            if not math.sqrt(dx * dx + dy * dy) > min_move_m:
                return state, None
        return [x, y], ()

    return Step(("t_ns", "x", "y"), "", advance)


def keyframe_gate(min_dt_ns: int = NS // 5) -> Step:
    """Emit a row once it is at least its own ``spacing_m`` and ``min_dt_ns`` from the last."""

    def advance(state, row):
        t, x, y, spacing = row
        if state is not None:
            dx, dy = x - state[1], y - state[2]
            if math.sqrt(dx * dx + dy * dy) < spacing or t - state[0] < min_dt_ns:
                return state, None
        return [t, x, y], ()

    return Step(("t_ns", "x", "y", "spacing_m"), "", advance)


def keyframe_gate_3d(min_dist_m: float, min_angle_rad: float | None = None, inclusive: bool = False) -> Step:
    """Emit on enough distance or, when given, enough rotation since the last keyframe.

    ``inclusive`` accepts a distance equal to the limit.
    """

    def advance(state, row):
        _, x, y, z, qx, qy, qz, qw = row
        if state is not None:
            gap = math.dist((x, y, z), state[:3])
            moved = gap >= min_dist_m if inclusive else gap > min_dist_m
            dot = abs(sum(a * b for a, b in zip((qx, qy, qz, qw), state[3:])))
            turned = min_angle_rad is not None and 2 * math.acos(min(1.0, dot)) > min_angle_rad
            if not (moved or turned):
                return state, None
        return [x, y, z, qx, qy, qz, qw], ()

    return Step(("t_ns", "x", "y", "z", "qx", "qy", "qz", "qw"), "", advance)


def throttle(min_gap_ns: int) -> Step:
    """Emit a row at least ``min_gap_ns`` after the last emitted one."""

    def advance(state, row):
        (t,) = row
        if state is not None and t - state[0] < min_gap_ns:
            return state, None
        return [t], ()

    return Step(("t_ns",), "", advance)


def limit_alerts(max_actions: int = 3, window_ns: int = 3600 * NS, cooldown_ns: int = 120 * NS) -> Step:
    """Allow at most ``max_actions`` per rolling window, and none during the cooldown."""

    def advance(state, row):
        (t,) = row
        recent = [a for a in (state or []) if a >= t - window_ns]
        if len(recent) >= max_actions or (recent and t - recent[-1] < cooldown_ns):
            return recent, (False,)
        return [*recent, t], (True,)

    return Step(("t_ns",), "allowed boolean", advance)


def gap_alert(max_gap_ns: int) -> Step:
    """T9 on a stream: emit a row that follows a gap over ``max_gap_ns``, with the gap in seconds."""

    def advance(state, row):
        (t,) = row
        gap = abs(t - state[0]) if state else 0
        return [t], ((gap / NS,) if gap > max_gap_ns else None)

    return Step(("t_ns",), "gap_s double", advance)


def hold_last(columns: tuple[str, ...], types: str) -> Step:
    """Repeat the latest row of values when a row has none; nothing before the first.

    ``types`` is the DDL of the output columns, in the order of ``columns``. A row counts as
    fresh when its first value is present.
    """

    def advance(state, row):
        fresh = row[0] is not None
        held = list(row) if fresh else state
        return held, (None if held is None else (*held, fresh))

    return Step(columns, f"{types}, fresh boolean", advance)
