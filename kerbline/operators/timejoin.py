"""Joins on time (J3-J7, J10, J13, J15): one union-and-window kernel.

Left and right rows are put in one time order per key and each left row picks up the
nearest right rows on both sides, through :mod:`kerbline.operators.ordered`, so neither a
theta join nor a whole track in one task is needed.

Ties: among right rows with equal time the backward match takes the last in the order of
``right_tie`` and the forward match the first; at equal distance the earlier row wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.pose import blend, compose_t, invert_t, lerp, pose_t, slerp_weights
from kerbline.operators.ordered import KEY, PART_ROWS, cut, last_known, running_max_before, scan

SIDE, TIE = "__side", "__tie"


def bracket_all(left: DataFrame, sources: dict[str, DataFrame], by: list[str], time: str = "t_ns",
                ties: dict[str, str] | None = None, part_rows: int = PART_ROWS, forward: bool = True) -> DataFrame:
    """Left rows with structs ``prev<name>`` (at or before) and ``next<name>`` (after) of each source.

    All sources share one order and one pass. The structs carry every column of the source
    except the keys. Adds the part key too, so that a following scan keeps the rows in place.
    """
    ties = ties or {}
    both = left.select(
        *by, F.col(time).alias("__t"), F.lit(1).alias(SIDE), F.struct(*[c for c in left.columns if c not in by]).alias("__l"))
    for name, source in sources.items():
        carried = F.struct(*[c for c in source.columns if c not in by])
        tie = {f"{TIE}{name}": F.col(ties[name])} if name in ties else {}
        rows = source.select(*by, F.col(time).alias("__t"), F.lit(0).alias(SIDE), carried.alias(f"__r{name}"), *[c.alias(n) for n, c in tie.items()])
        both = both.unionByName(rows, allowMissingColumns=True)
    order = ["__t", SIDE, *[f"{TIE}{name}" for name in sources if name in ties]]
    found = {name: F.col(f"__r{name}") for name in sources}
    rows = cut(both, by, order, part_rows)
    merged = scan(rows, by, order, last={f"prev{n}": c for n, c in found.items()},
                  ahead={f"next{n}": c for n, c in found.items()} if forward else None)
    sides = [f"{s}{n}" for s in (("prev", "next") if forward else ("prev",)) for n in sources]
    own = [F.col("__l")[c].alias(c) for c in left.columns if c not in by]
    return merged.filter(F.col(SIDE) == 1).select(*by, *own, *sides, KEY)


def bracket(left: DataFrame, right: DataFrame, by: list[str], time: str = "t_ns", right_tie: str | None = None,
            part_rows: int = PART_ROWS, forward: bool = True) -> DataFrame:
    """Left rows with structs ``prev`` (at or before) and ``next`` (after) of the right table."""
    return bracket_all(left, {"": right}, by, time, {"": right_tie} if right_tie else None, part_rows, forward).drop(KEY)


def _prefixed(side: str, right: DataFrame, by: list[str], prefix: str) -> list[Column]:
    return [F.col(side)[c].alias(prefix + c) for c in right.columns if c not in by]


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], max_age_ns: int | None = None,
                  time: str = "t_ns", right_tie: str | None = None, prefix: str = "r_",
                  part_rows: int = PART_ROWS) -> DataFrame:
    """Latest right row at or before each left row, null when older than ``max_age_ns``."""
    rows = bracket(left, right, by, time, right_tie, part_rows, forward=False)
    age = F.col(time) - F.col("prev")[time]
    if max_age_ns is not None:
        rows = rows.withColumn("prev", F.when(age <= max_age_ns, F.col("prev")))
    return rows.select(*left.columns, *_prefixed("prev", right, by, prefix))


def nearest_asof(left: DataFrame, right: DataFrame, by: list[str], tol_ns: int | None = None,
                 time: str = "t_ns", right_tie: str | None = None, prefix: str = "r_",
                 direction: str = "nearest", how: str = "inner",
                 part_rows: int = PART_ROWS) -> DataFrame:
    """Nearest right row in time within ``tol_ns``; adds ``dt_ns`` = right - left."""
    rows = bracket(left, right, by, time, right_tie, part_rows)
    rows = rows.withColumn("__best", _nearest("", time, None if how == "inner" else tol_ns, direction))
    rows = rows.withColumn("dt_ns", F.col("__best")[time] - F.col(time))
    if how == "inner":
        near = F.col("dt_ns").isNotNull()
        rows = rows.filter(near if tol_ns is None else near & (F.abs("dt_ns") <= tol_ns))
    return rows.select(*left.columns, *_prefixed("__best", right, by, prefix), "dt_ns")


def _nearest(name: str, time: str, tol_ns: int | None, direction: str = "nearest") -> Column:
    """The nearer of the two rows around, null when it is farther than ``tol_ns``."""
    prev, following = F.col(f"prev{name}"), F.col(f"next{name}")
    back, ahead = F.col(time) - prev[time], following[time] - F.col(time)
    use_prev = (ahead.isNull() | (back <= ahead)) if direction == "nearest" else F.lit(direction == "backward")
    best = F.when(use_prev, prev).otherwise(following)
    return best if tol_ns is None else F.when(F.when(use_prev, back).otherwise(ahead) <= tol_ns, best)


def prioritized_asof(left: DataFrame, sources: DataFrame, by: list[str], source_col: str,
                     value_col: str, priority: list[tuple[str, int | None]], time: str = "t_ns",
                     part_rows: int = PART_ROWS) -> DataFrame:
    """Value of the first source in ``priority`` that is fresh enough.

    ``sources`` holds rows ``(keys, time, source, value)``; ``priority`` lists
    ``(source, max_age_ns)`` from best to worst. When none is fresh, the value last used on
    the track is repeated with the name ``stale``. All sources share one pass.
    """
    wide = sources.select(
        *by, F.col(time).alias(time), F.lit(0).alias(SIDE),
        *[
            F.when(F.col(source_col) == name, F.struct(F.col(time).alias("t"), F.col(value_col).alias("v")))
            .alias(f"__p{i}")
            for i, (name, _) in enumerate(priority)
        ],
    )
    lefts = left.withColumn(SIDE, F.lit(1)).withColumn(
        "__l", F.struct(*[c for c in left.columns if c not in (*by, time)])
    ).select(*by, time, SIDE, "__l")
    both = cut(lefts.unionByName(wide, allowMissingColumns=True), by, [time, SIDE], part_rows)
    names = {f"__k{i}": F.col(f"__p{i}") for i in range(len(priority))}
    known = last_known(both, by, [time, SIDE], names).filter(F.col(SIDE) == 1)

    def fresh(i: int, limit: int | None) -> Column:
        latest = F.col(f"__k{i}")
        value = latest["v"]
        return value if limit is None else F.when(F.col(time) - latest["t"] <= limit, value)

    picks = [fresh(i, limit) for i, (_, limit) in enumerate(priority)]
    source = F.lit(None).cast("string")
    for (name, _), value in reversed(list(zip(priority, picks))):
        source = F.when(value.isNotNull(), F.lit(name)).otherwise(source)
    own = [F.col("__l")[c].alias(c) for c in left.columns if c not in (*by, time)]
    rows = known.select(*by, time, *own, KEY, F.coalesce(*picks).alias("value"), source.alias("value_source"))
    held = last_known(rows, by, [time], {"__held": F.col("value")})
    return held.select(
        *by, time, *[c for c in left.columns if c not in (*by, time)],
        F.coalesce("value", "__held").alias("value"),
        F.coalesce(
            "value_source", F.when(F.col("__held").isNotNull(), F.lit("stale")).otherwise(F.lit("none"))
        ).alias("value_source"),
    )


POSE = ("x", "y", "z", "qx", "qy", "qz", "qw")


def interpolate_poses(left: DataFrame, poses: DataFrame, by: list[str], time: str = "t_ns",
                      on_gap: str = "interpolate", max_gap_ns: int | None = None,
                      outside: str = "clamp", right_tie: str | None = None, prefix: str = "p_",
                      part_rows: int = PART_ROWS) -> DataFrame:
    """Pose at each left time by linear and spherical interpolation.

    A bracket wider than ``max_gap_ns`` is interpolated anyway, snapped to the nearer pose
    (``on_gap='snap'``) or dropped (``on_gap='drop'``). Before the first and after the last
    pose the end pose is used (``outside='clamp'``) or the row is dropped.
    """
    track = poses.select(*by, time, *POSE, *([right_tie] if right_tie and right_tie not in (time, *POSE) else []))
    rows = bracket(left, track, by, time, right_tie, part_rows)
    prev, nxt = F.col("prev"), F.col("next")
    span = nxt[time] - prev[time]
    alpha = F.when(span > 0, (F.col(time) - prev[time]) / span).otherwise(F.lit(0.0))
    rows = rows.filter((prev.isNotNull() & nxt.isNotNull()) if outside == "drop"
                       else (prev.isNotNull() | nxt.isNotNull()))
    if max_gap_ns is not None and on_gap == "drop":
        rows = rows.filter(~(F.coalesce(span, F.lit(0)) > max_gap_ns))
    if max_gap_ns is not None and on_gap == "snap":
        nearer = F.when(F.col(time) - prev[time] < nxt[time] - F.col(time), F.lit(0.0)).otherwise(F.lit(1.0))
        alpha = F.when(span > max_gap_ns, nearer).otherwise(alpha)
    first, second = F.coalesce(prev, nxt), F.coalesce(nxt, prev)
    rows = rows.withColumn("__a", F.when(prev.isNull() | nxt.isNull(), F.lit(0.0)).otherwise(alpha))
    rows = rows.withColumn("__f", first).withColumn("__s", second)
    f, s, a = F.col("__f"), F.col("__s"), F.col("__a")
    spot = [lerp(f[c], s[c], a).alias(prefix + c) for c in POSE[:3]]
    q0, q1 = [f[c] for c in POSE[3:]], [s[c] for c in POSE[3:]]
    w0, w1 = slerp_weights(q0, q1, a)
    rows = rows.withColumns({"__w0": w0, "__w1": w1})  # computed once, used eight times
    turn = blend(q0, q1, "__w0", "__w1")
    return rows.select(*left.columns, *spot, *[q.alias(prefix + c) for q, c in zip(turn, POSE[3:])])


def in_segments(frames: DataFrame, segments: DataFrame, by: list[str], time: str = "t_ns",
                part_rows: int = PART_ROWS) -> DataFrame:
    """Frames inside any segment ``(start_ns, end_ns)``; segments may overlap.

    The running maximum end of the segments started so far decides, so no range join is
    needed.
    """
    events = segments.select(*by, F.col("start_ns").alias(time), F.lit(0).alias(SIDE),
                             F.col("end_ns").alias("__end"))
    rows = frames.select(*by, time, F.lit(1).alias(SIDE),
                         F.struct(*[c for c in frames.columns if c not in (*by, time)]).alias("__l"))
    both = rows.unionByName(events, allowMissingColumns=True)
    seen = running_max_before(both, by, [time, SIDE], {"__open": F.col("__end")}, part_rows)
    return (
        seen.filter((F.col(SIDE) == 1) & (F.col("__open") >= F.col(time)))
        .select(*by, time, *[F.col("__l")[c].alias(c) for c in frames.columns if c not in (*by, time)])
        .select(*frames.columns)
    )


def associate(gt: DataFrame, est: DataFrame, by: list[str], max_diff_ns: int, time: str = "t_ns",
              est_id: str = "id", part_rows: int = PART_ROWS) -> DataFrame:
    """One-to-one pairs of two trajectories.

    Every ground-truth row takes its nearest estimate; an estimate chosen more than once
    keeps the closest row, the earlier one on a tie.
    """
    pairs = nearest_asof(gt, est, by, max_diff_ns, time, est_id, "e_", part_rows=part_rows)
    rank = Window.partitionBy(*by, f"e_{est_id}").orderBy(F.abs("dt_ns"), time)
    return pairs.withColumn("__rn", F.row_number().over(rank)).filter("__rn = 1").drop("__rn")


def correct_frames(clouds: DataFrame, local_poses: DataFrame, global_poses: DataFrame,
                   by: list[str], local_tol_ns: int, global_tol_ns: int, time: str = "t_ns",
                   part_rows: int = PART_ROWS) -> DataFrame:
    """Correction ``T_global * T_local^-1`` per cloud, held over clouds without a match.

    Adds ``corr`` = struct(r0..r8, tx, ty, tz) and ``fresh``; clouds before the first
    correction are dropped.
    """
    near = bracket_all(clouds, {"l": local_poses.select(*by, time, *POSE), "g": global_poses.select(*by, time, *POSE)}, by, time, part_rows=part_rows)
    near = near.withColumns({"__l": _nearest("l", time, local_tol_ns), "__g": _nearest("g", time, global_tol_ns)})
    near = near.select(*clouds.columns, KEY, *[F.col(f"__{s}")[c].alias(f"{s}_{c}") for s in "lg" for c in POSE])
    rot, shift = compose_t(pose_t("g_"), invert_t(pose_t("l_")))
    matched = F.col("l_x").isNotNull() & F.col("g_x").isNotNull()
    corr = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rot)],
                    *[c.alias(f"t{a}") for a, c in zip("xyz", shift)])
    near = near.withColumn("__fresh", F.when(matched, corr))
    held = last_known(near, by, [time], {"corr": F.col("__fresh")})
    return held.filter(F.col("corr").isNotNull()).select(
        *clouds.columns, "corr", F.col("__fresh").isNotNull().alias("fresh")
    )
