"""Audits, verdicts and comparison matrices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from kerbline.functions.labels import motion_class
from kerbline.functions.pose import quat_cols, quat_to_rot, rotate, transpose
from kerbline.functions.geo import distance3
from kerbline.operators.chains import greedy_chain
from kerbline.operators.ordered import PART_ROWS, neighbour, scan
from kerbline.operators.quantiles import exact_quantiles
from kerbline.operators.windows import circular_from_means, first_by, index_ranges, step_deltas
from kerbline.session import settle

NS = 1_000_000_000
GRAVITY = 9.80665
NO_EXPORT = "NO_EXPORT"
CARD_FIELDS = ("verdict", "pose_rate_hz", "p99_speed_mps", "cumul_distance_m",
               "extent_x_m", "extent_y_m", "extent_z_m", "las_size_gb")
# Tag -> class, recordings, first, last; used when no segment list names the tag.
LEGACY_SEGMENTS = (
    ("drive1", "URBAN", 7, 16, 22),
    ("bags40to45", "HIGHWAY", 6, 40, 45),
    ("static_005_007", "STATIC", 3, 5, 7),
    ("micro_000_004", "MICRO", 5, 0, 4),
    ("mixed_008_014", "MIXED", 7, 8, 14),
    ("mid_023_030", "MIXED", 8, 23, 30),
)


def _norm(*cols: str) -> Column:
    return F.sqrt(sum((F.col(c) * F.col(c) for c in cols[1:]), F.col(cols[0]) * F.col(cols[0])))


def motion_audit_odom(odom: DataFrame, by: list[str], order: list[str],
                      part_rows: int = PART_ROWS) -> DataFrame:
    """Path length, displacement, duration and peak speeds per recording shard."""
    rows = neighbour(odom, by, order, {f"__p_{a}": F.col(a) for a in "xyz"}, part_rows)
    step = F.sqrt(sum(((F.col(a) - F.col(f"__p_{a}")) * (F.col(a) - F.col(f"__p_{a}")) for a in "yz"),
                      (F.col("x") - F.col("__p_x")) * (F.col("x") - F.col("__p_x"))))
    key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("odom_msgs"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("path_length_m"),
        F.max(_norm("vx", "vy", "vz")).alias("peak_speed_mps"),
        F.max(_norm("wx", "wy", "wz")).alias("peak_ang_speed_rps"),
        ((F.max(order[0]) - F.min(order[0])) / NS).alias("duration_s"),
        *[f(c, key).alias(f"__{n}_{c}") for n, f in (("a", F.min_by), ("b", F.max_by)) for c in "xyz"],
    )
    moved = {c: F.col(f"__b_{c}") - F.col(f"__a_{c}") for c in "xyz"}
    gap = F.sqrt(sum((moved[c] * moved[c] for c in "yz"), moved["x"] * moved["x"]))
    return out.withColumn("displacement_m", gap).drop(*[f"__{n}_{c}" for n in "ab" for c in "xyz"])


def imu_std(imu: DataFrame, by: list[str]) -> DataFrame:
    """Population deviation of the acceleration magnitude."""
    return imu.groupBy(*by).agg(
        F.count(F.lit(1)).alias("imu_msgs"), F.stddev_pop(_norm("ax", "ay", "az")).alias("imu_accel_std")
    )


def is_moving(audit: DataFrame, min_path: float, min_peak_speed: float) -> DataFrame:
    """Does the shard hold motion?"""
    test = (F.col("path_length_m") >= min_path) & (F.col("peak_speed_mps") >= min_peak_speed)
    return audit.withColumn("moving", F.coalesce(test, F.lit(False)))


def motion_audit_imu(imu: DataFrame, by: list[str], time: str = "t_ns", gravity: float = GRAVITY) -> DataFrame:
    """RMS and peak of acceleration excess and turn rate, and the motion class."""
    excess = _norm("ax", "ay", "az") - gravity
    turn = _norm("gx", "gy", "gz")
    audit = imu.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_imu"),
        ((F.max(time) - F.min(time)) / NS).alias("duration_s"),
        F.sqrt(F.avg(excess * excess)).alias("accel_rms"),
        F.max(F.abs(excess)).alias("accel_peak"),
        F.sqrt(F.avg(turn * turn)).alias("gyro_rms"),
        F.max(turn).alias("gyro_peak"),
    )
    return audit.withColumn("class", motion_class("accel_rms", "gyro_rms"))


def class_histogram(audit: DataFrame, label: str = "class") -> DataFrame:
    """Number of shards per class, most frequent first."""
    return audit.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label)


def pose_stats(poses: DataFrame, by: list[str], order: list[str],
               part_rows: int = PART_ROWS) -> DataFrame:
    """Count, span, rate, distance, speeds, largest gap, rotation and extent of a trajectory.

    One pass in parts gives the steps; the 99th percentile speed is exact and does not hold
    a group's speeds in one buffer.
    """
    steps = step_deltas(poses, by, order, rotation=True, part_rows=part_rows)
    steps = settle(steps.select(*by, order[0], "x", "y", "z", "dt_s", "step_m", "speed_mps", "rot_rad"))
    t, zero = order[0], F.lit(0.0)
    span = (F.max(t) - F.min(t)) / NS
    stats = steps.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pose_count"),
        span.alias("span_s"),
        F.coalesce(F.sum("step_m"), zero).alias("cumul_m"),
        F.coalesce(F.max("speed_mps"), zero).alias("max_speed_mps"),
        F.coalesce(F.max("dt_s"), zero).alias("max_dt_s"),
        F.coalesce(F.sum("rot_rad"), zero).alias("rot_span_rad"),
        *[(F.max(a) - F.min(a)).alias(f"extent_{a}") for a in "xyz"],
    )
    live = F.col("span_s") > 0
    stats = stats.withColumn(
        "rate_hz", F.when(live, (F.col("pose_count") - 1) / F.col("span_s")).otherwise(zero)
    ).withColumn("mean_speed_mps", F.when(live, F.col("cumul_m") / F.col("span_s")).otherwise(zero))
    top = exact_quantiles(steps, by, F.col("speed_mps"), {"p99_speed_mps": 0.99})
    joined = stats.join(top, by, "left") if by else stats.crossJoin(top)
    return joined.withColumn("p99_speed_mps", F.coalesce("p99_speed_mps", zero))


def verdict(stats: DataFrame, rules: str = "card", max_speed: float = 30.0, max_extent: float = 2000.0,
            min_rate: float = 5.0, speed_stat: str = "p99_speed_mps") -> DataFrame:
    """A10: PASS, WARN or FAIL with reasons.

    ``rules='audit'`` is the gate before an export (speed statistic, extent, rate);
    ``'card'`` adds the mean-speed failure and the warning for a gap over 1 s.
    """
    extent = F.greatest("extent_x", "extent_y", "extent_z")
    fast, wide = F.col(speed_stat) > max_speed, extent > max_extent
    slow = F.col("rate_hz") < min_rate
    fails = [
        (fast, F.format_string(f"{speed_stat.removesuffix('_mps')}=%.1f>{max_speed} m/s", F.col(speed_stat))),
        (wide, F.format_string(f"extent=%.0f>{max_extent} m", extent)),
    ]
    warn = (F.col(speed_stat) > max_speed * 0.5) | slow
    if rules == "card":
        lead = F.col("mean_speed_mps") > max_speed
        fails.insert(0, (lead, F.format_string(f"mean_speed=%.1f>{max_speed} m/s", F.col("mean_speed_mps"))))
        warn = (
            (F.col(speed_stat) > max_speed * 0.5)
            | ((F.col("rate_hz") > 0) & slow)
            | (F.col("max_dt_s") > 1.0)
        )
    failed = fails[0][0]
    for test, _ in fails[1:]:
        failed = failed | test
    return stats.withColumn(
        "verdict", F.when(failed, "FAIL").when(warn, "WARN").otherwise("PASS")
    ).withColumn("reasons", F.concat_ws("; ", *[F.when(test, text) for test, text in fails]))


def require_pass(stats: DataFrame, force: bool = False, **rules) -> DataFrame:
    """Stop before an expensive export when any trajectory fails the audit rules.

    With ``force`` the export goes on and failures are told as ``WARN (forced)``.
    """
    told = verdict(stats, rules="audit", **rules)
    failed = F.col("verdict") == "FAIL"
    if force:
        return told.withColumn("verdict", F.when(failed, "WARN (forced)").otherwise(F.col("verdict")))
    bad = told.filter(failed).limit(5).collect()
    if bad:
        raise ValueError(f"divergent trajectory: {bad}")
    return told


#: The lines of a report: label, column and format, in their order.
CARD = (
    ("verdict", "verdict", "%s"), ("pose_count", "pose_count", "%d"), ("time_span_s", "span_s", "%.2f"), ("pose_rate_hz", "rate_hz", "%.2f"),
    ("cumul_distance_m", "cumul_m", "%.1f"), ("mean_speed_mps", "mean_speed_mps", "%.2f"), ("p99_speed_mps", "p99_speed_mps", "%.2f"),
    ("max_speed_mps", "max_speed_mps", "%.1f"), ("extent_x_m", "extent_x", "%.1f"), ("extent_y_m", "extent_y", "%.1f"), ("extent_z_m", "extent_z", "%.1f"),
)


def sanity_cards(stats: DataFrame, by: list[str], max_speed: float = 30.0, max_extent: float = 2000.0, min_rate: float = 5.0) -> DataFrame:
    """A10: the report of each trajectory as text lines ``(keys, line_no, value)`` that S10 reads back.

    Besides the statistics it tells the verdict, the gates, the reasons of a failure and, as
    ``warn_rate``, a rate that is too low.
    """
    told = verdict(stats, "card", max_speed, max_extent, min_rate)
    slow = (F.col("rate_hz") > 0) & (F.col("rate_hz") < min_rate)
    lines = [F.format_string(f"%-19s: {form}", F.lit(label), F.col(column)) for label, column, form in CARD]
    lines += [F.lit(f"gate_max_speed_mps : {max_speed}"), F.lit(f"gate_max_extent_m  : {max_extent}")]
    lines.append(F.when(F.col("reasons") != "", F.concat(F.lit("fail_reasons     : "), F.col("reasons"))))
    lines.append(F.when(slow, F.format_string(f"warn_rate        : rate=%.2f<{min_rate} Hz", F.col("rate_hz"))))
    return told.select(*by, F.posexplode(F.array_compact(F.array(*lines))).alias("line_no", "value"))


def audit_summary(audit: DataFrame, idx: str, moving: str, min_path_m: float, min_peak_mps: float, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """K6: one row of totals and thresholds, and the ranges of consecutive moving shards."""
    totals = audit.agg(F.count(F.lit(1)).alias("total_bags"), F.count_if(moving).alias("moving_bags")).withColumn(
        "thresholds", F.struct(F.lit(float(min_path_m)).alias("min_path_m"), F.lit(float(min_peak_mps)).alias("min_peak_speed_mps")))
    return totals, index_ranges(audit.where(moving), [], idx, part_rows)


def ate(pairs: DataFrame, by: list[str], a: str = "", b: str = "e_") -> DataFrame:
    """Statistics of the position error of matched poses."""
    gap = F.sqrt(sum(
        ((F.col(f"{a}{c}") - F.col(f"{b}{c}")) * (F.col(f"{a}{c}") - F.col(f"{b}{c}")) for c in "yz"),
        (F.col(f"{a}x") - F.col(f"{b}x")) * (F.col(f"{a}x") - F.col(f"{b}x")),
    ))
    return error_stats(pairs.withColumn("__e", gap), by, "__e")


def error_stats(rows: DataFrame, by: list[str], col: str) -> DataFrame:
    e = F.col(col)
    rows = settle(rows.select(*by, col))
    stats = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("mean"),
        F.stddev_pop(e).alias("std"), F.min(e).alias("min"), F.max(e).alias("max"),
    )
    middle = exact_quantiles(rows, by, e, {"median": 0.5})
    return stats.join(middle, by) if by else stats.crossJoin(middle)


def rpe(pairs: DataFrame, by: list[str], delta: float = 1.0, time: str = "t_ns", a: str = "",
        b: str = "e_", part_rows: int = PART_ROWS) -> DataFrame:
    """Relative pose error over steps of ``delta`` metres of travel.

    A pose is taken whenever the estimate has travelled ``delta`` since the last one taken (or
    since its beginning), where the count starts again; neighbours are compared.
    """
    before = {f"__p_{c}": F.col(f"{b}{c}") for c in "xyz"}
    gone = F.coalesce(distance3("__p_x", "__p_y", "__p_z", f"{b}x", f"{b}y", f"{b}z"), F.lit(0.0))
    pairs = settle(pairs.select(*by, time, *[f"{p}{c}" for p in (a, b) for c in ("x", "y", "z", "qx", "qy", "qz", "qw")]))
    along = settle(scan(pairs, by, [time], prev=before, sums={"cum_m": gone}, part_rows=part_rows).drop(*before))
    marks = greedy_chain(along, by, [time], "cum_m", delta, start=delta, part_rows=part_rows)
    pose = [f"q{c}" for c in "xyzw"] + list("xyz")
    cols = {f"o_{p}{c}": F.col(f"{p}{c}") for p in (a, b) for c in pose}
    legs = neighbour(marks, by, [time], cols, part_rows).filter(F.col(f"o_{b}x").isNotNull())
    # |want^-1 got| equals the distance of the two steps seen from their own start poses
    moved = [rotate(transpose(quat_to_rot(quat_cols(f"o_{p}"))),
                    [F.col(f"{p}{c}") - F.col(f"o_{p}{c}") for c in "xyz"]) for p in (a, b)]
    gaps = [g - w for w, g in zip(*moved)]
    err = F.hypot(F.hypot(gaps[0], gaps[1]), gaps[2])
    return error_stats(legs.withColumn("__e", err), by, "__e")


ALIGN_FIELDS = [f"r{i}" for i in range(9)] + ["tx", "ty", "tz"]


@F.pandas_udf(ArrayType(DoubleType()))
def _rigid_fit(moments: pd.Series) -> pd.Series:
    """Rotation and shift from centroids and cross-covariance, one small matrix per row."""
    out = []
    for m in moments:
        src, dst, cov = np.array(m[0:3]), np.array(m[3:6]), np.array(m[6:15]).reshape(3, 3)
        u, _, vt = np.linalg.svd(cov)
        flip = np.diag([1.0, 1.0, np.sign(np.linalg.det(u) * np.linalg.det(vt)) or 1.0])
        rot = u @ flip @ vt
        out.append([*rot.ravel(), *(dst - rot @ src)])
    return pd.Series(out)


def align_rigid(pairs: DataFrame, by: list[str], a: str = "", b: str = "e_") -> DataFrame:
    """Rotation and shift that move the estimate ``b`` onto the truth ``a`` (no scale).

    Spark sums the moments; only the 3x3 decomposition of one row per key is Python.
    """
    src, dst = [F.col(f"{b}{c}") for c in "xyz"], [F.col(f"{a}{c}") for c in "xyz"]
    cov = [F.covar_pop(d, s) for d in dst for s in src]
    fit = pairs.groupBy(*by).agg(
        F.array(*[F.avg(c) for c in src], *[F.avg(c) for c in dst], *cov).alias("__m")
    )
    fit = fit.withColumn("__f", _rigid_fit("__m"))
    return fit.select(*by, *[F.col("__f")[i].alias(n) for i, n in enumerate(ALIGN_FIELDS)])


def legacy_segments(spark) -> DataFrame:
    return spark.createDataFrame(
        list(LEGACY_SEGMENTS), "tag string, class string, n_bags int, start int, end int"
    )


def lookup_segment(runs: DataFrame, segments: DataFrame, legacy: DataFrame) -> DataFrame:
    """Class and range of a tag from the segment list, else the fallback list, else '?'.

    Of several segments with one tag the first by start and end is taken.
    """
    cols = ["class", "n_bags", "start", "end"]

    def one(df: DataFrame, name: str) -> DataFrame:
        return first_by(df.select("tag", *cols), ["tag"], [F.asc("start"), F.asc("end")]).select("tag", F.struct(*cols).alias(name))

    seg, old = one(segments, "__s"), one(legacy, "__o")
    rows = runs.join(seg, "tag", "left").join(old, "tag", "left")
    hit = F.coalesce("__s", "__o")
    rows = rows.withColumn("__h", hit)
    return rows.select(
        *runs.columns, F.coalesce(F.col("__h.class"), F.lit("?")).alias("class"),
        *[F.col("__h")[c].alias(c) for c in cols[1:]],
    )


def exported_tags(cards: DataFrame) -> DataFrame:
    """Tags for which at least one engine has an export."""
    done = F.coalesce(F.col("verdict"), F.lit(NO_EXPORT)) != NO_EXPORT
    return cards.filter(done).select("tag").distinct()


def diagnosis_matrix(cards: DataFrame, engines: list[str], fields: tuple[str, ...] = CARD_FIELDS) -> DataFrame:
    """One row per tag, ``<engine>_<field>`` columns; tags without any export dropped.

    The engine list is given, so the pivot is one aggregate without a scan for values. Where
    a tag and engine have several cards the first by ``card_id`` is shown.
    """
    live = cards.join(exported_tags(cards), "tag", "left_semi")
    body = F.min_by(F.struct(*fields), "card_id")
    wide = live.groupBy("tag").pivot("engine", engines).agg(body)
    cells = [F.col(e)[f].alias(f"{e}_{f}") for e in engines for f in fields]
    return wide.select("tag", *cells)


def verdict_counts(cards: DataFrame, verdicts: tuple[str, ...] = ("PASS", "WARN", "FAIL", NO_EXPORT)) -> DataFrame:
    """Number of cards per engine, class and verdict."""
    live = cards.join(exported_tags(cards), "tag", "left_semi")
    hits = [F.count_if(F.coalesce(F.col("verdict"), F.lit(NO_EXPORT)) == v).alias(v) for v in verdicts]
    return live.groupBy("engine", "class").agg(*hits)


def topic_rates(shards: DataFrame, by: list[str]) -> DataFrame:
    """Messages per second from counts and time ranges."""
    span = (F.max("end_ns") - F.min("start_ns")) / NS
    out = shards.groupBy(*by).agg(F.sum("count").alias("n_messages"), span.alias("duration_s"))
    return out.withColumn("rate_hz", F.when(F.col("duration_s") > 0, F.col("n_messages") / F.col("duration_s")))


def rate_compliance(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """Every expected topic as MISSING, LOW or OK. ``expected`` is a short list."""
    seen = observed.select("topic", "rate_hz")
    rows = expected.join(seen, "topic", "left")
    rate = F.coalesce("rate_hz", F.lit(0.0))
    flag = F.when(F.col("rate_hz").isNull(), "MISSING").when(rate < F.col("min_hz"), "LOW").otherwise("OK")
    return rows.select(*expected.columns, rate.alias("rate_hz"), flag.alias("status"))


def circular_mean_std(df: DataFrame, by: list[str], angle_deg: str) -> DataFrame:
    """Circular mean and Mardia's deviation in degrees."""
    rad = F.radians(angle_deg)
    sums = df.groupBy(*by).agg(F.avg(F.sin(rad)).alias("__s"), F.avg(F.cos(rad)).alias("__c"),
                               F.count(F.lit(1)).alias("n"))
    mean, std = circular_from_means(F.col("__s"), F.col("__c"))
    return sums.select(*by, "n", mean.alias("mean_deg"), std.alias("std_deg"))


def audit_session(frames: DataFrame, meta: DataFrame, session: str, cameras: list[str],
                  min_total: int = 40, min_per_camera: int = 10, min_grid_x: float = 400000.0,
                  temp_band: tuple[float, float] = (-30.0, 80.0),
                  exempt: dict[str, str] | None = None) -> DataFrame:
    """Frame counts, rule hits and the list of issues per session.

    ``meta`` has one sampled sidecar per session: ``x, heading_deg, heading_source,
    has_radiometric, min_temp_c, max_temp_c``. ``exempt`` maps a camera to a session that is
    known to lack it.
    """
    counts = frames.groupBy(session).agg(
        *[F.count_if(F.col("camera") == c).alias(c) for c in cameras]
    )
    total = sum((F.col(c) for c in cameras[1:]), F.col(cameras[0]))
    rows = counts.withColumn("total_frames", total).join(meta, session, "left")
    low, high = F.coalesce("min_temp_c", F.lit(-999.0)), F.coalesce("max_temp_c", F.lit(999.0))
    found = F.col("has_meta").isNotNull() if "has_meta" in meta.columns else F.col("x").isNotNull()
    thermal = found & F.coalesce(F.col("is_thermal"), F.lit(False))

    def camera_low(name: str) -> Column:
        test = F.col(name) < min_per_camera
        if exempt and name in exempt:
            test = test & (F.col(session).cast("string") != exempt[name])
        return F.when(test, F.format_string(f"{name}_low(%d)", F.col(name)))

    rules = [
        F.when(F.col("total_frames") == 0, F.lit("no_frames"))
        .when(F.col("total_frames") < min_total, F.format_string("too_few_frames(%d)", F.col("total_frames"))),
        *[camera_low(c) for c in cameras],
        F.when(found & (F.coalesce("x", F.lit(0.0)) < min_grid_x), F.lit("bad_bng")),
        F.when(found & (F.coalesce("heading_deg", F.lit(0.0)) == 0), F.lit("no_heading")),
        F.when(found & F.col("heading_source").isNull(), F.lit("no_heading_source")),
        F.when(thermal & ~F.coalesce("has_radiometric", F.lit(False)), F.lit("no_radiometric")),
        F.when(thermal & ((low < temp_band[0]) | (high > temp_band[1])),
               F.format_string("bad_temps(%.0fto%.0f)", low, high)),
    ]
    issues = F.array_compact(F.array(*rules))
    rows = rows.withColumn("issues", issues)
    return rows.select(session, *cameras, "total_frames", "issues", (F.size("issues") == 0).alias("valid"))


def health_rollup(checks: DataFrame, by: list[str]) -> DataFrame:
    """PASS, WARN and FAIL counts with the overall code 0, 1 or 2."""
    hits = [F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("PASS", "WARN", "FAIL")]
    out = checks.groupBy(*by).agg(*hits)
    return out.withColumn("exit_code", F.when(F.col("n_fail") > 0, 2).when(F.col("n_warn") > 0, 1).otherwise(0))
