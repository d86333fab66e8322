"""Queries on the order-dependent operators, checked with recursive SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.functions.labels import keyframe_distance
from kerbline.operators import steps as T
from kerbline.operators import windows as W
from kerbline.operators.fixes import is_rtk, valid_fix
from kerbline.operators.sequential import run_sequential
from kerbline.plans.bindings import DAY, HOUR, PARTS, Tables, with_tables
from kerbline.plans.registry import query, r

U = ["user_id"]
#: Segments of the whole table: even small tables are cut, keys across them included.
SEGMENTS = 12


def _walk(tables: str, extra: str, first: str, then: str, final: str) -> str:
    """Recursive SQL that follows ``o``, the rows of each user numbered in order as ``n``."""
    return with_tables(tables, recursive=True) + f""", {extra}, seq AS (
  SELECT {first} FROM o WHERE n = 1 UNION ALL SELECT {then} FROM seq s JOIN o ON o.user_id = s.user_id AND o.n = s.n + 1)
{final}"""


RAW = "t_ns + ((frame_id * 7919) % 5 - 2) * " + str(5 * HOUR)
O_RAW = f"o AS (SELECT frame_id, user_id, {RAW} AS raw, row_number() OVER (PARTITION BY user_id ORDER BY frame_id) AS n FROM frames)"


def _arrivals(t: Tables):
    raw = F.col("t_ns") + ((F.col("frame_id") * 7919) % 5 - 2) * F.lit(5 * HOUR)
    return t.frames().select("frame_id", *U, raw.alias("t_ns"))


@query(_walk("frames", O_RAW, "user_id, n, frame_id, raw AS out_ns, false AS corrected",
             "o.user_id, o.n, o.frame_id, CASE WHEN o.raw > s.out_ns THEN o.raw ELSE s.out_ns + 1000 END, NOT o.raw > s.out_ns",
             "SELECT frame_id, out_ns, corrected FROM seq"))
def monotonic_guard(t: Tables):
    out = run_sequential(_arrivals(t), U, ["frame_id"], T.monotonic_guard(1000), segments=SEGMENTS)
    return out.select("frame_id", "out_ns", "corrected")


JUMP = 30 * HOUR


@query(_walk("frames", O_RAW, "user_id, n, frame_id, raw, raw AS out_ns, 0::BIGINT AS off, 0::BIGINT AS epoch, false AS corrected",
             f"""o.user_id, o.n, o.frame_id, o.raw,
  CASE WHEN abs(o.raw - s.raw) > {JUMP} OR o.raw + s.off <= s.out_ns THEN s.out_ns + 1000 ELSE o.raw + s.off END,
  CASE WHEN abs(o.raw - s.raw) > {JUMP} OR o.raw + s.off <= s.out_ns THEN s.out_ns + 1000 - o.raw ELSE s.off END,
  s.epoch + CASE WHEN abs(o.raw - s.raw) > {JUMP} THEN 1 ELSE 0 END,
  NOT abs(o.raw - s.raw) > {JUMP} AND o.raw + s.off <= s.out_ns""",
             "SELECT frame_id, out_ns, off AS offset_ns, epoch, corrected FROM seq"))
def offset_guard(t: Tables):
    """T2 from the stamp before alone, as running sums."""
    out = W.offset_guard(_arrivals(t), U, ["frame_id"], "t_ns", 1000, JUMP, part_rows=PARTS)
    return out.select("frame_id", "out_ns", "offset_ns", "epoch", "corrected")


O_FIX = """o AS (SELECT *, status >= 2 AND var < 0.1 AS rtk, row_number() OVER (PARTITION BY user_id ORDER BY t_ns) AS n FROM fixes WHERE status >= 0)"""


@query(_walk("fixes", O_FIX, "user_id, n, frame_id, true AS ok, t_ns, lat, lon, 0::DOUBLE AS speed, NULL::DOUBLE AS hd, x AS ax, y AS ay",
             """o.user_id, o.n, o.frame_id, z.ok, CASE WHEN z.ok THEN o.t_ns ELSE s.t_ns END, CASE WHEN z.ok THEN o.lat ELSE s.lat END, CASE WHEN z.ok THEN o.lon ELSE s.lon END,
  CASE WHEN z.ok THEN z.v ELSE s.speed END,
  CASE WHEN z.ok AND z.m THEN degrees(atan2(o.x - s.ax, o.y - s.ay)) - 360 * floor(degrees(atan2(o.x - s.ax, o.y - s.ay)) / 360) ELSE s.hd END,
  CASE WHEN z.ok AND z.m THEN o.x ELSE s.ax END, CASE WHEN z.ok AND z.m THEN o.y ELSE s.ay END""",
             "SELECT frame_id, round(speed, 6) AS speed_mps, round(hd, 5) AS heading_deg FROM seq WHERE ok").replace(
    "JOIN o ON o.user_id = s.user_id AND o.n = s.n + 1)", """JOIN o ON o.user_id = s.user_id AND o.n = s.n + 1,
  LATERAL (SELECT sqrt(((o.lat - s.lat) * 111000) ** 2 + ((o.lon - s.lon) * 111000 * cos(radians(o.lat))) ** 2) / ((o.t_ns - s.t_ns) / 1e9) AS v,
    v <= 0.03 AS ok, sqrt((o.x - s.ax) ** 2 + (o.y - s.ay) ** 2) > CASE WHEN o.rtk THEN 100 ELSE 900 END AS m) z)"""))
def gnss_track(t: Tables):
    fixes = is_rtk(valid_fix(t.fixes())).select("frame_id", *U, "t_ns", "lat", "lon", "x", "y", "is_rtk")
    out = run_sequential(fixes, U, ["t_ns"], T.gnss_track(0.03, 100.0, 900.0), segments=SEGMENTS)
    return out.select("frame_id", r("speed_mps"), r("heading_deg", 5))


def _toward(x: str, y: str) -> str:
    turn = f"degrees(atan2(o.x - {x}, o.y - {y}))"
    return f"{turn} - 360 * floor({turn} / 360)"


@query(_walk("fixes", O_FIX, "user_id, n, frame_id, x AS wx, y AS wy, rtk AS dat, CASE WHEN rtk THEN x END AS rx, CASE WHEN rtk THEN y END AS ry, x AS px, y AS py, NULL::DOUBLE AS hd, NULL::VARCHAR AS src",
             f"""o.user_id, o.n, o.frame_id, CASE WHEN a.mv THEN o.x ELSE s.wx END, CASE WHEN a.mv THEN o.y ELSE s.wy END, b.dat AND NOT c.used,
  CASE WHEN a.far AND o.rtk THEN o.x ELSE b.rx END, CASE WHEN a.far AND o.rtk THEN o.y ELSE b.ry END, CASE WHEN a.far THEN o.x ELSE s.px END, CASE WHEN a.far THEN o.y ELSE s.py END,
  CASE WHEN c.used THEN {_toward("b.rx", "b.ry")} WHEN a.far THEN {_toward("s.px", "s.py")} END, CASE WHEN c.used THEN 'datum' WHEN a.far THEN 'movement' END""",
             "SELECT frame_id, round(hd, 5) AS heading_deg, src AS heading_from FROM seq WHERE hd IS NOT NULL").replace(
    "JOIN o ON o.user_id = s.user_id AND o.n = s.n + 1)", """JOIN o ON o.user_id = s.user_id AND o.n = s.n + 1,
  LATERAL (SELECT sqrt((o.x - s.wx) ** 2 + (o.y - s.wy) ** 2) > 600 AS mv, sqrt((o.x - s.px) ** 2 + (o.y - s.py) ** 2) > CASE WHEN o.rtk THEN 100 ELSE 900 END AS far) a,
  LATERAL (SELECT o.rtk AND NOT a.mv OR s.dat AS dat, CASE WHEN o.rtk AND NOT a.mv THEN o.x ELSE s.rx END AS rx, CASE WHEN o.rtk AND NOT a.mv THEN o.y ELSE s.ry END AS ry) b,
  LATERAL (SELECT coalesce(a.far AND o.rtk AND b.dat AND sqrt((o.x - b.rx) ** 2 + (o.y - b.ry) ** 2) > 300, false) AS used) c)"""))
def datum_heading(t: Tables):
    """Headings by movement and from places where the vehicle stood."""
    fixes = is_rtk(valid_fix(t.fixes())).select("frame_id", *U, "t_ns", "x", "y", "is_rtk")
    out = run_sequential(fixes, U, ["t_ns"], T.datum_heading(600.0, 300.0, 100.0, 900.0), segments=SEGMENTS)
    return out.select("frame_id", r("heading_deg", 5), "heading_from")


def _circ(buf: str) -> tuple[str, str]:
    """SQL for the circular mean and deviation of a list of degrees."""
    s = f"list_aggregate(list_transform({buf}, lambda v: sin(radians(v))), 'sum') / len({buf})"
    c = f"list_aggregate(list_transform({buf}, lambda v: cos(radians(v))), 'sum') / len({buf})"
    return s, c


YAW = f"(heading_deg - value / 20 - 60 * ((t_ns // {15 * DAY}) % 2))"
O_CAL = f"""o AS (SELECT frame_id, user_id, source <> 'view' AS dual, (heading_deg - ({YAW} - 360 * floor({YAW} / 360)) + 360)
  - 360 * floor((heading_deg - ({YAW} - 360 * floor({YAW} / 360)) + 360) / 360) AS smp,
  row_number() OVER (PARTITION BY user_id ORDER BY t_ns) AS n FROM frames)"""
S_OLD, C_OLD = _circ("s.buf")
S_NEW, C_NEW = _circ("d.nbuf")
CAL_SQL = with_tables("frames", recursive=True) + f""", {O_CAL}, seq AS (
  SELECT user_id, n, frame_id, [smp] AS buf, false AS conv, 0::BIGINT AS rej, smp AS mean, 0::DOUBLE AS std, 'accepted' AS action FROM o WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n, o.frame_id, d.nbuf, CASE WHEN d.act IN ('locked', 'rejected') THEN s.conv ELSE e.nstd < 2 AND len(d.nbuf) >= 5 END,
    CASE d.act WHEN 'locked' THEN CASE WHEN o.dual THEN 0 ELSE s.rej END WHEN 'rejected' THEN s.rej + 1 ELSE 0 END,
    CASE WHEN d.act IN ('locked', 'rejected') THEN s.mean ELSE e.nmean END, CASE WHEN d.act IN ('locked', 'rejected') THEN s.std ELSE e.nstd END,
    CASE WHEN d.act = 'seed' THEN 'accepted' ELSE d.act END
  FROM seq s JOIN o ON o.user_id = s.user_id AND o.n = s.n + 1,
  LATERAL (SELECT {S_OLD} AS os, {C_OLD} AS oc) a,
  LATERAL (SELECT degrees(atan2(a.os, a.oc)) - 360 * floor(degrees(atan2(a.os, a.oc)) / 360) AS om, sqrt(a.os * a.os + a.oc * a.oc) AS orr) b,
  LATERAL (SELECT CASE WHEN o.smp - s.mean > 180 THEN o.smp - s.mean - 360 WHEN o.smp - s.mean < -180 THEN o.smp - s.mean + 360 ELSE o.smp - s.mean END AS drift,
    CASE WHEN o.smp - b.om > 180 THEN o.smp - b.om - 360 WHEN o.smp - b.om < -180 THEN o.smp - b.om + 360 ELSE o.smp - b.om END AS gap,
    greatest(3 * CASE WHEN b.orr >= 1 THEN 0 ELSE degrees(sqrt(-2 * ln(b.orr))) END, 5) AS lim) c,
  LATERAL (SELECT CASE WHEN s.conv AND (NOT o.dual OR abs(c.drift) <= 25) THEN 'locked' WHEN s.conv AND s.rej + 1 < 20 THEN 'rejected'
      WHEN s.conv THEN 'seed' WHEN len(s.buf) >= 5 AND abs(c.gap) > c.lim AND s.rej + 1 < 20 THEN 'rejected'
      WHEN len(s.buf) >= 5 AND abs(c.gap) > c.lim THEN 'reset' ELSE 'accepted' END AS act) g,
  LATERAL (SELECT g.act, CASE g.act WHEN 'locked' THEN s.buf WHEN 'rejected' THEN s.buf WHEN 'seed' THEN [o.smp] WHEN 'reset' THEN [o.smp]
      ELSE list_append(s.buf, o.smp)[greatest(1, len(s.buf) - 18):] END AS nbuf) d,
  LATERAL (SELECT {S_NEW} AS ns, {C_NEW} AS nc) f,
  LATERAL (SELECT degrees(atan2(f.ns, f.nc)) - 360 * floor(degrees(atan2(f.ns, f.nc)) / 360) AS nmean,
    CASE WHEN sqrt(f.ns * f.ns + f.nc * f.nc) >= 1 THEN 0 ELSE degrees(sqrt(-2 * ln(sqrt(f.ns * f.ns + f.nc * f.nc)))) END AS nstd) e)
SELECT frame_id, round(mean, 7) AS offset_deg, round(std, 3) AS offset_std_deg, conv AS converged, rej AS rejects, action FROM seq"""


@query(CAL_SQL)
def heading_calibration(t: Tables):
    """T4: sample buffer, outlier rejection, lock and drift watch; the offset moves every 15 days."""
    shift = F.expr(f"t_ns div {15 * DAY}") % 2
    f = t.frames()
    rows = f.select("frame_id", *U, "t_ns", "heading_deg", (F.col("heading_deg") - F.col("value") / 20 - 60 * shift).alias("yaw_deg"),
                    (F.col("source") != "view").alias("from_dual"))
    out = run_sequential(rows, U, ["t_ns"], T.heading_calibration(), segments=SEGMENTS)
    return out.select("frame_id", r("offset_deg", 7), r("offset_std_deg", 3), "converged", "rejects", "action")


O_XY = "o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t_ns) AS n FROM frames)"


@query(_walk("frames", O_XY, "user_id, n, frame_id, true AS ok, x, y",
             """o.user_id, o.n, o.frame_id, sqrt((o.x - s.x) ** 2 + (o.y - s.y) ** 2) > 700,
  CASE WHEN sqrt((o.x - s.x) ** 2 + (o.y - s.y) ** 2) > 700 THEN o.x ELSE s.x END, CASE WHEN sqrt((o.x - s.x) ** 2 + (o.y - s.y) ** 2) > 700 THEN o.y ELSE s.y END""",
             "SELECT frame_id FROM seq WHERE ok"))
def trajectory_gate(t: Tables):
    f = t.frames().select("frame_id", *U, "t_ns", "x", "y")
    return run_sequential(f, U, ["t_ns"], T.trajectory_gate(700.0), segments=SEGMENTS).select("frame_id")


GATE = f"sqrt((o.x - s.x) ** 2 + (o.y - s.y) ** 2) >= o.sp AND o.t_ns - s.t_ns >= {6 * HOUR}"


@query(_walk("frames", "o AS (SELECT *, 100 * CASE WHEN value <= 5 / 3.6 THEN 2 WHEN value <= 30 / 3.6 THEN 5 WHEN value <= 60 / 3.6 THEN 10 ELSE 20 END AS sp, row_number() OVER (PARTITION BY user_id ORDER BY t_ns) AS n FROM frames)",
             "user_id, n, frame_id, true AS ok, t_ns, x, y",
             f"o.user_id, o.n, o.frame_id, {GATE}, CASE WHEN {GATE} THEN o.t_ns ELSE s.t_ns END, CASE WHEN {GATE} THEN o.x ELSE s.x END, CASE WHEN {GATE} THEN o.y ELSE s.y END",
             "SELECT frame_id FROM seq WHERE ok"))
def keyframe_gate(t: Tables):
    f = t.frames().select("frame_id", *U, "t_ns", "x", "y", (keyframe_distance("value") * 100).alias("spacing_m"))
    return run_sequential(f, U, ["t_ns"], T.keyframe_gate(6 * HOUR), segments=SEGMENTS).select("frame_id")


O_Q = "o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t_ns) AS n FROM odom)"
GATE3 = "(sqrt((o.x - s.x) ** 2 + (o.y - s.y) ** 2) > 900 OR 2 * acos(least(1, abs(o.qz * s.qz + o.qw * s.qw))) > 2.5)"


@query(_walk("odom", O_Q, "user_id, n, frame_id, true AS ok, x, y, qz, qw",
             f"o.user_id, o.n, o.frame_id, {GATE3}, CASE WHEN {GATE3} THEN o.x ELSE s.x END, CASE WHEN {GATE3} THEN o.y ELSE s.y END, CASE WHEN {GATE3} THEN o.qz ELSE s.qz END, CASE WHEN {GATE3} THEN o.qw ELSE s.qw END",
             "SELECT frame_id FROM seq WHERE ok"))
def keyframe_gate_turn(t: Tables):
    """T6 by distance or angle."""
    o = t.odometry().select("frame_id", *U, "t_ns", "x", "y", "z", "qx", "qy", "qz", "qw")
    return run_sequential(o, U, ["t_ns"], T.keyframe_gate_3d(900.0, 2.5), segments=SEGMENTS).select("frame_id")


@query(_walk("frames", O_XY, "user_id, n, frame_id, true AS ok, t_ns",
             f"o.user_id, o.n, o.frame_id, o.t_ns - s.t_ns >= {12 * HOUR}, CASE WHEN o.t_ns - s.t_ns >= {12 * HOUR} THEN o.t_ns ELSE s.t_ns END",
             "SELECT frame_id FROM seq WHERE ok"))
def throttle(t: Tables):
    f = t.frames().select("frame_id", *U, "t_ns")
    return run_sequential(f, U, ["t_ns"], T.throttle(12 * HOUR), segments=SEGMENTS).select("frame_id")


KEPT = f"list_filter(s.acts, lambda a: a >= o.t_ns - {3 * DAY})"
OKAY = f"len({KEPT}) < 3 AND (len({KEPT}) = 0 OR o.t_ns - {KEPT}[len({KEPT})] >= {8 * HOUR})"


@query(_walk("frames", O_XY, "user_id, n, frame_id, true AS ok, [t_ns] AS acts",
             f"o.user_id, o.n, o.frame_id, {OKAY}, CASE WHEN {OKAY} THEN list_append({KEPT}, o.t_ns) ELSE {KEPT} END",
             "SELECT frame_id, ok AS allowed FROM seq"))
def limit_alerts(t: Tables):
    f = t.frames().select("frame_id", *U, "t_ns")
    return run_sequential(f, U, ["t_ns"], T.limit_alerts(3, 3 * DAY, 8 * HOUR), segments=SEGMENTS).select("frame_id", "allowed")


@query(_walk("frames", O_XY, "user_id, n, frame_id, CASE WHEN source = 'error' THEN heading_deg END AS held, source = 'error' AS fresh",
             "o.user_id, o.n, o.frame_id, CASE WHEN o.source = 'error' THEN o.heading_deg ELSE s.held END, o.source = 'error'",
             "SELECT frame_id, held, fresh FROM seq WHERE held IS NOT NULL"))
def hold_last(t: Tables):
    """A value that only some rows carry, held over the others."""
    f = t.frames().select("frame_id", *U, "t_ns", F.when(F.col("source") == "error", F.col("heading_deg")).alias("sample"))
    out = W.hold_last(f, U, ["t_ns"], {"sample": "held"}, part_rows=PARTS)
    return out.select("frame_id", "held", "fresh")
