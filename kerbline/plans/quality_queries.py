"""Queries on audits, verdicts, recordings and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.operators import fleet as L
from kerbline.operators import quality as Q
from kerbline.operators import timejoin as J
from kerbline.operators.windows import class_runs, segment_tags
from kerbline.plans.bindings import HOUR, NS, PARTS, Tables, with_tables
from kerbline.plans.registry import query, r
from kerbline.plans.time_queries import NEAREST, STEPS
from kerbline.sinks import writers as K
from kerbline.sources import readers as R

S = ["session_id"]
T = ["t_ns"]


@query(STEPS + """, a AS (SELECT session_id, source, t_ns, x, y, vx, wz, lag(x) OVER w AS qx2, lag(y) OVER w AS qy2,
  first_value(x) OVER w2 AS fx, first_value(y) OVER w2 AS fy, last_value(x) OVER w2 AS lx, last_value(y) OVER w2 AS ly
  FROM odom WINDOW w AS (PARTITION BY session_id, source ORDER BY t_ns),
    w2 AS (PARTITION BY session_id, source ORDER BY t_ns ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT session_id, source, count(*) AS odom_msgs, round(coalesce(sum(sqrt((x - qx2) * (x - qx2) + (y - qy2) * (y - qy2))), 0), 2) AS path_length_m,
  round(max(vx), 6) AS peak_speed_mps, round(max(wz), 6) AS peak_ang_speed_rps, round((max(t_ns) - min(t_ns)) / 1e9, 6) AS duration_s,
  round(sqrt((max(lx) - max(fx)) * (max(lx) - max(fx)) + (max(ly) - max(fy)) * (max(ly) - max(fy))), 6) AS displacement_m,
  round(coalesce(sum(sqrt((x - qx2) * (x - qx2) + (y - qy2) * (y - qy2))), 0), 4) >= 150000 AND round(max(vx), 6) >= 20 AS moving
FROM a GROUP BY session_id, source""")
def motion_audit_odom(t: Tables):
    by = ["session_id", "source"]
    a = Q.motion_audit_odom(t.odometry(), by, T, part_rows=PARTS)
    a = Q.is_moving(a, 150000.0, 20.0)
    return a.select(*by, "odom_msgs", r("path_length_m", 2), r("peak_speed_mps"), r("peak_ang_speed_rps"),
                    r("duration_s"), r("displacement_m"), "moving")


IMU_SQL = with_tables("imu") + """, m AS (SELECT *, sqrt(ax * ax + ay * ay + az * az) - 9.80665::DOUBLE AS e, sqrt(gx * gx + gy * gy + gz * gz) AS g FROM imu),
a AS (SELECT shard, count(*) AS n_imu, (max(t_ns) - min(t_ns)) / 1e9 AS duration_s, sqrt(avg(e * e)) AS accel_rms, max(abs(e)) AS accel_peak,
  sqrt(avg(g * g)) AS gyro_rms, max(g) AS gyro_peak, stddev_pop(e + 9.80665::DOUBLE) AS imu_accel_std FROM m GROUP BY shard),
c AS (SELECT *, CASE WHEN accel_rms <= 0.35 AND gyro_rms <= 0.025 THEN 'STATIC' WHEN accel_rms <= 0.8 AND gyro_rms <= 0.1 THEN 'MICRO'
  WHEN accel_rms <= 3 AND gyro_rms <= 0.4 THEN 'URBAN' ELSE 'HIGHWAY' END AS class FROM a)
"""


@query(IMU_SQL + """SELECT shard, n_imu, round(duration_s, 2) AS duration_s, round(accel_rms, 5) AS accel_rms, round(accel_peak, 5) AS accel_peak,
  round(gyro_rms, 5) AS gyro_rms, round(gyro_peak, 5) AS gyro_peak, class FROM c""")
def motion_audit_imu(t: Tables):
    a = Q.motion_audit_imu(t.imu(), ["shard"])
    return a.select("shard", "n_imu", r("duration_s", 2), r("accel_rms", 5), r("accel_peak", 5), r("gyro_rms", 5),
                    r("gyro_peak", 5), "class")


@query(IMU_SQL + "SELECT shard, n_imu AS imu_msgs, round(imu_accel_std, 6) AS imu_accel_std FROM c")
def imu_std(t: Tables):
    return Q.imu_std(t.imu(), ["shard"]).select("shard", "imu_msgs", r("imu_accel_std"))


FINE = IMU_SQL.replace("c AS (SELECT *,", "c AS (SELECT *, CASE WHEN accel_peak > 10.2 THEN 'HIGHWAY' WHEN accel_peak > 10 THEN 'URBAN' ELSE 'MICRO' END AS peak_class,")


@query(FINE + "SELECT peak_class, count(*) AS n FROM c GROUP BY peak_class")
def class_histogram(t: Tables):
    a = Q.motion_audit_imu(t.imu(), ["shard"])
    peak = F.when(F.col("accel_peak") > 10.2, "HIGHWAY").when(F.col("accel_peak") > 10, "URBAN").otherwise("MICRO")
    return Q.class_histogram(a.withColumn("peak_class", peak), "peak_class")


@query(FINE + """, g AS (SELECT shard, peak_class, shard - row_number() OVER (PARTITION BY peak_class ORDER BY shard) AS k FROM c)
SELECT peak_class, min(shard) AS start, max(shard) AS "end", count(*) AS n_rows,
  format('{}_{:03d}_{:03d}', lower(peak_class), min(shard), max(shard)) AS tag FROM g GROUP BY peak_class, k""")
def motion_segments(t: Tables):
    """W6 with the segment tags of the motion audit."""
    a = Q.motion_audit_imu(t.imu(), ["shard"])
    peak = F.when(F.col("accel_peak") > 10.2, "HIGHWAY").when(F.col("accel_peak") > 10, "URBAN").otherwise("MICRO")
    runs = class_runs(a.withColumn("peak_class", peak), [], ["shard"], "peak_class", part_rows=PARTS)
    return segment_tags(runs, "peak_class").drop("run_no")


STATS = STEPS + """, ps AS (SELECT session_id, source, t_ns, x, y, qz, qw, lag(t_ns) OVER w AS pt, lag(x) OVER w AS px, lag(y) OVER w AS py,
  lag(qz) OVER w AS pz, lag(qw) OVER w AS pw FROM odom WINDOW w AS (PARTITION BY session_id, source ORDER BY t_ns)),
pd AS (SELECT *, (t_ns - pt) / 1e9 AS dt, sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS d,
  2 * acos(least(1, abs(qz * pz + qw * pw))) AS rot FROM ps),
stats AS (SELECT session_id, source, count(*) AS pose_count, (max(t_ns) - min(t_ns)) / 1e9 AS span_s, coalesce(sum(d), 0) AS cumul_m,
  coalesce(max(d / dt), 0) AS max_speed_mps, coalesce(max(dt), 0) AS max_dt_s, coalesce(sum(rot), 0) AS rot_span_rad,
  max(x) - min(x) AS extent_x, max(y) - min(y) AS extent_y, coalesce(quantile_cont(d / dt, 0.99), 0) AS p99_speed_mps FROM pd GROUP BY session_id, source),
full_stats AS (SELECT *, CASE WHEN span_s > 0 THEN (pose_count - 1) / span_s ELSE 0 END AS rate_hz,
  CASE WHEN span_s > 0 THEN cumul_m / span_s ELSE 0 END AS mean_speed_mps FROM stats)
"""


def _stats(t: Tables):
    return Q.pose_stats(t.odometry(), ["session_id", "source"], T, part_rows=PARTS)


@query(STATS + """SELECT session_id, source, pose_count, round(span_s, 3) AS span_s, round(rate_hz, 8) AS rate_hz, round(cumul_m, 2) AS cumul_m,
  round(mean_speed_mps, 6) AS mean_speed_mps, round(p99_speed_mps, 6) AS p99_speed_mps, round(max_speed_mps, 6) AS max_speed_mps,
  round(max_dt_s, 6) AS max_dt_s, round(rot_span_rad, 4) AS rot_span_rad, round(extent_x, 6) AS extent_x, round(extent_y, 6) AS extent_y FROM full_stats""")
def pose_stats(t: Tables):
    return _stats(t).select("session_id", "source", "pose_count", r("span_s", 3), r("rate_hz", 8), r("cumul_m", 2),
                            r("mean_speed_mps"), r("p99_speed_mps"), r("max_speed_mps"), r("max_dt_s"), r("rot_span_rad", 4),
                            r("extent_x"), r("extent_y"))


@query(STATS + """SELECT session_id, source,
  CASE WHEN mean_speed_mps > 0.1 OR p99_speed_mps > 0.1 OR greatest(extent_x, extent_y) > 1975 THEN 'FAIL'
    WHEN p99_speed_mps > 0.05 OR (rate_hz > 0 AND rate_hz < 0.00002) OR max_dt_s > 300000 THEN 'WARN' ELSE 'PASS' END AS verdict,
  concat_ws('; ', CASE WHEN mean_speed_mps > 0.1 THEN printf('mean_speed=%.1f>0.1 m/s', mean_speed_mps) END,
    CASE WHEN p99_speed_mps > 0.1 THEN printf('p99_speed=%.1f>0.1 m/s', p99_speed_mps) END,
    CASE WHEN greatest(extent_x, extent_y) > 1975 THEN printf('extent=%.0f>1975.0 m', greatest(extent_x, extent_y)) END) AS reasons
FROM full_stats""")
def verdict(t: Tables):
    v = Q.verdict(_stats(t).withColumn("max_dt_s", F.when(F.col("max_dt_s") > 300000, 2.0).otherwise(0.5)),
                  rules="card", max_speed=0.1, max_extent=1975.0, min_rate=0.00002)
    return v.select("session_id", "source", "verdict", "reasons")


@query(STATS + """SELECT session_id, source, CASE WHEN p99_speed_mps > 0.1 OR greatest(extent_x, extent_y) > 1975 THEN 'FAIL'
    WHEN p99_speed_mps > 0.05 OR rate_hz < 0.00002 THEN 'WARN' ELSE 'PASS' END AS verdict FROM full_stats""")
def verdict_audit(t: Tables):
    v = Q.verdict(_stats(t), rules="audit", max_speed=0.1, max_extent=1975.0, min_rate=0.00002)
    return v.select("session_id", "source", "verdict")


MATCH = NEAREST + f""",
p AS (SELECT *, row_number() OVER (PARTITION BY session_id, rid ORDER BY abs(rt - t_ns), t_ns) AS rn FROM n WHERE abs(rt - t_ns) <= {2 * HOUR}),
pairs AS (SELECT p.session_id, p.t_ns, l.x, l.y, radians(l.heading_deg) AS h, e.x AS ex, e.y AS ey, radians(e.heading_deg) AS eh
  FROM p JOIN frames l ON l.frame_id = p.frame_id JOIN frames e ON e.frame_id = p.rid WHERE rn = 1),
err AS (SELECT session_id, sqrt((x - ex) * (x - ex) + (y - ey) * (y - ey)) AS e FROM pairs)
"""
ERR_COLS = """session_id, count(*) AS n_pairs, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(e), 4) AS mean,
  round(stddev_pop(e), 4) AS std, round(min(e), 4) AS "min", round(max(e), 4) AS "max", round(median(e), 4) AS median"""


def _matched(t: Tables):
    o = t.odometry()
    cols = [*S, *T, "x", "y", "z", "qx", "qy", "qz", "qw"]
    est = o.filter("source = 'error'").select(*cols, F.col("frame_id").alias("id"))
    return J.associate(o.filter("source <> 'error'").select(*cols), est, S, 2 * HOUR, part_rows=PARTS)


def _errors(stats):
    return stats.select("session_id", "n_pairs", *[r(c, 4) for c in ("rmse", "mean", "std", "min", "max", "median")])


@query(MATCH + f"SELECT {ERR_COLS} FROM err GROUP BY session_id")
def ate(t: Tables):
    return _errors(Q.ate(_matched(t), S))


RPE_SQL = MATCH.replace("WITH ", "WITH RECURSIVE ", 1) + f""", st AS (SELECT *, row_number() OVER w AS n,
  coalesce(sqrt((ex - lag(ex) OVER w) ** 2 + (ey - lag(ey) OVER w) ** 2), 0) AS d FROM pairs WINDOW w AS (PARTITION BY session_id ORDER BY t_ns)),
walk AS (SELECT session_id, n, 0::DOUBLE AS gone, false AS hit FROM st WHERE n = 1 UNION ALL
  SELECT st.session_id, st.n, CASE WHEN walk.gone + st.d >= 1000 THEN 0 ELSE walk.gone + st.d END, walk.gone + st.d >= 1000
  FROM walk JOIN st ON st.session_id = walk.session_id AND st.n = walk.n + 1),
lg AS (SELECT st.*, lag(x) OVER w AS ox, lag(y) OVER w AS oy, lag(h) OVER w AS oh, lag(ex) OVER w AS oex, lag(ey) OVER w AS oey, lag(eh) OVER w AS oeh
  FROM st JOIN walk USING (session_id, n) WHERE hit WINDOW w AS (PARTITION BY session_id ORDER BY n)),
rl AS (SELECT *, cos(oh) * (x - ox) + sin(oh) * (y - oy) AS wx, -sin(oh) * (x - ox) + cos(oh) * (y - oy) AS wy,
  cos(oeh) * (ex - oex) + sin(oeh) * (ey - oey) AS gx, -sin(oeh) * (ex - oex) + cos(oeh) * (ey - oey) AS gy FROM lg WHERE ox IS NOT NULL),
er AS (SELECT session_id, sqrt((gx - wx) * (gx - wx) + (gy - wy) * (gy - wy)) AS e FROM rl)
SELECT {ERR_COLS} FROM er GROUP BY session_id"""


@query(RPE_SQL)
def rpe(t: Tables):
    return _errors(Q.rpe(_matched(t), S, delta=1000.0, part_rows=PARTS))


@query(MATCH + """, m AS (SELECT session_id, avg(ex) AS sx, avg(ey) AS sy, avg(x) AS dx, avg(y) AS dy,
  covar_pop(x, ex) + covar_pop(y, ey) AS c, covar_pop(y, ex) - covar_pop(x, ey) AS s,
  covar_pop(x, ex) - covar_pop(y, ey) AS c2, covar_pop(y, ex) + covar_pop(x, ey) AS s2 FROM pairs GROUP BY session_id),
an AS (SELECT *, atan2(s, c) AS th, atan2(s2, c2) AS th2, c * c + s * s >= c2 * c2 + s2 * s2 AS keep FROM m)
SELECT session_id, round(CASE WHEN keep THEN dx - (cos(th) * sx - sin(th) * sy) ELSE dx - (cos(th2) * sx + sin(th2) * sy) END, 3) AS tx,
  round(CASE WHEN keep THEN dy - (sin(th) * sx + cos(th) * sy) ELSE dy - (sin(th2) * sx - cos(th2) * sy) END, 3) AS ty FROM an""")
def align_rigid(t: Tables):
    """A13 on planar tracks: the best turn, or the best turn of the plane turned over, in closed form."""
    m = _matched(t)
    return Q.align_rigid(m, S).select("session_id", r("tx", 3), r("ty", 3))


@query(with_tables("cards") + """, live AS (SELECT DISTINCT tag FROM cards WHERE verdict <> 'NO_EXPORT'),
f AS (SELECT *, row_number() OVER (PARTITION BY tag, engine ORDER BY card_id) AS rn FROM cards WHERE tag IN (SELECT tag FROM live))
SELECT tag, max(verdict) FILTER (WHERE engine = 'F') AS F_verdict, max(pose_rate_hz) FILTER (WHERE engine = 'F') AS F_pose_rate_hz,
  max(verdict) FILTER (WHERE engine = 'O') AS O_verdict, max(pose_rate_hz) FILTER (WHERE engine = 'O') AS O_pose_rate_hz,
  max(verdict) FILTER (WHERE engine = 'P') AS P_verdict, max(pose_rate_hz) FILTER (WHERE engine = 'P') AS P_pose_rate_hz
FROM f WHERE rn = 1 GROUP BY tag""")
def diagnosis_matrix(t: Tables):
    return Q.diagnosis_matrix(t.cards(), ["F", "O", "P"], ("verdict", "pose_rate_hz"))


@query(with_tables("cards") + """, live AS (SELECT DISTINCT tag FROM cards WHERE verdict <> 'NO_EXPORT')
SELECT engine, class, count(*) FILTER (WHERE verdict = 'PASS') AS "PASS", count(*) FILTER (WHERE verdict = 'WARN') AS "WARN",
  count(*) FILTER (WHERE verdict = 'FAIL') AS "FAIL", count(*) FILTER (WHERE verdict = 'NO_EXPORT') AS "NO_EXPORT"
FROM cards WHERE tag IN (SELECT tag FROM live) GROUP BY engine, class""")
def verdict_counts(t: Tables):
    return Q.verdict_counts(t.cards())


@query(with_tables("cards") + """, f AS (SELECT *, row_number() OVER (PARTITION BY tag, engine ORDER BY card_id) AS rn FROM cards),
w AS (SELECT tag, max(verdict) FILTER (WHERE engine = 'F') AS fv, max(verdict) FILTER (WHERE engine = 'O') AS ov, max(verdict) FILTER (WHERE engine = 'P') AS pv
  FROM f WHERE rn = 1 GROUP BY tag)
SELECT tag, '| ' || tag || ' | URBAN | 3 | ' || coalesce(fv, '—') || ' | ' || coalesce(ov, '—') || ' | ' || coalesce(pv, '—') || ' |' AS line FROM w""")
def matrix_report(t: Tables):
    m = Q.diagnosis_matrix(t.cards(), ["F", "O", "P"], ("verdict",))
    m = m.withColumn("class", F.lit("URBAN")).withColumn("n_bags", F.lit(3))
    return K.matrix_report(m, ["F", "O", "P"], ("verdict",))


@query(with_tables("cards") + """, segs AS (SELECT tag, min(class) AS class, CAST(count(*) AS INTEGER) AS n_bags FROM cards WHERE tag IN ('1', '2', '3') GROUP BY tag),
legacy AS (SELECT * FROM (VALUES ('3', 'MIXED', 7), ('4', 'MIXED', 8)) v(tag, class, n_bags))
SELECT c.card_id, c.tag, coalesce(s.class, l.class, '?') AS seg_class, coalesce(s.n_bags, l.n_bags) AS n_bags
FROM cards c LEFT JOIN segs s ON c.tag = s.tag LEFT JOIN legacy l ON c.tag = l.tag""")
def lookup_segment(t: Tables):
    cards = t.cards()
    segs = cards.filter(F.col("tag").isin("1", "2", "3")).groupBy("tag").agg(
        F.min("class").alias("class"), F.count(F.lit(1)).cast("int").alias("n_bags"))
    segs = segs.withColumn("start", F.lit(0)).withColumn("end", F.lit(1))
    legacy = t.spark.createDataFrame([("3", "MIXED", 7, 8, 14), ("4", "MIXED", 8, 23, 30)],
                                     "tag string, class string, n_bags int, start int, end int")
    out = Q.lookup_segment(cards.select("card_id", "tag"), segs, legacy)
    return out.select("card_id", "tag", F.col("class").alias("seg_class"), "n_bags")


@query(with_tables("shards") + """SELECT session_id, topic, CAST(sum(count) AS BIGINT) AS n_messages,
  round((max(end_ns) - min(start_ns)) / 1e9, 3) AS duration_s, round(sum(count) / ((max(end_ns) - min(start_ns)) / 1e9), 9) AS rate_hz
FROM shards GROUP BY session_id, topic""")
def topic_rates(t: Tables):
    out = Q.topic_rates(t.shards(), ["session_id", "topic"])
    return out.select("session_id", "topic", "n_messages", r("duration_s", 3), r("rate_hz", 9))


@query(with_tables("frames") + """, o AS (SELECT source AS topic, count(*) / 2592000.0 AS rate_hz FROM frames GROUP BY source),
x AS (SELECT * FROM (VALUES ('click', 0.001), ('error', 1.0), ('purchase', 0.00001), ('signup', 0.0002), ('view', 5.0), ('lidar', 1.0)) v(topic, min_hz))
SELECT x.topic, CAST(x.min_hz AS DOUBLE) AS min_hz, round(CAST(coalesce(o.rate_hz, 0) AS DOUBLE), 8) AS rate_hz,
  CASE WHEN o.rate_hz IS NULL THEN 'MISSING' WHEN o.rate_hz < x.min_hz THEN 'LOW' ELSE 'OK' END AS status FROM x LEFT JOIN o USING (topic)""")
def rate_compliance(t: Tables):
    seen = t.frames().groupBy(F.col("source").alias("topic")).agg((F.count(F.lit(1)) / 2592000.0).alias("rate_hz"))
    want = t.spark.createDataFrame([("click", 0.001), ("error", 1.0), ("purchase", 0.00001), ("signup", 0.0002),
                                    ("view", 5.0), ("lidar", 1.0)], "topic string, min_hz double")
    return Q.rate_compliance(seen, want).select("topic", "min_hz", r("rate_hz", 8), "status")


@query(with_tables("frames") + """, m AS (SELECT session_id, source, avg(sin(radians(heading_deg))) AS s, avg(cos(radians(heading_deg))) AS c, count(*) AS n
  FROM frames GROUP BY session_id, source),
d AS (SELECT *, degrees(atan2(s, c)) AS a, sqrt(s * s + c * c) AS l FROM m)
SELECT session_id, source, n, round(a - 360 * floor(a / 360), 4) AS mean_deg, round(degrees(sqrt(-2 * ln(l))), 4) AS std_deg FROM d""")
def circular_mean_std(t: Tables):
    out = Q.circular_mean_std(t.frames(), ["session_id", "source"], "heading_deg")
    return out.select("session_id", "source", "n", r("mean_deg", 4), r("std_deg", 4))


@query(with_tables("frames") + """, c AS (SELECT user_id, count(*) FILTER (WHERE source = 'click') AS click, count(*) FILTER (WHERE source = 'view') AS view,
  count(*) FILTER (WHERE source = 'error') AS error FROM frames GROUP BY user_id),
m AS (SELECT user_id, min(x) AS x, arg_min(heading_deg, t_ns) AS h, min(value) - 40 AS lo, max(value) AS hi FROM frames GROUP BY user_id),
i AS (SELECT c.*, click + view + error AS total_frames, x, h, lo, hi FROM c LEFT JOIN m USING (user_id))
SELECT user_id, total_frames, array_to_string(list_filter([
  CASE WHEN total_frames = 0 THEN 'no_frames' WHEN total_frames < 40 THEN printf('too_few_frames(%d)', total_frames) END,
  CASE WHEN click < 14 THEN printf('click_low(%d)', click) END, CASE WHEN view < 14 THEN printf('view_low(%d)', view) END,
  CASE WHEN error < 14 THEN printf('error_low(%d)', error) END,
  CASE WHEN x < 4 THEN 'bad_bng' END, CASE WHEN h = 0 THEN 'no_heading' END,
  CASE WHEN user_id % 3 = 0 THEN 'no_heading_source' END, CASE WHEN user_id % 5 = 0 THEN 'no_radiometric' END,
  CASE WHEN lo < -39 OR hi > 80 THEN 'bad_temps' END], lambda x: x IS NOT NULL), ',') AS issues FROM i""")
def audit_session(t: Tables):
    f = t.frames()
    meta = f.groupBy("user_id").agg(F.min("x").alias("x"), F.min_by("heading_deg", "t_ns").alias("heading_deg"),
                                    (F.min("value") - 40).alias("min_temp_c"), F.max("value").alias("max_temp_c"))
    meta = meta.withColumn("heading_source", F.when(F.col("user_id") % 3 != 0, F.lit("dual_antenna")))
    meta = meta.withColumn("is_thermal", F.lit(True)).withColumn("has_radiometric", F.col("user_id") % 5 != 0)
    out = Q.audit_session(f.withColumn("camera", F.col("source")), meta, "user_id", ["click", "view", "error"],
                          min_per_camera=14, min_grid_x=4.0, temp_band=(-39.0, 80.0))
    short = F.transform("issues", lambda i: F.regexp_replace(i, r"^bad_temps\(.*$", "bad_temps"))
    return out.select("user_id", "total_frames", F.concat_ws(",", short).alias("issues"))


@query(with_tables("cards") + """SELECT tag, count(*) FILTER (WHERE verdict = 'PASS') AS n_pass, count(*) FILTER (WHERE verdict = 'WARN') AS n_warn,
  count(*) FILTER (WHERE verdict = 'FAIL') AS n_fail,
  CASE WHEN count(*) FILTER (WHERE verdict = 'FAIL') > 0 THEN 2 WHEN count(*) FILTER (WHERE verdict = 'WARN') > 0 THEN 1 ELSE 0 END AS exit_code
FROM cards GROUP BY tag""")
def health_rollup(t: Tables):
    return Q.health_rollup(t.cards().withColumn("status", F.col("verdict")), ["tag"])


@query("""SELECT o_custkey % 10 AS shard, o_orderstatus AS topic, count(*) AS count, min(epoch_us(o_orderdate) * 1000) AS start_ns,
  max(epoch_us(o_orderdate) * 1000) AS end_ns, CAST(sum(length(o_orderpriority)) AS BIGINT) AS bytes FROM orders GROUP BY 1, 2""")
def shard_index(t: Tables):
    m = t.raw("orders").select((F.col("o_custkey") % 10).alias("shard"), F.col("o_orderstatus").alias("topic"),
                               t._ns("o_orderdate").alias("log_time_ns"), F.encode("o_orderpriority", "UTF-8").alias("payload"))
    return L.shard_index(m)


@query(with_tables("shards") + """SELECT session_id, CAST(sum(count) AS BIGINT) AS message_count, min(start_ns) AS start_ns, max(end_ns) AS end_ns,
  max(end_ns) - min(start_ns) AS duration_ns, count(DISTINCT shard) AS shard_count, CAST(count(DISTINCT topic) AS INTEGER) AS n_topics FROM shards GROUP BY session_id""")
def recording_metadata(t: Tables):
    m = L.recording_metadata(t.shards())
    return m.select("session_id", "message_count", "start_ns", "end_ns", "duration_ns", "shard_count", F.size("topics").alias("n_topics"))


RANGE = (852076800 * NS, 857260800 * NS)


@query(with_tables("shards") + f"SELECT shard FROM shards WHERE shard % 11 = 0 OR (end_ns >= {RANGE[0]} AND start_ns <= {RANGE[1]})")
def overlapping_shards(t: Tables):
    s = t.shards().withColumn("end_ns", F.when(F.col("shard") % 11 != 0, F.col("end_ns")))
    return L.overlapping_shards(s, *RANGE).select("shard")


@query(with_tables("shards") + f"""SELECT shard, bytes_from_here, bytes_from_here > 100000000 AND k < n AS is_victim FROM (
  SELECT shard, CAST(sum(bytes) OVER (PARTITION BY session_id ORDER BY start_ns DESC, shard DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bytes_from_here,
    row_number() OVER (PARTITION BY session_id ORDER BY start_ns, shard) AS k, count(*) OVER (PARTITION BY session_id) AS n FROM shards)""")
def retention_plan(t: Tables):
    out = L.retention_plan(t.shards(), 100_000_000, S, ["start_ns", "shard"], part_rows=PARTS)
    return out.select("shard", "bytes_from_here", "is_victim")


@query(with_tables("shards") + """, l AS (SELECT *, max(idx) OVER (PARTITION BY session_id) AS last FROM shards)
SELECT shard FROM l WHERE idx < last OR (session_id % 2 = 0 AND 100 - (shard % 100) >= 60)""")
def sealed_shards(t: Tables):
    s = t.shards().withColumn("now_s", F.lit(100)).withColumn("modified_s", F.col("shard") % 100).withColumn(
        "recorder_alive", F.col("session_id") % 2 != 0)
    return L.sealed_shards(s, S).select("shard")


@query(with_tables("shards") + """SELECT session_id, shard FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY idx DESC) AS rn FROM shards) WHERE rn = 2""")
def latest_complete(t: Tables):
    return L.latest_complete(t.shards(), S, "idx").select("session_id", "shard")


@query("""SELECT name, CAST(shard_no AS INTEGER) AS shard_no FROM (SELECT 'rec_' || CAST(o_orderkey AS VARCHAR) || '.mcap' AS name, o_orderkey AS shard_no FROM orders)
ORDER BY shard_no LIMIT 50""")
def first_shards(t: Tables):
    """Natural order, then the first fifty."""
    names = t.raw("orders").select(F.format_string("rec_%d.mcap", "o_orderkey").alias("name"))
    return L.first_n(names, 50, "name")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def pending_work(t: Tables):
    done = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.pending(t.raw("orders").select("o_orderkey"), done, ["o_orderkey"])


@query("""SELECT DISTINCT c_custkey AS uprn FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def missing_keys(t: Tables):
    seen = t.raw("orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("uprn"))
    return L.missing(t.raw("customer").select(F.col("c_custkey").alias("uprn")), seen, ["uprn"])


@query(with_tables("frames") + "SELECT DISTINCT camera_side, frame_id % 100 AS stem FROM frames")
def keep_set(t: Tables):
    f = t.frames().withColumn("stem", F.col("frame_id") % 100)
    return L.keep_set(f, ["camera_side", "stem"])


@query(with_tables("frames") + """SELECT frame_id, camera_side, value FROM frames WHERE source = 'view'
UNION ALL SELECT frame_id, NULL, value FROM frames WHERE source <> 'view'""")
def union_cameras(t: Tables):
    f = t.frames()
    return L.union_all([f.filter("source = 'view'").select("frame_id", "camera_side", "value"),
                        f.filter("source <> 'view'").select("frame_id", "value")])


LOGLINE = "CASE WHEN doc_id % 4 = 0 THEN 'drop   0% ' WHEN doc_id % 4 = 1 THEN 'drop 7% ' WHEN doc_id % 4 = 2 THEN 'ERROR ' ELSE '' END || text"
NOISE_SQL = "(?i)type hash|USER_DATA|sequence size|Failed to parse|Could not set gain|enumentr|error_handling\\.c|rcutils_reset_error|This error state is being overwritten|with this new error message|drop\\s+0%|Failed to load schemaDefinition for topic \"/rtcm\""


@query(f"""WITH lines AS (SELECT doc_id, source, {LOGLINE} AS line FROM documents),
h AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM lines
  WHERE NOT regexp_matches(line, '{NOISE_SQL}') AND regexp_matches(line, '(?i)error|fatal|\\bfail|drop\\s+[1-9]|incomplete|disconnect|\\btimeout|segfault|abort'))
SELECT source, doc_id, CAST(rank AS INTEGER) AS rank FROM h WHERE rank <= 3""")
def error_lines(t: Tables):
    k = F.col("doc_id") % 4
    lead = F.when(k == 0, "drop   0% ").when(k == 1, "drop 7% ").when(k == 2, "ERROR ").otherwise("")
    logs = t.raw("documents").select("doc_id", "source", F.concat(lead, F.col("text")).alias("line"))
    return L.error_lines(logs, "source", ["doc_id"]).select("source", "doc_id", "rank")


NAMED = "SELECT event_id, 'rec' || CAST(user_id % 10 AS VARCHAR) AS recording, event_type AS side, 'f' || CAST(event_id AS VARCHAR) || CASE event_id % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.npy' WHEN 2 THEN '.meta.json' ELSE '.tmp' END AS file FROM events"


@query(f"""WITH f AS ({NAMED}) SELECT event_id, CASE WHEN file LIKE '%.jpg' THEN 'bags/' || recording || '/images/' || side || '/' || file
  WHEN file LIKE '%.npy' THEN 'bags/' || recording || '/raw_npy/' || file ELSE 'bags/' || recording || '/meta/' || side || '/' || file END AS object_key,
  CASE WHEN file LIKE '%.jpg' THEN 'image/jpeg' WHEN file LIKE '%.npy' THEN 'application/octet-stream' ELSE 'application/json' END AS content_type
FROM f WHERE file NOT LIKE '%.tmp'""")
def object_keys(t: Tables):
    k = F.col("event_id") % 4
    ending = F.when(k == 0, ".jpg").when(k == 1, ".npy").when(k == 2, ".meta.json").otherwise(".tmp")
    files = t.raw("events").select(
        "event_id", F.concat(F.lit("rec"), (F.col("user_id") % 10).cast("string")).alias("recording"),
        F.col("event_type").alias("side"), F.concat(F.lit("f"), F.col("event_id").cast("string"), ending).alias("file"))
    return L.object_keys(files).select("event_id", "object_key", "content_type")


@query(with_tables("frames") + f""", w AS (SELECT source, t_ns - t_ns % {6 * HOUR} AS window_ns, count(*) / {6 * 3600}.0 AS rate_hz FROM frames GROUP BY 1, 2)
SELECT source, window_ns, round(CAST(rate_hz AS DOUBLE), 9) AS rate_hz FROM w""")
def rate_windows(t: Tables):
    return L.rate_windows(t.frames(), ["source"], 6 * 3600).select("source", "window_ns", r("rate_hz", 9))


@query(with_tables("frames") + f""", w AS (SELECT session_id, source, t_ns - t_ns % {6 * HOUR} AS window_ns, count(*) AS n FROM frames GROUP BY 1, 2, 3),
m AS (SELECT *, sum(CASE WHEN n >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, source ORDER BY window_ns) AS ok FROM w),
s AS (SELECT session_id, source, min(window_ns) AS start_ns, max(window_ns) AS last, min(n) AS n FROM m WHERE n < 3 GROUP BY session_id, source, ok)
SELECT session_id, source, start_ns, (last - start_ns) / 1e9 + {6 * 3600} AS low_s, round(n / {6 * 3600}::DOUBLE, 9) AS min_rate_hz FROM s WHERE (last - start_ns) / 1e9 + {6 * 3600} >= {18 * 3600}""")
def rate_floor(t: Tables):
    out = L.rate_floor(t.frames(), ["session_id", "source"], 3 / (6 * 3600), 6 * 3600, 18 * 3600)
    return out.select("session_id", "source", "start_ns", F.col("low_s").cast("double").alias("low_s"), r("min_rate_hz", 9))


@query(with_tables("frames") + """, m AS (SELECT frame_id, t_ns, source, value, CASE frame_id % 3 WHEN 0 THEN 'rate' WHEN 1 THEN 'temp' ELSE 'offset' END AS metric FROM frames)
SELECT frame_id, metric, CASE metric WHEN 'rate' THEN 'below' WHEN 'temp' THEN 'above' ELSE 'abs_above' END AS test FROM m
WHERE (metric = 'rate' AND source = 'view' AND value < 8) OR (metric = 'temp' AND value > 75) OR (metric = 'offset' AND abs(value) > 100)""")
def soak_alerts(t: Tables):
    k = F.col("frame_id") % 3
    metrics = t.frames().withColumn("metric", F.when(k == 0, "rate").when(k == 1, "temp").otherwise("offset"))
    rules = t.spark.createDataFrame([("rate", "view", "below", 8.0), ("temp", None, "above", 75.0), ("offset", None, "abs_above", 100.0)],
                                    "metric string, source string, test string, limit double")
    return L.soak_alerts(metrics.select("frame_id", "t_ns", "metric", "source", "value"), rules).select("frame_id", "metric", "test")


@query(with_tables("frames") + f""", w AS (SELECT t_ns - t_ns % {HOUR} AS w, bool_or(value > 60) AS any_flow FROM frames WHERE source <> 'error' GROUP BY 1)
SELECT f.frame_id, CASE WHEN NOT coalesce(w.any_flow, false) THEN 'suppressed' WHEN f.session_id IN (1, 2) THEN 'log_only' ELSE 'act' END AS action
FROM frames f LEFT JOIN w ON f.t_ns - f.t_ns % {HOUR} = w.w WHERE f.source = 'error'""")
def suppress_global(t: Tables):
    f = t.frames()
    alerts = f.filter("source = 'error'").withColumn("key", F.col("session_id"))
    flowing = f.filter("source <> 'error'").withColumn("is_flowing", F.col("value") > 60)
    return L.suppress_global(alerts, flowing, [1, 2], window_ns=HOUR).select("frame_id", "action")


@query("""SELECT o_custkey, max(o_orderkey) AS version FROM orders GROUP BY o_custkey""")
def merge_progress(t: Tables):
    o = t.raw("orders").select("o_custkey", F.col("o_orderkey").alias("version"))
    return L.merge_progress(o.filter("version % 2 = 0"), o.filter("version % 2 = 1"), ["o_custkey"], "version")


@query("""WITH a AS (SELECT c_custkey AS uprn, CAST((c_custkey * 7919) % 2000 AS DOUBLE) AS x, CAST((c_custkey * 104729) % 2000 AS DOUBLE) AS y FROM customer),
ad AS (SELECT o_custkey AS uprn, min(o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR)) AS fulladdress FROM orders GROUP BY 1),
xr AS (SELECT o_custkey AS uprn, min(o_orderkey % 100) AS osid FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT a.uprn, CAST(floor(x / 50) AS BIGINT) AS grid_x, CAST(floor(y / 50) AS BIGINT) AS grid_y, ad.fulladdress, xr.osid, s.s_acctbal AS building_height_m
FROM a LEFT JOIN ad USING (uprn) LEFT JOIN xr USING (uprn) LEFT JOIN supplier s ON s.s_suppkey = xr.osid""")
def property_table(t: Tables):
    """S7 from customers (places), orders (addresses, cross-references) and suppliers (buildings)."""
    o = t.raw("orders")
    addr = o.select(F.col("o_custkey").alias("uprn"), F.concat_ws("/", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("fulladdress"))
    xref = o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("uprn"), (F.col("o_orderkey") % 100).alias("osid"))
    bldg = t.raw("supplier").select(F.col("s_suppkey").alias("osid"), F.col("s_acctbal").alias("building_height_m"))
    out = R.build_property_table(t.properties().select("uprn", "x", "y"), addr, xref, bldg)
    return out.select("uprn", "grid_x", "grid_y", "fulladdress", "osid", "building_height_m")


@query(STATS + """SELECT session_id, source, CAST(pose_count AS VARCHAR) AS pose_count, printf('%.2f', span_s) AS time_span_s, printf('%.2f', p99_speed_mps) AS p99_speed_mps,
  printf('%.1f', extent_x) AS extent_x_m, CASE WHEN rate_hz > 0 AND rate_hz < 0.00002 THEN printf('rate=%.2f<2e-05 Hz', rate_hz) END AS warn_rate,
  CASE WHEN mean_speed_mps > 0.1 OR p99_speed_mps > 0.1 OR greatest(extent_x, extent_y) > 1975 THEN 'FAIL'
    WHEN p99_speed_mps > 0.05 OR (rate_hz > 0 AND rate_hz < 0.00002) OR max_dt_s > 1 THEN 'WARN' ELSE 'PASS' END AS verdict FROM full_stats""")
def card_round_trip(t: Tables):
    """Reports written as lines and read back."""
    by = ["session_id", "source"]
    cards = Q.sanity_cards(_stats(t), by, 0.1, 1975.0, 0.00002)
    fields = ["pose_count", "time_span_s", "p99_speed_mps", "extent_x_m", "warn_rate", "verdict"]
    return R.parse_cards(cards, by, fields)


@query(STEPS + """, a AS (SELECT session_id, source, t_ns, x, y, vx, lag(x) OVER w AS px, lag(y) OVER w AS py FROM odom WINDOW w AS (PARTITION BY session_id, source ORDER BY t_ns)),
m AS (SELECT session_id * 5 + CASE source WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS idx,
  coalesce(sum(sqrt((x - px) ** 2 + (y - py) ** 2)), 0) >= 1000 AND max(vx) >= 25 AS moving FROM a GROUP BY session_id, source),
g AS (SELECT idx, idx - row_number() OVER (ORDER BY idx) AS k FROM m WHERE moving)
SELECT min(idx) AS start, max(idx) AS "end", count(*) AS n, (SELECT count(*) FROM m) AS total_bags, (SELECT count(*) FROM m WHERE moving) AS moving_bags FROM g GROUP BY k""")
def audit_ranges(t: Tables):
    """K6: the moving ranges of the motion audit with its totals."""
    a = Q.is_moving(Q.motion_audit_odom(t.odometry(), ["session_id", "source"], T, part_rows=PARTS), 1000.0, 25.0)
    rank = F.array_position(F.array(*[F.lit(s) for s in ("click", "error", "purchase", "signup", "view")]), F.col("source")) - 1
    totals, ranges = Q.audit_summary(a.select((F.col("session_id") * 5 + rank).alias("idx"), "moving"), "idx", "moving", 1000.0, 25.0, PARTS)
    return ranges.crossJoin(F.broadcast(totals.drop("thresholds")))  # one row of totals
