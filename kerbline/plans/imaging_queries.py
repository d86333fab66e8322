"""Queries on thermal frames, detections, calibration and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.functions import camera as C
from kerbline.functions import geo, labels, pose, thermal
from kerbline.functions.sql import register_sql_functions
from kerbline.operators import imaging as I
from kerbline.operators.fixes import is_rtk, valid_fix, valid_pose
from kerbline.plans.bindings import Tables, with_tables
from kerbline.plans.registry import query, r
from kerbline.sinks import writers as K
from kerbline.sources import readers as R

LIN = with_tables("pixels") + """, t AS (SELECT *, raw * 0.004::DOUBLE + (15.0::DOUBLE - 84.0::DOUBLE) AS c FROM pixels)
"""
REFLECT = """l AS (SELECT *, coalesce(lag(c) OVER w, lead(c) OVER w) AS lf, coalesce(lead(c) OVER w, lag(c) OVER w) AS rt FROM t WINDOW w AS (PARTITION BY frame_id, "row" ORDER BY col)),
s AS (SELECT *, rt - lf AS d, lf + 2 * c + rt AS sm FROM l),
u AS (SELECT *, coalesce(lag(d) OVER w, lead(d) OVER w) AS du, coalesce(lead(d) OVER w, lag(d) OVER w) AS dd, coalesce(lag(sm) OVER w, lead(sm) OVER w) AS su, coalesce(lead(sm) OVER w, lag(sm) OVER w) AS sd
  FROM s WINDOW w AS (PARTITION BY frame_id, col ORDER BY "row")),
g AS (SELECT *, du + 2 * d + dd AS gx, sd - su AS gy FROM u)
"""


def _celsius(t: Tables):
    return t.pixels().withColumn("c", thermal.linear_celsius("raw", 15.0))


@query(LIN + "SELECT frame_id, \"row\", col, round(c, 6) AS temp_c FROM t")
def linear_temperature(t: Tables):
    return _celsius(t).select("frame_id", "row", "col", r("c", 6, "temp_c"))


PLANCK = """water AS (SELECT 0.5 * exp(1.5587 + 0.06939 * 15 - 0.00027816 * 225 + 0.00000068455 * 3375) AS w),
tau AS (SELECT 0.732 * exp(-sqrt(10) * (1.239e-08 + 0.00318 * sqrt(w))) + 0.268 * exp(-sqrt(10) * (1.1095e-08 + 0.0031802 * sqrt(w))) AS tau FROM water),
k AS (SELECT *, CASE WHEN camera % 2 = 0 THEN 21324.9 ELSE 23529.5 END::DOUBLE AS kr, CASE WHEN camera % 2 = 0 THEN 1504.2 ELSE 1533.8 END::DOUBLE AS kb,
  CASE WHEN camera % 2 = 0 THEN 19831 ELSE 19525 END::DOUBLE AS j0, CASE WHEN camera % 2 = 0 THEN 33.3013 ELSE 35.6463 END::DOUBLE AS j1, raw * 2 AS raw2 FROM pixels),
o AS (SELECT *, ((raw2 - j0) / j1) / (0.95 * tau) - (0.05 / 0.95) * (kr / (exp(kb / 288.15) - 1.05)) - ((1 - tau) / (0.95 * tau)) * (kr / (exp(kb / 288.15) - 1.05)) AS obj FROM k, tau)
"""


@query(with_tables("pixels") + ", " + PLANCK + "SELECT frame_id, \"row\", col, round(kb / ln(kr / greatest(obj, 0.001) + 1.05) - 273.15, 4) AS temp_c FROM o")
def planck_temperature(t: Tables):
    rows = t.pixels().withColumn("raw2", F.col("raw") * 2)
    parts = [rows.filter(F.col("camera") % 2 == i).withColumn("c", thermal.planck_celsius("raw2", thermal.RADIOMETRY[n], 15.0, 0.5))
             for i, n in enumerate(("thermal1", "thermal2"))]
    return parts[0].unionByName(parts[1]).select("frame_id", "row", "col", r("c", 4, "temp_c"))


@query(LIN + ", " + REFLECT + "SELECT frame_id, \"row\", col, round(gx, 4) + 0 AS gx, round(gy, 4) + 0 AS gy FROM g")
def sobel(t: Tables):
    return I.sobel(_celsius(t), ["frame_id"], "c").select("frame_id", "row", "col", r("gx", 4), r("gy", 4))


@query(LIN + ", " + REFLECT + """, f AS (SELECT frame_id, avg(c) AS fm, greatest(stddev_pop(c), 0.01) AS fs FROM t GROUP BY frame_id),
p AS (SELECT frame_id, "row" - "row" % 4 AS y, col - col % 4 AS x, avg(c) AS pm, max(sqrt(gx * gx + gy * gy)) AS pg FROM g GROUP BY 1, 2, 3),
a AS (SELECT p.*, pm - fm AS dl, fs FROM p JOIN f USING (frame_id))
SELECT frame_id, 'thermal_anomaly' AS class, round(least(abs(dl) / (fs * 4.0), 1.0), 3) AS confidence, x, y, round(dl, 8) + 0 AS temp_delta FROM a WHERE abs(dl) > 0.3 * fs
UNION ALL SELECT frame_id, 'potential_crack', round(least(pg / (40.0 * 3.0), 1.0), 3), x, y, round(dl, 8) + 0 FROM a WHERE pg > 40.0""")
def thermal_anomalies(t: Tables):
    out = I.thermal_anomalies(_celsius(t), ["frame_id"], "c", 4, 0.3, 40.0, digits=8)
    return out.select("frame_id", "class", "confidence", "x", "y", (F.col("temp_delta") + 0.0).alias("temp_delta"))


@query(LIN + "SELECT frame_id, round(min(c), 2) AS min_temp_c, round(avg(c), 2) AS mean_temp_c, round(max(c), 2) AS max_temp_c FROM t GROUP BY frame_id")
def frame_temps(t: Tables):
    return I.frame_temps(_celsius(t), ["frame_id"], "c")


STRETCH = "SELECT frame_id, \"row\", col, CAST(floor(least(greatest((raw - lo) / (hi - lo) * 255, 0), 255)) AS INTEGER) AS grey FROM pixels JOIN e USING (frame_id)"


@query(with_tables("pixels") + ", e AS (SELECT frame_id, quantile_cont(raw, 0.01) AS lo, quantile_cont(raw, 0.99) AS hi FROM pixels GROUP BY frame_id) " + STRETCH)
def percentile_stretch(t: Tables):
    return I.percentile_stretch(t.pixels(), ["frame_id"], "raw").select("frame_id", "row", "col", "grey")


@query(with_tables("pixels") + """, e AS (SELECT frame_id, quantile_cont(raw, 0.02) AS lo, quantile_cont(raw, 0.98) AS hi FROM pixels
  WHERE "row" BETWEEN 2 AND 5 AND col BETWEEN 2 AND 5 GROUP BY frame_id) """ + STRETCH)
def percentile_stretch_roi(t: Tables):
    return I.percentile_stretch(t.pixels(), ["frame_id"], "raw", 0.02, 0.98, roi=0.5).select("frame_id", "row", "col", "grey")


@query(with_tables("points") + """, l AS (SELECT session_id, min(intensity) AS la, max(intensity) AS ha, min(y) AS lb, max(y) AS hb FROM points GROUP BY session_id),
c AS (SELECT session_id, floor((intensity - la) / greatest(ha - la, 1e-6) * 15) AS i, floor((y - lb) / greatest(hb - lb, 1e-6) * 15) AS j, count(*) AS n FROM points JOIN l USING (session_id) GROUP BY 1, 2, 3),
t AS (SELECT session_id, sum(n) AS total FROM c GROUP BY 1),
j AS (SELECT session_id, sum(-(n / total) * ln(n / total)) AS h FROM c JOIN t USING (session_id) GROUP BY 1),
a AS (SELECT session_id, sum(-(n / total) * ln(n / total)) AS h FROM (SELECT session_id, i, sum(n) AS n FROM c GROUP BY 1, 2) JOIN t USING (session_id) GROUP BY 1),
b AS (SELECT session_id, sum(-(n / total) * ln(n / total)) AS h FROM (SELECT session_id, j, sum(n) AS n FROM c GROUP BY 1, 2) JOIN t USING (session_id) GROUP BY 1)
SELECT session_id, CAST(total AS BIGINT) AS n, round(a.h + b.h - j.h, 6) AS mi FROM j JOIN a USING (session_id) JOIN b USING (session_id) JOIN t USING (session_id)""")
def mutual_information(t: Tables):
    out = I.mutual_information(t.points(), ["session_id"], "intensity", "y", bins=16)
    return out.select("session_id", "n", r("mi"))


@query("""WITH d AS (SELECT vec_id AS frame_id, label, CAST(embedding[1] AS DOUBLE) * 800 + 320 AS x0, CAST(embedding[2] AS DOUBLE) * 800 + 320 AS y0, 20 + abs(CAST(embedding[3] AS DOUBLE)) * 400 AS w, 20 + abs(CAST(embedding[4] AS DOUBLE)) * 400 AS h, CAST(embedding[5] AS DOUBLE) * 100 AS k FROM embeddings),
q AS (SELECT frame_id, label, x0, y0, x0 + w AS x1, y0 + k AS y1, x0 + w AS x2, y0 + h AS y2, x0 AS x3, y0 + h AS y3 FROM d),
s AS (SELECT *, (sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)) + sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) + sqrt((x3-x2)*(x3-x2)+(y3-y2)*(y3-y2)) + sqrt((x0-x3)*(x0-x3)+(y0-y3)*(y0-y3))) / 4 / sqrt(2 * 640.0 * 640.0) AS share,
  sqrt((x2-x0)*(x2-x0)+(y2-y0)*(y2-y0)) AS d1, sqrt((x3-x1)*(x3-x1)+(y3-y1)*(y3-y1)) AS d2, degrees(atan2(y1-y0, x1-x0)) AS ang, (x0+x1+x2+x3)/4 AS cx, (y0+y1+y2+y3)/4 AS cy FROM q),
b AS (SELECT *, CASE WHEN share < 0.035 THEN 0 WHEN share < 0.07 THEN 1 ELSE 2 END AS db, greatest(0, least(floor((1 - least(d1,d2)/greatest(d1,d2,1e-6)) * 2 * 5), 4)) AS tb,
  greatest(0, least(floor((((ang + 90) - 180 * floor((ang + 90) / 180)) - 90 + 90) / 180 * 5), 4)) AS rb FROM s),
g AS (SELECT label, count(DISTINCT (floor(cx / 640 * 10), floor(cy / 640 * 8))) AS grid_hit FROM s WHERE cx >= 0 AND cx < 640 AND cy >= 0 AND cy < 640 GROUP BY label),
n AS (SELECT label, count(*) AS frames_detected FROM b GROUP BY label),
dh AS (SELECT label, count(*) AS c FROM (SELECT label, db FROM b GROUP BY 1, 2 HAVING count(*) >= 5) GROUP BY 1),
th AS (SELECT label, count(*) AS c FROM (SELECT label, tb FROM b GROUP BY 1, 2 HAVING count(*) >= 5) GROUP BY 1),
rh AS (SELECT label, count(*) AS c FROM (SELECT label, rb FROM b GROUP BY 1, 2 HAVING count(*) >= 5) GROUP BY 1)
SELECT n.label, frames_detected, CAST(coalesce(dh.c, 0) AS INTEGER) AS dist_hit, CAST(coalesce(th.c, 0) AS INTEGER) AS tilt_hit, CAST(coalesce(rh.c, 0) AS INTEGER) AS roll_hit, coalesce(grid_hit, 0) AS grid_hit
FROM n LEFT JOIN g USING (label) LEFT JOIN dh USING (label) LEFT JOIN th USING (label) LEFT JOIN rh USING (label)""")
def calibration_coverage(t: Tables):
    v = [F.col("embedding")[i].cast("double") for i in range(5)]
    d = t.raw("embeddings").select(
        F.col("vec_id").alias("frame_id"), "label", (v[0] * 800 + 320).alias("x0"), (v[1] * 800 + 320).alias("y0"),
        (20 + F.abs(v[2]) * 400).alias("w"), (20 + F.abs(v[3]) * 400).alias("h"), (v[4] * 100).alias("k"))
    q = d.select("frame_id", "label", "x0", "y0", (F.col("x0") + F.col("w")).alias("x1"), (F.col("y0") + F.col("k")).alias("y1"),
                 (F.col("x0") + F.col("w")).alias("x2"), (F.col("y0") + F.col("h")).alias("y2"), F.col("x0").alias("x3"), (F.col("y0") + F.col("h")).alias("y3"))
    out = I.calibration_coverage(q, ["label"], 640.0, 640.0)
    return out.select("label", "frames_detected", "dist_hit", "tilt_hit", "roll_hit", "grid_hit")


@query(with_tables("pixels") + """, g AS (SELECT frame_id, raw // 500 AS band, count(*) AS n_points, max(col * 0.1::DOUBLE) - min(col * 0.1::DOUBLE) AS gx, max("row" * 0.1::DOUBLE) - min("row" * 0.1::DOUBLE) AS gy,
  max(raw / 50.0) - min(raw / 50.0) AS us, max(raw / 40.0) - min(raw / 40.0) AS vs FROM pixels GROUP BY frame_id, raw // 500)
SELECT frame_id, CAST(band AS BIGINT) AS band, n_points, CASE WHEN n_points < 12 THEN 'points' WHEN least(gx, gy) < 3.5 * 0.1 THEN 'grid' WHEN least(us, vs) < 80 THEN 'pixels' END AS dropped_for FROM g""")
def calib_frame_gate(t: Tables):
    """P18, each band of raw values of a frame taken as one picture of the board."""
    p = t.pixels().select("frame_id", F.floor(F.col("raw") / 500).alias("band"), (F.col("col") * 0.1).alias("grid_x"), (F.col("row") * 0.1).alias("grid_y"),
                 (F.col("raw") / 50.0).alias("u"), (F.col("raw") / 40.0).alias("v"))
    return I.calib_frame_gate(p, ["frame_id", "band"], 0.1).select("frame_id", "band", "n_points", "dropped_for")


BOXES = """WITH e AS (SELECT vec_id AS frame_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS v FROM embeddings),
d AS (SELECT frame_id, v[1] * 640 + 320 AS cx, v[2] * 640 + 320 AS cy, abs(v[3]) * 640 AS w, abs(v[4]) * 640 AS h, v[5:10] AS s FROM e),
c AS (SELECT *, list_max(s) AS score, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS class_id FROM d),
b AS (SELECT frame_id, class_id, score, greatest(0, CAST(trunc((cx - w / 2) * 2) AS INTEGER)) AS x1, greatest(0, CAST(trunc((cy - h / 2) * 1.5) AS INTEGER)) AS y1,
  least(1280, CAST(trunc((cx + w / 2) * 2) AS INTEGER)) AS x2, least(960, CAST(trunc((cy + h / 2) * 1.5) AS INTEGER)) AS y2 FROM c WHERE score > 0.12),
k AS (SELECT * FROM b WHERE x2 > x1 AND y2 > y1)
"""


def _boxes(t: Tables):
    e = t.raw("embeddings").select(F.col("vec_id").alias("frame_id"), F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    v = F.col("v")
    d = e.select("frame_id", (v[0] * 640 + 320).alias("cx"), (v[1] * 640 + 320).alias("cy"), (F.abs(v[2]) * 640).alias("w"),
                 (F.abs(v[3]) * 640).alias("h"), F.slice("v", 5, 6).alias("scores"))
    return I.decode_boxes(d, 0.12, 1280.0, 960.0, 6)


@query(BOXES + "SELECT frame_id, CAST(class_id AS BIGINT) AS class_id, round(score, 6) AS score, x1, y1, x2, y2 FROM k")
def decode_boxes(t: Tables):
    return _boxes(t).select("frame_id", F.col("class_id").cast("long").alias("class_id"), r("score"), "x1", "y1", "x2", "y2")


@query(BOXES + """, m AS (SELECT frame_id, CAST(class_id AS BIGINT) AS class_id,
  CASE WHEN class_id = 0 THEN greatest(0, x1 - 10) ELSE greatest(0, x1 + CAST(trunc((x2 - x1) * 0.2) AS INTEGER)) END AS mx1,
  CASE WHEN class_id = 0 THEN greatest(0, y1 - 10) ELSE greatest(0, y2 - CAST(trunc((y2 - y1) * 0.25) AS INTEGER)) END AS my1,
  CASE WHEN class_id = 0 THEN least(1280, x2 + 10) ELSE least(1280, greatest(0, x1 + CAST(trunc((x2 - x1) * 0.2) AS INTEGER)) + CAST(trunc((x2 - x1) * 0.6) AS INTEGER)) END AS mx2,
  CASE WHEN class_id = 0 THEN least(960, y1 + CAST(trunc((y2 - y1) * 0.35) AS INTEGER) + 10) ELSE least(960, y2) END AS my2 FROM k WHERE class_id IN (0, 2, 5, 7))
SELECT * FROM m WHERE mx2 > mx1 AND my2 > my1""")
def redaction_boxes(t: Tables):
    out = I.redaction_boxes(_boxes(t), 1280, 960)
    return out.select("frame_id", F.col("class_id").cast("long").alias("class_id"), "mx1", "my1", "mx2", "my2")


@query(with_tables("pixels") + """, l AS (SELECT frame_id, CAST(raw // 2000 AS BIGINT) AS label, count(*) AS n FROM pixels GROUP BY 1, 2)
SELECT frame_id, label, n, round(n / sum(n) OVER (PARTITION BY frame_id), 6) AS share FROM l""")
def label_share(t: Tables):
    p = t.pixels().withColumn("label", F.floor(F.col("raw") / 2000))
    return I.label_share(p, ["frame_id"], "label").select("frame_id", "label", "n", r("share"))


@query("""WITH s AS (SELECT vec_id AS frame_id, list_transform(embedding[1:5], lambda v: CAST(v AS DOUBLE) * 5) AS s FROM embeddings),
e AS (SELECT *, list_aggregate(list_transform(s, lambda v: exp(v - list_max(s))), 'sum') AS z, CAST(list_position(s, list_max(s)) - 1 AS BIGINT) AS class_id FROM s)
SELECT frame_id, class_id, round(1 / z, 6) AS confidence, class_id > 0 AND 1 / z > 0.4 AS alert FROM e""")
def classify_scores(t: Tables):
    s = t.raw("embeddings").select(F.col("vec_id").alias("frame_id"), F.transform(F.slice("embedding", 1, 5), lambda v: v.cast("double") * 5).alias("scores"))
    out = I.classify_scores(s, "scores", 0.4)
    return out.select("frame_id", F.col("class_id").cast("long").alias("class_id"), r("confidence"), "alert")


@query("""SELECT vec_id AS frame_id, round(sum(v), 4) + 0 AS total, max(v) > 0.3 AS hot FROM (SELECT vec_id, unnest(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS v FROM embeddings) GROUP BY vec_id""")
def infer_frames(t: Tables):
    """X4 with a stand-in model that sums the frame."""
    def model():
        def predict(batch):
            total = [float(sum(float(x) for x in e)) for e in batch["e"]]
            return batch[["frame_id"]].assign(total=total, hot=[max(e) > 0.3 for e in batch["e"]])
        return predict

    e = t.raw("embeddings").select(F.col("vec_id").alias("frame_id"), F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    return I.infer_frames(e, model, "frame_id long, total double, hot boolean").select("frame_id", r("total", 4), "hot")


CAM = with_tables("points") + """, c AS (SELECT point_id, x - 25 AS xc, z - 5 AS yc, y AS zc FROM points),
n AS (SELECT *, xc / zc AS a, yc / zc AS b FROM c), q AS (SELECT *, a * a + b * b AS r2, atan(sqrt(a * a + b * b)) AS th FROM n)
"""
LEVEL, SHIFT = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0), (-25.0, -5.0, 0.0)


@query(CAM + """, p AS (SELECT *, 334.78419 * (a * (1 + r2 * (-0.164539 + r2 * 0.026521)) + 2 * -0.004782 * a * b - 0.004943 * (r2 + 2 * a * a)) + 317.07016 AS u,
  332.67743 * (b * (1 + r2 * (-0.164539 + r2 * 0.026521)) - 0.004782 * (r2 + 2 * b * b) + 2 * -0.004943 * a * b) + 234.32726 AS v FROM q)
SELECT point_id, round(u, 4) AS u, round(v, 4) AS v FROM p WHERE zc > 0.1 AND u >= 0 AND u < 640 AND v >= 0 AND v < 480""")
def project_pinhole(t: Tables):
    u, v, d = C.project_pinhole(("x", "z", "y"), LEVEL, SHIFT, (334.78419, 332.67743, 317.07016, 234.32726),
                                (-0.164539, 0.026521, -0.004782, -0.004943, 0.0))
    p = t.points().withColumns({"u": u, "v": v, "d": d}).filter(C.in_image("u", "v", "d", 640, 480))
    return p.select("point_id", r("u", 4), r("v", 4))


@query(CAM + """, p AS (SELECT *, CASE WHEN sqrt(r2) > 1e-8 THEN th * (1 + th * th * (0.01 + th * th * (-0.002 + th * th * (0.0003 - th * th * 0.0001)))) / sqrt(r2) ELSE 1 END AS s FROM q),
w AS (SELECT *, 1166.26303 * a * s + 1619.56279 AS u, 1169.02224 * b * s + 1199.32755 AS v FROM p)
SELECT point_id, round(u, 3) AS u, round(v, 3) AS v FROM w WHERE zc > 0.1 AND u >= 0 AND u < 3232 AND v >= 0 AND v < 2426""")
def project_fisheye(t: Tables):
    u, v, d = C.project_fisheye(("x", "z", "y"), LEVEL, SHIFT, (1166.26303, 1169.02224, 1619.56279, 1199.32755),
                                (0.01, -0.002, 0.0003, -0.0001))
    p = t.points().withColumns({"u": u, "v": v, "d": d}).filter(C.in_image("u", "v", "d", 3232, 2426))
    return p.select("point_id", r("u", 3), r("v", 3))


@query(with_tables("odom") + """SELECT frame_id, round(atan2(2 * qw * qz, 1 - 2 * qz * qz), 6) + 0 AS yaw,
  round(cos(radians(heading_deg)) * 3 - sin(radians(heading_deg)) * 4 + x, 5) AS wx, round(sin(radians(heading_deg)) * 3 + cos(radians(heading_deg)) * 4 + y, 5) AS wy,
  CAST(0 AS DOUBLE) AS back_x, CAST(1 AS DOUBLE) AS dot FROM odom""")
def pose_transforms(t: Tables):
    """Yaw, apply, inverse composed to identity, and quaternion from rotation."""
    q = pose.quat_cols()
    tr = pose.pose_t()
    wx, wy, _ = pose.apply_t(tr, (F.lit(3.0), F.lit(4.0), F.lit(0.0)))
    rot, shift = pose.compose_t(pose.invert_t(tr), tr)
    again = pose.rot_to_quat(pose.quat_to_rot(q))
    yaw = F.round(pose.yaw(q), 6) + 0.0
    return t.odometry().select("frame_id", yaw.alias("yaw"), r(wx, 5, "wx"), r(wy, 5, "wy"), r(shift[0], 5, "back_x"),
                               r(F.abs(pose.quat_dot(again, q)), 5, "dot"))


@query(with_tables("points") + "SELECT point_id, -x + 0.0024::DOUBLE AS bx, -y + 0.0097::DOUBLE AS by, z + 0.0307::DOUBLE AS bz FROM points")
def extrinsic_preset(t: Tables):
    bx, by, bz = pose.apply_t(pose.extrinsic("fast_lio"), ("x", "y", "z"))
    return t.points().select("point_id", bx.alias("bx"), by.alias("by"), bz.alias("bz"))


GEO = with_tables("fixes") + """, h AS (SELECT f.*, CAST((frame_id * 37) % 360 AS DOUBLE) AS hd FROM fixes f)
"""


@query(GEO + """SELECT frame_id, round(cos(radians(hd)) * x - sin(radians(hd)) * y + 400000, 5) AS gx, round(sin(radians(hd)) * x + cos(radians(hd)) * y + 300000, 5) AS gy,
  round(lat + 20 * cos(radians(hd)) / 111320, 8) AS end_lat, round(lon + 20 * sin(radians(hd)) / (111320 * cos(radians(lat))), 8) AS end_lon,
  round(51.5 + (y - 500) / 111320, 7) AS loc_lat, round(-1.25 + (x - 500) / (111320 * cos(radians(51.5))), 7) AS loc_lon,
  round(sqrt(((51.5 - lat) * 111000) ** 2 + ((-1.25 - lon) * 111000 * cos(radians(51.5))) ** 2), 5) AS home_m,
  CASE WHEN hd - 100 > 180 THEN hd - 460 WHEN hd - 100 < -180 THEN hd + 260 ELSE hd - 100 END AS wrapped FROM h""")
def geo_functions(t: Tables):
    """F12, F14-F17."""
    f = t.fixes().withColumn("hd", ((F.col("frame_id") * 37) % 360).cast("double"))
    gx, gy, _ = geo.local_to_grid("x", "y", F.lit(0.0), "hd", 400000, 300000, 0)
    end_lat, end_lon = geo.arrow_end("lat", "lon", "hd")
    loc_lat, loc_lon = geo.bng_to_wgs84_local("x", "y", (500.0, 500.0, 51.5, -1.25))
    home = geo.fix_distance("lat", "lon", 51.5, -1.25)
    return f.select("frame_id", r(gx, 5, "gx"), r(gy, 5, "gy"), r(end_lat, 8, "end_lat"), r(end_lon, 8, "end_lon"),
                    loc_lat.alias("loc_lat"), loc_lon.alias("loc_lon"), r(home, 5, "home_m"), geo.wrap180(F.col("hd") - 100).alias("wrapped"))


@query(with_tables("fixes") + "SELECT frame_id, status >= 2 AND var < 0.1 AS is_rtk FROM fixes WHERE status >= 0 AND abs(lat) >= 0.1 AND abs(lon) >= 0.0001")
def valid_fixes(t: Tables):
    """P6, P7."""
    return is_rtk(valid_fix(t.fixes())).select("frame_id", "is_rtk")


@query(with_tables("odom") + "SELECT frame_id FROM odom WHERE sqrt(qz * qz + qw * qw) BETWEEN 0.9 AND 1.1")
def valid_poses(t: Tables):
    return valid_pose(t.odometry()).select("frame_id")


@query("""SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S_') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') AS stamp,
  'rec-pass' || CAST(user_id AS VARCHAR) || '-2026' || CASE event_type WHEN 'view' THEN '03' WHEN 'click' THEN '11' ELSE '00' END || lpad(CAST(event_id % 28 + 1 AS VARCHAR), 2, '0') AS recording,
  CASE event_type WHEN 'view' THEN 'left' WHEN 'click' THEN 'right' WHEN 'error' THEN 'rear' ELSE 'unknown' END AS side,
  CASE event_id % 5 WHEN 0 THEN 'nofix' WHEN 1 THEN 'gps' WHEN 2 THEN 'sbas' WHEN 3 THEN 'rtk' ELSE '3' END AS fix,
  CASE WHEN value * 3.6 <= 5 THEN 2.0 WHEN value * 3.6 <= 30 THEN 5.0 WHEN value * 3.6 <= 60 THEN 10.0 ELSE 20.0 END::DOUBLE AS spacing,
  CASE WHEN -value - 60 >= -95 THEN 'Excellent' WHEN -value - 60 >= -105 THEN 'Good' WHEN -value - 60 >= -115 THEN 'Fair' ELSE 'Poor' END AS grade,
  round(greatest(value, 1) ** 2, 6) AS var_e, round(4 * greatest(value, 1) ** 2, 6) AS var_u, coalesce(TRY_CAST(props ->> '$.k' AS DOUBLE), -1) AS k,
  CAST(coalesce(TRY_CAST(event_type AS DOUBLE), 7.5) AS DOUBLE) AS bad_num,
  CASE WHEN event_type = 'view' THEN value - 273.15 ELSE value END AS celsius, CASE WHEN event_type = 'view' THEN value > 75 ELSE value > -150 END AS too_hot FROM events""")
def label_functions(t: Tables):
    """F20, F24, F25, F27, F28, F31-F34, F38."""
    ev, v = t.raw("events").withColumn("t_ns", t._ns("ts")), F.col("value")
    month = F.when(F.col("event_type") == "view", "mar").when(F.col("event_type") == "click", "nov").otherwise("xyz")
    name = F.concat(F.lit("pass"), F.col("user_id").cast("string"), F.lit("_"), month, F.lpad((F.col("event_id") % 28 + 1).cast("string"), 2, "0"))
    cam = F.when(F.col("event_type") == "view", "left_rgb").when(F.col("event_type") == "click", "cam_right").when(F.col("event_type") == "error", "rear").otherwise("top")
    cov = labels.fix_covariance("value")
    unit = F.when(F.col("event_type") == "view", "Kelvin").otherwise("C")
    family = F.when(F.col("event_type") == "view", "uncooled").otherwise("cooled")
    return ev.select(
        "event_id", labels.stamp_name("t_ns").alias("stamp"), labels.recording_id(name, "rec", 2026).alias("recording"),
        labels.camera_side(cam).alias("side"), labels.fix_name(F.col("event_id") % 5 - 1).alias("fix"), labels.keyframe_distance("value").alias("spacing"),
        labels.signal_grade(-v - 60).alias("grade"), r(cov[0], 6, "var_e"), r(cov[8], 6, "var_u"),
        labels.num(labels.meta_field("props", "$.k"), -1.0).alias("k"), labels.num("event_type", 7.5).alias("bad_num"),
        thermal.to_celsius("value", unit).alias("celsius"), thermal.temp_alert("value", family).alias("too_hot"))


@query("""WITH z AS (SELECT *, sqrt((l_quantity - 25) ** 2 + (l_extendedprice / 1000 - 50) ** 2) AS rg FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN rg >= 2 AND rg < 2 + 78 * 0.25 ** 1.5 THEN 0 WHEN rg >= 2 + 78 * 0.25 ** 1.5 AND rg < 2 + 78 * 0.5 ** 1.5 THEN 1
  WHEN rg >= 2 + 78 * 0.5 ** 1.5 AND rg < 2 + 78 * 0.75 ** 1.5 THEN 2 WHEN rg >= 2 + 78 * 0.75 ** 1.5 AND rg < 80 THEN 3 END AS zone,
  CAST(floor(least(greatest((l_discount * 10 * 4 - 2) * 255, 0), 255) * 0.5) AS BIGINT) AS red FROM z""")
def cell_functions(t: Tables):
    """F35, F36."""
    li = t.raw("lineitem")
    zone = labels.zone_of(F.col("l_quantity") - 25, F.col("l_extendedprice") / 1000 - 50, 2.0, 80.0, 4)
    bright = labels.height_color(F.col("l_discount") * 10, F.lit(1.0))[0]
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", zone.alias("zone"), F.floor(bright * 0.5).alias("red"))


@query("""WITH e AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode('bag_' || CAST(event_id AS VARCHAR))) AS s, event_id % 360 AS a FROM events)
SELECT event_id, round(sqrt(value * value + 1), 6) AS dist, CAST(a AS DOUBLE) AS rel, round(value + abs(20 - 32.5) * 0.3, 6) AS score,
  round(degrees(atan2(value, 1)), 6) AS bearing, CAST(least(abs(a - 90), 360 - abs(a - 90)) AS DOUBLE) AS perp, CAST(CASE WHEN a > 180 THEN a - 360 ELSE a END AS DOUBLE) AS wrapped,
  round(2 * radians(a / 2), 6) AS yaw, s[1:8] || '-' || s[9:12] || '-5' || s[14:16] || '-' ||
  CASE WHEN s[17:17] IN ('0', '4', '8', 'c') THEN '8' WHEN s[17:17] IN ('1', '5', '9', 'd') THEN '9' WHEN s[17:17] IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END
  || s[18:20] || '-' || s[21:32] AS osid FROM e""")
def sql_functions(t: Tables):
    """Every registered SQL function."""
    register_sql_functions(t.spark)
    ev = t.raw("events").withColumn("a", (F.col("event_id") % 360).cast("double"))
    turn = F.expr("quat_yaw(0D, 0D, sin(radians(a / 2) / 2), cos(radians(a / 2) / 2))")
    return ev.select("event_id", r(F.expr("plan_distance(0D, 0D, value, 1D)"), 6, "dist"),
                     F.expr("relative_angle(CAST(event_id AS DOUBLE), 0D)").alias("rel"), r(F.expr("hero_score(value, 20D)"), 6, "score"),
                     r(F.expr("plan_bearing(0D, 0D, value, 1D)"), 6, "bearing"), F.expr("camera_perp_angle(a, 'left')").alias("perp"),
                     F.expr("wrap180(a)").alias("wrapped"), r(turn * 2, 6, "yaw"),
                     F.expr("uuid5_dns('bag_' || CAST(event_id AS STRING))").alias("osid"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN round((o_custkey % 65536) * 0.01::DOUBLE / 3.6, 6) END AS speed_mps,
  CASE WHEN o_orderkey % 2 = 1 THEN round(radians((CASE WHEN o_custkey * 40 % 65536 >= 32768 THEN o_custkey * 40 % 65536 - 65536 ELSE o_custkey * 40 % 65536 END) * 0.1::DOUBLE), 6) + 0 END AS steering_rad FROM orders""")
def decode_can(t: Tables):
    even = F.col("o_orderkey") % 2 == 0
    hex4 = lambda c: F.lpad(F.hex(c % 65536), 4, "0")
    data = F.when(even, F.unhex(F.concat(F.lit("0000"), hex4(F.col("o_custkey")), F.lit("00000000")))).otherwise(
        F.unhex(F.concat(hex4(F.col("o_custkey") * 40), F.lit("000000000000"))))
    frames = t.raw("orders").select("o_orderkey", F.when(even, 0x118).otherwise(0x129).alias("can_id"), data.alias("data"))
    return R.decode_can(frames).select("o_orderkey", r("speed_mps"), r("steering_rad"))


@query("""SELECT event_id, round(CASE WHEN abs(value / 1000) > 0.001 THEN value * tan(value / 1000) / 2.875 ELSE 0 END, 6) AS yaw_rate FROM events""")
def yaw_rate(t: Tables):
    return t.raw("events").select("event_id", r(pose.yaw_rate("value", F.col("value") / 1000, 2.875), 6, "yaw_rate"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fastlio' ELSE 'glim' END AS engine, 'run_' || CAST(o_custkey AS VARCHAR) AS tag FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def discover_runs(t: Tables):
    engine = F.when(F.col("o_orderstatus") == "F", "fastlio").when(F.col("o_orderstatus") == "O", "glim").otherwise("other")
    names = t.raw("orders").select("o_orderkey", F.concat_ws("_", engine, F.lit("run"), F.col("o_custkey").cast("string")).alias("name"))
    return R.discover_runs(names).select("o_orderkey", "engine", "tag")


@query("""SELECT o_orderkey AS report, CAST(o_custkey AS VARCHAR) AS cust, o_orderpriority AS prio FROM orders""")
def parse_cards(t: Tables):
    """S10 over report lines made from orders."""
    o = t.raw("orders")
    lines = o.select(F.col("o_orderkey").alias("report"), F.posexplode(F.array(
        F.concat(F.lit("cust   : "), F.col("o_custkey").cast("string")), F.lit("======"), F.concat(F.lit("prio: "), F.col("o_orderpriority"), F.lit("  ")))).alias("line_no", "value"))
    return R.parse_cards(lines, ["report"], ["cust", "prio"]).select("report", "cust", "prio")


@query("""SELECT CAST(o_orderkey AS INTEGER) AS start, CAST(o_orderkey + 3 AS INTEGER) AS "end", 't' || CAST(o_custkey AS VARCHAR) AS tag, o_orderstatus AS class, 4 AS n_bags FROM orders""")
def parse_segments(t: Tables):
    """S11 over segment lines made from orders."""
    line = F.format_string("  - {start: %d, end: %d, tag: t%d, class: %s, n_bags: 4}", "o_orderkey", F.col("o_orderkey") + 3, "o_custkey", "o_orderstatus")
    head = t.raw("orders").select(F.lit("segments:").alias("value"))
    return R.parse_segments(t.raw("orders").select(line.alias("value")).unionByName(head))


@query(with_tables("odom") + """SELECT frame_id, t_ns, x, y, round(qz, 5) + 0 AS qz FROM odom""")
def submap_poses(t: Tables):
    """Each pose is written as a 4x4 matrix in a text and read back."""
    o = t.odometry()
    rot = pose.quat_to_rot(pose.quat_cols())
    cells = [rot[0], rot[1], rot[2], F.col("x"), rot[3], rot[4], rot[5], F.col("y"), rot[6], rot[7], rot[8], F.col("z")]
    nums = F.concat_ws(" ", *[c.cast("string") for c in cells], F.lit("0.0 0.0 0.0 1.0"))
    stamp = F.concat((F.col("t_ns").cast("decimal(20,0)") / F.lit(1000000000).cast("decimal(10,0)")).cast("decimal(20,9)").cast("string"))
    text = F.concat(F.lit("id: 7\nstamp: "), stamp, F.lit("\nT_world_lidar: \n"), nums, F.lit("\nend\n"))
    p = R.parse_submap_poses(o.select("frame_id", text.alias("value")), keep=["frame_id"])
    sign = F.when(F.col("qw") < 0, -1.0).otherwise(1.0)
    flip = o.select("frame_id", F.when(F.col("qw") < 0, -1.0).otherwise(1.0).alias("s"))
    return p.join(flip, "frame_id").select("frame_id", "t_ns", "x", "y", r(F.col("qz") * sign * F.col("s"), 5, "qz"))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'thermal' WHEN c_mktsegment = 'MACHINERY' THEN 'panorama' ELSE 'rgb' END AS role FROM customer""")
def classify_topics(t: Tables):
    name = F.when(F.col("c_mktsegment") == "BUILDING", "left_raw").when(F.col("c_mktsegment") == "MACHINERY", "lidar_range").otherwise("left_rgb")
    return R.classify_topics(t.raw("customer").select("c_custkey", name.alias("name"))).select("c_custkey", "role")


@query(with_tables("fixes") + """SELECT frame_id, CAST(t_ns AS VARCHAR) || ' ' || printf('%.2f', x) || ' ' || printf('%.2f', y) || ' 0.00 90.00' AS line FROM fixes""")
def trajectory_rows(t: Tables):
    f = t.fixes().withColumn("z", F.lit(0.0)).withColumn("heading_deg", F.lit(90.0))
    rows = K.trajectory_rows(f, ["frame_id"])
    return rows.select("frame_id", "line")


@query(with_tables("fixes") + "SELECT frame_id, t_ns AS timestamp_ns, round(lat, 8) AS lat, round(lon, 8) AS lon, 12.35::DOUBLE AS alt FROM fixes")
def trajectory_json(t: Tables):
    f = t.fixes().withColumn("alt", F.lit(12.35)).withColumn("heading_deg", F.lit(90.0))
    return K.trajectory_json(f, ["frame_id"]).select("frame_id", "timestamp_ns", "lat", "lon", "alt")


@query("SELECT o_orderkey, '{\"customer\":' || CAST(o_custkey AS VARCHAR) || ',\"source\":null}' AS block FROM orders")
def accuracy_block(t: Tables):
    block = labels.accuracy_block(customer="o_custkey", source=F.lit(None).cast("string"))
    return t.raw("orders").select("o_orderkey", block.alias("block"))


@query("SELECT event_id, event_type AS topic FROM events WHERE event_type IN ('view', 'click')")
def slim_recording(t: Tables):
    m = t.raw("events").withColumn("topic", F.col("event_type"))
    return K.slim_recording(m, ["view", "click"]).select("event_id", "topic")


@query("""SELECT event_id, c.model, c.fx FROM events e LEFT JOIN (VALUES ('view', 'pinhole', 334.5), ('click', 'fisheye', 1166.25), ('error', 'pinhole', 1192.5)) c(camera, model, fx)
  ON e.event_type = c.camera""".replace("c.fx FROM", "CAST(c.fx AS DOUBLE) AS fx FROM"))
def with_calibration(t: Tables):
    """The newest calibration of each camera."""
    rows = [("view", None, 334.5, 5), ("view", "fisheye", 1.0, 4), ("click", "fisheye", 1166.25, 1), ("error", "pinhole", 1192.5, 1)]
    calib = t.spark.createDataFrame(rows, "camera string, model string, fx double, calibrated_ns long")
    f = t.raw("events").select("event_id", F.col("event_type").alias("camera"))
    return I.with_calibration(f, calib).select("event_id", "model", "fx")
