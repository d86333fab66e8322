"""Column functions against closed forms."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from kerbline.functions import geo, labels, pose, thermal
from kerbline.functions.sql import register_sql_functions


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def quat(deg):
    return tuple(F.lit(v) for v in (0.0, 0.0, math.sin(math.radians(deg) / 2), math.cos(math.radians(deg) / 2)))


def test_bearing_and_angles(spark):
    row = one(spark, geo.bearing(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)),
              geo.bearing(F.lit(0.0), F.lit(0.0), F.lit(-1.0), F.lit(0.0)),
              geo.relative_angle(F.lit(1.0), F.lit(359.0)), geo.relative_angle(F.lit(1.0), F.lit(359.0), "bearing_minus_heading"),
              geo.wrap180(F.lit(358.0)), geo.wrap180(F.lit(-190.0)))
    assert [round(v, 9) for v in row] == [90, 270, 2, 358, -2, 170]
    with pytest.raises(ValueError):
        geo.relative_angle(F.lit(1.0), F.lit(2.0), "other")


def test_fov_edges_and_perpendicular(spark):
    cases = [("left", 30, True), ("left", 29.9, False), ("left", 150, True), ("right", 330, True), ("right", 331, False),
             ("rear", 180, True), ("unknown", 90, False)]
    row = one(spark, *[geo.in_fov(F.lit(float(a)), F.lit(s)) for s, a, _ in cases])
    assert list(row) == [w for *_, w in cases]
    row = one(spark, geo.perp_angle(F.lit(350.0), F.lit("left")), geo.perp_angle(F.lit(10.0), F.lit("right")),
              geo.perp_angle(F.lit(90.0), F.lit("rear")), geo.hero_score(F.lit(10.0), F.lit(42.5)))
    assert [round(v, 9) for v in row] == [100, 100, 180, 13]


@pytest.mark.parametrize("convention", ["heading_minus_bearing", "bearing_minus_heading"])
def test_sector_by_axis_equals_sector_by_angle(spark, convention):
    nan = float("nan")
    headings = [None, nan, -725.0, 0.0, 15.0, 45.0, 90.0, 133.7, 359.0, 1e9]
    rows = [(h, s, float(x), float(y)) for h in headings for s in ("left", "right", "rear", "up", None) for x in range(-3, 4) for y in range(-3, 4)]
    df = spark.createDataFrame(rows, "h double, s string, x double, y double")
    rel = geo.relative_angle("h", geo.bearing(F.lit(0.0), F.lit(0.0), "x", "y"), convention)
    clear = geo.in_fov_by_axis(F.col("x"), F.col("y"), *geo.fov_axis("h", "s", convention))
    got = df.select("*", geo.in_fov(rel, "s").alias("want"), clear.alias("clear")).collect()
    assert all(r.clear is None or r.clear == r.want for r in got)
    sure = [r.clear is not None for r in got if r.h is not None and abs(r.h) < 1000 and r.s in ("left", "right", "rear") and (r.x, r.y) != (0, 0)]
    assert sum(sure) > 0.9 * len(sure)


@pytest.mark.parametrize("a,b,want", [(350, 10, 0), (0, 90, 45), (10, 10.5, 10.25)])
@pytest.mark.parametrize("flip", [1, -1])
def test_slerp_midpoint(spark, a, b, want, flip):
    q1 = tuple(flip * c for c in quat(b))
    q = pose.slerp(quat(a), q1, F.lit(0.5))
    yaw = math.degrees(one(spark, pose.yaw(q))[0])
    assert abs((yaw - want + 180) % 360 - 180) < 1e-6


def test_rotation_round_trips(spark):
    for q in [(0.1, 0.2, 0.3, 0.9), (0.9, 0.1, -0.2, 0.05), (0.1, -0.95, 0.1, 0.02), (0.0, 0.1, 0.99, -0.1), (0, 0, 0, 1.0)]:
        n = math.sqrt(sum(v * v for v in q))
        lits = [F.lit(v / n) for v in q]
        again = pose.rot_to_quat(pose.quat_to_rot(lits))
        assert abs(abs(one(spark, pose.quat_dot(lits, again))[0]) - 1) < 1e-9
        t = (pose.quat_to_rot(lits), (F.lit(1.0), F.lit(-2.0), F.lit(3.0)))
        p = tuple(F.lit(v) for v in (4.0, 5.0, -6.0))
        back = pose.apply_t(pose.invert_t(t), pose.apply_t(t, p))
        assert [round(v, 9) for v in one(spark, *back)] == [4, 5, -6]
        moved = pose.apply_t(t, p)
        zero = pose.apply_t(t, tuple(F.lit(0.0) for _ in range(3)))
        length = one(spark, geo.distance3(*moved, *zero))[0]
        assert abs(length - math.sqrt(77)) < 1e-9


def test_grid_conversion_against_published_points(spark):
    rows = [(52.657977, 1.716038, 651409.903, 313177.270)]
    df = spark.createDataFrame(rows, "lat double, lon double, e double, n double")
    for r in geo.wgs84_to_bng(df).collect():
        assert abs(r.x - r.e) < 5 and abs(r.y - r.n) < 5  # Helmert is metre-level
    for r in geo.bng_to_wgs84(df.drop("lat", "lon"), "e", "n").collect():
        want = min(rows, key=lambda w: abs(w[2] - r.e))
        assert abs(r.lat - want[0]) < 5e-5 and abs(r.lon - want[1]) < 8e-5


def test_uuid5_equals_python(spark):
    names = ["rec_1", "a_b", "Überweg_7", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string").select("name", labels.uuid5("name").alias("u"))
    assert {r.name: r.u for r in df.collect()} == {n: str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names}


def test_labels(spark):
    row = one(spark, labels.stamp_name(F.lit(1_706_151_878_947_999_999)), labels.recording_id(F.lit("pass7_mar24"), "r", 2026),
              labels.recording_id(F.lit("pass7_foo24"), "r", 2026), labels.num(F.lit("x"), 2.0), labels.num(F.lit(" 3.5 ")),
              labels.camera_side(F.lit("cam_left_rgb")), labels.motion_class(F.lit(0.35), F.lit(0.025)),
              labels.motion_class(F.lit(0.36), F.lit(0.02)), labels.motion_class(F.lit(9.0), F.lit(0.0)),
              labels.fix_type_name(F.lit(6)), labels.keyframe_distance(F.lit(5 / 3.6)), labels.signal_grade(F.lit(-105.0)))
    assert list(row) == ["20240125_030438_947", "r-pass7-20260324", "r-pass7-20260024", 2.0, 3.5, "left", "STATIC", "MICRO",
                         "HIGHWAY", "RTKFixed", 2.0, "Good"]


def test_floor_not_truncation(spark):
    row = one(spark, *labels.voxel_of(F.lit(-0.1), F.lit(0.1), F.lit(-1.0), 1.0))
    assert list(row) == [-1, 0, -1]


def test_planck_is_monotonic_and_plausible(spark):
    df = spark.range(19000, 24000, 500).select(
        thermal.planck_celsius(F.col("id"), thermal.RADIOMETRY["thermal1"], 15.0, 0.5).alias("c"))
    values = [r.c for r in df.collect()]
    assert values == sorted(values)


def test_sql_functions_match_columns(spark):
    register_sql_functions(spark)
    row = spark.sql("SELECT plan_bearing(0D,0D,1D,0D) a, camera_perp_angle(350D,'left') b, wrap180(358D) c, quat_yaw(0D,0D,1D,0D) d").first()
    assert [round(v, 6) for v in row] == [90, 100, -2, round(math.pi, 6)]
