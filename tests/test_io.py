"""Readers and writers round trip."""

import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kerbline.operators import fleet, quality
from kerbline.sinks import writers
from kerbline.sources import readers

NS = 1_000_000_000


def test_messages_prune_partitions(spark, tmp_path):
    rows = [("s1", "a_0.mcap", t, 100 + i, 100 + i, i, b"xy") for i, t in enumerate(["/imu", "/imu", "/points", "/gps"])]
    df = spark.createDataFrame(rows, "session_id string, shard string, topic string, log_time_ns long, publish_time_ns long, seq long, payload binary")
    writers.write_slim_recording(df, ["/imu", "/points"], str(tmp_path / "m"))
    got = readers.read_messages(spark, str(tmp_path / "m"), ["/imu"], t0=101)
    assert [r.seq for r in got.collect()] == [1]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "log_time_ns" in text.split("PushedFilters")[1]
    idx = fleet.shard_index(readers.read_messages(spark, str(tmp_path / "m"), ["/imu", "/points"]), ["session_id"])
    assert {(r.topic, r["count"], r.bytes) for r in idx.collect()} == {("/imu", 2, 4), ("/points", 1, 2)}


def test_frames_and_properties(spark, tmp_path):
    d = tmp_path / "left_rgb"
    d.mkdir()
    meta = {"timestamp_ns": 5, "gps": {"lat": 51.0, "lon": -1.0}, "bng": {"x": 1.5, "y": 2.5}, "heading_deg": 90.0}
    (d / "f1.meta.json").write_text(json.dumps(meta))
    row = readers.read_frames(spark, str(tmp_path / "*" / "*.meta.json")).first()
    assert (row.frame_id, row.camera, row.t_ns, row.x, row.heading_source) == ("f1", "left_rgb", 5, 1.5, None)
    spark.createDataFrame([("u1", 10.0, 10.0), ("u2", 99.0, 10.0)], "uprn string, x double, y double").write.parquet(str(tmp_path / "p"))
    assert [r.uprn for r in readers.read_properties(spark, str(tmp_path / "p"), (0, 0, 50, 50)).collect()] == ["u1"]


def test_sidecars_are_packed_and_filtered_at_the_source(spark, tmp_path):
    rows = []
    for i in range(600):
        session, camera = f"s{i % 3}", "left" if i % 2 else "right"
        folder = tmp_path / session / camera
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{i:04d}.meta.json").write_text(json.dumps({"timestamp_ns": i, "bng": {"x": i / 2, "y": None}, "radiometric": True}))
        rows.append((session, camera, f"f{i:04d}", i))
    odd = tmp_path / "s9" / "rear"
    odd.mkdir(parents=True)
    (odd / "cut.meta.json").write_text('{"timestamp_ns": ')
    (odd / "empty.meta.json").write_text("")
    (odd / "list.meta.json").write_text("[1]")
    (odd / "named.meta.json").write_text('{"camera": "front", "timestamp_ns": "7", "gps": 3}')
    (odd / "other.txt").write_text("x")
    frames = readers.read_frames(spark, str(tmp_path), files_per_task=400)
    assert frames.rdd.getNumPartitions() == 2
    assert {(r.session_id, r.camera, r.frame_id, r.t_ns) for r in frames.where("session_id <> 's9'").collect()} == set(rows)
    assert {(r.frame_id, r.camera, r.t_ns, r.lat) for r in frames.where("session_id = 's9'").collect()} == {
        ("cut", "rear", None, None), ("empty", "rear", None, None), ("list", "rear", None, None), ("named", "front", 7, None)}
    some = frames.where("session_id in ('s1', 's9') and t_ns >= 100 and t_ns < 200 and camera = 'left'")
    assert {r.frame_id for r in some.collect()} == {f for s, c, f, t in rows if s == "s1" and c == "left" and 100 <= t < 200}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and not re.search(r"\bFilter\b", plan)  # all of it is done by the source
    assert some.rdd.getNumPartitions() == 1  # 204 files of two sessions are opened, not 604


def test_trajectory_text_keeps_nanoseconds(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# time\n1700000000.123456789 1 2 3 0 0 0 1\n1700000001.5 4 5 6 0 0 0 1\n")
    got = readers.read_tum(spark, str(tmp_path / "t.txt")).orderBy("t_ns").collect()
    assert [r.t_ns for r in got] == [1700000000123456789, 1700000001500000000] and got[1].x == 4.0


def test_submaps_cards_segments(spark, tmp_path):
    text = ("id: 1\nT_world_origin: \n1 0 0 7\n0 1 0 8\n0 0 1 9\n0 0 0 1\nframe_0\nid: 3\nstamp: 12.5\nT_odom_lidar: \n1 0 0 0\n0 1 0 0\n0 0 1 0\n0 0 0 1\n"
            "T_world_lidar: \n0 -1 0 1.5\n1 0 0 -2e1\n0 0 1 3\n0 0 0 1\nframe_1\nstamp: 13.25\nT_world_lidar: \n1 0 0 0\n0 1 0 0\n0 0 1 0\n0 0 0 1\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "data.txt").write_text(text)
    got = readers.read_submap_poses(spark, str(tmp_path / "sub")).orderBy("t_ns").collect()
    assert [(r.t_ns, r.x, r.y) for r in got] == [(12_500_000_000, 1.5, -20.0), (13_250_000_000, 0.0, 0.0)]
    assert abs(got[0].qz - 0.5**0.5) < 1e-9
    raw = spark.read.text(str(tmp_path / "sub"), wholetext=True)
    assert readers.parse_submap_origin(raw).first().y == 8.0

    card = tmp_path / "dlio_run_7" / "export"
    card.mkdir(parents=True)
    (card / "sanity.txt").write_text("title\n=====\nverdict          : PASS\npose_rate_hz     : 9.50\nbad line\n")
    row = readers.read_cards(spark, str(tmp_path / "*" / "export" / "sanity.txt"), ["verdict", "pose_rate_hz", "las_size_gb"]).first()
    assert (row.engine, row.tag, row.verdict, row.pose_rate_hz, row.las_size_gb) == ("dlio", "run_7", "PASS", "9.50", None)
    (tmp_path / "seg.yaml").write_text("# x\nsegments:\n  - {start: 3, end: 9, tag: urban_003_009, class: URBAN, n_bags: 7}\n")
    assert tuple(readers.read_segments(spark, str(tmp_path / "seg.yaml")).first()) == (3, 9, "urban_003_009", "URBAN", 7)


def test_can_sign(spark):
    rows = [(0x118, bytes([0, 0, 0x0E, 0x10, 0, 0])), (0x129, bytes([0xFF, 0x9C, 0, 0])), (0x1, b"\x00\x00\x00\x00")]
    got = readers.decode_can(spark.createDataFrame(rows, "can_id int, data binary")).collect()
    assert [round(v, 6) for v in (got[0].speed_mps, got[1].steering_rad)] == [10.0, round(-10 * 3.141592653589793 / 180, 6)] and len(got) == 2


def test_progress_upsert_replaces_only_newer(spark, tmp_path):
    path, schema = str(tmp_path / "progress"), "session string, bucket int, frames long, version long"
    writers.upsert_progress(spark.createDataFrame([("a", 0, 10, 1), ("b", 1, 5, 1)], schema), path, ["session"], "version", "bucket")
    writers.upsert_progress(spark.createDataFrame([("a", 0, 20, 2), ("c", 0, 7, 1)], schema), path, ["session"], "version", "bucket")
    got = {r.session: r.frames for r in spark.read.parquet(path).collect()}
    assert got == {"a": 20, "b": 5, "c": 7}


def test_point_tiles_and_reports(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("point_id"), (F.col("id") % 40).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"), F.lit(0.0).alias("z"))
    writers.write_point_tiles(df, str(tmp_path / "tiles"), 10.0, max_rows=100, salts=2)
    back = spark.read.parquet(str(tmp_path / "tiles"))
    assert back.count() == 1000 and {r.tx for r in back.select("tx").distinct().collect()} == {0, 1, 2, 3}
    traj = spark.createDataFrame([("s", 2, 51.0, -1.0, 5.0, 1.234, 2.0, 3.0, 90.0), ("s", 1, 0.0, -1.0, 5.0, 1.0, 2.0, 3.0, 90.0)],
                                 "session string, t_ns long, lat double, lon double, alt double, x double, y double, z double, heading_deg double")
    writers.write_trajectory(traj, str(tmp_path / "traj"), ["session"])
    lines = spark.read.text(str(tmp_path / "traj" / "trajectory_bng")).collect()
    assert [r.value for r in lines] == ["2 1.23 2.00 3.00 90.00"]
    log = spark.createDataFrame([("e", "t", 1)], "engine string, tag string, exit int")
    writers.append_run_log(log, str(tmp_path / "log"))
    writers.append_run_log(log, str(tmp_path / "log"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "log")).count() == 2


def test_missing_folder_is_not_swallowed(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_properties(spark, str(tmp_path / "absent")).count()


def test_audit_and_cards_are_written_and_read_back(spark, tmp_path):
    audit = spark.createDataFrame([(i, i in (2, 3, 7), float(i)) for i in range(9)], "idx long, moving boolean, path_length_m double")
    writers.write_motion_audit(audit, str(tmp_path / "a"), min_path_m=10.0, min_peak_mps=1.5)
    total = spark.read.json(str(tmp_path / "a" / "summary")).first()
    assert (total.total_bags, total.moving_bags, total.thresholds.min_path_m) == (9, 3, 10.0)
    assert {(r.start, r.end, r.n) for r in spark.read.json(str(tmp_path / "a" / "moving_ranges")).collect()} == {(2, 3, 2), (7, 7, 1)}
    assert spark.read.option("header", "true").csv(str(tmp_path / "a" / "motion_audit")).count() == 9
    poses = spark.createDataFrame([(e, t * 10**9, float(t * v)) for e, v in (("glim", 1), ("dlio", 90)) for t in range(5)], "engine string, t_ns long, x double").selectExpr(
        "engine", "t_ns", "x", "0D y", "0D z", "0D qx", "0D qy", "0D qz", "1D qw")
    cards = quality.sanity_cards(quality.pose_stats(poses, ["engine"], ["t_ns"]), ["engine"])
    writers.write_cards(cards, str(tmp_path / "c"), ["engine"])
    lines = spark.read.text(str(tmp_path / "c")).withColumn("line_no", F.lit(0))
    got = {r.engine: r for r in readers.parse_cards(lines, ["engine"], ["verdict", "pose_count", "fail_reasons", "warn_rate"]).collect()}
    assert (got["glim"].verdict, got["glim"].pose_count, got["glim"].fail_reasons, got["glim"].warn_rate) == ("WARN", "5", None, "rate=1.00<5.0 Hz")
    assert got["dlio"].verdict == "FAIL" and "p99_speed=90.0" in got["dlio"].fail_reasons
    with pytest.raises(ValueError):
        quality.require_pass(quality.pose_stats(poses, ["engine"], ["t_ns"]))
    forced = quality.require_pass(quality.pose_stats(poses, ["engine"], ["t_ns"]), force=True)
    assert {r.engine: r.verdict for r in forced.collect()}["dlio"] == "WARN (forced)"


def test_property_table_takes_whole_rows(spark):
    places = spark.createDataFrame([(1, 10.0, 60.0), (2, 0.0, 0.0)], "uprn long, x double, y double")
    addr = spark.createDataFrame([(1, None, "A"), (1, "b road", "B"), (1, "b road", "A"), (2, None, "C"), (2, None, None)], "uprn long, fulladdress string, postcode string")
    xref = spark.createDataFrame([(1, "o2"), (1, "o1")], "uprn long, osid string")
    bldg = spark.createDataFrame([("o1", 5.0, "x"), ("o1", 4.0, "y"), ("o2", 1.0, "z")], "osid string, height double, age string")
    got = {r.uprn: (r.fulladdress, r.postcode, r.osid, r.height, r.age) for r in readers.build_property_table(places, addr, xref, bldg).collect()}
    assert got == {1: ("b road", "A", "o1", 4.0, "y"), 2: (None, None, None, None, None)}


def test_point_map_skips_row_groups(spark, tmp_path):
    """Half of the points lie in one cell; a box elsewhere reads few row groups."""
    spread = spark.range(60_000).selectExpr("id", "rand(1) * 1000 - 500 AS x", "rand(2) * 1000 - 500 AS y")
    dense = spark.range(60_000, 120_000).selectExpr("id", "rand(3) AS x", "rand(4) AS y")
    path = str(tmp_path / "map")
    points = spread.union(dense)
    writers.write_point_map(points, path, 10.0, max_rows=2_000, group_bytes=1 << 14)
    groups, inside = 0, 0
    for file in (tmp_path / "map").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        assert meta.num_rows <= 2_000
        for g in range(meta.num_row_groups):
            x, y = (next(meta.row_group(g).column(c).statistics for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == n) for n in "xy")
            groups += 1
            inside += x.max >= 100 and x.min <= 150 and y.max >= -300 and y.min <= -250
    assert groups >= 60 and inside < 0.1 * groups
    box = writers.read_point_box(spark, path, 100.0, -300.0, 150.0, -250.0)
    assert "PushedFilters: [IsNotNull(x)" in box._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in box.collect()) == sorted(r.id for r in points.where("x between 100 and 150 and y between -300 and -250").collect())
