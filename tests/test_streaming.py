"""Stream and batch give the same rows, over several micro-batches and out-of-order arrival."""

import random

import pytest
from pyspark.sql import functions as F

from kerbline.operators import steps as T
from kerbline.operators.sequential import run_sequential
from kerbline.operators.visibility import heroes, visibility_pairs
from kerbline.plans.bindings import Tables
from kerbline.streaming import live
from kerbline.streaming.stateful import stream_sequential

NS = 1_000_000_000
SCHEMA = "k LONG, t_ns LONG, x DOUBLE, y DOUBLE, id LONG"


def track(n=120, seed=3):
    rnd = random.Random(seed)
    rows, x, y = [], 0.0, 0.0
    for i in range(n):
        x, y = x + rnd.uniform(0, 2), y + rnd.uniform(-1, 1)
        rows.append((i % 3, 1_700_000_000 * NS + i * NS // 2, x, y, i))
    return rows


def write_batches(spark, rows, path, size=40, swap=3):
    rnd = random.Random(1)
    for start in range(0, len(rows), size):
        part = rows[start:start + size]
        for i in range(0, len(part) - swap, swap):  # disorder inside the allowed delay
            block = part[i:i + swap]
            rnd.shuffle(block)
            part[i:i + swap] = block
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def drain(query):
    query.processAllAvailable()
    query.stop()


CASES = {
    "gate": T.trajectory_gate(2.0), "guard": T.monotonic_guard(1000), "alerts": T.limit_alerts(3, 20 * NS, 4 * NS), "gap": T.gap_alert(NS),
}


@pytest.mark.parametrize("name", CASES)
def test_stream_equals_batch(spark, tmp_path, name):
    step, rows = CASES[name], track()
    last = rows[-1][1]
    # a far later row of another key moves the watermark past everything
    write_batches(spark, rows + [(99, last + 3600 * NS, 0.0, 0.0, 9999)], str(tmp_path / "in"))
    stream = live.read_stream(spark, str(tmp_path / "in"), SCHEMA, max_files=1, delay="5 seconds")
    out = stream_sequential(stream, ["k"], ["t_ns"], step, "event_time")
    q = (out.writeStream.format("memory").queryName(f"seq_{name}").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination(240)
    assert q.exception() is None
    got = {tuple(r) for r in spark.table(f"seq_{name}").filter("k < 90").collect()}
    batch = run_sequential(spark.createDataFrame(rows, SCHEMA), ["k"], ["t_ns"], step, segment_rows=25)
    want = {tuple(r) for r in batch.collect()}
    assert got == want and len(want) > 3


def test_live_heroes_match_batch(spark, tmp_path, folder):
    t = Tables(spark, folder)
    frames = t.frames().repartition(3)
    frames.write.parquet(str(tmp_path / "frames"))
    stream = live.read_stream(spark, str(tmp_path / "frames"), frames.schema, max_files=1, delay="3650 days")
    best = live.live_heroes(stream, t.properties())
    seen = {}

    def keep(batch, epoch):
        for row in batch.collect():
            seen[row.p_uprn] = row.asDict()

    q = live.periodic(best, "1 second", keep, str(tmp_path / "cp"), available_now=True)
    q.awaitTermination(240)
    want = {r.p_uprn: r.asDict() for r in heroes(visibility_pairs(t.frames(), t.properties())).collect()}
    assert seen == want


def test_live_rates_and_voxels(spark, tmp_path):
    rows = track()
    write_batches(spark, rows, str(tmp_path / "in"))
    stream = live.read_stream(spark, str(tmp_path / "in"), SCHEMA, max_files=1)
    q = (live.live_rates(stream, ["k"]).writeStream.format("memory").queryName("rates").outputMode("complete")
         .option("checkpointLocation", str(tmp_path / "cp1")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    total = spark.table("rates").agg(F.sum(F.col("rate_hz") * 5)).first()[0]
    assert round(total) == len(rows)

    points = stream.withColumn("z", F.lit(0.0)).withColumn("intensity", F.col("id").cast("double"))
    q = (live.live_voxel_map(points, 5.0).writeStream.format("memory").queryName("vox").outputMode("complete")
         .option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {(r.ix, r.iy): r.t_ns for r in spark.table("vox").collect()}
    want = {}
    for _, t_ns, x, y, _ in rows:
        cell = (int(x // 5), int(y // 5))
        want[cell] = max(want.get(cell, 0), t_ns)
    assert got == want
    capped = live.cap_voxel_map(spark.table("vox"), 5)
    best = sorted(want.items(), key=lambda v: (-v[1], v[0]))[:5]
    assert {((r.ix, r.iy), r.t_ns) for r in capped.collect()} == set(best)


def test_voxels_leave_the_state_after_their_time(spark, tmp_path):
    """Every batch brings twenty new voxels; only those of the last 30 seconds stay in the state."""
    base = 1_700_000_000 * NS
    batches = [[(0, base + (b * 20 + i) * NS, float(b * 20 + i) * 3, 0.0, i) for i in range(20)] for b in range(6)]
    batches[3].append((0, base + 61 * NS, 1.0, 0.0, 99))  # the first voxel is seen again
    for part in batches:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.read_stream(spark, str(tmp_path / "in"), SCHEMA, max_files=1, delay="1 second")
    points = stream.withColumn("z", F.lit(0.0)).withColumn("intensity", F.col("id").cast("double"))
    out = str(tmp_path / "out")
    q = live.periodic(live.decaying_voxel_map(points, 3.0, 30 * NS), "", lambda b, e: b.withColumn("epoch", F.lit(e)).write.mode("append").parquet(out),
                      str(tmp_path / "cp"), available_now=True)
    q.awaitTermination(240)
    assert q.exception() is None
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    alive = {r.ix: r.t_ns for r in live.latest_voxels(spark.read.parquet(out)).collect()}
    want = {}
    for part in batches:
        for _, t, x, *_ in part:
            want[int(x // 3)] = max(want.get(int(x // 3), 0), t)
    now = max(want.values()) - NS
    assert alive == {k: t for k, t in want.items() if t + 30 * NS > now}
    assert max(sizes[-2:]) <= max(sizes[:4]) and sizes[-1] <= 40 * 2  # values and timers


def test_late_rows_are_counted(spark, tmp_path):
    base = 1_700_000_000 * NS
    for i, ts in enumerate([[0, 10, 20], [30, 15, 29], [5, 31]]):
        rows = [(0, base + s * NS, 0.0, 0.0, s) for s in ts]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counts = []
    q = live.with_late_counter(stream, lambda ok, late, e: counts.append((ok.count(), late.count())),
                               4 * NS, str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert q.exception() is None
    assert sum(a for a, _ in counts) + sum(b for _, b in counts) == 8
    assert sum(b for _, b in counts) >= 2


def test_stream_stream_match(spark, tmp_path):
    left = [(0, 1_700_000_000 * NS + i * 10 * NS, 0.0, 0.0, i) for i in range(5)]
    right = [(0, t - 2 * NS, x, y, i) for _, t, x, y, i in left]
    spark.createDataFrame(left, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "l"))
    spark.createDataFrame(right, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "r"))
    a = live.read_stream(spark, str(tmp_path / "l"), SCHEMA)
    b = live.read_stream(spark, str(tmp_path / "r"), SCHEMA).select("k", F.col("id").alias("rid"), F.col("event_time").alias("right_time"))
    q = (live.matched_by_time(a, b, ["k"], "5 seconds").writeStream.format("memory").queryName("mm")
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert {(r.id, r.rid) for r in spark.table("mm").collect()} == {(i, i) for i in range(5)}
