"""Queries that run a stream over a whole table and return what it leaves behind."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.plans.bindings import DAY, HOUR, Tables, with_tables
from kerbline.plans.registry import query
from kerbline.session import ensure_checkpoint_dir
from kerbline.streaming import live

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _folder(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _state_settings(spark: SparkSession):
    """The store that timers need; one state partition per core, as a stream keeps its number for good."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


DECAY, DELAY = 400 * DAY, "1 hours"


@query(with_tables("points") + f""", m AS (SELECT CAST(floor(x / 5) AS BIGINT) AS ix, CAST(floor(y / 5) AS BIGINT) AS iy, CAST(floor(z / 5) AS BIGINT) AS iz, max(t_ns) AS t_ns
  FROM points GROUP BY 1, 2, 3), n AS (SELECT max(t_ns) - {HOUR} AS now FROM points)
SELECT ix, iy, iz, t_ns FROM m, n WHERE t_ns + {DECAY} > now ORDER BY t_ns DESC, ix, iy, iz LIMIT 200""")
def live_voxel_map(t: Tables) -> DataFrame:
    """A stream over all points, voxels dropped 400 days after their last point, 200 newest kept."""
    spark = t.spark
    source = spark.readStream.schema(t.raw("lineitem").schema).parquet(f"{t.folder}/lineitem*.parquet")
    points = t.points(source).withColumn("event_time", F.timestamp_micros(F.expr("t_ns div 1000"))).withWatermark("event_time", DELAY)
    updates, checkpoint = _folder(spark, "voxels"), _folder(spark, "voxel-state")
    with _state_settings(spark):
        voxels = live.decaying_voxel_map(points, 5.0, DECAY)
        live.periodic(voxels, "", lambda batch, epoch: batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(updates), checkpoint,
                      available_now=True).awaitTermination()
    return live.cap_voxel_map(live.latest_voxels(spark.read.parquet(updates)), 200).select("ix", "iy", "iz", "t_ns")


ARRIVALS = 4


@query(with_tables("frames") + f""", a AS (SELECT session_id, t_ns, frame_id % {ARRIVALS} AS b FROM frames), s AS (SELECT b, max(t_ns) AS top FROM a GROUP BY b),
w AS (SELECT b, max(top) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT session_id, count(*) FILTER (before IS NULL OR t_ns >= before - {10 * DAY}) AS n_timely, count(*) FILTER (t_ns < before - {10 * DAY}) AS n_late
FROM a JOIN w USING (b) GROUP BY session_id""")
def late_rows(t: Tables) -> DataFrame:
    """All frames arriving in four portions, each run by a query that starts again; rows ten days late are counted apart."""
    spark = t.spark
    frames = t.frames().select("frame_id", "session_id", "t_ns")
    arriving, counts, checkpoint = _folder(spark, "arriving"), _folder(spark, "late"), _folder(spark, "late-state")

    def count(timely: DataFrame, late: DataFrame, epoch: int) -> None:
        both = timely.withColumn("late", F.lit(0)).unionByName(late.withColumn("late", F.lit(1)))
        both.groupBy("session_id").agg(F.count_if(F.col("late") == 0).alias("n_timely"), F.count_if(F.col("late") == 1).alias("n_late")).write.mode("append").parquet(counts)

    for portion in range(ARRIVALS):
        frames.where(F.col("frame_id") % ARRIVALS == portion).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(frames.schema).parquet(arriving)
        live.with_late_counter(stream, count, 10 * DAY, checkpoint).awaitTermination()
    return spark.read.parquet(counts).groupBy("session_id").agg(F.sum("n_timely").alias("n_timely"), F.sum("n_late").alias("n_late"))
