"""Structured Streaming forms of the live pipeline."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from kerbline.operators.points import VOXEL, with_voxel
from kerbline.operators.quantiles import first_rows
from kerbline.operators.visibility import heroes, visibility_pairs
from kerbline.streaming.stateful import VoxelLife

NS = 1_000_000_000


def read_stream(spark: SparkSession, path: str, schema: StructType | str, time_ns: str = "t_ns",
                delay: str = "10 seconds", max_files: int | None = None,
                fmt: str = "parquet", **options: str) -> DataFrame:
    """A live table with ``event_time`` and a watermark. ``fmt='kafka'`` takes its options."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(path) if path else reader.load()
    return rows.withColumn("event_time", F.timestamp_micros(F.expr(f"{time_ns} div 1000"))).withWatermark(
        "event_time", delay
    )


def live_visibility(frames: DataFrame, props: DataFrame, **args) -> DataFrame:
    """Pairs of a frame stream and the static property table.

    A stream cannot be counted beforehand, so hot cells are left to the static side's cells.
    """
    return visibility_pairs(frames, props, hot_rows=None, **args)


def live_heroes(frames: DataFrame, props: DataFrame, **args) -> DataFrame:
    """Best frame per property so far; write in ``update`` mode."""
    return heroes(live_visibility(frames, props, **args))


def latest_per_source(stream: DataFrame, by: list[str], source: str, value: str, time: str = "t_ns") -> DataFrame:
    """Latest value of each source per key; ``update`` mode."""
    return stream.groupBy(*by, source).agg(
        F.max_by(value, time).alias(value), F.max(time).alias(time)
    )


def matched_by_time(left: DataFrame, right: DataFrame, by: list[str], max_age: str,
                    left_time: str = "event_time", right_time: str = "right_time") -> DataFrame:
    """Stream-stream interval join: right rows at most ``max_age`` before a left row.

    Both sides need watermarks so that state can be dropped.
    """
    same = reduce(lambda a, b: a & b, [left[c] == right[c] for c in by])
    near = (right[right_time] <= left[left_time]) & (
        right[right_time] >= left[left_time] - F.expr(f"INTERVAL {max_age}")
    )
    return left.join(right, same & near).drop(*[right[c] for c in by])


def live_rates(stream: DataFrame, by: list[str], width: str = "5 seconds", event_time: str = "event_time") -> DataFrame:
    """Messages per second in tumbling windows."""
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return stream.groupBy(*by, F.window(event_time, width).alias("w")).agg(
        F.count(F.lit(1)).alias("n")
    ).select(*by, F.col("w.start").alias("window_start"), (F.col("n") / seconds).alias("rate_hz"))


def live_voxel_map(points: DataFrame, size: float, time: str = "t_ns") -> DataFrame:
    """Latest point per voxel of a stream; ``update`` mode.

    Plain aggregation state, spread over all tasks by voxel, which never expires; see
    :func:`decaying_voxel_map`. :func:`cap_voxel_map` applies the cap to the stored map.
    """
    return with_voxel(points, size).groupBy(*VOXEL).agg(
        *[F.max_by(c, time).alias(c) for c in ("x", "y", "z", "intensity")], F.max(time).alias(time)
    )


def decaying_voxel_map(points: DataFrame, size: float, ttl_ns: int, time: str = "t_ns") -> DataFrame:
    """Latest point per voxel of a stream with a watermark, voxels dropped ``ttl_ns`` after it; ``update`` mode.

    One state per voxel with one timer at its end of life, so the state is as large as the
    voxels alive. A row with ``gone`` set tells that its voxel has been dropped.
    """
    kept = [*VOXEL, "x", "y", "z", "intensity", time]
    rows = with_voxel(points, size).select(*kept, "event_time")
    fields = T.StructType([rows.schema[c] for c in kept] + [T.StructField("gone", T.BooleanType())])
    return rows.groupBy(*VOXEL).transformWithStateInPandas(
        VoxelLife(list(VOXEL), kept[len(VOXEL):], ttl_ns, time), outputStructType=fields, outputMode="Update", timeMode="EventTime")


def latest_voxels(updates: DataFrame, epoch: str = "epoch") -> DataFrame:
    """The map after all updates: each voxel as its last update left it, without those that are gone."""
    last = Window.partitionBy(*VOXEL).orderBy(F.desc(epoch), F.col("gone"))
    return updates.withColumn("__rn", F.row_number().over(last)).where("__rn = 1 AND NOT gone").drop("__rn", epoch, "gone")


def cap_voxel_map(voxels: DataFrame, cap: int, ttl_ns: int | None = None, now_ns: int | None = None,
                  time: str = "t_ns") -> DataFrame:
    """The ``cap`` most recently updated voxels of the whole map, optionally only fresh ones.

    The time of the last one that stays is found by counting, so nothing is sorted as a whole;
    equal times go by voxel. The cap is the feature.
    """
    rows = voxels
    if ttl_ns is not None and now_ns is not None:
        rows = rows.filter(F.col(time) >= now_ns - ttl_ns)
    return first_rows(rows, cap, [(time, True), *[(c, False) for c in VOXEL]])


def periodic(stream: DataFrame, every: str, write: Callable[[DataFrame, int], None], checkpoint: str,
             mode: str = "update", available_now: bool = False):
    """Run ``write`` on each micro-batch; progress and resume live in ``checkpoint``."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def split_late(batch: DataFrame, watermark_ns: int, time: str = "t_ns") -> tuple[DataFrame, DataFrame]:
    """Rows of a micro-batch on and behind a watermark, for counting late data in ``foreachBatch``."""
    late = F.col(time) < watermark_ns
    return batch.filter(~late), batch.filter(late)


def with_late_counter(stream: DataFrame, sink: Callable[[DataFrame, DataFrame, int], None], delay_ns: int,
                      checkpoint: str, time: str = "t_ns", trigger: dict | None = None):
    """Start a query that hands ``sink`` the timely and the late rows of each micro-batch.

    Late means more than ``delay_ns`` behind the greatest time of all earlier batches, which
    is Spark's own watermark rule. The greatest time so far is kept in two one-row tables
    beside the checkpoint that batches write by turns: a restart, or a batch that is run
    again, finds the value before it, and a write that is cut off leaves the other. Works with
    any ``trigger``, by default all that is there now.
    """

    def slot(epoch: int) -> str:
        return f"{checkpoint.rstrip('/')}-time-{epoch % 2}"

    def known(spark: SparkSession, epoch: int) -> int | None:
        try:
            row = spark.read.schema("epoch long, top long").parquet(slot(epoch)).first()
        except Exception as error:  # the table appears with its first batch
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None
        return row["top"] if row is not None and row["epoch"] == epoch else None

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = known(spark, epoch - 1)
        timely, late = split_late(batch, -(2**63) if before is None else before - delay_ns, time)
        sink(timely, late, epoch)
        here = batch.agg(F.max(time)).first()[0]
        top = max((v for v in (before, here) if v is not None), default=None)
        spark.createDataFrame([(epoch, top)], "epoch long, top long").coalesce(1).write.mode("overwrite").parquet(slot(epoch))

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
