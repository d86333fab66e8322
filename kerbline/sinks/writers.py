"""Writers (K1, K6, K7, K9, K10, K12-K14). Spark's commit protocol makes each write all-or-nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.functions.labels import morton, tile_of
from kerbline.operators.fleet import merge_progress
from kerbline.operators.points import with_tile
from kerbline.operators.quality import audit_summary
from kerbline.session import settle

SAMPLE_SPACE = 1_000_000


def valid_place() -> Column:
    return (F.abs("lat") > 0.1) & (F.abs("lon") > 0.0001)


def trajectory_rows(traj: DataFrame, by: list[str]) -> DataFrame:
    """K1: rows of the grid trajectory text, ``t_ns x y z heading``, two digits."""
    two = [F.format_string("%.2f", c) for c in ("x", "y", "z", "heading_deg")]
    line = F.concat_ws(" ", F.col("t_ns").cast("string"), *two)
    return traj.filter(valid_place()).select(*by, "t_ns", line.alias("line"))


def trajectory_json(traj: DataFrame, by: list[str]) -> DataFrame:
    """K1: records of the geographic trajectory, eight digits for places."""
    return traj.filter(valid_place()).select(
        *by, F.col("t_ns").alias("timestamp_ns"), F.round("lat", 8).alias("lat"), F.round("lon", 8).alias("lon"),
        F.round("alt", 2).alias("alt"), F.round("heading_deg", 2).alias("heading"),
    )


def write_trajectory(traj: DataFrame, path: str, by: list[str]) -> None:
    """K1: text and JSON, sorted in files by time and partitioned by the keys."""
    rows = trajectory_rows(traj, by).repartitionByRange(*by, "t_ns").sortWithinPartitions(*by, "t_ns")
    rows.select(*by, "line").write.mode("overwrite").partitionBy(*by).text(f"{path}/trajectory_bng")
    trajectory_json(traj, by).write.mode("overwrite").partitionBy(*by).json(f"{path}/trajectory_wgs84")


def write_motion_audit(audit: DataFrame, path: str, idx: str = "idx", moving: str = "moving", min_path_m: float = 50.0,
                       min_peak_mps: float = 2.0) -> None:
    """K6: the audit as CSV, its totals with the thresholds and the moving ranges as JSON."""
    audit = settle(audit)
    totals, ranges = audit_summary(audit, idx, moving, min_path_m, min_peak_mps)
    audit.write.mode("overwrite").option("header", "true").csv(f"{path}/motion_audit")
    totals.write.mode("overwrite").json(f"{path}/summary")
    ranges.write.mode("overwrite").json(f"{path}/moving_ranges")


def write_cards(cards: DataFrame, path: str, by: list[str]) -> None:
    """A10: the lines of :func:`sanity_cards`, one folder per key, in order inside a file."""
    cards.repartition(*by).sortWithinPartitions(*by, "line_no").select(*by, "value").write.mode("overwrite").partitionBy(*by).text(path)


def write_document(records: DataFrame, path: str, by: list[str]) -> None:
    """K2, K3: JSON records partitioned by the keys and section."""
    records.select(*by, "section", "json").write.mode("overwrite").partitionBy(*by, "section").text(path)


def write_point_tiles(points: DataFrame, path: str, tile_m: float, max_rows: int = 5_000_000,
                      salts: int = 1) -> None:
    """K7: points by tile, files of at most ``max_rows``, sorted by cell inside.

    ``salts`` spreads each tile over several tasks when a tile holds much of the data.
    """
    tiled = with_tile(points, tile_m)
    spread = F.pmod(F.xxhash64("x", "y", "z"), F.lit(salts))
    (
        tiled.repartition("tx", "ty", spread).sortWithinPartitions("tx", "ty", "x", "y")
        .write.mode("overwrite").option("maxRecordsPerFile", max_rows).partitionBy("tx", "ty").parquet(path)
    )


def write_point_map(points: DataFrame, path: str, cell_m: float, max_rows: int = 5_000_000, group_bytes: int = 16 << 20) -> None:
    """K7 for large areas: one table of points along a space-filling curve of cells.

    Rows are dealt to tasks by ranges of (curve, x, y), about ``max_rows`` each, so a cell with
    half of all points is many files and a million empty cells cost nothing. Neighbours lie
    together, so the least and greatest coordinates that Parquet keeps of each row group are
    close, and :func:`read_point_box` skips all groups outside its box.
    """
    rows = points.withColumn("__z", morton(*tile_of("x", "y", cell_m)))
    parts = max(1, -(-points.count() // max_rows))
    spread = rows.repartitionByRange(parts, "__z", "x", "y").sortWithinPartitions("__z", "x", "y").drop("__z")
    spread.write.mode("overwrite").option("maxRecordsPerFile", max_rows).option("parquet.block.size", group_bytes).parquet(path)


def read_point_box(spark: SparkSession, path: str, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """The points of :func:`write_point_map` inside a box; the box reaches the file scan."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("x").between(xmin, xmax) & F.col("y").between(ymin, ymax))


def sample_export(points: DataFrame, share: float, id_cols: list[str], seed: int = 0) -> DataFrame:
    """K9: a repeatable sample by hash; the same rows on every run and cluster."""
    spot = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in id_cols]), F.lit(SAMPLE_SPACE))
    return points.filter(spot < int(share * SAMPLE_SPACE))


def upsert_progress(batch: DataFrame, path: str, keys: list[str], version: str, bucket: str) -> None:
    """Merge a batch into a table partitioned by ``bucket``; only touched buckets are rewritten.

    The merged rows are settled before the write because it replaces files it reads.
    """
    spark = batch.sparkSession
    try:
        stored = spark.read.schema(batch.schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = None
    rows = batch
    if stored is not None:
        touched = batch.select(bucket).distinct()
        rows = stored.join(touched, bucket, "left_semi").select(*batch.columns)
        rows = merge_progress(rows, batch, keys, version)
    else:
        rows = merge_progress(batch.limit(0), batch, keys, version)
    settle(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(bucket).parquet(path)


def slim_recording(messages: DataFrame, topics: list[str]) -> DataFrame:
    """Only the wanted topics."""
    return messages.filter(F.col("topic").isin(topics))


def write_slim_recording(messages: DataFrame, topics: list[str], path: str) -> None:
    """Written by session and topic; a shard without wanted messages leaves no file."""
    slim_recording(messages, topics).write.mode("overwrite").partitionBy("session_id", "topic").parquet(path)


def append_run_log(rows: DataFrame, path: str) -> None:
    """Add run records."""
    rows.write.mode("append").option("header", "true").csv(path)


def matrix_report(matrix: DataFrame, engines: list[str], fields: tuple[str, ...] = ("verdict", "pose_rate_hz", "cumul_distance_m")) -> DataFrame:
    """One Markdown table row per tag; absent cells show a dash."""
    cells = [F.coalesce(F.col(f"{e}_{f}").cast("string"), F.lit("—")) for f in fields for e in engines]
    head = [F.col("tag"), F.coalesce("class", F.lit("?")), F.coalesce(F.col("n_bags").cast("string"), F.lit("?"))]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *head, *cells), F.lit(" |"))
    return matrix.select("tag", line.alias("line"))
