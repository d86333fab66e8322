"""Readers (S1, S5, S6, S8-S14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.functions.pose import rot_to_quat
from kerbline.operators.windows import first_by
from kerbline.sources.sidecars import SidecarSource

MESSAGES = "topic STRING, log_time_ns LONG, publish_time_ns LONG, seq LONG, payload BINARY"
TRAJECTORY = "t DOUBLE, x DOUBLE, y DOUBLE, z DOUBLE, qx DOUBLE, qy DOUBLE, qz DOUBLE, qw DOUBLE"
ENGINES = ("fastlio", "dlio", "glim")
SPEED_CAN_ID, STEERING_CAN_ID = 0x118, 0x129
NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"


def read_messages(spark: SparkSession, path: str, topics: list[str], t0: int | None = None,
                  t1: int | None = None, schema: str = MESSAGES) -> DataFrame:
    """Messages of some topics; the topic list prunes partitions, the time range row groups."""
    df = spark.read.schema(T.StructType.fromDDL(f"{schema}, session_id STRING, shard STRING")).parquet(path)
    df = df.filter(F.col("topic").isin(topics))
    if t0 is not None:
        df = df.filter(F.col("log_time_ns") >= t0)
    if t1 is not None:
        df = df.filter(F.col("log_time_ns") <= t1)
    return df


def read_frames(spark: SparkSession, path: str, files_per_task: int = 5000) -> DataFrame:
    """Camera sidecars below a folder, or of a pattern, as ``session/camera/frame.meta.json``.

    Session and frame come from the path, the camera from the sidecar or else the path.
    Filters on session, camera and time reach the reader.
    """
    spark.dataSource.register(SidecarSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("sidecars").option("filesPerTask", files_per_task).load(path)


def read_properties(spark: SparkSession, path: str, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Properties, optionally inside (xmin, ymin, xmax, ymax); the box reaches the file scan."""
    df = spark.read.parquet(path)
    if bbox:
        xmin, ymin, xmax, ymax = bbox
        df = df.filter(F.col("x").between(xmin, xmax) & F.col("y").between(ymin, ymax))
    return df


def build_property_table(uprn: DataFrame, addr: DataFrame, xref: DataFrame, bldg: DataFrame,
                         cell: float = 50.0) -> DataFrame:
    """Places with address and building attributes, and the grid cell.

    The table keeps one row per property: of several addresses the whole row that is first by
    full address (null last) and then by its other columns, of several cross-references the
    least, of several rows of a building the first by its columns. What is passed over is the
    caller's to look at in the inputs.
    """
    a = first_by(addr, ["uprn"], [F.asc_nulls_last("fulladdress")])
    x = xref.groupBy("uprn").agg(F.min("osid").alias("osid"))
    b = first_by(bldg, ["osid"], [])
    rows = uprn.join(a, "uprn", "left").join(x, "uprn", "left").join(b, "osid", "left")
    return rows.withColumn("grid_x", F.floor(F.col("x") / cell)).withColumn("grid_y", F.floor(F.col("y") / cell))


def read_tum(spark: SparkSession, path: str) -> DataFrame:
    """Trajectory text ``t x y z qx qy qz qw`` in seconds; comment lines skipped.

    Times keep nanoseconds: the text is split at the point instead of going through a double.
    """
    schema = TRAJECTORY.replace("t DOUBLE", "t STRING")
    raw = spark.read.schema(schema).option("sep", " ").option("comment", "#").csv(path)
    return raw.filter(F.col("qw").isNotNull()).withColumn("t_ns", seconds_to_ns("t")).drop("t")


def seconds_to_ns(text: str) -> Column:
    """Decimal seconds as text to nanoseconds, exact."""
    return (F.col(text).cast("decimal(28,9)") * F.lit(1_000_000_000).cast("decimal(10,0)")).cast("long")


def _numbers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(f"({NUMBER})"), F.lit(1)), lambda n: n.cast("double"))


def _pose_columns(m: Column) -> list[Column]:
    rot = [m[4 * r + c] for r in range(3) for c in range(3)]
    quat = rot_to_quat(rot)
    return [*[m[4 * i + 3].alias(a) for i, a in enumerate("xyz")],
            *[q.alias(f"q{a}") for q, a in zip(quat, "xyzw")]]


def parse_submap_poses(texts: DataFrame, text: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Every 4x4 matrix after ``T_world_lidar:`` with the last ``stamp:`` before it."""
    block = rf"stamp:\s*({NUMBER})(?:(?!stamp:)[\s\S])*?T_world_lidar:\s*((?:{NUMBER}\s+){{15}}{NUMBER})"
    stamps = F.regexp_extract_all(F.col(text), F.lit(block), F.lit(1))
    mats = F.regexp_extract_all(F.col(text), F.lit(block), F.lit(2))
    rows = texts.select(*(keep or []), F.posexplode(F.arrays_zip(stamps.alias("s"), mats.alias("m"))).alias("pos", "__b"))
    rows = rows.withColumn("__s", F.col("__b.s")).withColumn("__m", _numbers(F.col("__b.m")))
    return rows.select(*(keep or []), "pos", seconds_to_ns("__s").alias("t_ns"), *_pose_columns(F.col("__m")))


def parse_submap_origin(texts: DataFrame, text: str = "value", keep: list[str] | None = None) -> DataFrame:
    """The matrix after ``T_world_origin:``."""
    body = F.regexp_extract(text, rf"T_world_origin:\s*((?:{NUMBER}\s+){{15}}{NUMBER})", 1)
    rows = texts.withColumn("__m", _numbers(body)).filter(F.size("__m") == 16)
    return rows.select(*(keep or []), *_pose_columns(F.col("__m")))


def read_submap_poses(spark: SparkSession, path: str) -> DataFrame:
    """Poses of all submap files under ``path``; one small text per submap."""
    texts = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    return parse_submap_poses(texts, keep=["path"])


CARD_LINE = r"^([a-z_0-9]+)\s*:\s*(.*?)\s*$"


def parse_cards(lines: DataFrame, keys: list[str], fields: list[str], text: str = "value") -> DataFrame:
    """Key:value report lines to one wide row per report; the last line of a key wins."""
    parsed = lines.select(*keys, "line_no", F.regexp_extract(text, CARD_LINE, 1).alias("k"),
                          F.regexp_extract(text, CARD_LINE, 2).alias("v")).filter(F.col("k").isin(fields))
    return parsed.groupBy(*keys).pivot("k", fields).agg(F.max_by("v", "line_no"))


def read_cards(spark: SparkSession, glob: str, fields: list[str]) -> DataFrame:
    """Reports ``<engine>_<tag>/.../sanity.txt`` with engine, tag and the wanted fields."""
    texts = spark.read.text(glob, wholetext=True).withColumn("path", F.input_file_name())
    lines = texts.select("path", F.posexplode(F.split("value", "\n")).alias("line_no", "value"))
    cards = parse_cards(lines, ["path"], fields)
    part = rf"({'|'.join(ENGINES)})_([^/]+)/"
    return cards.withColumn("engine", F.regexp_extract("path", part, 1)).withColumn(
        "tag", F.regexp_extract("path", part, 2)
    )


SEGMENT_LINE = {
    "start": (r"start:\s*(\d+)", "int"), "end": (r"end:\s*(\d+)", "int"),
    "tag": (r"tag:\s*([^,\s]+)", "string"), "class": (r"class:\s*([^,\s]+)", "string"),
    "n_bags": (r"n_bags:\s*(\d+)", "int"),
}


def parse_segments(lines: DataFrame, text: str = "value") -> DataFrame:
    """``- {start: .., end: .., tag: .., class: .., n_bags: ..}`` lines."""
    hit = F.col(text).rlike(r"^\s*-\s*\{start:.*n_bags:\s*\d+\}")
    return lines.filter(hit).select(
        *[F.regexp_extract(text, p, 1).try_cast(t).alias(n) for n, (p, t) in SEGMENT_LINE.items()]
    )


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return parse_segments(spark.read.text(path))


def discover_runs(paths: DataFrame, name: str = "name") -> DataFrame:
    """Directory names ``<engine>_<tag>`` to engine and tag; others drop out."""
    pattern = rf"^({'|'.join(ENGINES)})_(.*)$"
    return paths.filter(F.col(name).rlike(pattern)).withColumn(
        "engine", F.regexp_extract(name, pattern, 1)
    ).withColumn("tag", F.regexp_extract(name, pattern, 2))


def decode_can(frames: DataFrame) -> DataFrame:
    """Speed (m/s) and steering angle (rad) from big-endian CAN payloads."""
    def u16(first_byte: int) -> Column:
        return F.conv(F.hex(F.substring("data", first_byte, 2)), 16, 10).cast("int")

    raw = u16(1)
    signed = F.when(raw >= 32768, raw - 65536).otherwise(raw)
    speed = F.when(F.col("can_id") == SPEED_CAN_ID, u16(3) * 0.01 / 3.6)
    steer = F.when(F.col("can_id") == STEERING_CAN_ID, F.radians(signed * 0.1))
    return frames.select(*[c for c in frames.columns if c != "data"], speed.alias("speed_mps"),
                         steer.alias("steering_rad")).filter(
        F.col("speed_mps").isNotNull() | F.col("steering_rad").isNotNull()
    )


def classify_topics(config: DataFrame, name: str = "name") -> DataFrame:
    """Role of each configured stream."""
    role = F.when(F.col(name).endswith("_raw"), "thermal").when(F.col(name).startswith("lidar_"), "panorama").otherwise("rgb")
    return config.withColumn("role", role)
