"""The bundled tables seen as survey tables, once for Spark and once as SQL text.

Both forms compute the same arithmetic, so every query over them can be checked against a
plain SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = 1_000_000_000
HOUR, DAY = 3600 * NS, 86_400 * NS
YEAR = 366 * DAY
#: Rows a part of a track: small, so that even the small tables are cut into many parts.
PARTS = 1_000


class Tables:
    """Lazy access to the bundled tables of one folder under survey names."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @staticmethod
    def _ns(col: str):
        return F.unix_micros(F.col(col).cast("timestamp")) * 1000

    def frames(self) -> DataFrame:
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
        side = (
            F.when(F.col("event_type").isin("click", "purchase"), "left")
            .when(F.col("event_type").isin("view", "signup"), "right").otherwise("rear")
        )
        heading = ((F.col("event_id") * 37) % 360).cast("double")
        return self.raw("events").select(
            F.col("event_id").alias("frame_id"), (F.col("user_id") % 10).alias("session_id"), "user_id",
            self._ns("ts").alias("t_ns"), (F.col("value") * 4).alias("x"), (F.lit(20.0) * k).alias("y"),
            F.lit(0.0).alias("z"), heading.alias("heading_deg"), side.alias("camera_side"),
            F.col("event_type").alias("source"), "value",
        )

    def properties(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("uprn"), ((F.col("c_custkey") * 7919) % 2000).cast("double").alias("x"),
            ((F.col("c_custkey") * 104729) % 2000).cast("double").alias("y"),
            F.col("c_name").alias("address"), F.col("c_mktsegment").alias("building_use"),
        )

    def odometry(self) -> DataFrame:
        h = F.radians("heading_deg") / 2
        zero = F.lit(0.0)
        return self.frames().select(
            "frame_id", "session_id", "user_id", "source", "t_ns", "x", "y", "z",
            zero.alias("qx"), zero.alias("qy"), F.sin(h).alias("qz"), F.cos(h).alias("qw"),
            (F.col("value") / 10).alias("vx"), zero.alias("vy"), zero.alias("vz"),
            zero.alias("wx"), zero.alias("wy"), (F.col("value") / 1000).alias("wz"), "heading_deg",
        )

    def fixes(self) -> DataFrame:
        var = F.col("value") / 5000
        zero = F.lit(0.0)
        return self.frames().select(
            "frame_id", "session_id", "user_id", "t_ns", "x", "y",
            (F.lit(51.5) + F.col("x") / 111000).alias("lat"), (F.lit(-1.25) + F.col("y") / 111000).alias("lon"),
            (F.col("frame_id") % 4 - 1).cast("int").alias("status"),
            F.array(var, zero, zero, zero, var, zero, zero, zero, zero).alias("covariance"),
        )

    def imu(self) -> DataFrame:
        return self.raw("lineitem").select(
            (F.col("l_orderkey") % 50).alias("shard"), self._ns("l_shipdate").alias("t_ns"),
            (F.col("l_discount") * 10).alias("ax"), (F.col("l_tax") * 10).alias("ay"),
            (F.lit(9.8066) + (F.col("l_quantity") - 25) / 25).alias("az"),
            F.col("l_tax").alias("gx"), F.col("l_tax").alias("gy"), F.col("l_tax").alias("gz"),
        )

    def points(self, lineitem: DataFrame | None = None) -> DataFrame:
        pid = ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")) * 10000
        return (self.raw("lineitem") if lineitem is None else lineitem).select(
            (pid + F.col("l_suppkey")).alias("point_id"), (F.col("l_suppkey") % 7).alias("session_id"),
            F.col("l_suppkey").alias("scan_id"), F.col("l_orderkey").alias("cloud_id"),
            F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"),
            (F.col("l_discount") * 100).alias("z"), (F.col("l_tax") * 100).alias("intensity"),
            F.col("l_linenumber").alias("ring"), self._ns("l_shipdate").alias("t_ns"),
        )

    def pixels(self) -> DataFrame:
        return self.raw("embeddings").select(
            F.col("vec_id").alias("frame_id"), F.col("label").alias("camera"),
            F.posexplode("embedding").alias("i", "v"),
        ).select(
            "frame_id", "camera", F.floor(F.col("i") / 8).cast("int").alias("row"), (F.col("i") % 8).alias("col"),
            F.floor((F.col("v").cast("double") + 1) * 10000).cast("int").alias("raw"),
        )

    def shards(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("shard"), (F.col("o_custkey") % 10).alias("session_id"),
            F.col("o_orderkey").alias("idx"), F.col("o_orderstatus").alias("topic"),
            F.col("o_orderpriority").alias("class"), self._ns("o_orderdate").alias("start_ns"),
            (self._ns("o_orderdate") + F.col("o_custkey") * HOUR).alias("end_ns"),
            F.floor("o_totalprice").alias("bytes"), (F.col("o_custkey") + 1).alias("count"),
        )

    def cards(self) -> DataFrame:
        rate = F.round(F.col("o_totalprice") / 5000, 2)
        speed = F.round(F.col("o_totalprice") / 12000, 2)
        verdict = (
            F.when(F.col("o_orderkey") % 5 == 0, "NO_EXPORT").when(speed > 30, "FAIL")
            .when((speed > 15) | (rate < 5), "WARN").otherwise("PASS")
        )
        return self.raw("orders").select(
            F.col("o_orderkey").alias("card_id"), F.col("o_orderstatus").alias("engine"),
            (F.col("o_custkey") % 7).cast("string").alias("tag"), F.col("o_orderpriority").alias("class"),
            verdict.alias("verdict"), rate.alias("pose_rate_hz"), speed.alias("p99_speed_mps"),
            F.round(F.col("o_totalprice") / 100, 2).alias("cumul_distance_m"),
        )


FRAMES = """frames AS (
  SELECT event_id AS frame_id, user_id % 10 AS session_id, user_id, epoch_us(ts) * 1000 AS t_ns, value * 4 AS x,
    CAST(20 AS DOUBLE) * CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS y, CAST(0 AS DOUBLE) AS z,
    CAST((event_id * 37) % 360 AS DOUBLE) AS heading_deg,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'left' WHEN event_type IN ('view', 'signup') THEN 'right'
      ELSE 'rear' END AS camera_side, event_type AS source, value
  FROM events)"""
PROPS = """props AS (
  SELECT c_custkey AS uprn, CAST((c_custkey * 7919) % 2000 AS DOUBLE) AS x,
    CAST((c_custkey * 104729) % 2000 AS DOUBLE) AS y, c_name AS address, c_mktsegment AS building_use FROM customer)"""
ODOM = """odom AS (
  SELECT frame_id, session_id, user_id, source, t_ns, x, y, z, CAST(0 AS DOUBLE) AS qx, CAST(0 AS DOUBLE) AS qy,
    sin(radians(heading_deg) / 2) AS qz, cos(radians(heading_deg) / 2) AS qw, value / 10 AS vx,
    value / 1000 AS wz, heading_deg FROM frames)"""
FIXES = """fixes AS (
  SELECT frame_id, session_id, user_id, t_ns, x, y, 51.5::DOUBLE + x / 111000 AS lat, -1.25::DOUBLE + y / 111000 AS lon,
    CAST(frame_id % 4 - 1 AS INTEGER) AS status, value / 5000 AS var FROM frames)"""
IMU = """imu AS (
  SELECT l_orderkey % 50 AS shard, epoch_us(l_shipdate) * 1000 AS t_ns, l_discount * 10 AS ax, l_tax * 10 AS ay,
    9.8066::DOUBLE + (l_quantity - 25) / 25 AS az, l_tax AS gx, l_tax AS gy, l_tax AS gz FROM lineitem)"""
POINTS = """points AS (
  SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS point_id,
    l_suppkey % 7 AS session_id, l_suppkey AS scan_id, l_orderkey AS cloud_id, l_quantity AS x,
    l_extendedprice / 1000 AS y, l_discount * 100 AS z, l_tax * 100 AS intensity, l_linenumber AS ring,
    epoch_us(l_shipdate) * 1000 AS t_ns FROM lineitem)"""
PIXELS = """pixels AS (
  SELECT frame_id, camera, CAST(i // 8 AS INTEGER) AS "row", CAST(i % 8 AS INTEGER) AS col,
    CAST(floor((CAST(v AS DOUBLE) + 1) * 10000) AS INTEGER) AS raw
  FROM (SELECT vec_id AS frame_id, label AS camera, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i
        FROM embeddings))"""
SHARDS = f"""shards AS (
  SELECT o_orderkey AS shard, o_custkey % 10 AS session_id, o_orderkey AS idx, o_orderstatus AS topic,
    o_orderpriority AS class, epoch_us(o_orderdate) * 1000 AS start_ns,
    epoch_us(o_orderdate) * 1000 + o_custkey * {HOUR} AS end_ns, CAST(floor(o_totalprice) AS BIGINT) AS bytes,
    o_custkey + 1 AS count FROM orders)"""
CARDS = """cards AS (
  SELECT o_orderkey AS card_id, o_orderstatus AS engine, CAST(o_custkey % 7 AS VARCHAR) AS tag, o_orderpriority AS class,
    CASE WHEN o_orderkey % 5 = 0 THEN 'NO_EXPORT' WHEN round(o_totalprice / 12000, 2) > 30 THEN 'FAIL'
      WHEN round(o_totalprice / 12000, 2) > 15 OR round(o_totalprice / 5000, 2) < 5 THEN 'WARN' ELSE 'PASS' END AS verdict,
    round(o_totalprice / 5000, 2) AS pose_rate_hz, round(o_totalprice / 12000, 2) AS p99_speed_mps,
    round(o_totalprice / 100, 2) AS cumul_distance_m FROM orders)"""
CTES = {"frames": FRAMES, "props": PROPS, "odom": ODOM, "fixes": FIXES, "imu": IMU, "points": POINTS,
        "pixels": PIXELS, "shards": SHARDS, "cards": CARDS}
NEEDS = {"odom": ("frames",), "fixes": ("frames",)}


def with_tables(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause with the named tables; the caller appends more CTEs or the SELECT."""
    wanted: list[str] = []
    for name in names:
        for need in (*NEEDS.get(name, ()), name):
            if need not in wanted:
                wanted.append(need)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(CTES[n] for n in wanted) + "\n"
