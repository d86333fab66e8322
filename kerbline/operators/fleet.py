"""Recording shards, retention, alerts and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.operators.ordered import PART_ROWS, running_sum
from kerbline.operators.windows import top_k
from kerbline.session import settle

NS = 1_000_000_000
# Log patterns that are noise, and patterns that make a line an error.
LOG_NOISE = (
    r"(?i)type hash|USER_DATA|sequence size|Failed to parse|Could not set gain|enumentr|"
    r"error_handling\.c|rcutils_reset_error|This error state is being overwritten|"
    r"with this new error message|drop\s+0%|Failed to load schemaDefinition for topic \"/rtcm\""
)
LOG_ERRORS = r"(?i)error|fatal|\bfail|drop\s+[1-9]|incomplete|disconnect|\btimeout|segfault|abort"
# File ending -> (path template part, content type).
ASSET_KINDS = (
    (".meta.json", "meta", True, "application/json"),
    (".jpg", "images", True, "image/jpeg"),
    (".npy", "raw_npy", False, "application/octet-stream"),
)


def shard_index(messages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per shard and topic the number of messages, first and last time and bytes."""
    return messages.groupBy(*(by or []), "shard", "topic").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("log_time_ns").alias("start_ns"),
        F.max("log_time_ns").alias("end_ns"),
        F.sum(F.length("payload")).cast("long").alias("bytes"),
    )


def recording_metadata(shards: DataFrame, session: str = "session_id") -> DataFrame:
    """S3: totals per recording with its topic list; the topics are a short configured set."""
    per_topic = shards.groupBy(session, "topic").agg(
        F.sum("count").alias("n"), F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns"),
    )
    topics = F.array_sort(F.collect_list(F.struct("topic", "n")))
    totals = per_topic.groupBy(session).agg(
        F.sum("n").alias("message_count"), F.min("start_ns").alias("start_ns"),
        F.max("end_ns").alias("end_ns"), topics.alias("topics"),
    )
    files = shards.select(session, "shard").distinct().groupBy(session).agg(F.count(F.lit(1)).alias("shard_count"))
    return totals.join(files, session).withColumn("duration_ns", F.col("end_ns") - F.col("start_ns"))


def overlapping_shards(shards: DataFrame, t0: int, t1: int) -> DataFrame:
    """Shards that touch a time range; shards without a known range stay."""
    unknown = F.col("start_ns").isNull() | F.col("end_ns").isNull()
    return shards.filter(unknown | ((F.col("end_ns") >= t0) & (F.col("start_ns") <= t1)))


def shard_number(name: str) -> Column:
    """O1: the numeric suffix of a shard file name, for natural order."""
    return F.regexp_extract(name, r"_(\d+)\.mcap$", 1).try_cast("int")


def shard_order(df: DataFrame, name: str = "shard") -> DataFrame:
    return df.withColumn("shard_no", F.coalesce(shard_number(name), F.lit(0))).orderBy("shard_no", name)


def first_n(df: DataFrame, n: int, name: str = "shard") -> DataFrame:
    """The first ``n`` shards in natural order."""
    return shard_order(df, name).limit(n)


def latest_complete(shards: DataFrame, by: list[str], order: str) -> DataFrame:
    """The second newest shard, because the newest may still be written."""
    return top_k(shards, by, [F.desc(order)], 2).filter(F.col("rank") == 2).drop("rank")


def retention_plan(files: DataFrame, cap_bytes: int, by: list[str], order: list[str],
                   size: str = "bytes", part_rows: int = PART_ROWS) -> DataFrame:
    """The oldest files to delete so that the rest fits the cap; never the newest.

    A file goes while the total that remains, itself included, is over the cap. Nothing is
    deleted here.
    """
    rows = running_sum(files, by, order, {"__upto": F.col(size), "__k": F.lit(1)}, part_rows)
    totals = files.groupBy(*by).agg(F.sum(size).alias("__total"), F.count(F.lit(1)).alias("__n"))
    rows = rows.join(totals, by)
    rest = F.col("__total") - F.col("__upto") + F.col(size)
    victim = (rest > cap_bytes) & (F.col("__k") < F.col("__n"))
    return rows.select(*files.columns, rest.alias("bytes_from_here"), victim.alias("is_victim"))


def sealed_shards(shards: DataFrame, by: list[str], idx: str = "idx", idle_s: int = 60,
                  now_s: str = "now_s", modified_s: str = "modified_s",
                  recorder_alive: str = "recorder_alive") -> DataFrame:
    """Shards that are safe to move: not the last one, or idle after the recorder ended."""
    last = shards.groupBy(*by).agg(F.max(idx).alias("__last"))
    idle = ~F.col(recorder_alive) & (F.col(now_s) - F.col(modified_s) >= idle_s)
    return shards.join(last, by).filter((F.col(idx) < F.col("__last")) | idle).drop("__last")


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work that is not done yet."""
    return work.join(done.select(*keys), keys, "left_anti")


def missing(expected: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """U4: expected keys that were not seen."""
    return expected.select(*keys).distinct().join(seen.select(*keys), keys, "left_anti")


def keep_set(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of the frames to keep."""
    return frames.select(*keys).distinct()


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Union by name, absent columns null."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def error_lines(logs: DataFrame, source: str, order: list[str], text: str = "line", per_source: int = 3) -> DataFrame:
    """The first error lines of each source without known noise."""
    hits = logs.filter(~F.col(text).rlike(LOG_NOISE) & F.col(text).rlike(LOG_ERRORS))
    return top_k(hits, [source], [F.asc(c) for c in order], per_source)


def object_keys(files: DataFrame, prefix: str = "bags", recording: str = "recording",
                side: str = "side", name: str = "file") -> DataFrame:
    """Object key and content type per file; other endings are left out."""
    key, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for ending, folder, with_side, content in reversed(ASSET_KINDS):
        parts = [F.lit(prefix), F.col(recording), F.lit(folder), *([F.col(side)] if with_side else []), F.col(name)]
        hit = F.col(name).endswith(ending)
        key = F.when(hit, F.concat_ws("/", *parts)).otherwise(key)
        kind = F.when(hit, F.lit(content)).otherwise(kind)
    return files.withColumn("object_key", key).withColumn("content_type", kind).filter(F.col("object_key").isNotNull())


def rate_windows(df: DataFrame, by: list[str], width_s: int, time: str = "t_ns") -> DataFrame:
    """Messages per second in tumbling windows on event time; empty windows are absent."""
    start = F.col(time) - F.pmod(F.col(time), F.lit(width_s * NS))
    return df.groupBy(*by, start.alias("window_ns")).agg(
        (F.count(F.lit(1)) / F.lit(width_s)).alias("rate_hz")
    )


def rate_floor(df: DataFrame, by: list[str], floor_hz: float, sample_s: int = 5, window_s: int = 30,
               time: str = "t_ns", part_rows: int = PART_ROWS) -> DataFrame:
    """Spells in which the sampled rate stays below the floor for the whole window.

    A silent sample has no row and counts as below the floor, so a spell ends only at a
    sample that reaches the floor: low samples are numbered by the healthy samples before
    them.
    """
    rates = rate_windows(df, by, sample_s, time)
    low = F.col("rate_hz") < floor_hz
    marked = running_sum(settle(rates), by, ["window_ns"], {"__ok": F.when(low, 0).otherwise(1)}, part_rows)
    spells = marked.filter(low).groupBy(*by, "__ok").agg(
        F.min("window_ns").alias("start_ns"), F.max("window_ns").alias("__last"),
        F.min("rate_hz").alias("min_rate_hz"),
    )
    length = (F.col("__last") - F.col("start_ns")) / NS + sample_s
    return spells.withColumn("low_s", length).filter(F.col("low_s") >= window_s).drop("__ok", "__last")


def soak_alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Alerts of metric samples against rules.

    ``metrics`` has ``(t_ns, metric, source, value)``; ``rules`` is a short list of
    ``(metric, source, test, limit)`` where test is ``below``, ``above`` or ``abs_above`` and
    a null source stands for all. A rate rule of 80 % is a ``below`` limit of 0.8 x expected.
    """
    r = rules.withColumnsRenamed({"metric": "__m", "source": "__s"})
    on = (F.col("metric") == F.col("__m")) & (F.col("__s").isNull() | (F.col("source") == F.col("__s")))
    value, limit = F.col("value"), F.col("limit")
    hit = (
        F.when(F.col("test") == "below", value < limit)
        .when(F.col("test") == "above", value > limit)
        .otherwise(F.abs(value) > limit)
    )
    return metrics.join(r, on).filter(hit).select(*metrics.columns, "test", "limit")


def suppress_global(alerts: DataFrame, flowing: DataFrame, log_only: list[str], time: str = "t_ns",
                    window_ns: int = 60 * NS, key: str = "key") -> DataFrame:
    """What to do with each alert: ``act``, ``log_only`` or ``suppressed``.

    ``flowing`` has one row per sample with ``is_flowing``; when nothing flows in a window
    the whole stack is silent and single alerts are held back.
    """
    def window(df: DataFrame) -> DataFrame:
        return df.withColumn("__w", F.col(time) - F.pmod(F.col(time), F.lit(window_ns)))

    state = window(flowing).groupBy("__w").agg(F.bool_or("is_flowing").alias("__any"))
    rows = window(alerts).join(state, "__w", "left")
    action = (
        F.when(~F.coalesce(F.col("__any"), F.lit(False)), "suppressed")
        .when(F.col(key).isin(log_only), "log_only")
        .otherwise("act")
    )
    return rows.select(*alerts.columns, action.alias("action"))


def merge_progress(current: DataFrame, batch: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest row per key of the stored table and a batch."""
    both = current.unionByName(batch, allowMissingColumns=True)
    rank = Window.partitionBy(*keys).orderBy(F.desc(version))
    return both.withColumn("__rn", F.row_number().over(rank)).filter("__rn = 1").drop("__rn")
