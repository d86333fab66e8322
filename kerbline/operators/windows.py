"""Step, gap, run and rotation columns of a track."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.functions.geo import distance3
from kerbline.functions.pose import rotation_angle
from kerbline.operators.ordered import (
    KEY, PART_ROWS, cut, last_known, neighbour, rolling_sum, row_index, running_max_before, running_sum, scan,
)
from kerbline.session import settle

NS = 1_000_000_000


def _steps(order: list[str], rotation: bool = False) -> tuple[dict[str, Column], dict[str, Column]]:
    """What a step needs of the previous row, and the columns of the step."""
    names = [order[0], "x", "y", "z"] + (["qx", "qy", "qz", "qw"] if rotation else [])
    dt = (F.col(order[0]) - F.col(f"__p_{order[0]}")) / NS
    live = dt > 0
    step = distance3("__p_x", "__p_y", "__p_z", "x", "y", "z")
    out = {"dt_s": F.when(live, dt), "step_m": F.when(live, step), "speed_mps": F.when(live, step / dt)}
    if rotation:
        out["rot_rad"] = F.when(live, rotation_angle([f"__p_q{a}" for a in "xyzw"], [f"q{a}" for a in "xyzw"]))
    return {f"__p_{n}": F.col(n) for n in names}, out


def step_deltas(poses: DataFrame, by: list[str], order: list[str], rotation: bool = False,
                part_rows: int = PART_ROWS) -> DataFrame:
    """``dt_s``, ``step_m``, ``speed_mps`` and ``rot_rad`` against the previous row.

    All are null on the first row and where time does not advance.
    """
    before, steps = _steps(order, rotation)
    return scan(poses, by, order, prev=before, derive=steps, part_rows=part_rows).drop(*before)


def cumulative_distance(poses: DataFrame, by: list[str], order: list[str],
                        part_rows: int = PART_ROWS) -> DataFrame:
    """Distance travelled up to each row."""
    before, steps = _steps(order)
    walked = scan(poses, by, order, prev=before, derive={"__m": F.coalesce(steps["step_m"], F.lit(0.0))},
                  sums={"cum_m": F.col("__m")}, part_rows=part_rows)
    return walked.select(*poses.columns, "cum_m")


def mark_sessions(df: DataFrame, by: list[str], order: list[str], gap_ns: int,
                  end_col: str | None = None, name: str = "session_no",
                  part_rows: int = PART_ROWS) -> DataFrame:
    """Number the sessions of a key; a new one starts after a gap over ``gap_ns``.

    With ``end_col`` the gap is measured from the latest end so far instead of the previous
    start.
    """
    fresh = F.when(F.col(order[0]) - F.col("__prev") > gap_ns, 1).otherwise(0)
    if end_col:
        rows = running_max_before(cut(df, by, order, part_rows), by, order, {"__prev": F.col(end_col)})
        numbered = running_sum(rows, by, order, {name: fresh})
    else:
        numbered = scan(df, by, order, prev={"__prev": F.col(order[0])}, sums={name: fresh}, part_rows=part_rows)
    return numbered.select(*df.columns, F.col(name).cast("long").alias(name))


def sessionize(df: DataFrame, by: list[str], order: list[str], gap_ns: int,
               end_col: str | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per session with start, end and row count."""
    marked = mark_sessions(df, by, order, gap_ns, end_col, part_rows=part_rows)
    return marked.groupBy(*by, "session_no").agg(
        F.min(order[0]).alias("start_ns"),
        F.max(end_col or order[0]).alias("end_ns"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def session_windows(df: DataFrame, by: list[str], event_time: str, gap_s: int,
                    part_rows: int = PART_ROWS) -> DataFrame:
    """W4 on a TIMESTAMP column: sessions end ``gap_s`` after their last row.

    A stream uses Spark's own session window. A table goes through the form in parts, which
    gives the same sessions without sorting a whole key in one task.
    """
    if df.isStreaming:
        windows = df.groupBy(*by, F.session_window(event_time, f"{gap_s} seconds").alias("w"))
        return windows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            *by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_rows"
        )
    micros = 1_000_000
    rows = df.select(*by, F.unix_micros(event_time).alias("t_us"))
    found = sessionize(rows, by, ["t_us"], gap_s * micros - 1, part_rows=part_rows)
    return found.select(
        *by, F.timestamp_micros("start_ns").alias("start"),
        F.timestamp_micros(F.col("end_ns") + gap_s * micros).alias("end"), "n_rows",
    )


def class_runs(df: DataFrame, by: list[str], order: list[str], label: str, min_rows: int = 1,
               part_rows: int = PART_ROWS) -> DataFrame:
    """Maximal runs of one label: first and last order value, length."""
    change = F.when(F.col(label).eqNullSafe(F.col("__prev")), 0).otherwise(1)
    runs = scan(df, by, order, prev={"__prev": F.col(label)}, sums={"run_no": change}, part_rows=part_rows)
    return (
        runs.groupBy(*by, F.col("run_no").cast("long").alias("run_no"), label)
        .agg(F.min(order[0]).alias("start"), F.max(order[0]).alias("end"),
             F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") >= min_rows)
    )


def segment_tags(runs: DataFrame, label: str) -> DataFrame:
    """Tag of a motion segment: ``<class>_<start>_<end>`` with three-digit indices."""
    tag = F.format_string("%s_%03d_%03d", F.lower(label), F.col("start"), F.col("end"))
    return runs.withColumn("tag", tag)


def index_ranges(df: DataFrame, by: list[str], idx: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Ranges of consecutive distinct index values."""
    unique = settle(df.select(*by, idx).distinct())
    placed = row_index(unique, by, [idx], "__pos", part_rows)
    return (
        placed.groupBy(*by, (F.col(idx) - F.col("__pos")).alias("__run"))
        .agg(F.min(idx).alias("start"), F.max(idx).alias("end"), F.count(F.lit(1)).alias("n"))
        .drop("__run")
    )


def dedup_consecutive(df: DataFrame, by: list[str], order: list[str], cols: list[str],
                      part_rows: int = PART_ROWS) -> DataFrame:
    """Drop a row whose ``cols`` equal those of the previous row."""
    before = {f"__p_{c}": F.col(c) for c in cols}
    rows = scan(df, by, order, prev={**before, "__was": F.lit(True)}, part_rows=part_rows)
    same = F.col("__was").isNotNull()
    for c in cols:
        same = same & F.col(f"__p_{c}").eqNullSafe(F.col(c))
    return rows.filter(~same).select(*df.columns)


def dedup_by_time(df: DataFrame, by: list[str], time: str, tie: str) -> DataFrame:
    """One row per key and time, the one with the lowest ``tie``."""
    rank = Window.partitionBy(*by, time).orderBy(tie)
    return df.withColumn("__rn", F.row_number().over(rank)).filter("__rn = 1").drop("__rn")


def rolling_circular(df: DataFrame, by: list[str], order: list[str], angle_deg: str, n: int = 20,
                     part_rows: int = PART_ROWS) -> DataFrame:
    """Circular mean and deviation of the last ``n`` rows."""
    rad = F.radians(angle_deg)
    rows = rolling_sum(df, by, order, {"__s": F.sin(rad), "__c": F.cos(rad), "__k": F.lit(1.0)}, n, part_rows)
    size = F.col("__k").cast("long")
    mean, std = circular_from_means(F.col("__s") / size, F.col("__c") / size)
    return rows.select(*df.columns, size.alias("n_used"), mean.alias("mean_deg"), std.alias("std_deg"))


def circular_from_means(mean_sin: Column, mean_cos: Column) -> tuple[Column, Column]:
    """Circular mean in [0, 360) and Mardia's deviation, both in degrees."""
    mean = F.pmod(F.degrees(F.atan2(mean_sin, mean_cos)), F.lit(360.0))
    length = F.sqrt(mean_sin * mean_sin + mean_cos * mean_cos)
    std = F.when(length >= 1, F.lit(0.0)).otherwise(F.degrees(F.sqrt(-2.0 * F.log(length))))
    return mean, std


def frame_resets(poses: DataFrame, by: list[str], order: list[str], jump_m: float,
                 part_rows: int = PART_ROWS) -> DataFrame:
    """``epoch`` counts the jumps of more than ``jump_m`` so far; ``is_reset`` marks them."""
    rows = scan(poses, by, order, **_resets(jump_m), part_rows=part_rows)
    return rows.select(*poses.columns, "is_reset", F.col("epoch").cast("long").alias("epoch"))


def _resets(jump_m: float) -> dict:
    jump = F.coalesce(distance3("__p_x", "__p_y", "__p_z", "x", "y", "z") > jump_m, F.lit(False))
    return {"prev": {f"__p_{n}": F.col(n) for n in "xyz"}, "derive": {"is_reset": jump}, "sums": {"epoch": F.col("is_reset").cast("int")}}


def session_epochs(poses: DataFrame, by: list[str], order: list[str], jump_m: float,
                   settle_ns: int, save_every: int, max_rows: int,
                   part_rows: int = PART_ROWS) -> DataFrame:
    """Epochs split at jumps, rows inside the settle time after a jump dropped.

    ``block`` counts the saves within an epoch and ``part`` the forced restarts after
    ``max_rows`` kept rows.
    """
    rows = cut(poses, by, order, part_rows)
    marked = scan(rows, by, order, **_resets(jump_m), last={"__began": F.when(F.col("is_reset"), F.col(order[0]))})
    marked = marked.withColumn("epoch", F.col("epoch").cast("long"))
    kept = marked.filter((F.col("epoch") == 0) | (F.col(order[0]) - F.col("__began") >= settle_ns))
    placed = row_index(kept.select(*poses.columns, KEY, "epoch"), [*by, "epoch"], order, "__pos")
    part = F.floor(F.col("__pos") / max_rows)
    block = F.floor((F.col("__pos") - part * max_rows) / save_every)
    return placed.select(*poses.columns, "epoch", part.alias("part"), block.alias("block"))


def segment_by_growth(df: DataFrame, by: list[str], order: list[str], size_col: str, limit: int,
                      part_rows: int = PART_ROWS) -> DataFrame:
    """Segment number that steps up each time ``limit`` new points have arrived."""
    rows = running_sum(df, by, order, {"__cum": F.col(size_col)}, part_rows)
    return rows.select(*df.columns, F.floor(F.col("__cum") / limit).alias("segment_no"))


def gap_alerts(df: DataFrame, by: list[str], order: list[str], gap_ns: int,
               part_rows: int = PART_ROWS) -> DataFrame:
    """Rows that follow a gap over ``gap_ns``, with the gap in seconds."""
    rows = neighbour(df, by, order, {"__prev": F.col(order[0])}, part_rows)
    gap = F.abs(F.col(order[0]) - F.col("__prev"))
    return rows.filter(gap > gap_ns).select(*df.columns, (gap / NS).alias("gap_s"))


def growth_rate(samples: DataFrame, by: list[str], order: list[str], size_col: str,
                part_rows: int = PART_ROWS) -> DataFrame:
    """Change of a size per second against the previous sample."""
    rows = neighbour(samples, by, order,
                     {"__pt": F.col(order[0]), "__ps": F.col(size_col)}, part_rows)
    dt = (F.col(order[0]) - F.col("__pt")) / NS
    rate = F.when(dt > 0, (F.col(size_col) - F.col("__ps")) / dt)
    return rows.select(*samples.columns, rate.alias("rate_per_s"))


def decimate_bursts(poses: DataFrame, by: list[str], order: list[str], min_dt_ns: int,
                    part_rows: int = PART_ROWS) -> DataFrame:
    """In a burst of rows closer than ``min_dt_ns`` keep only the latest.

    A row that arrives inside the window replaces the row kept last, so the kept row is
    always the previous one: a row stays exactly when its successor is far enough away.
    """
    rows = neighbour(poses, by, order, {"__next": F.col(order[0])}, part_rows, step=1)
    far = F.col("__next").isNull() | (F.col("__next") - F.col(order[0]) >= min_dt_ns)
    return rows.filter(far).select(*poses.columns)


def offset_guard(df: DataFrame, by: list[str], order: list[str], raw: str, min_increment_ns: int, jump_ns: int,
                 part_rows: int = PART_ROWS) -> DataFrame:
    """T2 on a table: stamps that go back or jump shift all later ones; a jump starts an epoch.

    The output runs ahead of the last one by the same offset as the input, so whether a stamp
    goes back depends on the stamp before it alone, and the offset is a running sum.
    """
    before = F.col("__prev")
    jump = F.coalesce(F.abs(F.col(raw) - before) > jump_ns, F.lit(False))
    back = F.coalesce(F.col(raw) <= before, F.lit(False))
    shift = F.when(F.col("__jump") | F.col("__back"), before + min_increment_ns - F.col(raw)).otherwise(0)
    rows = scan(df, by, order, prev={"__prev": F.col(raw)}, derive={"__jump": jump, "__back": back},
                sums={"offset_ns": shift, "epoch": F.col("__jump").cast("int")}, part_rows=part_rows)
    return rows.select(
        *df.columns, (F.col(raw) + F.col("offset_ns")).alias("out_ns"), (F.col("__back") & ~F.col("__jump")).alias("corrected"),
        "offset_ns", F.col("epoch").cast("long").alias("epoch"),
    )


def hold_last(df: DataFrame, by: list[str], order: list[str], columns: dict[str, str],
              part_rows: int = PART_ROWS) -> DataFrame:
    """T20 on a table: the latest row of values where a row has none; nothing before the first.

    ``columns`` maps value columns to the names of the held ones. A row is ``fresh`` when its
    first value is present; the other values are then taken from it, null or not.
    """
    first = F.col(next(iter(columns)))
    fresh = F.when(first.isNotNull(), F.struct(*columns))
    held = last_known(df, by, order, {"__held": fresh}, part_rows).where(F.col("__held").isNotNull())
    return held.select(*df.columns, *[F.col("__held")[c].alias(n) for c, n in columns.items()], first.isNotNull().alias("fresh"))


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """O2: best ``k`` rows per key; Spark cuts each task to ``k`` before the shuffle."""
    rank = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)


def _ranks(column: pa.Array) -> list[np.ndarray]:
    """Arrays that order a column as Spark does when compared one after the other: nulls first, NaN last."""
    if pa.types.is_floating(column.type):
        there = column.is_valid().to_numpy(zero_copy_only=False)
        values = column.fill_null(0.0).to_numpy(zero_copy_only=False)
        nan = np.isnan(values)
        return [*([there] if column.null_count else []), *([nan, np.where(nan, 0.0, values)] if nan.any() else [values])]
    if pa.types.is_integer(column.type) and not column.null_count:
        return [column.to_numpy(zero_copy_only=False)]
    return [pc.rank(column, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy()]


def group_codes(columns: list[pa.Array]) -> tuple[np.ndarray, int]:
    """A number from 0 for every row, the same for rows with equal columns, and how many there are."""
    code, size = np.zeros(len(columns[0]), np.int64), 1
    for column in columns:
        held = column.dictionary_encode(null_encoding="encode")
        code = code * len(held.dictionary) + held.indices.to_numpy()
        code, size = (code, len(held.dictionary)) if size == 1 else _dense(code)
    return code, size


def _dense(code: np.ndarray) -> tuple[np.ndarray, int]:
    held, back = np.unique(code, return_inverse=True)
    return back, len(held)


def thinned(df: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The rows that are among the first ``k`` of their key in the Arrow batch they come in.

    Rows that cannot be among the first ``k`` of all are gone before a shuffle or a sort
    sees them, so a top-k after it gives what it gives without, but takes little disk where the
    rows of a key come together, as they do after a merge join.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, size = group_codes([batch.column(c) for c in by])
            if size * k < batch.num_rows:
                keys = [x for c in order for x in _ranks(batch.column(c))]
                rows = np.lexsort((*keys[::-1], code))
                counts = np.bincount(code, minlength=size)
                place = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
                batch = batch.take(pa.array(rows[place < k]))
            yield batch

    return df.mapInArrow(run, df.schema)


def best_and_counts(df: DataFrame, by: list[str], order: list[str], kept: list[str], flag: str) -> DataFrame:
    """Per key and Arrow batch: the first row in ``order``, how many rows there are and in how many ``flag`` holds.

    The counts are ``__n`` and ``__flagged``; added up over the batches they are those of the key.
    """
    asked = df.select(*dict.fromkeys([*by, *order, *kept, flag]))
    names = list(dict.fromkeys([*by, *order, *kept]))
    schema = T.StructType([asked.schema[c] for c in names]).add("__n", "long", False).add("__flagged", "long", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, size = group_codes([batch.column(c) for c in by])
            rows = np.arange(batch.num_rows)
            for values in (x for c in order for x in _ranks(batch.column(c))):
                if len(rows) == size:
                    break
                mine, group = values[rows], code[rows]
                by_group = np.lexsort((mine, group))
                begin = np.append(True, np.diff(group[by_group]) != 0)
                least = mine[by_group][begin]  # every key has a row left, so this is by number
                rows = rows[mine == least[group]]
            first = np.unique(code[rows], return_index=True)[1]
            holds = batch.column(flag).fill_null(False).to_numpy(zero_copy_only=False)
            out = batch.select(names).take(pa.array(rows[first]))
            counts = [np.bincount(code, minlength=size), np.bincount(code[holds], minlength=size)]
            yield pa.RecordBatch.from_arrays([*out.columns, *[pa.array(c, pa.int64()) for c in counts]], names=schema.fieldNames())

    return asked.mapInArrow(run, schema)


def first_by(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key: the first in ``order``, then by the other columns, nulls first."""
    rest = [F.asc(c) for c in df.columns if c not in by]
    return top_k(df, by, [*order, *rest] or [F.asc(by[0])], 1).drop("rank")


def time_sorted(df: DataFrame, by: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """O3: rows in (key, time) order over range partitions, without a single sorting task."""
    spread = df.repartitionByRange(*([partitions] if partitions else []), *by, *order)
    return spread.sortWithinPartitions(*by, *order)
