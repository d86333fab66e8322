"""Thermal frames, detections and coverage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Detector class numbers.
PERSON_CLASS = 0
VEHICLE_CLASSES = (2, 5, 7)
MODEL_SIZE = 640.0


def _trunc(value: Column) -> Column:
    """Toward zero, as an integer cast does."""
    return value.cast("int")


def decode_boxes(det: DataFrame, threshold: float, width: float, height: float, n_scores: int) -> DataFrame:
    """Centre boxes over the threshold as clamped corner boxes in picture pixels."""
    best = F.array_max(F.slice("scores", 1, n_scores))
    label = F.array_position(F.slice("scores", 1, n_scores), best) - 1
    rows = det.withColumn("score", best).withColumn("class_id", label).filter(F.col("score") > threshold)
    sx, sy = width / MODEL_SIZE, height / MODEL_SIZE
    cx, cy, w, h = (F.col(c) for c in ("cx", "cy", "w", "h"))
    box = {
        "x1": F.greatest(F.lit(0), _trunc((cx - w / 2) * sx)),
        "y1": F.greatest(F.lit(0), _trunc((cy - h / 2) * sy)),
        "x2": F.least(F.lit(int(width)), _trunc((cx + w / 2) * sx)),
        "y2": F.least(F.lit(int(height)), _trunc((cy + h / 2) * sy)),
    }
    kept = [c for c in det.columns if c not in ("cx", "cy", "w", "h", "scores")]
    out = rows.select(*kept, "class_id", "score", *[c.alias(n) for n, c in box.items()])
    return out.filter((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))


def redaction_boxes(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """Head area of persons (top 35 % plus 10 px) and plate area of vehicles."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    w, h = x2 - x1, y2 - y1
    person = F.col("class_id") == PERSON_CLASS
    vehicle = F.col("class_id").isin(*VEHICLE_CLASSES)
    px1 = F.greatest(F.lit(0), x1 + _trunc(w * 0.2))
    mask = {
        "mx1": F.when(person, F.greatest(F.lit(0), x1 - 10)).otherwise(px1),
        "my1": F.when(person, F.greatest(F.lit(0), y1 - 10)).otherwise(
            F.greatest(F.lit(0), y2 - _trunc(h * 0.25))),
        "mx2": F.when(person, F.least(F.lit(width), x2 + 10)).otherwise(
            F.least(F.lit(width), px1 + _trunc(w * 0.6))),
        "my2": F.when(person, F.least(F.lit(height), y1 + _trunc(h * 0.35) + 10)).otherwise(
            F.least(F.lit(height), y2)),
    }
    rows = boxes.filter(person | vehicle)
    kept = [c for c in boxes.columns if c not in ("x1", "y1", "x2", "y2", "score")]
    out = rows.select(*kept, *[c.alias(n) for n, c in mask.items()])
    return out.filter((F.col("mx2") > F.col("mx1")) & (F.col("my2") > F.col("my1")))


def calib_frame_gate(points: DataFrame, frame: list[str], spacing: float, min_points: int = 12,
                     min_cells: float = 3.5, min_pixels: float = 80.0) -> DataFrame:
    """Frames with enough target points, target span and picture span."""
    def span(c: str) -> Column:
        return F.max(c) - F.min(c)

    out = points.groupBy(*frame).agg(
        F.count(F.lit(1)).alias("n_points"), span("grid_x").alias("grid_x_span"),
        span("grid_y").alias("grid_y_span"), span("u").alias("u_span"), span("v").alias("v_span"),
    )
    reason = (
        F.when(F.col("n_points") < min_points, "points")
        .when(F.least("grid_x_span", "grid_y_span") < min_cells * spacing, "grid")
        .when(F.least("u_span", "v_span") < min_pixels, "pixels")
    )
    return out.withColumn("dropped_for", reason).withColumn("accepted", reason.isNull())


def sobel(pixels: DataFrame, frame: list[str], value: str) -> DataFrame:
    """3x3 gradients ``gx`` and ``gy``; the border mirrors without repeating the edge.

    The windows run inside one picture row or column, so their size is bounded by the
    sensor. One shuffle by frame serves both.
    """
    rows = pixels.repartition(*frame)
    line = Window.partitionBy(*frame, "row").orderBy("col")
    down = Window.partitionBy(*frame, "col").orderBy("row")

    def pair(c: Column, w) -> tuple[Column, Column]:
        before, after = F.lag(c).over(w), F.lead(c).over(w)
        return F.coalesce(before, after, c), F.coalesce(after, before, c)

    left, right = pair(F.col(value), line)
    rows = rows.withColumn("__d", right - left).withColumn("__s", left + 2 * F.col(value) + right)
    d_up, d_low = pair(F.col("__d"), down)
    s_up, s_low = pair(F.col("__s"), down)
    return rows.withColumn("gx", d_up + 2 * F.col("__d") + d_low).withColumn("gy", s_low - s_up).drop(
        "__d", "__s"
    )


def thermal_anomalies(pixels: DataFrame, frame: list[str], value: str, patch: int, k: float,
                      g: float, digits: int = 2) -> DataFrame:
    """Patches far from the frame mean or with a steep gradient, with a confidence.

    ``pixels`` has ``row, col`` and a temperature; patches that do not fit the picture whole
    are left out.
    """
    grad = sobel(pixels, frame, value)
    steep = F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))
    whole = grad.groupBy(*frame).agg(
        F.avg(value).alias("__mean"), F.greatest(F.stddev_pop(value), F.lit(0.01)).alias("__std"),
        F.max("row").alias("__rows"), F.max("col").alias("__cols"),
    )
    top = (F.col("row") - F.pmod(F.col("row"), F.lit(patch))).alias("y")
    side = (F.col("col") - F.pmod(F.col("col"), F.lit(patch))).alias("x")
    cells = grad.groupBy(*frame, top, side).agg(F.avg(value).alias("__pm"), F.max(steep).alias("__pg"))
    rows = cells.join(whole, frame).filter(
        (F.col("y") + patch <= F.col("__rows") + 1) & (F.col("x") + patch <= F.col("__cols") + 1)
    )
    delta = F.col("__pm") - F.col("__mean")
    odd = F.abs(delta) > k * F.col("__std")
    crack = F.col("__pg") > g
    kinds = F.array_compact(F.array(
        F.when(odd, F.struct(F.lit("thermal_anomaly").alias("class"),
                             F.least(F.abs(delta) / (F.col("__std") * 4.0), F.lit(1.0)).alias("c"))),
        F.when(crack, F.struct(F.lit("potential_crack").alias("class"),
                               F.least(F.col("__pg") / (g * 3.0), F.lit(1.0)).alias("c"))),
    ))
    out = rows.withColumn("__k", F.explode(kinds))
    return out.select(*frame, F.col("__k.class").alias("class"), F.round("__k.c", 3).alias("confidence"),
                      "x", "y", F.round(delta, digits).alias("temp_delta"))


def frame_temps(pixels: DataFrame, frame: list[str], value: str) -> DataFrame:
    """Lowest, mean and highest temperature per frame."""
    return pixels.groupBy(*frame).agg(
        F.round(F.min(value), 2).alias("min_temp_c"), F.round(F.avg(value), 2).alias("mean_temp_c"),
        F.round(F.max(value), 2).alias("max_temp_c"),
    )


def percentile_stretch(pixels: DataFrame, frame: list[str], value: str, lo: float = 0.01,
                       hi: float = 0.99, nonzero: bool = False, roi: float | None = None) -> DataFrame:
    """Grey value 0-255 between two percentiles of each frame.

    ``nonzero`` measures and shows only pixels above zero; ``roi`` measures the centre share
    of the picture. Raw counts have 16 bits, so
    the percentile buffer of a frame holds at most 65,536 distinct values.
    """
    basis = F.lit(True)
    rows = pixels
    if nonzero:
        basis = F.col(value) > 0
    if roi is not None:
        size = pixels.groupBy(*frame).agg(F.max("row").alias("__rows"), F.max("col").alias("__cols"))
        rows = pixels.join(size, frame)
        margin = (1 - roi) / 2
        for axis, top in (("row", "__rows"), ("col", "__cols")):
            n = F.col(top) + 1
            basis = basis & (F.col(axis) >= F.floor(n * margin)) & (F.col(axis) < n - F.floor(n * margin))
    kept = rows.filter(basis)
    ends = kept.groupBy(*frame).agg(
        F.percentile(value, F.lit(lo)).alias("__lo"), F.percentile(value, F.lit(hi)).alias("__hi")
    )
    joined = rows.join(ends, frame)
    share = (F.col(value) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * 255
    grey = F.when(F.col("__hi") > F.col("__lo"), F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(255.0))))
    if nonzero:
        grey = F.when(F.col(value) != 0, grey)
    return joined.select(*pixels.columns, F.coalesce(grey, F.lit(0)).cast("int").alias("grey"))


def mutual_information(pairs: DataFrame, by: list[str], a: str, b: str, bins: int = 32,
                       min_rows: int = 100) -> DataFrame:
    """Mutual information of two value columns from a joint histogram, in nats.

    After the first count the tables have at most ``bins`` squared rows per key.
    """
    limits = pairs.groupBy(*by).agg(F.min(a).alias("__la"), F.max(a).alias("__ha"),
                                    F.min(b).alias("__lb"), F.max(b).alias("__hb"))
    rows = pairs.join(limits, by) if by else pairs.crossJoin(F.broadcast(limits))

    def cell(v: str, lo: str, hi: str) -> Column:
        scaled = (F.col(v) - F.col(lo)) / F.greatest(F.col(hi) - F.col(lo), F.lit(1e-6)) * (bins - 1)
        return F.floor(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(float(bins - 1))))

    joint = rows.groupBy(*by, cell(a, "__la", "__ha").alias("__i"), cell(b, "__lb", "__hb").alias("__j")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    total = joint.groupBy(*by).agg(F.sum("__n").alias("n"))

    def entropy(counts: DataFrame, name: str) -> DataFrame:
        p = F.col("__n") / F.col("n")
        with_n = counts.join(total, by) if by else counts.crossJoin(F.broadcast(total))
        return with_n.groupBy(*by, "n").agg(F.sum(-p * F.log(p)).alias(name))

    def marginal(col: str) -> DataFrame:
        return joint.groupBy(*by, col).agg(F.sum("__n").alias("__n"))

    keys = [*by, "n"]
    out = entropy(joint, "h_joint").join(entropy(marginal("__i"), "h_a"), keys).join(
        entropy(marginal("__j"), "h_b"), keys
    )
    mi = F.when(F.col("n") >= min_rows, F.col("h_a") + F.col("h_b") - F.col("h_joint")).otherwise(F.lit(0.0))
    return out.withColumn("mi", mi)


def calibration_coverage(det: DataFrame, by: list[str], width: float, height: float, rows: int = 8,
                         cols: int = 10, tilt_bins: int = 5, roll_bins: int = 5, per_bin: int = 5,
                         min_grid_share: float = 0.7, min_dist: int = 3, min_tilt: int = 5,
                         min_roll: int = 5, min_frames: int = 80) -> DataFrame:
    """How well detected targets cover picture, distance, tilt and roll.

    ``det`` has one row per target: ``frame_id, x0, y0 .. x3, y3`` (corners in order). Only
    the largest target of a frame counts for the pose bins.
    """
    def side(i: int, j: int) -> Column:
        dx, dy = F.col(f"x{j}") - F.col(f"x{i}"), F.col(f"y{j}") - F.col(f"y{i}")
        return F.sqrt(dx * dx + dy * dy)

    cross = [F.col(f"x{i}") * F.col(f"y{(i + 1) % 4}") - F.col(f"x{(i + 1) % 4}") * F.col(f"y{i}") for i in range(4)]
    area = F.abs(cross[0] + cross[1] + cross[2] + cross[3]) / 2
    cx = (F.col("x0") + F.col("x1") + F.col("x2") + F.col("x3")) / 4
    cy = (F.col("y0") + F.col("y1") + F.col("y2") + F.col("y3")) / 4
    gc, gr = F.floor(cx / width * cols), F.floor(cy / height * rows)
    inside = gc.between(0, cols - 1) & gr.between(0, rows - 1)
    grid = det.filter(inside).select(*by, gc.alias("c"), gr.alias("r")).distinct().groupBy(*by).agg(
        F.count(F.lit(1)).alias("grid_hit")
    )
    share = (side(0, 1) + side(1, 2) + side(2, 3) + side(3, 0)) / 4 / (width**2 + height**2) ** 0.5
    d1, d2 = side(0, 2), side(1, 3)
    tilt = (1 - F.least(d1, d2) / F.greatest(d1, d2, F.lit(1e-6))) * 2 * tilt_bins
    angle = F.degrees(F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")))
    folded = F.pmod(angle + 90, F.lit(180.0)) - 90
    roll = (folded + 90) / 180 * roll_bins

    def clip(v: Column, n: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.floor(v), F.lit(n - 1)))

    body = F.struct(
        F.when(share < 0.035, 0).when(share < 0.07, 1).otherwise(2).alias("dist"),
        clip(tilt, tilt_bins).alias("tilt"), clip(roll, roll_bins).alias("roll"),
    )
    tie = [F.col(f"{a}{i}") for i in range(4) for a in "xy"]
    largest = det.groupBy(*by, "frame_id").agg(F.max_by(body, F.struct(area, *tie)).alias("s"))

    def filled(kind: str, n: int) -> Column:
        hits = [F.when(F.count_if(F.col(f"s.{kind}") == i) >= per_bin, 1).otherwise(0) for i in range(n)]
        return sum(hits[1:], hits[0])

    pose = largest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("frames_detected"), filled("dist", 3).alias("dist_hit"),
        filled("tilt", tilt_bins).alias("tilt_hit"), filled("roll", roll_bins).alias("roll_hit"),
    )
    out = pose.join(grid, by, "left") if by else pose.crossJoin(grid)
    out = out.withColumn("grid_hit", F.coalesce("grid_hit", F.lit(0).cast("long")))
    ready = (
        (F.col("grid_hit") / (rows * cols) >= min_grid_share) & (F.col("dist_hit") >= min_dist)
        & (F.col("tilt_hit") >= min_tilt) & (F.col("roll_hit") >= min_roll)
        & (F.col("frames_detected") >= min_frames)
    )
    return out.withColumn("ready", ready)


def with_calibration(frames: DataFrame, calibration: DataFrame, default_model: str = "pinhole") -> DataFrame:
    """Camera model of each frame; frames of an uncalibrated camera keep null values.

    One row per camera; the latest wins when ``calibration`` carries a ``calibrated_ns``.
    """
    rows = calibration
    if "calibrated_ns" in calibration.columns:
        body = F.struct(*[c for c in calibration.columns if c != "camera"])
        newest = calibration.groupBy("camera").agg(F.max_by(body, "calibrated_ns").alias("__c"))
        rows = newest.select("camera", "__c.*")
    model = F.coalesce("model", F.lit(default_model))
    return frames.join(rows.withColumn("model", model), "camera", "left")


def label_share(labels: DataFrame, frame: list[str], label: str) -> DataFrame:
    """Share of each class in each label picture."""
    counts = labels.groupBy(*frame, label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(*frame).agg(F.sum("n").alias("__t"))
    return counts.join(total, frame).select(*frame, label, "n", (F.col("n") / F.col("__t")).alias("share"))


def classify_scores(df: DataFrame, scores: str = "scores", threshold: float = 0.0) -> DataFrame:
    """Softmax confidence and class of a score array; ``alert`` for a sure class above 0."""
    top = F.array_max(scores)
    weights = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(weights, F.lit(0.0), lambda acc, s: acc + s)
    rows = df.withColumn("class_id", F.array_position(scores, top) - 1).withColumn("confidence", 1 / total)
    return rows.withColumn("alert", (F.col("class_id") > 0) & (F.col("confidence") > threshold))


def infer_frames(frames: DataFrame, model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
                 schema: str) -> DataFrame:
    """Run a caller-supplied model over frames, loaded once per task.

    ``model`` returns a function from an Arrow batch to result rows; no model is shipped.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = model()
        for batch in batches:
            yield predict(batch)

    return frames.mapInPandas(run, schema)
