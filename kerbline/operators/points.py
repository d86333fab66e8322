"""Point filters, voxel thinning, rasters and deskew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.camera import MIN_DEPTH_M, bend_fisheye, bend_pinhole, in_image
from kerbline.functions.labels import height_color, tile_of, voxel_of
from kerbline.functions.pose import apply_t, compose_t, extrinsic, pose_t
from kerbline.operators.ordered import PART_ROWS, match, row_index
from kerbline.operators.quantiles import exact_quantiles
from kerbline.operators.timejoin import interpolate_poses, nearest_asof
from kerbline.session import settle

VOXEL = ("ix", "iy", "iz")


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def valid_points(df: DataFrame, min_norm: float = 0.0) -> DataFrame:
    """Finite coordinates, farther from the sensor than ``min_norm``, never the origin."""
    n2 = F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z")
    return df.filter(_finite("x") & _finite("y") & _finite("z") & (n2 > min_norm * min_norm))


def range_filter(df: DataFrame, lo: float, hi: float, by: str = "norm") -> DataFrame:
    """Keep a range band in metres, by the stored range (``range_mm``) or the norm."""
    if by == "range":
        return df.filter((F.col("range_mm") / 1000).between(lo, hi))
    norm = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    return df.filter(norm.between(lo, hi))


def min_scan_size(df: DataFrame, scan: list[str], n: int) -> DataFrame:
    """Keep scans with at least ``n`` points, by a count per scan and a semi-join."""
    big = df.groupBy(*scan).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= n)
    return df.join(big.select(*scan), scan, "left_semi")


def _attach(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Join a per-group summary; without keys it is a single row."""
    return df.join(stats, by) if by else df.crossJoin(F.broadcast(stats))


def clip_to_median(df: DataFrame, metres: float, by: list[str] | None = None) -> DataFrame:
    """Drop points farther than ``metres`` from the median on any axis."""
    by = by or []
    out = df.filter(_finite("x") & _finite("y") & _finite("z"))
    kept = out
    for axis in "xyz":
        middle = exact_quantiles(out, by, F.col(axis), {f"__m{axis}": 0.5})
        kept = _attach(kept, middle, by).filter(F.abs(F.col(axis) - F.col(f"__m{axis}")) < metres)
    return kept.select(*df.columns)


def clip_to_centroid(df: DataFrame, scan: list[str], metres: float) -> DataFrame:
    """P5: keep points within ``metres`` of the centroid of their scan."""
    mid = df.groupBy(*scan).agg(*[F.avg(a).alias(f"__c{a}") for a in "xyz"])
    gap = sum(((F.col(a) - F.col(f"__c{a}")) * (F.col(a) - F.col(f"__c{a}")) for a in "yz"),
              (F.col("x") - F.col("__cx")) * (F.col("x") - F.col("__cx")))
    return df.join(mid, scan).filter(F.sqrt(gap) < metres).select(*df.columns)


def every_nth(df: DataFrame, by: list[str], order: list[str], n: int,
              part_rows: int = PART_ROWS) -> DataFrame:
    """P10: rows n, 2n, 3n, ... of each key."""
    placed = row_index(df, by, order, "__i", part_rows)
    return placed.filter(F.pmod(F.col("__i") + 1, F.lit(n)) == 0).select(*df.columns)


def evenly_spaced(df: DataFrame, by: list[str], order: list[str], n: int,
                  part_rows: int = PART_ROWS) -> DataFrame:
    """``n`` evenly spaced rows per key, both ends included."""
    placed = row_index(df, by, order, "__i", part_rows, total="__n")
    last = F.col("__n") - 1
    if n < 2:
        return placed.filter(F.col("__i") == 0).select(*df.columns)
    slot = F.ceil(F.col("__i") * (n - 1) / last)
    exact = F.floor(slot * last / (n - 1)) == F.col("__i")
    return placed.filter((F.col("__n") <= n) | ((slot <= n - 1) & exact)).select(*df.columns)


def thin_to(df: DataFrame, by: list[str], order: list[str], n: int,
            part_rows: int = PART_ROWS) -> DataFrame:
    """Every k-th row with k = max(1, count // n), starting with the first."""
    placed = row_index(df, by, order, "__i", part_rows, total="__n")
    step = F.greatest(F.lit(1), F.floor(F.col("__n") / n))
    return placed.filter(F.pmod(F.col("__i"), step) == 0).select(*df.columns)


def subsample_scan(df: DataFrame, scan: list[str], fraction: float, point_id: str,
                   min_keep: int = 100, seed: int = 7, part_rows: int = PART_ROWS) -> DataFrame:
    """A repeatable random share of each scan, at least ``min_keep`` points.

    Points are ranked by a hash; ranks are counted in parts so that a large scan is not
    sorted by one task.
    """
    mixed = df.withColumn("__h", F.xxhash64(F.lit(seed), F.col(point_id)))
    placed = row_index(mixed, scan, ["__h", point_id], "__i", part_rows, total="__n")
    keep = F.greatest(F.lit(min_keep), F.floor(F.col("__n") * fraction))
    return placed.filter(F.col("__i") < keep).select(*df.columns)


def drop_stale(df: DataFrame, max_age_ns: int, arrival: str = "arrival_ns", event: str = "t_ns") -> DataFrame:
    """Drop messages that arrive too old or too early."""
    return df.filter(F.abs(F.col(arrival) - F.col(event)) <= max_age_ns)


def with_voxel(df: DataFrame, size: float | Column) -> DataFrame:
    for name, cell in zip(VOXEL, voxel_of("x", "y", "z", size)):
        df = df.withColumn(name, cell)
    return df


def _pick_per_voxel(df: DataFrame, keys: list[str], order: str, pick) -> DataFrame:
    """Attributes of one row per group, chosen by one numeric order column.

    Column-wise picks over primitive buffers run as hash aggregation with a map-side step; a
    pick over a struct would sort all rows first. All picks follow the same order column,
    so they come from the same row as long as ``order`` is unique within a group.
    """
    rest = [c for c in df.columns if c not in (*keys, order)]
    edge = F.min if pick is F.min_by else F.max
    return df.groupBy(*keys).agg(edge(order).alias(order), *[pick(c, order).alias(c) for c in rest])


def voxel_first(points: DataFrame, size: float, order: str, by: list[str] | None = None) -> DataFrame:
    """First point of each voxel by the unique numeric column ``order``."""
    cut = with_voxel(points, size)
    return _pick_per_voxel(cut, [*(by or []), *VOXEL], order, F.min_by).select(*points.columns)


def voxel_latest(points: DataFrame, size: float, order: str, by: list[str] | None = None) -> DataFrame:
    """Latest point of each voxel."""
    cut = with_voxel(points, size)
    return _pick_per_voxel(cut, [*(by or []), *VOXEL], order, F.max_by).select(*points.columns)


def voxel_mean(points: DataFrame, size: float, attrs: list[str] | None = None,
               by: list[str] | None = None) -> DataFrame:
    """Mean position and attributes, and the number of points."""
    keys = [*(by or []), *VOXEL]
    cols = ["x", "y", "z", *(attrs or [])]
    return with_voxel(points, size).groupBy(*keys).agg(
        *[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n_points")
    )


def voxel_height_aware(points: DataFrame, ground: float, elevated: float, order: str,
                       margin: float = 1.5, share: float = 0.05,
                       by: list[str] | None = None) -> DataFrame:
    """Coarse cells near the ground, fine cells above it.

    The ground level is the 5th percentile of z per cloud; the class is part of the key.
    """
    by = by or []
    level = exact_quantiles(points, by, F.col("z"), {"__ground": share})
    above = F.col("z") > F.col("__ground") + margin
    rows = _attach(points, level, by).withColumn("is_elevated", above).drop("__ground")
    size = F.when(F.col("is_elevated"), F.lit(elevated)).otherwise(F.lit(ground))
    cut = with_voxel(rows, size)
    picked = _pick_per_voxel(cut, [*by, "is_elevated", *VOXEL], order, F.min_by)
    return picked.select(*points.columns, "is_elevated")


def first_pass_only(points: DataFrame, cell: float, gap_ns: int, time: str = "t_ns") -> DataFrame:
    """Drop points that arrive ``gap_ns`` or more after the first in their xy cell."""
    cut = points.withColumn("__cx", F.floor(F.col("x") / cell)).withColumn(
        "__cy", F.floor(F.col("y") / cell)
    )
    first = cut.groupBy("__cx", "__cy").agg(F.min(time).alias("__t0"))
    return cut.join(first, ["__cx", "__cy"]).filter(F.col(time) - F.col("__t0") < gap_ns).select(
        *points.columns
    )


def union_dedup(parts: list[DataFrame], size: float, order: str) -> DataFrame:
    """Union of clouds with one point per voxel; Spark's two-phase aggregate merges them."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return voxel_first(out, size, order)


def raster_topdown(points: DataFrame, res: float = 0.2, max_px: int | None = None,
                   by: list[str] | None = None) -> DataFrame:
    """Occupied pixels with mean height, count, density share and colour.

    The picture spans the points of its group. With ``max_px`` it is made coarser where a side
    would have more pixels; :func:`raster_pyramid` gives coarser pictures beside the fine one.
    """
    by = by or []
    limits = points.groupBy(*by).agg(
        *[f(a).alias(f"__{n}{a}") for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max))]
    )
    rows = _attach(points, limits, by)

    def pixel(axis: str) -> tuple[Column, Column]:
        span = F.greatest(F.col(f"__hi{axis}") - F.col(f"__lo{axis}"), F.lit(1.0))
        size = F.floor(span / res) + 1
        size = size if max_px is None else F.least(size, F.lit(max_px))
        return (F.col(axis) - F.col(f"__lo{axis}")) / span * (size - 1), size

    (across, _), (up, height) = pixel("x"), pixel("y")
    px = F.floor(across)
    py = F.floor(height - 1 - up)  # picture rows count down from the top
    cells = rows.groupBy(*by, px.cast("int").alias("px"), py.cast("int").alias("py")).agg(
        F.avg("z").alias("mean_z"), F.count(F.lit(1)).alias("n_points"),
        F.min("__loz").alias("__loz"), F.min("__hiz").alias("__hiz"),
    )
    top = cells.groupBy(*by).agg(F.max("n_points").alias("__top"))
    cells = _attach(cells, top, by)
    density = F.log1p(F.col("n_points").cast("double")) / F.greatest(F.log1p(F.col("__top").cast("double")), F.lit(1.0))
    share = F.when(F.col("__hiz") > F.col("__loz"),
                   (F.col("mean_z") - F.col("__loz")) / (F.col("__hiz") - F.col("__loz"))).otherwise(F.lit(0.0))
    cells = cells.withColumn("density", density).withColumn("__share", share)
    red, green, blue = height_color("__share", 0.3 + 0.7 * F.col("density"))
    return cells.select(*by, "px", "py", "mean_z", "n_points", "density",
                        red.alias("red"), green.alias("green"), blue.alias("blue"))


def raster_pyramid(points: DataFrame, res: float = 0.2, levels: int = 6, by: list[str] | None = None) -> DataFrame:
    """A24 at any extent: ``by, level, px, py, mean_z, n_points, min_z, max_z`` of occupied pixels.

    Pixels of level 0 are ``res`` wide and counted from the origin; a pixel of each level above
    sums the four below it, so level k is what points rastered at ``2 ** k * res`` would give.
    The points are read once, and each level is made from the cells of the last, at most a
    quarter more rows in all than level 0 has.
    """
    keys = [*(by or []), "px", "py"]
    pixel = [F.floor(F.col(axis) / res).cast("long").alias(name) for axis, name in (("x", "px"), ("y", "py"))]
    cells = points.select(*(by or []), *pixel, "z").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("z").alias("__sum"), F.min("z").alias("min_z"), F.max("z").alias("max_z"))
    out = None
    for level in range(levels):
        cells = settle(cells)
        rows = cells.select(*(by or []), F.lit(level).alias("level"), "px", "py", (F.col("__sum") / F.col("n_points")).alias("mean_z"), "n_points", "min_z", "max_z")
        out = rows if out is None else out.unionByName(rows)
        above = cells.withColumns({c: F.shiftright(c, 1) for c in ("px", "py")})
        cells = above.groupBy(*keys).agg(F.sum("n_points").alias("n_points"), F.sum("__sum").alias("__sum"), F.min("min_z").alias("min_z"), F.max("max_z").alias("max_z"))
    return out


def quantize_points(points: DataFrame, scale: float = 0.01, by: list[str] | None = None) -> DataFrame:
    """K8: scaled-integer coordinates with offset = minimum, and intensity as 0-65535.

    ``overflow`` marks coordinates outside 32 bits.
    """
    by = by or []
    stats = points.groupBy(*by).agg(
        *[F.min(a).alias(f"off_{a}") for a in "xyz"],
        F.min("intensity").alias("__ilo"), F.max("intensity").alias("__ihi"),
    )
    rows = _attach(points, stats, by)
    scaled = {a: F.round((F.col(a) - F.col(f"off_{a}")) / scale).cast("long") for a in "xyz"}
    over = F.greatest(*scaled.values()) > 2147483647
    grey = F.when(F.col("__ihi") > F.col("__ilo"),
                  (F.col("intensity") - F.col("__ilo")) / (F.col("__ihi") - F.col("__ilo")) * 65535)
    return rows.select(
        *points.columns, *[c.alias(f"{a}_int") for a, c in scaled.items()],
        *[f"off_{a}" for a in "xyz"],
        F.coalesce(F.floor(grey), F.lit(0)).cast("int").alias("intensity_u16"), over.alias("overflow"),
    )


def rgb16(channel: Column) -> Column:
    """K8: an 8-bit colour channel in the 16-bit field of a point file."""
    return channel.cast("int") * 256


def with_tile(points: DataFrame, tile_m: float) -> DataFrame:
    tx, ty = tile_of("x", "y", tile_m)
    return points.withColumn("tx", tx).withColumn("ty", ty)


def coverage_pct(points: DataFrame, flags: list[str], by: list[str] | None = None) -> DataFrame:
    """Share of points with each flag, in per cent."""
    return points.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_points"),
        *[(F.avg(F.col(f).cast("double")) * 100).alias(f"{f}_pct") for f in flags],
    )


def deskew(points: DataFrame, poses: DataFrame, by: list[str], bins: int = 16,
           preset: str = "identity", part_rows: int = PART_ROWS) -> DataFrame:
    """Move points to the world frame with one interpolated pose per time bin of a scan.

    Poses are interpolated for ``bins`` rows per scan instead of per point and gathered into
    one array of that fixed length, so the points are shuffled once, by scan. ``points`` has
    ``scan_ns, t_off_ns, x, y, z``.
    """
    keys = [*by, "scan_ns"]
    extent = points.groupBy(*keys).agg(
        F.min("t_off_ns").alias("__lo"), F.max("t_off_ns").alias("__hi")
    )
    span = F.col("__hi") - F.col("__lo")
    centre = F.col("scan_ns") + F.col("__lo") + F.floor(span * (2 * F.col("__bin") + 1) / (2 * bins))
    slots = extent.withColumn("__bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).withColumn(
        "t_ns", centre
    )
    at = interpolate_poses(settle(slots), poses, by, part_rows=part_rows)
    rot, shift = compose_t(pose_t("p_"), extrinsic(preset))
    entry = F.struct(F.col("__bin").alias("b"), *[c.alias(f"r{i}") for i, c in enumerate(rot)],
                     *[c.alias(f"t{i}") for i, c in enumerate(shift)])
    per_scan = at.groupBy(*keys, "__lo", "__hi").agg(F.array_sort(F.collect_list(entry)).alias("__t"))
    rows = points.join(per_scan, keys)
    slot = F.when(span > 0, F.least(F.floor((F.col("t_off_ns") - F.col("__lo")) * bins / span),
                                    F.lit(bins - 1))).otherwise(F.lit(0))
    rows = rows.withColumn("__m", F.get(F.col("__t"), slot.cast("int")))
    m = F.col("__m")
    world = apply_t(([m[f"r{i}"] for i in range(9)], [m[f"t{i}"] for i in range(3)]), ("x", "y", "z"))
    kept = [c for c in points.columns if c not in ("x", "y", "z")]
    return rows.select(*kept, *[w.alias(a) for a, w in zip("xyz", world)])


def world_or_deskew(world: DataFrame, raw: DataFrame, poses: DataFrame, session: str = "session_id",
                    **deskew_args) -> DataFrame:
    """Sessions that already have world-frame points use them; the rest are deskewed."""
    have = world.select(session).distinct()
    missing = raw.join(have, session, "left_anti")
    moved = deskew(missing, poses, [session], **deskew_args)
    return world.unionByName(moved, allowMissingColumns=True)


def _apart(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns behind a generator, which no filter or projection is merged through: each is computed once."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def seen_pixels(points: DataFrame, images: DataFrame, pixels: DataFrame, cameras: DataFrame, tol_ns: int, by: list[str],
                point_id: str = "point_id", part_rows: int = PART_ROWS) -> DataFrame:
    """Every (point, camera) in a picture: ``point_id``, the other columns of ``cameras`` and of ``pixels``.

    ``images`` (keys, camera, t_ns, image_id); ``pixels`` (image_id, row, col and values);
    ``cameras`` (camera, model, width, height, fx..cy, d0..d4, r0..r8, tx..tz and more, such as
    priority and kind). Scans are matched to images once per camera of their session, not once
    per point, and only points that fall inside a picture reach the pixel join.
    """
    scans = points.select(*by, F.col("scan_ns").alias("t_ns")).distinct()
    rig = images.select(*by, "camera").distinct()
    asked = settle(match(scans, rig, by) if by else scans.crossJoin(rig))  # a rig has a handful of cameras
    matched = nearest_asof(asked, images, [*by, "camera"], tol_ns, prefix="i_", right_tie="image_id", part_rows=part_rows)
    matched = matched.select(*by, F.col("t_ns").alias("scan_ns"), "camera", F.col("i_image_id").alias("image_id"))
    rows = points.select(*by, "scan_ns", point_id, "x", "y", "z").join(matched, [*by, "scan_ns"]).join(cameras, "camera")
    r, t = [F.col(f"r{i}") for i in range(9)], [F.col(f"t{a}") for a in "xyz"]
    k = [F.col(n) for n in ("fx", "fy", "cx", "cy")]
    rows = _apart(rows, dict(zip(("__x", "__y", "__d"), apply_t((r, t), ("x", "y", "z"))))).filter(F.col("__d") > MIN_DEPTH_M)
    rows = _apart(rows, {"__a": F.col("__x") / F.col("__d"), "__b": F.col("__y") / F.col("__d")})
    rows = _apart(rows, {"__r2": F.col("__a") * F.col("__a") + F.col("__b") * F.col("__b")})
    rows = _apart(rows, {"__r": F.sqrt("__r2"), "__th": F.atan(F.sqrt("__r2"))})
    flat = bend_pinhole("__a", "__b", "__r2", k, [F.col(f"d{i}") for i in range(5)])
    wide = bend_fisheye("__a", "__b", "__r", "__th", k, [F.col(f"d{i}") for i in range(4)])
    is_wide = F.col("model") == "fisheye"
    rows = _apart(rows, {n: F.when(is_wide, w).otherwise(f) for n, w, f in zip(("__u", "__v"), wide, flat)})
    rows = rows.filter(in_image("__u", "__v", "__d", "width", "height"))
    rows = rows.withColumn("col", F.floor("__u").cast("int")).withColumn("row", F.floor("__v").cast("int"))
    used = {"model", "width", "height", "fx", "fy", "cx", "cy", *[f"d{i}" for i in range(5)], *[f"r{i}" for i in range(9)], "tx", "ty", "tz"}
    about = [c for c in cameras.columns if c not in used]
    values = [c for c in pixels.columns if c not in ("image_id", "row", "col")]
    return rows.join(pixels, ["image_id", "row", "col"]).select(point_id, *about, *values)


def colorize_points(points: DataFrame, images: DataFrame, pixels: DataFrame, cameras: DataFrame,
                    tol_ns: int, by: list[str], point_id: str = "point_id",
                    part_rows: int = PART_ROWS) -> DataFrame:
    """Colour of each point from the first camera, by priority, that sees it; see :func:`seen_pixels`."""
    seen = seen_pixels(points, images, pixels, cameras, tol_ns, by, point_id, part_rows)
    best = seen.groupBy(point_id).agg(
        F.min_by("value", "priority").alias("value"), F.min("priority").alias("priority")
    )
    return points.join(best, point_id, "left").withColumn("has_color", F.col("value").isNotNull())


def _of_kind(kind: str):
    return lambda sight: sight["kind"] == kind


def point_attributes(points: DataFrame, images: DataFrame, pixels: DataFrame, cameras: DataFrame, tol_ns: int, by: list[str],
                     kinds: tuple[str, ...] = ("rgb", "thermal"), point_id: str = "point_id", part_rows: int = PART_ROWS) -> DataFrame:
    """All that the cameras tell of each point, each kind of camera for itself.

    ``cameras`` also has ``kind`` and ``priority``. Per kind the pixel columns of the first
    camera that sees the point, as ``<kind>_<column>``, with ``<kind>_camera`` and
    ``has_<kind>``; beside them ``raw``, a map from every camera that sees the point to a struct
    of its pixel columns, as large as the rig. Points that no camera sees keep nulls; of several
    sightings of a repeated point by one camera the one with the least values counts.
    """
    values = [c for c in pixels.columns if c not in ("image_id", "row", "col")]
    seen = seen_pixels(points, images, pixels, cameras, tol_ns, by, point_id, part_rows)
    each = F.struct("kind", "priority", "camera", F.struct(*values).alias("v"))
    told = seen.groupBy(point_id).agg(F.array_sort(F.collect_set(each)).alias("__seen"))
    told = told.withColumn("__raw", F.array_sort(F.transform("__seen", lambda s: F.struct(s["camera"].alias("camera"), s["v"].alias("v")))))
    first = F.filter("__raw", lambda s, i: (i == 0) | (F.get(F.col("__raw"), i - 1)["camera"] != s["camera"]))
    told = told.withColumn("raw", F.map_from_entries(first))
    for kind in kinds:
        told = told.withColumn("__best", F.get(F.filter("__seen", _of_kind(kind)), F.lit(0)))
        told = told.withColumns({f"{kind}_{c}": F.col("__best")["v"][c] for c in values} | {f"{kind}_camera": F.col("__best")["camera"]})
    told = told.drop("__seen", "__raw", "__best")
    rows = points.join(told, point_id, "left")
    return rows.withColumns({f"has_{kind}": F.col(f"{kind}_camera").isNotNull() for kind in kinds})
