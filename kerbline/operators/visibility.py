"""What each frame sees and the best frame per property."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.geo import (
    PERPENDICULAR_LIMIT_DEG, bearing, fov_axis, hero_score, in_fov, in_fov_by_axis, perp_angle, relative_angle,
)
from kerbline.functions.labels import uuid5
from kerbline.operators.ordered import PART_ROWS, match, row_index, scan
from kerbline.operators.spatial import grid_radius_join, unfolded
from kerbline.operators.timejoin import nearest_asof
from kerbline.operators.windows import best_and_counts, dedup_by_time, top_k
from kerbline.session import settle


#: Direction of the middle of the camera's sector and cosine of half its width.
AXIS = ("__ax", "__ay", "__ac")


def visibility_pairs(frames: DataFrame, props: DataFrame, radius: float = 75.0, cell: float | None = None,
                     window: int | None = None, convention: str = "heading_minus_bearing",
                     perp_limit: float = PERPENDICULAR_LIMIT_DEG, **join_args) -> DataFrame:
    """Every (frame, property) in range and in the camera sector, with the hero score.

    ``frames`` has ``x, y, heading_deg, camera_side``; ``props`` has ``uprn, x, y``.
    """
    axis = dict(zip(AXIS, fov_axis("heading_deg", "camera_side", convention), strict=True))
    pairs = grid_radius_join(frames.withColumns(axis), props, radius, cell, window, **join_args)
    pairs = pairs.withColumn("bearing_deg", bearing("x", "y", "p_x", "p_y"))
    pairs = pairs.withColumn("rel_deg", relative_angle("heading_deg", "bearing_deg", convention))
    # nearly all pairs are told by products alone; only those at the edge of a sector need the angle
    clear = in_fov_by_axis(F.col("p_x") - F.col("x"), F.col("p_y") - F.col("y"), *AXIS)
    pairs = pairs.filter(F.coalesce(clear, in_fov("rel_deg", "camera_side"))).drop(*AXIS)
    pairs = pairs.withColumn("perp_deg", perp_angle("rel_deg", "camera_side"))
    return pairs.withColumn("is_perpendicular", F.col("perp_deg") < perp_limit).withColumn(
        "score", hero_score("perp_deg", "distance_m")
    )


def seen_counts(frames: DataFrame, props: DataFrame, by: list[str], radius: float = 75.0, **pair_args) -> DataFrame:
    """Frames of each ``by`` that see a property: ``by, p_uprn, n_frames, n_left, n_right, min_distance_m``, one row per row of ``props``.

    What is seen depends on the place alone, and the flats of a house share one: frames are
    paired with the places and counted there (:func:`visibility_pairs`), and each property takes
    the counts of its place. A property that has several rows has several here; :func:`per_property` adds them.
    """
    pairs = visibility_pairs(frames, props.select("x", "y").distinct(), radius, **pair_args)
    at_place = pairs.groupBy(*by, "p_x", "p_y").agg(
        F.count(F.lit(1)).alias("n_frames"), F.count_if(F.col("camera_side") == "left").alias("n_left"),
        F.count_if(F.col("camera_side") == "right").alias("n_right"), F.min("distance_m").alias("min_distance_m"))
    return at_their_places(props.select("uprn", "x", "y"), at_place)


def at_their_places(props: DataFrame, at_place: DataFrame) -> DataFrame:
    """Every row of ``props`` with what was found at its place (``p_x, p_y``).

    Neither side goes through the driver; a place with very many properties is streamed past its rows.
    """
    placed = props.select(*[F.col(c).alias(f"p_{c}") for c in props.columns])
    return placed.hint("merge").join(at_place, ["p_x", "p_y"]).drop("p_x", "p_y")


def per_property(pairs: DataFrame, by: list[str]) -> DataFrame:
    """One row per (by, property) with its ``frame_count``, from pairs or from :func:`seen_counts`."""
    n = F.coalesce(F.sum("n_frames"), F.lit(0)) if "n_frames" in pairs.columns else F.count(F.lit(1))
    return pairs.groupBy(*by, "p_uprn").agg(n.alias("frame_count"))


#: What a hero keeps of its property, where the property table has it.
HERO_PROPERTY = ("address", "building_height_m", "building_use")


#: What a hero keeps of its frame and of how that sees the property.
HERO_FRAME = ("frame_id", "t_ns", "camera_side", "distance_m", "perp_deg", "score")


def seen_best(frames: DataFrame, props: DataFrame, by: list[str] | None = None, tie: tuple[str, ...] = ("t_ns", "frame_id"),
              radius: float = 75.0, **pair_args) -> DataFrame:
    """Best frame of each ``by`` and the counts for every row of ``props``, found once per place, for :func:`heroes`.

    As in :func:`seen_counts` frames are paired with places; each property takes the best frame of its place.
    """
    by = by or []
    at = [*by, "p_x", "p_y"]
    kept = list(dict.fromkeys([*HERO_FRAME, *tie]))
    pairs = visibility_pairs(frames, props.select("x", "y").distinct(), radius, **pair_args)
    rows = best_and_counts(pairs, at, ["score", *tie], kept, "is_perpendicular")
    best = F.min_by(F.struct(*kept), F.struct("score", *tie)).alias("__b")
    at_place = rows.groupBy(*at).agg(best, F.sum("__n").alias("__n"), F.sum("__flagged").alias("__flagged"))
    own = [c for c in HERO_PROPERTY if c in props.columns]
    return at_their_places(props.select("uprn", "x", "y", *own), at_place.select(*at, "__b.*", "__n", "__flagged"))


def heroes(pairs: DataFrame, by: list[str] | None = None, tie: tuple[str, ...] = ("t_ns", "frame_id")) -> DataFrame:
    """A1: best frame per property, first in time on a tie, with the counts and the property's columns.

    ``pairs`` may be :func:`seen_best`. Every batch of pairs is first reduced to one row per property
    (:func:`best_and_counts`), as the aggregate that picks whole rows sorts what it gets; a stream has no need of it.
    """
    keys = [*(by or []), "p_uprn"]
    own = [c for c in HERO_PROPERTY if f"p_{c}" in pairs.columns]
    kept = [*HERO_FRAME, *[f"p_{c}" for c in own]]
    if "__flagged" in pairs.columns:
        rows = pairs
    elif pairs.isStreaming:
        rows = pairs.withColumn("__n", F.lit(1)).withColumn("__flagged", F.col("is_perpendicular").cast("int"))
    else:
        rows = best_and_counts(pairs, keys, ["score", *tie], kept, "is_perpendicular")
    best = F.struct("score", *tie)
    detail = F.struct("frame_id", "t_ns", "camera_side", "distance_m", "perp_deg", "score", *[F.col(f"p_{c}").alias(c) for c in own])
    return (
        rows.groupBy(*keys)
        .agg(
            F.min_by(detail, best).alias("__b"),
            F.sum("__n").alias("visible_count"),
            F.coalesce(F.sum("__flagged"), F.lit(0)).cast("long").alias("perpendicular_count"),
        )
        .select(
            *keys,
            F.col("__b.score").alias("best_score"),
            F.col("__b.frame_id").alias("best_frame_id"),
            F.col("__b.t_ns").alias("best_t_ns"),
            F.col("__b.camera_side").alias("camera_side"),
            F.col("__b.distance_m").alias("distance_m"),
            F.col("__b.perp_deg").alias("perp_deg"),
            "visible_count",
            "perpendicular_count",
            *[F.col(f"__b.{c}").alias(c) for c in own],
        )
    )


def hero_assets(hero_rows: DataFrame, assets: DataFrame, kinds: list[str], by: list[str],
                part_rows: int = PART_ROWS) -> DataFrame:
    """A2: latest file of each kind at the hero time as ``assets`` MAP(kind -> file).

    ``assets`` has ``(keys, t_ns, kind, file)``. The kinds are a short configured list.
    """
    heroes_at = settle(hero_rows.withColumnRenamed("best_t_ns", "t_ns"))
    own = [c for c in heroes_at.columns if c not in (*by, "t_ns")]
    asked = heroes_at.select(*by, "t_ns", F.lit(1).alias("__side"), F.struct(*own).alias("__h"))
    files = assets.filter(F.col("kind").isin(*kinds)).select(*by, "t_ns", F.lit(0).alias("__side"), "kind", "file")
    both = asked.unionByName(files, allowMissingColumns=True)
    latest = {f"__a_f{i}": F.when(F.col("kind") == kind, F.col("file")) for i, kind in enumerate(kinds)}
    known = scan(both, by, ["t_ns", "__side", "file"], last=latest, part_rows=part_rows).filter("__side = 1")
    out = known.select(*by, "t_ns", *[F.col("__h")[c].alias(c) for c in own], *latest).select(*heroes_at.columns, *latest)
    entries = [F.when(F.col(f"__a_f{i}").isNotNull(), F.struct(F.lit(k).alias("k"), F.col(f"__a_f{i}").alias("v")))
               for i, k in enumerate(kinds)]
    mapped = F.map_from_entries(F.array_compact(F.array(*entries)))
    return out.withColumn("assets", mapped).drop(*[f"__a_f{i}" for i in range(len(kinds))]).withColumnRenamed(
        "t_ns", "best_t_ns"
    )


def visibility_stats(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A3: frames per property, left and right counts, least distance, sides; ``pairs`` may be :func:`seen_counts`."""
    if "n_frames" in pairs.columns:
        every, left, right = (F.coalesce(F.sum(c), F.lit(0)) for c in ("n_frames", "n_left", "n_right"))
    else:
        every, left, right = F.count(F.lit(1)), *(F.count_if(F.col("camera_side") == side) for side in ("left", "right"))
    sides = (
        F.when((F.col("left_count") > 0) & (F.col("right_count") > 0), "both")
        .when(F.col("left_count") > 0, "left")
        .when(F.col("right_count") > 0, "right")
        .otherwise("none")
    )
    return pairs.groupBy(*(by or []), "p_uprn").agg(
        every.alias("frame_count"),
        left.alias("left_count"),
        right.alias("right_count"),
        F.min("min_distance_m" if "n_frames" in pairs.columns else "distance_m").alias("min_distance_m"),
    ).withColumn("sides", sides)


def pass_totals(pairs: DataFrame, pass_col: str) -> DataFrame:
    """A4: properties and matched frames per pass.

    Pairs (or :func:`seen_counts`) are first reduced to one row per (pass, property), so the
    distinct count needs no expansion.
    """
    return per_property(pairs, [pass_col]).groupBy(pass_col).agg(
        F.count(F.lit(1)).alias("property_count"), F.sum("frame_count").alias("frame_matches")
    )


def busiest_properties(pairs: DataFrame, pass_col: str, k: int = 5) -> DataFrame:
    """O2 over A4: the ``k`` properties with most frames per pass; ``pairs`` may be :func:`seen_counts`."""
    return top_k(per_property(pairs, [pass_col]), [pass_col], [F.desc("frame_count"), F.asc("p_uprn")], k)


def bbox(track: DataFrame, by: list[str]) -> DataFrame:
    """A5: bounding box, two digits."""
    return track.groupBy(*by).agg(
        F.round(F.min("x"), 2).alias("xmin"), F.round(F.min("y"), 2).alias("ymin"),
        F.round(F.max("x"), 2).alias("xmax"), F.round(F.max("y"), 2).alias("ymax"),
    )


def session_counts(frames: DataFrame, pairs: DataFrame, by: list[str]) -> DataFrame:
    """Distinct frames, properties seen, visibility rows and heroes per session; ``pairs`` may be :func:`seen_counts`."""
    n_frames = frames.select(*by, "t_ns").distinct().groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_frames")
    )
    n_seen = per_property(pairs, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_properties"), F.sum("frame_count").alias("total_visibility")
    )
    zero = F.lit(0).cast("long")
    return n_frames.join(n_seen, by, "left").select(
        *by, "total_frames",
        F.coalesce("total_properties", zero).alias("total_properties"),
        F.coalesce("total_visibility", zero).alias("total_visibility"),
        F.coalesce("total_properties", zero).alias("heroes"),
    )


def visibility_document(frames: DataFrame, pairs: DataFrame, hero_rows: DataFrame, by: list[str],
                        sessions: DataFrame | None = None, assets: DataFrame | None = None, kinds: tuple[str, ...] = (),
                        seen: DataFrame | None = None) -> DataFrame:
    """K2: the visibility document as JSON records (keys, section, sort_key, json).

    Sections: ``metadata`` (columns of ``sessions``, such as ``rig_id, generated_at,
    generator``), ``statistics`` with the number of assets per kind, ``trajectory_bbox``,
    ``frames``, ``heroes`` and ``visibility``. ``assets`` has ``(keys, kind)``; heroes with an
    ``assets`` map get ``hero_<kind>`` for each of ``kinds``; absent values are left out.
    One record per entry keeps a long session from being collected into a single value;
    written partitioned by the keys and section it is the same document line by line. The pairs,
    by far the largest table, are read for their own section and, unless ``seen`` has their
    counts (:func:`seen_counts`), for the statistics, and not written in between. They may be pairs with
    places (:func:`gathered`): angles and distances are then rounded once per place.
    """
    def record(df: DataFrame, section: str, sort_key, body) -> DataFrame:
        return df.select(*by, F.lit(section).alias("section"),
                         sort_key.cast("string").alias("sort_key"), F.to_json(body).alias("json"))

    two = lambda c: F.round(F.col(c), 2)
    unique = dedup_by_time(frames, by, "t_ns", "frame_id")
    counts = session_counts(frames, unfolded(pairs) if seen is None else seen, by)
    shown = unfolded(pairs.withColumns({c: two(c) for c in ("distance_m", "bearing_deg", "perp_deg")}))
    if assets is not None:
        per_kind = assets.groupBy(*by, "kind").agg(F.count(F.lit(1)).alias("__n"))  # a short list of kinds
        counts = match(counts, per_kind.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "__n")))).alias("assets")), by, "left")
    known = [F.col(c) for c in HERO_PROPERTY if c in hero_rows.columns]
    files = [F.col("assets")[k].alias(f"hero_{k}") for k in kinds]
    parts = [
        record(counts, "statistics", F.lit(""),
               F.struct("total_frames", F.col("total_properties").alias("total_uprns"), F.col("total_visibility").alias("total_visibility_records"),
                        F.col("heroes").alias("uprns_with_hero_shots"), *(["assets"] if assets is not None else []))),
        record(bbox(frames, by), "trajectory_bbox", F.lit(""), F.struct("xmin", "ymin", "xmax", "ymax")),
        record(unique, "frames", F.col("t_ns"),
               F.struct(F.col("t_ns").alias("timestamp_ns"), two("x").alias("x"), two("y").alias("y"),
                        two("heading_deg").alias("heading_deg"))),
        record(hero_rows, "heroes", F.concat(F.lit("UPRN_"), F.col("p_uprn").cast("string")),
               F.struct(F.col("p_uprn").alias("uprn"), F.col("best_t_ns").alias("hero_rgb_timestamp_ns"),
                        "camera_side", two("distance_m").alias("distance_m"),
                        two("perp_deg").alias("angle_from_perpendicular_deg"),
                        F.col("visible_count").alias("visible_frame_count"),
                        F.col("perpendicular_count").alias("perpendicular_frame_count"), *known, *files)),
        record(shown, "visibility", F.concat_ws("/", "t_ns", "p_uprn"),
               F.struct(F.col("t_ns").alias("frame_timestamp_ns"), F.col("p_uprn").alias("uprn"),
                        "camera_side", "distance_m", "bearing_deg",
                        F.col("perp_deg").alias("angle_from_perpendicular_deg"), "is_perpendicular")),
    ]
    if sessions is not None:
        about = [c for c in sessions.columns if c not in by]
        name = F.concat_ws("_", *[F.col(c).cast("string") for c in by]).alias("session_name")
        parts.insert(0, record(sessions, "metadata", F.lit(""), F.struct(name, *about)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: The last known state of a session that its summary tells, and how many digits of each.
STATE = {"rig_id": None, "ambient_temp_c": None, "heading_source": None, "gnss_fix_status": None, "gnss_h_covariance_m2": 4,
         "heading_offset_deg": 2, "heading_offset_std_deg": 2, "heading_converged": None, "heading_offset_rtk_samples": None}
ORIGIN = {"easting": "origin_x", "northing": "origin_y", "altitude": "origin_z"}


def session_state(rows: DataFrame, by: list[str], time: str = "t_ns", crs: str = "EPSG:27700", local: str = "SLAM_local") -> DataFrame:
    """K3: the latest value of each column of ``STATE`` that ``rows`` have, and the origin of the local frame.

    A session is ``georeferenced`` when it has an origin (``origin_x, origin_y, origin_z``).
    Each column counts for itself: its latest row with a value.
    """
    there = [c for c in (*STATE, *ORIGIN.values()) if c in rows.columns]
    last = rows.groupBy(*by).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(time))).alias(c) for c in there])
    out = [(F.col(c) if STATE[c] is None else F.round(c, STATE[c])).alias(c) for c in STATE if c in there]
    if set(ORIGIN.values()) <= set(there):
        placed = F.col("origin_x").isNotNull() & F.col("origin_y").isNotNull()
        spot = F.struct(*[F.round(c, 3).alias(n) for n, c in ORIGIN.items()])
        out += [placed.alias("georeferenced"), F.when(placed, crs).otherwise(local).alias("crs"), F.when(placed, spot).alias("slam_origin_bng")]
    return last.select(*by, *out)


def session_summary(frames: DataFrame, pairs: DataFrame, assets: DataFrame, clouds: DataFrame,
                    by: list[str], state: DataFrame | None = None) -> DataFrame:
    """K3: one row per session: counts, bounding box, assets, cloud totals and the last state.

    ``assets`` has ``(keys, kind)`` and ``clouds`` ``(keys, n_points)``. The asset map has
    one entry per configured kind. ``state`` comes from :func:`session_state`.
    """
    per_kind = assets.groupBy(*by, "kind").agg(F.count(F.lit(1)).alias("n"))
    kinds = per_kind.groupBy(*by).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("assets"),
        F.sum(F.when(F.col("kind") != "slam_cloud", F.col("n")).otherwise(0)).alias("total_images"),
    )
    points = clouds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cloud_count"), F.sum("n_points").alias("cloud_points")
    )
    whole = (
        session_counts(frames, pairs, by).join(bbox(frames, by), by, "left")
        .join(kinds, by, "left").join(points, by, "left")
    )
    return whole if state is None else whole.join(state, by, "left")


def property_manifests(pairs: DataFrame, recording: str, key_prefix: str = "bags") -> DataFrame:
    """K5: one row per (recording, property): id, object key, frame count; ``pairs`` may be :func:`seen_counts`.

    The visible frames follow in :func:`manifest_frames`; they are not packed into one value
    because a parked vehicle can see one property in any number of frames.
    """
    per = per_property(pairs, [recording])
    name = F.concat_ws("_", F.col(recording).cast("string"), F.col("p_uprn").cast("string"))
    return per.withColumn("osid", uuid5(name)).withColumn(
        "object_key",
        F.concat_ws("/", F.lit(key_prefix), F.col(recording).cast("string"), F.lit("observations"),
                    "osid", F.lit("manifest.json")),
    )


def manifest_frames(pairs: DataFrame, recording: str) -> DataFrame:
    """K5: the visible frames of every manifest, one row each, ready to write by ``osid``; pairs may be with places (:func:`gathered`)."""
    pairs = unfolded(pairs.withColumn("distance_m", F.round("distance_m", 1)))
    name = F.concat_ws("_", F.col(recording).cast("string"), F.col("p_uprn").cast("string"))
    return pairs.select(uuid5(name).alias("osid"), recording, "p_uprn",
                        F.col("camera_side").alias("camera"), F.col("frame_id").alias("frame"), "distance_m")


def manifest_lines(pairs: DataFrame, recording: str) -> DataFrame:
    """K5: every manifest as the lines of one JSON text: ``osid, line_no, line``.

    The first line opens the record, one line follows per visible frame, in time order, and the
    last one closes it; joined in order they are the manifest. A property that a parked vehicle
    sees in any number of frames is thus never one value.
    """
    name = F.concat_ws("_", F.col(recording).cast("string"), F.col("p_uprn").cast("string"))
    rows = pairs.select(uuid5(name).alias("osid"), F.col(recording).cast("string").alias("__bag"), F.col("p_uprn").cast("string").alias("__uprn"),
                        "t_ns", F.col("camera_side").alias("camera"), F.col("frame_id").cast("string").alias("frame"))
    rows = settle(rows)
    inside = Window.partitionBy("osid").orderBy("t_ns", "frame")
    comma = F.when(F.lead("osid").over(inside).isNull(), "").otherwise(",")
    shown = F.to_json(F.struct("camera", "frame"))
    frames = rows.select("osid", F.row_number().over(inside).alias("line_no"), F.concat(shown, comma).alias("line"))
    each = rows.groupBy("osid").agg(F.min("__bag").alias("bag_id"), F.min("__uprn").alias("uprn"), F.count(F.lit(1)).alias("__n"))
    head = F.to_json(F.struct("osid", "uprn", "bag_id"))
    begun = F.concat(F.expr("left(__head, length(__head) - 1)"), F.lit(',"visible_frames":['))
    opened = each.withColumn("__head", head).select("osid", F.lit(0).alias("line_no"), begun.alias("line"))
    closed = each.select("osid", (F.col("__n") + 1).cast("int").alias("line_no"), F.lit('],"hero_rgb":null}').alias("line"))
    return opened.unionByName(frames).unionByName(closed)


def hero_locations(hero_rows: DataFrame, track: DataFrame, props: DataFrame, by: list[str],
                   part_rows: int = PART_ROWS) -> DataFrame:
    """Hero -> nearest trajectory point -> property place."""
    at = settle(hero_rows.withColumnRenamed("best_t_ns", "t_ns"))
    near = nearest_asof(at, track.select(*by, "t_ns", "x", "y"), by, prefix="traj_", part_rows=part_rows)
    places = props.select(F.col("uprn").alias("p_uprn"), F.col("x").alias("prop_x"), F.col("y").alias("prop_y"))
    # files of properties are small against what a broadcast of their rows takes
    return near.hint("merge").join(places, "p_uprn").withColumnRenamed("t_ns", "best_t_ns")


def overlay_features(track: DataFrame, hero_points: DataFrame, by: list[str],
                     max_line: int = 2000, max_arrows: int = 100, arrow_deg: float = 0.0002,
                     part_rows: int = PART_ROWS) -> DataFrame:
    """K4: GeoJSON features (keys, kind, json): one line, heading arrows, property points.

    The line is thinned to fewer than ``2 * max_line`` points before it is gathered, so the
    gathered array has a fixed bound. ``track`` has ``t_ns, lat, lon, heading_deg`` and
    perhaps ``heading_source``; ``hero_points`` has ``lat, lon, p_uprn`` and hero columns. The
    line tells its session and heading source, a property its address and use.
    """
    placed = row_index(track, by, ["t_ns"], "__i", part_rows, total="__n")
    ok = (F.abs("lat") > 0.1) & (F.abs("lon") > 0.0001)
    seven = lambda c: F.round(c, 7)
    point = F.array(seven(F.col("lon")), seven(F.col("lat")))

    def every(limit: int):
        step = F.greatest(F.lit(1), F.floor(F.col("__n") / limit))
        return F.pmod(F.col("__i"), step) == 0

    def feature(shape: str, coords, **props):
        return F.to_json(F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit(shape).alias("type"), coords.alias("coordinates")).alias("geometry"),
            F.struct(*[v.alias(k) for k, v in props.items()]).alias("properties"),
        ))

    ordered = F.array_sort(F.collect_list(F.struct("__i", point.alias("p"))))
    told = {"heading_source": F.max_by("heading_source", "__i").alias("__src")} if "heading_source" in track.columns else {}
    session = F.concat_ws("_", *[F.col(c).cast("string") for c in by])
    line = (
        placed.filter((F.col("__n") >= 2) & every(max_line) & ok)
        .groupBy(*by).agg(F.transform(ordered, lambda s: s["p"]).alias("__c"), F.max("__n").alias("__n"), *told.values())
        .select(*by, F.lit("trajectory").alias("kind"),
                feature("LineString", F.col("__c"), name=F.lit("trajectory"), session=session, points=F.col("__n"),
                        **({"heading_source": F.col("__src")} if told else {})).alias("json"))
    )
    h = F.radians("heading_deg")
    tip = F.array(seven(F.col("lon") + arrow_deg * F.sin(h)), seven(F.col("lat") + arrow_deg * F.cos(h)))
    arrows = placed.filter(every(max_arrows) & ok & (F.col("heading_deg") != 0)).select(
        *by, F.lit("heading_arrow").alias("kind"),
        feature("LineString", F.array(point, tip), name=F.lit("heading_arrow"),
                heading_deg=F.round("heading_deg", 1)).alias("json"),
    )
    points = hero_points.select(
        *by, F.lit("property").alias("kind"),
        feature("Point", point, name=F.concat(F.lit("UPRN_"), F.col("p_uprn").cast("string")),
                distance_m=F.round("distance_m", 2), perp_angle=F.round("perp_deg", 2),
                camera=F.col("camera_side"), visible_count=F.col("visible_count"),
                **{c: F.col(c) for c in ("address", "building_use") if c in hero_points.columns}).alias("json"),
    )
    return line.unionByName(arrows).unionByName(points)
