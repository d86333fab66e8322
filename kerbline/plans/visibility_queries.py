"""Queries on frames and properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.functions.geo import bng_to_wgs84, wgs84_to_bng
from kerbline.operators import visibility as V
from kerbline.operators.spatial import gathered, grid_radius_join, radius_join_small, unfolded
from kerbline.plans.bindings import PARTS, Tables, with_tables
from kerbline.plans.registry import query, r

PAIRS = """, near AS (
  SELECT f.*, p.uprn, p.x AS px, p.y AS py, sqrt((p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y)) AS dist
  FROM frames f JOIN props p ON p.x BETWEEN f.x - 76 AND f.x + 76 AND p.y BETWEEN f.y - 76 AND f.y + 76),
brg AS (SELECT *, degrees(atan2(px - x, py - y)) AS b0 FROM near WHERE dist <= 75),
rel AS (SELECT *, b0 - 360 * floor(b0 / 360) AS bearing FROM brg),
rel2 AS (SELECT *, (heading_deg - bearing) - 360 * floor((heading_deg - bearing) / 360) AS rel FROM rel),
pairs AS (
  SELECT *, CASE camera_side WHEN 'left' THEN least(abs(rel - 90), 360 - abs(rel - 90))
      WHEN 'right' THEN least(abs(rel - 270), 360 - abs(rel - 270)) ELSE 180 END AS perp
  FROM rel2 WHERE (camera_side = 'left' AND rel BETWEEN 30 AND 150) OR (camera_side = 'right' AND rel BETWEEN 210 AND 330)
    OR (camera_side = 'rear' AND rel BETWEEN 120 AND 240)),
scored AS (SELECT *, perp + abs(dist - 32.5) * 0.3::DOUBLE AS score, perp < 15 AS is_perp FROM pairs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY uprn ORDER BY score, t_ns, frame_id) AS rn FROM scored),
heroes AS (
  SELECT uprn, count(*) AS visible_count, count(*) FILTER (WHERE is_perp) AS perpendicular_count,
    max(score) FILTER (WHERE rn = 1) AS best_score, max(frame_id) FILTER (WHERE rn = 1) AS best_frame_id,
    max(t_ns) FILTER (WHERE rn = 1) AS best_t_ns, max(camera_side) FILTER (WHERE rn = 1) AS camera_side,
    max(dist) FILTER (WHERE rn = 1) AS distance_m, max(perp) FILTER (WHERE rn = 1) AS perp_deg
  FROM ranked GROUP BY uprn)
"""
BASE = with_tables("frames", "props") + PAIRS


def _place_pairs(t: Tables):
    """Pairs of frames and places, with the properties there as ``p_rows``."""
    return V.visibility_pairs(t.frames(), gathered(t.properties().select("uprn", "x", "y")))


def _best(t: Tables, by: list[str] | None = None):
    """The best frame of every property, without the texts of a property."""
    return V.heroes(V.seen_best(t.frames(), t.properties().select("uprn", "x", "y"), by), by)


def _told_best(t: Tables, by: list[str] | None = None):
    """The best frame of every property, with its texts."""
    return V.heroes(V.seen_best(t.frames(), t.properties(), by), by)


def _of_session(h, f):
    """Heroes with the session of their frame; neither side goes through the driver."""
    return h.hint("merge").join(f.select(F.col("frame_id").alias("best_frame_id"), "session_id"), "best_frame_id")


def _seen(t: Tables, by: list[str]):
    """How many frames see each property, for queries that only count pairs."""
    return V.seen_counts(t.frames(), t.properties(), by)


@query(BASE + """SELECT uprn, round(best_score, 6) AS best_score, best_frame_id, best_t_ns, camera_side,
  round(distance_m, 6) AS distance_m, round(perp_deg, 6) AS perp_deg, visible_count, perpendicular_count FROM heroes""")
def hero_per_property(t: Tables):
    h = _best(t)
    return h.select(F.col("p_uprn").alias("uprn"), r("best_score"), "best_frame_id", "best_t_ns", "camera_side",
                    r("distance_m"), r("perp_deg"), "visible_count", "perpendicular_count")


@query(BASE + """SELECT frame_id, uprn, camera_side, round(dist, 6) AS distance_m, round(bearing, 6) AS bearing_deg,
  round(perp, 6) AS perp_deg, is_perp AS is_perpendicular FROM scored""")
def visibility_pairs(t: Tables):
    # rounded once per place
    pairs = _place_pairs(t).select("frame_id", "camera_side", r("distance_m"), r("bearing_deg"), r("perp_deg"), "is_perpendicular", "p_rows")
    return unfolded(pairs).select("frame_id", F.col("p_uprn").alias("uprn"), "camera_side", "distance_m", "bearing_deg", "perp_deg", "is_perpendicular")


@query(with_tables("frames", "props") + """, near AS (
  SELECT f.*, p.uprn, p.x AS px, p.y AS py, sqrt((p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y)) AS dist
  FROM frames f JOIN props p ON floor(p.x / 50) BETWEEN floor(f.x / 50) - 1 AND floor(f.x / 50) + 1
    AND floor(p.y / 50) BETWEEN floor(f.y / 50) - 1 AND floor(f.y / 50) + 1)
SELECT session_id, count(*) AS n_pairs, count(DISTINCT uprn) AS n_props, round(avg(dist), 6) AS mean_m
FROM near WHERE dist <= 75 GROUP BY session_id""")
def grid_window_pairs(t: Tables):
    """J1 with the 3x3 window, which can miss pairs beyond 50 m from a cell edge."""
    props = t.properties().select("uprn", "x", "y")
    pairs = grid_radius_join(t.frames(), props.select("x", "y").distinct(), 75.0, 50.0, window=1)
    at_place = pairs.groupBy("session_id", "p_x", "p_y").agg(F.count(F.lit(1)).alias("n"), F.sum("distance_m").alias("m"))
    each = V.at_their_places(props, at_place).groupBy("session_id", "p_uprn").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    return each.groupBy("session_id").agg(
        F.sum("n").alias("n_pairs"), F.count("p_uprn").alias("n_props"), r(F.sum("m") / F.sum("n"), 6, "mean_m"))


@query(with_tables("frames", "props") + """SELECT f.frame_id, p.uprn,
  round(sqrt((p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y)), 6) AS distance_m
FROM frames f JOIN props p ON sqrt((p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y)) <= 50""")
def radius_join_few(t: Tables):
    """All pairs within a radius, without a grid of the caller's."""
    pairs = radius_join_small(t.frames(), gathered(t.properties().select("uprn", "x", "y")), 50.0)
    return unfolded(pairs.select("frame_id", r("distance_m"), "p_rows")).select("frame_id", F.col("p_uprn").alias("uprn"), "distance_m")


@query(BASE + """SELECT uprn, count(*) AS frame_count, count(*) FILTER (WHERE camera_side = 'left') AS left_count,
  count(*) FILTER (WHERE camera_side = 'right') AS right_count, round(min(dist), 6) AS min_distance_m,
  CASE WHEN count(*) FILTER (WHERE camera_side = 'left') > 0 AND count(*) FILTER (WHERE camera_side = 'right') > 0 THEN 'both'
    WHEN count(*) FILTER (WHERE camera_side = 'left') > 0 THEN 'left'
    WHEN count(*) FILTER (WHERE camera_side = 'right') > 0 THEN 'right' ELSE 'none' END AS sides
FROM scored GROUP BY uprn""")
def visibility_stats(t: Tables):
    s = V.visibility_stats(_seen(t, []))
    return s.select(F.col("p_uprn").alias("uprn"), "frame_count", "left_count", "right_count", r("min_distance_m"), "sides")


@query(BASE + "SELECT session_id, count(DISTINCT uprn) AS property_count, count(*) AS frame_matches FROM scored GROUP BY session_id")
def pass_totals(t: Tables):
    return V.pass_totals(_seen(t, ["session_id"]), "session_id")


@query(BASE + """SELECT session_id, uprn, frame_count, rank FROM (
  SELECT session_id, uprn, count(*) AS frame_count,
    row_number() OVER (PARTITION BY session_id ORDER BY count(*) DESC, uprn) AS rank FROM scored GROUP BY session_id, uprn)
WHERE rank <= 5""")
def busiest_properties(t: Tables):
    b = V.busiest_properties(_seen(t, ["session_id"]), "session_id", 5)
    return b.select("session_id", F.col("p_uprn").alias("uprn"), "frame_count", F.col("rank").cast("long").alias("rank"))


@query(with_tables("frames") + """SELECT session_id, round(min(x), 2) AS xmin, round(min(y), 2) AS ymin,
  round(max(x), 2) AS xmax, round(max(y), 2) AS ymax FROM frames GROUP BY session_id""")
def trajectory_bbox(t: Tables):
    return V.bbox(t.frames(), ["session_id"])


@query(BASE + """SELECT f.session_id, f.total_frames, coalesce(v.n_props, 0) AS total_properties,
  coalesce(v.n, 0) AS total_visibility, coalesce(v.n_props, 0) AS heroes
FROM (SELECT session_id, count(DISTINCT t_ns) AS total_frames FROM frames GROUP BY session_id) f
LEFT JOIN (SELECT session_id, count(DISTINCT uprn) AS n_props, count(*) AS n FROM scored GROUP BY session_id) v
  ON f.session_id = v.session_id""")
def session_counts(t: Tables):
    return V.session_counts(t.frames(), _seen(t, ["session_id"]), ["session_id"])


@query(BASE + """, bb AS (SELECT session_id, round(min(x), 2) AS xmin, round(max(y), 2) AS ymax, count(DISTINCT t_ns) AS total_frames
  FROM frames GROUP BY session_id),
v AS (SELECT session_id, count(DISTINCT uprn) AS n FROM scored GROUP BY session_id),
a AS (SELECT session_id, count(*) FILTER (WHERE source <> 'error') AS total_images,
  count(*) FILTER (WHERE source = 'view') AS n_view FROM frames GROUP BY session_id),
c AS (SELECT session_id, count(*) AS cloud_count, CAST(sum(floor(value)) AS BIGINT) AS cloud_points
  FROM frames WHERE source = 'error' GROUP BY session_id)
SELECT bb.session_id, bb.total_frames, coalesce(v.n, 0) AS total_properties, bb.xmin, bb.ymax, a.total_images, a.n_view,
  c.cloud_count, c.cloud_points
FROM bb LEFT JOIN v USING (session_id) LEFT JOIN a USING (session_id) LEFT JOIN c USING (session_id)""")
def session_summary(t: Tables):
    f = t.frames()
    kind = F.when(F.col("source") == "error", "slam_cloud").otherwise(F.col("source"))
    clouds = f.filter("source = 'error'").select("session_id", F.floor("value").alias("n_points"))
    s = V.session_summary(f, _seen(t, ["session_id"]), f.select("session_id", kind.alias("kind")), clouds, ["session_id"])
    return s.select("session_id", "total_frames", "total_properties", "xmin", "ymax", "total_images",
                    F.col("assets")["view"].alias("n_view"), "cloud_count", "cloud_points")


@query(BASE + """, named AS (SELECT session_id, uprn, count(*) AS frame_count FROM scored GROUP BY session_id, uprn)
SELECT session_id, uprn, frame_count, CAST(session_id AS VARCHAR) || '_' || CAST(uprn AS VARCHAR) AS name FROM named""")
def manifest_index(t: Tables):
    m = V.property_manifests(_seen(t, ["session_id"]), "session_id")
    name = F.concat_ws("_", F.col("session_id").cast("string"), F.col("p_uprn").cast("string"))
    return m.select("session_id", F.col("p_uprn").alias("uprn"), "frame_count", name.alias("name"))


@query(BASE + """, m AS (SELECT session_id, uprn, count(*) AS frame_count, CAST(session_id AS VARCHAR) || '_' || CAST(uprn AS VARCHAR) AS name FROM scored GROUP BY session_id, uprn),
h AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(name)) AS s FROM m),
u AS (SELECT *, s[1:8] || '-' || s[9:12] || '-5' || s[14:16] || '-' ||
  CASE WHEN s[17:17] IN ('0', '4', '8', 'c') THEN '8' WHEN s[17:17] IN ('1', '5', '9', 'd') THEN '9' WHEN s[17:17] IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END
  || s[18:20] || '-' || s[21:32] AS osid FROM h)
SELECT session_id, uprn, osid, 'bags/' || CAST(session_id AS VARCHAR) || '/observations/' || osid || '/manifest.json' AS object_key, frame_count FROM u""")
def manifest_uuid(t: Tables):
    m = V.property_manifests(_seen(t, ["session_id"]), "session_id")
    return m.select("session_id", F.col("p_uprn").alias("uprn"), "osid", "object_key", "frame_count")


@query(BASE + """SELECT session_id, uprn, frame_id AS frame, camera_side AS camera, round(dist, 1) AS distance_m FROM scored""")
def manifest_frames(t: Tables):
    m = V.manifest_frames(_place_pairs(t), "session_id")
    return m.select("session_id", F.col("p_uprn").alias("uprn"), "frame", "camera", "distance_m")


@query(BASE + """SELECT 'statistics' AS section, count(DISTINCT session_id) AS n FROM frames
UNION ALL SELECT 'trajectory_bbox', count(DISTINCT session_id) FROM frames
UNION ALL SELECT 'frames', count(DISTINCT (session_id, t_ns)) FROM frames
UNION ALL SELECT 'heroes', count(DISTINCT (session_id, uprn)) FROM scored
UNION ALL SELECT 'visibility', count(*) FROM scored""")
def visibility_document_sections(t: Tables):
    doc = V.visibility_document(t.frames(), _place_pairs(t), _told_best(t, SESSION), SESSION, seen=_seen(t, SESSION))
    return doc.groupBy("section").agg(F.count(F.lit(1)).alias("n"))


@query(BASE + """, track AS (SELECT frame_id, session_id, t_ns, x, y FROM frames),
h AS (SELECT h.*, f.session_id FROM heroes h JOIN frames f ON f.frame_id = h.best_frame_id)
SELECT h.uprn, h.session_id, h.best_t_ns, round(k.x, 6) AS traj_x, round(k.y, 6) AS traj_y, p.x AS prop_x, p.y AS prop_y
FROM h JOIN track k ON k.frame_id = h.best_frame_id JOIN props p ON p.uprn = h.uprn""")
def hero_locations(t: Tables):
    f = t.frames()
    h = _of_session(_best(t), f)
    at = V.hero_locations(h, f, t.properties(), ["session_id"], part_rows=PARTS)
    return at.select(F.col("p_uprn").alias("uprn"), "session_id", "best_t_ns", r("traj_x"), r("traj_y"), "prop_x", "prop_y")


@query(BASE + """, h AS (SELECT h.uprn, h.best_frame_id, h.best_t_ns, f.session_id FROM heroes h JOIN frames f ON f.frame_id = h.best_frame_id),
a AS (SELECT session_id, t_ns, source, 'file_' || CAST(frame_id AS VARCHAR) AS file FROM frames),
l AS (SELECT h.*, a.file AS view_file FROM h ASOF LEFT JOIN (SELECT * FROM a WHERE source = 'view') a
  ON h.session_id = a.session_id AND h.best_t_ns >= a.t_ns)
SELECT l.uprn, l.best_frame_id, l.view_file, e.file AS error_file, CAST((l.view_file IS NOT NULL)::INT + (e.file IS NOT NULL)::INT AS INTEGER) AS n_assets
FROM l ASOF LEFT JOIN (SELECT * FROM a WHERE source = 'error') e ON l.session_id = e.session_id AND l.best_t_ns >= e.t_ns""")
def hero_assets(t: Tables):
    f = t.frames()
    h = _of_session(_best(t), f)
    assets = f.select("session_id", "t_ns", F.col("source").alias("kind"),
                      F.concat(F.lit("file_"), F.col("frame_id").cast("string")).alias("file"))
    out = V.hero_assets(h, assets, ["view", "error"], ["session_id"], part_rows=PARTS)
    return out.select(F.col("p_uprn").alias("uprn"), "best_frame_id", F.col("assets")["view"].alias("view_file"),
                      F.col("assets")["error"].alias("error_file"), F.size("assets").alias("n_assets"))


@query(BASE + """, n AS (SELECT session_id, count(*) AS n FROM frames GROUP BY session_id),
i AS (SELECT f.*, n.n, row_number() OVER (PARTITION BY f.session_id ORDER BY t_ns) - 1 AS i FROM frames f JOIN n USING (session_id))
SELECT session_id, 'trajectory' AS kind, 1::BIGINT AS n FROM n WHERE n >= 2
UNION ALL SELECT session_id, 'heading_arrow', count(*) FROM i WHERE i % greatest(1, n // 100) = 0 AND heading_deg <> 0 GROUP BY session_id
UNION ALL SELECT f.session_id, 'property', count(*) FROM heroes h JOIN frames f ON f.frame_id = h.best_frame_id GROUP BY f.session_id""")
def overlay_features(t: Tables):
    f = t.frames().withColumn("lat", F.lit(51.5) + F.col("y") / 111000).withColumn("lon", F.lit(-1.25) + F.col("x") / 111000)
    h = _of_session(_told_best(t), f)
    grid = t.properties().select(F.col("uprn").alias("p_uprn"), (F.col("x") + 400000).alias("x"), (F.col("y") + 300000).alias("y"))
    places = bng_to_wgs84(grid).select("p_uprn", "lat", "lon")
    feats = V.overlay_features(f, h.hint("merge").join(places, "p_uprn"), ["session_id"], part_rows=PARTS)
    return feats.groupBy("session_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(with_tables("props") + """SELECT uprn, CAST(0 AS DOUBLE) AS dx, CAST(0 AS DOUBLE) AS dy FROM props""")
def bng_roundtrip(t: Tables):
    """grid -> geographic -> grid; the residual must vanish at centimetres."""
    grid = t.properties().select("uprn", (F.col("x") + 400000).alias("x"), (F.col("y") + 300000).alias("y"))
    back = wgs84_to_bng(bng_to_wgs84(grid), names=("e", "n"))
    return back.select("uprn", r(F.col("e") - F.col("x"), 2, "dx"), r(F.col("n") - F.col("y"), 2, "dy"))


SESSION = ["session_id"]


def _document(t: Tables):
    """The whole document with metadata, asset counts and a file of two kinds per hero."""
    f, pairs = t.frames(), _place_pairs(t)
    assets = f.select("session_id", "t_ns", F.col("source").alias("kind"), F.concat(F.lit("file_"), F.col("frame_id").cast("string")).alias("file"))
    found = V.hero_assets(_told_best(t, SESSION), assets, ["view", "error"], SESSION, part_rows=PARTS)
    about = f.select("session_id").distinct().select("session_id", F.format_string("rig_%d", "session_id").alias("rig_id"), F.lit("2024-01-31").alias("generated_at"))
    return V.visibility_document(f, pairs, found, SESSION, about, assets, ("view", "error"), _seen(t, SESSION))


def _section(t: Tables, name: str, schema: str):
    return _document(t).where(F.col("section") == name).select("session_id", "sort_key", F.from_json("json", schema).alias("j")).select("session_id", "sort_key", "j.*")


@query(BASE + """, hs AS (SELECT *, row_number() OVER (PARTITION BY session_id, uprn ORDER BY score, t_ns, frame_id) AS rn, count(*) OVER w AS n, count(*) FILTER (is_perp) OVER w AS np
  FROM scored WINDOW w AS (PARTITION BY session_id, uprn)),
b AS (SELECT session_id, uprn, t_ns, camera_side, dist, perp, n, np FROM hs WHERE rn = 1),
v AS (SELECT b.*, a.frame_id AS vf FROM b ASOF LEFT JOIN (SELECT * FROM frames WHERE source = 'view') a ON b.session_id = a.session_id AND b.t_ns >= a.t_ns),
e AS (SELECT v.*, a.frame_id AS ef FROM v ASOF LEFT JOIN (SELECT * FROM frames WHERE source = 'error') a ON v.session_id = a.session_id AND v.t_ns >= a.t_ns)
SELECT session_id, 'UPRN_' || CAST(e.uprn AS VARCHAR) AS sort_key, e.uprn, t_ns AS hero_rgb_timestamp_ns, camera_side, round(dist, 2) AS distance_m,
  round(perp, 2) AS angle_from_perpendicular_deg, n AS visible_frame_count, np AS perpendicular_frame_count, address, building_use,
  'file_' || CAST(vf AS VARCHAR) AS hero_view, 'file_' || CAST(ef AS VARCHAR) AS hero_error FROM e JOIN props p ON p.uprn = e.uprn""")
def document_heroes(t: Tables):
    """K2: the hero records as their JSON has them."""
    return _section(t, "heroes", "uprn long, hero_rgb_timestamp_ns long, camera_side string, distance_m double, angle_from_perpendicular_deg double, visible_frame_count long,"
                    " perpendicular_frame_count long, address string, building_use string, hero_view string, hero_error string")


@query(BASE + """SELECT session_id, CAST(t_ns AS VARCHAR) || '/' || CAST(uprn AS VARCHAR) AS sort_key, t_ns AS frame_timestamp_ns, uprn, camera_side, round(dist, 2) AS distance_m,
  round(bearing, 2) AS bearing_deg, round(perp, 2) AS angle_from_perpendicular_deg, is_perp AS is_perpendicular FROM scored""")
def document_visibility(t: Tables):
    """K2: the visibility records as their JSON has them."""
    return _section(t, "visibility", "frame_timestamp_ns long, uprn long, camera_side string, distance_m double, bearing_deg double, angle_from_perpendicular_deg double, is_perpendicular boolean")


@query(BASE + """, v AS (SELECT session_id, count(DISTINCT uprn) AS n_props, count(*) AS n FROM scored GROUP BY session_id)
SELECT f.session_id, 'rig_' || CAST(f.session_id AS VARCHAR) AS rig_id, CAST(f.session_id AS VARCHAR) AS session_name, count(DISTINCT f.t_ns) AS total_frames,
  coalesce(any_value(n_props), 0) AS total_uprns, coalesce(any_value(n), 0) AS total_visibility_records, coalesce(any_value(n_props), 0) AS uprns_with_hero_shots,
  count(*) FILTER (source = 'view') AS n_view, count(*) FILTER (source = 'error') AS n_error, round(min(x), 2) AS xmin, round(max(y), 2) AS ymax
FROM frames f LEFT JOIN v ON v.session_id = f.session_id GROUP BY f.session_id""")
def document_statistics(t: Tables):
    """K2: metadata, statistics with asset counts and bounding box, from their JSON."""
    schema = "rig_id string, session_name string, total_frames long, total_uprns long, total_visibility_records long, uprns_with_hero_shots long, assets map<string, long>, xmin double, ymax double"
    rows = _document(t).where(F.col("section").isin("metadata", "statistics", "trajectory_bbox")).select("session_id", F.from_json("json", schema).alias("j"))
    whole = rows.groupBy("session_id").agg(*[F.max(f"j.{c}").alias(c) for c in (
        "rig_id", "session_name", "total_frames", "total_uprns", "total_visibility_records", "uprns_with_hero_shots", "xmin", "ymax")],
        F.max(F.col("j.assets")["view"]).alias("n_view"), F.max(F.col("j.assets")["error"]).alias("n_error"))
    return whole


@query(with_tables("fixes") + """, s AS (SELECT session_id, max_by(status, t_ns) AS gnss_fix_status, round(max_by(var, t_ns), 4) AS gnss_h_covariance_m2,
  max_by(source, t_ns) AS heading_source, max_by(x, t_ns) FILTER (status >= 2) AS ox, max_by(y, t_ns) FILTER (status >= 2) AS oy
  FROM (SELECT fixes.*, frames.source FROM fixes JOIN frames USING (frame_id)) GROUP BY session_id)
SELECT session_id, gnss_fix_status, gnss_h_covariance_m2, heading_source, ox IS NOT NULL AS georeferenced, CASE WHEN ox IS NULL THEN 'SLAM_local' ELSE 'EPSG:27700' END AS crs,
  round(ox, 3) AS easting, round(oy, 3) AS northing FROM s""".replace("max_by(", "arg_max("))
def session_state(t: Tables):
    """K3: the last state of each session; its origin is where it was last fixed well."""
    fixes = t.fixes().join(t.frames().select("frame_id", F.col("source").alias("heading_source")), "frame_id")
    good = F.col("status") >= 2
    rows = fixes.select("session_id", "t_ns", "heading_source", F.col("status").alias("gnss_fix_status"), F.col("covariance")[0].alias("gnss_h_covariance_m2"),
                        F.when(good, F.col("x")).alias("origin_x"), F.when(good, F.col("y")).alias("origin_y"), F.when(good, F.lit(0.0)).alias("origin_z"))
    out = V.session_state(rows, SESSION)
    return out.select("session_id", "gnss_fix_status", "gnss_h_covariance_m2", "heading_source", "georeferenced", "crs", "slam_origin_bng.easting", "slam_origin_bng.northing")


@query(BASE + """, m AS (SELECT session_id, uprn, CAST(session_id AS VARCHAR) || '_' || CAST(uprn AS VARCHAR) AS name, row_number() OVER (PARTITION BY session_id, uprn ORDER BY t_ns, CAST(frame_id AS VARCHAR)) AS n,
  frame_id, camera_side FROM scored)
SELECT CAST(session_id AS VARCHAR) AS bag_id, CAST(uprn AS VARCHAR) AS uprn, CAST(n AS INTEGER) AS n, CAST(frame_id AS VARCHAR) AS frame, camera_side AS camera FROM m""")
def manifest_json(t: Tables):
    """K5: every manifest put together from its lines and read as JSON, one row per visible frame."""
    lines = V.manifest_lines(unfolded(_place_pairs(t)), "session_id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    schema = "osid string, bag_id string, uprn string, visible_frames array<struct<camera: string, frame: string>>"
    whole = lines.groupBy("osid").agg(F.from_json(text, schema).alias("j")).where("osid = j.osid")
    rows = whole.select("j.bag_id", "j.uprn", F.posexplode("j.visible_frames").alias("n", "f"))
    return rows.select("bag_id", "uprn", (F.col("n") + 1).alias("n"), "f.frame", "f.camera")


@query(BASE + """, h AS (SELECT h.*, f.session_id FROM heroes h JOIN frames f ON f.frame_id = h.best_frame_id)
SELECT session_id, 'UPRN_' || CAST(h.uprn AS VARCHAR) AS name, round(distance_m, 2) AS distance_m, round(perp_deg, 2) AS perp_angle, camera_side AS camera, visible_count, address, building_use
FROM h JOIN props USING (uprn)""")
def overlay_properties(t: Tables):
    """K4: the property points of the overlay, from their JSON."""
    f = t.frames().withColumn("lat", F.lit(51.5) + F.col("y") / 111000).withColumn("lon", F.lit(-1.25) + F.col("x") / 111000).withColumn("heading_source", F.col("source"))
    h = _of_session(_told_best(t), f)
    grid = t.properties().select(F.col("uprn").alias("p_uprn"), (F.col("x") + 400000).alias("x"), (F.col("y") + 300000).alias("y"))
    feats = V.overlay_features(f, h.hint("merge").join(bng_to_wgs84(grid).select("p_uprn", "lat", "lon"), "p_uprn"), SESSION, part_rows=PARTS)
    schema = "properties struct<name: string, distance_m: double, perp_angle: double, camera: string, visible_count: long, address: string, building_use: string>"
    return feats.where("kind = 'property'").select("session_id", F.from_json("json", schema).alias("j")).select("session_id", "j.properties.*")


@query(with_tables("frames") + """, i AS (SELECT f.*, count(*) OVER (PARTITION BY session_id) AS n, row_number() OVER (PARTITION BY session_id ORDER BY t_ns) - 1 AS i FROM frames f),
k AS (SELECT * FROM i WHERE i % greatest(1, n // 2000) = 0)
SELECT k.session_id, CAST(k.session_id AS VARCHAR) AS session, max(n) AS points, arg_max(source, i) AS heading_source, count(*) AS n_vertices,
  round(sum(round(-1.25::DOUBLE + x / 111000, 7)), 4) AS lon_sum, round(sum(round(51.5::DOUBLE + y / 111000, 7)), 4) AS lat_sum FROM k GROUP BY k.session_id HAVING max(n) >= 2""")
def overlay_lines(t: Tables):
    """K4: the line of each session with its vertices, from its JSON."""
    f = t.frames().withColumn("lat", F.lit(51.5) + F.col("y") / 111000).withColumn("lon", F.lit(-1.25) + F.col("x") / 111000).withColumn("heading_source", F.col("source"))
    none = t.properties().limit(0).select(F.col("uprn").alias("p_uprn"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.lit(0).cast("long").alias("session_id"),
                                          F.lit(0.0).alias("distance_m"), F.lit(0.0).alias("perp_deg"), F.lit("").alias("camera_side"), F.lit(0).alias("visible_count"))
    lines = V.overlay_features(f, none, SESSION, part_rows=PARTS).where("kind = 'trajectory'")
    schema = "geometry struct<coordinates: array<array<double>>>, properties struct<session: string, points: long, heading_source: string>"
    j = lines.select("session_id", F.from_json("json", schema).alias("j")).select("session_id", "j.properties.*", F.col("j.geometry.coordinates").alias("c"))
    lon = F.aggregate("c", F.lit(0.0), lambda total, p: total + p[0])
    lat = F.aggregate("c", F.lit(0.0), lambda total, p: total + p[1])
    add = [F.round(lon, 4).alias("lon_sum"), F.round(lat, 4).alias("lat_sum")]
    return j.select("session_id", "session", "points", "heading_source", F.size("c").cast("long").alias("n_vertices"), *add)
