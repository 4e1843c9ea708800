"""Named queries of map features, relational scenes, provenance and explanations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsift import binding as B
from roadsift import catalog as C
from roadsift.catalog import query
from roadsift.catalog_review import samples
from roadsift.operators import review
from roadsift.sources import maps, scenes

# Map features of all kinds from parts: twelve a scenario, now and then an id that occurs again.

FEATURES_SQL = """WITH p AS (SELECT p_partkey // 12 AS scenario_id, p_partkey % 9 AS kind, p_size AS size, CASE WHEN p_partkey % 9 = 8 THEN p_partkey - 2 ELSE p_partkey END AS feature_id, p_partkey AS pos FROM part),
k AS (SELECT *, CASE kind WHEN 0 THEN 'lane' WHEN 1 THEN 'road_line' WHEN 2 THEN 'road_edge' WHEN 3 THEN 'crosswalk' WHEN 4 THEN 'speed_bump' WHEN 5 THEN 'stop_sign' WHEN 6 THEN 'driveway' WHEN 8 THEN 'lane' END AS feature_type FROM p WHERE kind <> 7),
l AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY scenario_id, feature_id ORDER BY pos DESC) = 1)
"""


@B.remembered
def feature_records(spark: SparkSession, sf: str) -> DataFrame:
    kind, size = F.col("kind"), F.col("p_size")
    points = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((size + i).cast("double").alias("x"), (i * 0.5).cast("double").alias("y")))
    one = lambda k, **fields: F.when(kind == k, F.struct(*[c.alias(n) for n, c in fields.items()])) if isinstance(k, int) else F.when(kind.isin(*k), F.struct(*[c.alias(n) for n, c in fields.items()]))
    code = (size % 11).cast("int")
    feature = F.struct(
        F.when(kind == 8, F.col("p_partkey") - 2).otherwise(F.col("p_partkey")).alias("id"),
        one((0, 8), type=code, polyline=points, speed_limit_mph=size.cast("double"), interpolating=size % 2 == 0, entry_lanes=F.array(F.col("p_partkey")), exit_lanes=F.array(F.col("p_partkey"), F.col("p_partkey") + 1)).alias("lane"),
        one(1, type=code, polyline=points).alias("road_line"), one(2, type=code, polyline=points).alias("road_edge"), one(3, polygon=points).alias("crosswalk"), one(4, polygon=points).alias("speed_bump"),
        one(5, position=F.struct(size.cast("double").alias("x"), F.lit(1.0).alias("y")), lane=F.array(F.col("p_partkey"))).alias("stop_sign"), one(6, polygon=points).alias("driveway"),
    )
    rows = B.table(spark, sf, "part").withColumn("kind", F.col("p_partkey") % 9).select(F.floor(F.col("p_partkey") / 12).cast("long").alias("scenario_id"), "p_partkey", feature.alias("f"))
    return rows.groupBy("scenario_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "f"))), lambda x: x["f"]).alias("map_features"))


_LANE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in maps.LANE_TYPES.items())
_LINE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in maps.ROAD_LINE_TYPES.items())
_EDGE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in maps.ROAD_EDGE_TYPES.items())


@query(
    f"""SELECT scenario_id, feature_id, feature_type, CASE feature_type WHEN 'lane' THEN CASE size % 11 {_LANE} ELSE 'unknown' END WHEN 'road_line' THEN CASE size % 11 {_LINE} ELSE 'unknown' END WHEN 'road_edge' THEN CASE size % 11 {_EDGE} ELSE 'unknown' END END AS subtype,
  CAST(CASE WHEN feature_type IN ('lane', 'road_line', 'road_edge') THEN 3 ELSE 0 END AS INTEGER) AS line_points, CAST(CASE WHEN feature_type IN ('crosswalk', 'speed_bump', 'driveway') THEN 3 ELSE 0 END AS INTEGER) AS ring_points,
  CASE WHEN feature_type = 'lane' THEN CAST(size AS DOUBLE) END AS speed_limit_mph, CASE WHEN feature_type = 'lane' THEN size % 2 = 0 END AS interpolating, CASE WHEN feature_type = 'stop_sign' THEN CAST(size AS DOUBLE) END AS stop_x FROM l""",
    FEATURES_SQL,
)
def src_03_map_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = maps.flatten_features(feature_records(spark, sf))
    return rows.select("scenario_id", "feature_id", "feature_type", "subtype", F.size("polyline").alias("line_points"), F.size("polygon").alias("ring_points"), "speed_limit_mph", "interpolating", F.col("position.x").alias("stop_x"))


@query("SELECT scenario_id, feature_type, count(*) AS features FROM l WHERE feature_type IN ('lane', 'stop_sign') GROUP BY ALL", FEATURES_SQL.replace("WHERE kind <> 7", "WHERE kind IN (0, 5, 8)"))
def src_03_rule_features_only(spark: SparkSession, sf: str) -> DataFrame:
    return maps.flatten_features(feature_records(spark, sf), visual=False).groupBy("scenario_id", "feature_type").agg(F.count("*").alias("features"))


@query("SELECT o_orderkey, 'orders.parquet' AS source_file, n AS source_index, 'log_orders.parquet_s' || CASE WHEN n < 10000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END || '.json' AS payload_name FROM (SELECT o_orderkey, row_number() OVER () - 1 AS n FROM orders)", "")
def src_09_provenance(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.with_provenance(B.table(spark, sf, "orders"), "log").select("o_orderkey", "source_file", "source_index", "payload_name")


# Sensor records from lines: seven calibrations, one of them unknown, over three sensors.

SENSOR_SQL = """, data AS (SELECT scenario_id AS sample, tix AS position, s % 7 AS c, p AS ego_pose, q % 2 = 0 AS is_key_frame FROM base),
chosen AS (SELECT *, c <> 6 AND c % 3 = 0 AS main FROM data WHERE (c <> 6 AND c % 3 = 0) OR is_key_frame QUALIFY row_number() OVER (PARTITION BY sample ORDER BY NOT (c <> 6 AND c % 3 = 0), position) = 1)
"""


@B.remembered
def sensors(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("r_regionkey")
    return B.table(spark, sf, "region").filter("r_regionkey < 3").select(k.cast("long").alias("sensor"), F.when(k == 0, "LIDAR_TOP").when(k == 1, "CAM_FRONT").otherwise("RADAR_FRONT").alias("channel"), F.when(k == 0, "lidar").when(k == 1, "camera").otherwise("radar").alias("modality"))


@query(SENSOR_SQL + "SELECT s.scenario_id AS sample, CAST(p_size AS BIGINT) AS pose_x FROM scen s LEFT JOIN chosen c ON c.sample = s.scenario_id LEFT JOIN part ON p_partkey = c.ego_pose AND p_partkey % 10 <> 0")
def nrm_04_ego_pose(spark: SparkSession, sf: str) -> DataFrame:
    data = B.agents(spark, sf).select(F.col("scenario_id").alias("sample"), F.col("tix").alias("position"), (F.col("s") % 7).cast("long").alias("calibrated"), F.col("p").alias("ego_pose"), (F.col("q") % 2 == 0).alias("is_key_frame"))
    calibrated = B.table(spark, sf, "supplier").select((F.col("s_suppkey") % 7).cast("long").alias("calibrated")).distinct().filter("calibrated <> 6").withColumn("sensor", F.col("calibrated") % 3)
    poses = B.table(spark, sf, "part").filter("p_partkey % 10 <> 0").select(F.col("p_partkey").alias("ego_pose"), F.col("p_size").cast("long").alias("pose_x"))
    return scenes.ego_poses(data, calibrated, sensors(spark, sf).select("sensor", "channel"), poses)


@B.remembered
def uneven_features(spark: SparkSession, sf: str) -> DataFrame:
    """Map features without any in every seventh scenario, and with one lane unresolved in every fifth."""
    line = F.when((F.col("scenario_id") % 5 == 0) & (F.col("feature_id") == 2), F.slice("polyline", 1, 0)).otherwise(F.col("polyline"))
    return B.map_features(spark, sf).filter("scenario_id % 7 <> 0").withColumn("polyline", line)


@query("SELECT scenario_id, CASE WHEN scenario_id % 7 = 0 THEN 'camera,lidar,radar' WHEN scenario_id % 5 = 0 THEN 'camera,lane_topology,lidar,map,radar' ELSE 'camera,lane_geometry,lane_topology,lidar,map,radar' END AS capabilities FROM scen")
def nrm_12_capabilities(spark: SparkSession, sf: str) -> DataFrame:
    rows = scenes.capabilities(B.scenarios(spark, sf), sensors(spark, sf), uneven_features(spark, sf))
    return rows.select("scenario_id", F.array_join("capabilities", ",").alias("capabilities"))


@query("SELECT s.scenario_id AS scene, count(*) AS samples, CAST(8 AS DOUBLE) AS hz, CAST(CASE WHEN s.scenario_id % 7 = 0 THEN 0 ELSE 4 END AS BIGINT) AS lanes, CAST(CASE WHEN s.scenario_id % 7 = 0 THEN 0 WHEN s.scenario_id % 5 = 0 THEN 3 ELSE 4 END AS BIGINT) AS centrelines, CAST(CASE WHEN s.scenario_id % 7 = 0 THEN 0 ELSE 1 END AS BIGINT) AS links, CASE WHEN s.scenario_id % 7 <> 0 AND s.scenario_id % 5 = 0 THEN 'lane_geometry,traffic_lights' ELSE 'traffic_lights' END AS skipped FROM scen s JOIN sdc e ON e.scenario_id = s.scenario_id GROUP BY ALL")
def nrm_13_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = scenes.scene_metadata(scenes.order_samples(samples(spark, sf)), uneven_features(spark, sf))
    return rows.select("scene", "samples", "hz", "lanes", "centrelines", "links", F.array_join("skipped", ",").alias("skipped"))


@query(
    C.BRAKING_SQL
    + """SELECT scenario_id, step_index, subject_id, concat_ws(',', 'acceleration_mps2=' || CAST(round(acceleration) AS INTEGER), 'distance_m=' || CAST(round(distance) + 1 AS INTEGER), 'other_type=' || other_type, CASE WHEN red_lon IS NOT NULL THEN 'red_light_stop_longitudinal_m=' || CAST(round(red_lon) AS INTEGER) END, 'review_subtype=' || review_subtype) AS metrics FROM braking"""
)
def rev_06_explanation(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of hard braking; a supporting event's distance replaces the event's own, and an unknown name is left out."""
    whole = lambda c: F.round(c).cast("int").cast("string")
    entry = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    own = F.array(entry("distance_m", whole(F.col("distance")), "other_type", F.col("other_type"), "unlisted", F.lit("x")), entry("acceleration_mps2", whole(F.col("acceleration")), "red_light_stop_longitudinal_m", whole(F.col("red_lon")), "review_subtype", F.col("review_subtype")))
    supporting = F.array(F.array(entry("distance_m", (F.round("distance") + 1).cast("int").cast("string"))))
    rows = C.braking_pairs(spark, sf).withColumn("m", review.explanation(own, supporting))
    told = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.select("scenario_id", "step_index", "subject_id", F.array_join(told, ",").alias("metrics"))


@query("""SELECT o_orderkey AS scene, 'scene-' || o_orderkey AS name, n_name AS location, CASE WHEN s.scenario_id IS NULL THEN 0 ELSE 16 END AS samples, CASE WHEN s.scenario_id IS NOT NULL THEN CAST(8 AS DOUBLE) END AS hz,
  CASE WHEN s.scenario_id IS NOT NULL THEN CAST(o_orderkey % 50 AS DOUBLE) END AS origin_x, CASE WHEN s.scenario_id IS NOT NULL THEN CAST(0 - o_orderkey % 30 AS DOUBLE) END AS origin_y, CASE WHEN s.scenario_id IS NOT NULL THEN (o_orderkey % 4) * CAST(0.25 AS DOUBLE) END AS origin_yaw,
  CASE WHEN bare THEN 0 ELSE 4 END AS lanes, CASE WHEN NOT bare AND o_orderkey % 5 = 0 THEN 'lane_geometry=Some lane polygons have no centreline.;' ELSE '' END || 'traffic_lights=The source has no traffic light states by sample.' AS skipped,
  concat_ws('|', 'States are those of annotated samples, none between them.', CASE WHEN s.scenario_id IS NOT NULL THEN 'Positions are relative to the first ego position, axes and headings are global.' END, CASE WHEN NOT bare THEN CASE WHEN o_orderkey % 5 = 0 THEN 3 ELSE 4 END || ' of 4 lanes have a centreline.' END, CASE WHEN NOT bare THEN '1 directed links between lanes are inferred.' END) AS notes
  FROM orders LEFT JOIN scen s ON s.scenario_id = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 6 <> 0 LEFT JOIN nation ON n_nationkey = c_nationkey, LATERAL (SELECT s.scenario_id IS NULL OR o_orderkey % 7 = 0 AS bare)""")  # fmt: skip
def nrm_13_described_scenes(spark: SparkSession, sf: str) -> DataFrame:
    """Scenes of orders, with logs of customers; some logs are unknown and some scenes have no samples."""
    k = F.col("o_orderkey")
    table = B.table(spark, sf, "orders").select(k.alias("scene"), F.concat(F.lit("scene-"), k).alias("name"), F.col("o_custkey").alias("log"))
    logs = B.table(spark, sf, "customer").filter("c_custkey % 6 <> 0").join(B.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("log"), F.col("n_name").alias("location"))
    s = F.col("scene")
    ordered = scenes.order_samples(samples(spark, sf)).withColumns({"x": F.col("x") + s % 50, "y": F.col("y") - s % 30, "heading": F.col("heading") + s % 4 * 0.25})
    rows = scenes.described_scenes(table, logs, ordered, uneven_features(spark, sf))
    told = F.array_join(F.transform(F.array_sort(F.map_entries("skipped")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return rows.select("scene", "name", "location", F.col("samples").cast("int").alias("samples"), "hz", F.col("origin.x").alias("origin_x"), F.col("origin.y").alias("origin_y"), F.col("origin.yaw").alias("origin_yaw"), F.col("lanes").cast("int").alias("lanes"), told.alias("skipped"), F.array_join("notes", "|").alias("notes"))


def _listed(counts: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(counts)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias(counts)


@query(
    FEATURES_SQL.replace("WITH p AS", ", p AS")
    + """, t AS (SELECT scenario_id, string_agg(object_type || '=' || n, ',' ORDER BY object_type) AS told FROM (SELECT scenario_id, object_type, count(DISTINCT track_id) AS n FROM st GROUP BY ALL) GROUP BY scenario_id),
f AS (SELECT scenario_id, string_agg(feature_type || '=' || n, ',' ORDER BY feature_type) AS told FROM (SELECT scenario_id, feature_type, count(*) AS n FROM (SELECT scenario_id, feature_type FROM l UNION ALL SELECT scenario_id, 'lane' FROM scen, lanes) GROUP BY ALL) GROUP BY scenario_id),
g AS (SELECT scenario_id, string_agg(state || '=' || n, ',' ORDER BY state) AS told FROM (SELECT scenario_id, state, count(*) AS n FROM lights WHERE step_index = 10 GROUP BY ALL) GROUP BY scenario_id),
w AS (SELECT scenario_id, count(DISTINCT step_index) AS steps, count(DISTINCT track_id) AS tracks, count(*) FILTER (WHERE valid) AS valid_states FROM st GROUP BY ALL)
SELECT s.scenario_id, 10 AS current_time_index, steps, tracks, valid_states, coalesce(t.told, '') AS tracks_by_type, coalesce(f.told, '') AS features_by_type, coalesce(g.told, '') AS lights_now FROM scen s LEFT JOIN w USING (scenario_id) LEFT JOIN t USING (scenario_id) LEFT JOIN f USING (scenario_id) LEFT JOIN g USING (scenario_id)"""
)
def rev_21_scenario_profile(spark: SparkSession, sf: str) -> DataFrame:
    features = maps.flatten_features(feature_records(spark, sf)).select("scenario_id", "feature_type").union(B.map_features(spark, sf).select("scenario_id", "feature_type"))
    rows = review.scenario_profile(B.agent_states(spark, sf), features, B.traffic_lights(spark, sf), B.scenarios(spark, sf))
    return rows.select("scenario_id", F.col("current_time_index").cast("int").alias("current_time_index"), "steps", "tracks", "valid_states", *map(_listed, ("tracks_by_type", "features_by_type", "lights_now")))


@query("SELECT scenario_id, track_id, min(object_type) AS object_type, count(*) AS steps, count(*) FILTER (WHERE valid) AS valid_steps FROM st GROUP BY ALL")
def rev_21_track_profile(spark: SparkSession, sf: str) -> DataFrame:
    return review.track_profile(B.agent_states(spark, sf))
