"""Named queries, continued: lanes, subjects, temporal rules, policies and the rule pack."""

from __future__ import annotations



from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadsift import binding as B
from roadsift import catalog as C
from roadsift.catalog import PAIR, add, lane_sql, pairs_of, query, r6
from roadsift.operators import align, features, lane_predicates, policy, quality, subjects, temporal
from roadsift.operators.predicates import BUILTIN

REPEATED = {"window_seconds": 3.0, "min_lane_changes": 1, "min_speed_mps": 2.0, "min_stable_duration_seconds": 0.1, "min_lateral_displacement_m": 1.5}


@B.remembered
def repeated_changes(spark: SparkSession, sf: str, args: dict = REPEATED) -> DataFrame:
    rows = lane_predicates.repeated_changes(C.sdc_lanes(spark, sf, 1.5), features.connected_lanes(B.map_features(spark, sf)), args)
    return rows.filter(BUILTIN("sdc_repeated_lane_change", min_lane_changes=args["min_lane_changes"]))


def repeated_sql(changes: int, displacement: float) -> str:
    """Runs of matched lanes within 3 s before each state; lanes 1 and 3 are one."""
    return lane_sql("sdc", "m", 1.5, 0.7) + f""", wide AS (SELECT e.scenario_id, e.step_index, e.track_id, max(p.y) - min(p.y) AS width FROM sdc e JOIN sdc p ON e.scenario_id = p.scenario_id AND p.ts BETWEEN e.ts - 3 AND e.ts GROUP BY ALL),
seen AS (SELECT e.step_index AS anchor, p.* FROM sdc e JOIN m p ON e.scenario_id = p.scenario_id AND p.ts BETWEEN e.ts - 3 AND e.ts WHERE e.speed >= 2),
marked AS (SELECT *, CASE WHEN lag(lane_id) OVER w = lane_id THEN 0 ELSE 1 END AS fresh FROM seen WINDOW w AS (PARTITION BY scenario_id, anchor ORDER BY step_index)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY scenario_id, anchor ORDER BY step_index) AS run FROM marked),
runs AS (SELECT scenario_id, anchor, run, any_value(CASE lane_id WHEN 3 THEN 1 ELSE lane_id END) AS lane, arg_min(y, step_index) AS y0, arg_max(y, step_index) AS y1 FROM numbered GROUP BY ALL HAVING max(ts) - min(ts) + 1e-9 >= 0.1),
folded AS (SELECT *, CASE WHEN lag(lane) OVER w <> lane THEN 1 ELSE 0 END AS changed FROM runs WINDOW w AS (PARTITION BY scenario_id, anchor ORDER BY run)),
repeated AS (SELECT f.scenario_id, anchor AS step_index, '0' AS track_id, CAST(sum(changed) AS INTEGER) AS lane_changes, abs(arg_max(y1, run) - arg_min(y0, run)) AS moved FROM folded f JOIN wide w ON w.scenario_id = f.scenario_id AND w.step_index = anchor
  WHERE width >= {displacement} GROUP BY f.scenario_id, anchor HAVING sum(changed) >= {changes} AND abs(arg_max(y1, run) - arg_min(y0, run)) >= {displacement})
"""


@query(repeated_sql(1, 1.5) + "SELECT scenario_id, step_index, track_id, lane_changes, round(moved, 6) AS lateral_displacement FROM repeated")
def prd_23_sdc_repeated_lane_change(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_changes(spark, sf).select("scenario_id", "step_index", "track_id", "lane_changes", r6("lateral_displacement").alias("lateral_displacement"))


CONFLICT = {"max_front_longitudinal_m": 25.0, "max_behind_longitudinal_m": 20.0, "max_lateral_m": 3.0, "min_target_speed_mps": 1.0, "min_lateral_displacement_m": 1.5, "max_ttc_s": 4.0, "min_closing_speed_mps": 0.5}


def with_other_lane(pairs: DataFrame, spark: SparkSession, sf: str, lateral: float, heading: float = 0.7) -> DataFrame:
    """Pairs of the car with the lane of the other one, of which each frame has one row."""
    others = pairs.withColumns({"x": F.col("other_x"), "y": F.col("other_y"), "heading": F.col("other_heading")})
    lane = features.lane_match(others, C.segments(spark, sf), lateral, heading)
    return lane.select(*pairs.columns, F.col("lane_id").alias("other_lane"))


@B.remembered
def conflict_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The car's lateral motion is checked before it is paired."""
    moved = lane_predicates.ego_lane_move(C.sdc_lanes(spark, sf, 1.8), 3.0).filter("lateral_range >= 1.5 AND matched >= 2 AND first_lane <> last_lane AND moved >= 1.5")
    ego = moved.select("scenario_id", "step_index", "lateral_range", "first_lane", "last_lane", "moved", "matched")
    pairs = subjects.beside(pairs_of(spark, sf).filter("lon <= 25 AND lon >= -20 AND abs(lat) <= 3"), ego, "inner")
    return lane_predicates.conflicts(with_other_lane(pairs, spark, sf, 2.2), CONFLICT).filter(BUILTIN("sdc_lane_change_conflict"))


CONFLICT_SQL = (
    lane_sql("sdc", "m", 1.8, 0.7)
    + lane_sql("ok", "om", 2.2, 0.7)
    + """, ends AS (SELECT e.scenario_id, e.step_index, count(*) AS matched, arg_min(p.lane_id, p.step_index) AS first_lane, arg_max(p.lane_id, p.step_index) AS last_lane, abs(arg_max(p.y, p.step_index) - arg_min(p.y, p.step_index)) AS moved
  FROM sdc e JOIN m p ON e.scenario_id = p.scenario_id AND p.ts BETWEEN e.ts - 3 AND e.ts GROUP BY ALL),
wide AS (SELECT e.scenario_id, e.step_index, max(p.y) - min(p.y) AS width FROM sdc e JOIN sdc p ON e.scenario_id = p.scenario_id AND p.ts BETWEEN e.ts - 3 AND e.ts GROUP BY ALL),
conflict AS (SELECT p.*, CASE WHEN lon >= 0 THEN closing ELSE -closing END AS gain, CASE WHEN lon >= 0 THEN 'front_target' ELSE 'rear_target' END AS conflict_mode
  FROM pairs p JOIN ends USING (scenario_id, step_index) JOIN wide USING (scenario_id, step_index) LEFT JOIN om ON om.scenario_id = p.scenario_id AND om.step_index = p.step_index AND om.track_id = p.other_id
  WHERE matched >= 2 AND first_lane <> last_lane AND moved >= 1.5 AND width >= 1.5 AND other_type = 'vehicle' AND lon <= 25 AND lon >= -20 AND abs(lat) <= 3 AND other_speed >= 1 AND (om.lane_id IS NULL OR om.lane_id = last_lane)
    AND CASE WHEN lon >= 0 THEN closing ELSE -closing END >= 0.5 AND abs(lon) / (CASE WHEN lon >= 0 THEN closing ELSE -closing END) <= 4)
"""
)


@query(CONFLICT_SQL + "SELECT scenario_id, step_index, subject_id, round(abs(lon) / gain, 6) AS ttc, conflict_mode FROM conflict")
def prd_24_sdc_lane_change_conflict(spark: SparkSession, sf: str) -> DataFrame:
    return conflict_pairs(spark, sf).select(*PAIR, r6("ttc").alias("ttc"), "conflict_mode")


def lane_pairs(pairs: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of the car with both lanes, which are looked up in one pass over both sides of the pair's own row; the car's lane comes to the other's row by a window."""
    place = lambda side: F.struct(F.lit(side).alias("side"), *[F.col(f"{side}_{c}").alias(c) for c in ("x", "y", "heading")])
    rows = pairs.withColumn("_pair", F.monotonically_increasing_id()).withColumn("_p", F.explode(F.array(place("ego"), place("other"))))
    lanes = features.lane_match(rows.select(*pairs.columns, "_pair", "_p.*"), C.segments(spark, sf), 1.8, 0.7)
    both = lanes.withColumn("ego_lane", F.max(F.when(F.col("side") == "ego", F.col("lane_id"))).over(Window.partitionBy("scenario_id", "step_index", "_pair"))).filter("side = 'other'")
    return both.select(*pairs.columns, F.col("lane_id").alias("other_lane"), "ego_lane").withColumn("has_map", F.lit(True))


SAME_SQL = (
    lane_sql("ok", "om", 1.8, 0.7)
    + """, same AS (SELECT p.*, a.lane_id AS ego_lane, b.lane_id AS other_lane FROM pairs p LEFT JOIN om a ON a.scenario_id = p.scenario_id AND a.step_index = p.step_index AND a.track_id = p.ego_id
  LEFT JOIN om b ON b.scenario_id = p.scenario_id AND b.step_index = p.step_index AND b.track_id = p.other_id
  WHERE CASE WHEN a.lane_id IS NOT NULL AND b.lane_id IS NOT NULL THEN a.lane_id = b.lane_id WHEN a.lane_id IS NULL AND b.lane_id IS NULL THEN abs(lat) <= 1.2 AND abs(ego_heading - other_heading) <= 0.35 ELSE false END)
"""
)


@query(SAME_SQL + "SELECT scenario_id, step_index, subject_id, ego_lane, other_lane FROM same")
def prd_25_same_lane_or_path(spark: SparkSession, sf: str) -> DataFrame:
    """Each state's lane is looked up once, the car's too, before states are paired."""
    ok = subjects.with_car(subjects.valid_states(B.agent_states(spark, sf)), B.scenarios(spark, sf))
    pairs = subjects.framed_pairs(features.lane_match(ok, C.segments(spark, sf), 1.8, 0.7), both=("lane_id",))
    pairs = pairs.withColumnsRenamed({"ego_lane_id": "ego_lane", "other_lane_id": "other_lane"}).withColumn("has_map", F.lit(True))
    return pairs.filter(BUILTIN("same_lane_or_path")).select(*PAIR, "ego_lane", "other_lane")


# Subjects.


@query("SELECT scenario_id, count(*) AS n, count(*) FILTER (WHERE valid) AS n_valid FROM st GROUP BY ALL")
def sub_01_agent(spark: SparkSession, sf: str) -> DataFrame:
    return B.agent_states(spark, sf).groupBy("scenario_id").agg(F.count("*").alias("n"), F.count_if("valid").alias("n_valid"))


@query("SELECT DISTINCT scenario_id, step_index FROM st")
def sub_02_frame(spark: SparkSession, sf: str) -> DataFrame:
    return B.agent_states(spark, sf).select("scenario_id", "step_index").distinct()


@query("SELECT scenario_id, step_index, light_pos, CAST(lane_id AS VARCHAR) AS subject_id FROM lights")
def sub_03_lane(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.lanes_of(B.traffic_lights(spark, sf))


TURNED_SQL = ", turned AS (SELECT a.scenario_id, a.step_index, a.track_id AS ego_id, b.track_id AS other_id, (b.x - a.x) * cos(a.heading) + (b.y - a.y) * sin(a.heading) AS lon, (b.y - a.y) * cos(a.heading) - (b.x - a.x) * sin(a.heading) AS lat, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS distance FROM ok a JOIN ok b ON a.scenario_id = b.scenario_id AND a.step_index = b.step_index AND a.track_id <> b.track_id)\n"


@query(TURNED_SQL + "SELECT scenario_id, step_index, count(*) AS n, round(sum(lon), 3) + 0 AS lon, round(sum(abs(lat)), 3) AS lat FROM turned GROUP BY ALL")
def sub_04_agent_pair_directed(spark: SparkSession, sf: str) -> DataFrame:
    rows = subjects.agent_pairs(B.agent_states(spark, sf))
    return rows.groupBy("scenario_id", "step_index").agg(F.count("*").alias("n"), F.round(F.sum("lon"), 3).alias("lon"), F.round(F.sum(F.abs("lat")), 3).alias("lat")).withColumn("lon", F.col("lon") + F.lit(0.0))


@query(TURNED_SQL + "SELECT scenario_id, ego_id || ':' || other_id AS subject_id, count(*) AS n, round(min(distance), 6) AS nearest FROM turned WHERE CAST(ego_id AS BIGINT) < CAST(other_id AS BIGINT) GROUP BY ALL")
def sub_05_agent_pair_unordered(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.agent_pairs(B.agent_states(spark, sf), directed=False).groupBy("scenario_id", "subject_id").agg(F.count("*").alias("n"), F.round(F.min("distance"), 6).alias("nearest"))


@query("SELECT scenario_id, step_index, track_id, x, y FROM st WHERE track_id = '0'")
def sub_06_sdc_agent(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.sdc_states(B.agent_states(spark, sf), B.scenarios(spark, sf)).select("scenario_id", "step_index", "track_id", "x", "y")


@query("SELECT scenario_id, step_index, subject_id, lon, lat, closing + 0 AS closing, lat_vel + 0 AS lat_vel FROM pairs")
def sub_07_sdc_pair(spark: SparkSession, sf: str) -> DataFrame:
    return pairs_of(spark, sf).select(*PAIR, "lon", "lat", (F.col("closing") + F.lit(0.0)).alias("closing"), (F.col("lat_vel") + F.lit(0.0)).alias("lat_vel"))


@query(TURNED_SQL + "SELECT scenario_id, step_index, ego_id || ':' || other_id AS subject_id, round(distance, 6) AS distance FROM turned WHERE distance <= 6.1")
def sub_08_candidate_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.near_pairs(B.agent_states(spark, sf), 6.1).select(*PAIR, r6("distance").alias("distance"))


@query("SELECT p.scenario_id, p.step_index, subject_id, round(acceleration, 6) AS acceleration FROM pairs p JOIN motion m ON p.scenario_id = m.scenario_id AND p.step_index = m.step_index AND m.track_id = p.ego_id WHERE acceleration <= -3 AND -speed_delta >= 2 AND start_speed >= 3")
def sub_09_braking_gate(spark: SparkSession, sf: str) -> DataFrame:
    return C.gated_by_braking(B.agent_states(spark, sf), B.scenarios(spark, sf)).select(*PAIR, r6("acceleration").alias("acceleration"))


WIDE_SQL = ", wide AS (SELECT e.scenario_id, e.step_index, e.track_id, max(p.y) - min(p.y) AS width FROM sdc e JOIN sdc p ON e.scenario_id = p.scenario_id AND p.ts BETWEEN e.ts - 3 AND e.ts GROUP BY ALL)\n"


@query(WIDE_SQL + "SELECT scenario_id, step_index, subject_id, round(width, 6) AS lateral_range FROM pairs JOIN wide USING (scenario_id, step_index) WHERE width >= 1.5")
def sub_10_lateral_gate(spark: SparkSession, sf: str) -> DataFrame:
    states = B.agent_states(spark, sf)
    wide = features.lateral_range(subjects.sdc_states(states, B.scenarios(spark, sf)), 3.0).filter("lateral_range >= 1.5")
    return subjects.car_pairs(wide, states, ("lateral_range",)).select(*PAIR, r6("lateral_range").alias("lateral_range"))


@query("SELECT scenario_id, step_index, subject_id FROM pairs p WHERE EXISTS (SELECT 1 FROM pairs q WHERE q.scenario_id = p.scenario_id AND q.subject_id = p.subject_id AND abs(q.lat) <= 1 AND q.lon BETWEEN 0 AND 5)")
def sub_11_allowed_subjects(spark: SparkSession, sf: str) -> DataFrame:
    pairs = pairs_of(spark, sf)
    return subjects.only_subjects(pairs, pairs.filter("abs(lat) <= 1 AND lon BETWEEN 0 AND 5")).select(*PAIR)


# Features.


@query("SELECT scenario_id, step_index, subject_id, round(ego_speed, 6) AS ego_speed, round(other_speed, 6) AS other_speed, round(closing, 6) AS closing, round(distance, 6) AS distance FROM pairs WHERE distance <= 8.1")
def fea_01_kinematics(spark: SparkSession, sf: str) -> DataFrame:
    return pairs_of(spark, sf).filter("distance <= 8.1").select(*PAIR, *[r6(c).alias(c) for c in ("ego_speed", "other_speed", "closing", "distance")])


@query("SELECT scenario_id, track_id, step_index, round(dt, 6) AS dt, round(start_speed, 6) AS start_speed, round(speed_delta, 6) AS speed_delta, round(acceleration, 6) AS acceleration FROM motion WHERE track_id = '0'")
def fea_02_speed_change(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.speed_change(subjects.sdc_states(B.agent_states(spark, sf), B.scenarios(spark, sf)))
    return rows.select("scenario_id", "track_id", "step_index", *[r6(c).alias(c) for c in ("dt", "start_speed", "speed_delta", "acceleration")])


@query("""SELECT scenario_id, track_id, step_index, count(*) OVER w AS observed, count(CASE WHEN speed <= 0.6 THEN 1 END) OVER w AS low_count, coalesce(max(CASE WHEN speed <= 0.6 THEN ts END) OVER w - min(CASE WHEN speed <= 0.6 THEN ts END) OVER w, 0) AS low_seconds,
  round(max(speed) OVER w, 6) AS top_speed, ts - min(ts) OVER w AS span FROM ok WINDOW w AS (PARTITION BY scenario_id, track_id ORDER BY ts RANGE BETWEEN 1.0 PRECEDING AND CURRENT ROW)""")  # fmt: skip
def fea_03_low_speed_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.low_speed_window(B.agent_states(spark, sf), 1.0, 0.6)
    return rows.select("scenario_id", "track_id", "step_index", "observed", "low_count", "low_seconds", r6("top_speed").alias("top_speed"), "span")


@query(WIDE_SQL + "SELECT scenario_id, step_index, track_id, round(width, 6) AS lateral_range FROM wide")
def fea_04_lateral_range(spark: SparkSession, sf: str) -> DataFrame:
    return features.lateral_range(subjects.sdc_states(B.agent_states(spark, sf), B.scenarios(spark, sf)), 3.0).select("scenario_id", "step_index", "track_id", r6("lateral_range").alias("lateral_range"))


@query("SELECT e.scenario_id, e.step_index, min(stop_x - e.x) AS red_lon FROM sdc e JOIN red r USING (scenario_id, step_index) WHERE stop_x - e.x BETWEEN 0 AND 40 AND abs(stop_y - e.y) <= 4 GROUP BY ALL")
def fea_05_red_stop_ahead(spark: SparkSession, sf: str) -> DataFrame:
    ego = C.sdc_ok(spark, sf).select("scenario_id", "step_index", F.col("track_id").alias("ego_id"), F.col("x").alias("ego_x"), F.col("y").alias("ego_y"), F.col("heading").alias("ego_heading"))
    return features.red_stop_ahead(ego, B.traffic_lights(spark, sf), 40.0, 4.0).filter("red_lon IS NOT NULL").select("scenario_id", "step_index", "red_lon")


RED_STOPS = "(SELECT DISTINCT scenario_id, lane_id, stop_x, stop_y FROM red SEMI JOIN scen USING (scenario_id))"


@query(f"SELECT scenario_id, lane_id, stop_x, stop_y, CAST(1 AS DOUBLE) AS dir_x, CAST(0 AS DOUBLE) AS dir_y FROM {RED_STOPS}")
def fea_06_lane_direction(spark: SparkSession, sf: str) -> DataFrame:
    return C.red_lanes(spark, sf).select("scenario_id", "lane_id", "stop_x", "stop_y", "dir_x", "dir_y").distinct()


@query(f"SELECT scenario_id, lane_id, stop_x, stop_y, CAST(0 AS DOUBLE) AS lane_turn FROM {RED_STOPS}")
def fea_07_lane_turn(spark: SparkSession, sf: str) -> DataFrame:
    return C.red_lanes(spark, sf).select("scenario_id", "lane_id", "stop_x", "stop_y", "lane_turn").distinct()


@query("SELECT scenario_id, track_id, step_index, round(abs(heading - last_value(heading) OVER (PARTITION BY scenario_id, track_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND 2.000001 FOLLOWING)), 6) AS heading_change FROM ok")
def fea_08_future_heading(spark: SparkSession, sf: str) -> DataFrame:
    return features.heading_ahead(B.agent_states(spark, sf), 2.0).select("scenario_id", "track_id", "step_index", r6("heading_change").alias("heading_change"))


@query("SELECT scenario_id, step_index, light_pos, lane_id, stop_x, stop_y FROM red SEMI JOIN scen USING (scenario_id)")
def fea_09_red_lanes(spark: SparkSession, sf: str) -> DataFrame:
    return C.red_lanes(spark, sf).select("scenario_id", "step_index", "light_pos", "lane_id", "stop_x", "stop_y")


@query("SELECT scenario_id, CAST(lane_id AS BIGINT) AS lane_id, CAST(xa + 20 * i AS DOUBLE) AS x0, CAST(20 AS DOUBLE) AS length, CAST(20 * i AS DOUBLE) AS s_before FROM scen, lanes, (SELECT range AS i FROM range(8)) WHERE xa + 20 * i < xb")
def fea_10_lane_segments(spark: SparkSession, sf: str) -> DataFrame:
    return C.segments(spark, sf).select("scenario_id", "lane_id", "x0", "length", "s_before")


@query(lane_sql("ok", "om", 1.8, 0.7) + "SELECT scenario_id, step_index, track_id, lane_id, round(off, 6) AS lateral FROM om")
def fea_11_lane_match(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.lane_match(subjects.valid_states(B.agent_states(spark, sf)), C.segments(spark, sf), 1.8, 0.7).filter("lane_id IS NOT NULL")
    return rows.select("scenario_id", "step_index", "track_id", "lane_id", r6("lane_lateral").alias("lateral"))


@query("SELECT scenario_id, CAST(a AS BIGINT) AS from_lane, CAST(b AS BIGINT) AS to_lane FROM scen, (VALUES (1, 3), (3, 1)) v(a, b)")
def fea_12_connected_lanes(spark: SparkSession, sf: str) -> DataFrame:
    return features.connected_lanes(B.map_features(spark, sf))


# Temporal rules over the derived tag events.

EV_T = ", tag AS (SELECT DISTINCT scenario_id, subject_id, frame_index, frame_index * CAST(0.125 AS DOUBLE) AS ts, tag_name FROM ev)\n"
ISLES = ", one AS (SELECT scenario_id, subject_id, frame_index, ts, frame_index - row_number() OVER (PARTITION BY scenario_id, subject_id ORDER BY frame_index) AS isle FROM tag WHERE tag_name = 'view')\n"


@B.remembered
def wide_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tag events with one subject a scenario, so that tags follow each other."""
    return B.tag_events(spark, sf).withColumn("subject_id", F.lit("all"))


ALL_T = ", tag AS (SELECT DISTINCT scenario_id, 'all' AS subject_id, frame_index, frame_index * CAST(0.125 AS DOUBLE) AS ts, tag_name FROM ev)\n"


@query(ALL_T + ISLES + "SELECT scenario_id, subject_id, frame_index, ts, CAST(frame_index - 1 AS INTEGER) AS first_frame, frame_index AS last_frame FROM (SELECT *, row_number() OVER (PARTITION BY scenario_id, isle ORDER BY frame_index) AS n FROM one) WHERE n >= 2")
def tmp_01_sustained_frames(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.sustained_frames(wide_tags(spark, sf), "view", 2)


@query(ALL_T + ISLES + "SELECT a.scenario_id, a.subject_id, a.frame_index, a.ts, b.frame_index AS first_frame, a.frame_index AS last_frame FROM one a JOIN one b ON a.scenario_id = b.scenario_id AND a.isle = b.isle AND a.ts - b.ts = 0.125")
def tmp_02_sustained_seconds(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.sustained_seconds(wide_tags(spark, sf), "view", 0.125)


def chain_sql(tags: list[str], low: str, gap: int | None = None) -> str:
    """Greedy chains by successive joins: each step takes the earliest frame that fits."""
    out = f", c_end AS (SELECT scenario_id, subject_id, frame_index AS anchor, ts AS anchor_ts FROM tag WHERE tag_name = '{tags[-1]}')"
    before = "c_end"
    for k, t in enumerate(tags):
        first = "a.first_frame" if k else "min(b.frame_index)"
        keep = ", a.first_frame" if k else ""
        after = "AND b.frame_index >= a.place" if k else ""
        having = f"HAVING min(b.frame_index) - a.place - 1 <= {gap}" if gap is not None and k else ""
        at = ", a.place" if k else ""
        out += f", c{k} AS (SELECT a.scenario_id, a.subject_id, a.anchor, a.anchor_ts, {first} AS first_frame, min(b.frame_index) AS place FROM {before} a JOIN tag b ON a.scenario_id = b.scenario_id AND a.subject_id = b.subject_id AND b.tag_name = '{t}' AND {low} AND b.frame_index <= a.anchor {after} GROUP BY a.scenario_id, a.subject_id, a.anchor, a.anchor_ts{at}{keep} {having})"
        before = f"c{k}"
    return out + "\n"


CHAIN = ["signup", "click", "purchase"]
CHAIN_OUT = "SELECT scenario_id, subject_id, anchor AS frame_index, anchor_ts AS ts, first_frame, place AS last_frame FROM c2"


@query(ALL_T + chain_sql(CHAIN, "b.frame_index >= a.anchor - 6") + CHAIN_OUT)
def tmp_03_sequence_frames(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.sequence(wide_tags(spark, sf), CHAIN, frames=6).drop("chain")


@query(ALL_T + chain_sql(CHAIN, "b.ts >= a.anchor_ts - 1.0", 2) + CHAIN_OUT)
def tmp_04_sequence_seconds(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.sequence(wide_tags(spark, sf), CHAIN, seconds=1.0, max_gap_frames=2).drop("chain")


@query(ALL_T + ISLES + """, det AS (SELECT scenario_id, frame_index, frame_index - 1 AS first_frame FROM (SELECT *, row_number() OVER (PARTITION BY scenario_id, isle ORDER BY frame_index) AS n FROM one) WHERE n >= 2)
SELECT d.scenario_id, d.frame_index, string_agg(CAST(o.frame_index AS VARCHAR), ',' ORDER BY o.frame_index) AS supporting FROM det d JOIN one o ON o.scenario_id = d.scenario_id AND o.frame_index BETWEEN d.first_frame AND d.frame_index GROUP BY ALL""")  # fmt: skip
def tmp_05_temporal_event(spark: SparkSession, sf: str) -> DataFrame:
    tags = wide_tags(spark, sf)
    rows = temporal.supporting(temporal.sustained_frames(tags, "view", 2), tags, "view")
    return rows.select("scenario_id", "frame_index", F.array_join(F.col("supporting_frames").cast("array<string>"), ",").alias("supporting"))


@query(ALL_T + chain_sql(CHAIN, "b.ts >= a.anchor_ts - 1.0") + "SELECT c.scenario_id, c.anchor AS frame_index, CAST(sum(e.review_priority) AS BIGINT) AS support FROM c2 c JOIN ev e ON e.scenario_id = c.scenario_id AND e.frame_index BETWEEN c.first_frame AND c.place GROUP BY ALL")
def tmp_06_supporting_metadata(spark: SparkSession, sf: str) -> DataFrame:
    tags = wide_tags(spark, sf)
    found = temporal.sequence(tags, CHAIN, seconds=1.0).select("scenario_id", "frame_index", F.explode(F.sequence("first_frame", "last_frame")).alias("at"))
    return found.join(tags.select("scenario_id", F.col("frame_index").alias("at"), "review_priority"), ["scenario_id", "at"]).groupBy("scenario_id", "frame_index").agg(F.sum("review_priority").alias("support"))


@query(EV_T + "SELECT scenario_id, subject_id, frame_index FROM tag t WHERE tag_name = 'purchase' AND EXISTS (SELECT 1 FROM tag p WHERE p.scenario_id = t.scenario_id AND p.subject_id = t.subject_id AND p.tag_name = 'signup')")
def tmp_07_candidate_gating(spark: SparkSession, sf: str) -> DataFrame:
    tags = B.tag_events(spark, sf)
    return temporal.gated(tags.filter("tag_name = 'purchase'"), tags, "signup").select("scenario_id", "subject_id", "frame_index")


@query(EV_T + "SELECT scenario_id, tag_name, subject_id, string_agg(CAST(frame_index AS VARCHAR), ',' ORDER BY frame_index) AS frames FROM tag GROUP BY ALL")
def tmp_08_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.timeline(B.tag_events(spark, sf)).select("scenario_id", "tag_name", "subject_id", F.array_join(F.col("frames").cast("array<string>"), ",").alias("frames"))


# Policies.


def merged_sql(source: str, gap: int, name: str) -> str:
    return f""", {name}_n AS (SELECT *, CASE WHEN frame_index <= lag(frame_index) OVER w + {gap} THEN 0 ELSE 1 END AS fresh FROM {source} WINDOW w AS (PARTITION BY scenario_id, tag_name, rule_id, subject_type, subject_id ORDER BY frame_index)),
{name}_r AS (SELECT *, sum(fresh) OVER (PARTITION BY scenario_id, tag_name, rule_id, subject_type, subject_id ORDER BY frame_index) AS run FROM {name}_n),
{name} AS (SELECT scenario_id, tag_name, rule_id, subject_type, subject_id, min(frame_index) AS frame_index, max(frame_index) AS end_frame, count(*) AS event_count, string_agg(CAST(frame_index AS VARCHAR), ',' ORDER BY frame_index) AS raw_frames,
  any_value(intent) AS intent, any_value(review_family) AS review_family, arg_min(review_priority, frame_index) AS review_priority FROM {name}_r GROUP BY scenario_id, tag_name, rule_id, subject_type, subject_id, run)
"""


def raw_frames() -> Column:
    return F.array_join(F.col("raw_frames").cast("array<string>"), ",").alias("raw_frames")


EVENT = ["scenario_id", "tag_name", "subject_id", "frame_index"]


@query(", quiet AS (SELECT * REPLACE ('all' AS subject_id) FROM ev WHERE intent <> 'review')\n" + merged_sql("quiet", 1, "i") + "SELECT scenario_id, tag_name, subject_id, frame_index, end_frame, event_count, raw_frames FROM i UNION ALL SELECT scenario_id, tag_name, 'all', frame_index, frame_index, 1, CAST(frame_index AS VARCHAR) FROM ev WHERE intent = 'review'")
def pol_01_compaction(spark: SparkSession, sf: str) -> DataFrame:
    return policy.compact(wide_tags(spark, sf)).select(*EVENT, "end_frame", "event_count", raw_frames())


@query(", loud AS (SELECT * FROM ev WHERE intent = 'review')\n" + merged_sql("loud", 4, "i") + "SELECT scenario_id, tag_name, subject_id, frame_index, end_frame, event_count, raw_frames FROM i")
def pol_02_episodes(spark: SparkSession, sf: str) -> DataFrame:
    return policy.episodes(B.tag_events(spark, sf).filter("intent = 'review'"), 4).select(*EVENT, "end_frame", "event_count", raw_frames())


def cool_sql(source: str, frames: int) -> str:
    """The fold as a recursion from each kept event to the next one after its silence."""
    return f"""SELECT * FROM (WITH RECURSIVE k AS (
  SELECT scenario_id, tag_name, subject_type, subject_id, min(frame_index) AS frame_index FROM {source} GROUP BY ALL
  UNION ALL
  SELECT k.scenario_id, k.tag_name, k.subject_type, k.subject_id, (SELECT min(e.frame_index) FROM {source} e WHERE e.scenario_id = k.scenario_id AND e.tag_name = k.tag_name AND e.subject_id = k.subject_id AND e.frame_index > k.frame_index + {frames})
  FROM k WHERE k.frame_index IS NOT NULL)
SELECT scenario_id, tag_name, subject_id, frame_index, frame_index + {frames} AS suppressed_until FROM k WHERE frame_index IS NOT NULL)"""


@query(cool_sql("ev", 6))
def pol_03_cooldown(spark: SparkSession, sf: str) -> DataFrame:
    return policy.cooldown(B.tag_events(spark, sf), 6).select(*EVENT, "suppressed_until")


DOMINANT = """, ranked AS (SELECT *, row_number() OVER (PARTITION BY scenario_id, subject_type, subject_id, review_family ORDER BY review_priority DESC, frame_index, tag_name, rule_id) AS n FROM i WHERE review_family IS NOT NULL),
kept AS (SELECT r.* FROM ranked r JOIN ranked b ON b.n = 1 AND r.scenario_id = b.scenario_id AND r.subject_id = b.subject_id AND r.review_family = b.review_family WHERE r.n = 1 OR NOT (r.frame_index <= b.end_frame AND r.end_frame >= b.frame_index))
"""


@query(", loud AS (SELECT * FROM ev WHERE intent = 'review')\n" + merged_sql("loud", 4, "i") + DOMINANT + "SELECT scenario_id, tag_name, subject_id, frame_index, end_frame, review_priority FROM kept")
def pol_04_dominance(spark: SparkSession, sf: str) -> DataFrame:
    rows = policy.dominance(policy.episodes(B.tag_events(spark, sf).filter("intent = 'review'"), 4))
    return rows.select(*EVENT, "end_frame", "review_priority")


@query(", loud AS (SELECT * FROM ev WHERE intent = 'review')\n" + merged_sql("loud", 4, "j") + ", i AS (SELECT * FROM j SEMI JOIN (" + cool_sql("j", 4) + ") USING (scenario_id, tag_name, subject_id, frame_index))\n" + DOMINANT + "SELECT scenario_id, tag_name, subject_id, frame_index, end_frame, review_priority FROM kept")
def pol_05_chained(spark: SparkSession, sf: str) -> DataFrame:
    events = policy.episodes(B.tag_events(spark, sf).filter("intent = 'review'"), 4)
    return policy.dominance(policy.cooldown(events, 4)).select(*EVENT, "end_frame", "review_priority")


# Quality and alignment.

JUMPS = """, q AS (SELECT *, lag(valid) OVER w AS pv, lag(step_index) OVER w AS ps, lag(ts) OVER w AS pt, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(heading) OVER w AS ph, lag(sqrt(vx * vx + vy * vy)) OVER w AS pspeed, sqrt(vx * vx + vy * vy) AS speed
  FROM st WINDOW w AS (PARTITION BY scenario_id, track_id ORDER BY step_index)), qq AS (SELECT *, sqrt((x - px) * (x - px) + (y - py) * (y - py)) / (ts - pt) AS jump, abs(speed - pspeed) / (ts - pt) AS acc, abs(heading - ph) AS turn FROM q WHERE valid AND pv)
"""


def _issues(kind: str, column: str, limit: float, **args: float) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return quality.quality_issues(B.agent_states(spark, sf), **args, kinds=(kind,)).select("scenario_id", "track_id", "step_index", "previous_step", r6("value").alias("value"))

    number = {"jump_speed": 1, "acceleration_jump": 2, "heading_jump": 3}[kind]
    add(f"qlt_0{number}_{kind}", run, JUMPS + f"SELECT scenario_id, track_id, step_index, ps AS previous_step, round({column}, 6) AS value FROM qq WHERE {column} > {limit}")


_issues("jump_speed", "jump", 14.3, jump=14.3)
_issues("acceleration_jump", "acc", 5.3, acceleration=5.3)
_issues("heading_jump", "turn", 1.6)


TURNING = JUMPS.replace("FROM st WINDOW", "FROM (SELECT * REPLACE (heading + CASE WHEN (step_index + track_index * 3) % 7 = 0 THEN 2.0 WHEN (step_index + track_index) % 5 = 0 THEN 6.0 ELSE 0 END AS heading) FROM st) WINDOW")


@query(TURNING + "SELECT scenario_id, track_id, step_index, ps AS previous_step, round(CASE WHEN turn > pi() THEN 2 * pi() - turn ELSE turn END, 6) AS value FROM qq WHERE CASE WHEN turn > pi() THEN 2 * pi() - turn ELSE turn END > 1.6")
def qlt_03_heading_jump_of_turning(spark: SparkSession, sf: str) -> DataFrame:
    """Heading jumps, the short way round, of tracks that turn now and then."""
    i, k = F.col("step_index"), F.col("track_index")
    states = B.agent_states(spark, sf).withColumn("heading", F.col("heading") + F.when((i + k * 3) % 7 == 0, 2.0).when((i + k) % 5 == 0, 6.0).otherwise(0.0))
    return quality.quality_issues(states, kinds=("heading_jump",)).select("scenario_id", "track_id", "step_index", "previous_step", r6("value").alias("value"))


@query(JUMPS + "SELECT issue_type, count(*) AS n FROM (SELECT 'jump_speed' AS issue_type FROM qq WHERE jump > 10.3 UNION ALL SELECT 'acceleration_jump' FROM qq WHERE acc > 4.3) GROUP BY ALL")
def qlt_04_annotator(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_issues(B.agent_states(spark, sf), 10.3, 4.3).groupBy("issue_type").agg(F.count("*").alias("n"))


@query("SELECT scenario_id, step_index, CASE WHEN step_index < 10 THEN 'observed' WHEN step_index = 10 THEN 'current' ELSE 'future' END AS visibility FROM scen, steps WHERE step_index BETWEEN 4 AND 13")
def aln_01_causal(spark: SparkSession, sf: str) -> DataFrame:
    return align.causal(sub_02_frame(spark, sf), B.scenarios(spark, sf), 6, 3)


@query("SELECT scenario_id, step_index, 'current' AS visibility, 'offline_full_scene' AS evaluation_mode FROM scen, steps")
def aln_02_full_scene(spark: SparkSession, sf: str) -> DataFrame:
    return align.full_scene(sub_02_frame(spark, sf))


MODES = ", modes AS (SELECT scenario_id, step_index, scenario_id IN (SELECT o_orderkey FROM orders) AS lit FROM scen, steps)\n"


@query(MODES + "SELECT scenario_id, step_index, 'agents,lane_geometry,map,' || CASE WHEN lit THEN 'traffic_lights,' ELSE '' END || 'valid_agents' AS modalities FROM modes")
def aln_03_modalities(spark: SparkSession, sf: str) -> DataFrame:
    rows = align.modalities(B.agent_states(spark, sf), B.traffic_lights(spark, sf), B.map_features(spark, sf))
    return rows.select("scenario_id", "step_index", F.array_join("modalities", ",").alias("modalities"))


@query(MODES + "SELECT scenario_id, step_index, 'agents,lane_geometry,' || CASE WHEN scenario_id % 3 = 0 AND step_index <= 10 THEN 'lidar,' ELSE '' END || 'map,' || CASE WHEN lit THEN 'traffic_lights,' ELSE '' END || 'valid_agents' AS modalities FROM modes")
def aln_03_modalities_with_lidar(spark: SparkSession, sf: str) -> DataFrame:
    scenarios = B.scenarios(spark, sf).withColumn("has_lidar_data", F.col("scenario_id") % 3 == 0)
    rows = align.modalities(B.agent_states(spark, sf), B.traffic_lights(spark, sf), B.map_features(spark, sf), scenarios)
    return rows.select("scenario_id", "step_index", F.array_join("modalities", ",").alias("modalities"))


@query("SELECT s.scenario_id, CASE WHEN bool_or(track_index = 3) THEN 'never_valid' ELSE 'no_track' END AS problem FROM scen s JOIN st USING (scenario_id) GROUP BY ALL HAVING NOT bool_or(track_index = 3 AND step_index = 10 AND valid)")
def aln_04_unresolved(spark: SparkSession, sf: str) -> DataFrame:
    """Scenarios whose fourth track isn't valid in the current frame."""
    states = B.agent_states(spark, sf)
    return align.without_sdc(B.scenarios(spark, sf), states, 3, align.sdc_track(states, 3, causal_step=B.CURRENT))


@query("SELECT scenario_id, arg_min(track_id, step_index) AS sdc_track_id FROM st WHERE track_index = 1 AND valid GROUP BY ALL")
def aln_04_sdc_track(spark: SparkSession, sf: str) -> DataFrame:
    return align.sdc_track(B.agent_states(spark, sf), 1)


@query(MODES + "SELECT scenario_id, step_index FROM modes WHERE lit AND step_index = 10")
def aln_05_applies(spark: SparkSession, sf: str) -> DataFrame:
    rows = align.modalities(B.agent_states(spark, sf), B.traffic_lights(spark, sf), B.map_features(spark, sf))
    seen = align.causal(rows, B.scenarios(spark, sf), 10, 5)
    return seen.filter(align.applies(["traffic_lights", "lane_geometry"], current_only=True)).select("scenario_id", "step_index")



