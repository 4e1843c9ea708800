"""Named queries of the rule pack and of whole runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsift import binding as B
from roadsift import catalog as C
from roadsift import catalog_rules as R
from roadsift.catalog import add, pairs_of, query, r6
from roadsift.catalog_rules import chain_sql, cool_sql, merged_sql
from roadsift.operators import light_predicates, policy, temporal
from roadsift.operators.predicates import BUILTIN
from roadsift.plans import evaluate, pack

SEEN = "step_index <= 10"
"""Rules look at the frames up to the current one."""
EVENT_OUT = ["scenario_id", "frame_index", "tag_name", "subject_id"]
LANE_FREE = f"ego_type = 'vehicle' AND other_type = 'vehicle' AND {SEEN}"
COND = {
    "cut_in_candidate": "abs(lat) <= 3 AND abs(lon) <= 10 AND CASE WHEN lat > 0 THEN lat_vel < -0.2 ELSE lat_vel > 0.2 END AND abs(ego_heading - other_heading) BETWEEN 0.05 AND 0.5",
    "adjacent_vehicle": "abs(lat) BETWEEN 1.5 AND 4.5 AND abs(lon) <= 15",
    "cut_in_lateral_approach": "ego_speed > 0.5 AND other_speed > 0.5 AND abs(lat) BETWEEN 1 AND 4.5 AND abs(lon) <= 15 AND CASE WHEN lat > 0 THEN lat_vel < -0.2 ELSE lat_vel > 0.2 END AND abs(ego_heading - other_heading) <= 0.7",
    "same_path_overlap": "ego_speed > 0.5 AND abs(lat) <= 1.2 AND lon BETWEEN 0 AND 20",
}
TTC_COND = "ego_speed > 0.5 AND lon >= 1 AND lon <= 60 AND abs(lat) <= 2 AND closing >= 1 AND lon / closing < 3"

# All events of the pack's pair rules: tag has one row a tag, subject and frame.
PACK_SQL = (
    R.SAME_SQL
    + ", tag0 AS ("
    + " UNION ALL ".join(f"SELECT scenario_id, subject_id, step_index AS frame_index, ts, '{t}' AS tag_name FROM pairs WHERE {LANE_FREE} AND {c}" for t, c in COND.items())
    + f" UNION ALL SELECT scenario_id, subject_id, step_index, ts, 'low_ttc_pair' FROM same WHERE {LANE_FREE} AND {TTC_COND}),\n"
    + """approach AS (SELECT * FROM tag0 t WHERE tag_name = 'cut_in_lateral_approach' AND EXISTS (SELECT 1 FROM tag0 p WHERE p.tag_name = 'adjacent_vehicle' AND p.scenario_id = t.scenario_id AND p.subject_id = t.subject_id)),
overlap AS (SELECT * FROM tag0 t WHERE tag_name = 'same_path_overlap' AND EXISTS (SELECT 1 FROM approach p WHERE p.scenario_id = t.scenario_id AND p.subject_id = t.subject_id)),
tag AS (SELECT * FROM tag0 WHERE tag_name NOT IN ('cut_in_lateral_approach', 'same_path_overlap') UNION ALL SELECT * FROM approach UNION ALL SELECT * FROM overlap)
"""
)


@B.remembered
def seen_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs_of(spark, sf).filter(SEEN)


@B.remembered
def low_ttc_events(spark: SparkSession, sf: str) -> DataFrame:
    """Cheap conditions first; lanes are matched for the pairs that are left."""
    cheap = F.lit(True)
    for name, args in pack.LOW_TTC.conditions[:-1]:
        cheap = cheap & BUILTIN(name, **args)
    rows = R.lane_pairs(seen_pairs(spark, sf).filter(cheap), spark, sf).filter(BUILTIN("same_lane_or_path"))
    return pack.tagged(rows.withColumn("frame_index", F.col("step_index")), pack.LOW_TTC)


@B.remembered
def pair_events(spark: SparkSession, sf: str, *tags: str) -> DataFrame:
    """Events of single-frame pair rules, later sequence steps gated: of the given tags alone, and of no rule that these don't need."""
    gates, wanted, todo = pack.gates(pack.TEMPORAL), set(), list(tags)
    while todo:
        tag = todo.pop()
        wanted.add(tag)
        todo += sorted(gates.get(tag, set()) - wanted)
    rules, rows = [r for r in pack.pair_rules() if r.tag in wanted], []
    if rules:
        found = pack.single_frame(seen_pairs(spark, sf), rules)
        rows.append((pack.gate_sequences(found) if wanted & set(gates) else found).filter(F.col("tag_name").isin(*tags)))
    if "low_ttc_pair" in tags:
        rows.append(low_ttc_events(spark, sf))
    return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])


PAIR_TAGS = ("low_ttc_pair", "cut_in_candidate", "adjacent_vehicle", "cut_in_lateral_approach", "same_path_overlap")


def _single(tag: str, rule: pack.Rule | None) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return pair_events(spark, sf, tag).select(*EVENT_OUT)

    add(f"rule_{tag}", run, PACK_SQL + f"SELECT scenario_id, frame_index, tag_name, subject_id FROM tag WHERE tag_name = '{tag}'")


for _tag in PAIR_TAGS:
    _single(_tag, None)


def sustained_sql(tag: str, source: str = "tag") -> str:
    return f""", s_one AS (SELECT scenario_id, subject_id, frame_index, ts, frame_index - row_number() OVER (PARTITION BY scenario_id, subject_id ORDER BY frame_index) AS isle FROM {source} WHERE tag_name = '{tag}'),
s_hit AS (SELECT a.scenario_id, a.subject_id, a.frame_index, b.frame_index AS first_frame FROM s_one a JOIN s_one b ON a.scenario_id = b.scenario_id AND a.subject_id = b.subject_id AND a.isle = b.isle AND a.ts - b.ts = 0.25)
"""


def as_found(tag: str, source: str, frame: str = "frame_index", family: str = "NULL", priority: str = "NULL") -> str:
    return f", found AS (SELECT scenario_id, '{tag}' AS tag_name, '{tag}' AS rule_id, 'agent_pair' AS subject_type, subject_id, {frame} AS frame_index, 'review' AS intent, CAST({family} AS VARCHAR) AS review_family, CAST({priority} AS INTEGER) AS review_priority FROM {source})\n"


def sources_of(rule: pack.Rule) -> tuple[str, ...]:
    return (rule.sustained[0],) if rule.sustained else rule.steps


def detections(spark: SparkSession, sf: str, rule: pack.Rule) -> DataFrame:
    return pack.tagged(pack.temporal_events(pair_events(spark, sf, *sources_of(rule)), rule), rule)


#: Frames of the tables here are 1/8 s apart.
RULES = pack.on_grid(pack.all_rules(), B.STEP_S)
BY_TAG = {r.tag: r for r in RULES if r.sustained or r.steps}
EPISODE_OUT = ["scenario_id", "subject_id", "frame_index", "end_frame", "event_count"]


@query(PACK_SQL + sustained_sql("low_ttc_pair") + as_found("persistent_low_ttc_pair", "s_hit") + merged_sql("found", 1, "i") + "SELECT scenario_id, subject_id, frame_index, end_frame, event_count FROM i")
def rule_persistent_low_ttc_pair(spark: SparkSession, sf: str) -> DataFrame:
    return policy.episodes(detections(spark, sf, BY_TAG["persistent_low_ttc_pair"])).select(*EPISODE_OUT)


@query(PACK_SQL + sustained_sql("cut_in_candidate") + "SELECT scenario_id, subject_id, frame_index, first_frame FROM s_hit")
def rule_cut_in_developing(spark: SparkSession, sf: str) -> DataFrame:
    return pack.temporal_events(pair_events(spark, sf, "cut_in_candidate"), BY_TAG["cut_in_developing"]).select("scenario_id", "subject_id", "frame_index", "first_frame")


def _sequence(tag: str) -> None:
    rule = BY_TAG[tag]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return policy.episodes(detections(spark, sf, rule)).select(*EPISODE_OUT)

    last = f"c{len(rule.steps) - 1}"
    add(f"rule_{tag}", run, PACK_SQL + chain_sql(list(rule.steps), "b.ts >= a.anchor_ts - 0.8") + as_found(tag, last, "anchor") + merged_sql("found", 1, "i") + "SELECT scenario_id, subject_id, frame_index, end_frame, event_count FROM i")


_sequence("cut_in_confirmed")
_sequence("cut_in_risk")

# Rules over the car alone.


@B.remembered
def sdc_stopped(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.sdc_ok(spark, sf).filter(SEEN)
    for name, args in pack.STOPPED:
        rows = rows.filter(BUILTIN(name, **args))
    return rows


def agent_events(rows: DataFrame, tag: str, intent: str = "debug") -> DataFrame:
    return pack.tagged(rows.withColumns({"frame_index": F.col("step_index"), "subject_id": F.col("track_id")}), pack.Rule(tag, "sdc_agent", intent=intent))


STOP_SQL = f""", stopped AS (SELECT * FROM sdc WHERE {SEEN} AND speed < 0.5),
at_red AS (SELECT * FROM stopped s WHERE EXISTS (SELECT 1 FROM red r WHERE r.scenario_id = s.scenario_id AND r.step_index = s.step_index AND sqrt((s.x - stop_x) * (s.x - stop_x) + (s.y - stop_y) * (s.y - stop_y)) <= 5)),
tag AS (SELECT scenario_id, track_id AS subject_id, step_index AS frame_index, ts, 'sdc_vehicle_stopped' AS tag_name FROM stopped UNION ALL SELECT scenario_id, track_id, step_index, ts, 'sdc_vehicle_stopped_at_red' FROM at_red)
"""


@B.remembered
def stopped_at_red(spark: SparkSession, sf: str) -> DataFrame:
    return light_predicates.near_red_stop(sdc_stopped(spark, sf), B.traffic_lights(spark, sf), 5.0).filter(BUILTIN("near_red_light_stop_point"))


def _stop_rules(tag: str, still: str, rows) -> None:  # noqa: ANN001
    quiet = f", q AS (SELECT scenario_id, tag_name, tag_name AS rule_id, 'agent' AS subject_type, subject_id, frame_index, 'debug' AS intent, NULL AS review_family, CAST(NULL AS INTEGER) AS review_priority FROM tag WHERE tag_name = '{tag}')\n"

    def single(spark: SparkSession, sf: str) -> DataFrame:
        return policy.compact(agent_events(rows(spark, sf), tag)).select(*EPISODE_OUT)

    def held(spark: SparkSession, sf: str) -> DataFrame:
        return temporal.sustained_seconds(agent_events(rows(spark, sf), tag), *BY_TAG[still].sustained).select("scenario_id", "subject_id", "frame_index", "first_frame")

    add(f"rule_{tag}", single, STOP_SQL + quiet + merged_sql("q", 1, "i") + "SELECT scenario_id, subject_id, frame_index, end_frame, event_count FROM i")
    add(f"rule_{still}", held, STOP_SQL + sustained_sql(tag) + "SELECT scenario_id, subject_id, frame_index, first_frame FROM s_hit")


_stop_rules("sdc_vehicle_stopped", "sdc_vehicle_stopped_for_3_frames", sdc_stopped)
_stop_rules("sdc_vehicle_stopped_at_red", "sdc_vehicle_still_stopped_at_red", stopped_at_red)


@query(C.LINE_SQL + f"SELECT scenario_id, step_index AS frame_index, track_id AS subject_id, lane_id FROM before_line WHERE {SEEN} AND speed >= 0.5 AND abs(heading) <= 0.7 {C.FIRST_LIGHT}")
def rule_red_light_stop_line_approach(spark: SparkSession, sf: str) -> DataFrame:
    return C.before_line(spark, sf).filter(SEEN).select("scenario_id", F.col("step_index").alias("frame_index"), F.col("track_id").alias("subject_id"), "lane_id")


@query(C.LINE_SQL + f"SELECT scenario_id, step_index AS frame_index, track_id AS subject_id, lane_id FROM after_line WHERE {SEEN} {C.FIRST_LIGHT}")
def rule_red_light_stop_line_crossed(spark: SparkSession, sf: str) -> DataFrame:
    return C.after_line(spark, sf).filter(SEEN).select("scenario_id", F.col("step_index").alias("frame_index"), F.col("track_id").alias("subject_id"), "lane_id")


def review_sql(tag: str, source: str, subject: str, gap: int, extra: str = "") -> str:
    """Episodes and cooldown of a review rule over the rows of a source."""
    found = f", found AS (SELECT DISTINCT scenario_id, '{tag}' AS tag_name, '{tag}' AS rule_id, 'agent' AS subject_type, {subject} AS subject_id, step_index AS frame_index, 'review' AS intent, NULL AS review_family, CAST(NULL AS INTEGER) AS review_priority FROM {source} WHERE {SEEN} {extra})\n"
    return found + merged_sql("found", gap, "i") + f"SELECT scenario_id, subject_id, frame_index, end_frame, event_count FROM i SEMI JOIN ({cool_sql('i', gap)}) USING (scenario_id, tag_name, subject_id, frame_index)"


def reviewed(rows: DataFrame, tag: str, subject: str, gap: int) -> DataFrame:
    events = pack.tagged(rows.filter(SEEN).withColumns({"frame_index": F.col("step_index"), "subject_id": F.col(subject), "ts": F.col("step_index") * B.STEP_S}), pack.Rule(tag, "sdc_pair", intent="review"))
    return policy.cooldown(policy.episodes(events, gap), gap).select(*EPISODE_OUT)


CROSSED_SQL = C.LINE_SQL + ", crossed AS (SELECT DISTINCT a.scenario_id, a.step_index, a.track_id FROM after_line a JOIN before_line b ON a.scenario_id = b.scenario_id AND a.lane_id = b.lane_id AND b.step_index < a.step_index)\n"
add("rule_red_light_running", lambda spark, sf: reviewed(C.red_crossings(spark, sf), "red_light_running", "track_id", 30), CROSSED_SQL + review_sql("red_light_running", "crossed", "track_id", 30))
add("rule_sdc_hard_braking", lambda spark, sf: reviewed(C.braking_pairs(spark, sf), "sdc_hard_braking", "subject_id", 20), C.BRAKING_SQL + review_sql("sdc_hard_braking", "braking", "subject_id", 20))
add("rule_sdc_blocked_unable_to_proceed", lambda spark, sf: reviewed(C.blocked_pairs(spark, sf).filter("step_index = 10"), "sdc_blocked_unable_to_proceed", "subject_id", 20), C.BLOCKED_SQL + review_sql("sdc_blocked_unable_to_proceed", "blocked", "subject_id", 20, "AND step_index = 10"))
add("rule_vru_close_interaction", lambda spark, sf: reviewed(C.vru_pairs(spark, sf, prefilter=True), "vru_close_interaction", "subject_id", 20), C.VRU_SQL + review_sql("vru_close_interaction", "vru", "subject_id", 20, "AND lon >= 0 AND lon <= 16 AND abs(lat) <= 5 AND distance <= 12"))
add("rule_lane_change_conflict", lambda spark, sf: reviewed(R.conflict_pairs(spark, sf).filter("step_index = 10"), "lane_change_conflict", "subject_id", 20), R.CONFLICT_SQL + review_sql("lane_change_conflict", "conflict", "subject_id", 20, "AND step_index = 10"))
_TWICE = R.REPEATED | {"min_lane_changes": 2, "min_lateral_displacement_m": 2.5}
add("rule_sdc_repeated_lane_change", lambda spark, sf: reviewed(R.repeated_changes(spark, sf, _TWICE).filter("step_index = 10"), "sdc_repeated_lane_change", "track_id", 30), R.repeated_sql(2, 2.5) + review_sql("sdc_repeated_lane_change", "repeated", "track_id", 30, "AND step_index = 10"))


@query(PACK_SQL + "SELECT scenario_id, subject_id, frame_index, tag_name, CASE tag_name WHEN 'cut_in_candidate' THEN 'debug' ELSE 'supporting' END AS intent, split_part(subject_id, ':', 1) AS ego_id, split_part(subject_id, ':', 2) AS target_id FROM tag")
def rul_02_event_metadata(spark: SparkSession, sf: str) -> DataFrame:
    part = F.split("subject_id", ":", 2)
    return pair_events(spark, sf, *PAIR_TAGS).select("scenario_id", "subject_id", "frame_index", "tag_name", "intent", part[0].alias("ego_id"), part[1].alias("target_id"))


# Whole runs over all rules.


def tables_of(spark: SparkSession, sf: str) -> evaluate.Tables:
    return evaluate.Tables(B.agent_states(spark, sf), B.traffic_lights(spark, sf), B.map_features(spark, sf), B.scenarios(spark, sf))


def run_of(spark: SparkSession, sf: str, mode: str = "causal_online") -> evaluate.Run:
    """A run of all rules over the derived tables."""
    return evaluate.evaluate(tables_of(spark, sf), RULES, mode)


RAW_SQL = {t: f"SELECT scenario_id, subject_id, frame_index FROM ({B.SQL}{PACK_SQL} SELECT * FROM tag WHERE tag_name = '{t}')" for t in (*COND, "low_ttc_pair")}
RAW_SQL |= {t: f"SELECT scenario_id, subject_id, frame_index FROM ({B.SQL}{STOP_SQL} SELECT * FROM tag WHERE tag_name = '{t}')" for t in ("sdc_vehicle_stopped", "sdc_vehicle_stopped_at_red")}
RAW_SQL |= {t: f"SELECT scenario_id, subject_id, frame_index FROM ({C.SQL[f'rule_{t}']})" for t in ("red_light_stop_line_approach", "red_light_stop_line_crossed")}
RAW_SQL |= {
    t: f"SELECT DISTINCT scenario_id, {subject} AS subject_id, step_index AS frame_index FROM ({B.SQL}{sql} SELECT * FROM {source}) WHERE {SEEN} {extra}"
    for t, (sql, source, subject, extra) in {
        "red_light_running": (CROSSED_SQL, "crossed", "track_id", ""), "sdc_hard_braking": (C.BRAKING_SQL, "braking", "subject_id", ""), "sdc_blocked_unable_to_proceed": (C.BLOCKED_SQL, "blocked", "subject_id", "AND step_index = 10"),
        "vru_close_interaction": (C.VRU_SQL, "vru", "subject_id", "AND lon >= 0 AND lon <= 16 AND abs(lat) <= 5 AND distance <= 12"), "lane_change_conflict": (R.CONFLICT_SQL, "conflict", "subject_id", "AND step_index = 10"),
        "sdc_repeated_lane_change": (R.repeated_sql(2, 2.5), "repeated", "track_id", "AND step_index = 10"),
    }.items()
}
SINGLE_SQL = " UNION ALL ".join(f"SELECT scenario_id, frame_index, '{t}' AS tag_name, subject_id FROM ({q})" for t, q in RAW_SQL.items())


@query(SINGLE_SQL, "")
def rul_01_single_frame(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.detect(tables_of(spark, sf), RULES)[0].select(*EVENT_OUT)


def _both(tag: str, n: str, priority: int) -> str:
    return f"SELECT scenario_id, '{tag}' AS tag_name, '{tag}' AS rule_id, 'agent_pair' AS subject_type, subject_id, anchor AS frame_index, 'review' AS intent, 'cut_in' AS review_family, {priority} AS review_priority FROM {n}"


CUT_IN_SQL = (
    B.SQL + PACK_SQL + chain_sql(list(BY_TAG["cut_in_risk"].steps), "b.ts >= a.anchor_ts - 0.8").replace("c_end", "r_end").replace("c0", "r0").replace("c1", "r1").replace("c2", "r2").replace("c3", "r3")
    + chain_sql(list(BY_TAG["cut_in_confirmed"].steps), "b.ts >= a.anchor_ts - 0.8")
    + ", found AS (" + _both("cut_in_risk", "r3", 20) + " UNION ALL " + _both("cut_in_confirmed", "c2", 10) + ")\n" + merged_sql("found", 1, "i") + R.DOMINANT + "SELECT tag_name, scenario_id, subject_id, frame_index, end_frame, event_count FROM kept"
)
COMPACTED = ("adjacent_vehicle", "cut_in_lateral_approach", "same_path_overlap")
ALONE = ("low_ttc_pair", "cut_in_candidate", "red_light_stop_line_approach", "red_light_stop_line_crossed")
_OUT = "scenario_id, subject_id, frame_index, end_frame, event_count"
RUN_SQL = " UNION ALL ".join([
    f"SELECT * FROM ({CUT_IN_SQL})",
    *[f"SELECT '{t}', {_OUT} FROM ({B.SQL}, src AS (SELECT scenario_id, '{t}' AS tag_name, '{t}' AS rule_id, 'pair' AS subject_type, subject_id, frame_index, 'x' AS intent, NULL AS review_family, 0 AS review_priority FROM ({RAW_SQL[t]})) {merged_sql('src', 1, 'i')} SELECT * FROM i)" for t in COMPACTED],
    *[f"SELECT '{t}', scenario_id, subject_id, frame_index, frame_index, 1 FROM ({RAW_SQL[t]})" for t in ALONE],
    *[f"SELECT '{t}', scenario_id, subject_id, frame_index, frame_index, 1 FROM ({C.SQL[f'rule_{t}']})" for t in ("cut_in_developing", "sdc_vehicle_stopped_for_3_frames", "sdc_vehicle_still_stopped_at_red")],
    *[f"SELECT '{t}', {_OUT} FROM ({C.SQL[f'rule_{t}']})" for t in ("sdc_vehicle_stopped", "sdc_vehicle_stopped_at_red", "persistent_low_ttc_pair", "red_light_running", "sdc_hard_braking", "sdc_blocked_unable_to_proceed", "vru_close_interaction", "lane_change_conflict", "sdc_repeated_lane_change")],
])


@query(f"SELECT scenario_id, tag_name, subject_id, frame_index, end_frame, event_count, 'causal_online' AS evaluation_mode FROM ({RUN_SQL})", "")
def run_01_full_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    return run_of(spark, sf).reviewed.select("scenario_id", "tag_name", "subject_id", "frame_index", "end_frame", "event_count", "evaluation_mode")


@query(f"SELECT s.scenario_id, 11 AS input_frames, 5 AS future_frames, count(tag_name) AS events, count(DISTINCT tag_name) AS tags FROM (SELECT DISTINCT l_orderkey AS scenario_id FROM lineitem) s LEFT JOIN ({RUN_SQL}) USING (scenario_id) GROUP BY s.scenario_id", "")
def run_02_scenario_stats(spark: SparkSession, sf: str) -> DataFrame:
    frames = B.agent_states(spark, sf).filter("track_id = '0'").groupBy("scenario_id").agg(F.count_if(F.col("step_index") <= B.CURRENT).cast("int").alias("input_frames"), F.count_if(F.col("step_index") > B.CURRENT).cast("int").alias("future_frames"))
    counts = run_of(spark, sf).reviewed.groupBy("scenario_id").agg(F.count("*").alias("events"), F.count_distinct("tag_name").alias("tags"))
    return frames.join(counts.hint("merge"), "scenario_id", "left").select("scenario_id", "input_frames", "future_frames", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("tags", F.lit(0)).alias("tags"))


_LOOKS = [r for r in RULES if r.conditions]


@query(
    f"""SELECT s.scenario_id, CAST({len(_LOOKS)} - CASE WHEN lit THEN 0 ELSE {sum("traffic_lights" in r.requires for r in _LOOKS)} END AS BIGINT) AS rules_evaluated, CAST(CASE WHEN lit THEN 0 ELSE {sum("traffic_lights" in r.requires for r in _LOOKS)} END AS BIGINT) AS rules_skipped, coalesce(told, '') AS by_rule
  FROM (SELECT DISTINCT l_orderkey AS scenario_id, l_orderkey IN (SELECT o_orderkey FROM orders) AS lit FROM lineitem) s
  LEFT JOIN (SELECT scenario_id, string_agg(tag_name || '=' || n, ',' ORDER BY tag_name) AS told FROM (SELECT scenario_id, tag_name, count(*) AS n FROM ({RUN_SQL}) GROUP BY ALL) GROUP BY scenario_id) USING (scenario_id)""",
    "",
)
def run_02_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rules that looked at each scenario, rules that couldn't, and events by rule after the policies."""
    rows = evaluate.scenario_stats(run_of(spark, sf))
    left = F.filter("by_rule", lambda r: r["reviewed"] > 0)
    told = F.transform(left, lambda r: F.concat_ws("=", r["rule_id"], r["reviewed"].cast("string")))
    return rows.select("scenario_id", "rules_evaluated", "rules_skipped", F.array_join(told, ",").alias("by_rule"))


@query(
    PACK_SQL + C.BRAKING_SQL
    + """SELECT t.scenario_id, frame_index, t.subject_id, 'low_ttc_pair' AS tag_name, 'supporting' AS intent, '0' AS ego_id, other_id AS target_id, NULL AS risk_level, NULL AS review_subtype, round(lon / closing, 6) AS ttc_s, round(closing, 6) AS closing_speed_mps, NULL AS acceleration_mps2, NULL AS distance_m, NULL AS red_stop_m
  FROM tag t JOIN pairs p ON t.scenario_id = p.scenario_id AND t.subject_id = p.subject_id AND t.frame_index = p.step_index WHERE tag_name = 'low_ttc_pair'
UNION ALL SELECT scenario_id, step_index, subject_id, 'sdc_hard_braking', 'review', '0', other_id, risk_level, review_subtype, NULL, NULL, round(acceleration, 6), round(distance, 6), round(red_lon, 6) FROM braking WHERE step_index <= 10"""
)
def rul_02_operator_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the metrics of their predicates, their roles and their risk."""
    rules = [r for r in RULES if r.tag in ("low_ttc_pair", "sdc_hard_braking")]
    part = F.split("subject_id", ":", 2)

    def told(name: str) -> Column:
        found = F.filter(F.flatten("operators.metrics"), lambda m: m["name"] == name)
        return r6(F.try_element_at(found, F.lit(1))["value"].cast("double")).alias("red_stop_m" if name.startswith("red_") else name)

    once = lambda *names: F.filter("operators", lambda o: o["operator"].isin(*names))
    rows = evaluate.detect(tables_of(spark, sf), rules)[0].withColumn("operators", once("low_ttc", "pair_ego_hard_braking"))
    return rows.select("scenario_id", "frame_index", "subject_id", "tag_name", "intent", part[0].alias("ego_id"), part[1].alias("target_id"), "risk_level", "review_subtype", *[told(n) for n in ("ttc_s", "closing_speed_mps", "acceleration_mps2", "distance_m", "red_light_stop_longitudinal_m")])


_SUSTAINED = {r.tag: r.sustained[0] for r in BY_TAG.values() if r.sustained}
_DETECTED = {t: f"SELECT count(*) FROM ({B.SQL}{STOP_SQL if t.startswith('sdc') else PACK_SQL}{sustained_sql(source)} SELECT * FROM s_hit)" for t, source in _SUSTAINED.items()}
_DETECTED |= {r.tag: f"SELECT count(*) FROM ({B.SQL}{PACK_SQL}{chain_sql(list(r.steps), 'b.ts >= a.anchor_ts - 0.8')} SELECT * FROM c{len(r.steps) - 1})" for r in BY_TAG.values() if r.steps}
_CHEAP = {t: f"{LANE_FREE} AND {c}" for t, c in COND.items()} | {
    "low_ttc_pair": f"{LANE_FREE} AND {TTC_COND}", "sdc_hard_braking": f"{SEEN} AND lon >= 0 AND lon <= 35 AND abs(lat) <= 4", "sdc_blocked_unable_to_proceed": "step_index = 10 AND lon BETWEEN 1 AND 12 AND abs(lat) <= 2.5 AND ego_speed <= 0.4 AND other_speed <= 0.8", "vru_close_interaction": f"{SEEN} AND other_type IN ('pedestrian', 'cyclist') AND lon >= 0 AND lon <= 16 AND abs(lat) <= 5 AND distance <= 12", "lane_change_conflict": "step_index = 10 AND other_type = 'vehicle' AND lon <= 25 AND lon >= -20 AND abs(lat) <= 3 AND other_speed >= 1",
    "sdc_vehicle_stopped": f"{SEEN} AND speed < 0.5", "sdc_vehicle_stopped_at_red": f"{SEEN} AND speed < 0.5 AND lit", "red_light_stop_line_approach": f"{SEEN} AND lit", "red_light_stop_line_crossed": f"{SEEN} AND lit", "red_light_running": f"{SEEN} AND lit", "sdc_repeated_lane_change": "step_index = 10",
}
_SINGLE = [r for r in RULES if r.conditions]


def _rule_counts(r: pack.Rule) -> str:
    lit, now = "traffic_lights" in r.requires, "step_index = 10" if r.current_only else SEEN
    looked = now + (" AND lit" if lit else "")
    source = "lit_pairs" if r.subject == "sdc_pair" else "lit_sdc"
    return f"SELECT '{r.tag}' AS rule_id, (SELECT count(*) FROM seen_frames WHERE {looked}) AS frames_evaluated, (SELECT count(*) FROM seen_frames WHERE {SEEN} AND NOT ({looked})) AS frames_skipped, (SELECT count(*) FROM {source} WHERE {looked}) AS subjects, (SELECT count(*) FROM {source} WHERE {_CHEAP[r.tag]}) AS candidates, (SELECT count(*) FROM singles WHERE tag_name = '{r.tag}') AS events"


@query(
    f"""{B.SQL}, singles AS MATERIALIZED ({SINGLE_SQL}), seen_frames AS MATERIALIZED (SELECT DISTINCT scenario_id, step_index, scenario_id IN (SELECT o_orderkey FROM orders) AS lit FROM st),
lit_sdc AS MATERIALIZED (SELECT *, scenario_id IN (SELECT o_orderkey FROM orders) AS lit FROM sdc), lit_pairs AS MATERIALIZED (SELECT *, scenario_id IN (SELECT o_orderkey FROM orders) AS lit FROM pairs)
"""
    + " UNION ALL ".join([*map(_rule_counts, _SINGLE), *[f"SELECT '{t}', NULL, NULL, NULL, NULL, ({q})" for t, q in _DETECTED.items()]]),
    "",
)
def run_03_rule_counters(spark: SparkSession, sf: str) -> DataFrame:
    """What each of the 21 rules looked at, skipped and found."""
    return run_of(spark, sf).counters.groupBy("rule_id").agg(*[F.sum(c).alias(c) for c in ("frames_evaluated", "frames_skipped", "subjects", "candidates", "events")])
