"""Named queries of sources, scene normalisation, review aggregates, exchange documents and feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsift import binding as B
from roadsift import catalog as C
from roadsift.catalog import query, r6
from roadsift.operators import feedback, review, scenario_ir
from roadsift.sources import scenes

# Review aggregates over the derived tag events.

EVR = """, evr AS (SELECT *, CASE WHEN review_priority >= 70 THEN 'high' WHEN review_priority >= 50 THEN 'medium' END AS risk_level FROM ev),
grouped AS (SELECT *, CASE intent WHEN 'review' THEN 'primary' WHEN 'supporting' THEN 'supporting' ELSE 'debug' END AS review_group FROM evr)
"""


@B.remembered
def grouped(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.tag_events(spark, sf).withColumn("risk_level", F.when(F.col("review_priority") >= 70, "high").when(F.col("review_priority") >= 50, "medium"))
    return rows.withColumn("review_group", review.group_of(F.col("tag_name"), F.col("intent"), F.col("risk_level")))


@query("SELECT scenario_id, tag_name, subject_id, min(frame_index) AS frame_index FROM ev GROUP BY ALL")
def rev_01_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    rows = review.first_of_each(B.tag_events(spark, sf), ["scenario_id", "tag_name", "subject_id"], ["frame_index"])
    return rows.select("scenario_id", "tag_name", "subject_id", "frame_index")


@query(C.BRAKING_SQL + """, near AS (SELECT *, row_number() OVER (PARTITION BY scenario_id, step_index ORDER BY distance, other_id) AS n FROM braking)
SELECT scenario_id, step_index, max(other_id) FILTER (WHERE n = 1) AS kept, coalesce(string_agg(other_id, ',' ORDER BY other_id) FILTER (WHERE n > 1), '') AS suppressed FROM near GROUP BY ALL""")  # fmt: skip
def rev_02_nearest_target(spark: SparkSession, sf: str) -> DataFrame:
    return review.nearest_targets(C.braking_pairs(spark, sf)).select("scenario_id", "step_index", "kept", F.array_join("suppressed", ",").alias("suppressed"))


@query(C.BRAKING_SQL + """, hits AS (SELECT DISTINCT scenario_id, step_index FROM braking), marked AS (SELECT *, CASE WHEN step_index <= lag(step_index) OVER w + 2 THEN 0 ELSE 1 END AS fresh FROM hits WINDOW w AS (PARTITION BY scenario_id ORDER BY step_index)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY scenario_id ORDER BY step_index) AS run FROM marked) SELECT scenario_id, min(step_index) AS frame_index, max(step_index) AS end_frame, count(*) AS event_count FROM runs GROUP BY scenario_id, run""")  # fmt: skip
def rev_03_braking_episodes(spark: SparkSession, sf: str) -> DataFrame:
    from roadsift.operators import policy

    hits = C.braking_pairs(spark, sf).select("scenario_id", F.col("step_index").alias("frame_index")).distinct()
    hits = hits.withColumns({"tag_name": F.lit("sdc_hard_braking"), "rule_id": F.lit("sdc_hard_braking"), "subject_type": F.lit("ego"), "subject_id": F.lit(B.SDC), "intent": F.lit("review")})
    return policy.merged(hits, 2).select("scenario_id", "frame_index", "end_frame", "event_count")


@query(EVR + "SELECT scenario_id, frame_index, review_group FROM grouped")
def rev_04_group(spark: SparkSession, sf: str) -> DataFrame:
    return grouped(spark, sf).select("scenario_id", "frame_index", "review_group")


MIXED_SQL = f""", mixed AS (SELECT *, list_extract({[*review.PRIMARY_TAGS, *review.SUPPORTING_TAGS, "cut_in_candidate"]!r}, CAST(scenario_id + frame_index * 7 AS BIGINT) % {len(review.PRIMARY_TAGS) + len(review.SUPPORTING_TAGS) + 1} + 1) AS tag,
  CASE (frame_index + scenario_id) % 5 WHEN 0 THEN 'review' WHEN 1 THEN 'supporting' WHEN 2 THEN 'debug' WHEN 3 THEN 'other' END AS said, CASE (frame_index + 2 * scenario_id) % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' END AS risk FROM ev)
"""


@query(MIXED_SQL + f"SELECT scenario_id, frame_index, tag, CASE WHEN tag = 'vru_close_interaction' AND risk IN ('medium', 'low') THEN 'supporting' WHEN said = 'review' THEN 'primary' WHEN said IN ('supporting', 'debug') THEN said WHEN tag IN {review.PRIMARY_TAGS!r} THEN 'primary' WHEN tag IN {review.SUPPORTING_TAGS!r} THEN 'supporting' ELSE 'debug' END AS review_group FROM mixed")
def rev_04_group_without_intent(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of events of all tags, with intents missing or unknown and risks of all kinds."""
    return mixed(spark, sf).select("scenario_id", "frame_index", F.col("tag_name").alias("tag"), "review_group")


@B.remembered
def mixed(spark: SparkSession, sf: str) -> DataFrame:
    tags = [*review.PRIMARY_TAGS, *review.SUPPORTING_TAGS, "cut_in_candidate"]
    s, f = F.col("scenario_id"), F.col("frame_index")
    tag = F.element_at(F.array(*[F.lit(t) for t in tags]), ((s + f * 7) % len(tags) + 1).cast("int"))
    said = F.element_at(F.array(F.lit("review"), F.lit("supporting"), F.lit("debug"), F.lit("other"), F.lit(None)), ((f + s) % 5 + 1).cast("int"))
    risk = F.element_at(F.array(F.lit("high"), F.lit("medium"), F.lit("low"), F.lit(None)), ((f + 2 * s) % 4 + 1).cast("int"))
    rows = B.tag_events(spark, sf).select("scenario_id", "frame_index", tag.alias("tag_name"), said.alias("intent"), risk.alias("risk_level"), F.concat(F.lit("0:"), (f % 3).cast("string")).alias("subject_id"), F.when(f % 4 != 0, F.concat(F.lit("sub"), (f % 2).cast("string"))).alias("review_subtype"))
    return rows.withColumn("review_group", review.group_of(F.col("tag_name"), F.col("intent"), F.col("risk_level")))


@query(EVR + "SELECT scenario_id, frame_index, coalesce(risk_level, CASE review_group WHEN 'primary' THEN 'high' ELSE 'candidate' END) AS risk_level FROM grouped")
def rev_05_risk_level(spark: SparkSession, sf: str) -> DataFrame:
    return grouped(spark, sf).select("scenario_id", "frame_index", review.risk_of(F.col("risk_level"), F.col("review_group")).alias("risk_level"))


@query(EVR + "SELECT scenario_id, count(*) FILTER (WHERE review_group = 'primary') AS primary, count(*) FILTER (WHERE review_group = 'supporting') AS supporting, count(*) FILTER (WHERE review_group = 'debug') AS debug, count(DISTINCT subject_id) AS targets, string_agg(DISTINCT tag_name, ',' ORDER BY tag_name) AS tags FROM grouped GROUP BY ALL".replace("AS primary", 'AS "primary"'))
def rev_07_summary(spark: SparkSession, sf: str) -> DataFrame:
    return review.summary(grouped(spark, sf))


@query(EVR + "SELECT scenario_id, tag_name, min(frame_index) AS first_frame, count(*) AS events FROM grouped WHERE review_group = 'primary' GROUP BY ALL")
def rev_08_by_tag(spark: SparkSession, sf: str) -> DataFrame:
    return grouped(spark, sf).filter("review_group = 'primary'").groupBy("scenario_id", "tag_name").agg(F.min("frame_index").alias("first_frame"), F.count("*").alias("events"))


@query(C.VRU_SQL + ", out AS (" + C.VRU_OUT + ") SELECT scenario_id, step_index, subject_id FROM out WHERE risk_level = 'medium'")
def rev_09_payload_filter(spark: SparkSession, sf: str) -> DataFrame:
    return C.vru_pairs(spark, sf).filter("risk_level = 'medium'").select("scenario_id", "step_index", "subject_id")


@query(EVR + "SELECT tag_name, risk_level, count(*) AS events, count(DISTINCT (scenario_id, subject_id)) AS subjects FROM grouped GROUP BY ALL")
def rev_10_counters(spark: SparkSession, sf: str) -> DataFrame:
    return review.counters(grouped(spark, sf), "tag_name", "risk_level")


@query(EVR + ", per AS (SELECT scenario_id % 5 AS shard, scenario_id, count(*) AS n, count(*) FILTER (WHERE review_group = 'primary') AS r FROM grouped GROUP BY ALL) SELECT shard, count(*) AS scenarios, sum(n)::BIGINT AS events, sum(r)::BIGINT AS review_events, count(*) FILTER (WHERE r > 1) AS multi_event_scenarios FROM per GROUP BY ALL")
def rev_11_shard_summary(spark: SparkSession, sf: str) -> DataFrame:
    return review.shard_summary(grouped(spark, sf), F.col("scenario_id") % 5)


@query(EVR + "SELECT scenario_id, count(*) AS events FROM grouped WHERE review_group = 'primary' GROUP BY ALL ORDER BY events DESC, scenario_id LIMIT 10")
def rev_12_busiest_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    return review.busiest(grouped(spark, sf))


@query("SELECT scenario_id % 5 AS shard, tag_name, count(*) AS events FROM ev GROUP BY ROLLUP (scenario_id % 5, tag_name)")
def rev_13_merged_totals(spark: SparkSession, sf: str) -> DataFrame:
    return review.totals(B.tag_events(spark, sf), F.col("scenario_id") % 5)


@query("SELECT rule_id, count(*) AS events, count(DISTINCT scenario_id) AS scenarios FROM ev GROUP BY ALL")
def rev_14_rule_counters(spark: SparkSession, sf: str) -> DataFrame:
    return B.tag_events(spark, sf).groupBy("rule_id").agg(F.count("*").alias("events"), F.count_distinct("scenario_id").alias("scenarios"))


@query("SELECT scenario_id, min(x) - 10 AS min_x, min(y) - 10 AS min_y, max(x) + 10 AS max_x, max(y) + 10 AS max_y FROM st WHERE valid GROUP BY ALL")
def rev_15_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return review.bounds(B.agent_states(spark, sf).filter("valid"), ["scenario_id"], 10.0)


@query("SELECT p.scenario_id, p.step_index, p.subject_id, least(ego_x, other_x) - 5 AS min_x, least(ego_y, other_y) - 5 AS min_y, greatest(ego_x, other_x) + 5 AS max_x, greatest(ego_y, other_y) + 5 AS max_y FROM pairs p")
def rev_16_event_bounds(spark: SparkSession, sf: str) -> DataFrame:
    points = C.pairs_of(spark, sf).select("scenario_id", "step_index", "subject_id", F.explode(F.array(F.struct(F.col("ego_x").alias("x"), F.col("ego_y").alias("y")), F.struct(F.col("other_x").alias("x"), F.col("other_y").alias("y")))).alias("p"))
    return review.bounds(points.select("scenario_id", "step_index", "subject_id", "p.*"), ["scenario_id", "step_index", "subject_id"], 5.0)


@query(", box AS (SELECT scenario_id, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y FROM sdc GROUP BY ALL) SELECT scenario_id, CAST(lane_id AS BIGINT) AS feature_id FROM box, lanes WHERE xb >= min_x AND xa <= max_x AND y0 >= min_y AND y0 <= max_y QUALIFY row_number() OVER (PARTITION BY scenario_id ORDER BY lane_id) <= 2")
def rev_17_map_crop(spark: SparkSession, sf: str) -> DataFrame:
    boxes = review.bounds(C.sdc_ok(spark, sf), ["scenario_id"], 0.0)
    return review.crop_map(B.map_features(spark, sf), boxes, 2).select("scenario_id", "feature_id")


@query(""", n AS (SELECT scenario_id, count(*) AS k FROM ev GROUP BY ALL), a AS (SELECT scenario_id, count(*) AS k, sum(x) AS x, max(y) FILTER (WHERE step_index = 15) AS y FROM st GROUP BY ALL)
SELECT s.scenario_id, 16 AS n_frames, CAST(coalesce(n.k, 0) AS INTEGER) AS n_events, CAST(a.k AS INTEGER) AS n_states, round(a.x, 3) + 0 AS sum_x, a.y + 0 AS last_y FROM scen s JOIN a USING (scenario_id) LEFT JOIN n USING (scenario_id)""")  # fmt: skip
def rev_18_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes and sums of each document, read back from its JSON text."""
    rows = review.payload(B.agent_states(spark, sf), B.tag_events(spark, sf))
    shape = "scenario_id long, frames array<struct<step_index:int,ts:double,agents:array<struct<track_id:string,x:double,y:double,heading:double,valid:boolean>>>>"
    read = rows.select("scenario_id", "n_frames", "n_events", F.from_json("document", shape).alias("d"))
    agents = F.flatten("d.frames.agents")
    total = F.aggregate(agents, F.lit(0.0), lambda s, a: s + a["x"])
    last = F.array_max(F.element_at("d.frames.agents", -1)["y"])
    return read.select("scenario_id", "n_frames", "n_events", F.size(agents).alias("n_states"), (F.round(total, 3) + F.lit(0.0)).alias("sum_x"), (last + F.lit(0.0)).alias("last_y"))


@query(EVR + "SELECT scenario_id, review_group, tag_name, count(*) AS events, min(frame_index) AS first_frame FROM grouped GROUP BY ALL")
def rev_19_payload_index(spark: SparkSession, sf: str) -> DataFrame:
    return grouped(spark, sf).groupBy("scenario_id", "review_group", "tag_name").agg(F.count("*").alias("events"), F.min("frame_index").alias("first_frame"))


@query(EVR + ", c AS (SELECT review_group, tag_name, count(*) AS k FROM grouped GROUP BY ALL) SELECT review_group, string_agg(tag_name, ',' ORDER BY k DESC, tag_name) AS tags FROM c GROUP BY ALL")
def rev_20_tag_groups(spark: SparkSession, sf: str) -> DataFrame:
    c = grouped(spark, sf).groupBy("review_group", "tag_name").agg(F.count("*").alias("k"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("k"), "tag_name")))
    return c.groupBy("review_group").agg(ranked.alias("all")).select("review_group", F.array_join(F.col("all.tag_name"), ",").alias("tags"))


@query("SELECT scenario_id, count(DISTINCT step_index) AS steps, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT track_id) AS tracks, count(*) FILTER (WHERE valid) AS valid_states FROM st GROUP BY ALL")
def rev_21_profile(spark: SparkSession, sf: str) -> DataFrame:
    return review.profile(B.agent_states(spark, sf))


# Exchange documents, over scenarios named by user.

TRIGGER_SQL = """, best AS (SELECT scenario_id, frame_index, tag_name, subject_id FROM ev QUALIFY row_number() OVER (PARTITION BY scenario_id ORDER BY intent <> 'review', frame_index, tag_name, subject_id) = 1),
trig AS (SELECT s.scenario_id, coalesce(frame_index, 10) AS trigger_frame, coalesce(frame_index, 10) * CAST(0.125 AS DOUBLE) AS trigger_ts, tag_name AS trigger_tag, subject_id AS trigger_subject FROM scen s LEFT JOIN best USING (scenario_id)),
win AS (SELECT *, greatest(least(trigger_ts, 1.875) - 0.5, 0) AS start_ts, least(least(trigger_ts, 1.875) + 1, 1.875) AS end_ts FROM trig)
"""


@B.remembered
def trigger(spark: SparkSession, sf: str) -> DataFrame:
    return scenario_ir.triggers(B.scenarios(spark, sf), B.tag_events(spark, sf), B.STEP_S)


@B.remembered
def window(spark: SparkSession, sf: str) -> DataFrame:
    rows = trigger(spark, sf).withColumn("trigger_ts", F.least("trigger_ts", F.lit(1.875)))
    extent = B.scenarios(spark, sf).select("scenario_id", F.lit(0.0).alias("first_ts"), F.lit(1.875).alias("last_ts"))
    return scenario_ir.windows(rows, extent, 0.5, 1.0, 0.5)


@query(TRIGGER_SQL + "SELECT scenario_id, trigger_frame, trigger_ts, trigger_tag FROM trig")
def ir_01_trigger(spark: SparkSession, sf: str) -> DataFrame:
    return trigger(spark, sf).select("scenario_id", "trigger_frame", "trigger_ts", "trigger_tag")


@query(TRIGGER_SQL + "SELECT scenario_id, round(start_ts, 6) AS start_ts, round(end_ts, 6) AS end_ts, round(greatest(start_ts - 0.5, 0), 6) AS warm_up_ts FROM win")
def ir_02_windows(spark: SparkSession, sf: str) -> DataFrame:
    return window(spark, sf).select("scenario_id", "start_ts", "end_ts", "warm_up_ts")


@query(TRIGGER_SQL + ", seen AS (SELECT scenario_id, track_id, min(step_index) AS first_step, min(track_index) AS track_index FROM ok JOIN win USING (scenario_id) WHERE track_id <> '0' AND ts BETWEEN start_ts AND end_ts GROUP BY ALL) SELECT scenario_id, track_id, first_step, CAST(row_number() OVER (PARTITION BY scenario_id ORDER BY first_step, track_index) AS INTEGER) AS role_rank FROM seen QUALIFY row_number() OVER (PARTITION BY scenario_id ORDER BY first_step, track_index) <= 3")
def ir_03_actors(spark: SparkSession, sf: str) -> DataFrame:
    return scenario_ir.actors(B.agent_states(spark, sf), window(spark, sf), 3, B.SDC).select("scenario_id", "track_id", "first_step", "role_rank")


@query(", o AS (SELECT scenario_id, arg_min(x, step_index) AS ox, arg_min(y, step_index) AS oy FROM sdc GROUP BY ALL) SELECT scenario_id, step_index, track_id, round(x - ox, 6) AS ir_x, round(y - oy, 6) AS ir_y, round(degrees(heading), 6) AS ir_heading FROM ok JOIN o USING (scenario_id)")
def ir_04_first_ego_frame(spark: SparkSession, sf: str) -> DataFrame:
    rows = scenario_ir.in_first_ego_frame(B.agent_states(spark, sf), B.SDC).filter("valid")
    return rows.select("scenario_id", "step_index", "track_id", r6("ir_x").alias("ir_x"), r6("ir_y").alias("ir_y"), r6("ir_heading").alias("ir_heading"))


@query(TRIGGER_SQL + ", o AS (SELECT scenario_id, arg_min(x, step_index) AS ox FROM sdc GROUP BY ALL) SELECT scenario_id, track_id, CAST(count(*) AS INTEGER) AS n_points, round(arg_min(x - ox, step_index), 6) AS start_x FROM ok JOIN win USING (scenario_id) JOIN o USING (scenario_id) WHERE ts BETWEEN start_ts AND end_ts GROUP BY ALL")
def ir_05_trajectories(spark: SparkSession, sf: str) -> DataFrame:
    return scenario_ir.trajectories(B.agent_states(spark, sf), window(spark, sf), B.SDC).select("scenario_id", "track_id", "n_points", r6("start.ir_x").alias("start_x"))


@query("SELECT scenario_id, 'lane' AS feature_type, count(*) AS features, CAST(sum((xb - xa) / 20 + 1) AS BIGINT) AS points FROM scen, lanes GROUP BY ALL")
def ir_06_map_context(spark: SparkSession, sf: str) -> DataFrame:
    return B.map_features(spark, sf).groupBy("scenario_id", "feature_type").agg(F.count("*").alias("features"), F.sum(F.size("polyline")).alias("points"))


# Feedback documents from orders, some of them faulty.

FBK_SQL = """WITH f AS (SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 23 = 0 THEN 'shared_exchange_protocol.v0' ELSE 'shared_exchange_protocol.v1' END AS protocol_version, CASE WHEN o_orderkey % 19 = 0 THEN '-bad' ELSE 'm.' || o_orderkey END AS message_id,
  o_orderkey % 37 <> 0 AS dated, 'run-' || (o_orderkey % 4000) AS run_id, CASE WHEN o_orderkey % 11 = 0 THEN 'bad' ELSE md5(CAST(o_custkey AS VARCHAR)) END AS scene_id,
  CASE o_orderstatus WHEN 'O' THEN 'succeeded' WHEN 'F' THEN 'failed' ELSE 'pending' END AS status,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'completed' WHEN '2' THEN 'ego_closed_loop' WHEN '3' THEN 'not_run' WHEN '4' THEN 'planned' ELSE 'failed' END AS runtime_status,
  CASE o_custkey % 3 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' ELSE 'unknown' END AS outcome, o_orderkey % 29 <> 0 AS versioned, o_orderkey % 31 <> 0 AS complete, o_orderkey % 41 <> 0 AS timed FROM orders),
e AS (SELECT *, concat_ws(',', CASE WHEN seq % 23 = 0 THEN 'protocol_version' END, CASE WHEN message_id = '-bad' THEN 'message_id' END, CASE WHEN NOT dated THEN 'created_at' END, CASE WHEN NOT timed THEN 'payload.finished_at' END,
  CASE WHEN scene_id = 'bad' THEN 'scene_id' END, CASE WHEN status = 'pending' THEN 'status' END, CASE WHEN NOT versioned THEN 'algorithm' END, CASE WHEN NOT complete THEN 'summary' END) AS errors FROM f)
"""


@B.remembered
def results(spark: SparkSession, sf: str) -> DataFrame:
    o, key = B.table(spark, sf, "orders"), F.col("o_orderkey")
    pick = lambda c, names, rest: F.coalesce(*[F.when(c == k, v) for k, v in names.items()], F.lit(rest))
    summary = F.map_from_arrays(F.array(*[F.lit(n) for n in feedback.SUMMARY]), F.array(*[F.lit(float(k)) for k in range(len(feedback.SUMMARY))]))
    payload = {
        "run_id": F.concat(F.lit("run-"), (key % 4000).cast("string")), "scene_id": F.when(key % 11 == 0, "bad").otherwise(F.md5(F.col("o_custkey").cast("string"))), "scene_version": F.lit("1"),
        "status": pick(F.col("o_orderstatus"), {"O": "succeeded", "F": "failed"}, "pending"), "runtime_status": pick(F.substring("o_orderpriority", 1, 1), {"1": "completed", "2": "ego_closed_loop", "3": "not_run", "4": "planned"}, "failed"),
        "outcome": pick(F.col("o_custkey") % 3, {0: "pass", 1: "fail"}, "unknown"), "algorithm": F.when(key % 29 == 0, F.create_map(F.lit("algorithm_id"), F.lit("a"))).otherwise(F.create_map(F.lit("algorithm_id"), F.lit("a"), F.lit("algorithm_version"), F.lit("2"))),
        "odd": F.create_map(F.lit("odd_id"), F.lit("city")), "started_at": F.col("o_orderdate"), "finished_at": F.when(key % 41 != 0, F.col("o_orderdate")), "duration_sec": F.col("o_totalprice"),
        "summary": F.when(key % 31 == 0, F.map_filter(summary, lambda k, v: k != "max_jerk")).otherwise(summary), "artifacts": F.array(F.lit("log")),
    }
    return o.select(
        key.alias("seq"), F.when(key % 23 == 0, "shared_exchange_protocol.v0").otherwise("shared_exchange_protocol.v1").alias("protocol_version"), F.lit("evaluation_run_result.v1").alias("schema_version"), F.lit("evaluation.run.result").alias("message_type"),
        F.when(key % 19 == 0, "-bad").otherwise(F.concat(F.lit("m."), key.cast("string"))).alias("message_id"), F.when(key % 37 != 0, F.col("o_orderdate")).alias("created_at"), F.struct(*[c.alias(n) for n, c in payload.items()]).alias("payload"),
    )


@query("SELECT seq, errors FROM e", FBK_SQL)
def fbk_01_validate(spark: SparkSession, sf: str) -> DataFrame:
    return results(spark, sf).select("seq", F.array_join(feedback.errors(), ",").alias("errors"))


DONE = "status = 'succeeded' AND runtime_status IN ('completed', 'ego_closed_loop') AND outcome = 'pass'"
FAILED = "status = 'failed' OR runtime_status = 'failed' OR outcome = 'fail'"


@query(f"SELECT seq, CASE WHEN {DONE} THEN 'validated' WHEN {FAILED} THEN 'failed' ELSE 'incomplete' END AS state, CASE WHEN {DONE} THEN 'normal' WHEN {FAILED} THEN 'high' ELSE 'normal' END AS priority, CASE WHEN {DONE} THEN 'pass' WHEN {FAILED} THEN 'investigate' ELSE 'unknown' END AS disposition FROM e WHERE errors = ''", FBK_SQL)
def fbk_02_classify(spark: SparkSession, sf: str) -> DataFrame:
    return results(spark, sf).filter(F.size(feedback.errors()) == 0).select("seq", *[c.alias(n) for n, c in feedback.classification().items()])


@B.remembered
def flat_results(spark: SparkSession, sf: str) -> DataFrame:
    return results(spark, sf).select("seq", "payload.run_id", "payload.scene_id", "payload.status", "payload.outcome")


@query("""SELECT seq, sha256('{"outcome":"' || outcome || '","run_id":"' || run_id || '","scene_id":"' || scene_id || '","status":"' || status || '"}') AS digest FROM e""", FBK_SQL)
def fbk_03_digest(spark: SparkSession, sf: str) -> DataFrame:
    return flat_results(spark, sf).select("seq", feedback.digest("run_id", "scene_id", "status", "outcome").alias("digest"))


@query("""SELECT seq, run_id, CASE WHEN row_number() OVER w = 1 THEN 'new' WHEN status || outcome || scene_id = first_value(status || outcome || scene_id) OVER w THEN 'duplicate' ELSE 'conflict' END AS action FROM e WINDOW w AS (PARTITION BY run_id ORDER BY seq)""", FBK_SQL)
def fbk_04_store(spark: SparkSession, sf: str) -> DataFrame:
    batch = flat_results(spark, sf).withColumn("digest", feedback.digest("run_id", "scene_id", "status", "outcome"))
    empty = batch.filter("false").select("run_id", "digest")
    return feedback.absorb(batch, empty).select("seq", "run_id", "action")


# Scene normalisation over relational scene tables.


@B.remembered
def samples(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.sdc_ok(spark, sf)
    return rows.select(F.col("scenario_id").alias("scene"), F.concat_ws("-", "scenario_id", "step_index").alias("token"), (F.col("step_index") * 125000 + 7_000_000).cast("long").alias("timestamp"), "x", "y", "heading")


@query("SELECT scenario_id AS scene, scenario_id || '-' || step_index AS token, step_index FROM sdc")
def nrm_01_sample_order(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.order_samples(samples(spark, sf)).select("scene", "token", "step_index")


@query("SELECT scenario_id AS scene, step_index, ts FROM sdc")
def nrm_02_relative_time(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.order_samples(samples(spark, sf)).select("scene", "step_index", "ts")


@query("SELECT scenario_id AS scene, step_index, CASE WHEN step_index < 10 THEN 'history' WHEN step_index = 10 THEN 'current' ELSE 'future' END AS phase FROM sdc")
def nrm_03_phase(spark: SparkSession, sf: str) -> DataFrame:
    from roadsift.operators.align import phase

    return scenes.order_samples(samples(spark, sf)).select("scene", "step_index", phase(F.col("step_index"), F.lit(B.CURRENT)).alias("phase"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'cyclist' WHEN 1 THEN 'vehicle' WHEN 2 THEN 'pedestrian' WHEN 3 THEN 'other' ELSE 'cyclist' END AS object_type FROM part", "")
def nrm_05_category(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in ("vehicle.bicycle", "vehicle.car", "human.pedestrian.adult", "animal", "vehicle.motorcycle")])
    return B.table(spark, sf, "part").select("p_partkey", scenes.object_type(F.element_at(names, (F.col("p_partkey") % 5 + 1).cast("int"))).alias("object_type"))


@query(", o AS (SELECT scenario_id, arg_min(x, step_index) AS ox, arg_min(y, step_index) AS oy FROM sdc GROUP BY ALL) SELECT scenario_id AS scene, step_index, track_id AS instance, x - ox AS x, y - oy AS y FROM ok JOIN o USING (scenario_id)")
def nrm_06_local_frame(spark: SparkSession, sf: str) -> DataFrame:
    from roadsift.operators.subjects import valid_states

    rows = valid_states(B.agent_states(spark, sf)).select(F.col("scenario_id").alias("scene"), "step_index", F.col("track_id").alias("instance"), "x", "y")
    return scenes.to_local(rows, scenes.order_samples(samples(spark, sf)))


@query("SELECT scenario_id AS scene, step_index, track_id AS instance, round(heading, 6) AS heading FROM ok")
def nrm_07_yaw(spark: SparkSession, sf: str) -> DataFrame:
    from roadsift.operators.subjects import valid_states

    turn = F.array(F.cos(F.col("heading") / 2), F.lit(0.0), F.lit(0.0), F.sin(F.col("heading") / 2))
    return valid_states(B.agent_states(spark, sf)).select(F.col("scenario_id").alias("scene"), "step_index", F.col("track_id").alias("instance"), r6(scenes.heading_of(turn)).alias("heading"))


NEIGHBOURS = ", nb AS (SELECT *, coalesce(lag(x) OVER w, x) AS x0, coalesce(lead(x) OVER w, x) AS x1, coalesce(lag(y) OVER w, y) AS y0, coalesce(lead(y) OVER w, y) AS y1, coalesce(lag(ts) OVER w, ts) AS t0, coalesce(lead(ts) OVER w, ts) AS t1 FROM ok WINDOW w AS (PARTITION BY scenario_id, track_id ORDER BY ts))\n"


@query(NEIGHBOURS + "SELECT scenario_id AS scene, track_id AS instance, step_index, round(CASE WHEN t1 > t0 THEN (x1 - x0) / (t1 - t0) ELSE 0 END, 6) AS vx, round(CASE WHEN t1 > t0 THEN (y1 - y0) / (t1 - t0) ELSE 0 END, 6) AS vy FROM nb WHERE track_id <> '0'")
def nrm_08_annotation_velocity(spark: SparkSession, sf: str) -> DataFrame:
    from roadsift.operators.subjects import valid_states

    rows = valid_states(B.agent_states(spark, sf)).filter("track_id <> '0'").select(F.col("scenario_id").alias("scene"), F.col("track_id").alias("instance"), "step_index", "ts", "x", "y")
    return scenes.velocities(rows, ["scene", "instance"]).select("scene", "instance", "step_index", r6("vx").alias("vx"), r6("vy").alias("vy"))


@query(NEIGHBOURS + "SELECT scenario_id AS scene, step_index, round((x1 - x0) / (t1 - t0), 6) AS vx, round((y1 - y0) / (t1 - t0), 6) AS vy FROM nb WHERE track_id = '0'")
def nrm_09_ego_velocity(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.ego_velocities(scenes.order_samples(samples(spark, sf))).select("scene", "step_index", r6("vx").alias("vx"), r6("vy").alias("vy"))


@query(", f AS (SELECT scenario_id, track_id, min(step_index) AS s, any_value(track_index) AS i FROM ok WHERE track_id <> '0' GROUP BY ALL) SELECT scenario_id AS scene, track_id AS instance, CAST(dense_rank() OVER (PARTITION BY scenario_id ORDER BY s, i) AS INTEGER) AS track_index FROM f")
def nrm_10_track_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.agent_states(spark, sf).filter("valid AND track_id <> '0'")
    return scenes.track_indices(rows.select(F.col("scenario_id").alias("scene"), F.col("track_id").alias("instance"), "step_index", F.col("track_index").alias("position")))


@query("SELECT scenario_id AS scene, CAST(8 AS DOUBLE) AS hz FROM scen")
def nrm_11_sampling_rate(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.sampling_hz(scenes.order_samples(samples(spark, sf)))


@query("SELECT scenario_id, CAST(a AS BIGINT) AS from_lane, CAST(b AS BIGINT) AS to_lane FROM scen, (VALUES (1, 3)) v(a, b)")
def nrm_16_lane_topology(spark: SparkSession, sf: str) -> DataFrame:
    def end(at: int):  # noqa: ANN202
        p = F.element_at("polyline", at)
        return F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(0.0).alias("heading"))

    return scenes.lane_topology(B.map_features(spark, sf).select("scenario_id", F.col("feature_id").alias("lane_id"), end(1).alias("start"), end(-1).alias("end")))


# Nested records.


@B.remembered
def records(spark: SparkSession, sf: str) -> DataFrame:
    """The scenario tables nested, one record a scenario; every 17th holds a wrong index and every 19th lacks lights."""
    code = F.when(F.col("object_type") == "vehicle", 1).when(F.col("object_type") == "pedestrian", 2).otherwise(3)
    state = F.struct("x", "y", "vx", "vy", "heading", "valid")
    tracks = B.agent_states(spark, sf).groupBy("scenario_id", "track_index").agg(F.max(code).alias("object_type"), F.transform(F.array_sort(F.collect_list(F.struct("step_index", state.alias("s")))), lambda p: p["s"]).alias("states"))
    tracks = tracks.groupBy("scenario_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("track_index", "object_type", "states"))), lambda t: F.struct(t["track_index"].cast("long").alias("id"), t["object_type"].alias("object_type"), t["states"].alias("states"))).alias("tracks"))
    light = F.struct(F.col("lane_id").alias("lane"), F.when(F.col("state") == "stop", 4).when(F.col("state") == "arrow_stop", 1).otherwise(6).alias("state"), F.struct(F.col("stop_x").alias("x"), F.col("stop_y").alias("y")).alias("stop_point"))
    lights = B.traffic_lights(spark, sf).groupBy("scenario_id", "step_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("light_pos", light.alias("l")))), lambda p: p["l"]).alias("lane_states"))
    lights = lights.groupBy("scenario_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step_index", "lane_states"))), lambda d: F.struct(d["lane_states"].alias("lane_states"))).alias("dynamic_map_states"))
    rows = tracks.join(lights, "scenario_id")
    target = F.struct(F.pmod(F.col("scenario_id"), F.lit(3)).cast("int").alias("track_index"), F.lit(1).alias("difficulty"))
    return rows.select(
        "scenario_id", F.transform(F.sequence(F.lit(0), F.lit(B.STEPS - 1)), lambda i: i * F.lit(B.STEP_S)).alias("timestamps"), F.when(F.col("scenario_id") % 17 == 0, 99).otherwise(B.CURRENT).alias("current_time_index"),
        F.lit(0).alias("sdc_track_index"), "tracks", F.when(F.col("scenario_id") % 19 == 0, F.slice("dynamic_map_states", 1, 3)).otherwise(F.col("dynamic_map_states")).alias("dynamic_map_states"), F.array(target).alias("tracks_to_predict"),
    )


LIT = " AND scenario_id IN (SELECT o_orderkey FROM orders)"


@query("SELECT scenario_id, step_index, track_id, track_index, object_type, ts, x, y, valid FROM st WHERE true" + LIT)
def src_02_flatten_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.flatten_tracks(records(spark, sf)).select("scenario_id", "step_index", "track_id", "track_index", "object_type", "ts", "x", "y", "valid")


@query("SELECT scenario_id, step_index, light_pos, lane_id, state, stop_x, stop_y FROM lights SEMI JOIN scen USING (scenario_id) WHERE scenario_id % 19 <> 0 OR step_index < 3")
def src_06_flatten_lights(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.flatten_lights(records(spark, sf))


@query("SELECT scenario_id, feature_type, count(*) AS features FROM (SELECT scenario_id, 'lane' AS feature_type FROM scen, lanes) GROUP BY ALL")
def src_04_rule_features(spark: SparkSession, sf: str) -> DataFrame:
    return B.map_features(spark, sf).filter(F.col("feature_type").isin(*scenes.RULE_FEATURES)).groupBy("scenario_id", "feature_type").agg(F.count("*").alias("features"))


@query("SELECT s.scenario_id, CAST(s.scenario_id % 3 AS INTEGER) AS track_index, t.track_id, 1 AS difficulty, t.object_type FROM scen s JOIN st t ON t.scenario_id = s.scenario_id AND t.track_index = s.scenario_id % 3 AND t.step_index = 0 WHERE s.scenario_id IN (SELECT o_orderkey FROM orders)")
def src_05_prediction_targets(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.prediction_targets(records(spark, sf))


@query(", n AS (SELECT scenario_id, max(track_index) AS last FROM st GROUP BY ALL) SELECT scenario_id, concat_ws(',', CASE WHEN scenario_id % 17 = 0 THEN 'current_index' END, CASE WHEN scenario_id % 19 = 0 THEN 'light_length' END, CASE WHEN scenario_id % 3 > last THEN 'target_index' END) AS errors FROM n WHERE true" + LIT)
def src_07_validation(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).select("scenario_id", F.array_join(scenes.validation_errors(), ",").alias("errors"))


@query("SELECT o_orderkey AS scenario_id, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS run_order FROM orders WHERE o_orderpriority = '1-URGENT'", "")
def src_08_scene_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Scenes of one name in run order; the chosen list, not the tables, goes through one task."""
    from pyspark.sql import Window

    rows = B.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderdate")
    day = Window.partitionBy("o_orderdate").orderBy("o_orderkey")
    per = rows.groupBy("o_orderdate").agg(F.count("*").alias("n"))
    before = per.alias("p").select("o_orderdate", (F.sum("n").over(Window.orderBy("o_orderdate")) - F.col("n")).alias("before"))
    return rows.withColumn("k", F.row_number().over(day)).join(before, "o_orderdate").select(F.col("o_orderkey").alias("scenario_id"), (F.col("before") + F.col("k")).cast("int").alias("run_order"))
