"""Review aggregates over tag events and scenario tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups of tags whose event states no intent; all others are for debugging.
PRIMARY_TAGS = ("cut_in_confirmed", "cut_in_risk", "low_ttc_pair", "persistent_low_ttc_pair", "red_light_running", "sdc_hard_braking", "sdc_blocked_unable_to_proceed", "vru_close_interaction", "lane_change_conflict")
SUPPORTING_TAGS = ("adjacent_vehicle", "cut_in_lateral_approach", "same_path_overlap", "red_light_stop_line_approach", "red_light_stop_line_crossed")


def first_of_each(events: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One event a key: the first in order."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return events.withColumn("_n", n).filter("_n = 1").drop("_n")


def nearest_targets(braking: DataFrame) -> DataFrame:
    """Per scenario, frame and ego the nearest target; the others are listed as suppressed."""
    key = ["scenario_id", "step_index", "ego_id"]
    rows = braking.groupBy(*key).agg(F.min_by("other_id", F.struct("distance", "other_id")).alias("kept"), F.collect_list("other_id").alias("_all"))
    return rows.select(*key, "kept", F.array_sort(F.array_except("_all", F.array("kept"))).alias("suppressed"))


def group_of(tag: Column, intent: Column, risk: Column) -> Column:
    """Review group of an event: a close interaction whose stated risk isn't high is supporting, then the intent decides, then the tag."""
    stated = F.when(intent == "review", "primary").when(intent.isin("supporting", "debug"), intent)
    by_tag = F.when(tag.isin(*PRIMARY_TAGS), "primary").when(tag.isin(*SUPPORTING_TAGS), "supporting").otherwise("debug")
    return F.when((tag == "vru_close_interaction") & risk.isNotNull() & (risk != "high"), "supporting").otherwise(F.coalesce(stated, by_tag))


def risk_of(risk: Column, group: Column) -> Column:
    return F.coalesce(risk, F.when(group == "primary", "high").otherwise("candidate"))


def target_of(subject: Column) -> Column:
    return F.try_element_at(F.split(subject, ":", 2), F.lit(2))


def summary(events: DataFrame) -> DataFrame:
    """Per scenario: events by group, distinct targets and tags."""
    counts = [F.count_if(F.col("review_group") == g).alias(g) for g in ("primary", "supporting", "debug")]
    return events.groupBy("scenario_id").agg(*counts, F.count_distinct("subject_id").alias("targets"), F.array_join(F.array_sort(F.collect_set("tag_name")), ",").alias("tags"))


def scenario_summary(events: DataFrame) -> DataFrame:
    """Per scenario: maps of counts by group, tag and risk, the sorted distinct targets, and how many events are primary and supporting."""
    target = F.when(F.col("subject_id").contains(":"), target_of(F.col("subject_id")))
    named = {"group": F.col("review_group"), "tag": F.col("tag_name"), "risk": risk_of(F.col("risk_level"), F.col("review_group")), "target": target}
    rows = events.select("scenario_id", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("name")) for k, v in named.items()])).alias("n")).select("scenario_id", "n.*").filter("name IS NOT NULL")
    counts = rows.groupBy("scenario_id", "kind", "name").agg(F.count("*").alias("events"))
    entry = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("name", "events"))))
    total = lambda group: F.coalesce(F.sum(F.when((F.col("kind") == "group") & (F.col("name") == group), F.col("events"))), F.lit(0))
    return counts.groupBy("scenario_id").agg(*[F.map_from_entries(entry(k)).alias(f"by_{k}") for k in ("group", "tag", "risk")], F.transform(entry("target"), lambda e: e["name"]).alias("targets"), total("primary").alias("primary_events"), total("supporting").alias("candidate_events"))


def counters(events: DataFrame, *by: str) -> DataFrame:
    return events.groupBy(*by).agg(F.count("*").alias("events"), F.count_distinct("scenario_id", "subject_id").alias("subjects"))


def bounds(points: DataFrame, key: list[str], margin: float) -> DataFrame:
    """Box of each key's points with a margin; 50 m around the origin without points."""
    edge = {"min_x": F.min("x") - margin, "min_y": F.min("y") - margin, "max_x": F.max("x") + margin, "max_y": F.max("y") + margin}
    rows = points.groupBy(*key).agg(*[c.alias(n) for n, c in edge.items()])
    return rows.select(*key, *[F.coalesce(n, F.lit(-50.0 if n[:3] == "min" else 50.0)).alias(n) for n in edge])


def crop_map(features: DataFrame, boxes: DataFrame, most: int) -> DataFrame:
    """Features that meet their scenario's box, the first ``most`` by id."""
    x, y = F.col("polyline.x"), F.col("polyline.y")
    rows = features.withColumns({"x0": F.array_min(x), "x1": F.array_max(x), "y0": F.array_min(y), "y1": F.array_max(y)}).join(boxes, "scenario_id")
    met = rows.filter("x1 >= min_x AND x0 <= max_x AND y1 >= min_y AND y0 <= max_y")
    return met.withColumn("_n", F.row_number().over(Window.partitionBy("scenario_id").orderBy("feature_id"))).filter(F.col("_n") <= most).drop("_n")


def shard_summary(events: DataFrame, shard: Column) -> DataFrame:
    """Per shard: events, review events, candidates and scenarios with several review events."""
    per = events.withColumn("shard", shard).groupBy("shard", "scenario_id").agg(F.count("*").alias("n"), F.count_if(F.col("review_group") == "primary").alias("r"))
    return per.groupBy("shard").agg(F.count("*").alias("scenarios"), F.sum("n").alias("events"), F.sum("r").alias("review_events"), F.count_if(F.col("r") > 1).alias("multi_event_scenarios"))


def busiest(events: DataFrame, n: int = 10) -> DataFrame:
    """The n scenarios with most review events, ties by id."""
    return events.filter("review_group = 'primary'").groupBy("scenario_id").agg(F.count("*").alias("events")).orderBy(F.desc("events"), "scenario_id").limit(n)


def totals(events: DataFrame, shard: Column) -> DataFrame:
    """Counts for each shard and tag, each shard and the whole."""
    return events.withColumn("shard", shard).rollup("shard", "tag_name").agg(F.count("*").alias("events"))


def profile(states: DataFrame) -> DataFrame:
    """Per scenario: steps, time range, tracks and valid states."""
    return states.groupBy("scenario_id").agg(_distinct("step_index").alias("steps"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), _distinct("track_id").alias("tracks"), F.count_if("valid").alias("valid_states"))


def _distinct(c: str) -> Column:
    """How many distinct values a scenario has. Two distinct counts would write every row thrice and shuffle the copies; a scenario's steps and tracks are few."""
    return F.size(F.collect_set(c)).cast("long")


def counts_by(rows: DataFrame, name: Column, alias: str) -> DataFrame:
    """(scenario_id, map of row counts by name); names are words of a fixed list, null counts as "unknown"."""
    each = rows.groupBy("scenario_id", F.coalesce(name, F.lit("unknown")).alias("_name")).agg(F.count("*").alias("_n"))
    return each.groupBy("scenario_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_name", "_n")))).alias(alias))


def track_profile(states: DataFrame) -> DataFrame:
    """Per track: its type, steps and valid steps."""
    return states.groupBy("scenario_id", "track_id").agg(F.min("object_type").alias("object_type"), F.count("*").alias("steps"), F.count_if("valid").alias("valid_steps"))


def scenario_profile(states: DataFrame, features: DataFrame, lights: DataFrame, scenarios: DataFrame) -> DataFrame:
    """profile() of every scenario with its car, its current step, tracks by type, map features by type and lights by state at the current step.

    A map is empty where a scenario has nothing of the kind; a scenario without states has zero counts and null times.
    """
    tracks = track_profile(states)
    now = scenarios.select("scenario_id", F.col("current_time_index").alias("_now"))
    lit = lights.join(now, "scenario_id").filter(F.col("step_index") == F.col("_now"))
    parts = [profile(states), counts_by(tracks, F.col("object_type"), "tracks_by_type"), counts_by(features, F.col("feature_type"), "features_by_type"), counts_by(lit, F.col("state"), "lights_now")]
    out = scenarios.select("scenario_id", "sdc_track_id", "current_time_index")
    for part in parts:
        out = out.join(part, "scenario_id", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("steps", "tracks", "valid_states")}
    empty = {c: F.coalesce(c, F.create_map().cast("map<string,bigint>")) for c in ("tracks_by_type", "features_by_type", "lights_now")}
    return out.withColumns(zero | empty)


def payload(states: DataFrame, events: DataFrame) -> DataFrame:
    """One JSON document a scenario: its frames in order and its events."""
    frames = states.groupBy("scenario_id", "step_index", "ts").agg(F.array_sort(F.collect_list(F.struct("track_id", "x", "y", "heading", "valid"))).alias("agents"))
    frames = frames.groupBy("scenario_id").agg(F.array_sort(F.collect_list(F.struct("step_index", "ts", "agents"))).alias("frames"))
    told = events.groupBy("scenario_id").agg(F.array_sort(F.collect_list(F.struct("frame_index", "tag_name", "subject_id"))).alias("events"))
    rows = frames.join(told, "scenario_id", "left")
    return rows.select("scenario_id", F.size("frames").alias("n_frames"), F.coalesce(F.size("events"), F.lit(0)).alias("n_events"), F.to_json(F.struct("scenario_id", "frames", "events")).alias("document"))


def whole_payload(states: DataFrame, events: DataFrame, features: DataFrame, margin: float = 10.0, most_features: int = 500) -> DataFrame:
    """(scenario_id, document): the whole review document as JSON.

    Besides frames and events it has the box of all valid states with a margin, the map features that
    meet it (the first ``most_features`` by id), the primary events by tag, counts of steps, tracks
    and valid states, and the summary of the events. ``events`` have review_group and risk_level.
    Scenarios without events have an empty summary. All parts are aggregates by scenario, those
    of the states made in one pass, so that documents meet only what lies by scenario as they do.
    """
    held = F.array_sort(F.collect_list(F.struct("track_id", "object_type", "x", "y", "heading", "valid"))).alias("agents")
    edges = {"min_x": F.min, "min_y": F.min, "max_x": F.max, "max_y": F.max}
    boxes = [of(F.when(F.col("valid"), F.col(c[-1]))).alias(c) for c, of in edges.items()]
    frames = states.groupBy("scenario_id", "step_index", "ts").agg(held, *boxes, F.count_if("valid").alias("valid_states"))
    frames = frames.groupBy("scenario_id").agg(F.array_sort(F.collect_list(F.struct("step_index", "ts", "agents"))).alias("frames"), _distinct("step_index").alias("steps"), *[of(c).alias(c) for c, of in edges.items()], F.sum("valid_states").alias("valid_states"))
    tracks = F.size(F.array_compact(F.array_distinct(F.flatten(F.transform("frames", lambda f: f["agents"]["track_id"]))))).cast("long")
    box = F.struct(*[F.coalesce(F.col(c) + (-margin if c[:3] == "min" else margin), F.lit(-50.0 if c[:3] == "min" else 50.0)).alias(c) for c in edges])
    frames = frames.select("scenario_id", "frames", F.struct("steps", tracks.alias("tracks"), "valid_states").alias("stats"), F.when(F.col("valid_states") > 0, box).alias("bounds"))
    pairs_first = F.when(F.col("subject_id").contains(":"), 0).otherwise(1)
    told = events.groupBy("scenario_id").agg(F.array_sort(F.collect_list(F.struct("frame_index", pairs_first.alias("_o"), "tag_name", "subject_id", "review_group", risk_of(F.col("risk_level"), F.col("review_group")).alias("risk_level")))).alias("_e"))
    told = told.select("scenario_id", F.transform("_e", lambda e: e.dropFields("_o")).alias("events"))
    groups = events.filter("review_group = 'primary'").groupBy("scenario_id", "tag_name").agg(F.min("frame_index").alias("first_frame"), F.count("*").alias("events"))
    groups = groups.groupBy("scenario_id").agg(F.array_sort(F.collect_list(F.struct("first_frame", "tag_name", "events"))).alias("groups"))
    x, y = F.col("polyline.x"), F.col("polyline.y")
    extents = {"x0": F.array_min(x), "x1": F.array_max(x), "y0": F.array_min(y), "y1": F.array_max(y)}
    mapped = features.groupBy("scenario_id").agg(F.array_sort(F.collect_list(F.struct("feature_id", "feature_type", "polyline", *[v.alias(n) for n, v in extents.items()]))).alias("_map"))
    b = F.col("bounds")
    met = F.filter("_map", lambda f: (f["x1"] >= b["min_x"]) & (f["x0"] <= b["max_x"]) & (f["y1"] >= b["min_y"]) & (f["y0"] <= b["max_y"]))
    shown = F.transform(F.slice(met, 1, most_features), lambda f: f.dropFields(*extents))
    rows = frames.join(told, "scenario_id", "left").join(groups, "scenario_id", "left").join(mapped, "scenario_id", "left").withColumn("_shown", shown).withColumn("map", F.when(F.size("_shown") > 0, F.col("_shown")))
    summed = scenario_summary(events)
    rows = rows.join(summed.select("scenario_id", F.struct(*[c for c in summed.columns if c != "scenario_id"]).alias("summary")), "scenario_id", "left")
    return rows.select("scenario_id", F.to_json(F.struct("scenario_id", "stats", "bounds", "summary", "groups", "events", "map", "frames")).alias("document"))


# Metrics that an explanation may hold.
EXPLAINED = (
    "distance_m", "longitudinal_m", "lateral_m", "closing_speed_mps", "lateral_closing_speed_mps", "ttc_s", "heading_delta_rad", "speed_drop_mps", "acceleration_mps2", "ego_acceleration_mps2",
    "ego_speed_delta_mps", "ego_speed_mps", "other_speed_mps", "vru_speed_mps", "other_type", "vru_type", "conflict_mode", "traffic_control_context", "red_light_lane_id", "red_light_stop_longitudinal_m",
    "red_light_stop_lateral_m", "braking_category", "blocked_category", "blocker_type", "blocker_speed_mps", "blocker_track_id", "queue_vehicle_count", "low_speed_frame_count", "observed_frame_count",
    "max_observed_speed_mps", "review_subtype",
)


def explanation(own: Column, supporting: Column) -> Column:
    """Metrics of an event: those of its operators in order, then of its supporting events' operators; a later one replaces an earlier one.

    ``own`` is an array of maps of text, one an operator; ``supporting`` an array of such arrays.
    Names other than EXPLAINED and nulls are left out.
    """
    empty = F.array().cast("array<map<string,string>>")
    maps = F.concat(F.coalesce(own, empty), F.flatten(F.coalesce(supporting, F.array(empty))))
    told = F.transform(F.filter(maps, lambda m: m.isNotNull()), lambda m: F.map_filter(m, lambda k, v: k.isin(*EXPLAINED) & v.isNotNull()))
    return F.aggregate(told, F.create_map().cast("map<string,string>"), lambda s, m: F.map_concat(F.map_filter(s, lambda k, v: ~F.array_contains(F.map_keys(m), k)), m))
