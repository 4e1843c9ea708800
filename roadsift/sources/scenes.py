"""Normalisation of relational scene tables and of nested scenario records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsift.functions.geometry import yaw

# Codes of nested records.
OBJECT_TYPES = {0: "unset", 1: "vehicle", 2: "pedestrian", 3: "cyclist", 4: "other"}
LANE_STATES = {0: "unknown", 1: "arrow_stop", 2: "arrow_caution", 3: "arrow_go", 4: "stop", 5: "caution", 6: "go", 7: "flashing_stop", 8: "flashing_caution"}
RULE_FEATURES = ("lane", "stop_sign")


def label(code: Column, names: dict[int, str]) -> Column:
    """The code's name, "unknown" where it has none."""
    out = F.lit("unknown")
    for k, v in names.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def object_type(category: Column) -> Column:
    """Type of a dotted category name."""
    two_wheels = category.startswith("vehicle.bicycle") | category.startswith("vehicle.motorcycle")
    return F.when(two_wheels, "cyclist").when(category.startswith("vehicle."), "vehicle").when(category.startswith("human.pedestrian"), "pedestrian").otherwise("other")


def order_samples(samples: DataFrame) -> DataFrame:
    """Samples (scene, token, timestamp in microseconds) with step_index and seconds since the scene's first."""
    scene = Window.partitionBy("scene")
    return samples.withColumns({"step_index": (F.row_number().over(scene.orderBy("timestamp")) - 1).cast("int"), "ts": (F.col("timestamp") - F.min("timestamp").over(scene)) / F.lit(1e6)})


def sampling_hz(ordered: DataFrame) -> DataFrame:
    """Samples a second of each scene from its mean positive interval; null for fewer than two."""
    gap = F.col("ts") - F.lag("ts").over(Window.partitionBy("scene").orderBy("step_index"))
    rows = ordered.withColumn("_g", gap).groupBy("scene").agg(F.avg(F.when(F.col("_g") > 0, F.col("_g"))).alias("_m"))
    return rows.select("scene", F.try_divide(F.lit(1.0), "_m").alias("hz"))


def velocities(rows: DataFrame, track: list[str]) -> DataFrame:
    """vx and vy by central differences over a track's own rows, one-sided at its ends, 0 for one row."""
    order = Window.partitionBy(*track).orderBy("ts")
    here = F.struct("ts", "x", "y")
    out = rows.withColumns({"_p": F.coalesce(F.lag(here).over(order), here), "_q": F.coalesce(F.lead(here).over(order), here)})
    dt = F.col("_q.ts") - F.col("_p.ts")
    return out.withColumns({f"v{c}": F.when(dt > 0, F.try_divide(F.col(f"_q.{c}") - F.col(f"_p.{c}"), dt)).otherwise(0.0) for c in ("x", "y")}).drop("_p", "_q")


def ego_velocities(poses: DataFrame) -> DataFrame:
    """As velocities() over samples; where a neighbouring pose is missing the velocity is 0."""
    order = Window.partitionBy("scene").orderBy("step_index")
    here = F.struct("ts", "x", "y")
    out = poses.withColumns({"_p": F.when(F.row_number().over(order) == 1, here).otherwise(F.lag(here).over(order)), "_q": F.coalesce(F.lead(here).over(order), here)})
    dt = F.col("_q.ts") - F.col("_p.ts")
    return out.withColumns({f"v{c}": F.coalesce(F.when(dt > 0, F.try_divide(F.col(f"_q.{c}") - F.col(f"_p.{c}"), dt)), F.lit(0.0)) for c in ("x", "y")}).drop("_p", "_q")


def to_local(rows: DataFrame, poses: DataFrame) -> DataFrame:
    """Coordinates less each scene's first ego position."""
    origin = poses.groupBy("scene").agg(F.min_by(F.struct("x", "y"), "step_index").alias("o"))
    return rows.join(origin, "scene").withColumns({"x": F.col("x") - F.col("o.x"), "y": F.col("y") - F.col("o.y")}).drop("o")


def heading_of(rotation: Column) -> Column:
    """Heading of a (w, x, y, z) quaternion array."""
    return yaw(rotation[0], rotation[1], rotation[2], rotation[3])


def track_indices(rows: DataFrame) -> DataFrame:
    """(scene, instance, track_index): 1, 2, ... by first appearance; 0 is the ego's."""
    first = rows.groupBy("scene", "instance").agg(F.min(F.struct("step_index", "position")).alias("f"))
    return first.select("scene", "instance", F.dense_rank().over(Window.partitionBy("scene").orderBy("f")).alias("track_index"))


def flatten_tracks(records: DataFrame) -> DataFrame:
    """Nested records (scenario_id, timestamps, tracks[].states[]) to agent states; the step is the place in the array."""
    tracks = records.select("scenario_id", "timestamps", F.posexplode("tracks").alias("track_index", "t"))
    rows = tracks.select("scenario_id", "timestamps", "track_index", F.col("t.id").alias("track_id"), F.col("t.object_type").alias("code"), F.posexplode("t.states").alias("step_index", "s"))
    return rows.select("scenario_id", "step_index", F.element_at("timestamps", F.col("step_index") + 1).alias("ts"), F.col("track_id").cast("string"), "track_index", label(F.col("code"), OBJECT_TYPES).alias("object_type"), "s.*")


def flatten_lights(records: DataFrame) -> DataFrame:
    rows = records.select("scenario_id", F.posexplode("dynamic_map_states").alias("step_index", "d"))
    rows = rows.select("scenario_id", "step_index", F.posexplode("d.lane_states").alias("light_pos", "l"))
    return rows.select("scenario_id", "step_index", "light_pos", F.col("l.lane").alias("lane_id"), label(F.col("l.state"), LANE_STATES).alias("state"), F.col("l.stop_point.x").alias("stop_x"), F.col("l.stop_point.y").alias("stop_y"))


def validation_errors() -> Column:
    """What is wrong with a nested record."""
    n = F.size("timestamps")
    checks = {
        "empty_timeline": n > 0, "current_index": (F.col("current_time_index") >= 0) & (F.col("current_time_index") < n), "track_length": F.forall("tracks", lambda t: F.size(t["states"]) == n),
        "light_length": F.size("dynamic_map_states") == n, "sdc_index": (F.col("sdc_track_index") >= 0) & (F.col("sdc_track_index") < F.size("tracks")),
        "target_index": F.forall("tracks_to_predict", lambda t: (t["track_index"] >= 0) & (t["track_index"] < F.size("tracks"))),
    }
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(k)) for k, ok in checks.items()]))


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, quarantined ones with their errors)."""
    rows = records.withColumn("errors", validation_errors())
    return rows.filter("size(errors) = 0").drop("errors"), rows.filter("size(errors) > 0")


def prediction_targets(records: DataFrame) -> DataFrame:
    """Targets with the id and type of their track."""
    want = records.select("scenario_id", "tracks", F.explode("tracks_to_predict").alias("p"))
    track = F.try_element_at("tracks", F.col("p.track_index") + 1)
    return want.select("scenario_id", F.col("p.track_index").alias("track_index"), track["id"].cast("string").alias("track_id"), F.col("p.difficulty").alias("difficulty"), label(track["object_type"], OBJECT_TYPES).alias("object_type")).filter("track_id IS NOT NULL")


def lane_topology(ends: DataFrame, reach: float = 3.0, turn: float = 0.7) -> DataFrame:
    """(scenario_id, from_lane, to_lane) where a lane's end lies within reach of another's start with a like heading.

    ``ends``: scenario_id, lane_id, start and end (structs of x, y, heading). Starts and ends meet in grid cells.
    """
    from roadsift.functions.geometry import wrapped_once

    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    a = ends.select("scenario_id", F.col("lane_id").alias("from_lane"), F.col("end").alias("a")).withColumns({"cx": F.floor(F.col("a.x") / reach), "cy": F.floor(F.col("a.y") / reach)})
    a = a.withColumn("cx", F.explode(F.transform(near, lambda d: F.col("cx") + d))).withColumn("cy", F.explode(F.transform(near, lambda d: F.col("cy") + d)))
    b = ends.select("scenario_id", F.col("lane_id").alias("to_lane"), F.col("start").alias("b")).withColumns({"cx": F.floor(F.col("b.x") / reach), "cy": F.floor(F.col("b.y") / reach)})
    dx, dy = F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")
    met = a.join(b, ["scenario_id", "cx", "cy"]).filter((F.col("from_lane") != F.col("to_lane")) & (F.sqrt(dx * dx + dy * dy) <= reach) & (wrapped_once(F.col("a.heading"), F.col("b.heading")) <= turn))
    return met.select("scenario_id", "from_lane", "to_lane").distinct()


def ego_poses(sample_data: DataFrame, calibrated: DataFrame, sensors: DataFrame, poses: DataFrame, main: str = "LIDAR_TOP") -> DataFrame:
    """(sample, pose columns): each sample's pose by its first record of the main channel, else by its first key frame; null without one.

    ``sample_data``: sample, position (its place in the file), calibrated, ego_pose, is_key_frame;
    ``calibrated``: calibrated, sensor; ``sensors``: sensor, channel; ``poses``: ego_pose and more.
    """
    rows = sample_data.join(calibrated, "calibrated", "left").join(sensors, "sensor", "left")
    ours = F.coalesce(F.col("channel") == main, F.lit(False))
    chosen = rows.groupBy("sample").agg(F.min(F.when(ours | F.col("is_key_frame"), F.struct(~ours, "position", "ego_pose"))).alias("_c"))
    return chosen.select("sample", F.col("_c.ego_pose").alias("ego_pose")).join(poses, "ego_pose", "left").select("sample", *[c for c in poses.columns if c != "ego_pose"])


def lane_counts(features: DataFrame) -> DataFrame:
    """Per scenario: its features, lanes, lanes with a centreline and directed links."""
    lane = F.col("feature_type") == "lane"
    return features.groupBy("scenario_id").agg(
        F.count("*").alias("features"), F.count_if(lane).alias("lanes"), F.count_if(lane & (F.size("polyline") > 0)).alias("centrelines"), F.coalesce(F.sum(F.when(lane, F.greatest(F.size("exit_lanes"), F.lit(0)))), F.lit(0)).alias("links"),
    )


def capabilities(scenarios: DataFrame, sensors: DataFrame, features: DataFrame) -> DataFrame:
    """(scenario_id, capabilities): sensor modalities of the data set, and map, lane_geometry (every lane has a centreline) and lane_topology of the scenario."""
    known = sensors.filter("modality <> ''").agg(F.sort_array(F.collect_set("modality")).alias("_m"))  # a row of few names
    rows = scenarios.select("scenario_id").join(lane_counts(features), "scenario_id", "left").join(F.broadcast(known))
    own = {"map": F.col("features") > 0, "lane_geometry": (F.col("lanes") > 0) & (F.col("centrelines") == F.col("lanes")), "lane_topology": F.col("links") > 0}
    return rows.select("scenario_id", F.sort_array(F.concat("_m", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in own.items()])))).alias("capabilities"))


def scene_metadata(ordered: DataFrame, features: DataFrame) -> DataFrame:
    """Per scene: samples, sampling rate, lanes, centrelines, links and the rule inputs it has to do without."""
    rows = ordered.groupBy("scene").agg(F.count("*").alias("samples")).join(sampling_hz(ordered), "scene", "left").join(lane_counts(features).withColumnRenamed("scenario_id", "scene"), "scene", "left")
    lacking = F.array_compact(F.array(F.when((F.col("lanes") > 0) & (F.col("centrelines") < F.col("lanes")), F.lit("lane_geometry")), F.lit("traffic_lights")))
    return rows.select("scene", "samples", "hz", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lanes", "centrelines", "links")], lacking.alias("skipped"))

#: Why rules must do without an input that no scene of a relational source has, and without lane geometry.
LACKING = {"traffic_lights": "The source has no traffic light states by sample."}
LANES_LACKING = "Some lane polygons have no centreline."


def described_scenes(scene_table: DataFrame, logs: DataFrame, ordered: DataFrame, features: DataFrame, lacking: dict[str, str] | None = None) -> DataFrame:
    """Per scene: name, log and location, samples, hz, origin (the global pose of its first sample), counts of its map, skipped (reason by input that rules must do without) and notes.

    ``scene_table``: scene, name, log; ``logs``: log, location, one row a log; ``ordered``: samples
    with step_index, ts, x, y and heading; ``lacking``: reasons for inputs that no scene has. A scene
    whose log is unknown has a null location; one without samples has a null rate and origin.
    """
    first = ordered.groupBy("scene").agg(F.count("*").alias("samples"), F.min_by(F.struct("x", "y", F.col("heading").alias("yaw")), "step_index").alias("origin"))
    rows = scene_table.join(logs, "log", "left").join(first, "scene", "left").join(sampling_hz(ordered), "scene", "left").join(lane_counts(features).withColumnRenamed("scenario_id", "scene"), "scene", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("samples", "features", "lanes", "centrelines", "links")})
    told = {k: (F.lit(True), v) for k, v in (LACKING if lacking is None else lacking).items()} | {"lane_geometry": (F.col("centrelines") < F.col("lanes"), LANES_LACKING)}
    skipped = F.map_from_entries(F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("key"), F.lit(v).alias("value"))) for k, (c, v) in sorted(told.items())])))
    notes = F.array_compact(F.array(
        F.lit("States are those of annotated samples, none between them."),
        F.when(F.col("origin").isNotNull(), F.lit("Positions are relative to the first ego position, axes and headings are global.")),
        F.when(F.col("lanes") > 0, F.format_string("%d of %d lanes have a centreline.", "centrelines", "lanes")), F.when(F.col("lanes") > 0, F.format_string("%d directed links between lanes are inferred.", "links")),
    ))
    return rows.select("scene", "name", "log", "location", "samples", "hz", "origin", "features", "lanes", "centrelines", "links", skipped.alias("skipped"), notes.alias("notes"))


def with_provenance(table: DataFrame, prefix: str) -> DataFrame:
    """Rows read from files with source_file, source_index (their place in it) and payload_name."""
    index = F.col("_metadata.row_index")
    name = F.col("_metadata.file_name")
    return table.select("*", name.alias("source_file"), index.alias("source_index"), F.format_string(f"{prefix}_%s_s%04d.json", name, index).alias("payload_name"))
