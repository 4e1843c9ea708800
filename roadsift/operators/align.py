"""What a rule may see: causal and full-scene views, modalities, the car's track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def causal(frames: DataFrame, scenarios: DataFrame, history_steps: int, future_steps: int) -> DataFrame:
    """Frames up to ``history_steps`` before the current one and ``future_steps`` after, with their visibility."""
    if history_steps < 0 or future_steps < 0:
        raise ValueError("steps can't be negative")
    away = F.col("step_index") - F.col("current_time_index")
    rows = frames.join(scenarios.select("scenario_id", "current_time_index").hint("merge"), "scenario_id").filter((away >= -history_steps) & (away <= future_steps))
    return rows.withColumn("visibility", F.when(away < 0, "observed").when(away == 0, "current").otherwise("future")).drop("current_time_index")


def full_scene(frames: DataFrame) -> DataFrame:
    """Every frame is current."""
    return frames.withColumns({"visibility": F.lit("current"), "evaluation_mode": F.lit("offline_full_scene")})


def phase(step: Column, current: Column) -> Column:
    return F.when(step < current, "history").when(step == current, "current").otherwise("future")


def modalities(states: DataFrame, lights: DataFrame, features: DataFrame, scenarios: DataFrame | None = None) -> DataFrame:
    """(scenario_id, step_index, modalities): what each frame offers. With ``scenarios`` (has_lidar_data, current_time_index), frames up to the current one offer lidar where the scenario has it."""
    agents = states.groupBy("scenario_id", "step_index").agg(F.bool_or("valid").alias("ok"))
    lit = lights.groupBy("scenario_id").agg(F.collect_set("step_index").alias("_lit"))
    lane = F.col("feature_type") == "lane"
    maps = features.groupBy("scenario_id").agg(F.lit(True).alias("map"), (F.bool_or(lane) & F.bool_and(~lane | (F.size("polyline") > 0))).alias("geometry"))
    rows = agents.join(lit.hint("merge"), "scenario_id", "left").join(maps.hint("merge"), "scenario_id", "left").withColumns({"lights": F.array_contains("_lit", F.col("step_index")), "lidar": F.lit(False)})
    if scenarios is not None:
        has = scenarios.select("scenario_id", "has_lidar_data", "current_time_index")
        rows = rows.join(has.hint("merge"), "scenario_id", "left").withColumn("lidar", F.col("has_lidar_data") & (F.col("step_index") <= F.col("current_time_index")))
    names = F.array(F.lit("agents"), *[F.when(F.col(c), F.lit(n)) for c, n in (("geometry", "lane_geometry"), ("lidar", "lidar"), ("map", "map"), ("lights", "traffic_lights"), ("ok", "valid_agents"))])
    return rows.select("scenario_id", "step_index", F.array_compact(names).alias("modalities"))


def applies(required: list[str], current_only: bool = False) -> Column:
    """Whether a rule applies to a frame with modalities and visibility."""
    out = F.size(F.array_except(F.array(*[F.lit(r) for r in required]).cast("array<string>"), F.col("modalities"))) == 0
    return out & (F.col("visibility") == "current") if current_only else out


def sdc_track(states: DataFrame, sdc_index: int, causal_step: int | None = None) -> DataFrame:
    """(scenario_id, sdc_track_id): the track with the index that is valid in the given step, or in its first valid frame."""
    rows = states.filter((F.col("track_index") == sdc_index) & F.col("valid"))
    if causal_step is not None:
        rows = rows.filter(F.col("step_index") == causal_step)
    return rows.groupBy("scenario_id").agg(F.min_by("track_id", "step_index").alias("sdc_track_id"))


def without_sdc(scenarios: DataFrame, states: DataFrame, sdc_index: int, resolved: DataFrame) -> DataFrame:
    """(scenario_id, problem) of the scenarios that sdc_track() can't resolve: "no_track" without any row of the index, "never_valid" without a valid one in the frames looked at."""
    seen = states.filter(F.col("track_index") == sdc_index).select("scenario_id").distinct().withColumn("_seen", F.lit(True))
    left = scenarios.select("scenario_id").join(resolved.select("scenario_id"), "scenario_id", "left_anti").join(seen, "scenario_id", "left")
    return left.select("scenario_id", F.when(F.col("_seen"), "never_valid").otherwise("no_track").alias("problem"))
