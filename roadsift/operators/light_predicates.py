"""Joins behind the traffic-light predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsift.functions.geometry import wrapped_once
from roadsift.operators.features import over_future
from roadsift.operators.predicates import BUILTIN
from roadsift.operators.subjects import KEYS, listed, once, same, there
from roadsift.schemas import RED_STATES

AGENT = ["scenario_id", "step_index", "track_id"]


def near_red_stop(ok: DataFrame, lights: DataFrame, max_distance_m: float) -> DataFrame:
    """Valid states with near_red_lane and near_red_distance: of the first red light, in list order, within reach."""
    red = lights.filter(F.col("state").isin(*RED_STATES) & F.col("stop_x").isNotNull()).select(*KEYS, "light_pos", "lane_id", "stop_x", "stop_y")

    def seen(r: Column) -> Column:
        dx, dy = F.col("x") - r["stop_x"], F.col("y") - r["stop_y"]
        return F.struct(r["light_pos"].alias("light_pos"), r["lane_id"].alias("lane_id"), F.sqrt(dx * dx + dy * dy).alias("far"))

    near = F.filter(F.transform(there("step_index"), seen), lambda r: r["far"] <= max_distance_m)
    rows = ok.join(listed(red, "step_index"), "scenario_id", "left").withColumn("_n", once(F.array_min(near)))
    return rows.select(*ok.columns, F.col("_n.lane_id").alias("near_red_lane"), F.col("_n.far").alias("near_red_distance"))


def with_turns(ok: DataFrame, horizon_s: float = 2.0, long_horizon_s: float = 5.0) -> DataFrame:
    """Valid states with turn and long_turn: heading changes to the last valid state within two horizons."""
    return ok.withColumns({"turn": wrapped_once(F.col("heading"), over_future("last(heading)", horizon_s + 1e-6)), "long_turn": wrapped_once(F.col("heading"), over_future("last(heading)", long_horizon_s + 1e-6))})


def at_red_lanes(ok: DataFrame, red: DataFrame) -> DataFrame:
    """Valid states beside each red lane of their frame: line_lon and line_lat from the stop point along the lane, line_heading."""
    dx, dy = F.col("x") - F.col("stop_x"), F.col("y") - F.col("stop_y")
    told = ["light_pos", "lane_id", "stop_x", "stop_y", "dir_x", "dir_y", "lane_turn"]
    red = red.select(F.col("scenario_id").alias("_scenario"), F.col("step_index").alias("_step"), *told).hint("merge")
    met = ok.join(red, (F.col("scenario_id") == F.col("_scenario")) & same(F.col("step_index"), F.col("_step"))).select(*ok.columns, *told)
    return met.withColumns({
        "line_lon": dx * F.col("dir_x") + dy * F.col("dir_y"), "line_lat": dy * F.col("dir_x") - dx * F.col("dir_y"), "line_heading": wrapped_once(F.col("heading"), F.atan2("dir_y", "dir_x")),
    })


def first_light(rows: DataFrame) -> DataFrame:
    """Of each agent's passing rows, the one of the first light in list order."""
    keep = [c for c in rows.columns if c not in AGENT]
    return rows.groupBy(*AGENT).agg(F.min_by(F.struct(*keep), "light_pos").alias("_r")).select(*AGENT, "_r.*")


def crossings(ok: DataFrame, red: DataFrame, args: dict) -> DataFrame:
    """States after a red lane's stop line that stood before the same lane's red line in an earlier frame.

    The first light counts, then the earliest frame. ``ok`` has the turns.
    """
    near = at_red_lanes(ok, red)
    before = (F.abs("line_lat") <= args["max_lateral_m"]) & (F.col("line_lon") >= -args["max_before_stop_line_m"]) & (F.col("line_lon") < 0)
    stood = F.min(F.when(before, F.struct(F.col("step_index").alias("before_frame"), F.col("light_pos").alias("before_pos"), F.col("line_lon").alias("lon_before"))))
    near = near.withColumn("_b", stood.over(Window.partitionBy("scenario_id", "track_id", "lane_id").orderBy("step_index").rangeBetween(Window.unboundedPreceding, -1)))
    after_args = {k: v for k, v in args.items() if k in ("max_lateral_m", "min_after_stop_line_m", "max_after_stop_line_m", "min_speed_mps", "max_heading_delta_rad", "max_future_heading_change_rad", "extended_max_future_heading_change_rad")}
    after = near.filter(BUILTIN("red_light_after_stop_line", **after_args))
    if args.get("max_lane_heading_change_rad") is not None:
        after = after.filter(~F.coalesce(F.col("lane_turn") > args["max_lane_heading_change_rad"], F.lit(False)))
    best = F.min_by(F.struct("lane_id", F.col("_b.before_frame").alias("before_frame"), F.col("_b.lon_before").alias("lon_before"), F.col("line_lon").alias("lon_after"), "line_lat"), F.struct("light_pos", "_b.before_frame", "_b.before_pos"))
    return after.filter("_b IS NOT NULL").groupBy(*AGENT).agg(best.alias("_c")).select(*AGENT, "_c.*")
