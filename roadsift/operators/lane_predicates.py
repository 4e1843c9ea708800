"""Window features behind the lane predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadsift.functions.geometry import ahead, aside
from roadsift.operators.features import over_past


def lane_changes(matched: DataFrame, seconds: float) -> DataFrame:
    """Valid states (with lane_id) and the first change between successive matched lanes of the window."""
    rows = matched.withColumn("_w", F.sort_array(over_past("collect_list(CASE WHEN lane_id IS NOT NULL THEN struct(step_index, lane_id) END)", seconds)))
    none = F.lit(None).cast("struct<step_index:int,lane_id:bigint>")

    def look(s: Column, p: Column) -> Column:
        new = s["b"].isNull() & s["last"].isNotNull() & (s["last"]["lane_id"] != p["lane_id"])
        return F.struct(p.alias("last"), F.when(new, s["last"]).otherwise(s["a"]).alias("a"), F.when(new, p).otherwise(s["b"]).alias("b"))

    rows = rows.withColumn("_f", F.aggregate("_w", F.struct(none.alias("last"), none.alias("a"), none.alias("b")), look))
    return rows.select(*matched.columns, F.col("_f.a.lane_id").alias("previous_lane"), F.col("_f.b.lane_id").alias("current_lane"), F.col("_f.a.step_index").alias("previous_frame"), F.col("_f.b.step_index").alias("current_frame"))


def _runs(points: Column) -> Column:
    """Runs of equal lanes of a sorted array of (step_index, ts, lane_id, x, y, heading): first and last point and length."""
    empty = F.slice(F.transform(points, lambda p: F.struct(p.alias("first"), p.alias("last"), F.lit(1).alias("n"))), 1, 0)

    def add(runs: Column, p: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        longer = F.concat(F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0))), F.array(F.struct(last["first"].alias("first"), p.alias("last"), (last["n"] + 1).alias("n"))))
        return F.when((F.size(runs) > 0) & (last["first"]["lane_id"] == p["lane_id"]), longer).otherwise(F.concat(runs, F.array(F.struct(p.alias("first"), p.alias("last"), F.lit(1).alias("n")))))

    return F.aggregate(points, empty, add)


def repeated_changes(matched: DataFrame, links: DataFrame, args: dict) -> DataFrame:
    """Valid states with lane_changes: how often the stable lanes of the window change, connected lanes counted as one; null where a check on speed or displacement fails.

    ``matched`` has lane_id and lateral_range, ``links`` are features.connected_lanes.
    """
    least = args.get("min_lateral_displacement_m", 0.0)
    rows = matched.withColumn("_w", over_past("collect_list(CASE WHEN lane_id IS NOT NULL THEN struct(step_index, ts, lane_id, x, y, heading) END)", args["window_seconds"]))
    rows = rows.filter((F.col("speed") >= args.get("min_speed_mps", 0.0)) & (F.col("lateral_range") >= least) & (F.size("_w") >= 2)).withColumn("_w", F.sort_array("_w"))
    if args.get("min_stable_duration_seconds") is not None:
        stable = lambda r: F.when(r["n"] >= 2, r["last"]["ts"] - r["first"]["ts"]).otherwise(0.0) + 1e-9 >= args["min_stable_duration_seconds"]
    else:
        stable = lambda r: r["n"] >= args.get("min_stable_frames", 2)
    rows = rows.withColumn("_r", F.filter(_runs(F.col("_w")), stable))
    a, b = F.try_element_at("_r", F.lit(1))["first"], F.try_element_at("_r", F.lit(-1))["last"]
    moved = F.coalesce(F.abs(aside(b["x"] - a["x"], b["y"] - a["y"], a["heading"])), F.lit(0.0))
    rows = rows.withColumn("lateral_displacement", moved).filter(F.col("lateral_displacement") >= least)
    known = links.groupBy("scenario_id").agg(F.collect_set(F.struct("from_lane", "to_lane")).alias("_links"))
    rows = rows.join(known.hint("merge"), "scenario_id", "left")
    lanes = F.transform("_r", lambda r: r["first"]["lane_id"])

    def follow(s: Column, lane: Column) -> Column:
        on = (s["last"] == lane) | F.exists(F.coalesce("_links", F.array().cast("array<struct<from_lane:bigint,to_lane:bigint>>")), lambda x: (x["from_lane"] == s["last"]) & (x["to_lane"] == lane))
        return F.struct(lane.alias("last"), (s["n"] + F.when(s["last"].isNull() | on, 0).otherwise(1)).alias("n"))

    start = F.struct(F.lit(None).cast("long").alias("last"), F.lit(0).alias("n"))
    return rows.withColumn("lane_changes", F.aggregate(lanes, start, follow)["n"]).drop("_w", "_r", "_links")


def ego_lane_move(matched: DataFrame, seconds: float) -> DataFrame:
    """Valid states with first_lane and last_lane of the window's matched states and how far aside the last lies of the first."""
    rows = matched.withColumn("_w", F.sort_array(over_past("collect_list(CASE WHEN lane_id IS NOT NULL THEN struct(step_index, lane_id, x, y, heading) END)", seconds)))
    a, b = F.try_element_at("_w", F.lit(1)), F.try_element_at("_w", F.lit(-1))
    return rows.withColumns({"first_lane": a["lane_id"], "last_lane": b["lane_id"], "moved": F.abs(aside(b["x"] - a["x"], b["y"] - a["y"], a["heading"])), "matched": F.size("_w")}).drop("_w")


def conflicts(pairs: DataFrame, args: dict) -> DataFrame:
    """Pairs with ttc and conflict_mode, null without a conflict.

    Needs the ego's lateral_range, first_lane, last_lane, moved and matched, and the target's other_lane.
    """
    least = args.get("min_lateral_displacement_m", 1.5)
    box = (F.col("lon") <= args.get("max_front_longitudinal_m", 25.0)) & (F.col("lon") >= -args.get("max_behind_longitudinal_m", 20.0)) & (F.abs("lat") <= args.get("max_lateral_m", 3.0))
    changed = (F.col("matched") >= 2) & (F.col("first_lane") != F.col("last_lane")) & (F.col("lateral_range") >= least) & (F.col("moved") >= least)
    target = F.col("other_lane").isNull() | (F.col("other_lane") == F.col("last_lane"))
    ok = (F.col("ego_type") == "vehicle") & (F.col("other_type") == "vehicle") & box & (F.col("other_speed") >= args.get("min_target_speed_mps", 0.0)) & changed & target
    gain = ahead(F.col("ego_vx") - F.col("other_vx"), F.col("ego_vy") - F.col("other_vy"), F.col("ego_heading"))
    closing = F.when(F.col("lon") >= 0, gain).otherwise(-gain)
    ttc = F.when((closing >= args.get("min_closing_speed_mps", 0.5)) & (closing > 0), F.try_divide(F.abs("lon"), closing))
    mode = F.when(ok & (ttc <= args.get("max_ttc_s", 4.0)), F.when(F.col("lon") >= 0, "front_target").otherwise("rear_target"))
    return pairs.withColumns({"ttc": ttc, "conflict_mode": mode})
