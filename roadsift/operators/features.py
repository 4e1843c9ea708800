"""Motion, light and lane features, computed once as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsift.functions.geometry import aside, wrapped_once
from roadsift.operators.subjects import KEYS, listed, once, same, there, valid_states
from roadsift.schemas import RED_STATES

TRACK = "PARTITION BY scenario_id, track_id ORDER BY ts RANGE BETWEEN"


def over_past(expression: str, seconds: float) -> Column:
    """An aggregate over a track's rows of the last seconds, this one included."""
    return F.expr(f"{expression} OVER ({TRACK} {float(seconds)!r}D PRECEDING AND CURRENT ROW)")


def over_future(expression: str, seconds: float) -> Column:
    return F.expr(f"{expression} OVER ({TRACK} CURRENT ROW AND {float(seconds)!r}D FOLLOWING)")


def speed_change(states: DataFrame, seconds: float = 1.0) -> DataFrame:
    """Valid states with dt, start_speed, speed_delta and acceleration since the first valid state of the window; null without one before."""
    ok = valid_states(states).withColumn("_s", over_past("first(struct(ts, speed))", seconds))
    dt = F.col("ts") - F.col("_s.ts")
    return ok.withColumns({"dt": dt, "start_speed": F.col("_s.speed"), "speed_delta": F.col("speed") - F.col("_s.speed"), "acceleration": F.when(dt > 0, F.try_divide(F.col("speed") - F.col("_s.speed"), dt))}).drop("_s")


def low_speed_window(states: DataFrame, seconds: float, max_speed: float) -> DataFrame:
    """Valid states with observed, low_count, low_seconds (first to last low), top_speed and span of the window."""
    ok = valid_states(states)
    low = f"CASE WHEN speed <= {max_speed!r}D THEN ts END"
    return ok.withColumns({
        "observed": over_past("count(ts)", seconds), "low_count": over_past(f"count({low})", seconds), "low_seconds": F.coalesce(over_past(f"max({low})", seconds) - over_past(f"min({low})", seconds), F.lit(0.0)),
        "top_speed": over_past("max(speed)", seconds), "span": F.col("ts") - over_past("min(ts)", seconds),
    })


def lateral_range(states: DataFrame, seconds: float) -> DataFrame:
    """Valid states with the range of sideways displacement over the window, seen from its first state."""
    ok = valid_states(states).withColumn("_w", over_past("collect_list(struct(ts, x, y, heading))", seconds)).withColumn("_first", F.array_min("_w"))
    rows = ok.withColumns({"_sin": F.sin("_first.heading"), "_cos": F.cos("_first.heading")})  # once a row: within the list, they would be told anew for each of its points
    rows = rows.withColumn("_side", F.transform("_w", lambda p: F.col("_cos") * (p["y"] - F.col("_first.y")) - F.col("_sin") * (p["x"] - F.col("_first.x"))))
    return rows.withColumn("lateral_range", F.array_max("_side") - F.array_min("_side")).drop("_w", "_first", "_sin", "_cos", "_side")


def red_stop_ahead(pairs: DataFrame, lights: DataFrame, max_lon: float, max_lat: float) -> DataFrame:
    """Pairs of a heading-0 or turned ego with the nearest red stop point ahead (red_lane, red_lon, red_lat), null if none."""
    red = lights.filter(F.col("state").isin(*RED_STATES) & F.col("stop_x").isNotNull()).select(*KEYS, "light_pos", "lane_id", "stop_x", "stop_y")
    h = F.col("ego_heading")

    def seen(r: Column) -> Column:
        dx, dy = r["stop_x"] - F.col("ego_x"), r["stop_y"] - F.col("ego_y")
        return F.struct((dx * F.cos(h) + dy * F.sin(h)).alias("lon"), r["light_pos"].alias("light_pos"), r["lane_id"].alias("lane_id"), aside(dx, dy, h).alias("lat"))

    ahead = F.filter(F.transform(there("step_index"), seen), lambda r: (r["lon"] >= 0) & (r["lon"] <= max_lon) & (F.abs(r["lat"]) <= max_lat))
    rows = pairs.join(listed(red, "step_index"), "scenario_id", "left").withColumn("_r", once(F.array_min(ahead)))
    return rows.select(*pairs.columns, F.col("_r.lane_id").alias("red_lane"), F.col("_r.lon").alias("red_lon"), F.col("_r.lat").alias("red_lat"))


def heading_ahead(states: DataFrame, seconds: float) -> DataFrame:
    """Valid states with the heading change to the last valid state within the horizon."""
    ok = valid_states(states)
    return ok.withColumn("heading_change", wrapped_once(F.col("heading"), over_future("last(heading)", seconds + 1e-6)))


def lane_segments(features: DataFrame) -> DataFrame:
    """Lane segments in order with the length before each; segments without length are left out."""
    lane = features.filter("feature_type = 'lane' AND size(polyline) >= 2")
    parts = F.transform(F.sequence(F.lit(1), F.size("polyline") - 1), lambda i: F.struct(i.alias("i"), F.element_at("polyline", i).alias("a"), F.element_at("polyline", i + 1).alias("b")))
    rows = lane.select("scenario_id", "feature_pos", F.col("feature_id").alias("lane_id"), F.explode(parts).alias("s"))
    rows = rows.select("scenario_id", "feature_pos", "lane_id", F.col("s.i").alias("i"), F.col("s.a.x").alias("x0"), F.col("s.a.y").alias("y0"), (F.col("s.b.x") - F.col("s.a.x")).alias("dx"), (F.col("s.b.y") - F.col("s.a.y")).alias("dy"))
    rows = rows.withColumn("length", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))).filter("length > 0")
    before = "OVER (PARTITION BY scenario_id, lane_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return rows.withColumn("s_before", F.expr(f"coalesce(sum(length) {before}, 0.0D)")).withColumn("order", F.struct("feature_pos", "i"))


def lane_match(agents: DataFrame, segments: DataFrame, max_lateral: float, max_heading: float, weight: float = 3.0) -> DataFrame:
    """agents with lane_id, lane_lateral, lane_s and lane_heading of the best lane segment in reach, null if none.

    The score is lateral distance + weight * heading difference and ties go to the earlier segment.
    Agents meet the segments of their scenario in whose box, widened by the reach, they lie: the join
    tests four bounds for each, in compiled code, and no row is made for the others. The best one is
    told by a window over the agent's own row, so that nothing that lies by scenario is shuffled.
    """
    reach = max_lateral + 1e-6
    x1, y1 = F.col("x0") + F.col("dx"), F.col("y0") + F.col("dy")
    bounds = {"_west": F.least("x0", x1) - reach, "_east": F.greatest("x0", x1) + reach, "_south": F.least("y0", y1) - reach, "_north": F.greatest("y0", y1) + reach}
    filed = {"_lane": F.col("lane_id"), "_pos": F.col("feature_pos"), "_i": F.col("i"), "_x0": F.col("x0"), "_y0": F.col("y0"), "_dx": F.col("dx"), "_dy": F.col("dy"), "_length": F.col("length"), "_before": F.col("s_before"), "_ahead": F.atan2("dy", "dx")}
    boxes = segments.select(F.col("scenario_id").alias("_scenario"), *[c.alias(n) for n, c in (bounds | filed).items()]).hint("merge")
    # a row has a number of its own, as states may be given twice
    rows = agents.withColumn("_row", F.monotonically_increasing_id())
    inside = (F.col("x") >= F.col("_west")) & (F.col("x") <= F.col("_east")) & (F.col("y") >= F.col("_south")) & (F.col("y") <= F.col("_north"))
    met = rows.join(boxes, (F.col("scenario_id") == F.col("_scenario")) & inside, "left").drop("_scenario", *bounds)
    t = ((F.col("x") - F.col("_x0")) * F.col("_dx") + (F.col("y") - F.col("_y0")) * F.col("_dy")) / (F.col("_length") * F.col("_length"))
    met = met.withColumn("_t", F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)))
    off_x, off_y = F.col("x") - F.col("_x0") - F.col("_t") * F.col("_dx"), F.col("y") - F.col("_y0") - F.col("_t") * F.col("_dy")
    met = met.withColumns({"_lateral": F.sqrt(off_x * off_x + off_y * off_y), "_turned": wrapped_once(F.col("heading"), F.col("_ahead")), "_s": F.col("_before") + F.col("_t") * F.col("_length")})
    near = (F.col("_lateral") <= max_lateral) & (F.col("_turned") <= max_heading)
    met = met.withColumn("_score", F.when(near, F.col("_lateral") + weight * F.col("_turned"))).select(*rows.columns, "_score", "_pos", "_i", "_lane", "_lateral", "_s", "_turned")
    order = Window.partitionBy(*KEYS, "_row").orderBy(F.asc_nulls_last("_score"), "_pos", "_i")
    best = met.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    told = {"lane_id": "_lane", "lane_lateral": "_lateral", "lane_s": "_s", "lane_heading": "_turned"}
    return best.select(*agents.columns, *[F.when(F.col("_score").isNotNull(), F.col(c)).alias(n) for n, c in told.items()])


def red_lanes(lights: DataFrame, features: DataFrame) -> DataFrame:
    """Red lights on mapped lanes with the lane's direction at the stop point and its heading change ahead over 15 m.

    The steps of a stop point are one row while its lane is looked up and followed.
    """
    red = lights.filter(F.col("state").isin(*RED_STATES) & F.col("stop_x").isNotNull())
    stop = ["scenario_id", "lane_id", "stop_x", "stop_y"]
    rest = [c for c in red.columns if c not in stop]
    lane = features.filter("size(polyline) >= 2").select(F.col("scenario_id").alias("_scenario"), F.col("feature_id").alias("_lane"), "polyline").hint("merge")
    x, y = F.col("stop_x"), F.col("stop_y")
    told = red.select(*stop).filter("lane_id IS NOT NULL").distinct().join(lane, (F.col("scenario_id") == F.col("_scenario")) & same(F.col("lane_id"), F.col("_lane")))
    # the segments, and the nearest of them, are told once: within the fold over segments they would be told anew for each one
    told = told.withColumn("_parts", once(_parts(F.col("polyline"), x, y))).withColumn("_near", once(_nearest(F.col("_parts"))))
    told = told.select(*stop, lane_direction(F.col("polyline"), x, y, F.col("_parts")).alias("d"), lane_turn(F.col("_parts"), F.col("_near"), 15.0).alias("lane_turn")).filter("d IS NOT NULL")
    told = told.select(*[F.col(c).alias(f"_at_{c}") for c in stop], F.col("d.x").alias("dir_x"), F.col("d.y").alias("dir_y"), "lane_turn").hint("merge")
    known = lambda c: F.coalesce(F.col(c), F.lit(float("nan")))
    here = (F.col("scenario_id") == F.col("_at_scenario_id")) & same(x, F.col("_at_stop_x")) & same(known("stop_y"), known("_at_stop_y")) & same(F.col("lane_id"), F.col("_at_lane_id"))
    return red.join(told, here).select(*stop, *rest, "dir_x", "dir_y", "lane_turn")


def _parts(polyline: Column, x: Column, y: Column) -> Column:
    """Segments of a polyline with their midpoint's distance from a point."""
    def part(i: Column) -> Column:
        a, b = F.element_at(polyline, i), F.element_at(polyline, i + 1)
        mx, my, dx, dy = (a["x"] + b["x"]) / 2 - x, (a["y"] + b["y"]) / 2 - y, b["x"] - a["x"], b["y"] - a["y"]
        return F.struct(F.sqrt(mx * mx + my * my).alias("far"), i.alias("i"), dx.alias("dx"), dy.alias("dy"), F.sqrt(dx * dx + dy * dy).alias("length"))

    return F.transform(F.sequence(F.lit(1), F.size(polyline) - 1), part)


def _nearest(parts: Column) -> Column:
    """The part whose midpoint is nearest, of equal ones the first."""
    return F.array_min(F.transform(parts, lambda p: F.struct(p["far"].alias("far"), p["i"].alias("i"), p["length"].alias("length"), p["dx"].alias("dx"), p["dy"].alias("dy"))))


def lane_direction(polyline: Column, x: Column, y: Column, parts: Column | None = None) -> Column:
    """Unit direction of the segment whose midpoint is nearest. Where that has no length, of the last one nearer than all before that has; else of the ends; else null."""
    unit = lambda dx, dy, n: F.struct((dx / n).alias("x"), (dy / n).alias("y"))
    none = F.lit(None).cast("struct<x:double,y:double>")
    start = F.struct(F.lit(float("inf")).alias("far"), none.alias("d"))
    nearer = F.aggregate(_parts(polyline, x, y) if parts is None else parts, start, lambda s, p: F.when(p["far"] < s["far"], F.struct(p["far"].alias("far"), F.when(p["length"] > 0, unit(p["dx"], p["dy"], p["length"])).otherwise(s["d"]).alias("d"))).otherwise(s))
    a, b = F.element_at(polyline, 1), F.element_at(polyline, -1)
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    whole = F.sqrt(dx * dx + dy * dy)
    return F.coalesce(nearer["d"], F.when(whole > 0, unit(dx, dy, whole)))


def lane_turn(parts: Column, nearest: Column, lookahead: float) -> Column:
    """Heading change from the nearest segment to where the look-ahead distance is walked; null if that segment has no length."""
    start = F.struct(F.lit(0.0).alias("walked"), F.atan2(nearest["dy"], nearest["dx"]).alias("h"))
    step = lambda s, p: F.when((p["i"] < nearest["i"]) | (s["walked"] >= lookahead), s).otherwise(F.struct((s["walked"] + p["length"]).alias("walked"), F.when(p["length"] > 0, F.atan2(p["dy"], p["dx"])).otherwise(s["h"]).alias("h")))
    end = F.aggregate(parts, start, step)["h"]
    return F.when(nearest["length"] > 0, wrapped_once(F.atan2(nearest["dy"], nearest["dx"]), end))


def connected_lanes(features: DataFrame) -> DataFrame:
    """(scenario_id, from_lane, to_lane) of lanes that lead into each other, either way."""
    lane = features.filter("feature_type = 'lane'")
    on = lane.select("scenario_id", F.col("feature_id").alias("from_lane"), F.explode(F.array_union(F.coalesce("exit_lanes", F.array()), F.coalesce("entry_lanes", F.array()))).alias("to_lane"))
    return on.union(on.select("scenario_id", F.col("to_lane").alias("from_lane"), F.col("from_lane").alias("to_lane"))).distinct()
