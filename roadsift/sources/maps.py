"""Map features of nested records: seven kinds in one row shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadsift.sources.scenes import RULE_FEATURES, label

# Kinds of features and their codes in nested records.
KINDS = ("lane", "road_line", "road_edge", "crosswalk", "speed_bump", "stop_sign", "driveway")
LANE_TYPES = {0: "undefined", 1: "freeway", 2: "surface_street", 3: "bike_lane"}
ROAD_LINE_TYPES = {
    0: "unknown", 1: "broken_single_white", 2: "solid_single_white", 3: "solid_double_white", 4: "broken_single_yellow",
    5: "broken_double_yellow", 6: "solid_single_yellow", 7: "solid_double_yellow", 8: "passing_double_yellow",
}
ROAD_EDGE_TYPES = {0: "unknown", 1: "road_edge_boundary", 2: "road_edge_median"}
POINTS = "array<struct<x:double,y:double>>"


def flatten_features(records: DataFrame, visual: bool = True) -> DataFrame:
    """(scenario_id, feature_pos, feature_id, feature_type, polyline, polygon, subtype, speed_limit_mph, interpolating, entry_lanes, exit_lanes, position, stop_lanes).

    ``records`` has ``map_features``: structs of an id and one filled struct of KINDS. Features of no
    known kind are left out, and without ``visual`` so are those that rules don't read. Of features
    with one id the last stands, in the place of the first.
    """
    rows = records.select("scenario_id", F.posexplode("map_features").alias("feature_pos", "f"))
    kind = F.coalesce(*[F.when(F.col(f"f.{k}").isNotNull(), k) for k in KINDS])
    rows = rows.withColumn("feature_type", kind).filter("feature_type IS NOT NULL")
    if not visual:
        rows = rows.filter(F.col("feature_type").isin(*RULE_FEATURES))
    same = Window.partitionBy("scenario_id", "f.id")
    rows = rows.withColumns({"_last": F.max("feature_pos").over(same), "_first": F.min("feature_pos").over(same)}).filter("feature_pos = _last")
    subtype = F.when(F.col("feature_type") == "lane", label(F.col("f.lane.type"), LANE_TYPES)).when(F.col("feature_type") == "road_line", label(F.col("f.road_line.type"), ROAD_LINE_TYPES))
    subtype = subtype.when(F.col("feature_type") == "road_edge", label(F.col("f.road_edge.type"), ROAD_EDGE_TYPES))
    none = F.array().cast(POINTS)
    return rows.select(
        "scenario_id", F.col("_first").alias("feature_pos"), F.col("f.id").alias("feature_id"), "feature_type",
        F.coalesce("f.lane.polyline", "f.road_line.polyline", "f.road_edge.polyline", none).alias("polyline"), F.coalesce("f.crosswalk.polygon", "f.speed_bump.polygon", "f.driveway.polygon", none).alias("polygon"),
        subtype.alias("subtype"), F.col("f.lane.speed_limit_mph").alias("speed_limit_mph"), F.col("f.lane.interpolating").alias("interpolating"), F.col("f.lane.entry_lanes").alias("entry_lanes"), F.col("f.lane.exit_lanes").alias("exit_lanes"),
        F.col("f.stop_sign.position").alias("position"), F.col("f.stop_sign.lane").alias("stop_lanes"),
    )
