"""Map files of relational scenes: token lists to features, lane centrelines and lane topology.

A map file is one object with a list for each kind of record; records name nodes, lines and
polygons by tokens. All maps are resolved at once, by joins on (location, token).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadsift.functions.geometry import wrapped_once
from roadsift.scratch import cut

# Kinds of features in the order of their ids, and where each names its outline.
AREAS = ("lane", "road_segment", "walkway", "ped_crossing", "stop_line")
LINES = ("road_divider", "lane_divider")
MANY_AREAS = ("drivable_area",)
KINDS = (*AREAS, *LINES, *MANY_AREAS)
#: Fewest points of an outline and of a line.
RING_POINTS, LINE_POINTS = 3, 2
#: Fewest and most points of a centreline, and what counts as no length.
FEWEST, MOST, NOTHING = 8, 32, 1e-9
REACH_M, TURN_RAD = 3.0, 0.7
#: What tells features apart before they have ids.
FEATURE = ("location", "_order", "position", "part", "token", "feature_type")

MAP_SCHEMA = ", ".join([
    "node array<struct<token:string,x:double,y:double>>", "polygon array<struct<token:string,exterior_node_tokens:array<string>>>", "line array<struct<token:string,node_tokens:array<string>>>",
    "lane array<struct<token:string,polygon_token:string,lane_type:string,from_edge_line_token:string,to_edge_line_token:string>>", "road_segment array<struct<token:string,polygon_token:string,is_intersection:boolean>>",
    "walkway array<struct<token:string,polygon_token:string>>", "ped_crossing array<struct<token:string,polygon_token:string>>", "stop_line array<struct<token:string,polygon_token:string,stop_line_type:string>>",
    "road_divider array<struct<token:string,line_token:string>>", "lane_divider array<struct<token:string,line_token:string>>", "drivable_area array<struct<token:string,polygon_tokens:array<string>>>",
])
_PROPERTIES = {"lane": ("lane_type", "from_edge_line_token", "to_edge_line_token"), "road_segment": ("is_intersection",), "stop_line": ("stop_line_type",)}


def read_maps(spark: SparkSession, folder: str) -> DataFrame:
    """(location, one column for each kind of record) of the files <location>.json of a folder."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    return spark.read.schema(MAP_SCHEMA).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder).select(name.alias("location"), "*")


def records(maps: DataFrame) -> dict[str, DataFrame]:
    """The tables of map files: location and position beside each record's fields."""
    return {c: maps.select("location", F.posexplode(c).alias("position", "r")).select("location", "position", "r.*") for c in maps.columns if c != "location"}


def _resolved(tables: dict[str, DataFrame], lists: DataFrame, key: list[str]) -> DataFrame:
    """lists (key, location, tokens) with points: array of (token, x, y) in the tokens' order, x and y null where the node isn't there.

    Tokens meet their nodes by a window and not by a join, which would shuffle tables that lie by location by (location, token) anew.
    """
    each = lists.select(*dict.fromkeys([*key, "location"]), F.posexplode("tokens").alias("_at", "node"))
    nodes = tables["node"].filter("location IS NOT NULL AND token IS NOT NULL").select("location", F.col("token").alias("node"), F.struct("x", "y").alias("_xy"), "position")
    both = each.unionByName(nodes, allowMissingColumns=True)
    met = both.withColumn("_n", F.max_by("_xy", "position").over(Window.partitionBy("location", "node"))).filter("_at IS NOT NULL")
    points = met.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_at", F.col("node").alias("token"), F.col("_n.x").alias("x"), F.col("_n.y").alias("y")))).alias("_p"))
    return points.select(*key, F.transform("_p", lambda p: F.struct(p["token"].alias("token"), p["x"].alias("x"), p["y"].alias("y"))).alias("points"))


def _known(points: Column | str) -> Column:
    return F.transform(F.filter(points, lambda p: p["x"].isNotNull()), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))


def resolve_features(tables: dict[str, DataFrame]) -> DataFrame:
    """(location, feature_id, feature_type, token, polyline, polygon, properties, ring, from_edge, to_edge, unresolved).

    Tokens that name no node are left out and counted in unresolved, and an outline of fewer than
    three points or a line of fewer than two is no feature. Ids go from 1 in the order of kinds and
    of each kind's records, within each location. For lanes ring, from_edge and to_edge are the
    resolved lists that centrelines() reads, null where the record they name isn't there.
    """
    each = []
    for order, kind in enumerate(KINDS):
        own = _PROPERTIES.get(kind, ())
        rows = tables[kind]
        if kind in MANY_AREAS:
            rows = rows.select("location", "position", "token", F.posexplode("polygon_tokens").alias("part", "shape"))
        else:
            rows = rows.withColumns({"part": F.lit(0), "shape": F.col("polygon_token" if kind in AREAS else "line_token")})
        properties = F.map_filter(F.create_map(*[x for n in own for x in (F.lit(n), F.col(n).cast("string"))]).cast("map<string,string>"), lambda k, v: v.isNotNull())
        edges = {c: F.col(f"{c}_edge_line_token") if kind == "lane" else F.lit(None).cast("string") for c in ("from", "to")}
        each.append(rows.select("location", F.lit(order).alias("_order"), "position", "part", "token", F.lit(kind).alias("feature_type"), "shape", properties.alias("properties"), *[c.alias(f"_{n}") for n, c in edges.items()]))
    rows = each[0]
    for more in each[1:]:
        rows = rows.unionByName(more)
    shapes = tables["polygon"].select("location", F.lit(True).alias("is_area"), F.col("token").alias("shape"), F.col("exterior_node_tokens").alias("tokens"))
    shapes = shapes.unionByName(tables["line"].select("location", F.lit(False).alias("is_area"), F.col("token").alias("shape"), F.col("node_tokens").alias("tokens")))
    points = _resolved(tables, shapes, ["location", "is_area", "shape"])
    is_area = F.col("feature_type").isin(*AREAS, *MANY_AREAS)
    named = [F.struct(F.when(is_area, "ring").otherwise("line").alias("role"), is_area.alias("is_area"), F.col("shape").alias("shape"))]
    named += [F.struct(F.lit(f"{side}_edge").alias("role"), F.lit(False).alias("is_area"), F.col(f"_{side}").alias("shape")) for side in ("from", "to")]
    named = F.array(*named)
    # Features meet all shapes that they name in one window and are put together in one grouping; joined one by one, each shape would carry those before it.
    asked = rows.select(*FEATURE, "properties", F.explode(F.filter(named, lambda n: n["role"].isin("ring", "line") | n["shape"].isNotNull())).alias("n")).select(*FEATURE, "properties", "n.*")
    known = points.filter("location IS NOT NULL AND shape IS NOT NULL").withColumnRenamed("points", "_given")
    both = asked.unionByName(known, allowMissingColumns=True)
    found = both.withColumn("points", F.first("_given", True).over(Window.partitionBy("location", "is_area", "shape"))).filter("role IS NOT NULL")
    rows = found.groupBy(*FEATURE).agg(F.any_value("properties", True).alias("properties"), *[F.any_value(F.when(F.col("role") == r, F.col("points")), True).alias(r) for r in ("ring", "line", "from_edge", "to_edge")])
    none = F.array().cast("array<struct<x:double,y:double>>")
    given = F.coalesce("ring", "line")
    rows = rows.withColumns({"polygon": F.coalesce(_known("ring"), none), "polyline": F.coalesce(_known("line"), none), "unresolved": F.coalesce(F.size(F.filter(given, lambda p: p["x"].isNull())), F.lit(0))})
    kept = rows.filter(F.when(is_area, F.size("polygon") >= RING_POINTS).otherwise(F.size("polyline") >= LINE_POINTS))
    place = Window.partitionBy("location").orderBy("_order", "position", "part")
    lane = F.col("feature_type") == "lane"
    return kept.select("location", F.row_number().over(place).cast("long").alias("feature_id"), "feature_type", "token", "polyline", "polygon", "properties", *[F.when(lane, F.col(c)).alias(c) for c in ("ring", "from_edge", "to_edge")], "unresolved")


# Centrelines.


def _path(ring: Column, a: Column, b: Column) -> Column:
    """The ring's points from place a on to place b, places from 1, over its end where b comes before a."""
    return F.when(a <= b, F.slice(ring, a, b - a + 1)).otherwise(F.concat(F.slice(ring, a, F.size(ring) - a + 1), F.slice(ring, F.lit(1), b)))


def _place(ring: Column, token: Column) -> Column:
    return F.array_position(F.transform(ring, lambda p: p["token"]), token).cast("int")


def _distance(a: Column, b: Column) -> Column:
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    return F.sqrt(dx * dx + dy * dy)


def _middle(a: Column, b: Column) -> Column:
    return F.struct(((a["x"] + b["x"]) / 2).alias("x"), ((a["y"] + b["y"]) / 2).alias("y"))


def _walked(points: Column) -> Column:
    """How far each point lies along the line."""
    steps = F.transform(F.sequence(F.lit(2), F.size(points)), lambda i: _distance(F.element_at(points, i - 1), F.element_at(points, i)))
    return F.aggregate(steps, F.array(F.lit(0.0)), lambda s, d: F.concat(s, F.array(F.element_at(s, -1) + d)))


def _resampled(points: Column, walked: Column, n: Column) -> Column:
    """n points at equal distances along a line of two points and more; its two ends where it has no length."""
    total = F.element_at(walked, -1)

    def placed(k: Column) -> Column:
        target = total * k / (n - 1)
        return F.struct(target.alias("target"), (F.size(F.filter(F.slice(walked, F.lit(2), F.size(points) - 2), lambda w: w < target)) + 1).alias("i"))

    def between(p: Column) -> Column:
        return F.struct(p["target"].alias("target"), F.element_at(points, p["i"]).alias("a"), F.element_at(points, p["i"] + 1).alias("b"), F.element_at(walked, p["i"]).alias("before"), F.element_at(walked, p["i"] + 1).alias("after"))

    def shared(p: Column) -> Column:
        long = p["after"] - p["before"]
        return F.struct(p["a"].alias("a"), p["b"].alias("b"), F.when(long > NOTHING, F.try_divide(p["target"] - p["before"], long)).otherwise(0.0).alias("part"))

    def at(p: Column) -> Column:
        a, b = p["a"], p["b"]
        return F.struct((a["x"] + p["part"] * (b["x"] - a["x"])).alias("x"), (a["y"] + p["part"] * (b["y"] - a["y"])).alias("y"))

    evenly = F.sequence(F.lit(0), n - 1)
    for step in (placed, between, shared, at):  # one list after another, as what a step's function names twice is computed twice
        evenly = F.transform(evenly, step)
    return F.when(total <= NOTHING, F.array(F.element_at(points, 1), F.element_at(points, -1))).otherwise(evenly)


def centrelines(lanes: DataFrame) -> DataFrame:
    """lanes (with ring, from_edge, to_edge: arrays of token, x, y) with centreline and centreline_source.

    The ring is cut at its two edge lines into two sides. Both begin at the middle of the one edge and
    end at the middle of the other, are resampled to as many points as the longer has, 8 to 32, and
    the centreline goes midway between. "edge_midpoint_fallback": from edge to edge, where the ring is
    short, broken or doesn't hold the edges; "unavailable", an empty line, where the edges don't have
    two known points each at different places.
    """
    none = F.array().cast("array<struct<x:double,y:double>>")
    ring = F.when((F.size("ring") > 1) & (F.element_at("ring", 1)["token"] == F.element_at("ring", -1)["token"]), F.slice("ring", F.lit(1), F.size("ring") - 1)).otherwise(F.col("ring"))
    rows = lanes.withColumns({"_r": ring, "_f": F.coalesce(_known("from_edge"), none), "_t": F.coalesce(_known("to_edge"), none)})
    two = (F.size("_f") == 2) & (F.size("_t") == 2)
    rows = rows.withColumns({"_a": F.when(two, _middle(F.get("_f", F.lit(0)), F.get("_f", F.lit(1)))), "_b": F.when(two, _middle(F.get("_t", F.lit(0)), F.get("_t", F.lit(1))))})
    dx, dy = F.col("_b.x") - F.col("_a.x"), F.col("_b.y") - F.col("_a.y")
    rows = rows.withColumn("_direct", F.when(dx * dx + dy * dy > NOTHING, F.array("_a", "_b")).otherwise(none))
    for n, (edge, k) in {"_p0": ("from_edge", 1), "_p1": ("from_edge", 2), "_q0": ("to_edge", 1), "_q1": ("to_edge", 2)}.items():
        rows = rows.withColumn(n, _place(F.col("_r"), F.try_element_at(edge, F.lit(k))["token"]))
    whole = two & (F.size("_r") >= 4) & (F.size("from_edge") == 2) & (F.size("to_edge") == 2) & (F.least("_p0", "_p1", "_q0", "_q1") > 0) & (F.col("_p0") != F.col("_q0")) & (F.col("_p1") != F.col("_q1"))
    whole = F.coalesce(whole & F.col("_p0").isNotNull() & F.col("_p1").isNotNull() & F.col("_q0").isNotNull() & F.col("_q1").isNotNull(), F.lit(False))
    one = F.when(whole, _known(_path(F.col("_r"), F.col("_p0"), F.col("_q0"))))
    two_side = F.when(whole, _known(F.reverse(_path(F.col("_r"), F.col("_q1"), F.col("_p1")))))
    rows = rows.withColumns({"_one": one, "_two": two_side})
    for n in ("_one", "_two"):
        rows = rows.withColumn(n, F.when(F.size(n) >= 2, F.concat(F.array("_a"), F.slice(n, F.lit(2), F.size(n) - 2), F.array("_b"))))
    rows = rows.withColumn("_both", F.col("_one").isNotNull() & F.col("_two").isNotNull())
    rows = rows.withColumns({"_n": F.greatest(F.lit(FEWEST), F.least(F.lit(MOST), F.greatest(F.size("_one"), F.size("_two")))), "_w1": F.when(F.col("_both"), _walked(F.col("_one"))), "_w2": F.when(F.col("_both"), _walked(F.col("_two")))})
    rows = rows.withColumns({"_s1": _resampled(F.col("_one"), F.col("_w1"), F.col("_n")), "_s2": _resampled(F.col("_two"), F.col("_w2"), F.col("_n"))})
    middle = F.transform(F.sequence(F.lit(1), F.least(F.size("_s1"), F.size("_s2"))), lambda i: _middle(F.element_at("_s1", i), F.element_at("_s2", i)))
    line = F.when(F.col("_both"), middle).otherwise(F.col("_direct"))
    source = F.when(F.col("_both"), "polygon_boundary_midpoint").when(F.size("_direct") > 0, "edge_midpoint_fallback").otherwise("unavailable")
    return rows.select(*lanes.columns, line.alias("centreline"), source.alias("centreline_source"))


# Topology.


def _first_heading(line: Column, sign: int = 1) -> Column:
    """Heading of the first step of some length, with sign -1 of the way back; null without one."""
    steps = F.transform(F.sequence(F.lit(2), F.greatest(F.size(line), F.lit(2))), lambda i: F.struct((F.try_element_at(line, i)["x"] - F.try_element_at(line, i - 1)["x"]).alias("dx"), (F.try_element_at(line, i)["y"] - F.try_element_at(line, i - 1)["y"]).alias("dy")))
    first = F.try_element_at(F.filter(steps, lambda s: s["dx"] * s["dx"] + s["dy"] * s["dy"] > NOTHING), F.lit(1))
    return F.atan2(sign * first["dy"], sign * first["dx"])


def lane_ends(lanes: DataFrame, line: str = "polyline") -> DataFrame:
    """lanes with start and end (x, y, heading), headings null where the line has no length; those without points are left out."""
    back = F.reverse(line)
    ends = {"start": (F.get(line, F.lit(0)), _first_heading(F.col(line))), "end": (F.get(back, F.lit(0)), _first_heading(back, -1))}
    return lanes.filter(F.size(line) > 0).withColumns({n: F.struct(p["x"].alias("x"), p["y"].alias("y"), h.alias("heading")) for n, (p, h) in ends.items()})


def lane_links(ends: DataFrame, key: str = "location", reach: float = REACH_M, turn: float = TURN_RAD) -> DataFrame:
    """(key, from_lane, to_lane) where a lane's end lies within reach of another's start with a like heading; ends and starts meet in grid cells."""
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    a = ends.filter("end.heading IS NOT NULL").select(key, F.col("feature_id").alias("from_lane"), F.col("end").alias("a"))
    a = a.withColumn("cx", F.explode(F.transform(near, lambda d: F.floor(F.col("a.x") / reach) + d))).withColumn("cy", F.explode(F.transform(near, lambda d: F.floor(F.col("a.y") / reach) + d)))
    b = ends.filter("start.heading IS NOT NULL").select(key, F.col("feature_id").alias("to_lane"), F.col("start").alias("b"))
    b = b.withColumns({"cx": F.floor(F.col("b.x") / reach), "cy": F.floor(F.col("b.y") / reach)})
    met = a.join(b, [key, "cx", "cy"]).filter((F.col("from_lane") != F.col("to_lane")) & (_distance(F.col("a"), F.col("b")) <= reach) & (wrapped_once(F.col("a.heading"), F.col("b.heading")) <= turn))
    return met.select(key, "from_lane", "to_lane").distinct()


def with_topology(features: DataFrame, key: str = "location") -> DataFrame:
    """Features with entry_lanes and exit_lanes: sorted ids of the lanes that lead into a lane and on from it; null for other features and lanes without a line."""
    ends = lane_ends(features.filter("feature_type = 'lane'"))
    links = cut(lane_links(ends, key))
    out = links.groupBy(key, F.col("from_lane").alias("feature_id")).agg(F.array_sort(F.collect_set("to_lane")).alias("exit_lanes"))
    into = links.groupBy(key, F.col("to_lane").alias("feature_id")).agg(F.array_sort(F.collect_set("from_lane")).alias("entry_lanes"))
    has_line = (F.col("feature_type") == "lane") & (F.size("polyline") > 0)  # told before the joins, which needn't carry the lines of those who don't ask for them
    rows = features.withColumn("_has_line", has_line).join(into, [key, "feature_id"], "left").join(out, [key, "feature_id"], "left")
    return rows.withColumns({c: F.when(F.col("_has_line"), F.coalesce(c, F.array().cast("array<long>"))) for c in ("entry_lanes", "exit_lanes")}).drop("_has_line")


def map_features(tables: dict[str, DataFrame]) -> DataFrame:
    """All features of all maps, lanes with their centreline as polyline and its source among the properties, with topology."""
    rows = centrelines(resolve_features(tables))
    lane = F.col("feature_type") == "lane"
    rows = rows.withColumns({
        "polyline": F.when(lane, F.col("centreline")).otherwise(F.col("polyline")),
        "properties": F.when(lane, F.map_concat("properties", F.create_map(F.lit("centreline_source"), F.col("centreline_source"), F.lit("topology_source"), F.lit("endpoint_heading_inferred")))).otherwise(F.col("properties")),
    })
    return with_topology(cut(rows.drop("ring", "from_edge", "to_edge", "centreline", "centreline_source")))


def in_scenes(features: DataFrame, scenarios: DataFrame) -> DataFrame:
    """A location's features for each of its scenes, about the scene's origin (origin_x, origin_y of scenarios)."""
    def moved(c: str) -> Column:
        return F.transform(c, lambda p: F.struct((p["x"] - F.col("_ox")).alias("x"), (p["y"] - F.col("_oy")).alias("y")))

    at = scenarios.select("scenario_id", "location", F.col("origin_x").alias("_ox"), F.col("origin_y").alias("_oy"))
    rows = features.join(at, "location")
    return rows.withColumns({"polyline": moved("polyline"), "polygon": moved("polygon"), "feature_pos": (F.col("feature_id") - 1).cast("int")}).drop("_ox", "_oy")
