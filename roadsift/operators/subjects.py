"""What a rule is evaluated on: agents, frames, lanes and pairs of agents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsift.functions.geometry import ahead, aside, speed

KEYS = ["scenario_id", "step_index"]
PAIRED = ["track_id", "object_type", "x", "y", "vx", "vy", "heading", "speed"]


def valid_states(states: DataFrame) -> DataFrame:
    return states.filter("valid").withColumn("speed", speed())


def sdc_states(states: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Rows of each scenario's self-driving car; invalid ones too. The hint keeps scenarios from being sent whole to the driver."""
    return states.join(scenarios.select("scenario_id", "sdc_track_id").hint("merge"), "scenario_id").filter("track_id = sdc_track_id").drop("sdc_track_id")


def listed(rows: DataFrame, *by: str) -> DataFrame:
    """(scenario_id, _there): each scenario's rows as a map of lists, by the other columns ``by``, to be joined by scenario alone.

    Rows of either side that lie by scenario stay where they are. The hint is needed, as Spark takes
    exploded rows to be as few as those they come from, and would send them whole to the driver.
    """
    rest = [c for c in rows.columns if c not in ("scenario_id", *by)]
    key = F.col(by[0]) if len(by) == 1 else F.struct(*by)
    each = rows.dropna(subset=list(by)).groupBy("scenario_id", *by).agg(F.collect_list(F.struct(*rest)).alias("_l"))
    return each.groupBy("scenario_id").agg(F.map_from_entries(F.collect_list(F.struct(key.alias("key"), F.col("_l").alias("value")))).alias("_there")).hint("merge")


def there(*by: str) -> Column:
    """The list of a row that listed() was joined to; null where there is none."""
    return F.col("_there")[F.col(by[0]) if len(by) == 1 else F.struct(*by)]


def once(value: Column) -> Column:
    """value as a generator: filters on it are not pushed below, where it would be computed a second time."""
    return F.explode_outer(F.array(value))


def same(a: Column, b: Column) -> Column:
    """Equality that Spark doesn't take for a key of a join: rows that lie by scenario would be shuffled by a second key, but not by a condition."""
    return (a <= b) & (a >= b)


def beside(rows: DataFrame, told: DataFrame, how: str = "left") -> DataFrame:
    """rows with the columns of told, which has one row a frame, joined by scenario alone: rows of either side that lie by scenario aren't shuffled again.

    ``how`` is "left" or "inner".
    """
    more = [c for c in told.columns if c not in KEYS]
    named = told.select(F.col("scenario_id").alias("_scenario"), F.col("step_index").alias("_step"), *[F.col(c).alias(f"_told_{c}") for c in more]).hint("merge")
    met = rows.join(named, (F.col("scenario_id") == F.col("_scenario")) & same(F.col("step_index"), F.col("_step")), how)
    return met.select(*rows.columns, *[F.col(f"_told_{c}").alias(c) for c in more])


def lanes_of(lights: DataFrame) -> DataFrame:
    """One subject a light and frame, named by its lane."""
    return lights.select(*KEYS, "light_pos", F.col("lane_id").cast("string").alias("subject_id"))


def _named(side: str, column: str) -> str:
    return f"{side}_{column}".replace("_track_id", "_id").replace("_object_type", "_type")


def _side(states: DataFrame, name: str, *more: str) -> DataFrame:
    return states.select(*KEYS, *more, *[F.col(c).alias(_named(name, c)) for c in PAIRED])


def with_geometry(pairs: DataFrame) -> DataFrame:
    """Distances and closing speeds of a pair in the ego's frame."""
    h, dx, dy = F.col("ego_heading"), F.col("other_x") - F.col("ego_x"), F.col("other_y") - F.col("ego_y")
    dvx, dvy = F.col("other_vx") - F.col("ego_vx"), F.col("other_vy") - F.col("ego_vy")
    return pairs.withColumns({
        "subject_id": F.concat_ws(":", "ego_id", "other_id"), "lon": ahead(dx, dy, h), "lat": aside(dx, dy, h), "closing": ahead(F.col("ego_vx") - F.col("other_vx"), F.col("ego_vy") - F.col("other_vy"), h), "lat_vel": aside(dvx, dvy, h), "distance": F.sqrt(dx * dx + dy * dy),
    })


def sdc_pairs(states: DataFrame, scenarios: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The car with every other valid agent of its frame: as many rows as agents, and ``more`` columns of the car.

    The car's row comes to the others of its frame by a window, so that states laid out by scenario
    aren't shuffled again.
    """
    return framed_pairs(with_car(states if "speed" in states.columns else valid_states(states), scenarios), more)


def with_car(ok: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Valid states with sdc_track_id."""
    return ok.filter("valid").join(scenarios.select("scenario_id", "sdc_track_id").hint("merge"), "scenario_id")


def framed_pairs(ok: DataFrame, more: tuple[str, ...] = (), both: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of with_car's rows: ``more`` columns of the car, and ``both`` columns of either side, named by it."""
    sides = [*PAIRED, *both]
    ours = F.when(F.col("track_id") == F.col("sdc_track_id"), F.struct(*sides, "ts", *more))
    rows = ok.withColumn("_ego", F.max(ours).over(Window.partitionBy(*KEYS))).filter("_ego IS NOT NULL AND track_id <> sdc_track_id")
    return with_geometry(rows.select(*KEYS, "_ego.ts", *[F.col(f"_ego.{c}").alias(_named("ego", c)) for c in sides], *[F.col(c).alias(_named("other", c)) for c in sides], *[f"_ego.{c}" for c in more]))


def track_pairs(tracks: DataFrame, scenarios: DataFrame) -> DataFrame:
    """The car's track (``ego``) with every other one (``other``) of its scenario, as structs of the columns of ``tracks``, which has one row a track.

    Tracks meet before they become states: one row a track is sorted and held, not one for each of its steps.
    """
    whole = F.struct(*[c for c in tracks.columns if c != "scenario_id"])
    rows = tracks.join(scenarios.select("scenario_id", "sdc_track_id").hint("merge"), "scenario_id")
    ours = F.when(F.col("track_id") == F.col("sdc_track_id"), whole)
    return rows.withColumn("ego", F.max(ours).over(Window.partitionBy("scenario_id"))).filter("ego IS NOT NULL AND track_id <> sdc_track_id").select("scenario_id", "ego", whole.alias("other"))


def paired_states(rows: DataFrame) -> DataFrame:
    """Frames in which both states of a pair are valid, with its geometry. Columns are named by side, as in ego_track_id and other_valid."""
    both = [(side, c) for side in ("ego", "other") for c in PAIRED if c != "speed"]
    named = rows.filter("ego_valid AND other_valid").select(*KEYS, "ts", *[F.col(f"{side}_{c}").alias(_named(side, c)) for side, c in both])
    named = named.withColumns({f"{side}_speed": speed(f"{side}_vx", f"{side}_vy") for side in ("ego", "other")})
    return with_geometry(named.select(*KEYS, "ts", *[_named(side, c) for side in ("ego", "other") for c in PAIRED]))


def car_pairs(cars: DataFrame, states: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows of cars, one a frame, with every other valid agent of it, and ``more`` columns of the car.

    What is filtered out of ``cars``, or of ``states``, before is never paired. Agents meet the car by scenario alone,
    so that states laid out by scenario aren't shuffled again.
    """
    ego = _side(cars, "ego", "ts", *more)
    ok = states if "speed" in states.columns else valid_states(states)
    rows = beside(_side(ok.filter("valid"), "other"), ego, "inner").filter("ego_id <> other_id")
    return with_geometry(rows.select(*ego.columns, *[c for c in rows.columns if c not in ego.columns]))


def number_first(a: Column, b: Column) -> Column:
    """a < b by number where both are numbers, else as text."""
    x, y = (c.try_cast("long") for c in (a, b))
    return F.when(x.isNotNull() & y.isNotNull(), x < y).otherwise(a < b)


def agent_pairs(states: DataFrame, directed: bool = True) -> DataFrame:
    """Valid agents of a frame with each other; undirected pairs begin with the lower id. A window gives each agent those of its frame, so that states laid out by scenario aren't shuffled again."""
    rows = valid_states(states).withColumn("_all", F.collect_list(F.struct(*PAIRED)).over(Window.partitionBy(*KEYS))).withColumn("_o", F.explode("_all"))
    both = rows.select(*KEYS, "ts", *[F.col(c).alias(_named("ego", c)) for c in PAIRED], *[F.col(f"_o.{c}").alias(_named("other", c)) for c in PAIRED])
    return with_geometry(both.filter("ego_id <> other_id") if directed else both.filter(number_first(F.col("ego_id"), F.col("other_id"))))


def near_pairs(states: DataFrame, radius: float) -> DataFrame:
    """Directed pairs within a radius. A window along x gives each agent those of its frame that may be near, so that far agents never meet and states laid out by scenario aren't shuffled again."""
    reach = f"{float(radius) + 1e-6!r}D"
    rows = valid_states(states).filter("x IS NOT NULL AND y IS NOT NULL")
    rows = rows.withColumn("_all", F.expr(f"collect_list(struct({', '.join(PAIRED)})) OVER (PARTITION BY {', '.join(KEYS)} ORDER BY x RANGE BETWEEN {reach} PRECEDING AND {reach} FOLLOWING)"))
    rows = rows.withColumn("_o", F.explode(F.filter("_all", lambda o: F.abs(o["y"] - F.col("y")) <= F.expr(reach))))
    both = rows.select(*KEYS, "ts", *[F.col(c).alias(_named("ego", c)) for c in PAIRED], *[F.col(f"_o.{c}").alias(_named("other", c)) for c in PAIRED])
    return with_geometry(both.filter("ego_id <> other_id")).filter(F.col("distance") <= radius)


def boxed(pairs: DataFrame, box: dict) -> DataFrame:
    """Pairs within a rule's box in the ego frame and its radius."""
    bounds = {"min_lon": F.col("lon") >= box.get("min_lon"), "max_lon": F.col("lon") <= box.get("max_lon"), "max_lat": F.abs("lat") <= box.get("max_lat"), "max_distance": F.col("distance") <= box.get("max_distance")}
    for name, condition in bounds.items():
        if name in box:
            pairs = pairs.filter(condition)
    return pairs


def only_subjects(candidates: DataFrame, allowed: DataFrame) -> DataFrame:
    """Candidates whose subject stands in ``allowed`` (scenario_id, subject_id)."""
    return candidates.join(allowed.select("scenario_id", "subject_id").distinct().hint("merge"), ["scenario_id", "subject_id"], "left_semi")
