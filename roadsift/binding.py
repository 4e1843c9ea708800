"""Scenario tables derived from the star-schema tables, on a grid of 1/8 s with exact arithmetic.

Each order is a scenario, its first line the self-driving car (track 0, heading 0) and the other
lines are the agents around it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STEPS, CURRENT = 16, 10
STEP_S = 0.125
SDC = "0"


def remembered(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """make(spark, ...), planned once a session: building a plan anew for every query costs more than small queries do. Only plans are kept: every query reads its tables."""
    @functools.wraps(make)
    def get(spark: SparkSession, *args: object, **named: object) -> DataFrame:
        plans = spark.__dict__.setdefault("_roadsift_plans", {})
        key = (make.__module__, make.__qualname__, repr(args), repr(named))
        if key not in plans:
            plans[key] = make(spark, *args, **named)
        return plans[key]

    return get


@remembered
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Agents to a partition: their states, 16 times as many rows, are sorted in memory.
AGENTS = 50_000


@remembered
def places(spark: SparkSession, sf_dir: str) -> int:
    """How many partitions the derived tables lie in, all of them by scenario_id."""
    return -(-table(spark, sf_dir, "lineitem").count() // AGENTS) or 1


def laid_out(rows: DataFrame, sf_dir: str, key: str = "scenario_id") -> DataFrame:
    """rows by scenario_id (or another key), before they become many: what is made of them for each step is sorted, grouped and joined by scenario without another shuffle. Adaptive execution would merge partitions by the few bytes of these rows."""
    return rows.repartition(places(rows.sparkSession, sf_dir), key)


@remembered
def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an agent: scenario_id, tix and the numbers its states follow from. The scenario has its name before the window, as Spark doesn't see later that rows lie by it."""
    order = Window.partitionBy("scenario_id").orderBy("l_linenumber", "p", "s", "l_quantity", "l_extendedprice", "l_tax", "l_discount", "l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("scenario_id"), "l_linenumber", F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), "l_quantity", "l_extendedprice", "l_tax", "l_discount", "l_shipdate")
    return laid_out(lines, sf_dir).withColumn("tix", F.row_number().over(order) - 1).select("scenario_id", "tix", "p", "s", F.col("l_quantity").cast("long").alias("q"))


def tracks_of(agents: DataFrame) -> DataFrame:
    """One row an agent with all of its states that no step changes, so that it is worked out once and not at every step."""
    e = F.expr
    return agents.select(
        "scenario_id", "tix", "p", F.col("tix").cast("string").alias("track_id"),
        e("CASE WHEN tix = 0 THEN 'vehicle' WHEN p % 5 = 0 THEN 'pedestrian' WHEN p % 5 = 1 THEN 'cyclist' ELSE 'vehicle' END").alias("object_type"),
        e("CAST((p % 61) - 12 AS DOUBLE)").alias("x0"),
        e("CAST(CASE WHEN tix = 0 THEN 4 + q % 12 ELSE q % 12 END AS DOUBLE)").alias("x_rate"),
        e("CASE WHEN tix = 0 THEN 0.0D ELSE ((s % 25) - 12) * 0.5D END").alias("y0"),
        e("CASE WHEN tix = 0 THEN CASE WHEN s % 3 = 0 THEN 2.0D ELSE 0.0D END ELSE ((p % 7) - 3) * 0.5D END").alias("y_rate"),
        e("CASE WHEN p % 4 = 1 THEN CASE WHEN tix = 0 THEN 1.0D ELSE 0.5D END WHEN tix = 0 THEN CAST(4 + q % 12 AS DOUBLE) ELSE CAST(q % 12 AS DOUBLE) END").alias("vx0"),
        e("CASE WHEN p % 4 = 1 THEN CASE WHEN tix = 0 THEN 0.25D ELSE 0.5D END WHEN tix = 0 THEN CAST(4 + q % 12 AS DOUBLE) ELSE CAST(q % 12 AS DOUBLE) END").alias("vx5"),
        e("CASE WHEN tix = 0 AND p % 4 = 0 THEN CAST(p % 7 AS DOUBLE) END").alias("braking"),
        e("CASE WHEN tix = 0 THEN 0.0D ELSE ((p % 7) - 3) * 0.5D END").alias("vy"),
        e("CASE WHEN tix = 0 THEN 0.0D ELSE ((s % 9) - 4) * 0.125D END").alias("heading"),
    )


def at_steps(rows: DataFrame) -> DataFrame:
    """rows at each step."""
    return rows.withColumn("step_index", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1)))).withColumn("ts", F.col("step_index") * F.lit(STEP_S))


def state_at(track: Callable[[str], Column]) -> dict[str, Column]:
    """The state of a track, whose columns ``track`` gives, at the row's step."""
    step, ts, car = F.col("step_index"), F.col("ts"), track("tix") == 0
    moved = track("x_rate") * ts
    return {
        "track_id": track("track_id"),
        "object_type": track("object_type"),
        "x": F.when(car, moved).otherwise(track("x0") + moved),
        "y": track("y0") + track("y_rate") * ts,
        "vx": F.when(track("braking").isNotNull(), F.greatest(F.lit(0.0), track("vx0") - track("braking") * ts)).when(step < 5, track("vx0")).otherwise(track("vx5")),
        "vy": track("vy"),
        "heading": track("heading"),
        "valid": car | ((track("p") + step) % 13 != 0),
    }


def states_of(agents: DataFrame) -> DataFrame:
    """``agent_states`` over all steps."""
    state = {name: c.alias(name) for name, c in state_at(F.col).items()}
    return at_steps(tracks_of(agents)).select("scenario_id", "step_index", "ts", state.pop("track_id"), F.col("tix").alias("track_index"), *state.values())


@remembered
def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks_of(agents(spark, sf_dir))


def pair_states(pairs: DataFrame) -> DataFrame:
    """Pairs of tracks, structs ``ego`` and ``other``, as the states of both at each step, with their columns named by side."""
    sides = ("ego", "other")
    tracks = pairs.select("scenario_id", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in sides for c in pairs.schema[side].dataType.names])
    both = [c.alias(f"{side}_{name}") for side in sides for name, c in state_at(lambda c, side=side: F.col(f"{side}_{c}")).items()]
    return at_steps(tracks).select("scenario_id", "step_index", "ts", *both)


@remembered
def agent_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states_of(agents(spark, sf_dir))


@remembered
def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laid_out(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("scenario_id")), sf_dir).distinct().select("scenario_id", F.lit(SDC).alias("sdc_track_id"), F.lit(CURRENT).alias("current_time_index"))


@remembered
def traffic_lights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lights for each order and step."""
    o = laid_out(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scenario_id"), "o_custkey", "o_orderstatus"), sf_dir).withColumn("step_index", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))))
    state = F.expr("CASE o_orderstatus WHEN 'O' THEN 'stop' WHEN 'P' THEN 'arrow_stop' ELSE 'go' END")
    lights = F.array(
        F.struct(F.lit(0).alias("light_pos"), (5 + F.col("o_custkey") % 20).cast("double").alias("stop_x"), F.lit(0.0).alias("stop_y")),
        F.struct(F.lit(1).alias("light_pos"), (8 + F.col("o_custkey") % 15).cast("double").alias("stop_x"), F.lit(0.5).alias("stop_y")),
    )
    return o.select("scenario_id", "step_index", state.alias("state"), F.explode(lights).alias("l")).select("scenario_id", "step_index", "l.light_pos", F.lit(1).cast("long").alias("lane_id"), "state", "l.stop_x", "l.stop_y")


#: feature id, y, first x, last x, lanes that lead in, lanes that lead on.
LANES = ((0, -3.5, -40, 120, (), ()), (1, 0.0, -40, 20, (), (3,)), (2, 3.5, -40, 120, (), ()), (3, 0.0, 20, 120, (1,), ()))
LANE_STEP = 20


def _line(y: float, first: int, last: int) -> Column:
    return F.transform(F.sequence(F.lit(first), F.lit(last), F.lit(LANE_STEP)), lambda x: F.struct(x.cast("double").alias("x"), F.lit(y).alias("y")))


@remembered
def map_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four straight lanes for each scenario, with a point every 20 m."""
    lane = F.array(*[
        F.struct(
            F.lit(i).cast("long").alias("feature_id"), F.lit(k).alias("feature_pos"), F.lit("lane").alias("feature_type"),
            _line(y, a, b).alias("polyline"),
            F.array(*[F.lit(n).cast("long") for n in entry]).cast("array<long>").alias("entry_lanes"), F.array(*[F.lit(n).cast("long") for n in out]).cast("array<long>").alias("exit_lanes"),
        )
        for k, (i, y, a, b, entry, out) in enumerate(LANES)
    ])
    return scenarios(spark, sf_dir).select("scenario_id", F.explode(lane).alias("f")).select("scenario_id", "f.*")


@remembered
def tag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users as tag events: each user is a scenario. They lie where the states of their scenarios do, so that these, and documents made of them, aren't shuffled to meet them."""
    e = laid_out(table(spark, sf_dir, "events").withColumnRenamed("user_id", "scenario_id"), sf_dir)
    order = Window.partitionBy("scenario_id").orderBy("ts", "event_id")
    frame = (F.row_number().over(order) - 1).cast("int")
    review = F.col("event_type").isin("purchase", "error")
    return e.select(
        "scenario_id", frame.alias("frame_index"), F.col("event_type").alias("tag_name"), F.concat(F.lit("r_"), "event_type").alias("rule_id"),
        F.lit("agent").alias("subject_type"), (F.col("event_id") % 2).cast("string").alias("subject_id"), F.when(review, "review").otherwise("debug").alias("intent"),
        F.when(review, "commerce").alias("review_family"), F.get_json_object("props", "$.k").cast("int").alias("review_priority"),
    ).withColumn("ts", F.col("frame_index") * F.lit(STEP_S))


# The same tables in SQL, for the oracle.
SQL = """
WITH base AS (
  SELECT l_orderkey AS scenario_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax, l_discount, l_shipdate) - 1 AS tix,
    l_partkey AS p, l_suppkey AS s, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
steps AS (SELECT CAST(range AS INTEGER) AS step_index, range * CAST(0.125 AS DOUBLE) AS ts FROM range(16)),
st AS MATERIALIZED (
  SELECT scenario_id, step_index, ts, CAST(tix AS VARCHAR) AS track_id, CAST(tix AS INTEGER) AS track_index,
    CASE WHEN tix = 0 THEN 'vehicle' WHEN p % 5 = 0 THEN 'pedestrian' WHEN p % 5 = 1 THEN 'cyclist' ELSE 'vehicle' END AS object_type,
    CASE WHEN tix = 0 THEN (4 + q % 12) * ts ELSE (p % 61) - 12 + (q % 12) * ts END AS x,
    CASE WHEN tix = 0 THEN CASE WHEN s % 3 = 0 THEN 2 * ts ELSE CAST(0 AS DOUBLE) END ELSE ((s % 25) - 12) * CAST(0.5 AS DOUBLE) + ((p % 7) - 3) * CAST(0.5 AS DOUBLE) * ts END AS y,
    CASE WHEN tix = 0 THEN CASE WHEN p % 4 = 0 THEN greatest(CAST(0 AS DOUBLE), (4 + q % 12) - (p % 7) * ts) WHEN p % 4 = 1 THEN CASE WHEN step_index < 5 THEN CAST(1 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END ELSE CAST(4 + q % 12 AS DOUBLE) END
      WHEN p % 4 = 1 THEN CAST(0.5 AS DOUBLE) ELSE CAST(q % 12 AS DOUBLE) END AS vx,
    CASE WHEN tix = 0 THEN CAST(0 AS DOUBLE) ELSE ((p % 7) - 3) * CAST(0.5 AS DOUBLE) END AS vy,
    CASE WHEN tix = 0 THEN CAST(0 AS DOUBLE) ELSE ((s % 9) - 4) * CAST(0.125 AS DOUBLE) END AS heading,
    (tix = 0 OR (p + step_index) % 13 <> 0) AS valid
  FROM base, steps),
ok AS MATERIALIZED (SELECT *, sqrt(vx * vx + vy * vy) AS speed FROM st WHERE valid),
motion AS MATERIALIZED (
  SELECT scenario_id, track_id, step_index, ts - t0 AS dt, s0 AS start_speed, speed AS end_speed, speed - s0 AS speed_delta, CASE WHEN ts > t0 THEN (speed - s0) / (ts - t0) END AS acceleration FROM (
    SELECT *, first_value(ts) OVER w AS t0, first_value(speed) OVER w AS s0 FROM ok
    WINDOW w AS (PARTITION BY scenario_id, track_id ORDER BY ts RANGE BETWEEN 1.0 PRECEDING AND CURRENT ROW))),
sdc AS MATERIALIZED (SELECT * FROM ok WHERE track_id = '0'),
pairs AS MATERIALIZED (
  SELECT e.scenario_id, e.step_index, e.ts, e.track_id || ':' || o.track_id AS subject_id, e.track_id AS ego_id, o.track_id AS other_id,
    e.object_type AS ego_type, o.object_type AS other_type, e.heading AS ego_heading, o.heading AS other_heading, e.speed AS ego_speed, o.speed AS other_speed,
    e.x AS ego_x, e.y AS ego_y, o.x AS other_x, o.y AS other_y,
    o.x - e.x AS lon, o.y - e.y AS lat, e.vx - o.vx AS closing, o.vy - e.vy AS lat_vel, sqrt((o.x - e.x) * (o.x - e.x) + (o.y - e.y) * (o.y - e.y)) AS distance, e.vx AS ego_vx, o.vx AS other_vx
  FROM sdc e JOIN ok o ON e.scenario_id = o.scenario_id AND e.step_index = o.step_index AND e.track_id <> o.track_id),
lights AS (
  SELECT o_orderkey AS scenario_id, step_index, light_pos, CAST(1 AS BIGINT) AS lane_id, CASE o_orderstatus WHEN 'O' THEN 'stop' WHEN 'P' THEN 'arrow_stop' ELSE 'go' END AS state,
    CAST(CASE WHEN light_pos = 0 THEN 5 + o_custkey % 20 ELSE 8 + o_custkey % 15 END AS DOUBLE) AS stop_x, CASE WHEN light_pos = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS stop_y
  FROM orders, steps, (SELECT CAST(range AS INTEGER) AS light_pos FROM range(2))),
red AS (SELECT * FROM lights WHERE state IN ('stop', 'arrow_stop')),
lanes(lane_id, lane_pos, y0, xa, xb) AS (VALUES (CAST(0 AS BIGINT), 0, -3.5, -40, 120), (1, 1, 0.0, -40, 20), (2, 2, 3.5, -40, 120), (3, 3, 0.0, 20, 120)),
scen AS (SELECT DISTINCT l_orderkey AS scenario_id FROM lineitem),
ev AS (
  SELECT user_id AS scenario_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS frame_index, event_type AS tag_name, 'r_' || event_type AS rule_id, 'agent' AS subject_type,
    CAST(event_id % 2 AS VARCHAR) AS subject_id, CASE WHEN event_type IN ('purchase', 'error') THEN 'review' ELSE 'debug' END AS intent,
    CASE WHEN event_type IN ('purchase', 'error') THEN 'commerce' END AS review_family, CAST(json_extract_string(props, '$.k') AS INTEGER) AS review_priority FROM events)
"""
