"""Trajectory quality: jumps between a track's successive rows."""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadsift.functions.geometry import speed, wrapped

JUMP_MPS, ACCELERATION_MPS2, HEADING_RAD = 80.0, 25.0, 1.6


KINDS = ("jump_speed", "acceleration_jump", "heading_jump")


def quality_issues(states: DataFrame, jump: float = JUMP_MPS, acceleration: float = ACCELERATION_MPS2, heading: float = HEADING_RAD, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """jump_speed, acceleration_jump and heading_jump, or those of ``kinds``, of each valid state against the row before, if that is valid too.

    Only what these kinds look at is sorted and kept of the row before.
    """
    looked = {"jump_speed": ("x", "y"), "acceleration_jump": ("speed",), "heading_jump": ("heading",)}
    seen = [c for k in KINDS if k in kinds for c in looked[k]]
    kept = ["scenario_id", "track_id", "step_index", "ts", "valid", *seen]
    order = Window.partitionBy("scenario_id", "track_id").orderBy("step_index")
    before = {f"_{c}": F.lag(c).over(order) for c in ("step_index", "ts", "valid", *seen)}
    rows = states.withColumn("speed", speed()).select(*kept).withColumns(before).filter("valid AND _valid AND ts > _ts")
    dt, turn = F.col("ts") - F.col("_ts"), F.abs(F.col("heading") - F.col("_heading"))
    dx, dy = F.col("x") - F.col("_x"), F.col("y") - F.col("_y")
    told = {"jump_speed": (F.sqrt(dx * dx + dy * dy) / dt, jump), "acceleration_jump": (F.abs(F.col("speed") - F.col("_speed")) / dt, acceleration), "heading_jump": (wrapped(F.col("heading"), F.col("_heading")), heading)}
    over = {k: v > limit for k, (v, limit) in told.items()}
    over["heading_jump"] = (turn > min(heading, math.pi) - 1e-9) & over["heading_jump"]  # the short way round is never longer, and costs three functions of angles
    mine = [k for k in KINDS if k in kinds]
    rows = rows.filter(functools.reduce(operator.or_, [F.coalesce(over[k], F.lit(False)) for k in mine]))  # before arrays are made for each row
    issues = F.filter(F.array(*[F.struct(F.lit(k).alias("issue_type"), told[k][0].alias("value"), F.lit(told[k][1]).alias("threshold")) for k in mine]), lambda i: i["value"] > i["threshold"])
    return rows.select("scenario_id", "track_id", "step_index", F.col("_step_index").alias("previous_step"), F.explode(issues).alias("i")).select("scenario_id", "track_id", "step_index", "previous_step", "i.*")
