"""Named predicates: functions of arguments that give a boolean column over agents or pairs.

Agent predicates read the columns of valid states, pair predicates those of subjects.with_geometry;
some need feature columns beside them, named in their docstring. Unknown values count as false.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadsift.functions.geometry import wrapped_once

Predicate = Callable[..., Column]


class Registry:
    """Predicates by name; a name is registered once and unknown ones are errors."""

    def __init__(self) -> None:
        self._by_name: dict[str, Predicate] = {}

    def register(self, name: str, predicate: Predicate) -> None:
        if name in self._by_name:
            raise ValueError(f"predicate {name} is registered already")
        self._by_name[name] = predicate

    def get(self, name: str) -> Predicate:
        if name not in self._by_name:
            raise KeyError(f"no predicate {name}")
        return self._by_name[name]

    def names(self) -> list[str]:
        return sorted(self._by_name)

    def __call__(self, name: str, **args: object) -> Column:
        return F.coalesce(self.get(name)(**args), F.lit(False))


BUILTIN = Registry()


def predicate(f: Predicate) -> Predicate:
    BUILTIN.register(f.__name__, f)
    return f


_NAMES: ContextVar[dict[str, str]] = ContextVar("names of columns", default={})


@contextmanager
def reading(names: dict[str, str]) -> Iterator[None]:
    """Within this, predicates read the given columns in place of those that they name."""
    token = _NAMES.set(names)
    try:
        yield
    finally:
        _NAMES.reset(token)


def _c(name: str) -> Column:
    return F.col(_NAMES.get().get(name, name))


@predicate
def type_is(object_type: str) -> Column:
    return _c("object_type") == object_type


@predicate
def speed_below(threshold_mps: float) -> Column:
    return _c("speed") < threshold_mps


@predicate
def speed_above(threshold_mps: float) -> Column:
    return _c("speed") > threshold_mps


@predicate
def pair_types_are(ego_type: str | None = None, other_type: str | None = None) -> Column:
    return (F.lit(ego_type is None) | (_c("ego_type") == (ego_type or ""))) & (F.lit(other_type is None) | (_c("other_type") == (other_type or "")))


@predicate
def pair_other_type_in(object_types: tuple[str, ...]) -> Column:
    return _c("other_type").isin(*object_types)


@predicate
def pair_in_front(min_longitudinal_m: float = 0.0, max_lateral_m: float = 4.0) -> Column:
    return (_c("lon") >= min_longitudinal_m) & (F.abs("lat") <= max_lateral_m)


@predicate
def low_ttc(threshold_s: float, max_lateral_m: float = 4.0, max_longitudinal_m: float | None = None, min_closing_speed_mps: float = 0.1) -> Column:
    near = F.lit(True) if max_longitudinal_m is None else _c("lon") <= max_longitudinal_m
    return (F.abs("lat") <= max_lateral_m) & near & (_c("closing") >= min_closing_speed_mps) & (_c("lon") > 0) & (F.try_divide("lon", "closing") < threshold_s)


@predicate
def close_lateral_gap(max_lateral_m: float, max_longitudinal_m: float) -> Column:
    return (F.abs("lat") <= max_lateral_m) & (F.abs("lon") <= max_longitudinal_m)


@predicate
def lateral_motion_toward(min_lateral_speed_mps: float) -> Column:
    return F.when(_c("lat") > 0, _c("lat_vel") < -min_lateral_speed_mps).otherwise(_c("lat_vel") > min_lateral_speed_mps)


@predicate
def heading_converging(min_heading_delta_rad: float, max_heading_delta_rad: float) -> Column:
    return wrapped_once(_c("ego_heading"), _c("other_heading")).between(min_heading_delta_rad, max_heading_delta_rad)


@predicate
def near_red_light_stop_point() -> Column:
    """Needs near_red_lane from light_predicates.near_red_stop."""
    return _c("near_red_lane").isNotNull()


@predicate
def lateral_gap_between(min_lateral_m: float, max_lateral_m: float, max_longitudinal_m: float) -> Column:
    return F.abs("lat").between(min_lateral_m, max_lateral_m) & (F.abs("lon") <= max_longitudinal_m)


@predicate
def pair_ego_speed_above(threshold_mps: float) -> Column:
    return _c("ego_speed") > threshold_mps


@predicate
def pair_other_speed_above(threshold_mps: float) -> Column:
    return _c("other_speed") > threshold_mps


@predicate
def pair_ego_hard_braking(
    max_acceleration_mps2: float, min_speed_drop_mps: float = 0.0, min_start_speed_mps: float = 0.0, max_front_longitudinal_m: float = 40.0, max_lateral_m: float = 4.0,
    other_types: tuple[str, ...] = ("vehicle", "pedestrian", "cyclist"),
) -> Column:
    """Needs the ego's speed_delta, start_speed and acceleration."""
    box = (_c("lon") >= 0) & (_c("lon") <= max_front_longitudinal_m) & (F.abs("lat") <= max_lateral_m)
    return _c("other_type").isin(*other_types) & box & (_c("acceleration") <= max_acceleration_mps2) & (-_c("speed_delta") >= min_speed_drop_mps) & (_c("start_speed") >= min_start_speed_mps)


def braking_context(margin_m: float = 5.0) -> Column:
    """Whether a red stop point (red_lon) explains the braking."""
    return F.coalesce(_c("red_lon") <= _c("lon") + margin_m, F.lit(False))


@predicate
def same_path_overlap(max_lateral_m: float, max_longitudinal_m: float, min_longitudinal_m: float = 0.0) -> Column:
    return (F.abs("lat") <= max_lateral_m) & _c("lon").between(min_longitudinal_m, max_longitudinal_m)


def _by_type(name: str, default: float, per_type: dict[str, dict[str, float]]) -> Column:
    out = F.lit(float(default))
    for kind, own in per_type.items():
        if name in own:
            out = F.when(_c("other_type") == kind, F.lit(float(own[name]))).otherwise(out)
    return out


def vru_reasons(args: dict) -> dict[str, Column]:
    """The reasons for which an interaction's risk is high; needs the ego's motion."""
    per = args.get("type_thresholds", {})
    max_lat = _by_type("max_lateral_m", args.get("max_lateral_m", 8.0), per)
    close = _by_type("close_lateral_m", args["close_lateral_m"], per) if "close_lateral_m" in args else max_lat
    high_close = _by_type("high_close_lateral_m", args["high_close_lateral_m"], per) if "high_close_lateral_m" in args else close
    high_ttc = _by_type("high_ttc_lateral_m", args["high_ttc_lateral_m"], per) if "high_ttc_lateral_m" in args else max_lat
    return {
        "immediate_distance": (_c("distance") <= args.get("high_immediate_distance_m", 5.0)) & (F.abs("lat") <= high_close),
        "low_ttc": (pair_ttc() <= args.get("high_max_ttc_s", 3.0)) & (F.abs("lat") <= high_ttc),
        "ego_response": ego_response(args) & (_c("distance") <= args.get("high_ego_response_max_distance_m", 10.0)) & (F.abs("lat") <= high_ttc),
    }


def pair_ttc() -> Column:
    return F.when((_c("lon") > 0) & (_c("closing") > 0), F.try_divide("lon", "closing")).otherwise(F.lit(float("inf")))


def ego_response(args: dict) -> Column:
    return F.coalesce((_c("acceleration") <= args.get("ego_response_max_acceleration_mps2", -2.0)) | ((-_c("speed_delta") >= args.get("ego_response_min_speed_drop_mps", 1.0)) & _c("acceleration").isNotNull()), F.lit(False))


@predicate
def vru_close_interaction(**args: object) -> Column:
    """Needs the ego's speed_delta and acceleration."""
    per = args.get("type_thresholds", {})
    min_lon = args.get("min_longitudinal_m", -5.0)
    max_lon = _by_type("max_longitudinal_m", args.get("max_longitudinal_m", 20.0), per)
    max_lat = _by_type("max_lateral_m", args.get("max_lateral_m", 8.0), per)
    max_distance = _by_type("max_distance_m", args.get("max_distance_m", 15.0), per)
    min_closing = _by_type("min_closing_speed_mps", args.get("min_closing_speed_mps", float("-inf")), per)
    close = _by_type("close_lateral_m", args["close_lateral_m"], per) if "close_lateral_m" in args else max_lat
    wide = _by_type("wide_lateral_min_closing_speed_mps", args["wide_lateral_min_closing_speed_mps"], per) if "wide_lateral_min_closing_speed_mps" in args else min_closing
    behind = (_c("lon") >= args.get("behind_min_longitudinal_m", min_lon)) & (_c("lon") < min_lon) & (_c("distance") <= args.get("behind_close_distance_m", 0.0))
    lon_ok = F.when(_c("lon") < min_lon, behind).otherwise(_c("lon") <= max_lon)
    lat_ok = (F.abs("lat") <= close) | ((F.abs("lat") <= max_lat) & (_c("closing") >= wide))
    risk = (_c("distance") <= args.get("immediate_distance_m", 6.0)) | (pair_ttc() <= args.get("max_ttc_s", 4.0)) | ego_response(args)
    types = (_c("ego_type") == "vehicle") & _c("other_type").isin(*args.get("vru_types", ("pedestrian", "cyclist")))
    return types & lon_ok & lat_ok & (_c("distance") <= max_distance) & (_c("ego_speed") >= args.get("min_ego_speed_mps", 0.0)) & (_c("closing") >= min_closing) & risk


def blocked_box(args: dict) -> Column:
    types = (_c("ego_type") == "vehicle") & _c("other_type").isin(*args.get("blocker_types", ("vehicle", "pedestrian", "cyclist", "unknown")))
    box = _c("lon").between(args.get("min_front_longitudinal_m", 1.0), args.get("max_front_longitudinal_m", 12.0)) & (F.abs("lat") <= args.get("max_lateral_m", 2.5))
    return types & box & (_c("ego_speed") <= args.get("max_ego_speed_mps", 0.4)) & (_c("other_speed") <= args.get("max_blocker_speed_mps", 0.8))


@predicate
def sdc_blocked_unable_to_proceed(**args: object) -> Column:
    """Needs the ego's top_speed, low_seconds and low_count, red_lane, and queue: slow vehicles beside the blocker in the corridor."""
    if args.get("min_stopped_duration_seconds") is not None:
        stopped = _c("low_seconds") >= args["min_stopped_duration_seconds"]
    else:
        stopped = _c("low_count") >= args.get("min_stopped_frames", 6)
    queued = (_c("other_type") == "vehicle") & (_c("queue") >= args.get("min_queue_vehicle_count", 2)) | ((_c("other_type") != "vehicle") & F.lit(1 >= args.get("min_queue_vehicle_count", 2)))
    return blocked_box(args) & (_c("top_speed") >= args.get("min_recent_ego_motion_mps", 0.0)) & stopped & _c("red_lane").isNull() & ~queued


@predicate
def same_lane_or_path(fallback_max_lateral_m: float = 1.2, fallback_max_heading_delta_rad: float = 0.35, allow_fallback_without_map: bool = True) -> Column:
    """Needs ego_lane and other_lane, and has_map."""
    ego, other = _c("ego_lane"), _c("other_lane")
    path = (F.abs("lat") <= fallback_max_lateral_m) & (wrapped_once(_c("ego_heading"), _c("other_heading")) <= fallback_max_heading_delta_rad) & F.lit(allow_fallback_without_map)
    one = ego.isNull() != other.isNull()
    return F.when(ego.isNotNull() & other.isNotNull(), ego == other).when(one & _c("has_map"), F.lit(False)).otherwise(path)


@predicate
def red_light_before_stop_line(max_lateral_m: float, max_before_stop_line_m: float, min_speed_mps: float, max_heading_delta_rad: float) -> Column:
    """Over a valid state joined with a red lane (light_predicates.at_red_lanes)."""
    return (_c("speed") >= min_speed_mps) & (F.abs("line_lat") <= max_lateral_m) & (_c("line_lon") >= -max_before_stop_line_m) & (_c("line_lon") < 0) & (_c("line_heading") <= max_heading_delta_rad)


@predicate
def red_light_after_stop_line(
    max_lateral_m: float, min_after_stop_line_m: float, max_after_stop_line_m: float, min_speed_mps: float, max_heading_delta_rad: float,
    max_future_heading_change_rad: float | None = None, extended_max_future_heading_change_rad: float | None = None,
) -> Column:
    """As above; needs turn and long_turn, the heading changes within the two horizons."""
    out = (_c("speed") >= min_speed_mps) & (F.abs("line_lat") <= max_lateral_m) & _c("line_lon").between(min_after_stop_line_m, max_after_stop_line_m) & (_c("line_heading") <= max_heading_delta_rad)
    for limit, name in ((max_future_heading_change_rad, "turn"), (extended_max_future_heading_change_rad, "long_turn")):
        if limit is not None:
            out = out & ~F.coalesce(_c(name) > limit, F.lit(False))
    return out


@predicate
def red_light_crossing_transition() -> Column:
    """Needs before_frame of light_predicates.crossings."""
    return _c("before_frame").isNotNull()


@predicate
def sdc_lane_changed() -> Column:
    """Needs current_lane of lane_predicates.lane_changes."""
    return _c("current_lane").isNotNull()


@predicate
def sdc_repeated_lane_change(min_lane_changes: int) -> Column:
    """Needs lane_changes of lane_predicates.repeated_changes."""
    return _c("lane_changes") >= min_lane_changes


@predicate
def sdc_lane_change_conflict() -> Column:
    """Needs conflict_mode of lane_predicates.conflicts."""
    return _c("conflict_mode").isNotNull()
