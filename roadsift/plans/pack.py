"""The shipped rules as data, and their evaluation as one lazy plan.

A single-frame rule is a list of predicates over agents or pairs; a temporal rule refers to tags
of earlier rules. Feature columns that the predicates need are joined once for each subject kind.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsift.operators import align, policy, temporal
from roadsift.operators.predicates import BUILTIN, Registry
from roadsift.scratch import cut


@dataclass(frozen=True)
class Rule:
    """A rule and what it emits. ``conditions`` are (predicate, arguments); ``steps`` are tags of a sequence."""

    tag: str
    subject: str
    conditions: tuple[tuple[str, dict], ...] = ()
    sustained: tuple[str, float] | None = None
    steps: tuple[str, ...] = ()
    within_s: float | None = None
    intent: str = "debug"
    family: str | None = None
    priority: int | None = None
    compact: bool = False
    episode: bool = False
    cooldown: int = 0
    requires: tuple[str, ...] = ()
    current_only: bool = False


VEHICLES = ("pair_types_are", {"ego_type": "vehicle", "other_type": "vehicle"})
MOVING = ("pair_ego_speed_above", {"threshold_mps": 0.5})
STOPPED = (("type_is", {"object_type": "vehicle"}), ("speed_below", {"threshold_mps": 0.5}))


def pair_rules() -> list[Rule]:
    """Rules over pairs that need no features beyond the pair's geometry, in the order of their evaluation."""
    toward = ("lateral_motion_toward", {"min_lateral_speed_mps": 0.2})
    return [
        Rule("cut_in_candidate", "sdc_pair", (VEHICLES, ("close_lateral_gap", {"max_lateral_m": 3.0, "max_longitudinal_m": 10.0}), toward, ("heading_converging", {"min_heading_delta_rad": 0.05, "max_heading_delta_rad": 0.5}))),
        Rule("adjacent_vehicle", "sdc_pair", (VEHICLES, ("lateral_gap_between", {"min_lateral_m": 1.5, "max_lateral_m": 4.5, "max_longitudinal_m": 15.0})), intent="supporting", compact=True),
        Rule(
            "cut_in_lateral_approach", "sdc_pair",
            (VEHICLES, MOVING, ("pair_other_speed_above", {"threshold_mps": 0.5}), ("lateral_gap_between", {"min_lateral_m": 1.0, "max_lateral_m": 4.5, "max_longitudinal_m": 15.0}), toward, ("heading_converging", {"min_heading_delta_rad": 0.0, "max_heading_delta_rad": 0.7})),
            intent="supporting", compact=True,
        ),
        Rule("same_path_overlap", "sdc_pair", (VEHICLES, MOVING, ("same_path_overlap", {"max_lateral_m": 1.2, "min_longitudinal_m": 0.0, "max_longitudinal_m": 20.0})), intent="supporting", compact=True),
    ]


LOW_TTC = Rule(
    "low_ttc_pair", "sdc_pair",
    (
        VEHICLES, MOVING, ("pair_in_front", {"min_longitudinal_m": 1.0, "max_lateral_m": 2.0}), ("low_ttc", {"threshold_s": 3.0, "max_lateral_m": 2.0, "max_longitudinal_m": 60.0, "min_closing_speed_mps": 1.0}),
        ("same_lane_or_path", {"max_lane_lateral_m": 1.8, "max_heading_delta_rad": 0.7, "fallback_max_lateral_m": 1.2, "fallback_max_heading_delta_rad": 0.35}),
    ),
    intent="supporting",
)
TEMPORAL = [
    Rule("sdc_vehicle_stopped_for_3_frames", "sdc_agent", sustained=("sdc_vehicle_stopped", 0.2)),
    Rule("persistent_low_ttc_pair", "sdc_pair", sustained=("low_ttc_pair", 0.2), intent="review", episode=True),
    Rule("cut_in_developing", "sdc_pair", sustained=("cut_in_candidate", 0.2)),
    Rule("cut_in_confirmed", "sdc_pair", steps=("adjacent_vehicle", "cut_in_lateral_approach", "same_path_overlap"), within_s=0.8, intent="review", family="cut_in", priority=10, episode=True),
    Rule("cut_in_risk", "sdc_pair", steps=("adjacent_vehicle", "cut_in_lateral_approach", "same_path_overlap", "low_ttc_pair"), within_s=0.8, intent="review", family="cut_in", priority=20, episode=True),
    Rule("sdc_vehicle_still_stopped_at_red", "sdc_agent", sustained=("sdc_vehicle_stopped_at_red", 0.2)),
]
VEHICLE = ("type_is", {"object_type": "vehicle"})
LINE = {"max_lateral_m": 2.0, "min_speed_mps": 0.5, "max_heading_delta_rad": 0.7}
BEFORE = {"max_before_stop_line_m": 12.0}
AFTER = {
    "min_after_stop_line_m": 0.5, "max_after_stop_line_m": 15.0, "max_lane_heading_change_rad": 0.35, "lane_heading_lookahead_m": 15.0, "max_future_heading_change_rad": 0.25, "future_heading_horizon_seconds": 2.0,
    "extended_max_future_heading_change_rad": 0.45, "extended_future_heading_horizon_seconds": 5.0,
}
BRAKING = {
    "other_types": ("vehicle", "pedestrian", "cyclist"), "window_seconds": 1.0, "max_acceleration_mps2": -3.0, "min_speed_drop_mps": 2.0, "min_start_speed_mps": 3.0, "max_front_longitudinal_m": 35.0, "max_lateral_m": 4.0,
    "traffic_control_max_stop_longitudinal_m": 40.0, "traffic_control_max_stop_lateral_m": 4.0, "traffic_control_target_margin_m": 5.0,
}
BLOCKED = {
    "blocker_types": ("vehicle", "pedestrian", "cyclist", "unknown"), "window_seconds": 1.0, "min_stopped_duration_seconds": 0.5, "max_ego_speed_mps": 0.4, "min_recent_ego_motion_mps": 0.2, "max_blocker_speed_mps": 0.8,
    "min_front_longitudinal_m": 1.0, "max_front_longitudinal_m": 12.0, "max_lateral_m": 2.5, "traffic_control_max_stop_longitudinal_m": 17.0, "traffic_control_max_stop_lateral_m": 2.5, "min_queue_vehicle_count": 2,
    "queue_max_front_longitudinal_m": 22.0, "queue_max_lateral_m": 2.8,
}
VRU = {
    "vru_types": ("pedestrian", "cyclist"), "min_longitudinal_m": 0.0, "behind_min_longitudinal_m": -2.0, "behind_close_distance_m": 5.0, "max_longitudinal_m": 16.0, "max_lateral_m": 5.0, "max_distance_m": 12.0,
    "min_ego_speed_mps": 0.5, "min_closing_speed_mps": 0.2, "close_lateral_m": 3.5, "wide_lateral_min_closing_speed_mps": 1.5, "immediate_distance_m": 6.0, "max_ttc_s": 4.0,
    "high_immediate_distance_m": 4.5, "high_max_ttc_s": 2.5, "high_close_lateral_m": 3.0, "high_ttc_lateral_m": 3.5, "high_ego_response_max_distance_m": 10.0, "ego_response_window_seconds": 1.0,
    "ego_response_max_acceleration_mps2": -2.0, "ego_response_min_speed_drop_mps": 1.0,
    "type_thresholds": {
        "pedestrian": {"max_distance_m": 10.0, "max_lateral_m": 4.0, "close_lateral_m": 3.0, "high_close_lateral_m": 2.6, "high_ttc_lateral_m": 3.2, "min_closing_speed_mps": 0.8, "wide_lateral_min_closing_speed_mps": 1.5},
        "cyclist": {"max_distance_m": 12.0, "max_lateral_m": 5.0, "close_lateral_m": 3.5, "high_close_lateral_m": 3.0, "high_ttc_lateral_m": 4.0, "min_closing_speed_mps": 0.5, "wide_lateral_min_closing_speed_mps": 1.2},
    },
}
CONFLICT = {
    "window_seconds": 3.0, "max_lane_lateral_m": 1.8, "target_lane_lateral_m": 2.2, "max_heading_delta_rad": 0.7, "min_lateral_displacement_m": 1.5, "max_front_longitudinal_m": 25.0, "max_behind_longitudinal_m": 20.0,
    "max_lateral_m": 3.0, "max_ttc_s": 4.0, "min_closing_speed_mps": 0.5, "min_target_speed_mps": 1.0,
}
REPEATED = {"window_seconds": 3.0, "min_lane_changes": 2, "max_lateral_m": 1.5, "max_heading_delta_rad": 0.7, "min_speed_mps": 2.0, "min_stable_duration_seconds": 0.1, "min_lateral_displacement_m": 2.5}
#: Boxes before any other test of a pair, for rules whose candidates lie within one.
BOXES = {"vru_close_interaction": {"min_lon": 0.0, "max_lon": 16.0, "max_lat": 5.0, "max_distance": 12.0}}
#: Single-frame rules over the car, its lights, lanes and motion: some of their predicates need joined features.
FEATURED = [
    Rule("sdc_vehicle_stopped", "sdc_agent", STOPPED, compact=True),
    Rule("sdc_vehicle_stopped_at_red", "sdc_agent", (*STOPPED, ("near_red_light_stop_point", {"max_distance_m": 5.0})), compact=True, requires=("traffic_lights",)),
    Rule("red_light_stop_line_approach", "sdc_agent", (VEHICLE, ("red_light_before_stop_line", LINE | BEFORE)), intent="supporting", requires=("traffic_lights", "lane_geometry")),
    Rule("red_light_stop_line_crossed", "sdc_agent", (VEHICLE, ("red_light_after_stop_line", LINE | AFTER)), intent="supporting", requires=("traffic_lights", "lane_geometry")),
    Rule("red_light_running", "sdc_agent", (VEHICLE, ("red_light_crossing_transition", LINE | BEFORE | AFTER)), intent="review", episode=True, cooldown=30, requires=("traffic_lights", "lane_geometry")),
    Rule("sdc_hard_braking", "sdc_pair", (("pair_types_are", {"ego_type": "vehicle"}), ("pair_ego_hard_braking", BRAKING)), intent="review", family="sdc_response", priority=30, episode=True, cooldown=20),
    Rule("sdc_blocked_unable_to_proceed", "sdc_pair", (("sdc_blocked_unable_to_proceed", BLOCKED),), intent="review", family="planner_blocked", priority=18, episode=True, cooldown=20, current_only=True),
    Rule("vru_close_interaction", "sdc_pair", (("vru_close_interaction", VRU),), intent="review", family="vru", priority=20, episode=True, cooldown=20),
    Rule("lane_change_conflict", "sdc_pair", (("sdc_lane_change_conflict", CONFLICT),), intent="review", family="lane_change", priority=20, episode=True, cooldown=20, current_only=True, requires=("lane_geometry",)),
    Rule("sdc_repeated_lane_change", "sdc_agent", (VEHICLE, ("sdc_repeated_lane_change", REPEATED)), intent="review", episode=True, cooldown=30, current_only=True, requires=("lane_geometry",)),
]


def all_rules() -> list[Rule]:
    """The shipped rules, in the order of their evaluation."""
    return [*pair_rules(), LOW_TTC, *FEATURED, *TEMPORAL]


def on_grid(rules: list[Rule], step_s: float) -> list[Rule]:
    """Rules for frames that are step_s apart: a sustained time becomes the least whole number of steps that is as long, as a tag must have held exactly since a frame."""
    return [replace(r, sustained=(r.sustained[0], math.ceil(r.sustained[1] / step_s - 1e-9) * step_s)) if r.sustained else r for r in rules]


def eligible(events: DataFrame, rules: list[Rule], frames: DataFrame) -> DataFrame:
    """Events of frames that their rule applies to.

    ``frames`` has scenario_id, step_index, visibility and modalities, as align gives them: frames that lack
    what a rule requires don't count for it, and for a rule of the current frame alone no other does.
    """
    offered = frames.select("scenario_id", F.col("step_index").alias("frame_index"), "visibility", "modalities")
    ok = F.lit(True)
    for rule in rules:
        if rule.requires or rule.current_only:
            ok = F.when(F.col("tag_name") == rule.tag, align.applies(list(rule.requires), rule.current_only)).otherwise(ok)
    return events.join(offered.hint("merge"), ["scenario_id", "frame_index"]).filter(ok).select(*events.columns)


def single_frame(candidates: DataFrame, rules: list[Rule], registry: Registry = BUILTIN) -> DataFrame:
    """Tag events of rules over one table of subjects, in one pass: a row for each rule that holds."""
    def passed(rule: Rule):
        test = F.lit(True)
        for name, args in rule.conditions:
            test = test & registry(name, **args)
        event = F.struct(F.lit(rule.tag).alias("tag_name"), F.lit(rule.intent).alias("intent"), F.lit(rule.family).cast("string").alias("review_family"), F.lit(rule.priority).cast("int").alias("review_priority"))
        return F.when(test, event)

    found = F.array_compact(F.array(*[passed(r) for r in rules]))
    rows = candidates.select("scenario_id", F.col("step_index").alias("frame_index"), "ts", "subject_id", F.explode(found).alias("e"))
    return as_events(rows.select("scenario_id", "frame_index", "ts", "subject_id", "e.*"), rules[0].subject)


def as_events(rows: DataFrame, subject: str) -> DataFrame:
    return rows.select(
        "scenario_id", "frame_index", "ts", "tag_name", F.col("tag_name").alias("rule_id"), F.lit("agent_pair" if "pair" in subject else "agent").alias("subject_type"), "subject_id", "intent", "review_family", "review_priority"
    )


def tagged(rows: DataFrame, rule: Rule) -> DataFrame:
    """Events of one rule for (scenario_id, frame_index, ts, subject_id) rows."""
    cols = {"tag_name": F.lit(rule.tag), "intent": F.lit(rule.intent), "review_family": F.lit(rule.family).cast("string"), "review_priority": F.lit(rule.priority).cast("int")}
    return as_events(rows.select("scenario_id", "frame_index", "ts", "subject_id", *[c.alias(n) for n, c in cols.items()]), rule.subject)


def temporal_events(events: DataFrame, rule: Rule) -> DataFrame:
    """Detections of a temporal rule with first_frame and last_frame, over events before any policy."""
    if rule.sustained:
        return temporal.sustained_seconds(events, *rule.sustained)
    return temporal.sequence(events, list(rule.steps), seconds=rule.within_s).drop("chain")


def gates(rules: list[Rule]) -> dict[str, set[str]]:
    """For each tag that only counts for subjects with a step before it, those steps; in an order in which each gate comes after the gates of its steps.

    These are the later steps of sequences. What begins a sequence or is the source of a sustained rule counts everywhere.
    """
    free = {r.sustained[0] for r in rules if r.sustained} | {r.steps[0] for r in rules if r.steps}
    out: dict[str, set[str]] = {}
    for _, tag, before in sorted((k, r.steps[k], r.steps[k - 1]) for r in rules for k in range(1, len(r.steps)) if r.steps[k] not in free):
        out.setdefault(tag, set()).add(before)
    return out


def gate_sequences(events: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Later steps of sequences count only for subjects that carry the step before, which may be gated itself."""
    subject = Window.partitionBy("scenario_id", "subject_id")
    rows, kept = events.withColumn("_kept", F.lit(True)), F.col("_kept")
    for tag, before in gates(TEMPORAL if rules is None else rules).items():
        carries = F.max(kept & F.col("tag_name").isin(*sorted(before))).over(subject)
        rows = rows.withColumn("_carries", carries).withColumn("_kept", F.when(F.col("tag_name") == tag, F.col("_carries")).otherwise(kept)).drop("_carries")
    return rows.filter("_kept").drop("_kept")


def _per_tag(rules: list[Rule], value: Callable[[Rule], int], otherwise: int) -> Column:
    out = F.lit(otherwise)
    for v in sorted({value(r) for r in rules} - {otherwise}):
        out = F.when(F.col("tag_name").isin(*[r.tag for r in rules if value(r) == v]), v).otherwise(out)
    return out


def with_policies(events: DataFrame, rules: list[Rule]) -> DataFrame:
    """Compaction or episodes and cooldown as each event's rule says, in one pass over all of them, then dominance. Steps that are read more than once go through tables of the shared folder."""
    gap = _per_tag(rules, lambda r: 1 if r.compact and r.intent != "review" else max(1, r.cooldown) if r.episode else -1, -1)
    cooled = cut(policy.cooldown(cut(policy.merged(events, gap)), _per_tag(rules, lambda r: r.cooldown, 0)))
    return policy.dominance(cooled)
