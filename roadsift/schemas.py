"""Column layouts of the scenario tables."""

from __future__ import annotations

AGENT_STATES = "scenario_id long, step_index int, ts double, track_id string, track_index int, object_type string, x double, y double, vx double, vy double, heading double, valid boolean"
TRAFFIC_LIGHTS = "scenario_id long, step_index int, light_pos int, lane_id long, state string, stop_x double, stop_y double"
MAP_FEATURES = "scenario_id long, feature_id long, feature_pos int, feature_type string, polyline array<struct<x:double,y:double>>, entry_lanes array<long>, exit_lanes array<long>"
SCENARIOS = "scenario_id long, sdc_track_id string, current_time_index int"
TAG_EVENTS = "scenario_id long, frame_index int, ts double, tag_name string, rule_id string, subject_type string, subject_id string, intent string, review_family string, review_priority int, risk_level string"

RED_STATES = ("stop", "arrow_stop")
"""Light states that hold traffic."""
