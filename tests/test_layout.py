"""Plans that keep states where they lie and send no table of them whole to the driver."""

import pytest
from pyspark.sql import functions as F

from roadsift import binding, catalog
from roadsift.operators import features, subjects
from roadsift.sources import relational_maps, sinks

SF = "/root/testdata/sf0.001"


def plan_of(spark, name, sf=SF):
    return catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_states_are_not_shuffled_again(spark):
    for name in ("qlt_01_jump_speed", "src_07_validation"):
        assert "ENSURE_REQUIREMENTS" not in plan_of(spark, name), name


def test_lights_are_not_broadcast(spark):
    assert "Broadcast" not in plan_of(spark, "prd_11_near_red_light_stop_point")


def test_segments_are_not_broadcast_and_agents_not_shuffled(spark):
    assert "Broadcast" not in plan_of(spark, "fea_11_lane_match")
    assert "ENSURE_REQUIREMENTS" not in plan_of(spark, "fea_11_lane_match")


def test_pairs_of_a_frame_need_no_join(spark):
    plan = plan_of(spark, "sub_05_agent_pair_unordered")
    assert "Join" not in plan and "ENSURE_REQUIREMENTS" not in plan


def test_scenarios_are_not_broadcast(spark):
    for name in ("prd_17_sdc_blocked_unable_to_proceed", "prd_23_sdc_repeated_lane_change", "prd_25_same_lane_or_path", "rule_cut_in_risk", "rule_lane_change_conflict", "rule_sdc_vehicle_stopped_at_red", "rul_02_event_metadata", "sub_10_lateral_gate"):
        assert "Broadcast" not in plan_of(spark, name), name


def test_runs_broadcast_no_table(spark):
    for name in ("rul_02_operator_metrics", "run_02_scenario_stats", "run_02_rule_counts"):
        assert "Broadcast" not in plan_of(spark, name), name


def test_a_gate_leaves_states_where_they_lie(spark):
    assert "ENSURE_REQUIREMENTS" not in plan_of(spark, "sub_10_lateral_gate", SF.replace("0.001", "0.1"))  # one partition alone would be dealt out anew


def test_near_pairs_need_no_join(spark):
    plan = plan_of(spark, "sub_08_candidate_prefilter")
    assert "Join" not in plan and "ENSURE_REQUIREMENTS" not in plan


def test_a_window_is_sorted_by_its_frame_alone(spark):
    assert "array_sort" not in plan_of(spark, "fea_04_lateral_range")


def test_places_along_a_line_are_looked_up_once(spark):
    assert str(relational_maps._resampled(F.col("p"), F.col("w"), F.lit(8))).count("filter(") == 1


@pytest.fixture
def large(spark):
    """Plans as they are where no side is small enough to be broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield SF.replace("0.001", "0.1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_documents_are_not_shuffled_to_their_events(spark, large):
    assert "ENSURE_REQUIREMENTS" not in plan_of(spark, "rev_18_payload", large)


def test_whole_documents_are_made_of_states_in_one_pass(spark, large):
    plan = plan_of(spark, "rev_18_whole_payload", large)
    assert "ENSURE_REQUIREMENTS" not in plan and "Expand" not in plan
    assert len([line for line in plan.splitlines() if "FileScan" in line and "l_partkey" in line]) == 1


def test_documents_are_written_compressed(spark, tmp_path):
    frames = ", ".join(f'{{"step_index": {i}}}' for i in range(2000))
    documents = spark.createDataFrame([(0, f'{{"scenario_id": "a", "frames": [{frames}], "events": []}}')], "shard int, document string")
    sinks.write_payloads(documents, str(tmp_path / "p"))
    files = list((tmp_path / "p").glob("shard=*/part-*"))
    assert files and sum(f.stat().st_size for f in files) < 15_000
    index, broken = sinks.index_payloads(spark, str(tmp_path / "p"))
    assert [(r.scenario_id, r.n_frames) for r in index.collect()] == [("a", 2000)] and broken.count() == 0


def test_tokens_meet_nodes_where_they_lie(spark, large):
    plan = plan_of(spark, "nrm_14_map_tokens", large)
    assert "ENSURE_REQUIREMENTS" not in plan and "Join" not in plan


def test_topology_joins_no_lines_that_nobody_asks_for(spark):
    features = spark.createDataFrame([("m", 1, "lane", [(0.0, 0.0), (5.0, 0.0)]), ("m", 2, "lane", [(5.0, 0.0), (9.0, 0.0)]), ("m", 3, "lane", [])], "location string, feature_id long, feature_type string, polyline array<struct<x:double,y:double>>")
    rows = relational_maps.with_topology(features).select("feature_id", "entry_lanes", "exit_lanes")
    assert sorted(map(tuple, rows.collect())) == [(1, [], [2]), (2, [1], []), (3, None, None)]
    joined = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Project" in line]
    assert not any(line.split("Project")[1].strip(" []").endswith("polyline") or ", polyline#" in line for line in joined), joined


def test_a_kind_of_jump_looks_at_nothing_else(spark):
    assert "ATAN2" not in plan_of(spark, "qlt_02_acceleration_jump").upper()
    assert "SQRT" not in plan_of(spark, "qlt_03_heading_jump").upper()


def test_tracks_meet_before_they_become_states(spark):
    for name in ("prd_09_lateral_motion_toward", "sub_07_sdc_pair"):
        assert not [line for line in plan_of(spark, name).splitlines() if "Sort [" in line and "step_index" in line], name


def test_pairs_of_tracks_are_those_of_states(spark):
    pairs, states = catalog.pairs_of(spark, SF), subjects.sdc_pairs(binding.agent_states(spark, SF), binding.scenarios(spark, SF))
    assert sorted(pairs.columns) == sorted(states.columns)
    states = states.select(*pairs.columns)
    assert pairs.count() > 0 and pairs.exceptAll(states).isEmpty() and states.exceptAll(pairs).isEmpty()


def test_segments_are_tested_in_compiled_code(spark):
    """No map of lists by cell is made for each scenario, and no lambda runs for each state and segment."""
    plan = plan_of(spark, "fea_11_lane_match")
    assert "map_from_entries" not in plan and "collect_list" not in plan
    joined = plan[: plan.index("SortMergeJoin")]
    assert "lambdafunction" not in joined and "row_number" in joined


def test_a_state_given_twice_keeps_both_rows_and_their_lane(spark):
    lanes = spark.createDataFrame([(1, 0, "lane", 7, [(0.0, 0.0), (10.0, 0.0), (20.0, 0.0)])], "scenario_id long, feature_pos int, feature_type string, feature_id long, polyline array<struct<x:double,y:double>>")
    states = spark.createDataFrame([(1, 0, 10.0, 1.0, 0.0), (1, 0, 10.0, 1.0, 0.0), (1, 0, 10.0, 9.0, 0.0), (1, 0, None, 1.0, 0.0), (2, 0, 1.0, 1.0, 0.0)], "scenario_id long, step_index int, x double, y double, heading double")
    got = features.lane_match(states, features.lane_segments(lanes), 1.5, 0.7).collect()
    assert sorted((r["scenario_id"], r["y"], r["lane_id"] or 0, r["lane_lateral"] or 0, r["lane_s"] or 0) for r in got) == [(1, 1.0, 0, 0, 0), (1, 1.0, 7, 1.0, 10.0), (1, 1.0, 7, 1.0, 10.0), (1, 9.0, 0, 0, 0), (2, 1.0, 0, 0, 0)]


def test_lanes_are_looked_up_once_for_both_sides_of_pairs(spark):
    for name in ("prd_25_same_lane_or_path", "rule_low_ttc_pair"):
        assert plan_of(spark, name).count("Window [row_number() windowspecdefinition(scenario_id") == 2, name  # one numbers the tracks


def test_steps_of_a_sequence_are_worked_out_once(spark):
    plan = plan_of(spark, "rule_cut_in_risk")
    assert [plan.count(f"filter(_p{k}#") for k in range(4)] == [1, 1, 1, 1]


def test_the_nearest_segment_of_a_lane_is_told_once(spark):
    plan = plan_of(spark, "rule_red_light_running")
    assert plan.count("array_min(") == 1 and "map_from_entries" not in plan


def test_lane_windows_are_sorted_without_a_comparator(spark):
    assert "array_sort" not in plan_of(spark, "prd_22_sdc_lane_changed")
