"""Small scenes with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from roadsift.operators import features, policy, quality, subjects, temporal
from roadsift.operators.predicates import BUILTIN, Registry
from roadsift.schemas import AGENT_STATES, MAP_FEATURES, TRAFFIC_LIGHTS


def agent(step, track, x, y=0.0, vx=0.0, vy=0.0, heading=0.0, kind="vehicle", valid=True, dt=0.1):
    return (1, step, step * dt, str(track), int(track), kind, float(x), float(y), float(vx), float(vy), float(heading), valid)


def states(spark, rows):
    return spark.createDataFrame(rows, AGENT_STATES)


def scenarios(spark, sdc="1"):
    return spark.createDataFrame([(1, sdc, 10)], "scenario_id long, sdc_track_id string, current_time_index int")


def events(spark, rows):
    """rows: (subject, frame, tag, intent, family, priority)."""
    out = [(1, f, f * 0.1, t, f"r_{t}", "agent", s, i, fam, p) for s, f, t, i, fam, p in rows]
    return spark.createDataFrame(out, "scenario_id long, frame_index int, ts double, tag_name string, rule_id string, subject_type string, subject_id string, intent string, review_family string, review_priority int")


def test_hard_braking_pair(spark):
    st = states(spark, [agent(0, 1, 0, vx=12), agent(10, 1, 8, vx=7), agent(0, 2, 25), agent(10, 2, 24)])
    motion = features.speed_change(st).filter("track_id = '1' AND step_index = 10").first()
    assert motion["acceleration"] == pytest.approx(-5.0)
    pair = subjects.sdc_pairs(st, scenarios(spark)).filter("step_index = 10").first()
    assert (pair["subject_id"], pair["lon"], pair["lat"]) == ("1:2", 16.0, 0.0)


def test_red_stop_behind_margin(spark):
    st = states(spark, [agent(0, 1, 0)])
    lights = spark.createDataFrame([(1, 0, 0, 7, "stop", 13.0, 0.0), (1, 0, 1, 8, "stop", 5.0, 9.0), (1, 0, 2, 9, "go", 4.0, 0.0)], TRAFFIC_LIGHTS)
    ego = subjects.valid_states(st).select("scenario_id", "step_index", F.col("track_id").alias("ego_id"), F.col("x").alias("ego_x"), F.col("y").alias("ego_y"), F.col("heading").alias("ego_heading"))
    assert features.red_stop_ahead(ego, lights, 40.0, 4.0).first()["red_lane"] == 7


def test_jump_needs_valid_row_before(spark):
    rows = [agent(0, 1, 0, vx=1, dt=0.5), agent(1, 1, 100, vx=1, dt=0.5), agent(2, 1, 101, vx=1, dt=0.5)]
    found = quality.quality_issues(states(spark, rows), jump=50.0).collect()
    assert [(r["issue_type"], r["step_index"], r["previous_step"]) for r in found] == [("jump_speed", 1, 0)]
    rows[1] = agent(1, 1, 100, vx=1, valid=False, dt=0.5)
    assert quality.quality_issues(states(spark, rows), jump=50.0).count() == 0


def test_lane_match_prefers_score(spark):
    line = lambda *p: [{"x": float(a), "y": float(b)} for a, b in p]
    lanes = spark.createDataFrame([(1, 10, 0, "lane", line((-10, -5.463), (10, 5.463)), [], []), (1, 11, 1, "lane", line((-10, 0.6), (10, 0.6)), [], [])], MAP_FEATURES)
    got = features.lane_match(subjects.valid_states(states(spark, [agent(0, 1, 0)])), features.lane_segments(lanes), 1.5, 0.7).first()
    assert (got["lane_id"], round(got["lane_lateral"], 6)) == (11, 0.6)


def test_lane_direction_without_length(spark):
    line = [{"x": 0.0, "y": 0.0}, {"x": 0.0, "y": 0.0}]
    lights = spark.createDataFrame([(1, 0, 0, 5, "stop", 0.0, 0.0)], TRAFFIC_LIGHTS)
    lanes = spark.createDataFrame([(1, 5, 0, "lane", line, [], [])], MAP_FEATURES)
    assert features.red_lanes(lights, lanes).count() == 0


def test_lane_turn_on_a_bend(spark):
    line = [{"x": a, "y": b} for a, b in ((-20.0, 0.0), (0.0, 0.0), (5.0, 0.0), (5.0, 5.0))]
    lights = spark.createDataFrame([(1, 0, 0, 7, "stop", 0.0, 0.0)], TRAFFIC_LIGHTS)
    lanes = spark.createDataFrame([(1, 7, 0, "lane", line, [], [])], MAP_FEATURES)
    row = features.red_lanes(lights, lanes).first()
    assert (row["dir_x"], row["dir_y"]) == (1.0, 0.0)
    assert row["lane_turn"] == pytest.approx(1.5707963)


def test_cooldown(spark):
    ev = events(spark, [("1", f, "t", "debug", None, None) for f in (0, 1, 2, 3)] + [("2", 1, "t", "debug", None, None)])
    kept = {(r["subject_id"], r["frame_index"], r["suppressed_until"]) for r in policy.cooldown(ev, 2).collect()}
    assert kept == {("1", 0, 2), ("1", 3, 5), ("2", 1, 3)}


def test_compaction(spark):
    ev = events(spark, [("1", f, "t", "debug", None, None) for f in (0, 1, 2, 4, 5)] + [("2", 1, "t", "debug", None, None)])
    got = {(r["subject_id"], r["frame_index"], r["end_frame"], r["event_count"]) for r in policy.compact(ev).collect()}
    assert got == {("1", 0, 2, 3), ("1", 4, 5, 2), ("2", 1, 1, 1)}


def test_episode_with_cooldown_gap(spark):
    ev = events(spark, [("1", f, "t", "review", None, None) for f in (4, 8, 9, 28, 36)])
    (row,) = policy.episodes(ev, 20).collect()
    assert (row["frame_index"], row["end_frame"], row["raw_frames"]) == (4, 36, [4, 8, 9, 28, 36])


@pytest.mark.parametrize(("low", "high", "left"), [((3, 5), (3, 5), {20}), ((1, 2), (8, 9), {10, 20})])
def test_dominance(spark, low, high, left):
    ev = events(spark, [("1", low[0], "a", "review", "cut_in", 10), ("1", high[0], "b", "review", "cut_in", 20)])
    ev = ev.withColumn("end_frame", F.when(F.col("review_priority") == 10, low[1]).otherwise(high[1]))
    assert {r["review_priority"] for r in policy.dominance(ev).collect()} == left


def test_sustained_exact_seconds(spark):
    ev = spark.createDataFrame([(1, f, f * 0.125, "m", "1") for f in (0, 1, 2, 4)], "scenario_id long, frame_index int, ts double, tag_name string, subject_id string")
    assert [(r["first_frame"], r["frame_index"]) for r in temporal.sustained_seconds(ev, "m", 0.25).collect()] == [(0, 2)]
    assert temporal.sustained_seconds(ev, "m", 0.2).count() == 0
    assert temporal.sustained_seconds(ev, "m", 0.2, mode="at_least").count() == 1


@pytest.mark.parametrize(("seconds", "gap", "hit"), [(0.25, 1, True), (0.15, 1, False), (0.25, 0, False)])
def test_sequence_window_and_gap(spark, seconds, gap, hit):
    ev = spark.createDataFrame([(1, 1, 0.1, "a", "1"), (1, 3, 0.3, "b", "1")], "scenario_id long, frame_index int, ts double, tag_name string, subject_id string")
    got = temporal.sequence(ev, ["a", "b"], seconds=seconds, max_gap_frames=gap).collect()
    assert [(r["first_frame"], r["last_frame"]) for r in got] == ([(1, 3)] if hit else [])


def test_grid_pairs_equal_all_pairs(spark):
    rows = [agent(0, k, (k * 7) % 23, (k * 5) % 11, heading=k * 0.1) for k in range(1, 30)]
    st = states(spark, rows)
    key = lambda df: {(r["ego_id"], r["other_id"]) for r in df.collect()}
    assert key(subjects.near_pairs(st, 4.5)) == key(subjects.agent_pairs(st).filter("distance <= 4.5"))


def test_unordered_ids_compare_as_numbers(spark):
    got = subjects.agent_pairs(states(spark, [agent(0, 9, 0), agent(0, 10, 1)]), directed=False).collect()
    assert [r["subject_id"] for r in got] == ["9:10"]


def test_registry_rejects_twice_and_unknown():
    own = Registry()
    own.register("far", lambda limit: F.col("lon") > limit)
    with pytest.raises(ValueError):
        own.register("far", lambda: F.lit(True))
    with pytest.raises(KeyError):
        own.get("near")
    assert len(BUILTIN.names()) == 25


def test_payload_round_trip(spark, tmp_path):
    from roadsift.sources import sinks

    spark.createDataFrame([(0, '{"a": 1}'), (0, "{broken")], "shard int, document string").transform(lambda d: sinks.write_payloads(d, str(tmp_path / "p")) or d)
    good, bad = sinks.read_payloads(spark, str(tmp_path / "p"), "a int")
    assert [r["a"] for r in good.collect()] == [1]
    assert [r["text"] for r in bad.collect()] == ["{broken"]
