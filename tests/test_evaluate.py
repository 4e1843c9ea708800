"""Evaluation of the shipped rules, and of one's own, on small scenarios at 0.1 s steps."""

import pytest
from pyspark.sql import functions as F

from roadsift.operators.predicates import Registry
from roadsift.plans import evaluate as E
from roadsift.plans import pack

STATES = "scenario_id string, step_index int, ts double, track_id string, track_index int, object_type string, x double, y double, vx double, vy double, heading double, valid boolean"
LIGHTS = "scenario_id string, step_index int, light_pos int, lane_id long, state string, stop_x double, stop_y double"
LANES = "scenario_id string, feature_id long, feature_pos int, feature_type string, polyline array<struct<x:double,y:double>>, entry_lanes array<long>, exit_lanes array<long>"


def tables(spark, agents, lights=(), lanes=(), current=None, step_s=0.1):
    """agents: (step, track, x, y, vx, vy, heading[, type])."""
    rows = [("s", a[0], a[0] * step_s, str(a[1]), a[1], a[7] if len(a) > 7 else "vehicle", *map(float, a[2:7]), True) for a in agents]
    now = max(a[0] for a in agents) if current is None else current
    return E.Tables(
        spark.createDataFrame(rows, STATES), spark.createDataFrame([("s", *x) for x in lights], LIGHTS), spark.createDataFrame([("s", i, i, "lane", [tuple(map(float, p)) for p in line], [], []) for i, line in enumerate(lanes)], LANES),
        spark.createDataFrame([("s", "20", now)], "scenario_id string, sdc_track_id string, current_time_index int"),
    )


def tags(rows):
    return {r["tag_name"] for r in rows}


def test_low_ttc_and_cut_in(spark):
    agents = [a for k in range(3) for a in ((k, 20, 0, 0, 10, 0, 0), (k, 21, 10, 0, 5, 0, 0), (k, 22, 5, 2, 8, -1, -0.2), (k, 10, 1, 0, 0.1, 0, 0))]
    run = E.evaluate(tables(spark, agents))
    rows = run.events.collect()
    assert {"low_ttc_pair", "persistent_low_ttc_pair", "cut_in_candidate", "cut_in_developing"} <= tags(rows)
    low = next(r for r in rows if r["tag_name"] == "low_ttc_pair" and r["subject_id"] == "20:21")
    told = {m["name"]: float(m["value"]) for o in low["operators"] if o["operator"] == "low_ttc" for m in o["metrics"]}
    assert told["ttc_s"] == pytest.approx(2.0) and told["closing_speed_mps"] == pytest.approx(5.0)
    held = next(r for r in rows if r["tag_name"] == "persistent_low_ttc_pair")
    assert held["frame_index"] == 2 and sum(o["operator"] == "low_ttc" for o in held["operators"]) == 3
    counts = {r["rule_id"]: r for r in run.counters.collect()}
    assert len(counts) == len(pack.all_rules())
    assert (counts["low_ttc_pair"]["frames_evaluated"], counts["low_ttc_pair"]["subjects"]) == (3, 9)
    assert (counts["red_light_running"]["frames_evaluated"], counts["red_light_running"]["frames_skipped"], counts["red_light_running"]["subjects"]) == (0, 3, 0)
    assert counts["persistent_low_ttc_pair"]["frames_evaluated"] is None
    assert "persistent_low_ttc_pair" in tags(run.reviewed.collect())


def test_stopped_at_red(spark):
    agents = [a for k in range(3) for a in ((k, 20, 1, 0, 0.1, 0, 0), (k, 21, 10, 0, 0, 0, 0))]
    run = E.evaluate(tables(spark, agents, [(k, 0, 7, "stop", 1.0, 0.0) for k in range(3)]))
    rows = run.events.collect()
    assert {"sdc_vehicle_stopped", "sdc_vehicle_stopped_for_3_frames", "sdc_vehicle_stopped_at_red", "sdc_vehicle_still_stopped_at_red"} <= tags(rows)
    assert {r["subject_id"] for r in rows if r["tag_name"].startswith("sdc_vehicle")} == {"20"}
    first = next(r for r in run.reviewed.collect() if r["tag_name"] == "sdc_vehicle_stopped")
    assert (first["frame_index"], first["end_frame"], first["event_count"]) == (0, 2, 3)


@pytest.mark.parametrize(("other", "light", "risk", "subtype"), [((25, 24), None, "high", "sdc_interaction_braking"), ((30, 31), 13.0, "medium", "sdc_traffic_light_braking")])
def test_hard_braking(spark, other, light, risk, subtype):
    agents = [(0, 20, 0, 0, 12, 0, 0), (10, 20, 8, 0, 7, 0, 0), (0, 2, other[0], 0, 5, 0, 0), (10, 2, other[1], 0, 5, 0, 0)]
    lights = [(k, 0, 7, "stop", light, 0.0) for k in (0, 10)] if light else []
    (row,) = E.evaluate(tables(spark, agents, lights), [r for r in pack.all_rules() if r.tag == "sdc_hard_braking"]).reviewed.collect()
    assert (row["subject_id"], row["risk_level"], row["review_subtype"], row["frame_index"]) == ("20:2", risk, subtype, 10)
    told = {m["name"]: m["value"] for o in row["operators"] for m in o["metrics"]}
    assert float(told["speed_drop_mps"]) == 5.0 and (told.get("red_light_lane_id") == "7") == bool(light)


def test_blocked(spark):
    def run(first):
        agents = [a for k in (0, 2, 4, 6, 8, 10) for a in ((k, 20, 0, 0, first if k < 6 else 0.1, 0, 0), (k, 2, 6, 0, 0, 0, 0))]
        return E.evaluate(tables(spark, agents), [r for r in pack.all_rules() if r.tag == "sdc_blocked_unable_to_proceed"]).events.collect()

    (row,) = run(0.3)
    assert (row["frame_index"], row["subject_id"], row["review_subtype"]) == (10, "20:2", "blocked_by_vehicle")
    assert run(0.01) == []


def test_red_light_running_on_a_turned_road(spark):
    """The road, the car and the light turned by a 3-4-5 triangle."""
    turn = lambda x, y: (0.8 * x - 0.6 * y, 0.6 * x + 0.8 * y)
    heading = 0.6435011087932844
    agents = [(k, 20, *turn(-6.0 + 3 * k, 0), *turn(10, 0), heading) for k in range(6)]
    lane = [turn(x, 0) for x in (-20, 0, 20)]
    rules = [r for r in pack.all_rules() if r.tag.startswith("red_light")]
    rows = E.evaluate(tables(spark, agents, [(k, 0, 0, "stop", *turn(0, 0)) for k in range(6)], [lane]), rules).events.collect()
    assert {(r["tag_name"], r["frame_index"]) for r in rows} == {("red_light_stop_line_approach", 0), ("red_light_stop_line_approach", 1), *((f"red_light_{t}", k) for k in (3, 4, 5) for t in ("stop_line_crossed", "running"))}
    bent = [turn(x, y) for x, y in ((-20, 0), (0, 0), (5, 0), (5, 5))]
    rows = E.evaluate(tables(spark, agents, [(k, 0, 0, "stop", *turn(0, 0)) for k in range(6)], [bent]), rules).events.collect()
    assert "red_light_running" not in tags(rows)


def test_modes_and_predicates_of_ones_own(spark):
    registry = Registry()
    registry.register("ahead_by", lambda gap_m: F.col("lon") > gap_m)
    registry.register("slower", lambda: E.P._c("mean_speed") < E.P._c("ego_speed"))
    mean = E.Feature("mean", ("mean_speed",), lambda rows, c, a: rows.select(*E.KEYS, "other_speed").withColumn("mean_speed", F.col("other_speed") * a["weight"]).select(*E.KEYS, "mean_speed"), {"weight": 1.0})
    rules = [pack.Rule("far", "sdc_pair", (("ahead_by", {"gap_m": 3.0}), ("slower", {})), intent="review", current_only=True)]
    data = tables(spark, [a for k in range(4) for a in ((k, 20, k, 0, 10, 0, 0), (k, 5, k + 4, 0, 9, 0, 0), (k, 6, k + 4, 0, 11, 0, 0))], current=1)
    found = lambda mode: sorted((r["frame_index"], r["subject_id"]) for r in E.evaluate(data, rules, mode, registry, needs={"slower": (mean,)}).reviewed.collect())
    assert found("causal_online") == [(1, "20:5")]
    assert found("offline_full_scene") == [(k, "20:5") for k in range(4)]
    with pytest.raises(ValueError, match="no mode"):
        E.evaluate(data, rules, "other", registry)
    with pytest.raises(KeyError):
        E.evaluate(data, [pack.Rule("x", "sdc_pair", (("unknown", {}),))], registry=registry)


def test_scenario_stats_tell_rules_that_looked_and_rules_that_could_not(spark):
    agents = [a for k in range(3) for a in ((k, 20, 0, 0, 10, 0, 0), (k, 21, 10, 0, 5, 0, 0))]
    run = E.evaluate(tables(spark, agents))
    (row,) = E.scenario_stats(run).collect()
    rules = [r for r in pack.all_rules() if r.conditions]
    kept = [r for r in rules if r.requires]  # no lights and no lanes here
    assert (row["rules_evaluated"], row["rules_skipped"]) == (len(rules) - len(kept), len(kept)) and kept
    found = {r["rule_id"]: r for r in row["by_rule"]}
    assert [r["rule_id"] for r in row["by_rule"]] == sorted(found) and found["low_ttc_pair"]["events"] == 3
    assert sum(r["reviewed"] for r in row["by_rule"]) == run.reviewed.count() and sum(r["events"] for r in row["by_rule"]) == run.events.count()


def test_a_run_tells_its_frames_and_red_lanes_once(spark, monkeypatch):
    frames, written, cut, visible = [], [], E.cut, E.visible_frames
    monkeypatch.setattr(E, "cut", lambda df: written.append(df.columns) or cut(df))
    monkeypatch.setattr(E, "visible_frames", lambda *a: frames.append(a) or visible(*a))
    agents = [(k, 20, -6.0 + 3 * k, 0, 10, 0, 0) for k in range(6)]
    run = E.evaluate(tables(spark, agents, [(k, 0, 0, "stop", 0.0, 0.0) for k in range(6)], [[(-20, 0), (0, 0), (20, 0)]]), [r for r in pack.all_rules() if r.tag.startswith("red_light")])
    assert {("red_light_running", k) for k in (3, 4, 5)} <= {(r["tag_name"], r["frame_index"]) for r in run.events.collect()}
    counts = {r["rule_id"]: r for r in run.counters.collect()}
    assert (counts["red_light_running"]["subjects"], counts["red_light_running"]["candidates"], counts["red_light_running"]["frames_evaluated"]) == (6, 6, 6)
    assert len(frames) == 1 and sum("dir_x" in c for c in written) == 1
