"""Relational scenes and maps on small folders written here."""

import json
import math

import pytest
from pyspark.sql import functions as F

from roadsift.sources import relational, relational_maps


def write(folder, **tables):
    for name, rows in tables.items():
        (folder / f"{name}.json").write_text(json.dumps(rows, indent=1))


def turned(a):
    return [math.cos(a / 2), 0.0, 0.0, math.sin(a / 2)]


@pytest.fixture
def folder(tmp_path):
    def note(sample, who, x, **more):
        return {"token": f"{sample}{who}", "sample_token": sample, "instance_token": who, "translation": [x, 2.0, 0.5], "rotation": turned(0.5), "size": [2.0, 4.5, 1.6]} | more

    write(
        tmp_path,
        scene=[{"token": "s", "name": "scene-1", "first_sample_token": "a", "last_sample_token": "c", "log_token": "l"}, {"token": "t", "name": "scene-2", "first_sample_token": "x", "last_sample_token": "", "log_token": "none"}],
        sample=[{"token": "c", "timestamp": 1_000_000, "next": "d"}, {"token": "a", "timestamp": 2_000_000, "next": "b"}, {"token": "b", "timestamp": 2_500_000, "next": "c"}, {"token": "d", "timestamp": 9_000_000, "next": ""}, {"token": "x", "timestamp": 5, "next": ""}],
        sample_annotation=[note("b", "q", 7.0), note("a", "p", 1.0), note("a", "q", 5.0), note("c", "p", 9.0, translation=None), note("b", "p", 2.0)],
        instance=[{"token": "p", "category_token": "k"}, {"token": "q", "category_token": "gone"}],
        category=[{"token": "k", "name": "human.pedestrian.adult"}],
        ego_pose=[{"token": "e", "translation": [100.0, 50.0, 1.0], "rotation": turned(0.25)}, {"token": "f", "translation": [103.0, 50.0, 1.0], "rotation": turned(0.25)}],
        sample_data=[{"token": "1", "sample_token": "a", "ego_pose_token": "f", "calibrated_sensor_token": "cam", "is_key_frame": True}, {"token": "2", "sample_token": "a", "ego_pose_token": "e", "calibrated_sensor_token": "top", "is_key_frame": False}, {"token": "3", "sample_token": "b", "ego_pose_token": "f", "calibrated_sensor_token": "cam", "is_key_frame": True}],
        sensor=[{"token": "m", "channel": "LIDAR_TOP", "modality": "lidar"}, {"token": "n", "channel": "CAM", "modality": "camera"}],
        calibrated_sensor=[{"token": "top", "sensor_token": "m"}, {"token": "cam", "sensor_token": "n"}],
    )
    return tmp_path


def test_a_folder_becomes_agent_states(spark, folder):
    tables = relational.read_scenes(spark, str(folder))
    assert [(r["table_name"], r["problem"]) for r in tables.quarantined.collect()] == [("sample_annotation", "without translation")]
    assert tables["log"].count() == 0
    states, scenarios = relational.normalise(tables)
    told = {r["scenario_id"]: r for r in scenarios.collect()}
    assert (told["s"]["status"], told["s"]["samples"], told["s"]["current_time_index"]) == ("ok", 3, 2)
    assert (told["t"]["status"], told["t"]["samples"]) == ("ended_early", 1)  # an empty last token is never reached
    assert told["s"]["origin_yaw"] == pytest.approx(0.25)
    rows = {(r["step_index"], r["track_id"]): r for r in states.filter("scenario_id = 's'").collect()}
    assert set(rows) == {(0, "ego"), (1, "ego"), (0, "p"), (0, "q"), (1, "p"), (1, "q")}
    assert (rows[0, "ego"]["x"], rows[1, "ego"]["x"], rows[0, "p"]["x"], rows[0, "p"]["y"]) == (0.0, 3.0, -99.0, -48.0)
    assert [rows[0, t]["track_index"] for t in ("ego", "p", "q")] == [0, 1, 2]
    assert [rows[0, t]["object_type"] for t in ("ego", "p", "q")] == ["vehicle", "pedestrian", "other"]
    assert rows[0, "p"]["vx"] == 2.0 and rows[0, "ego"]["vx"] == 6.0 and rows[1, "ego"]["vx"] == 0.0  # no pose after it
    assert rows[1, "p"]["ts"] == 0.5 and rows[1, "p"]["phase"] == "history" and rows[0, "p"]["heading"] == pytest.approx(0.5)
    assert (rows[0, "p"]["length"], rows[0, "p"]["width"]) == (4.5, 2.0)


def test_missing_tables(spark, folder):
    (folder / "category.json").unlink()
    with pytest.raises(FileNotFoundError, match="category"):
        relational.read_scenes(spark, str(folder))


def test_walks(spark):
    links = {"a1": "a2", "a2": "a3", "a3": "", "b1": "b2", "b2": "nowhere", "c1": "c2", "c2": "c3", "c3": "c2", "e1": "a2", **{f"l{i}": f"l{i + 1}" for i in range(40)}, "l40": None}
    samples = spark.createDataFrame(list(links.items()), "token string, next string")
    scenes = spark.createDataFrame([("a", "a1", "a3"), ("b", "b1", "b9"), ("c", "c1", "z"), ("d", "gone", "x"), ("e", "e1", "a2"), ("l", "l0", "l40"), ("m", "l5", "l5")], "token string, first_sample_token string, last_sample_token string")
    rows, told = relational.walk_samples(scenes, samples)
    assert {r["scene"]: (r["samples"], r["status"]) for r in told.collect()} == {"a": (3, "ok"), "b": (2, "broken"), "c": (3, "cycle"), "d": (0, "broken"), "e": (2, "ok"), "l": (41, "ok"), "m": (1, "ok")}
    found = {(r["scene"], r["step_index"]): r["token"] for r in rows.collect()}
    assert [found[s, i] for s, i in (("a", 2), ("b", 1), ("c", 2), ("e", 1), ("l", 40), ("m", 0))] == ["a3", "b2", "c3", "a2", "l40", "l5"] and len(found) == 52


def lane(spark, ring, first, last):
    points = "array<struct<token:string,x:double,y:double>>"
    return relational_maps.centrelines(spark.createDataFrame([(ring, first, last)], f"ring {points}, from_edge {points}, to_edge {points}")).first()


def test_centrelines(spark):
    a, b, c, d, e = ("a", 0.0, 1.0), ("b", 10.0, 1.0), ("c", 20.0, 1.0), ("d", 20.0, -1.0), ("e", 0.0, -1.0)
    r = lane(spark, [a, b, c, d, e, a], [a, e], [c, d])
    assert r["centreline_source"] == "polygon_boundary_midpoint" and len(r["centreline"]) == 8
    assert (r["centreline"][0]["x"], r["centreline"][-1]["x"]) == (0.0, 20.0) and r["centreline"][0]["y"] == 0.0
    assert 0 < max(p["y"] for p in r["centreline"]) < 1  # one side bends out at b
    many = [(f"n{i}", float(i), 1.0) for i in range(50)]
    assert len(lane(spark, [*many, ("z", 49.0, -1.0), e], [many[0], e], [many[-1], ("z", 49.0, -1.0)])["centreline"]) == 32
    for ring, first, last, source in (
        ([a, b, c], [a, e], [c, d], "edge_midpoint_fallback"), ([a, b, c, d, e], [a, ("x", 0.0, -1.0)], [c, d], "edge_midpoint_fallback"), (None, [a, e], [c, d], "edge_midpoint_fallback"),
        ([a, b, c, d, e], [a, ("e", None, None)], [c, d], "unavailable"), ([a, b, c, d, e], [a, e], None, "unavailable"), ([a, b, c, d, e], [a, e], [a, e], "unavailable"), ([a, b, c, d, e], [a], [c, d], "unavailable"),
    ):
        r = lane(spark, ring, first, last)
        assert r["centreline_source"] == source and len(r["centreline"]) == (2 if source[0] == "e" else 0)


def test_map_files(spark, tmp_path):
    nodes = [{"token": t, "x": x, "y": y} for t, x, y in (("a", 0, 1), ("b", 10, 1), ("c", 10, -1), ("d", 0, -1), ("e", 20, 1), ("f", 20, -1))]
    lane = lambda t, p, i, o: {"token": t, "polygon_token": p, "from_edge_line_token": i, "to_edge_line_token": o}
    write(tmp_path, town={"node": nodes, "polygon": [{"token": "p", "exterior_node_tokens": ["a", "b", "c", "d"]}, {"token": "q", "exterior_node_tokens": ["b", "e", "f", "c", "lost"]}, {"token": "thin", "exterior_node_tokens": ["a", "b"]}],
                          "line": [{"token": "i", "node_tokens": ["a", "d"]}, {"token": "m", "node_tokens": ["b", "c"]}, {"token": "o", "node_tokens": ["e", "f"]}],
                          "lane": [lane("one", "p", "i", "m"), lane("two", "q", "m", "o"), lane("none", "thin", "i", "m")], "walkway": [{"token": "w", "polygon_token": "p"}], "lane_divider": [{"token": "v", "line_token": "m"}], "drivable_area": [{"token": "y", "polygon_tokens": ["p", "q"]}]}, empty={})
    rows = relational_maps.map_features(relational_maps.records(relational_maps.read_maps(spark, str(tmp_path)))).orderBy("feature_id").collect()
    assert [(r["location"], r["feature_id"], r["feature_type"], r["token"], r["unresolved"]) for r in rows] == [("town", 1, "lane", "one", 0), ("town", 2, "lane", "two", 1), ("town", 3, "walkway", "w", 0), ("town", 4, "lane_divider", "v", 0), ("town", 5, "drivable_area", "y", 0), ("town", 6, "drivable_area", "y", 1)]
    assert (rows[0]["exit_lanes"], rows[1]["entry_lanes"], rows[0]["entry_lanes"], rows[2]["exit_lanes"]) == ([2], [1], [], None)
    assert rows[1]["properties"]["centreline_source"] == "polygon_boundary_midpoint"
    scenes = spark.createDataFrame([("s", "town", 10.0, 0.0)], "scenario_id string, location string, origin_x double, origin_y double")
    moved = relational_maps.in_scenes(spark.createDataFrame(rows, relational_maps.map_features(relational_maps.records(relational_maps.read_maps(spark, str(tmp_path)))).schema), scenes).filter("feature_id = 2").first()
    assert (moved["polyline"][0]["x"], moved["feature_pos"]) == (0.0, 1)


def test_ends_turn_with_the_lane(spark):
    rows = spark.createDataFrame([(1, [(0.0, 0.0), (0.0, 0.0), (0.0, 5.0), (-5.0, 5.0)]), (2, [(1.0, 1.0)])], "feature_id long, polyline array<struct<x:double,y:double>>").withColumn("location", F.lit("t"))
    told = {r["feature_id"]: r for r in relational_maps.lane_ends(rows).collect()}
    assert told[1]["start"]["heading"] == pytest.approx(math.pi / 2) and abs(told[1]["end"]["heading"]) == pytest.approx(math.pi)
    assert told[2]["start"]["heading"] is None and told[2]["end"]["heading"] is None


def test_described_scenes_without_samples_logs_or_maps(spark):
    from roadsift.sources import scenes

    table = spark.createDataFrame([("a", "first", "l"), ("b", "second", "gone"), ("c", "third", None)], "scene string, name string, log string")
    logs = spark.createDataFrame([("l", "town")], "log string, location string")
    ordered = spark.createDataFrame([("a", 0, 0.0, 3.0, 4.0, 0.5), ("a", 1, 0.5, 5.0, 4.0, 0.6), ("b", 0, 0.0, 1.0, 1.0, 0.0)], "scene string, step_index int, ts double, x double, y double, heading double")
    features = spark.createDataFrame([("a", "lane", [(0.0, 0.0)], [2]), ("a", "lane", [], None), ("a", "crosswalk", None, None)], "scenario_id string, feature_type string, polyline array<struct<x:double,y:double>>, exit_lanes array<int>")
    a, b, c = scenes.described_scenes(table, logs, ordered, features).orderBy("scene").collect()
    assert (a["location"], a["samples"], a["hz"], tuple(a["origin"]), a["features"], a["lanes"], a["centrelines"], a["links"]) == ("town", 2, 2.0, (3.0, 4.0, 0.5), 3, 2, 1, 1)
    assert set(a["skipped"]) == {"traffic_lights", "lane_geometry"} and "1 of 2 lanes have a centreline." in a["notes"]
    assert (b["location"], b["samples"], b["hz"], b["lanes"], set(b["skipped"]), len(b["notes"])) == (None, 1, None, 0, {"traffic_lights"}, 2)
    assert (c["samples"], c["origin"], len(c["notes"])) == (0, None, 1)
    assert not scenes.described_scenes(table, logs, ordered, features, {}).filter("scene = 'b'").first()["skipped"]


def test_profile_of_scenarios_that_lack_parts(spark):
    from roadsift.operators import review

    states = spark.createDataFrame([("s", 0, 0.0, "1", "vehicle", True), ("s", 1, 0.1, "1", "vehicle", False), ("s", 0, 0.0, "2", None, True)], "scenario_id string, step_index int, ts double, track_id string, object_type string, valid boolean")
    features = spark.createDataFrame([("s", "lane"), ("s", "lane"), ("s", "stop_sign")], "scenario_id string, feature_type string")
    lights = spark.createDataFrame([("s", 0, "go"), ("s", 1, "stop"), ("s", 1, None)], "scenario_id string, step_index int, state string")
    scenarios = spark.createDataFrame([("s", "1", 1), ("none", None, 0)], "scenario_id string, sdc_track_id string, current_time_index int")
    none, s = review.scenario_profile(states, features, lights, scenarios).orderBy("scenario_id").collect()
    assert (s["steps"], s["tracks"], s["valid_states"]) == (2, 2, 2) and s["tracks_by_type"] == {"vehicle": 1, "unknown": 1}
    assert s["features_by_type"] == {"lane": 2, "stop_sign": 1} and s["lights_now"] == {"stop": 1, "unknown": 1}
    assert (none["steps"], none["first_ts"], none["tracks_by_type"], none["features_by_type"], none["lights_now"]) == (0, None, {}, {}, {})
