import math

import pytest
from pyspark.sql import functions as F

from tidelane.functions import arrays, names, rates
from tidelane.functions.integers import floor_div, seconds_to_ns
from tidelane.operators import deltas, runtime


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_topics(spark):
    rows = [("/joint_states", "ros2msg://sensor_msgs/msg/JointState"), ("/cam_waist/image_raw/compressed", "sensor_msgs/msg/CompressedImage"), ("/usb/front", "sensor_msgs/Image"), ("/follower_l_forward_controller/commands", "std_msgs/Float64MultiArray"), ("/robot/follower_l_x_controller/commands", "std_msgs/Float64MultiArray"), ("/a/b", None)]
    df = "t string, k string"
    assert values(spark, names.topic_role(F.col("k")), rows, df) == ["stream", "stream", "stream", "action", "action", "unclassified"]
    assert values(spark, names.topic_label(F.col("t"), F.col("k")), rows, df) == ["joint_states", "waist", "usb_front", "action[left]", "action[robot_follower_l_x_controller_commands]", "a_b"]
    topics = [("/usb_cam_waist/image_raw/compressed",), ("/camera/image_raw",), ("/wrist_r/image",), ("/image",), ("/x//",)]
    assert values(spark, names.camera_name(F.col("t")), topics, "t string") == ["usb_cam_waist", "camera", "wrist_r", "camera", "x"]
    assert values(spark, names.source_camera_name(F.col("t")), topics[:2], "t string") == ["usb_cam_waist", "camera"]


def test_joint_names(spark):
    rows = [("leader_r_joint1",), ("follower_l_finger_joint1",), ("follower_joint2",), ("follower_x_joint2",), ("head_joint",), ("leader_r",), (None,)]
    parsed = values(spark, names.parse_joint_name(F.col("n")), rows, "n string")
    assert [tuple(p) if p else None for p in parsed] == [("action", "right", "joint1"), ("observation", "left", "finger_joint1"), ("observation", "", "joint2"), None, None, ("action", "right", "r"), None]
    single = values(spark, names.parse_joint_name(F.col("n"), arms={}), [("leader_x_y",)], "n string")
    assert tuple(single[0]) == ("action", "", "x_y")


def test_labels(spark):
    rows = [(" Médio ",), ("LARGE",), ("odd",), (None,)]
    assert values(spark, names.label_alias(F.col("v"), names.SIZE_ALIASES), rows, "v string") == ["medium", "big", None, None]
    with pytest.raises(Exception, match="unrecognised size"):
        values(spark, names.require_alias(F.col("v"), names.SIZE_ALIASES, "size"), rows, "v string")
    assert values(spark, names.action_type(F.col("a"), F.col("b")), [("absolute", True), (None, True), (None, None)], "a string, b boolean") == ["absolute", "delta_obs_t", "absolute"]
    assert values(spark, names.shown_names(F.col("v"), 2), [(["a", "b", "c"],), (["a"],)], "v array<string>") == ["a, b ... and 1 more", "a"]


def test_rates(spark):
    rows = [(29.97,), (27.4,), (100.0,), (2.0,), (72.5,), (67.5,), (27.5,)]
    assert values(spark, rates.snap_rate(F.col("r")), rows, "r double") == [30, 25 if abs(27.4 - 25) < abs(27.4 - 30) else 30, 100, 5, 70, 60, 25]
    assert values(spark, rates.duration_text(F.col("s")), [(5.25,), (245.0,), (3725.0,)], "s double") in (["5.2s", "4m 05s", "1h 02m"], ["5.3s", "4m 05s", "1h 02m"])
    assert values(spark, rates.normalize_timestamp(F.col("t")), [(2e9,), (5.0,)], "t double") == [2.0, 5.0]
    assert values(spark, rates.output_height(F.lit(640), F.lit(480), 322), [(1,)], "x int") == [242]
    assert values(spark, rates.same_aspect(F.lit(640), F.lit(480), F.lit(320), F.col("h")), [(240,), (200,)], "h int") == [True, False]
    assert values(spark, rates.time_drift("a", "b"), [(1.0, 3.5), (None, 2.0), (None, None)], "a double, b double") == [2.5, None, None]
    assert values(spark, rates.refill_delay_steps(F.col("l"), F.lit(30.0), F.lit(4)), [(0.33,), (None,), (0.0,)], "l double") == [10, 4, 4]


def test_readiness_of_a_refill(spark):
    r = rates.refill_readiness(chunk=F.lit(50), delay=F.lit(10), latency=F.lit(0.3), rate=F.lit(30.0), threshold=F.lit(25), age=F.lit(0.4), max_age=F.lit(3.0), horizon=F.lit(35))
    got = spark.range(1).select(r.alias("r")).first().r
    assert (got.q_start, got.wait_steps, got.q_required, got.delay_bound, got.overlap, got.failures, got.sustainable) == (40, 15, 24, 11, 13, [], True)
    bad = spark.range(1).select(rates.refill_readiness(chunk=F.lit(10), delay=F.lit(10), latency=F.lit(0.3), rate=F.lit(30.0), threshold=F.lit(5), age=F.lit(5.0), max_age=F.lit(1.0), horizon=F.lit(35)).alias("r")).first().r
    assert bad.failures == ["empty_queue", "coverage", "source_age", "overlap"]


def test_integers(spark):
    assert values(spark, floor_div(F.col("x"), 4), [(7,), (-1,), (-4,), (None,)], "x long") == [1, -1, -1, None]
    assert values(spark, seconds_to_ns(F.col("s")), [(1.5,), (float("nan"),), (1e30,), (None,)], "s double") == [1_500_000_000, None, None, None]


def test_orders(spark):
    rows = [(["joint10", "finger_joint1", "joint2", None], [1.0, 2.0, 3.0, 4.0]), (["b", "a"], [1.0])]
    assert values(spark, arrays.canonical_order(F.col("n"), F.col("v")), rows, "n array<string>, v array<double>") == [[2.0, 1.0, 3.0], [1.0]]
    v = [([1.0, 2.0, 3.0],), ([1.0],)]
    assert values(spark, arrays.controller_order(F.col("v"), ["a", "b", "c"], ["c", "a", "b"]), v, "v array<double>") == [[3.0, 1.0, 2.0], [1.0]]
    assert values(spark, arrays.controller_order(F.col("v"), ["a", "b", "c"], ["c", "a", "x"]), v[:1], "v array<double>") == [[1.0, 2.0, 3.0]]


def test_limits_and_differences(spark):
    rows, schema = [([1.0, 5.0], [0.0, 5.5]), ([1.0], [0.0, 2.0])], "a array<double>, c array<double>"
    assert values(spark, arrays.limit_step(F.col("a"), F.col("c"), 0.2), rows, schema) == [[0.2, 5.3], [1.0]]
    assert values(spark, arrays.limited_joints(F.col("a"), F.col("c"), 0.6), rows, schema) == [[0], []]
    delta = deltas.delta_to_state(F.col("a"), F.col("c"), [1])
    assert values(spark, delta, rows[:1], schema) == [[1.0, 5.0]]
    assert values(spark, deltas.delta_from_state(delta, F.col("c"), [1]), rows[:1], schema) == [[1.0, 5.0]]
    assert values(spark, arrays.padded_distortion(F.col("a")), [([1.0, 2.0], None)], schema) == [[1.0, 2.0, 0.0, 0.0, 0.0]]
    assert values(spark, arrays.unit_pixels(F.col("a")), [([255.0, 0.0], None)], schema) == [[1.0, 0.0]]
    assert values(spark, arrays.flat_names(F.col("n")), [([["a"], ["b", "c"]],)], "n array<array<string>>") == [["a", "b", "c"]]


def test_poses(spark):
    half = math.sqrt(0.5)
    rows = [([0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0], [3.0, 4.0, 0.0, 0.0, 0.0, half, half])]
    got = values(spark, arrays.pose_delta(F.col("a"), F.col("b")), rows, "a array<double>, b array<double>")[0]
    assert got.metres == 5 and got.degrees == pytest.approx(90)
    m = values(spark, arrays.quaternion_matrix(F.slice("b", 4, 4)), rows, "a array<double>, b array<double>")[0]
    assert m[0] == pytest.approx([0, -1, 0], abs=1e-12) and m[2] == pytest.approx([0, 0, 1])


def test_joint_checks(spark):
    rows = [(["a", "b"], [1.0, 2.0]), (["a", "a"], [1.0, float("nan")]), (["a"], [1.0, 2.0])]
    assert values(spark, runtime.joint_message_faults(F.col("n"), F.col("v"), ["a", "b"]), rows, "n array<string>, v array<double>") == [[], ["repeated", "missing", "non_finite"], ["length", "missing"]]
    maps = [({"left_a": 1.0, "right_a": 2.0},), ({"left_a": float("inf"), "right_a": 2.0},), ({"left_a": 1.0},)]
    assert values(spark, runtime.observation_vector(F.col("m"), ["right", "left"], ["a"]), maps, "m map<string,double>") == [[1.0, 2.0], None, None]
    s = runtime.saturated(F.col("v"), F.lit(0.0), F.lit(1.0), F.col("m"))
    assert values(spark, s, [(1.05, 0.1), (1.5, 0.1), (1.05, None), (0.5, 0.1)], "v double, m double") == [1.0, 1.5, 1.05, 0.5]
    c = runtime.target_check(F.col("v"), F.lit(0.0), F.lit(1.0), F.lit(0.1))
    assert [(x.value, x.error) for x in values(spark, c, [(1.05,), (2.0,), (float("nan"),), (None,)], "v double")] == [(1.0, None), (None, "out_of_limits"), (None, "not_finite"), (None, "not_finite")]


def test_merge_alignment(spark):
    rows = [(True, 20, 15, 3, 8, 1.0, 1.2, True), (True, 20, 20, 3, 3, 1.0, 1.2, False), (True, 20, 15, 3, 7, 1.0, 1.2, True), (True, 20, 5, 0, 15, 1.0, 1.2, True), (False, 1, 1, 0, 0, 1.0, 1.2, True), (True, 20, 19, 0, 1, 1.0, 1.2, False), (True, 1, 0, 0, 1, 1.0, 1.2, True), (True, 1, 1, 0, 0, 2.0, 1.0, True)]
    df = spark.createDataFrame(rows, "q boolean, a long, b long, i long, j long, s double, m double, r boolean")
    c = rates.merge_alignment(same_queue=F.col("q"), queue_before=F.col("a"), queue_at=F.col("b"), index_before=F.col("i"), index_at=F.col("j"), requested_s=F.col("s"), merged_s=F.col("m"), rate=F.lit(30.0), ready=F.col("r"))
    got = [(x.delay_steps, x.error) for x in (r[0] for r in df.select(c).collect())]
    assert got == [(5, None), (6, None), (None, "mismatch"), (None, "consumed_too_much"), (None, "queue_changed"), (None, "consumed_before_ready"), (None, "queue_empty"), (None, "timing")]
