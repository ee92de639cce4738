"""Queries over all joints of all arms, on small tables made by hand."""

import pytest

from tidelane import catalog

JOINTS = ["finger_joint1", "joint1", "joint2"]
SCHEMA = "episode_idx long, t long, joint string, predicted double, ground_truth double, raw_output double"


def number(t, arm, place):
    return t + place / 8 + (0.5 if arm == "right" else 0.0)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Episode 0 has both arms, episode 1 only the right one; one row is there twice."""
    arms = {0: ("left", "right"), 1: ("right",)}
    rows = [(e, t, f"{arm}_{j}", number(t, arm, i), number(t, arm, i), -number(t, arm, i)) for e in arms for arm in arms[e] for t in range(4) for i, j in enumerate(JOINTS)]
    path = tmp_path_factory.mktemp("vectors")
    spark.createDataFrame(rows + rows[:1], SCHEMA).write.parquet(f"{path}/predictions.parquet")
    return str(path)


def query(spark, folder, name):
    return catalog.registered()[name][0](spark, folder)


def test_pairs_of_whole_vectors_of_every_arm(spark, folder):
    got = {(r.episode, r.arm, r.ts, r.dt): (r.truth, r.predicted) for r in query(spark, folder, "pred_gt_align").collect()}
    vector = lambda arm, t: [number(t, arm, i) for i in range(3)]
    expected = {(e, arm, t * 33 + 4 * (arm == "right"), 5): (vector(arm, t), [-x for x in vector(arm, t)]) for e, arm in ((0, "left"), (0, "right"), (1, "right")) for t in range(4)}
    assert got == expected


def test_arms_on_the_clock_of_the_first_that_an_episode_has(spark, folder):
    got = {(r.episode, r.ts): r["values"] for r in query(spark, folder, "arm_merge").collect()}
    vector = lambda arm, t: [number(t, arm, i) for i in range(3)]
    # The right arm's samples come 4 ms late, so the nearest to frame t is its own.
    assert got == {**{(0, t * 33): vector("left", t) + vector("right", t) for t in range(4)}, **{(1, t * 33 + 4): vector("right", t) for t in range(4)}}


def test_smoothness_of_the_step_of_all_joints(spark, tmp_path):
    moved = {0: (0.0, 0.0), 1: (0.0, 0.0), 2: (3.0, 4.0), 3: (3.0, 4.0)}
    rows = [(0, t, f"right_{j}", x, 0.0, 0.0) for t, at in moved.items() for j, x in zip(("finger_joint1", "joint2"), at, strict=True)]
    spark.createDataFrame(rows + rows[:1], SCHEMA).write.parquet(f"{tmp_path}/predictions.parquet")
    out = query(spark, str(tmp_path), "smoothness_rolling").orderBy("t").collect()
    assert [(r.step_max, r.jerk_max, r.clamped_pct) for r in out] == [(None, None, None), (None, None, None), (5.0, 5.0, round(100 / 3, 9)), (5.0, 5.0, 25.0)]
