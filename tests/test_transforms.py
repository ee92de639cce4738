import json

import pytest

from tidelane.operators import transforms
from tidelane.operators.coverage import coverage_report, episode_severity, markdown_lines, report_documents


def test_choices():
    assert transforms.state_index(["a", "b", "g"], ["g", "a", "b"], ["g"]) == [1, 2, -1]
    with pytest.raises(ValueError):
        transforms.state_index(["x"], ["a"])
    assert transforms.arm_slices(16, 8) == [(0, 8), (8, 16)]
    with pytest.raises(ValueError):
        transforms.arm_slices(9, 8)
    assert transforms.wanted_topics(["/a/image_raw", "/b", "/b"]) == ["/a/image_raw", "/b", "/a/image_raw/compressed"]


def test_pipeline(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "`observation.images.waist` int, `observation.state` double, extra double")
    steps = [transforms.Step("x", transforms.exclude_observations(["images.waist", "state"])), transforms.Step("d", transforms.drop_features(["extra"])), transforms.Step("t", transforms.set_task("go"))]
    assert transforms.pipeline(df, steps).columns == ["observation.state", "task"]
    with pytest.raises(ValueError):
        transforms.pipeline(df, [transforms.Step("d", transforms.drop_features(["none"]))])
    vectors = spark.createDataFrame([([], [1.0]), (None, [])], "velocity array<double>, effort array<double>")
    assert transforms.used_features(vectors, ["velocity", "effort", "other"]) == ["effort"]


def test_topics_and_joints(spark):
    topics = spark.createDataFrame([("/a",), ("/x/commands",)], "topic string")
    transforms.require_any(topics, "topic", ["/a", "/zzz"])
    with pytest.raises(ValueError):
        transforms.require_any(topics, "topic", ["/zzz"])
    rows = spark.createDataFrame([("b", 1, ["follower_r_joint1"]), ("a", 2, ["leader_l_joint2", "leader_l_joint1", "leader_x_joint9", "head"]), ("a", 1, ["head", None])], "file string, n int, names array<string>")
    assert [tuple(r) for r in transforms.first_joints(rows, file="file", order="n", names="names").collect()] == [("action", "left", ["joint1", "joint2"])]
    assert transforms.first_joints(rows.limit(0), file="file", order="n", names="names").collect() == []


def test_report_documents(spark):
    rows = [("e", t, "stream", i * 10**7) for t in ("b", "a") for i in range(50)]
    report = coverage_report(spark.createDataFrame(rows, "episode string, topic string, role string, ts_ns long"))
    severity = episode_severity(report, spark.createDataFrame([("f", "aborted")], "episode string, status string"))
    docs = {r.episode: json.loads(r.document) for r in report_documents(report, severity).collect()}
    assert [t["topic"] for t in docs["e"]["topics"]] == ["a", "b"] and docs["e"]["passed"]
    assert docs["f"] == {"episode": "f", "severity": "critical", "passed": False, "topics": []}
    assert "| f | critical | 0 |" in markdown_lines([r.asDict() for r in severity.collect()])
