import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelane.operators import batch_checks, coverage
from tidelane.operators.coverage import QualityLimits, coverage_report


def report(spark, streams, **limits):
    """Report by topic from {(topic, role): seconds}."""
    rows = [("e", t, r, int(round(s * 1e9))) for (t, r), stamps in streams.items() for s in stamps]
    out = coverage_report(spark.createDataFrame(rows, "episode string, topic string, role string, ts_ns long"), QualityLimits(**limits))
    return {r.topic: r for r in out.collect()}


STEADY = [i / 30 for i in range(30)]


def test_steady_stream_passes(spark):
    r = report(spark, {("s", "stream"): STEADY})["s"]
    assert (r.severity, r.messages, r.gaps) == ("pass", 30, []) and r.avg_fps == pytest.approx(30) and r.coverage == 1


def test_hole_and_silent_ends_are_critical(spark):
    hole = report(spark, {("s", "stream"): STEADY + [3 + x for x in STEADY]})["s"]
    assert hole.severity == "critical" and [g.kind for g in hole.gaps] == ["dropframe"] and hole.total_gap_s == pytest.approx(3 - 29 / 30)
    both = report(spark, {("a", "stream"): [i / 30 for i in range(300)], ("b", "stream"): [5 + x for x in STEADY]})["b"]
    assert [g.kind for g in both.gaps] == ["leading", "trailing"] and both.severity == "critical"


def test_single_message_and_actions_and_others(spark):
    r = report(spark, {("s", "stream"): STEADY, ("one", "stream"): [0.5], ("act", "action"): [0.0, 0.3, 2.0], ("x", "other"): [0.0, 9.0]})
    assert (r["one"].severity, r["one"].coverage) == ("critical", 0.0)
    assert (r["act"].severity, r["act"].avg_fps, [g.kind for g in r["act"].gaps]) == ("warning", None, ["idle"])
    assert (r["x"].severity, r["x"].coverage, r["x"].gaps) == ("pass", 1.0, [])


def test_empty_and_null_stamps(spark):
    df = spark.createDataFrame([("e", "t", "stream", None), (None, "t", "stream", 5)], "episode string, topic string, role string, ts_ns long")
    assert coverage_report(df).collect() == []


def reports(spark, rows):
    return spark.createDataFrame(rows, "episode string, topic string, label string, role string, avg_fps double, severity string, reason string")


@pytest.mark.parametrize(("rates", "slow"), [([60, 60, 50], {2}), ([60, 60, 60, 48], {3}), ([30], set()), ([30, None, 30], set()), ([10, 100], {0})])
def test_rate_degradation_by_the_others_median(spark, rates, slow):
    df = reports(spark, [(str(i), "t", "l", "stream", None if x is None else float(x), "pass", "") for i, x in enumerate(rates)])
    assert {int(r.episode) for r in batch_checks.rate_degradation(df).where("degraded").collect()} == slow


def test_others_median_equals_numpy(spark):
    rng = random.Random(1)
    rows = [(str(i), rng.choice("ab"), "l", "stream", float(rng.randrange(20, 40)), rng.choice(["pass", "critical"]), "") for i in range(61)]
    got = {(r.topic, r.episode): r.others_median for r in batch_checks.rate_degradation(reports(spark, rows)).collect()}
    for e, t, _, _, _, _, _ in rows:
        assert got[(t, e)] == pytest.approx(np.median([x[4] for x in rows if x[1] == t and x[0] != e]))
    raised = batch_checks.apply_rate_check(reports(spark, rows)).where("severity = 'warning'").collect()
    assert all(r.avg_fps < 0.85 * got[(r.topic, r.episode)] for r in raised)


def test_missing_topics_by_quorum(spark):
    rows = [(e, t, t, "stream", 30.0, "pass", "") for e in "abc" for t in ("x", "y") if (e, t) != ("c", "y")] + [("a", "z", "z", "stream", 1.0, "pass", "")]
    assert {(r.episode, r.topic) for r in batch_checks.missing_topics(reports(spark, rows)).collect()} == {("c", "y")}
    assert batch_checks.missing_topics(reports(spark, rows[:2])).collect() == []
    assert batch_checks.missing_topics(reports(spark, [])).collect() == []


def test_summaries(spark):
    rows = [(f"e{i:02d}", "t", "l", "stream", float(i), "critical" if i < 25 else "pass", f"r{i}") for i in range(30)]
    g = batch_checks.flagged_groups(reports(spark, rows)).first()
    assert (g.episodes, g.first_episode, g.first_reason) == (25, "e00", "r0")
    # Every episode has its row, however many there are.
    assert {(r.episode, r.reason) for r in batch_checks.flagged_episodes(reports(spark, rows)).collect()} == {(f"e{i:02d}", f"r{i}") for i in range(25)}
    h = batch_checks.topic_health(reports(spark, rows)).first()
    assert (h.passes, h.criticals, h.min_fps, h.median_fps, h.max_fps) == (5, 25, 0.0, 14.5, 29.0)
    eps = spark.createDataFrame([("a", "pass"), ("b", None)], "episode string, severity string")
    assert batch_checks.readiness(eps).first().verdict == "not_ready"
    assert [r.episode for r in batch_checks.quality_gate(eps, "warning").collect()] == ["a"]
    assert batch_checks.readiness(eps.limit(0)).first().verdict == "ready"


def test_aborted_episodes_are_critical(spark):
    df = coverage_report(spark.createDataFrame([("e", "t", "stream", i * 10**7) for i in range(9)], "episode string, topic string, role string, ts_ns long"))
    status = spark.createDataFrame([("e", "aborted"), ("f", "aborted"), ("e", "success")], "episode string, status string")
    assert {(r.episode, r.severity, r.passed) for r in coverage.episode_severity(df, status).collect()} == {("e", "critical", False), ("f", "critical", False)}
    assert coverage.episode_severity(df).first().passed


def test_inventory(spark):
    rows = [("e", "a", i * 100_000_000) for i in range(11)] + [("e", "b", 0)]
    got = {r.topic: (r.messages, r.file_rate) for r in coverage.topic_inventory(spark.createDataFrame(rows, "episode string, topic string, ts_ns long")).collect()}
    assert got == {"a": (11, 10.0), "b": (1, None)}
    assert spark.range(1).select(coverage.record_stamp(F.lit(0), F.lit(7))).first()[0] == 7
