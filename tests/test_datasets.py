import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelane.operators import calibration, contracts, datasets, deltas, labels, metrics, runtime, splits, statistics


def test_frames_round_trip_and_refuse_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(e, i, float(i)) for e in range(5) for i in range(10)], "episode_index long, frame_index long, x double")
    datasets.write_frames(df, str(tmp_path / "d"), buckets=3)
    back = datasets.read_dataset(spark, str(tmp_path / "d"))
    assert {tuple(r)[:3] for r in back.select("episode_index", "frame_index", "x").collect()} == {tuple(r) for r in df.collect()}
    one = datasets.read_episode(spark, str(tmp_path / "d"), 3, 3)
    assert [r.frame_index for r in one.collect()] == list(range(10))
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    with pytest.raises(Exception, match="(?i)exists"):
        datasets.write_frames(df, str(tmp_path / "d"), buckets=3)


def test_merge_and_resume(spark):
    a = spark.createDataFrame([(0, 0, "x"), (1, 1, "y")], "e long, i long, f string")
    b = spark.createDataFrame([(0, 0, "z")], "e long, i long, f string")
    assert {tuple(r) for r in datasets.merge_datasets([a, b.select("f", "i", "e")], episode="e", index="i").collect()} == {(0, 0, "x"), (1, 1, "y"), (2, 2, "z")}
    with pytest.raises(ValueError):
        datasets.merge_datasets([a, b.drop("f")], episode="e", index="i")
    assert datasets.merge_datasets([a, b.withColumn("g", F.lit(1))], episode="e", index="i", drop=["f", "g"]).count() == 3
    assert [r.e for r in datasets.not_yet_written(a, b, "e").collect()] == [1]
    rel = datasets.relative_index(a.unionByName(spark.createDataFrame([(9, 200_000, "q")], "e long, i long, f string")), a.where("i = 1").select("i").unionByName(spark.createDataFrame([(200_000,)], "i long")), "i")
    assert {r.i: r.relative for r in rel.collect()} == {1: 0, 200_000: 1}
    assert datasets.annotate(a, spark.createDataFrame([(1, "new")], "e long, f string"), "e").where("e = 1").first().f == "new"


def test_publish_manifest_and_verify(spark, tmp_path):
    stage = tmp_path / "stage"
    (stage / "meta").mkdir(parents=True)
    datasets.replace_file(str(stage / "a.txt"), b"one")
    datasets.replace_file(str(stage / "meta" / "stats.json"), b"{}")
    before = datasets.manifest(spark, str(stage))
    lines = spark.createDataFrame([(f"{r.digest}  {r.path}",) for r in before.collect()] + [("nonsense",), ("0" * 64 + "  ../up",), ("0" * 64 + "  gone",), ("0" * 64 + "  a.txt",)], "l string")
    found = {(r.path, r.problem) for r in datasets.verify_manifest(lines, "l", before, ["must.txt"]).collect()}
    assert found == {("nonsense", "malformed"), ("../up", "unsafe_path"), ("../up", "missing"), ("gone", "missing"), ("a.txt", "repeated"), ("a.txt", "mismatch"), ("must.txt", "required")}
    kept = spark.createDataFrame(before.collect(), before.schema)
    datasets.replace_file(str(stage / "a.txt"), b"two")
    datasets.replace_file(str(stage / "meta" / "stats.json"), b"[]")
    assert {tuple(r) for r in datasets.manifest_changes(kept, datasets.manifest(spark, str(stage))).collect()} == {("a.txt", "changed")}
    datasets.publish(str(stage), str(tmp_path / "goal"))
    assert (tmp_path / "goal" / datasets.MARKER).exists()
    stage.mkdir()
    with pytest.raises(FileExistsError):
        datasets.publish(str(stage), str(tmp_path / "goal"))
    assert datasets.manifest_digest([("a", "1"), ("b", "2")]) == datasets.manifest_digest([("b", "2"), ("a", "1")])
    assert datasets.provenance(str(tmp_path))["commit"] == ""


def test_dataset_root():
    assert datasets.root_problems({}, set()) == ["error: meta/info.json is missing"]
    info = {"codebase_version": "v1.0", "total_episodes": 0, "features": {"cam": {"dtype": "video"}}}
    assert datasets.root_problems(info, {"data"}) == ["error: unsupported version 'v1.0'", "error: meta is missing", "warning: no episodes", "warning: videos is missing"]
    assert datasets.root_problems({"codebase_version": "v3.0", "total_episodes": 1}, {"data", "meta"}) == []


def test_contracts(spark):
    frames = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 0), ("b", 2)] + [("c", 0), ("c", 0)], "e string, i long")
    assert {r.e: (r.contiguous, r.lost, r.repeated) for r in contracts.index_contract(frames, "e", "i").collect()} == {"a": (True, 0, 0), "b": (False, 1, 0), "c": (False, 0, 1)}
    seg = spark.createDataFrame([("f", 0.0, 1.0), ("f", 1.0, 2.0), ("f", 1.5, 3.0), ("f", 4.0, 5.0), ("g", 0.05, 1.0)], "f string, s double, e double")
    assert {(r.f, r.s, r.fault) for r in contracts.segment_faults(seg, "f", "s", "e", 10.0).collect()} == {("f", 1.5, "overlap"), ("f", 4.0, "gap"), ("g", 0.05, "off_grid")}
    points = spark.createDataFrame([("f", 0.5), ("f", 1.7), ("f", 3.5)], "f string, t double")
    assert {r.t: r.segments for r in contracts.assign_segments(points, seg, "f", "t", "s", "e").collect()} == {0.5: 1, 1.7: 2, 3.5: 0}


def test_statistics_equal_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 256, 999)
    df = spark.createDataFrame([("a", int(v)) for v in x], "g string, v int")
    exact = statistics.feature_stats(df.withColumn("v", F.col("v") / 255.0), ["g"], "v").first()
    summed = statistics.histogram_stats(statistics.histogram(df, ["g"], "v"), ["g"]).first()
    for got in (exact, summed):
        assert got["count"] == 999 and got["mean"] == pytest.approx((x / 255).mean()) and got["std"] == pytest.approx((x / 255).std())
        for name, p in statistics.POINTS.items():
            assert got[name] == pytest.approx(np.quantile(x / 255, p), abs=1e-12)
    assert statistics.histogram_stats(statistics.histogram(df.limit(0), ["g"], "v"), ["g"]).collect() == []
    near = statistics.approximate_stats(df, ["g"], "v").first()
    assert abs(near.q50 - np.quantile(x, 0.5)) <= 2
    assert statistics.round_trip(df.withColumn("v", F.col("v") / 255.0), ["g"], "v").first().changed == 0
    a = spark.createDataFrame([("k", 1.0, 2.0)], "k string, m double, n double")
    b = spark.createDataFrame([("k", 1.0, 2.5), ("z", 0.0, 0.0)], "k string, m double, n double")
    assert {(r.k, r.stat) for r in statistics.stats_differences(a, b, ["k"], ["m", "n"]).collect()} == {("k", "n"), ("z", "m"), ("z", "n")}


def scored(spark, rows):
    df = spark.createDataFrame(rows, "episode_idx long, t long, joint string, predicted double, ground_truth double")
    return metrics.episode_metrics(metrics.paired(df)).first()


def test_metrics_by_hand(spark):
    r = scored(spark, [(1, t, j, t * 0.1 + 0.5, t * 0.1) for t in range(10) for j in "ab"])
    assert (r.mse, r.mae, r.rmse, r.max_abs_error) == pytest.approx((0.25, 0.5, 0.5, 0.5))
    assert r.gt_smoothness_mean == pytest.approx(0.1 * 2**0.5) and r.gt_smoothness_std == pytest.approx(0, abs=1e-9)
    orthogonal = scored(spark, [(1, 0, "a", 1.0, 0.0), (1, 0, "b", 0.0, 1.0)])
    assert (orthogonal.cosine_similarity, orthogonal.gt_smoothness_mean, orthogonal.max_abs_error_joint) == (0, 0, "a")
    assert scored(spark, [(1, 0, "a", 0.0, 0.0), (1, 0, "b", float("nan"), 1.0)]).cosine_similarity == 0
    assert scored(spark, []) is None
    losses = spark.createDataFrame([("v", i, float(i)) for i in range(5)], "s string, i long, x double")
    assert metrics.batch_loss(losses, "s", "i", "x", 2).first().loss == pytest.approx((0.5 + 2.5 + 4) / 3)


def test_delta_statistics(spark):
    rows = [(1, j, t, 0.01 * t, 0.01 * t) for j in "ab" for t in range(50)]
    df = spark.createDataFrame(rows, "e long, j string, t long, a double, s double")
    got = {r.j: r for r in deltas.pooled_delta_stats(df, episode="e", joint="j", t="t", action="a", state="s", steps=3).collect()}
    assert got["a"].mean == pytest.approx(sum([0] * 50 + [0.01] * 49 + [0.02] * 48) / 147) and got["a"]["count"] == 50 and got["a"].n_samples == 147
    one = deltas.pooled_delta_stats(df, episode="e", joint="j", t="t", action="a", state="s", steps=1)
    assert one.first()["std"] == 1e-6
    original = spark.createDataFrame([("a", 9.0), ("b", 8.0)], "j string, mean double")
    assert {r.j: round(r.mean, 6) for r in deltas.with_kept_stats(one, original, "j", ["b"]).collect()} == {"a": 0.0, "b": 8.0}


def test_splits_of_lists():
    split = splits.shuffled_split(list(range(100)), (8, 1, 1), 3)
    assert [len(split[k]) for k in ("train", "val", "test")] == [80, 10, 10]
    assert sorted(sum(split.values(), [])) == list(range(100)) and split == splits.shuffled_split(list(range(100)), (8, 1, 1), 3)
    assert splits.shuffled_split(list(range(10)), (8, 2), 0)["test"] == []
    strata = {i: f"s{i % 6}" for i in range(600)}
    first = splits.stratified_shuffle(strata, (8, 1, 1), 7)
    grown = splits.stratified_shuffle(strata | {1000 + i: "s0" for i in range(50)}, (8, 1, 1), 7)
    assert {len(v) for v in first.values()} == {480, 60}
    assert {e for e in first["val"] if e % 6} == {e for e in grown["val"] if e < 1000 and e % 6}
    assert splits.contiguous_ranges(5, (0.98, 0.01, 0.01)) == {"train": (0, 3), "val": (3, 4), "test": (4, 5)}
    assert {k: len(v) for k, v in splits.replay_split(list(range(3)), 1).items()} == {"val": 1, "test": 1, "train": 1}
    assert splits.shard_plan(10, 4) == [(0, 3), (3, 6), (6, 8), (8, 10)] and splits.shard_plan(2, 5) == [(0, 1), (1, 2)] and splits.shard_plan(0, 3) == [(0, 0)]
    assert splits.resolve_split(file={"val_episodes": [2, 1]}, legacy_range=(0, 1), ratios=None, episodes=[]) == {"train": [], "val": [1, 2], "test": []}
    assert splits.resolve_split(file=None, legacy_range=(0, 2), ratios=None, episodes=[0, 1, 2])["train"] == [2]


def test_stratified_split_of_a_table(spark):
    df = spark.createDataFrame([(i, f"s{i % 3}") for i in range(300)], "e long, s string")
    out = splits.stratified_split(df, episode="e", stratum="s", ratios=(0.8, 0.1, 0.1), seed=1)
    assert {(r.s, r.train, r.val, r.test) for r in splits.strata_summary(out, "s").collect()} == {(f"s{k}", 80, 10, 10) for k in range(3)}
    doc = json.loads(splits.split_document(out, "e").first().document)
    assert sorted(sum(doc.values(), [])) == list(range(300))
    bad = spark.createDataFrame([(1, "train"), (1, "val"), (-1, "test"), (None, "odd")], "e long, split string")
    assert Counter(r.problem for r in splits.split_problems(bad, "e", 5).collect()) == {"several_splits": 1, "out_of_range": 2, "unknown_split": 1}
    assert [r.problem for r in splits.split_problems(bad.limit(0), "e").collect()] == ["empty_train"]
    assert splits.sample_per_split(out, split="split", episode="e", n=4, seed=2).count() == 12


def test_label_layouts(spark):
    grouped = json.dumps({"big": {"upside": [0, 3], "downside": [1]}, "Small": {"face_up": [8]}})
    flat = json.dumps({"10": {"envelope_size": "big", "envelope_facing_side": "upside"}, "11": ["big", "downside"], "12": "small|face_up"})
    docs = spark.createDataFrame([(grouped,), (flat,), ("broken",), (None,)], "d string")
    got = {(r.episode_index, r["size"], r.face) for r in labels.labels_from_text(docs, "d").collect()}
    assert got == {(0, "big", "face_up"), (3, "big", "face_up"), (1, "big", "face_down"), (8, "small", "face_up"), (10, "big", "face_up"), (11, "big", "face_down"), (12, "small", "face_up")}
    table = spark.createDataFrame([(1, "L", "up"), (2, "", "up")], "e long, envelope string, orientation string")
    assert {tuple(r) for r in labels.labels_from_columns(table, "e").collect()} == {(1, "big", "face_up")}
    with pytest.raises(ValueError):
        labels.labels_from_columns(table.select("e"), "e")


def test_label_joins(spark):
    rows, tags = spark.createDataFrame([(1,), (2,)], "e long"), spark.createDataFrame([(1, "big"), (3, "small")], "e long, size string")
    assert {tuple(r) for r in labels.join_labels(rows, tags, "e", ["size"]).collect()} == {(1, "big"), (2, "")}
    assert {tuple(r) for r in labels.alignment_faults(rows, tags, "e").collect()} == {(2, "missing"), (3, "extra")}
    newer = spark.createDataFrame([(1, "small"), (3, "small")], "e long, size string")
    assert [(r.e, r.old, r.new) for r in labels.label_conflicts(tags, newer, "e", ["size"]).collect()] == [(1, "big", "small")]
    assert labels.spread_session_label(rows, tags.limit(1), ["size"]).count() == 2
    with pytest.raises(Exception, match="disagree"):
        labels.spread_session_label(rows, tags, ["size"]).collect()
    stamped = labels.stamp_sidecars(tags, spark.createDataFrame([(1, ""), (9, "med")], "e long, size string"), "e", ["size"])
    assert {tuple(r) for r in stamped.collect()} == {(1, "big"), (3, "small"), (9, "med")}


def test_sidecars_and_entries(spark, tmp_path):
    for name, text in (("a", '{"status": "aborted", "arm": "left"}'), ("b", "broken")):
        (tmp_path / f"{name}.json").write_text(text)
    got = {r.file.rsplit("/", 1)[1]: (r.status, r.fields) for r in labels.read_sidecars(spark, str(tmp_path)).collect()}
    assert got == {"a.json": ("aborted", {"status": "aborted", "arm": "left"}), "b.json": (None, {})}
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "x.json").write_text('{"loop": {"episodes": [{"n": 1}, {"n": 2}]}, "episodes": []}')
    assert labels.episode_entries(spark, str(tmp_path / "s")).count() == 2


def test_runtime_by_hand(spark):
    rows = spark.createDataFrame([("a", i, float(i), x) for i, x in enumerate([None, 1.0, 3.0, 2.0])], "k string, i long, at double, step double")
    out = runtime.rolling_smoothness(rows, by=["k"], order="i", vector_step="step", window=2).orderBy("i").collect()
    assert [r.step_mean for r in out] == [None, None, 2.0, 2.5] and out[3].jerk_max == 2.0
    ok = spark.createDataFrame([("a", i, i * 0.5, v) for i, v in enumerate([True, False, True, True, True, None, True])], "k string, i long, at double, v boolean")
    got = sorted((r.since, r.samples, r.settled) for r in runtime.settled(ok, by=["k"], order="i", at_s="at", valid="v", seconds=1.0, samples=3).collect())
    assert got == [(0.0, 1, False), (1.0, 3, True), (3.0, 1, False)]
    gone = spark.createDataFrame([("a", t) for t in (0.0, 0.5, 3.0)], "k string, t double")
    assert sorted(r.n for r in runtime.silence_sessions(gone, by=["k"], ts_s="t", gap_s=1.0).collect()) == [1, 2]
    still = spark.createDataFrame([("a", 0, [0.0]), ("a", 1, [0.005]), ("a", 2, [1.0]), ("a", 3, [1.0, 2.0])], "k string, i long, v array<double>")
    assert [r.still for r in runtime.still(still, by=["k"], order="i", vector="v", most=0.01).orderBy("i").collect()] == [False, True, False, False]


def test_calibration(spark):
    points = spark.createDataFrame([("c", x, y, 80, 80) for x in (-5.0, 15.0, 79.0, 200.0) for y in (1.0,)], "c string, x double, y double, w int, h int")
    assert calibration.coverage_grid(points, ["c"], "x", "y", "w", "h").first().coverage == 3 / 64
    res = spark.createDataFrame([("c", 0, 3.0, 4.0), ("c", 1, 0.0, 0.0)], "c string, v long, dx double, dy double")
    r = calibration.residual_rms(res, ["c"], "dx", "dy", "v").first()
    assert (r.rms, r.rms_even, r.rms_odd) == pytest.approx((12.5**0.5, 5.0, 0.0))
    views = spark.createDataFrame([("c", i, [float(x)]) for i, x in enumerate([0, 1, 5, 5.5, 9])], "c string, i long, v array<double>")
    assert [x.novel for x in calibration.novel_views(views, "c", "i", "v", 3.0).orderBy("i").collect()] == [True, False, True, False, True]
    report = spark.createDataFrame([("a", 0.5, 0.5, 0.49, 13), ("b", 0.3, 0.1, 0.9, 2)], "camera string, coverage double, rms double, factory_rms double, views long")
    done = [r.asDict() for r in calibration.recommendation(report).collect()]
    assert [d["recommendation"] for d in done] == ["use_new", "keep_factory"] and "| a | 13 | 50% | 0.490 | 0.500 | use_new |" in calibration.report_lines(done)
    assert json.loads(calibration.calibration_document("c", [[1.0]], (640, 480)))["dist_coeffs"] == [0.0] * 5


def test_pose_gate_names_the_first_reason(spark):
    rows = [(1, "a", 0.0, 0.0), (1, "b", 1.0, 0.0), (2, "a", 0.5, 0.0), (2, "b", 1.0, 9.0), (3, "a", 0.0, 9.0), (4, "a", float("nan"), 0.0), (4, "b", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "n long, joint string, position double, velocity double")
    got = {r.n: (r.ok, r.reason, r.joint) for r in runtime.pose_gate(df, [("a", 0.0, 0.1, 1.0), ("b", 1.0, 0.1, 1.0)], by=["n"]).collect()}
    assert got == {1: (True, None, None), 2: (False, "position", "a"), 3: (False, "missing", "b"), 4: (False, "non_finite", "a")}
    with pytest.raises(ValueError):
        runtime.pose_gate(df, [], by=["n"])
