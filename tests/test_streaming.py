import json
import random

import pytest
from pyspark.sql import functions as F

from tidelane.operators.deadband import deadband
from tidelane.streaming.folds import Fold, WatchLimits, align_fold, complete_fold, deadband_fold, fold_batch, fold_stream, triple_fold, watchdog_fold
from tidelane.streaming.windows import interval_rates, log_csv, silence_sessions


def streamed(spark, tmp_path, df, order, fold, by, pieces=3):
    """The fold over the rows as a stream of files, in order."""
    rows = df.orderBy(*order).collect()
    folder = tmp_path / "in"
    size = -(-len(rows) // pieces)
    for i in range(pieces):
        spark.createDataFrame(rows[i * size : (i + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    name = f"out{random.randrange(10**9)}"
    query = fold_stream(stream, by, order, fold).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert query.awaitTermination(240)
    return {tuple(r) for r in spark.table(name).collect()}


def test_deadband_in_a_stream_equals_batch_and_by_hand(spark, tmp_path):
    values = [0.0, 0.01, 0.03, None, 0.02, 0.05, 0.051, 0.2]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)] + [("b", 0, 1.0)], "k string, t long, v double")
    fold = deadband_fold("v", "t", 0.03)
    batch = {tuple(r) for r in fold_batch(df, ["k"], ["t"], fold).collect()}
    # Pending after t=1 is 0.01; at 2 it reaches 0.03; then -0.01, 0.02, 0.021, 0.17.
    assert {(k, t, round(p, 6)) for k, t, p in batch} == {("a", 0, 0.0), ("a", 2, 0.03), ("a", 7, 0.2), ("b", 0, 1.0)}
    assert streamed(spark, tmp_path, df, ["t"], fold, ["k"]) == batch
    full = deadband(df, by=["k"], order="t", value="v", threshold=0.03).collect()
    assert {(r.k, r.t, r.published) for r in full if r.fresh} == batch and len(full) == 9


def aligned_rows(seed):
    rng = random.Random(seed)
    rows, seq = [], 0
    for key in ("p", "q"):
        at = sorted(rng.sample(range(1000), 150))
        for ts in at:
            seq += 1
            stream = rng.choice(["main", "near", "near", "cause"])
            rows.append((key, ts, seq, stream, float(seq)))
        seq += 1
        rows.append((key, 2000, seq, "end", None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_alignment_in_a_stream_equals_batch_and_brute_force(spark, tmp_path, seed):
    rows = aligned_rows(seed)
    df = spark.createDataFrame(rows, "k string, ts long, seq long, stream string, value double")
    fold = align_fold({"near": "nearest", "cause": "causal"}, 1500)
    want = set()
    for key, ts, seq, stream, _ in rows:
        if stream == "main":
            near = [(abs(t - ts), t, s) for k, t, s, n, _ in rows if k == key and n == "near"]
            cause = [(t, s) for k, t, s, n, _ in rows if k == key and n == "cause" and t <= ts]
            if near and cause:
                want.add((key, ts, seq, json.dumps({"cause": max(cause)[1], "near": min(near)[2]})))
    assert {tuple(r) for r in fold_batch(df, ["k"], ["ts", "seq"], fold).collect()} == want
    assert streamed(spark, tmp_path, df, ["ts", "seq"], fold, ["k"]) == want


def run(fold, rows):
    state, out = json.loads(json.dumps(fold.start)), []
    for row in rows:
        state, emitted = fold.step(state, row)
        state = json.loads(json.dumps(state))
        out += emitted
    return out


def test_short_buffer_keeps_what_a_frame_needs():
    rows = [{"ts": t, "seq": t, "stream": s, "value": 0.0} for t, s in [(0, "c"), (1, "c"), (5, "main"), (6, "c"), (7, "main"), (20, "main"), (40, "c")]] + [{"ts": 41, "seq": 0, "stream": "end", "value": None}]
    got = {(r["ts"], json.loads(r["matched"])["c"]) for r in run(align_fold({"c": "causal"}, 3), rows)}
    assert got == {(5, 1), (7, 6), (20, 6)}


def test_complete_observations_need_every_stream_to_advance():
    fold = complete_fold("s", "n", "at", ["a", "b"])
    rows = [{"s": s, "n": n, "at": float(i)} for i, (s, n) in enumerate([("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 2), ("a", 2), ("x", 9), ("a", 3), ("a", None)])]
    assert [(r["at"], json.loads(r["sequences"])) for r in run(fold, rows)] == [(2.0, {"a": 2, "b": 1}), (7.0, {"a": 3, "b": 2})]


def test_triple_is_logged_once_per_pair():
    rows = [{"kind": k, "v": v, "at": float(i)} for i, (k, v) in enumerate([("tick", None), ("obs", 1.0), ("raw", 2.0), ("tick", None), ("cmd", 3.0), ("tick", None), ("tick", None), ("raw", 4.0), ("cmd", 5.0), ("tick", None)])]
    assert run(triple_fold("kind", "v", "at"), rows) == [{"at": 5.0, "obs": 1.0, "raw": 2.0, "cmd": 3.0}, {"at": 9.0, "obs": 1.0, "raw": 4.0, "cmd": 5.0}]


def test_watchdog_latches_and_rearms_only_after_new_samples():
    fold = watchdog_fold(WatchLimits({"a": 1.0, "b": 1.0}, skew_s=5.0, grace_s=0.5))
    reading = lambda at, s, n: {"at": at, "stream": s, "sequence": n, "seen": at, "command": None}
    ask = lambda at, c: {"at": at, "stream": None, "sequence": None, "seen": None, "command": c}
    rows = [ask(0.0, "check"), reading(0.1, "a", 1), reading(0.1, "b", 1), ask(0.2, "check"), ask(2.0, "check"), ask(2.1, "rearm"), reading(2.2, "a", 2), ask(2.3, "rearm"), reading(2.3, "b", 2), ask(2.4, "rearm"), ask(2.5, "check")]
    assert [(r["state"], r["epoch"]) for r in run(fold, rows)] == [("starting", 0), ("armed", 0), ("latched", 1), ("latched", 1), ("latched", 1), ("armed", 2), ("armed", 2)]
    late = [ask(0.0, "check"), ask(0.6, "check")]
    assert [r["state"] for r in run(fold, late)] == ["starting", "latched"]


def test_windows_of_a_stream_and_csv_log(spark, tmp_path):
    rows = [("a", f"2026-01-01 00:00:{s:02d}") for s in (0, 1, 2, 20, 21)] + [("a", "2026-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "k string, at string").select("k", F.col("at").cast("timestamp").alias("at"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    batch = silence_sessions(df, ["k"], "at", "5 seconds", "1 second")
    assert sorted(r.n for r in batch.collect()) == [1, 2, 3]
    q = silence_sessions(stream(), ["k"], "at", "5 seconds", "1 second").writeStream.format("memory").queryName("sessions").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert sorted(r.n for r in spark.table("sessions").collect()) == [2, 3]  # the last is still open
    assert sum(r.n for r in interval_rates(df, ["k"], "at", "10 seconds", "1 second").collect()) == 6
    assert log_csv(stream(), str(tmp_path / "csv"), str(tmp_path / "c2")).awaitTermination(120)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 6


def test_fold_of_nothing(spark):
    fold = Fold({}, lambda s, r: (s, []), "x long")
    assert fold_batch(spark.createDataFrame([], "k string, t long"), ["k"], ["t"], fold).collect() == []
