import random

import pytest

from tidelane.operators import shaping
from tidelane.operators.asof import align, asof, fill_counts, fill_kind, merge_arms, pair_vectors

SCHEMA = "ep long, ts long, seq long, value double"


def rows(seed, n, keys=(1, 2, None)):
    rng = random.Random(seed)
    return [(rng.choice(keys), rng.randrange(-200, 200), seed * 1000 + i, float(i)) for i in range(n)]


@pytest.mark.parametrize("bucket", [1, 16, 10**9])
@pytest.mark.parametrize("mode", ["causal", "nearest"])
def test_asof_equals_brute_force(spark, mode, bucket):
    left, right = rows(1, 150), rows(2, 90)
    df = lambda x: spark.createDataFrame(x, SCHEMA).repartition(3)
    got = {r.l.seq: (None if r.r is None else r.r.seq, r.dt) for r in asof(df(left), df(right), by=["ep"], ts="ts", seq="seq", mode=mode, bucket=bucket).collect()}
    for ep, ts, seq, _ in left:
        if mode == "causal":
            best = max(((t, s) for e, t, s, _ in right if e == ep and t <= ts), default=None)
        else:
            best = min(((abs(t - ts), t, s) for e, t, s, _ in right if e == ep), default=None)
            best = best and best[1:]
        assert got[seq] == ((None, None) if best is None else (best[1], best[0] - ts))


def test_asof_tolerance_copies_unusable_and_empty(spark):
    left = spark.createDataFrame([(1, 10, 1, 0.0)] * 2 + [(1, None, 2, 0.0), (1, 50, 3, 0.0)], SCHEMA)
    right = spark.createDataFrame([(1, 8, 9, 1.0), (1, None, 8, 1.0)], SCHEMA)
    got = sorted((r.l.seq, r.r is not None) for r in asof(left, right, by=["ep"], ts="ts", seq="seq", tolerance=5).collect())
    assert got == [(1, True), (1, True), (3, False)]
    empty = spark.createDataFrame([], SCHEMA)
    assert [r.r for r in asof(left, empty, by=["ep"], ts="ts", seq="seq", mode="nearest").collect()] == [None] * 3
    assert asof(empty, right, by=["ep"], ts="ts", seq="seq").collect() == []
    with pytest.raises(ValueError):
        asof(left, right, by=["ep"], ts="ts", seq="seq", mode="soon")


def test_fill_kinds(spark):
    frames = spark.createDataFrame([(1, i * 10, i, 0.0) for i in range(12)], SCHEMA.replace("ep", "episode"))
    commands = spark.createDataFrame([(1, 25, 100, 7.0)], SCHEMA.replace("ep", "episode"))
    observations = spark.createDataFrame([(1, 5, 200, 3.0)], SCHEMA.replace("ep", "episode"))
    got = fill_kind(frames, commands, observations, buffer_frames=2)
    kinds = {r.ts: (r.kind, r.value) for r in got.collect()}
    assert kinds[0] == kinds[20] == ("fallback_to_observation", 3.0)
    assert kinds[30] == kinds[50] == ("exact", 7.0)  # the oldest frame held at 50 is 20
    assert kinds[60] == ("hold_last", 7.0)
    assert tuple(fill_counts(got, ["episode"]).first()) == (1, 3, 6, 3, 0)
    none = fill_kind(frames.limit(1), commands.limit(0), observations.limit(0), buffer_frames=2).first()
    assert none.kind == "dropped"


def test_align_drops_incomplete_frames(spark):
    main = spark.createDataFrame([(1, 10, 1, 0.0), (2, 10, 2, 0.0)], SCHEMA)
    out = align(main, {"j": (spark.createDataFrame([(1, 11, 5, 1.0)], SCHEMA), "nearest"), "c": (spark.createDataFrame([(1, 9, 6, 2.0), (2, 9, 7, 2.0)], SCHEMA), "causal")}, by=["ep"], ts="ts", seq="seq").collect()
    assert [(r.ep, r.j.seq, r.c.seq) for r in out] == [(1, 5, 6)]


def test_arms_and_predictions(spark):
    schema = "ep long, ts long, seq long, values array<double>"
    truth = spark.createDataFrame([(1, i * 33, i, [float(i), 0.0, 9.0]) for i in range(5)], schema)
    late = spark.createDataFrame([(1, i * 33 + 5, i, [float(i), 1.0]) for i in range(5)], schema)
    pairs = sorted((r.ts, r.truth, r.predicted) for r in pair_vectors(truth, late, by=["ep"], ts="ts", seq="seq").collect())
    assert pairs == [(i * 33, [float(i), 0.0], [float(i), 1.0]) for i in range(5)]
    merged = merge_arms({"right": late, "left": truth}, by=["ep"], ts="ts", seq="seq").orderBy("ts").collect()
    assert merged[2]["values"] == [2.0, 0.0, 9.0, 2.0, 1.0]
    alone = merge_arms({"right": late.limit(0), "left": truth}, by=["ep"], ts="ts", seq="seq").collect()
    assert all(len(r["values"]) == 3 for r in alone)


def grid_fold(stamps, rate):
    """The grid as it is walked: a frame is emitted if the next point isn't after it."""
    out, points = [], 0
    for ts in sorted(stamps):
        if (ts - min(stamps)) * rate >= points * 10**9:
            out.append(ts)
            points += 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_grid_subsample_equals_the_fold(spark, seed):
    rng = random.Random(seed)
    data = []
    for ep in range(12):
        t, n = rng.randrange(10**12), rng.randrange(1, 60)
        for i in range(n):
            t += rng.choice([1, 20, 33, 34, 100, 700, 3000]) * 10**6
            data.append((ep, t, i, 0.0))
    got = {}
    for r in shaping.grid_subsample(spark.createDataFrame(data, SCHEMA), by="ep", ts="ts", seq="seq", rate=10).collect():
        got.setdefault(r.ep, []).append(r.ts)
    for ep in range(12):
        assert sorted(got[ep]) == grid_fold([t for e, t, _, _ in data if e == ep], 10)


def test_look_ahead(spark):
    df = spark.createDataFrame([(1, i, i, float(i)) for i in range(6)], SCHEMA)
    out = shaping.look_ahead(df, by=["ep"], order=["ts"], state="value", steps=2).orderBy("ts").collect()
    assert [(r.value, r.action) for r in out] == [(float(i), float(i + 2)) for i in range(4)]
    with pytest.raises(ValueError):
        shaping.look_ahead(df, by=["ep"], order=["ts"], state="value", steps=0)


def test_stride_and_previous_sample(spark):
    fast = spark.createDataFrame([(1, i * 5_000_000, i, float(i)) for i in range(40)] + [(2, i, i, 0.0) for i in range(3)], SCHEMA)
    out = shaping.stride_rate(fast, by="ep", ts="ts", seq="seq", rate=30.0)
    assert sorted(r.seq for r in out.where("ep = 1").collect()) == list(range(0, 40, 7)) and out.where("ep = 2").count() == 3
    assert [r.command for r in shaping.previous_sample(fast.where("ep = 1"), by=["ep"], order=["ts"], value="value").orderBy("ts").limit(3).collect()] == [0.0, 0.0, 1.0]


def test_positions():
    assert shaping.parse_positions("1,3:5, 8", 9) == [0, 2, 3, 7] and shaping.parse_positions("0,2:4", 9, base=0) == [0, 2, 3] and shaping.parse_positions("", 3) == []
    for bad in ("0", "5:3", "1:2:3", "x", "9:12"):
        with pytest.raises(ValueError):
            shaping.parse_positions(bad, 9)


def test_episode_selection(spark):
    paths = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "p string")
    assert [(r.p, r.place) for r in shaping.episode_order(paths, "p").orderBy("place").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    assert {r.p for r in shaping.skip_positions(paths, "p", "2", 3).collect()} == {"a", "c"}
    assert {r.p for r in shaping.first_episodes(paths, "p", 2).collect()} == {"a", "b"}
    frames = spark.createDataFrame([("a", True), ("a", False), ("b", None), ("b", False)], "p string, bad boolean")
    assert {r.p for r in shaping.drop_broken(frames, "p", "bad").collect()} == {"b"}
    sizes = spark.createDataFrame([("w", 2, 640, 480), ("w", 1, 320, 240)], "cam string, n int, width int, height int")
    assert tuple(shaping.first_resolution(sizes, "cam", ["n"]).first()) == ("w", 320, 240)
