import math
import random

import numpy as np
import pytest

from tidelane.functions.chains import forward_backward
from tidelane.operators import signal_faults
from tidelane.operators.medians import grouped_median
from tidelane.operators.signal_faults import flag_faults

SCHEMA = "ep long, joint string, t long, a double, b double"


def brute(rows, low, high):
    """The stated rule, reading by reading."""
    out = set()
    sources = {}
    for ep, joint, t, a, b in rows:
        for field, v in (("a", a), ("b", b)):
            if v is not None and t is not None:
                sources.setdefault((ep, joint, field), {}).setdefault(t, v)
    for (ep, joint, field), series in sources.items():
        bad = {t for t, v in series.items() if not math.isfinite(v) or v < low or v > high}
        out |= {(ep, joint, t, field) for t in bad}
        t = sorted(set(series) - bad)
        v = [series[x] for x in t]
        steps = [abs(y - x) for x, y in zip(v, v[1:], strict=False) if y != x]
        if steps:
            m = 15 * float(np.median(steps))
            for k in (1, 2, 3):
                for i in range(1, len(v) - k):
                    run, left, right = v[i : i + k], v[i - 1], v[i + k]
                    if min(run) - max(left, right) > m or min(left, right) - max(run) > m:
                        out |= {(ep, joint, x, field) for x in t[i : i + k]}
        runs, i = [], 0
        while i < len(v):
            j = i
            while j + 1 < len(v) and v[j + 1] == v[i]:
                j += 1
            runs.append((i, j - i + 1))
            i = j + 1
        if runs:
            usual = float(np.median([n for _, n in runs]))
            for i, n in runs:
                if n >= 24 and n >= 3 * usual:
                    out |= {(ep, joint, x, field) for x in t[i : i + n]}
    return out


def made(seed, length):
    rng = random.Random(seed)
    rows = []
    for ep in range(3):
        for joint in ("j", None):
            x = 0.0
            for t in range(length):
                x += rng.choice([0, 0.001, -0.002, 0.003])
                a = x
                u = rng.random()
                if u < 0.02:
                    a = rng.choice([float("nan"), float("inf"), 9.0, None, x + 0.2, x - 0.3])
                b = 0.25 if 40 < t < 75 else round(x, 2)
                rows.append((ep, joint, t * 2 + (t > 90), a, b if rng.random() < 0.95 else None))
    return rows


def found(df, limits, spark):
    got = flag_faults(df, ["ep", "joint"], "t", ["a", "b"], limits=limits, limit_key="joint")
    return [(r.ep, r.joint, r.t, r.field) for r in got.collect()]


@pytest.mark.parametrize("block", [16, 4096])
def test_equals_the_rule_whatever_the_blocks(spark, crowded, monkeypatch, block):
    monkeypatch.setattr(signal_faults, "BLOCK", block)
    rows = made(block, 150)
    df = crowded(spark.createDataFrame(rows + rows[:200] + [(1, "j", None, 1.0, 1.0)], SCHEMA)).repartition(5)
    limits = spark.createDataFrame([("j", -5.0, 5.0)], "key string, lower double, upper double")
    got = found(df, limits, spark)
    assert len(got) == len(set(got))
    want = brute([r for r in rows if r[1] == "j"], -5, 5) | brute([r for r in rows if r[1] is None], -1e300, 1e300)
    assert set(got) == want


def test_long_stuck_run_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(signal_faults, "BLOCK", 16)
    rows = [(1, "j", t, 0.5 if 20 <= t < 90 else t * 0.01, None) for t in range(120)]
    got = found(spark.createDataFrame(rows, SCHEMA), None, spark)
    assert set(got) == {(1, "j", t, "a") for t in range(20, 90)}


def test_resting_source_constant_and_empty(spark):
    rest = [(1, "j", t, float(t // 30), None) for t in range(300)] + [(2, "j", t, 1.0, None) for t in range(50)]
    assert found(spark.createDataFrame(rest, SCHEMA), None, spark) == []
    assert found(spark.createDataFrame([], SCHEMA), None, spark) == []
    assert found(spark.createDataFrame([(1, "j", 0, None, None)], SCHEMA), None, spark) == []


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    start, move = np.array([0.6, 0.3, 0.1]), rng.dirichlet(np.ones(3), 3)
    lengths = np.array([4, 1, 0, 5])
    emission = rng.random((10, 3))
    got = forward_backward(emission, lengths, start, move)
    at = 0
    for n in lengths:
        total = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n) if n else []:
            p = start[path[0]] * np.prod([move[a, b] for a, b in zip(path, path[1:], strict=False)]) * np.prod([emission[at + i, s] for i, s in enumerate(path)])
            for i, s in enumerate(path):
                total[i, s] += p
        if n:
            assert np.allclose(got[at : at + n], total / total.sum(1, keepdims=True))
        at += n


def test_grouped_median(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0.0, 1.0, rng.random(), rng.random() * 1e6])) for _ in range(501)] + [("c", None), ("d", 2.0), ("d", 4.0)]
    got = {r.g: r["median"] for r in grouped_median(spark.createDataFrame(rows, "g string, x double"), ["g"], "x").collect()}
    for g in ("a", "b", None, "d"):
        assert got[g] == pytest.approx(np.median([x for k, x in rows if k == g]))
    assert "c" not in got
