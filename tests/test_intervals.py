import random

import pytest

from tidelane.operators.intervals import merge_intervals

SCHEMA = "entity string, a long, b long"


def brute(rows):
    out = set()
    for key in {r[0] for r in rows}:
        spans = sorted({(a, b) for k, a, b in rows if k == key and a is not None and b is not None and b > a})
        merged = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out |= {(key, "period", a, b) for a, b in merged}
        out |= {(key, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:], strict=False)}
    return out


def run(df, **options):
    return [tuple(r) for r in merge_intervals(df, ["entity"], "a", "b", **options).collect()]


@pytest.mark.parametrize("block", [4, 64, 1 << 16])
def test_random_intervals_equal_brute_force(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice(["x", "y", None]), s := rng.randrange(-300, 300), s + rng.choice([-3, 0, 1, 2, 5, 40, 200])) for _ in range(600)]
    rows += [("x", None, 5), ("x", 5, None), (None, None, None)]
    found = run(spark.createDataFrame(rows, SCHEMA).repartition(5), block=block, fan_in=3)
    assert len(found) == len(set(found))
    assert set(found) == brute(rows)


def test_touching_nested_repeated_and_one_hot_key(spark, crowded):
    rows = [("hot", i * 10, i * 10 + (10 if i % 5 else 4)) for i in range(500)] * 3 + [("n", 0, 100), ("n", 10, 20), ("n", 100, 120), ("m", 7, 7), ("m", 9, 3)]
    found = run(crowded(spark.createDataFrame(rows, SCHEMA)), block=128)
    assert set(found) == brute(rows)
    assert ("n", "period", 0, 120) in found
    assert not [r for r in found if r[0] == "m"]


def test_long_interval_over_many_blocks(spark):
    rows = [("x", 0, 1_000_000), ("x", 500_000, 1_000_001), ("x", 999_999, 1_000_050), ("x", 1_000_060, 1_000_070)]
    assert set(run(spark.createDataFrame(rows, SCHEMA), block=1024)) == brute(rows)


def test_empty(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
