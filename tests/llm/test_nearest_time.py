import random

import pytest

from tidelane.llm.nearest_time import nearest_in_time, unmatched

LEFT, RIGHT = "ep long, fid long, stamp long", "ep long, rid long, stamp long"


def run(left, right, tolerance):
    out = nearest_in_time(left, right, left_entity="ep", left_id="fid", left_stamp="stamp", right_entity="ep", right_id="rid", right_stamp="stamp", tolerance=tolerance)
    return [(r.entity, r.left_id, r.right_id) for r in out.collect()]


def brute(left, right, tolerance):
    out = set()
    for e, f, s in left:
        near = [(abs(t - s), t, r) for k, r, t in right if e is not None and k == e and None not in (s, t) and abs(t - s) <= tolerance]
        if near:
            out.add((e, f, min(near)[2]))
    return out


@pytest.mark.parametrize("tolerance", [0, 1, 7, 50])
def test_random_stamps_equal_brute_force(spark, crowded, tolerance):
    rng = random.Random(tolerance)
    left = [(rng.choice([1, 2, None]), i, rng.choice([None, rng.randrange(-400, 400)])) for i in range(400)]
    right = [(rng.choice([1, 2, None]), i, rng.choice([None, rng.randrange(-400, 400)])) for i in range(250)]
    got = run(crowded(spark.createDataFrame(left + left[:50], LEFT)), crowded(spark.createDataFrame(right + right[:50], RIGHT)), tolerance)
    assert len(got) == len(set(got))
    assert set(got) == brute(left, right, tolerance)


def test_ties_and_shared_stamps(spark):
    left = [(1, 1, 10), (1, 2, 10), (1, 3, 17)]
    right = [(1, 7, 8), (1, 5, 8), (1, 4, 12), (1, 9, 20)]
    assert set(run(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), 5)) == {(1, 1, 5), (1, 2, 5), (1, 3, 9)}


def test_hot_entity_and_stamp(spark):
    left = [(1, i, 1_000_000_000_000) for i in range(2000)] + [(1, 5000 + i, i * 1000) for i in range(1000)]
    right = [(1, i, i * 1000 + 3) for i in range(1000)] + [(1, 9999, 1_000_000_000_001)]
    got = set(run(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), 10))
    assert got == {(1, i, 9999) for i in range(2000)} | {(1, 5000 + i, i) for i in range(1000)}


def test_empty_sides_and_extreme_stamps(spark):
    none_l, none_r = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    one_l, one_r = spark.createDataFrame([(1, 1, 5), (1, 2, 2**62), (1, 3, -(2**62))], LEFT), spark.createDataFrame([(1, 1, 5), (1, 2, 2**62)], RIGHT)
    assert run(none_l, one_r, 5) == run(one_l, none_r, 5) == run(none_l, none_r, 5) == []
    assert run(one_l, one_r, 5) == [(1, 1, 1)]
    with pytest.raises(ValueError):
        run(one_l, one_r, -1)


def test_unmatched(spark):
    left = spark.createDataFrame([(1, 1, 5), (1, 2, 99)], LEFT)
    pairs = nearest_in_time(left, spark.createDataFrame([(1, 1, 5)], RIGHT), left_entity="ep", left_id="fid", left_stamp="stamp", right_entity="ep", right_id="rid", right_stamp="stamp", tolerance=3)
    assert [r.fid for r in unmatched(left, pairs, "fid").collect()] == [2]
