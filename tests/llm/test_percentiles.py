import math
import random

import numpy as np
import pytest

from tidelane.llm.percentiles import error_bound, merge, percentiles, percentiles_from, summarise

SCHEMA = "d string, ep long, v double"
POINTS = {"q01": 0.01, "q50": 0.5, "q90": 0.9}


def run(df, **options):
    out = percentiles(df, [["d"], ["d", "ep"]], "v", POINTS, **options)
    return {(r.level, r.d, r.ep, r.stat): (r.n, r.result) for r in out.collect()}


def test_equals_numpy(spark, crowded):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e6), 0.0, -0.0, 0.25, None, float("nan")])) for _ in range(3000)]
    got = run(crowded(spark.createDataFrame(rows, SCHEMA)).repartition(7))
    clean = [(d, e, v) for d, e, v in rows if v is not None and v == v]
    for d in ("a", "b", None):
        for e in ("all", 1, 2, None):
            values = [v for k, x, v in clean if k == d and (e == "all" or x == e)]
            for stat, p in POINTS.items():
                n, result = got[(0, d, None, stat)] if e == "all" else got[(1, d, e, stat)]
                assert n == len(values)
                assert result == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300)


def test_bounded_error_with_fewer_digits(spark):
    rows = [("a", 1, random.Random(i).random() + 0.1) for i in range(999)]
    got = run(spark.createDataFrame(rows, SCHEMA), digits=2)
    for stat, p in POINTS.items():
        exact = np.quantile([v for _, _, v in rows], p)
        assert abs(got[(0, "a", None, stat)][1] - exact) <= error_bound(2) * exact
    assert error_bound(4) == 0 and error_bound(1) > error_bound(2) > error_bound(3)


@pytest.mark.parametrize("digits", [1, 2, 3, 4])
def test_merged_summaries_give_percentiles_within_the_bound(spark, crowded, digits):
    rng = random.Random(4)
    rows = [(rng.choice(["a", None]), i % 7, rng.choice([rng.gauss(0, 3), rng.lognormvariate(0, 4), -0.5, 0.25, None, float("nan")])) for i in range(2000)]
    df = crowded(spark.createDataFrame(rows, SCHEMA))
    files = [summarise(df.where(f"ep = {i}"), ["d"], "v", digits=digits) for i in range(7)]
    whole = files[0]
    for other in files[1:]:
        whole = whole.unionByName(other)
    whole = merge(whole, ["d"])
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in summarise(df, ["d"], "v", digits=digits).collect()}
    for r in percentiles_from(whole, ["d"], POINTS, digits=digits).collect():
        values = sorted(v for d, _, v in rows if d == r.d and v is not None and v == v)
        place = (len(values) - 1) * POINTS[r.stat]
        largest = max(abs(values[int(place)]), abs(values[math.ceil(place)]))
        exact = np.quantile(values, POINTS[r.stat])
        slack = 1e-12 * largest
        assert r.n == len(values) and abs(r.result - exact) <= error_bound(digits) * largest + slack
        assert r.low - slack <= exact <= r.high + slack
    assert percentiles_from(whole.where("n < 0"), ["d"], POINTS, digits=digits).collect() == []


def test_ties_single_values_and_empty(spark):
    got = run(spark.createDataFrame([("a", 1, 0.5)] * 9 + [("b", 1, 3.0), ("c", 1, None)], SCHEMA))
    assert got[(0, "a", None, "q90")] == (9, 0.5) and got[(1, "b", 1, "q01")] == (1, 3.0)
    assert not [k for k in got if k[1] == "c"]
    assert run(spark.createDataFrame([], SCHEMA)) == {}
    with pytest.raises(ValueError):
        percentiles(spark.createDataFrame([], SCHEMA), [["ep"], ["d"]], "v", POINTS)
