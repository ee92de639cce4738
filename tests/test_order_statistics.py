import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelane.operators.medians import grouped_median, grouped_percentiles, ranked_values
from tidelane.operators.splits import shards
from tidelane.plans import places
from tidelane.plans.places import number_bin, with_places

SCHEMA = "k string, v double"


def rows(seed, n=600):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 5), -2.5, 0.0, 7.0, None])) for _ in range(n)]


def test_percentiles_and_medians_equal_numpy(spark, crowded):
    data = rows(1) + [("one", 3.0), ("none", None)]
    df = crowded(spark.createDataFrame(data, SCHEMA))
    quantiles = {r.k: r.percentiles for r in grouped_percentiles(df, ["k"], "v", [0.1, 0.5, 1.0]).collect()}
    medians = {r.k: r.median for r in grouped_median(df, ["k"], "v").collect()}
    assert set(quantiles) == set(medians) == {"a", "b", None, "one"}
    for k in quantiles:
        values = [v for key, v in data if key == k and v is not None]
        assert quantiles[k] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 1.0]))) and medians[k] == pytest.approx(np.median(values))


def test_counted_values_nans_and_missing_ranks(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", float("nan"), 1), ("a", -4.0, 2)], "k string, v double, c long")
    got = {r.rank: r.value for r in ranked_values(df, ["k"], "v", F.array(F.lit(0), F.lit(4), F.lit(5), F.lit(6)), "c").collect()}
    assert got[0] == -4.0 and got[4] == 1.0 and got[5] != got[5] and len(got) == 3
    assert ranked_values(df.limit(0), ["k"], "v", F.array(F.lit(0)), "c").collect() == []


def test_places_equal_a_sort(spark, monkeypatch):
    monkeypatch.setattr(places, "WIDTH", 8)
    data = [(random.Random(i).choice(["x", None]), i) for i in random.Random(5).sample(range(500), 120)]
    out = with_places(spark.createDataFrame(data, "g string, n long"), ["g"], [F.col("n")], number_bin("n")).collect()
    for g in ("x", None):
        expected = sorted(n for key, n in data if key == g)
        assert [r.n for r in sorted((r for r in out if r.g == g), key=lambda r: r._place)] == expected
        assert {r._total for r in out if r.g == g} == {len(expected)}


@pytest.mark.parametrize(("n", "count"), [(10, 4), (2, 5), (7, 7), (0, 3)])
def test_shards_are_even_and_larger_ones_first(spark, n, count):
    out = [r.shard for r in shards(spark.createDataFrame([(i * 3,) for i in range(n)], "e long"), "e", count).orderBy("e").collect()]
    assert out == [i for i in range(count) for _ in range(n // count + (i < n % count))]
