import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelane.llm import related_splits
from tidelane.llm.related_splits import assign_splits, broken_components, components, record_components


def union_find(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    groups = {}
    for x in root:
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def grouped(rows, key, value):
    groups = {}
    for r in rows:
        groups.setdefault(r[key], set()).add(r[value])
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("small", [0, 500_000])
def test_components_equal_union_find(spark, monkeypatch, small):
    monkeypatch.setattr(related_splits, "SMALL_GRAPH", small)
    rng = random.Random(5)
    links = [(f"n{rng.randrange(150)}", f"n{rng.randrange(150)}") for _ in range(110)]
    links += [(f"path{i}", f"path{i + 1}") for i in range(40)] + [("hub", f"leaf{i}") for i in range(200)] + [("leaf7", "path20")]
    df = spark.createDataFrame(links * 2 + [("solo", "solo"), (None, "n1"), ("n1", None)], "a string, b string")
    got = components(df).collect()
    assert len(got) == len({r.node for r in got})
    assert grouped(got, "component", "node") == {g for g in union_find([x for x in links if x[0] != x[1]])}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []
    assert components(spark.createDataFrame([("x", "x")], "a string, b string")).collect() == []


def test_records_share_keys_through_others(spark, crowded):
    rows = [(1, "A", None), (2, "a ", "r1"), (3, None, "r1"), (4, "", None), (5, None, None), (None, "A", "r1"), (1, "A", None)]
    df = crowded(spark.createDataFrame(rows, "rec long, ses string, src string"))
    out = record_components(df, "rec", [F.nullif(F.upper(F.trim("ses")), F.lit("")), F.col("src")]).collect()
    assert grouped(out, "component", "record") == {frozenset("123"), frozenset("4"), frozenset("5")}


def test_splits_keep_components_whole_and_near_the_shares(spark):
    sizes = [1] * 300 + [7] * 20 + [60]
    rows = [(f"{c}-{i}", f"c{c}") for c, n in enumerate(sizes) for i in range(n)]
    out = assign_splits(spark.createDataFrame(rows, "record string, component string"), {"train": 0.8, "val": 0.1, "test": 0.1}).collect()
    assert len(out) == len(rows)
    assert all(len(s) == 1 for s in ({r.split for r in out if r.component == c} for c in {r.component for r in out}))
    assert {r.component for r in out} == {min(f"{c}-{i}" for i in range(n)) for c, n in enumerate(sizes)}
    share = Counter(r.split for r in out)
    assert abs(share["train"] / len(rows) - 0.8) < 0.13 and share["val"] and share["test"]
    assert assign_splits(spark.createDataFrame([], "record string, component string"), {"train": 1}).collect() == []
    with pytest.raises(ValueError):
        assign_splits(spark.createDataFrame(rows, "record string, component string"), {})


def test_size_of_the_graph_changes_nothing(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, f"s{rng.randrange(260)}", f"r{rng.randrange(260)}" if rng.random() < 0.5 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "rec long, ses string, src string")
    results = []
    for small in (0, 500_000):
        monkeypatch.setattr(related_splits, "SMALL_GRAPH", small)
        members = record_components(df, "rec", [F.col("ses"), F.col("src")])
        results.append(({tuple(r) for r in members.collect()}, {tuple(r) for r in assign_splits(members, {"train": 0.8, "val": 0.1, "test": 0.1}).collect()}))
    assert results[0] == results[1] and len(results[0][1]) == 400


def test_broken_components(spark):
    members = spark.createDataFrame([("1", "c"), ("2", "c"), ("3", "d")], "record string, component string")
    labels = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test"), (9, "train"), (9, "val"), (None, "val"), (3, None)], "record long, split string")
    assert {r.record for r in broken_components(members, labels).collect()} == {"1", "2", "9"}
