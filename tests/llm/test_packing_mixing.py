import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelane.llm import packing
from tidelane.llm.mixing import mix, plan_source, subset_sum
from tidelane.llm.packing import Container, best_fit, fill_report, pack
from tidelane.llm.tokens import LONG as LONG_TEXT
from tidelane.llm.tokens import count_tokens, token_count

BOX = Container(tokens=100, documents=12, attention=100.0**2)


def packed(df, box=BOX):
    return pack(df, item="doc", tokens="size", box=box).collect()


@pytest.mark.parametrize("items", [20_000, 37])
def test_every_token_in_one_container_within_all_capacities(spark, crowded, monkeypatch, items):
    monkeypatch.setattr(packing, "ITEMS", items)
    rng = random.Random(1)
    rows = [(i, rng.choice([1, 3, 10, 40, 60, 99, 100, 101, 250, 300, 0])) for i in range(600)] + [(7000, None), (7001, -5), (None, 8)]
    out = packed(crowded(spark.createDataFrame(rows + rows[:40], "doc long, size long")))
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc].append(r)
        by_bin[r.bin].append(r.tokens)
    want = {None if d is None else str(d): max(0, s or 0) for d, s in rows}
    assert set(by_doc) == set(want)
    for doc, parts in by_doc.items():
        assert sum(p.tokens for p in parts) == want[doc]
        assert sorted(p.part for p in parts) == list(range(len(parts)))
        assert len(parts) == max(1, -(-want[doc] // 100))
        assert all(p.first_token == 100 * p.part for p in parts)
    assert all(sum(t) <= 100 and len(t) <= 12 and sum(x * x for x in t) <= 100.0**2 for t in by_bin.values())


def test_little_space_is_left(spark):
    rng = random.Random(2)
    rows = [(i, min(4096, int(rng.expovariate(1 / 200)) + 1)) for i in range(5000)]
    report = fill_report(pack(spark.createDataFrame(rows, "doc long, size long"), item="doc", tokens="size")).first()
    assert report.filled > 0.99 and report.tokens == sum(s for _, s in rows)


def test_pack_is_repeatable_and_empty_is_fine(spark):
    rows = [(i, i % 77) for i in range(300)]
    a = {tuple(r) for r in packed(spark.createDataFrame(rows, "doc long, size long").repartition(3))}
    b = {tuple(r) for r in packed(spark.createDataFrame(rows[::-1], "doc long, size long").repartition(5))}
    assert a == b
    assert packed(spark.createDataFrame([], "doc long, size long")) == []
    with pytest.raises(ValueError):
        Container(tokens=10, attention=5.0)


def test_best_fit_prefers_the_tightest():
    assert list(best_fit(np.array([60, 30, 40, 70]), BOX)) == [1, 0, 1, 0]


def naive_best_fit(sizes, box):
    """Every open container is looked at for every item."""
    rest, place = [], np.zeros(len(sizes), int)
    for i in np.argsort(-sizes, kind="stable"):
        s, best = float(sizes[i]), None
        for n, (t, d, a) in enumerate(rest):
            if t >= s and d >= 1 and a >= s * s:
                left = (((t - s) / box.tokens) ** 2 * box.weights[0] + ((d - 1) / box.documents) ** 2 * box.weights[1] + ((a - s * s) / box.attention) ** 2 * box.weights[2])
                best = (left, n) if best is None or left < best[0] - 1e-15 else best
        n = len(rest) if best is None else best[1]
        if best is None:
            rest.append((box.tokens, box.documents, box.attention))
        t, d, a = rest[n]
        rest[n] = (t - s, d - 1, a - s * s)
        place[i] = n
    return place


@pytest.mark.parametrize("box", [BOX, Container(tokens=100, documents=4, attention=100.0**2, weights=(1, 0.5, 0.5))])
def test_best_fit_uses_as_few_containers_as_the_naive_one(box):
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.choice([0, 1, 5, 20, 33, 50, 51, 70, 99, 100], 300)
        got = best_fit(sizes, box)
        assert abs(got.max() - naive_best_fit(sizes, box).max()) <= 1
        for n in range(got.max() + 1):
            mine = sizes[got == n]
            assert len(mine) and mine.sum() <= box.tokens and len(mine) <= box.documents and (mine.astype(float) ** 2).sum() <= box.attention


def test_leftovers_never_meet_in_one_group(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 100)
    rng = random.Random(8)
    sizes = [rng.randrange(1400, 2000) for _ in range(5000)]
    rows = pack(spark.createDataFrame(list(enumerate(sizes)), "doc long, size long"), item="doc", tokens="size").collect()
    groups, bins = defaultdict(int), {r.bin for r in rows}
    for r in rows:
        groups[r.bin.rsplit("-", 1)[0]] += 1
    assert len(rows) == 5000 and max(groups.values()) <= 200
    assert len(bins) <= 1.01 * (best_fit(np.array(sizes), Container()).max() + 1)


def test_plan_with_documents_longer_than_the_spare_tokens():
    assert plan_source(np.array([90_000]), np.array([2]), 100_000, 1)[1].tolist() == [1]
    rng = random.Random(9)
    for _ in range(40):
        lengths = np.array(sorted(rng.sample(range(20_000, 200_000), 6)))
        counts = np.array([rng.randrange(0, 4) for _ in lengths])
        total = int((lengths * counts).sum())
        budget, repeats = rng.randrange(1, 2 * total + 2), rng.randrange(1, 4)
        whole, take = plan_source(lengths, counts, budget, repeats)
        assert whole == (repeats if not total else min(repeats, budget // total))
        assert (take <= counts).all() and (take >= 0).all()
        if whole < repeats:
            rest = budget - whole * total
            reach = {0}
            for size, n in zip(lengths, counts, strict=True):
                reach = {r + int(size) * k for r in reach for k in range(n + 1) if r + int(size) * k <= rest}
            fit = [(s, n) for s, n in zip(lengths, counts, strict=True) if s <= rest]
            short = max(reach) - int((take * lengths).sum())
            # Up to three of the longest documents are left to the knapsack alone; before, lengths keep their shares.
            assert short == 0 if min(rest, sum(int(s * n) for s, n in fit)) <= 3 * max((s for s, _ in fit), default=0) else 0 <= short < 0.05 * rest
        else:
            assert not take.any()


def test_subset_sum_is_the_best_possible():
    rng = random.Random(4)
    for _ in range(60):
        lengths = np.array(sorted(rng.sample(range(1, 40), 5)))
        counts = np.array([rng.randrange(0, 4) for _ in lengths])
        budget = rng.randrange(0, 150)
        take = subset_sum(lengths, counts, budget)
        reach = {0}
        for size, n in zip(lengths, counts, strict=True):
            reach = {r + size * k for r in reach for k in range(n + 1)}
        assert (take <= counts).all() and (take >= 0).all()
        assert int((take * lengths).sum()) == max(r for r in reach if r <= budget)


def test_mixture_reaches_shares_or_says_so(spark, crowded):
    rng = random.Random(3)
    rows = [(i, "big", rng.randrange(1, 90)) for i in range(3000)] + [(5000 + i, "mid", rng.randrange(1, 50)) for i in range(200)] + [(9000, "tiny", 10), (9001, None, 500), (9002, "zero", 0), (9003, "mid", None)]
    targets = [("big", 0.5, 2), ("mid", 0.3, 20), ("tiny", 0.1, 3), ("zero", 0.0, 1), ("none", 0.1, 4), (None, 0.2, 1)]
    docs = crowded(spark.createDataFrame(rows + rows[:100], "doc long, source string, tokens long"))
    chosen, report = mix(docs, crowded(spark.createDataFrame(targets, "source string, target_share double, max_repeats int")), doc_id="doc", source="source", tokens="tokens", seed=1)
    total = sum(s or 0 for _, _, s in rows)
    got = {r.source: r for r in report.collect()}
    assert set(got) == {"big", "mid", "tiny", "zero", "none"}
    for name, share, cap in targets[:4]:
        mine = [s or 0 for _, k, s in rows if k == name]
        aim = share * total
        assert got[name].missed == (sum(mine) * cap < aim)
        assert got[name].reached == (sum(mine) * cap if got[name].missed else pytest.approx(aim, abs=1))
    assert got["tiny"].missed and got["none"].missed and not got["zero"].missed
    used = chosen.collect()
    assert len(used) == len({r.doc for r in used})
    sums = defaultdict(int)
    for r in used:
        assert 1 <= r.repeats <= dict((s, c) for s, _, c in targets)[r.source]
        sums[r.source] += r.tokens * r.repeats
    assert {s: t for s, t in sums.items() if t} == {s: r.reached for s, r in got.items() if r.reached}
    assert sum(r.reached_share for r in got.values()) == pytest.approx(1)


def test_mixture_of_nothing(spark):
    chosen, report = mix(spark.createDataFrame([], "doc long, source string, tokens long"), spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int"), doc_id="doc", source="source", tokens="tokens")
    assert chosen.collect() == []
    row = report.first()
    assert (row.reached, row.missed) == (0, False)


def test_token_counts(spark):
    assert count_tokens(["", "hello world", "<|endoftext|>"])[:2] == [0, 2]
    long = "word " * 60_000
    assert count_tokens([long[:LONG_TEXT - 1], long[:LONG_TEXT]])[1] - count_tokens([long[:LONG_TEXT - 1]])[0] in (0, 1)
    assert count_tokens([" " * 1_600_000]) == [1_600_000]
    rows = spark.createDataFrame([("hello world",), ("",), (None,), (long,), ("你好",)], "t string").select(token_count(F.col("t")).alias("n")).collect()
    assert [r.n for r in rows][:3] == [2, 0, 0] and rows[3].n >= 50_000 and rows[4].n >= 2
