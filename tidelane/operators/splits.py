"""Train, validation and test splits of episodes, and checks of them."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.plans.places import number_bin, with_places


def split_counts(n: int, ratios: tuple[float, ...]) -> tuple[int, int, int]:
    """Sizes of the three parts: test and validation rounded half to even, the rest is train.  Two ratios: no test."""
    total = sum(ratios)
    val, test = round(n * ratios[1] / total), round(n * ratios[2] / total) if len(ratios) > 2 else 0
    return n - val - test, val, test


def shuffled_split(episodes: list[int], ratios: tuple[float, ...], seed: int) -> dict[str, list[int]]:
    """Random three-way split of an episode list (metadata of one dataset, on the driver)."""
    order = sorted(episodes)
    random.Random(seed).shuffle(order)
    train, val, _ = split_counts(len(order), ratios)
    return {"train": sorted(order[:train]), "val": sorted(order[train : train + val]), "test": sorted(order[train + val :])}


def stratified_shuffle(strata: dict[int, str], ratios: tuple[float, ...], seed: int) -> dict[str, list[int]]:
    """As :func:`shuffled_split` in each stratum on its own: a stratum's seed comes from its name, so others don't change when it grows."""
    out: dict[str, list[int]] = {"train": [], "val": [], "test": []}
    for name in sorted(set(strata.values())):
        own = int.from_bytes(hashlib.sha256(f"{seed}:{name}".encode()).digest()[:8], "big")
        for split, episodes in shuffled_split([e for e, s in strata.items() if s == name], ratios, own).items():
            out[split] += episodes
    return {k: sorted(v) for k, v in out.items()}


def replay_split(episodes: list[int], seed: int, share: float = 0.1) -> dict[str, list[int]]:
    """Shuffled split with at least one validation and one test episode."""
    order = list(episodes)
    random.Random(seed).shuffle(order)
    n = max(1, round(share * len(order)))
    return {"val": sorted(order[:n]), "test": sorted(order[n : 2 * n]), "train": sorted(order[2 * n :])}


def contiguous_ranges(n: int, ratios: tuple[float, float, float]) -> dict[str, tuple[int, int]]:
    """Ranges [from, to) of contiguous splits, at least one episode in validation and test where there are three or more."""
    total = sum(ratios)
    val, test = (max(1, round(n * r / total)) if n >= 3 and r > 0 else 0 for r in ratios[1:])
    train = n - val - test
    return {"train": (0, train), "val": (train, train + val), "test": (train + val, n)}


def contiguous_split(episodes: DataFrame, episode: str, ratios: tuple[float, float, float]) -> DataFrame:
    """Episodes (BIGINT) in their order cut into train, val and test; their places come from bins of numbers."""
    rows = with_places(episodes.select(episode).distinct(), [], [F.col(episode)], number_bin(episode))
    n, whole = F.col("_total"), sum(ratios)
    part = lambda r: F.when((n >= 3) & F.lit(r > 0), F.greatest(F.lit(1), F.rint(n * r / whole).cast("int"))).otherwise(0)
    val, test = part(ratios[1]), part(ratios[2])
    return rows.select(episode, F.when(F.col("_place") < n - val - test, "train").when(F.col("_place") < n - test, "val").otherwise("test").alias("split"))


def _digest(seed: int, stratum: Column, episode: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), stratum, episode.cast("string")), 256)


def stratified_split(episodes: DataFrame, *, episode: str, stratum: str, ratios: tuple[float, float, float], seed: int) -> DataFrame:
    """Split of (episode, stratum) by rank of a seeded digest inside the stratum; strata don't depend on one another."""
    digested = episodes.select(episode, stratum).distinct().withColumn("_d", _digest(seed, F.col(stratum), F.col(episode)))
    placed = with_places(digested, [stratum], [F.col("_d"), F.col(episode)], F.substring("_d", 1, 3)).withColumn("_r", F.col("_place") + 1)
    total = sum(ratios)
    test, val = (F.rint(F.col("_total") * r / total) for r in (ratios[2], ratios[1]))
    train = F.col("_total") - test - val
    return placed.select(episode, stratum, F.when(F.col("_r") <= train, "train").when(F.col("_r") <= train + val, "val").otherwise("test").alias("split"))


def sample_per_split(rows: DataFrame, *, split: str, episode: str, n: int, seed: int) -> DataFrame:
    """``n`` episodes of each split, drawn without replacement by a seeded digest."""
    order = Window.partitionBy(split).orderBy(_digest(seed, F.col(split), F.col(episode)), episode)
    return rows.select(split, episode).distinct().withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def strata_summary(splits: DataFrame, stratum: str) -> DataFrame:
    """Episodes per stratum and split."""
    of = lambda s: F.count_if(F.col("split") == s).alias(s)
    return splits.groupBy(stratum).agg(of("train"), of("val"), of("test"), F.count(F.lit(1)).alias("total"))


def split_problems(splits: DataFrame, episode: str, total: int | None = None) -> DataFrame:
    """Problems of a split table: unknown split names, episodes outside 0..total-1, in several splits, and an empty train split."""
    problem = lambda df, code: df.select(F.lit(code).alias("problem"), F.col(episode).cast("bigint").alias("episode"))
    out = problem(splits.where(~F.coalesce(F.col("split"), F.lit("")).isin("train", "val", "test")), "unknown_split").distinct()
    out = out.unionByName(problem(splits.where(F.col(episode).isNull() | (F.col(episode) < 0) | (F.lit(total is not None) & (F.col(episode) >= F.lit(total or 0)))), "out_of_range").distinct())
    shared = splits.groupBy(episode).agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b")
    out = out.unionByName(problem(shared, "several_splits"))
    empty = splits.agg(F.count_if(F.col("split") == "train").alias("n")).where("n = 0").select(F.lit("empty_train").alias("problem"), F.lit(None).cast("bigint").alias("episode"))
    return out.unionByName(empty)


def split_document(splits: DataFrame, episode: str) -> DataFrame:
    """One row: the split as a JSON text with sorted episode lists.  The document lists every episode by its nature; it is metadata."""
    of = lambda s: F.array_sort(F.collect_set(F.when(F.col("split") == s, F.col(episode)))).alias(f"{s}_episodes")
    return splits.agg(of("train"), of("val"), of("test")).select(F.to_json(F.struct("*")).alias("document"))


def resolve_split(*, file: dict | None, legacy_range: tuple[int, int] | None, ratios: tuple[float, ...] | None, episodes: list[int], seed: int = 0) -> dict[str, list[int]]:
    """The split to use: that of a file, else a legacy range as validation, else ratios."""
    if file:
        return {s: sorted(file.get(f"{s}_episodes", [])) for s in ("train", "val", "test")}
    if legacy_range:
        low, high = legacy_range
        val = [e for e in episodes if low <= e < high]
        return {"train": sorted(set(episodes) - set(val)), "val": sorted(val), "test": []}
    return shuffled_split(episodes, ratios or (8, 1, 1), seed)


def shard_plan(n: int, shards: int) -> list[tuple[int, int]]:
    """Contiguous ranges [from, to) of ``n`` items, larger ones first; no more shards than items."""
    shards = max(1, min(shards, n)) if n else 1
    base, more = divmod(n, shards)
    ends = [0]
    for i in range(shards):
        ends.append(ends[-1] + base + (i < more))
    return list(zip(ends, ends[1:], strict=False))


def shards(episodes: DataFrame, episode: str, count: int) -> DataFrame:
    """Shard number (from 0) of each episode (BIGINT), contiguous and larger ones first."""
    placed = with_places(episodes.select(episode).distinct(), [], [F.col(episode)], number_bin(episode))
    size, more = F.expr(f"_total div {count}"), F.expr(f"_total % {count}")
    # The first ones hold one episode more.
    large = more * (size + 1)
    shard = F.when(F.col("_place") < large, F.call_function("div", "_place", size + 1)).otherwise(more + F.call_function("div", F.col("_place") - large, F.greatest(size, F.lit(1))))
    return placed.select(episode, shard.cast("int").alias("shard"))
