"""As-of joins of streams on one clock: causal, nearest, with provenance of what was used.

Rows of the clock and of all streams are united, shuffled once and ordered by time; a match is the last row of a stream before
a clock row, or the last one in the opposite order for what comes after it.  An entity's rows are cut into buckets of
time so that one long recording is many tasks; what a bucket can't see, a stream's last row before it (or the first
after), comes from one small row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.functions.integers import floor_div, usable_stamp
from tidelane.plans.joins import join_null_safe

#: Width of a bucket in units of the stamps: with nanoseconds a minute.
BUCKET = 60_000_000_000


def _matches(main: DataFrame, streams: list[tuple[DataFrame, str]], by: list[str], ts: str, seq: str, bucket: int) -> DataFrame:
    """Rows of ``main`` as struct ``l``, their time ``t``, and ``m0``, ``m1``, ...: (t, r) of each stream's match.

    Keys are one struct, so that null keys are equal and the join on them needs no other shuffle than the windows'.
    """
    sides = [main, *(rows for rows, _ in streams)]
    names = ["l", *(f"r{i}" for i in range(len(streams)))]
    kinds = [df.select(F.struct(*df.columns).alias("x")).schema["x"].dataType for df in sides]

    def side(n: int) -> DataFrame:
        df = sides[n]
        # Of equal stamps a nearest stream gives its first arrival, a causal one its last: the later one in this order.
        turn = F.lit(0) if n == 0 else F.col(seq) if streams[n - 1][1] == "causal" else -F.col(seq)
        own = [F.struct(*df.columns).alias(c) if i == n else F.lit(None).cast(kind).alias(c) for i, (c, kind) in enumerate(zip(names, kinds, strict=True))]
        rows = df.select(F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(by))).alias("k"), F.col(ts).cast("bigint").alias("t"), F.lit(n == 0).alias("clock"), turn.cast("bigint").alias("o"), *own)
        return rows.where(usable_stamp(F.col("t"))).withColumn("b", floor_div(F.col("t"), bucket))

    both = side(0)
    for n in range(1, len(sides)):
        both = both.unionByName(side(n))
    order = Window.partitionBy("k", "b").orderBy("t", "clock", "o").rowsBetween(Window.unboundedPreceding, 0)
    back_order = Window.partitionBy("k", "b").orderBy(F.desc("t"), F.desc("clock"), "o").rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    back_along = Window.partitionBy("k").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    inside, ends, carry = [], [], []
    for i, (_, mode) in enumerate(streams):
        there = F.col(f"r{i}").isNotNull()
        inside.append(F.last(F.when(there, F.struct("t", F.col(f"r{i}").alias("r"))), ignorenulls=True).over(order).alias(f"back{i}"))
        ends.append(F.max(F.when(there, F.struct("t", "o", F.col(f"r{i}").alias("r")))).alias(f"last{i}"))
        carry.append(F.last(f"last{i}", ignorenulls=True).over(along).alias(f"before{i}"))
        if mode == "nearest":
            inside.append(F.last(F.when(there, F.struct("t", F.col(f"r{i}").alias("r"))), ignorenulls=True).over(back_order).alias(f"ahead{i}"))
            ends.append(F.min(F.when(there, F.struct("t", (-F.col("o")).alias("o"), F.col(f"r{i}").alias("r")))).alias(f"first{i}"))
            carry.append(F.last(f"first{i}", ignorenulls=True).over(back_along).alias(f"after{i}"))
    rows = both.select("k", "b", "t", "clock", "l", *inside).where("clock")
    joined = rows.join(both.groupBy("k", "b").agg(*ends).select("k", "b", *carry), ["k", "b"])
    plain = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.t").alias("t"), F.col(f"{c}.r").alias("r")))
    found = []
    for i, (_, mode) in enumerate(streams):
        match = F.coalesce(f"back{i}", plain(f"before{i}"))
        if mode == "nearest":
            later = F.coalesce(f"ahead{i}", plain(f"after{i}"))
            match = F.when(match.isNull() | (later["t"] - F.col("t") < F.col("t") - match["t"]), F.coalesce(later, match)).otherwise(match)
        found.append(match.alias(f"m{i}"))
    return joined.select("l", "t", *found)


def asof(left: DataFrame, right: DataFrame, *, by: list[str], ts: str, seq: str, mode: str = "causal", tolerance: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """Every row of ``left`` (as struct ``l``) with its match in ``right`` (struct ``r``, NULL if none) and ``dt``, the match's time minus its own.

    Both sides have the columns ``by``, ``ts`` and ``seq`` (arrival), both BIGINT.  Modes: 'causal', the newest row at or before;
    of equal stamps the last arrival.  'nearest', the row at the smallest distance; of equal distances the earlier, of
    equal stamps the first arrival.  Beyond ``tolerance`` there is no match.

    Defined cases: rows with unusable stamps are left out; null keys are a group; copies on the left each give a
    row; an empty right side gives no match, an empty left side no row.
    """
    if mode not in ("causal", "nearest"):
        raise ValueError("mode must be causal or nearest")
    out = _matches(left, [(right, mode)], by, ts, seq, bucket)
    dt = F.col("m0.t") - F.col("t")
    near = F.lit(True) if tolerance is None else F.abs(dt) <= tolerance
    return out.select("l", F.when(near, F.col("m0.r")).alias("r"), F.when(near, dt).alias("dt"))


def fill_kind(frames: DataFrame, commands: DataFrame, observations: DataFrame, *, buffer_frames: int) -> DataFrame:
    """Where the action of each main frame comes from: exact, hold_last, fallback_to_observation or dropped.

    All sides have (episode, ts, seq), commands and observations a ``value``.  A command at or before the frame
    is used; it is exact if it isn't older than the oldest frame that a buffer of 2 x ``buffer_frames`` frames still
    holds at that frame, else held.  Without one, the nearest observation stands in.  Returns episode, ts, seq, value, kind.
    """
    order = Window.partitionBy("episode").orderBy("ts", "seq")
    h = F.lit(buffer_frames)
    placed = frames.select("episode", "ts", "seq", (F.row_number().over(order) - 1).alias("f"), F.count(F.lit(1)).over(Window.partitionBy("episode")).alias("n"))
    oldest = F.when(F.col("f") > F.col("n") - h, F.greatest(F.lit(0), F.col("n") - 2 * h)).otherwise(F.greatest(F.lit(0), F.col("f") - (h + 1)))
    placed = placed.withColumn("oldest", oldest)
    at = placed.select(F.col("episode").alias("e2"), F.col("f").alias("oldest"), F.col("ts").alias("oldest_ts"))
    placed = placed.join(at, (placed["episode"] == at["e2"]) & (placed["oldest"] == at["oldest"])).select("episode", "ts", "seq", "oldest_ts")
    command = asof(placed, commands, by=["episode"], ts="ts", seq="seq").select("l.*", F.col("r.value").alias("command"), F.col("r.ts").alias("command_ts"))
    full = asof(command, observations, by=["episode"], ts="ts", seq="seq", mode="nearest").select("l.*", F.col("r.value").alias("observed"))
    kind = F.when(F.col("command_ts") >= F.col("oldest_ts"), "exact").when(F.col("command_ts").isNotNull(), "hold_last").when(F.col("observed").isNotNull(), "fallback_to_observation").otherwise("dropped")
    return full.select("episode", "ts", "seq", F.when(F.col("command_ts").isNotNull(), F.col("command")).otherwise(F.col("observed")).alias("value"), kind.alias("kind"))


def fill_counts(kinds: DataFrame, by: list[str]) -> DataFrame:
    """Counts of each kind of fill."""
    of = lambda k: F.count_if(F.col("kind") == k).alias(k)
    return kinds.groupBy(*by).agg(of("exact"), of("hold_last"), of("fallback_to_observation"), of("dropped"))


def align(main: DataFrame, streams: dict[str, tuple[DataFrame, str]], *, by: list[str], ts: str, seq: str, complete: bool = True, bucket: int = BUCKET) -> DataFrame:
    """Each row of the main clock with one row of each other stream {name: (rows, mode)}, all in one pass (see :func:`asof`).

    Columns of the main stream, then a struct per stream.  With ``complete`` frames that lack any stream are dropped.
    """
    if any(mode not in ("causal", "nearest") for _, mode in streams.values()):
        raise ValueError("a mode must be causal or nearest")
    out = _matches(main, list(streams.values()), by, ts, seq, bucket)
    out = out.select("l.*", *(F.col(f"m{i}.r").alias(name) for i, name in enumerate(streams)))
    return out.dropna(subset=list(streams)) if complete else out


def fresh(value: Column, age: Column, most: float) -> Column:
    """A latest value only while it isn't older than ``most``."""
    return F.when(age <= most, value)


def merge_arms(arms: dict[str, DataFrame], *, by: list[str], ts: str, seq: str) -> DataFrame:
    """Vectors of all arms on the first arm's clock (order of names), concatenated; a missing arm is left out."""
    first, *others = sorted(arms)
    if not others:
        return arms[first]
    out = align(arms[first], {f"_{n}": (arms[n], "nearest") for n in others}, by=by, ts=ts, seq=seq, complete=False)
    none = F.array().cast(arms[first].schema["values"].dataType)
    values = F.concat("values", *(F.coalesce(F.col(f"_{n}.values"), none) for n in others))
    return out.select(*(c for c in arms[first].columns if c != "values"), values.alias("values"))


def merge_rigs(arms: dict[str, DataFrame], *, by: list[str], ts: str, seq: str) -> DataFrame:
    """As ``merge_arms``, but a group's clock is the first arm that it has, so a group without the first arm of all is kept."""
    names = sorted(arms)
    arms = {n: arms[n].where(usable_stamp(F.col(ts))) for n in names}
    out = merge_arms(arms, by=by, ts=ts, seq=seq)
    earlier = arms[names[0]].select(*by)
    for i, name in enumerate(names[1:], 1):
        alone = join_null_safe(arms[name], earlier.distinct(), by, "left_anti")
        out = out.unionByName(merge_arms({name: alone, **{n: arms[n] for n in names[i + 1 :]}}, by=by, ts=ts, seq=seq))
        earlier = earlier.unionByName(arms[name].select(*by))
    return out


def pair_vectors(truth: DataFrame, predicted: DataFrame, *, by: list[str], ts: str, seq: str) -> DataFrame:
    """Each ground-truth vector with the nearest prediction, both cut to the shorter length."""
    pairs = asof(truth, predicted, by=by, ts=ts, seq=seq, mode="nearest").where(F.col("r").isNotNull())
    n = F.least(F.size("l.values"), F.size("r.values"))
    return pairs.select(*(F.col(f"l.{c}").alias(c) for c in (*by, ts)), F.slice("l.values", 1, n).alias("truth"), F.slice("r.values", 1, n).alias("predicted"), "dt")
