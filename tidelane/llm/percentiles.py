"""Percentiles of very large numeric columns by radix selection.

A value's bits, mapped so that integer order is numeric order, are read as four digits.  Counts of the leading digits per
group are summaries of a file or day (:func:`summarise`); they add up (:func:`merge`), and the sum alone gives percentiles
within a stated error (:func:`percentiles_from`).  :func:`percentiles` goes on to the exact value: each pass counts one more digit
among the values that share the digits chosen before, and follows the digit in which a target rank falls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.functions.orderkeys import order_key, order_value
from tidelane.plans.joins import small_side
from tidelane.plans.lineage import cut

#: Leading bits that are known after each pass: the first digit has sign, exponent and 8 bits of mantissa.
ENDS = (20, 36, 52, 64)
DIGITS = len(ENDS)


def error_bound(digits: int) -> float:
    """Largest error of a percentile from ``digits`` digits, as a share of the larger neighbour of its rank; normal doubles (0 after four)."""
    return 0.0 if digits >= DIGITS else 2.0 ** (11 - ENDS[digits - 1])


def _prefix(key: Column, digits: int) -> Column:
    return F.shiftright(key, 64 - ENDS[digits - 1])


def _keyed(df: DataFrame, groups: dict[str, str], value: str) -> DataFrame:
    """The groups under new names, and the key of each value that counts."""
    x = F.col("_x")
    rows = df.select(*(F.col(c).alias(n) for n, c in groups.items()), F.col(value).cast("double").alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    return rows.select(*groups, order_key(x).alias("key"))


def summarise(df: DataFrame, groups: list[str], value: str, *, digits: int = 1) -> DataFrame:
    """The mergeable summary (groups, ``prefix``, ``n``): how many values of each group have these first ``digits`` digits.

    Null and NaN values don't count (infinities do); null grouping values are a group; other columns are not read.
    The first digit has 256 cells an octave, so a summary has some thousand rows a group at most, however many values it has.
    """
    if not 1 <= digits <= DIGITS:
        raise ValueError("digits must be 1 to 4")
    names = {f"g{i}": c for i, c in enumerate(groups)}
    counts = _keyed(df, names, value).groupBy(*names, _prefix(F.col("key"), digits).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(*(F.col(n).alias(c) for n, c in names.items()), "prefix", "n")


def merge(summary: DataFrame, groups: list[str]) -> DataFrame:
    """Summaries of files, days or finer groups (rows under one another) as one summary of ``groups``."""
    return summary.groupBy(*groups, "prefix").agg(F.sum("n").alias("n"))


def _placed(counts: DataFrame, group: list[str], parent: Column) -> DataFrame:
    """Counts with their parent cell and the number of values of that cell before them."""
    along = Window.partitionBy(*group, "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("parent", parent).select(*group, "parent", "prefix", "n", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("below"))


def _first_targets(counts: DataFrame, group: list[str], points: dict[str, float]) -> DataFrame:
    """Of a summary, the cells of both ranks around the place of each percentile, in one pass along each group."""
    placed = _placed(counts, group, F.lit(0).cast("bigint"))
    placed = placed.withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
    place = lambda p: (F.col("total") - 1) * F.lit(float(p))
    upto = F.col("below") + F.col("n")
    # Few cells hold a rank: they are found by plain comparisons before any list of ranks is made.
    placed = placed.where(reduce(Column.__or__, ((F.floor(place(p)) < upto) & (F.ceil(place(p)) >= F.col("below")) for p in points.values())))
    ranks = [F.struct(F.lit(s).alias("stat"), place(p).alias("place"), r(place(p)).alias("rank"), F.floor(place(p)).alias("low")) for s, p in points.items() for r in (F.floor, F.ceil)]
    mine = F.filter(F.array_distinct(F.array(*ranks)), lambda r: (r["rank"] >= F.col("below")) & (r["rank"] < upto))
    hit = placed.select(*group, "total", "prefix", "below", F.explode(mine).alias("r"))
    return hit.select(*group, "total", "r.stat", "r.place", "r.rank", "r.low", F.col("prefix").alias("parent"), (F.col("r.rank") - F.col("below")).alias("left"))


def _results(targets: DataFrame, group: list[str], digits: int) -> DataFrame:
    """(group, n, stat, result, low, high) from the last cell of each rank: its middle, and the ends between which the percentile lies."""
    spare = 64 - ENDS[digits - 1]
    first = F.shiftleft("parent", spare)
    last = first + F.lit((1 << spare) - 1).cast("bigint")
    middle = first + F.lit((1 << spare) >> 1).cast("bigint") if spare else first
    at = lambda key, name: (F.min(F.when(F.col("rank") == F.col("low"), key)).alias(f"{name}_a"), F.max(key).alias(f"{name}_b"))
    ends = targets.groupBy(*group, "total", "stat", "place", "low").agg(*at(middle, "m"), *at(first, "f"), *at(last, "l"))
    a, b = (lambda name: order_value(F.col(f"{name}_a"))), (lambda name: order_value(F.col(f"{name}_b")))
    between = lambda name: F.when(F.col(f"{name}_a") == F.col(f"{name}_b"), a(name)).otherwise(a(name) + (b(name) - a(name)) * (F.col("place") - F.col("low")))
    return ends.select(*group, F.col("total").alias("n"), "stat", between("m").alias("result"), between("f").alias("low"), between("l").alias("high"))


def percentiles_from(summary: DataFrame, groups: list[str], points: dict[str, float], *, digits: int = 1) -> DataFrame:
    """Linear percentiles from merged summaries alone: (groups, ``n``, ``stat``, ``result``, ``low``, ``high``).

    ``summary`` is a result of :func:`summarise` with as many ``digits`` or of :func:`merge`; ``points`` names the percentiles (0..1).
    ``result`` is off by :func:`error_bound` at most; ``low`` and ``high`` are bounds of the exact percentile.  Null grouping
    values are a group; an empty summary gives no row.
    """
    names = {f"g{i}": c for i, c in enumerate(groups)}
    counts = summary.select(*(F.col(c).alias(n) for n, c in names.items()), "prefix", "n")
    out = _results(_first_targets(counts, list(names), points), list(names), digits)
    return out.select(*(F.col(n).alias(c) for n, c in names.items()), "n", "stat", "result", "low", "high")


def percentiles(df: DataFrame, levels: list[list[str]], value: str, points: dict[str, float], *, digits: int = DIGITS) -> DataFrame:
    """Linear percentiles of ``value`` for the groups of each level of grouping columns.

    Args: ``levels`` are lists of columns, each a prefix of the next (coarse to fine); ``points`` names the
    percentiles (0..1); ``digits`` passes bound the error (see :func:`error_bound`; 4: exact).

    Returns the finest level's columns (null where a level hasn't them), ``level`` (its number), ``n``, ``stat``, ``result``.

    Null and NaN values don't count (infinities do); a group without values has no row; ties and copies count as
    often as they occur; null grouping values are a group; an empty table gives no row.  Other columns are not read.

    Scale: each pass is one map-side combined count, of 256 cells an octave in the first and 65,536 a cell in the next.  What is
    kept between passes are the values in the cells that targets fall in, never the whole column; ``df`` is read twice.  No
    group is ever gathered.
    """
    if any(fine[: len(coarse)] != coarse for coarse, fine in zip(levels, levels[1:], strict=False)):
        raise ValueError("each level must extend the one before")
    if not 1 <= digits <= DIGITS:
        raise ValueError("digits must be 1 to 4")
    finest = levels[-1]
    names = {f"g{i}": c for i, c in enumerate(finest)}
    group = ["level", *names]
    keyed = _keyed(df, names, value)

    def at_level(i: int) -> list[Column]:
        return [F.lit(i).alias("level"), *(F.col(n) if k < len(levels[i]) else F.lit(None).cast(keyed.schema[n].dataType).alias(n) for k, n in enumerate(names))]

    fine = keyed.groupBy(*names, _prefix(F.col("key"), 1).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    counts = reduce(DataFrame.unionByName, (fine.select(*at_level(i), "prefix", "n") for i in range(len(levels))))
    if len(levels) > 1:
        counts = merge(counts, group)
    targets = cut(_first_targets(counts, group, points))
    live = keyed.select(F.explode(F.array(*(F.struct(*at_level(i)) for i in range(len(levels))))).alias("l"), "key").select("l.*", "key")
    for d in range(2, digits + 1):
        # Cells of the chosen digits: a few per group.  Few enough in all, they go to the values; else the values go to them.
        cells = small_side(targets.select(*group, "parent").distinct())
        cell = cells.toDF(*(f"c_{c}" for c in cells.columns))
        live = cut(live.join(cell, [live[c].eqNullSafe(cell[f"c_{c}"]) for c in group] + [_prefix(live["key"], d - 1) == cell["c_parent"]], "left_semi"))
        counts = live.groupBy(*group, _prefix(F.col("key"), d).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        other = _placed(counts, group, F.shiftright("prefix", ENDS[d - 1] - ENDS[d - 2]))
        other = other.toDF(*(f"c_{c}" for c in other.columns))
        on = [targets[c].eqNullSafe(other[f"c_{c}"]) for c in [*group, "parent"]]
        hit = targets.join(other, [*on, (F.col("left") >= F.col("c_below")) & (F.col("left") < F.col("c_below") + F.col("c_n"))])
        targets = cut(hit.select(*group, "total", "stat", "place", "rank", "low", F.col("c_prefix").alias("parent"), (F.col("left") - F.col("c_below")).alias("left")))
    out = _results(targets, group, digits)
    return out.select(*(F.col(n).alias(c) for n, c in names.items()), "level", "n", "stat", "result")
