"""Exact order statistics of groups of any size, without gathering a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.functions.orderkeys import order_key
from tidelane.plans.joins import join_null_safe

#: Leading bits of a value's key that make its bin: sign, exponent and 8 bits of the fraction, so 256 bins an octave.
BIN_BITS = 20


def ranked_values(rows: DataFrame, by: list[str], x: str, places: Column, count: str | None = None) -> DataFrame:
    """(by, ``n``, ``rank``, ``value``): the values at some ranks (from 0) of each group; ``places`` is an ARRAY of ranks in terms of ``n``.

    Each value counts ``count`` times (default once).  Two digits: counts by bin locate the ranks, then only the values of
    those bins are ordered.  Counting combines before the shuffle, so no group is gathered.  Null values don't
    count, NaN is the largest; null keys are a group; a group without values has no row; ranks that a group hasn't give none.
    """
    names = [f"g{i}" for i in range(len(by))]
    times = F.lit(1).cast("bigint") if count is None else F.col(count)
    bins = rows.select(*(F.col(c).alias(g) for g, c in zip(names, by, strict=True)), F.col(x).cast("double").alias("x"), times.alias("c")).where(F.col("x").isNotNull())
    bins = bins.groupBy(*names, "x").agg(F.sum("c").alias("c")).withColumn("b", F.when(F.isnan("x"), F.lit(1 << (BIN_BITS - 1)).cast("bigint")).otherwise(F.shiftright(order_key(F.col("x")), 64 - BIN_BITS)))
    sums = bins.groupBy(*names, "b").agg(F.sum("c").alias("c"))
    along = Window.partitionBy(*names).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, "b", "c", F.coalesce(F.sum("c").over(along), F.lit(0)).alias("base"), F.sum("c").over(Window.partitionBy(*names)).alias("n"))
    ranks = sums.withColumn("rank", F.explode(F.array_distinct(places).cast("array<bigint>")))
    ranks = ranks.where((F.col("rank") >= F.col("base")) & (F.col("rank") < F.col("base") + F.col("c"))).drop("c")
    inside = join_null_safe(bins, ranks, [*names, "b"])
    upto = F.sum("c").over(Window.partitionBy(*names, "b", "rank").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("upto", F.col("base") + upto)
    hits = inside.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c")))
    return hits.select(*(F.col(g).alias(c) for g, c in zip(names, by, strict=True)), "n", "rank", F.col("x").alias("value"))


def grouped_median(rows: DataFrame, by: list[str], x: str, count: str | None = None) -> DataFrame:
    """(by, median) of the values ``x``, each counted ``count`` times (default once); see :func:`ranked_values`."""
    middle = ranked_values(rows, by, x, F.array(F.expr("(n - 1) div 2"), F.expr("n div 2")), count)
    return middle.groupBy(*by).agg(F.avg("value").alias("median"))


def grouped_percentiles(rows: DataFrame, by: list[str], x: str, points: list[float]) -> DataFrame:
    """(by, ``percentiles``): the linear percentiles of ``x`` at ``points`` as an ARRAY in their order; see :func:`ranked_values`."""
    place = lambda p: (F.col("n") - 1) * F.lit(float(p))
    ranks = ranked_values(rows, by, x, F.array(*(r(place(p)) for p in points for r in (F.floor, F.ceil))))
    held = ranks.groupBy(*by).agg(F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("v"))

    def at(p: float) -> Column:
        low, high = F.element_at("v", F.floor(place(p)).cast("bigint")), F.element_at("v", F.ceil(place(p)).cast("bigint"))
        return F.when(low == high, low).otherwise(low + (high - low) * (place(p) - F.floor(place(p))))

    return held.select(*by, F.array(*map(at, points)).alias("percentiles"))
