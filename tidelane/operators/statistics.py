"""Exact statistics of features, from rows or from histograms, and checks that use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.operators.medians import grouped_percentiles
from tidelane.plans.joins import join_null_safe

POINTS = {"q01": 0.01, "q10": 0.10, "q50": 0.50, "q90": 0.90, "q99": 0.99}


def _aggregates(x: Column) -> list[Column]:
    return [F.count(x).alias("count"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")]


def feature_stats(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, extremes, mean, population deviation and exact linear quantiles of a value per group.

    The quantiles come from counts by bin (:func:`tidelane.operators.medians.ranked_values`), so a group may have any size.
    Null values don't count (a group of nulls has a count of 0 and no statistics); NaN is largest.
    """
    quantiles = grouped_percentiles(rows, by, value, list(POINTS.values()))
    both = join_null_safe(rows.groupBy(*by).agg(*_aggregates(F.col(value))), quantiles, by, "left")
    return both.select(*(c for c in both.columns if c != "percentiles"), *(F.get("percentiles", F.lit(i)).alias(n) for i, n in enumerate(POINTS)))


def grouped_stats(rows: DataFrame, common: list[str], extra: str, value: str) -> DataFrame:
    """Statistics per ``common`` group (``extra`` NULL, ``over_all`` 1) and per ``common`` and ``extra`` (``over_all`` 0)."""
    whole = feature_stats(rows, common, value).select(*common, F.lit(None).cast(rows.schema[extra].dataType).alias(extra), "count", "min", "max", "mean", "std", *POINTS, F.lit(1).cast("tinyint").alias("over_all"))
    return whole.unionByName(feature_stats(rows, [*common, extra], value).withColumn("over_all", F.lit(0).cast("tinyint")))


def vector_rows(rows: DataFrame, keep: list[str], vector: str) -> DataFrame:
    """One row per element of a vector: keys, ``dim`` (from 0), ``x``."""
    return rows.select(*keep, F.posexplode(vector).alias("dim", "x"))


def histogram(rows: DataFrame, by: list[str], value: str, levels: int = 256) -> DataFrame:
    """Counts of each level 0..levels-1 (values outside are left out): a summary that adds up across files."""
    v = F.col(value).cast("int")
    return rows.select(*by, v.alias("level")).where(v.between(0, levels - 1)).groupBy(*by, "level").agg(F.count(F.lit(1)).alias("n"))


def histogram_stats(counts: DataFrame, by: list[str], top: float = 255.0, points: dict[str, float] = POINTS) -> DataFrame:
    """Exact statistics of level / ``top`` from counts (by, level, n): weighted sums, and quantiles by rank in the cumulative count.

    At most one row per level and group is ordered, however many values were counted.
    """
    x = F.col("level") / top
    along = Window.partitionBy(*by).orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(*by)
    placed = counts.select("*", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("below"), F.sum("n").over(total).alias("total"))
    # The value at a rank is the level that the rank falls in.
    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col("n")), x))

    place = lambda p: (F.col("total") - 1) * p
    mean = F.sum(x * F.col("n")) / F.sum("n")
    square = F.sum(x * x * F.col("n")) / F.sum("n")
    out = placed.groupBy(*by).agg(
        F.sum("n").alias("count"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        mean.alias("mean"),
        F.sqrt(F.greatest(F.lit(0.0), square - mean * mean)).alias("std"),
        *(at(F.floor(place(p))).alias(f"{n}_low") for n, p in points.items()),
        *(at(F.ceil(place(p))).alias(f"{n}_high") for n, p in points.items()),
    )
    mix = lambda n, p: F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * ((F.col("count") - 1) * p - F.floor((F.col("count") - 1) * p))
    return out.select(*by, "count", "min", "max", "mean", "std", *(mix(n, p).alias(n) for n, p in points.items()))


def approximate_stats(rows: DataFrame, by: list[str], value: str, accuracy: int = 1000) -> DataFrame:
    """Statistics with quantiles of bounded rank error 1 / ``accuracy`` from mergeable summaries of bounded size."""
    x = F.col(value)
    return rows.groupBy(*by).agg(F.count(x).alias("count"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), *(F.percentile_approx(x, p, accuracy).alias(n) for n, p in POINTS.items()))


def finite(x: Column) -> Column:
    """Whether a number is there and neither NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def quantile_normalized(x: Column, low: Column, high: Column, eps: float = 1e-8) -> Column:
    """-1 at the low quantile, 1 at the high; a constant feature uses ``eps`` as its span."""
    span = F.when(F.abs(high - low) < eps, F.lit(eps)).otherwise(high - low)
    return 2 * (x - low) / span - 1


def quantile_restored(y: Column, low: Column, high: Column, eps: float = 1e-8) -> Column:
    span = F.when(F.abs(high - low) < eps, F.lit(eps)).otherwise(high - low)
    return (y + 1) / 2 * span + low


def round_trip(rows: DataFrame, by: list[str], value: str, tolerance: float = 1e-9) -> DataFrame:
    """Per group, how many values do not come back from quantile normalisation."""
    bounds = rows.groupBy(*by).agg(F.percentile(value, 0.01).alias("low"), F.percentile(value, 0.99).alias("high"))
    x = F.col(value)
    back = quantile_restored(quantile_normalized(x, F.col("low"), F.col("high")), F.col("low"), F.col("high"))
    return rows.join(bounds, by).groupBy(*by).agg(F.count_if(F.abs(back - x) > tolerance).alias("changed"), F.count(F.lit(1)).alias("values"))


def stats_differences(a: DataFrame, b: DataFrame, keys: list[str], stats: list[str], tolerance: float = 0.0) -> DataFrame:
    """Keys and statistics that differ (or are on one side only) between two tables of statistics."""
    long = lambda df: df.select(*keys, F.explode(F.array(*(F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("x")) for s in stats))).alias("s")).select(*keys, "s.stat", "s.x")
    both = long(a).withColumnRenamed("x", "left").join(long(b).withColumnRenamed("x", "right"), [*keys, "stat"], "full_outer")
    same = F.col("left").eqNullSafe(F.col("right")) | F.coalesce(F.abs(F.col("left") - F.col("right")) <= tolerance, F.lit(False))
    return both.where(~same)
