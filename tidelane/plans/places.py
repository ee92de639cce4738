"""Places of rows in the order of their group, without ordering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.plans.joins import join_null_safe

#: Width of a bin of whole numbers.
WIDTH = 1 << 16


def number_bin(number: str) -> Column:
    """Bins of a BIGINT column in its order."""
    return F.call_function("div", F.col(number), F.lit(WIDTH).cast("bigint"))


def with_places(rows: DataFrame, by: list[str], order: list[Column], bin_: Column) -> DataFrame:
    """``rows`` with ``_place`` (from 0) in ``order`` within the group ``by``, and ``_total``, the group's rows.

    ``bin_`` must not fall along ``order``; places come from bin totals and an order inside each bin, so a task orders one
    bin.  Only one row a bin meets in a window over the group.  Null keys are a group.
    """
    binned = rows.withColumn("_bin", bin_)
    along = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = binned.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    sums = sums.select(*by, "_bin", F.coalesce(F.sum("_c").over(along), F.lit(0)).alias("_base"), F.sum("_c").over(Window.partitionBy(*by)).alias("_total"))
    inner = F.row_number().over(Window.partitionBy(*by, "_bin").orderBy(*order)) - 1
    placed = join_null_safe(binned.withColumn("_inner", inner), sums, [*by, "_bin"])
    return placed.withColumn("_place", F.col("_base") + F.col("_inner")).drop("_bin", "_inner", "_base")
