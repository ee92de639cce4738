"""Pairing records of two tables that lie nearest in time.

Each right-side stamp owns the stretch of time that is nearer to it than to its neighbours and
within the tolerance: an interval bounded by midpoints and tolerance.  The intervals of an entity
are disjoint, so a left stamp lies in one at most.  They are indexed by entity and cell of time:
an interval is listed in each cell it meets (at most two), and the left stamps join the
intervals of their own cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelane.functions.integers import floor_div, usable_stamp
from tidelane.plans.joins import join_null_safe

#: Width of an index cell in tolerances.
CELL_TOLERANCES = 8


def neighbour_intervals(stamps: DataFrame, tolerance: int, cell: int) -> DataFrame:
    """Index of disjoint intervals (e, c, lo, hi, t, r) of the stamps (e, t, r), cut at cell borders.

    A cell needs only the stamps within the tolerance of it: others own nothing inside.
    """
    tol, wide = F.lit(tolerance).cast("bigint"), F.lit(cell).cast("bigint")
    listed = stamps.select("e", "t", "r", F.explode(F.sequence(floor_div(F.col("t") - tol, cell), floor_div(F.col("t") + tol, cell))).alias("c"))
    along = Window.partitionBy("e", "c").orderBy("t")
    before, after = F.lag("t").over(along), F.lead("t").over(along)
    half = lambda gap: F.call_function("div", gap, F.lit(2).cast("bigint"))
    # A stamp in the middle of two belongs to the earlier one.
    lo = F.greatest(F.col("t") - tol, F.col("c") * wide, before + half(F.col("t") - before) + 1)
    hi = F.least(F.col("t") + tol, (F.col("c") + 1) * wide - 1, F.col("t") + half(after - F.col("t")))
    return listed.select("e", "c", "t", "r", lo.alias("lo"), hi.alias("hi")).where(F.col("lo") <= F.col("hi"))


def nearest_in_time(left: DataFrame, right: DataFrame, *, left_entity: str, left_id: str, left_stamp: str, right_entity: str, right_id: str, right_stamp: str, tolerance: int) -> DataFrame:
    """Each left record with the right record of its entity that is nearest in time, if within ``tolerance``.

    Stamps and tolerance are BIGINT in one unit.  Returns ``entity``, ``left_id``, ``right_id``,
    ``left_stamp``, ``right_stamp``; left records without a partner have no row.

    Defined cases: of two equally near stamps the earlier, of records with one stamp the smallest
    id; null stamps and stamps beyond 2**61 are unusable; null entities match nothing; null ids are kept on the left
    and last choice on the right; copies of a left record give one row; an empty side gives none.
    Other columns are not read, whatever their names.

    Scale: stamps are reduced to distinct ones per entity before any shuffle and spread by cell, so an entity
    with a third of the rows is as many tasks as it has cells.  The join back to the records is a plain
    equi-join, which adaptive execution splits if many records share one stamp.
    """
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")
    cell = max(1, CELL_TOLERANCES * tolerance)
    records = left.select(F.col(left_entity).alias("e"), F.col(left_id).alias("l"), F.col(left_stamp).cast("bigint").alias("s")).where(F.col("e").isNotNull() & usable_stamp(F.col("s")))
    stamps = right.select(F.col(right_entity).alias("e"), F.col(right_id).alias("r"), F.col(right_stamp).cast("bigint").alias("t")).where(F.col("e").isNotNull() & usable_stamp(F.col("t")))
    index = neighbour_intervals(stamps.groupBy("e", "t").agg(F.min("r").alias("r")), tolerance, cell)
    probes = records.select("e", "s").distinct().withColumn("c", floor_div(F.col("s"), cell))
    hits = probes.join(index, ["e", "c"]).where(F.col("s").between(F.col("lo"), F.col("hi"))).select("e", "s", "t", "r")
    pairs = records.join(hits, ["e", "s"]).select("e", "l", "r", "s", "t").distinct()
    return pairs.toDF("entity", "left_id", "right_id", "left_stamp", "right_stamp")


def unmatched(left: DataFrame, pairs: DataFrame, left_id: str) -> DataFrame:
    """The left records that have no partner in ``pairs`` (a record with a null id counts by that null)."""
    return join_null_safe(left, pairs.select(F.col("left_id").alias(left_id)), [left_id], "left_anti")
