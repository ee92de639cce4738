"""Joins whose null keys match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which a null matches a null; columns of ``left``, then the others of ``right``.

    Still a hash or sort-merge join: ``<=>`` on a column is an equality to the planner.
    """
    other = right.toDF(*(f"__{c}" for c in right.columns))
    joined = left.join(other, [left[c].eqNullSafe(other[f"__{c}"]) for c in on], how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select(*left.columns, *(F.col(f"__{c}").alias(c) for c in right.columns if c not in on))


#: Rows up to which a side is sent to every executor: some tens of MB for rows of a few short columns.
SMALL_SIDE = 200_000


def small_side(df: DataFrame, most: int = SMALL_SIDE) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows (counted), else as it is, so that the join shuffles.

    Meant for checkpointed or otherwise cheap sides with narrow rows, as counting computes them.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
