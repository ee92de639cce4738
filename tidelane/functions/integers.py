"""Exact integer arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stamps beyond this magnitude are unusable: sums and differences of two could overflow a BIGINT.
STAMP_LIMIT = 1 << 61


def floor_div(value: Column, width: int) -> Column:
    """Floor of BIGINT division (``div`` alone truncates towards zero, ``/`` goes through DOUBLE)."""
    wide = F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, wide), wide)


def seconds_to_ns(seconds: Column) -> Column:
    """DOUBLE seconds to BIGINT ns, half to even; NULL for null, non-finite or unusably large values."""
    ns = F.rint(seconds * 1e9)
    return F.when(F.abs(ns) < float(STAMP_LIMIT), ns).cast("bigint")


def usable_stamp(stamp: Column) -> Column:
    """Whether a BIGINT stamp is present and small enough for exact sums."""
    return stamp.isNotNull() & (stamp > -STAMP_LIMIT) & (stamp < STAMP_LIMIT)
