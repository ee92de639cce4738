"""Irregular readings onto a regular grid of slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelane.functions.integers import STAMP_LIMIT, floor_div

#: Slots per block: what one task orders at once for one series.
BLOCK = 1 << 12


def regular_grid(df: DataFrame, series: list[str], slot: str, *, value: str | None = None, order: str | None = None, max_gap: int | None = None, block: int = BLOCK) -> DataFrame:
    """Every slot of each series from its first to its last reading, filled or marked.

    Args: ``slot`` is the BIGINT slot of a reading (a reading with a null slot or a null series
    column is no reading); ``value`` is what a slot carries, of its last reading by ``order``
    (ties: the larger value); ``max_gap`` is how many slots a value may be carried forward
    (None: any number).

    Returns the series columns, ``slot``, ``readings`` (0 where there is none), ``value`` and
    ``status``: 'read', 'filled' (carried forward) or 'missing'.

    Defined cases: copies of a reading change only ``readings``; a series with one slot gives that
    slot; an empty table gives no row; a null ``value`` counts as a reading and is not carried.

    Readings are reduced to slots before the shuffle.  A series is cut into blocks of ``block``
    slots, each made, joined and filled on its own, so neither a series with most of the rows
    nor one with a far outlier is one task's work; only one row per block and series meets in
    a window to hand on the last value before a block.
    """
    names = [f"g{i}" for i in range(len(series))]
    if value is None:
        value, df = "_no_value", df.withColumn("_no_value", F.lit(None).cast("double"))
    rows = df.select(*(F.col(c).alias(n) for c, n in zip(series, names, strict=True)), F.col(slot).cast("bigint").alias("slot"), F.col(value).alias("v"), (F.col(order) if order else F.lit(0)).alias("o"))
    present = F.col("slot").isNotNull() & (F.abs("slot") < STAMP_LIMIT)
    for n in names:
        present = present & F.col(n).isNotNull()
    buckets = rows.where(present).groupBy(*names, "slot").agg(F.count(F.lit(1)).alias("readings"), F.max(F.struct("o", "v")).alias("last")).select(*names, "slot", "readings", F.col("last.v").alias("v"))

    # One row per block that holds a reading: its ends, and the last value that can be carried out of it.
    blocks = buckets.groupBy(*names, floor_div(F.col("slot"), block).alias("blk")).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.max(F.when(F.col("v").isNotNull(), F.struct("slot", "v"))).alias("seen"))
    along = Window.partitionBy(*names).orderBy("blk")
    before = F.last("seen", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(*names, "blk", "lo", "hi", "seen", before.alias("carry"), F.lead("blk").over(along).alias("next_blk"), F.lead("lo").over(along).alias("next_lo"))
    # The block itself, then the blocks without a reading up to the next.  Each piece covers [from, to].
    spans = blocks.select(*names, "blk", "carry", "seen", "lo", "hi", F.explode(F.sequence(F.col("blk"), F.coalesce(F.col("next_blk") - 1, F.col("blk")))).alias("b"), "next_blk", F.lag("blk").over(along).isNull().alias("first"))
    base = F.lit(block).cast("bigint")
    spans = spans.select(
        *names,
        F.col("b").alias("blk"),
        F.when((F.col("b") == F.col("blk")) & F.col("first"), F.col("lo")).otherwise(F.col("b") * base).alias("from"),
        F.when((F.col("b") == F.col("blk")) & F.col("next_blk").isNull(), F.col("hi")).otherwise((F.col("b") + 1) * base - 1).alias("to"),
        F.when(F.col("b") == F.col("blk"), F.col("carry")).otherwise(F.coalesce("seen", "carry")).alias("carry"),
    )
    spread = spans.repartition(*names, "blk")
    grid = spread.select(*names, "blk", "carry", F.explode(F.sequence("from", "to")).alias("slot"))
    joined = grid.join(buckets, [*names, "slot"], "left")

    inside = Window.partitionBy(*names, "blk").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.last(F.when(F.col("v").isNotNull(), F.struct("slot", "v")), ignorenulls=True).over(inside), F.col("carry"))
    seen = F.last(F.when(F.col("readings").isNotNull(), F.col("slot")), ignorenulls=True).over(inside)
    filled = joined.withColumns({"last": last, "seen": seen})
    near = F.col("last").isNotNull() & (F.lit(True) if max_gap is None else F.col("slot") - F.col("last.slot") <= F.lit(max_gap))
    # What is carried forward to a slot with a reading is that reading.
    read = F.coalesce(F.col("seen") == F.col("slot"), F.lit(False))
    return filled.select(
        *(F.col(n).alias(c) for n, c in zip(names, series, strict=True)),
        "slot",
        F.coalesce("readings", F.lit(0).cast("bigint")).alias("readings"),
        F.when(read, F.col("v")).when(near, F.col("last.v")).alias("value"),
        F.when(read, "read").when(near, "filled").otherwise("missing").alias("status"),
    )
