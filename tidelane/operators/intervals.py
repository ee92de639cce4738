"""Overlapping and gapped intervals: continuous periods and the gaps between them.

The aggregate is a sorted list of disjoint intervals.  Two lists combine by one
linear merge, so partial lists can be built per input partition, merged in a
reduction tree and still give the same periods in any order.

A list never grows without bound: it holds the intervals that *start* in one
block of time, and integer intervals that do not touch need at least two units
each, so a list has at most ``block / 2`` entries.  Only each block's largest
end crosses block borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.functions import segments
from tidelane.functions.integers import STAMP_LIMIT, floor_div
from tidelane.plans.joins import join_null_safe
from tidelane.plans.lineage import cut

#: Time units per block: with milliseconds about a minute, so at most 32,768 intervals in a list.
BLOCK = 1 << 16
#: Partial lists of one block that a task of the lower tree level merges are 1/FAN_IN of all.
FAN_IN = 32


def linear_merge(gid: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge interval lists into sorted disjoint lists per group; touching intervals join.

    The inputs are concatenated sorted runs, which the stable sort merges run by run.
    """
    if not len(gid):
        return gid, start, end
    order = np.lexsort((start, gid))
    gid, start, end = gid[order], start[order], end[order]
    reach = segments.running_max(end, gid)
    new = np.r_[True, (gid[1:] != gid[:-1]) | (start[1:] > reach[:-1])]
    at = np.flatnonzero(new)
    return gid[at], start[at], reach[np.r_[at[1:] - 1, len(gid) - 1]]


def _emit(keys: list[pa.Array], gid: np.ndarray, start: np.ndarray, end: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    n = len(keys[0])
    return pa.RecordBatch.from_arrays([*keys, segments.lists_of(start, gid, n, pa.int64()), segments.lists_of(end, gid, n, pa.int64())], schema=schema)


def _partial(n_keys: int):
    """Rows (keys, block, start, end) of a partition to one list per key and block and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(i) for i in range(n_keys)]
            gid, first = segments.group_numbers(keys)
            gid, start, end = linear_merge(gid, batch.column(n_keys).to_numpy(), batch.column(n_keys + 1).to_numpy())
            kept = [k.take(pa.array(first)) for k in keys]
            names = [f"k{i}" for i in range(n_keys)] + ["starts", "ends"]
            schema = pa.schema([*zip(names, [*(k.type for k in kept), pa.list_(pa.int64()), pa.list_(pa.int64())], strict=True)])
            yield _emit(kept, gid, start, end, schema)

    return run


def _combine(n_keys: int):
    """Lists sorted by key to one list per key; a key that spans batches is carried as one merged list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.concat_batches([held, batch])
            keys = [batch.column(i) for i in range(n_keys)]
            raw, _ = segments.group_numbers(keys)
            at = segments.segment_starts(raw)
            row_gid = np.cumsum(np.isin(np.arange(batch.num_rows), at)) - 1
            start, row = segments.flatten(batch.column(n_keys))
            end, _ = segments.flatten(batch.column(n_keys + 1))
            gid, start, end = linear_merge(row_gid[row], start, end)
            out = _emit([k.take(pa.array(at)) for k in keys], gid, start, end, batch.schema)
            if out.num_rows > 1:
                yield out.slice(0, out.num_rows - 1)
            held = out.slice(out.num_rows - 1)
        if held is not None:
            yield held

    return run


def interval_lists(df: DataFrame, keys: list[str], start: str, end: str, *, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """The mergeable aggregate: columns k0.., blk, starts, ends with one sorted disjoint list per key and block.

    Rows with a missing bound or an end not after the start are no intervals.
    """
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"))
    rows = rows.where((F.col("e") > F.col("s")) & (F.col("s") > -STAMP_LIMIT) & (F.col("e") < STAMP_LIMIT))
    rows = rows.select(*names, floor_div(F.col("s"), block).alias(f"k{len(keys)}"), "s", "e")
    group = [*names, f"k{len(keys)}"]
    lists = [T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))]
    schema = T.StructType([*(rows.schema[g] for g in group), *lists])
    partial = rows.mapInArrow(_partial(len(group)), schema)
    # Lower tree level: the salt is taken from where a partial was made, so no group meets all of its partials at once.
    salted = partial.select(*group, F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("salt"), "starts", "ends")
    salted = salted.repartition(*group, "salt").sortWithinPartitions(*group, "salt")
    level = T.StructType([*(rows.schema[g] for g in group), T.StructField("salt", T.IntegerType()), *lists])
    lower = salted.mapInArrow(_combine(len(group) + 1), level).drop("salt")
    upper = lower.repartition(*group).sortWithinPartitions(*group).mapInArrow(_combine(len(group)), schema)
    return upper.withColumnRenamed(f"k{len(keys)}", "blk")


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str, *, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """Continuous periods of the intervals of each key, and the gaps between successive periods.

    Args: ``start`` and ``end`` are columns of whole numbers (any unit).

    Returns the key columns (names kept), ``piece`` ('period' or 'gap'), ``piece_start``, ``piece_end``.

    Defined cases: touching intervals join; copies change nothing; intervals with a null
    bound, or an end not after the start, or a bound beyond 2**61, are ignored; a null key is a
    key like any other; a key without a valid interval has no row; an empty table gives none.
    Other columns are not read, whatever their names.
    """
    names = [f"k{i}" for i in range(len(keys))]
    blocks = cut(interval_lists(df, keys, start, end, block=block, fan_in=fan_in))

    # Block summaries are small rows; only they meet in a window per key.
    order = Window.partitionBy(*names).orderBy("blk")
    sums = blocks.select(*names, "blk", F.element_at("ends", -1).alias("top"))
    sums = sums.select(*names, "blk", F.max("top").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("carry"), F.max("top").over(Window.partitionBy(*names)).alias("key_top"))
    carried = join_null_safe(blocks, sums, [*names, "blk"])

    # A start beyond everything before it opens a period; `before` is where the previous period ended.
    opens = carried.select(
        *names,
        "blk",
        "key_top",
        F.expr(
            "filter(transform(starts, (s, i) -> named_struct('s', s, 'before', "
            "CASE WHEN i = 0 THEN carry ELSE greatest(carry, ends[i - 1]) END)), x -> x.before IS NULL OR x.s > x.before)"
        ).alias("open"),
    ).where(F.size("open") > 0)
    heads = opens.select(*names, "blk", F.col("open")[0]["before"].alias("head"))
    ahead = heads.select(*names, "blk", F.lead("head").over(order).alias("next_before"))
    placed = join_null_safe(opens, ahead, [*names, "blk"])
    pieces = placed.select(
        *names,
        F.explode(
            F.expr(
                "concat("
                "transform(open, (x, i) -> named_struct('piece', 'period', 'piece_start', x.s, 'piece_end', coalesce(get(open, i + 1).before, next_before, key_top))),"
                "transform(filter(open, x -> x.before IS NOT NULL), x -> named_struct('piece', 'gap', 'piece_start', x.before, 'piece_end', x.s)))"
            )
        ).alias("p"),
    )
    return pieces.select(*(F.col(n).alias(k) for n, k in zip(names, keys, strict=True)), "p.piece", "p.piece_start", "p.piece_end")
