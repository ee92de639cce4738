"""Folds that have no closed form: each step depends on what was published before.

A key's rows are folded in order by the same function in batch (grouped by key) and in a stream (with its state kept).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: State of a deadband before its first value.
START = (float("nan"), float("nan"), 0.0)


def deadband_step(state: tuple[float, float, float], value: float, threshold: float) -> tuple[tuple[float, float, float], float, bool]:
    """One value through the deadband: new state (last raw, last published, pending), what is published now, and whether it is new.

    The first value is published.  Steps add up in ``pending``; once they reach the threshold they are published and start at 0.
    """
    raw, shown, pending = state
    if np.isnan(shown):
        return (value, value, 0.0), value, True
    pending += value - raw
    if abs(pending) >= threshold:
        return (value, shown + pending, 0.0), shown + pending, True
    return (value, shown, pending), shown, False


def deadband(rows: DataFrame, *, by: list[str], order: str, value: str, threshold: float) -> DataFrame:
    """Each row (by, order, value) with the ``published`` value and whether it is ``fresh``.

    Rows of one key arrive sorted, batch by batch, and only the state of the key at hand is kept: a key of any length is
    streamed through, never gathered.  Null values leave the state as it is and publish what was published before.
    """
    n = len(by)
    source = rows.select(*by, order, value).repartition(*by).sortWithinPartitions(*by, order)
    schema = T.StructType([*source.schema.fields, T.StructField("published", T.DoubleType()), T.StructField("fresh", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, START
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(n)), strict=True))
            values = batch.column(n + 1).to_pylist()
            shown, fresh = [], []
            for k, x in zip(keys, values, strict=True):
                if k != key:
                    key, state = k, START
                if x is None:
                    out, new = (None if np.isnan(state[1]) else state[1]), False
                else:
                    state, out, new = deadband_step(state, float(x), threshold)
                shown.append(out)
                fresh.append(new)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shown, pa.float64()), pa.array(fresh)], names=schema.names)

    return source.mapInArrow(run, schema)
