"""NumPy helpers for work on many groups at once inside one Arrow batch.

All functions take whole batches as flat arrays with a group number per
element; none loops over groups, so a batch of ten thousand small groups costs
as much as one with a single large group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def group_numbers(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Dense group number per row for equal tuples of ``columns`` (nulls equal nulls), and each group's first row."""
    n = len(columns[0])
    gid = np.zeros(n, dtype=np.int64)
    for column in columns:
        codes = pc.dictionary_encode(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(codes):
            gid = gid * (codes.max() + 1) + codes
            gid = np.unique(gid, return_inverse=True)[1].astype(np.int64)
    _, first = np.unique(gid, return_index=True)
    return gid, first


def segment_starts(gid: np.ndarray) -> np.ndarray:
    """Positions where a new group starts in a grouped array."""
    if not len(gid):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])


def running_max(values: np.ndarray, gid: np.ndarray) -> np.ndarray:
    """Running maximum within each group of a grouped array of integers."""
    if not len(values):
        return values
    levels, rank = np.unique(values, return_inverse=True)
    _, dense = np.unique(gid, return_inverse=True)
    best = np.maximum.accumulate(dense.astype(np.int64) * len(levels) + rank)
    return levels[best % len(levels)]


def lists_of(values: np.ndarray, gid: np.ndarray, n_groups: int, kind: pa.DataType) -> pa.ListArray:
    """One list per group number 0..n_groups-1 from a grouped flat array."""
    offsets = np.searchsorted(gid, np.arange(n_groups + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def flatten(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row each comes from."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), counts)
