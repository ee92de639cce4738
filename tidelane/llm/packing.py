"""Filling containers of fixed capacity with items by vector best-fit.

Each item has three sizes, tokens, one document and attention cost (tokens squared), and each container a capacity in
each.  Items go, largest first, into the open container that keeps every capacity and leaves the smallest weighted
norm of what remains.  An item is divided only if it is longer than a container.

Items are spread by hash over groups of about ``ITEMS`` items, and each group is packed on its own.  Containers a group
leaves short of ``full`` are opened again and their items spread anew over groups of that same size, level by level, as
long as that saves containers.  No level has a group larger than the first level's, however much is left over.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.plans.lineage import cut

#: Items a group has on average: a task's work and memory.
ITEMS = 1 << 13
#: Most tasks of a level; beyond, a task packs several groups one after the other.
MOST_TASKS = 20_000
#: Share of its containers that a level must save for another level to follow.
GAIN = 0.02


@dataclass(frozen=True)
class Container:
    """Capacities of a container, and the weights of what remains of each in the choice of one."""

    tokens: int = 4096
    documents: int = 512
    attention: float = 4096.0**2
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    #: Share of the tokens from which a container counts as full and isn't opened again.
    full: float = 0.995

    def __post_init__(self) -> None:
        if self.tokens < 1 or self.documents < 1 or self.attention < float(self.tokens) ** 2:
            raise ValueError("a container must hold one item of its token capacity")


def best_fit(sizes: np.ndarray, box: Container) -> np.ndarray:
    """Container number of each item; ``sizes`` must not exceed the token capacity.

    Containers too full for the item at hand sleep in a heap by what they have left; as items only get smaller,
    each is woken once it fits again, and an item looks only at containers with room for its tokens.
    """
    place = np.zeros(len(sizes), np.int64)
    scale = np.array(box.weights) / np.array([box.tokens, box.documents, box.attention], float) ** 2
    # What remains of each awake container, and its number; the first ``awake`` places are in use.
    tokens, documents, attention = (np.zeros(len(sizes)) for _ in range(3))
    number = np.zeros(len(sizes), np.int64)
    awake, opened = 0, 0
    asleep: list[tuple[float, int, float, float]] = []
    for item in np.argsort(-sizes, kind="stable"):
        size = float(sizes[item])
        cost = size * size
        while asleep and -asleep[0][0] >= size:
            left, n, d, a = heapq.heappop(asleep)
            tokens[awake], documents[awake], attention[awake], number[awake] = -left, d, a, n
            awake += 1
        at = -1
        if awake:
            t, d, a = tokens[:awake] - size, documents[:awake] - 1, attention[:awake] - cost
            norm = scale[0] * t * t + scale[1] * d * d + scale[2] * a * a
            norm[(t < 0) | (a < 0)] = np.inf
            at = int(norm.argmin())
            if norm[at] == np.inf:
                at = -1
        if at < 0:
            at = awake
            tokens[at], documents[at], attention[at], number[at] = box.tokens, box.documents, box.attention, opened
            awake, opened = awake + 1, opened + 1
        tokens[at] -= size
        documents[at] -= 1
        attention[at] -= cost
        place[item] = number[at]
        # A container without room for another item of this size sleeps (or is done with, if no document fits).
        if tokens[at] < size or documents[at] < 1:
            if documents[at] >= 1:
                heapq.heappush(asleep, (-tokens[at], int(number[at]), documents[at], attention[at]))
            awake -= 1
            for column in (tokens, documents, attention, number):
                column[at] = column[awake]
    return place


def _pack_groups(box: Container, level: int) -> object:
    """Rows sorted by group to packed rows: bin, and whether it is full."""

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        group = batch.column(0)[0].as_py()
        size = batch.column(3).to_numpy()
        # An order of the items that doesn't hang on how rows arrived.
        order = np.lexsort((batch.column(2).to_numpy(), np.array(batch.column(1).to_pylist(), dtype=str)))
        place = np.empty(len(size), np.int64)
        place[order] = best_fit(size[order], box)
        filled = np.bincount(place, size)
        full = (filled >= box.full * box.tokens)[place]
        names = np.char.add(f"{level}-{group}-", place.astype(str)) if len(place) else np.zeros(0, str)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(full)], names=[*batch.schema.names, "bin", "full"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            group = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(group)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and held[-1].column(0)[0].as_py() != group[a]:
                    yield pack(pa.concat_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield pack(pa.concat_batches(held))

    return run


def pack(items: DataFrame, *, item: str, tokens: str, box: Container | None = None) -> DataFrame:
    """Pack each item: (item, part, first_token, tokens, bin).  ``part`` counts the pieces of an item longer than a container.

    Defined cases: null or negative sizes count as 0 and are packed like others; null items are items; exact
    copies of (item, tokens) count once; an empty table gives no row.  No container exceeds a capacity, no item
    of at most the token capacity is divided, and every token of every item is in one container.
    """
    box = box or Container()
    rows = items.select(F.col(item).cast("string").alias("item"), F.greatest(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)), F.lit(0)).alias("size")).distinct()
    whole = F.lit(box.tokens).cast("bigint")
    parts = F.greatest(F.call_function("div", F.col("size") + whole - 1, whole), F.lit(1))
    pieces = cut(rows.select("item", F.posexplode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part", "_n"), F.col("size").alias("all")).select("item", "part", F.least(whole, F.col("all") - F.col("_n") * whole).alias("size"), F.xxhash64("item", "part", "all").alias("h")))
    schema = T.StructType([T.StructField("g", T.LongType()), T.StructField("item", T.StringType()), T.StructField("part", T.IntegerType()), T.StructField("size", T.LongType()), T.StructField("h", T.LongType()), T.StructField("bin", T.StringType()), T.StructField("full", T.BooleanType())])
    packed, todo, level, before = None, pieces, 0, math.inf
    count = pieces.count()
    while True:
        groups = max(1, math.ceil(count / ITEMS))
        spread = todo.select(F.pmod(F.xxhash64("h", F.lit(level)), F.lit(groups)).alias("g"), "item", "part", "size", "h")
        tasks = min(groups, MOST_TASKS)
        by_task = spread.repartitionById(tasks, F.pmod("g", F.lit(tasks)).cast("int")).sortWithinPartitions("g")
        done = cut(by_task.mapInArrow(_pack_groups(box, level), schema))
        each = done.groupBy("bin").agg(F.max("full").alias("full"), F.count(F.lit(1)).alias("n"))
        now = each.agg(F.count(F.lit(1)).alias("bins"), F.count_if(~F.col("full")).alias("open"), F.coalesce(F.sum(F.when(~F.col("full"), F.col("n"))), F.lit(0)).alias("left")).first()
        # One group has seen all there is; and a level that saved next to nothing is the last.
        if groups == 1 or not now["left"] or now["bins"] > before * (1 - GAIN):
            last = done if now["bins"] <= before else todo
            packed = last if packed is None else packed.unionByName(last)
            break
        full = done.where("full")
        packed = full if packed is None else packed.unionByName(full)
        todo, count, level, before = done.where("not full"), now["left"], level + 1, now["open"]
    return packed.select(F.col("item").alias(item), "part", (F.col("part") * whole).alias("first_token"), F.col("size").alias("tokens"), "bin")


def fill_report(packed: DataFrame, box: Container | None = None) -> DataFrame:
    """One row: containers, pieces, tokens, share of the capacity that is filled, largest fill and document count."""
    box = box or Container()
    bins = packed.groupBy("bin").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    return bins.agg(F.count(F.lit(1)).alias("containers"), F.sum("n").alias("pieces"), F.sum("t").alias("tokens"), (F.sum("t") / (F.count(F.lit(1)) * box.tokens)).alias("filled"), F.max("t").alias("most_tokens"), F.max("n").alias("most_documents"))
