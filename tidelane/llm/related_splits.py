"""Splits that keep related records together.

Records are related when they share a key (a session, a recording, an author), also through others.  Records
and keys are the nodes of a graph; its components get a split as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.plans.lineage import cut

#: A graph of colliding labels up to this many links is merged by one task (about 50 MB there); a larger one by the same search again.
SMALL_GRAPH = 500_000
#: Hexadecimal digits of the hash that make a bin: 4,096 bins, from which cumulative sizes are made.
BIN_DIGITS = 3


def _rank(node: Column) -> Column:
    """A total order of nodes that has nothing to do with their names."""
    return F.struct(F.xxhash64(node).alias("h"), node.alias("id"))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b: two strings) as (node, component), component being its smallest seed.

    Frontier breadth-first search from many seeds at once.  Seeds are the nodes whose hash is smaller than that
    of all their neighbours, so each component has one at least and each node is a few steps from one.
    A frontier joins the adjacency lists, which are hash-partitioned by node; a node takes the smallest label
    that reaches it.  Where two labels meet they collide, and the colliding labels form a smaller graph
    (no two seeds are neighbours), solved in one task if small, else by this search again.

    Null ends and self-links link nothing; copies and both directions of a link count once; without links
    the result is empty.  Hot nodes: degrees are only ever reduced by map-side aggregation, and the joins
    are plain equi-joins, which adaptive execution splits.
    """
    both = links.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")).where(F.col("a") != F.col("b"))
    edges = cut(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = edges.groupBy("a").agg(F.min(_rank(F.col("b"))).alias("m"))
    reached = cut(smallest.where(_rank(F.col("a")) < F.col("m")).select(F.col("a").alias("node"), F.col("a").alias("label")))
    frontier = reached
    while True:
        offers = frontier.join(edges, frontier["node"] == edges["a"]).groupBy("b").agg(F.min("label").alias("label"))
        frontier = cut(offers.join(reached, offers["b"] == reached["node"], "left_anti").select(F.col("b").alias("node"), "label"))
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    at_a = edges.where(F.col("a") < F.col("b")).join(reached.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
    at_both = at_a.join(reached.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
    collisions = cut(at_both.where(F.col("la") != F.col("lb")).select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
    size = collisions.count()
    if not size:
        return reached.withColumnRenamed("label", "component")
    merged = _merge_small(collisions) if size <= SMALL_GRAPH else components(collisions)
    # The smallest label names a component, whichever way the labels were merged.
    merged = merged.select(F.col("node").alias("label"), "component")
    if size > SMALL_GRAPH:
        merged = cut(merged)
        named = merged.groupBy("component").agg(F.min("label").alias("smallest"))
        merged = merged.join(named, "component").select("label", F.col("smallest").alias("component"))
    return reached.join(merged, "label", "left").select("node", F.coalesce("component", "label").alias("component"))


def _merge_small(links: DataFrame) -> DataFrame:
    """Components of a graph of bounded size in one executor's task, by labels that halve their way to the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        whole = pa.Table.from_batches(parts).combine_chunks()
        names, codes = np.unique(np.r_[whole["a"].to_numpy(), whole["b"].to_numpy()], return_inverse=True)
        a, b = np.split(codes, 2)
        root = np.arange(len(names))
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            root = root[root]
            if np.array_equal(before, root):
                break
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(names[root], pa.string())], names=["node", "component"])

    return links.coalesce(1).mapInArrow(run, "node string, component string")


def record_components(df: DataFrame, record: str, keys: list[Column]) -> DataFrame:
    """(record, component) for each non-null record of ``df``; records that share a non-null value of one of ``keys`` get one component.

    A record without any key is its own component.  The record comes back as text.
    """
    name = F.concat(F.lit("r:"), F.col(record).cast("string"))
    rows = df.select(name.alias("a"), *(F.concat(F.lit(f"k{i}:"), k.cast("string")).alias(f"k{i}") for i, k in enumerate(keys))).where(F.col("a").isNotNull())
    links = rows.select("a", F.explode(F.array(*(F.col(f"k{i}") for i in range(len(keys))))).alias("b")).where(F.col("b").isNotNull()).distinct()
    found = components(links)
    records = rows.select("a").distinct()
    joined = records.join(found, records["a"] == found["node"], "left")
    return joined.select(F.substring("a", 3, 1 << 30).alias("record"), F.coalesce("component", "a").alias("component"))


def assign_splits(members: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Give each component of ``members`` (record, component) one split so that the splits get about ``shares`` of the records.

    A component is called by its smallest record, and components stand in the order of that name's hash (MD5); the one
    that covers a point of the cumulative record count goes to the split that the middle of it falls in.  Returns
    (record, component, split).  A component larger than a share makes that share unreachable; nothing is ever divided.
    Records and components must be text without nulls.

    The cumulative count comes from the totals of 4,096 bins and an order inside each bin, so no task sees all components.
    """
    if not shares or min(shares.values()) < 0 or not sum(shares.values()):
        raise ValueError("shares must be non-negative and not all zero")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min("record").alias("name")).withColumn("h", F.md5("name"))
    sizes = sizes.withColumn("bin", F.conv(F.substring("h", 1, BIN_DIGITS), 16, 10).cast("int"))
    bins = sizes.groupBy("bin").agg(F.sum("size").alias("bin_size"))
    bins = bins.select("bin", F.coalesce(F.sum("bin_size").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("bin_size").over(Window.partitionBy()).alias("total"))
    inner = Window.partitionBy("bin").orderBy("h", "name").rowsBetween(Window.unboundedPreceding, 0)
    placed = sizes.join(F.broadcast(bins), "bin").withColumn("middle", (F.col("base") + F.sum("size").over(inner) - F.col("size") / 2) / F.col("total"))
    total, upto, split = sum(shares.values()), 0.0, None
    names = [n for n, s in shares.items() if s > 0]
    for n in names[:-1]:
        upto += shares[n] / total
        split = (F.when if split is None else split.when)(F.col("middle") < upto, F.lit(n))
    chosen = F.lit(names[-1]) if split is None else split.otherwise(F.lit(names[-1]))
    return members.join(placed.select("component", "name", chosen.alias("split")), "component").select("record", F.col("name").alias("component"), "split")


def broken_components(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Records of ``labels`` (record, split) whose component carries two or more splits.

    A labelled record that ``members`` doesn't have is its own component; null records and splits are left out.
    """
    given = labels.select(F.col("record").cast("string").alias("record"), "split").where(F.col("record").isNotNull() & F.col("split").isNotNull()).distinct()
    placed = given.join(members, "record", "left").select("record", "split", F.coalesce("component", F.concat(F.lit("r:"), F.col("record"))).alias("component"))
    placed = cut(placed)
    broken = placed.groupBy("component").agg(F.min("split").alias("x"), F.max("split").alias("y")).where("x <> y").select("component")
    return placed.join(broken, "component").select("record").distinct()
