"""Integrity contracts of datasets: indices, segments, and tables that must cover each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def index_contract(rows: DataFrame, episode: str, frame: str) -> DataFrame:
    """Per episode: rows, whether its frame numbers are 0..n-1 without repeats, and the first frame that isn't where it should be.

    Contiguity needs no order: n distinct numbers from 0 to n - 1 are contiguous.
    """
    per = rows.groupBy(episode).agg(F.count(F.lit(1)).alias("n"), F.min(frame).alias("low"), F.max(frame).alias("high"), F.countDistinct(frame).alias("distinct"))
    return per.select(episode, F.col("n").alias("frames"), ((F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("distinct") == F.col("n"))).alias("contiguous"), (F.col("high") + 1 - F.col("distinct")).alias("lost"), (F.col("n") - F.col("distinct")).alias("repeated"))


def episode_ranges(lengths: DataFrame, episode: str, length: str) -> DataFrame:
    """First and last row number of each episode when they follow one another; a window over episodes, a metadata table."""
    upto = F.sum(length).over(Window.orderBy(episode).rowsBetween(Window.unboundedPreceding, 0))
    return lengths.select(episode, (upto - F.col(length)).alias("from_index"), upto.alias("to_index"))


def segment_faults(segments: DataFrame, by: str, start: str, end: str, rate: float, tolerance: float = 1e-3) -> DataFrame:
    """Segments of a file that are off the frame grid, overlap the one before, or leave a gap to it."""
    order = Window.partitionBy(by).orderBy(start, end)
    a, b = F.col(start) * rate, F.col(end) * rate
    off = (F.abs(a - F.rint(a)) > tolerance) | (F.abs(b - F.rint(b)) > tolerance)
    before = F.lag(F.rint(b)).over(order)
    fault = F.when(off, "off_grid").when(F.rint(a) < before, "overlap").when(F.rint(a) > before, "gap")
    return segments.select(by, start, end, fault.alias("fault")).where(F.col("fault").isNotNull())


def assign_segments(points: DataFrame, segments: DataFrame, by: str, at: str, start: str, end: str) -> DataFrame:
    """Each point with the number of segments [start, end) of its file that hold it (contract: exactly one)."""
    hits = points.join(segments.select(F.col(by).alias("_b"), F.col(start).alias("_s"), F.col(end).alias("_e")), (F.col(by) == F.col("_b")) & (F.col(at) >= F.col("_s")) & (F.col(at) < F.col("_e")), "left")
    return hits.groupBy(by, at).agg(F.count("_s").alias("segments"))


def coverage_faults(wanted: DataFrame, have: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only: 'missing' (wanted, not there) or 'unknown' (there, not wanted)."""
    w, h = wanted.select(*keys).distinct(), have.select(*keys).distinct()
    return w.join(h, keys, "left_anti").withColumn("fault", F.lit("missing")).unionByName(h.join(w, keys, "left_anti").withColumn("fault", F.lit("unknown")))
