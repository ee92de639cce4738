"""Shaping aligned frames: grid subsampling, look-ahead, strides, selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def grid_subsample(frames: DataFrame, *, by: str, ts: str, seq: str, rate: int, start: DataFrame | None = None) -> DataFrame:
    """The frames that a grid of ``rate`` per second, anchored at the first frame, emits.

    A frame is emitted if the next grid point isn't after it; then the grid moves on one point.  After a gap the grid lags and
    frames are emitted in a burst.  In closed form: frame i stands at grid cell g; the points passed by then are
    i + min(0, smallest g - j of the frames j up to i), and a frame is emitted when that number grows.
    ``start`` (by, first_ts) gives the anchor where the first processed frame isn't in ``frames``.
    """
    order = Window.partitionBy(by).orderBy(ts, seq)
    rows = frames.withColumn("_i", F.row_number().over(order))
    if start is None:
        rows = rows.withColumn("_t0", F.min(ts).over(Window.partitionBy(by)))
    else:
        rows = rows.join(start.select(by, F.col("first_ts").alias("_t0")), by)
    rows = rows.withColumn("_g", F.call_function("div", (F.col(ts) - F.col("_t0")) * rate, F.lit(1_000_000_000)) + 1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_k", F.col("_i") + F.least(F.lit(0), F.min(F.col("_g") - F.col("_i")).over(upto)))
    return rows.withColumn("_p", F.coalesce(F.lag("_k").over(order), F.lit(0))).where("_k > _p").drop("_i", "_t0", "_g", "_k", "_p")


def look_ahead(frames: DataFrame, *, by: list[str], order: list[str], state: str, steps: int) -> DataFrame:
    """Action of a frame = state ``steps`` frames later; the last frames of an episode have none and go."""
    if steps < 1:
        raise ValueError("steps must be positive")
    return frames.withColumn("action", F.lead(state, steps).over(Window.partitionBy(*by).orderBy(*order))).where(F.col("action").isNotNull())


def stride_rate(rows: DataFrame, *, by: str, ts: str, seq: str, rate: float) -> DataFrame:
    """Rows (with their place) thinned to about ``rate``: the detected rate is that of the upper median of the first 20 steps, every round(detected / rate)-th row stays.

    Fewer than four rows stay as they are; a half rounds to even.
    """
    order = Window.partitionBy(by).orderBy(ts, seq)
    placed = rows.select("*", (F.row_number().over(order) - 1).alias("place"), (F.col(ts) - F.lag(ts).over(order)).alias("_d"), F.count(F.lit(1)).over(Window.partitionBy(by)).alias("_n"))
    heads = placed.where("place BETWEEN 1 AND 20").groupBy(by).agg(F.array_sort(F.collect_list("_d")).alias("d")).select(by, F.get("d", F.floor(F.size("d") / 2).cast("int")).alias("_m"))
    strided = placed.join(heads, by, "left").withColumn("stride", F.when((F.col("_n") < 4) | (F.coalesce("_m", F.lit(0)) <= 0), 1).otherwise(F.greatest(F.lit(1), F.rint(1e9 / F.col("_m") / rate))).cast("bigint"))
    return strided.where(F.pmod("place", "stride") == 0).drop("_d", "_n", "_m")


def previous_sample(rows: DataFrame, *, by: list[str], order: list[str], value: str) -> DataFrame:
    """The command a player would publish: the sample before, 0 where there is none."""
    return rows.withColumn("command", F.coalesce(F.lag(value).over(Window.partitionBy(*by).orderBy(*order)), F.lit(0.0)))


def parse_positions(spec: str, count: int, *, base: int = 1) -> list[int]:
    """Places named by ``1,3:5,8`` (ends exclusive, ``base`` the first place), as sorted places from 0; out of bounds or malformed raises."""
    places: set[int] = set()
    for part in filter(None, (p.strip() for p in spec.split(","))):
        ends = part.split(":")
        if len(ends) > 2 or not all(e.strip().lstrip("-").isdigit() for e in ends):
            raise ValueError(f"not a place or range: {part!r}")
        low = int(ends[0]) - base
        high = int(ends[1]) - base if len(ends) == 2 else low + 1
        if low < 0 or high > count or high <= low:
            raise ValueError(f"out of range: {part!r} of {count}")
        places |= set(range(low, high))
    return sorted(places)


def episode_order(paths: DataFrame, path: str) -> DataFrame:
    """Place (from 0) of each file in the order of its path.  One window over file names, a metadata table."""
    return paths.select(path).distinct().withColumn("place", F.row_number().over(Window.orderBy(path)) - 1)


def skip_positions(paths: DataFrame, path: str, spec: str, count: int) -> DataFrame:
    """Files except those at the places of ``spec``."""
    return episode_order(paths, path).where(~F.col("place").isin(parse_positions(spec, count)))


def first_episodes(paths: DataFrame, path: str, most: int) -> DataFrame:
    return episode_order(paths, path).where(F.col("place") < most)


def drop_broken(frames: DataFrame, by: str, broken: str) -> DataFrame:
    """Frames of the episodes that have no broken one; a NULL mark is not broken."""
    bad = frames.where(broken).select(by).distinct()
    return frames.join(bad, by, "left_anti")


def smallest_rate(rates: DataFrame, session: str, rate: str) -> DataFrame:
    """Rate of a session: the smallest of its recordings', and whether they are mixed."""
    return rates.groupBy(session).agg(F.min(rate).alias("rate"), (F.min(rate) != F.max(rate)).alias("mixed"))


def first_resolution(images: DataFrame, camera: str, order: list[str]) -> DataFrame:
    """Size of the first image of each camera."""
    return images.groupBy(camera).agg(F.min_by(F.struct("width", "height"), F.struct(*order)).alias("s")).select(camera, "s.width", "s.height")
