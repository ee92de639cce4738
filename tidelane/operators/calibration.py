"""The data side of camera calibration: coverage, residuals, gates, and the choice of views."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_VIEWS = 12


def coverage_grid(points: DataFrame, by: list[str], x: str, y: str, width: str, height: str, cells: int = 8) -> DataFrame:
    """Share of the image's grid cells that hold a point; points outside count for the border cells."""
    cell = lambda v, size: F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.floor(F.col(v) / F.col(size) * cells)))
    return points.groupBy(*by).agg((F.countDistinct(cell(x, width) * cells + cell(y, height)) / (cells * cells)).alias("coverage"))


def residual_rms(residuals: DataFrame, by: list[str], dx: str, dy: str, view: str | None = None) -> DataFrame:
    """Root mean square of residual lengths, over all views and (with ``view``) over even and odd ones apart."""
    square = F.col(dx) * F.col(dx) + F.col(dy) * F.col(dy)
    rms = lambda c: F.sqrt(F.avg(c))
    even = [] if view is None else [rms(F.when(F.pmod(F.col(view), F.lit(2)) == r, square)).alias(n) for r, n in ((0, "rms_even"), (1, "rms_odd"))]
    return residuals.groupBy(*by).agg(rms(square).alias("rms"), *even)


def view_counts(views: DataFrame, camera: str, least: int = MIN_VIEWS) -> DataFrame:
    """Views per camera, and whether they are enough to solve."""
    return views.groupBy(camera).agg(F.count(F.lit(1)).alias("views")).withColumn("enough", F.col("views") >= least)


def recommendation(report: DataFrame, least_coverage: float = 0.4, slack: float = 0.02) -> DataFrame:
    """``use_new`` where coverage is enough and the fit isn't worse than the factory's by more than ``slack``."""
    ok = (F.col("coverage") >= least_coverage) & (F.col("rms") <= F.col("factory_rms") + slack)
    return report.withColumn("recommendation", F.when(ok, "use_new").otherwise("keep_factory"))


def board_still(corners: DataFrame, by: list[str], tick: str, corner: str, x: str, y: str, most: float, least: int = 4) -> DataFrame:
    """Whether the median shift of the corners common with the tick before is at most ``most`` (and there are at least ``least``)."""
    along = Window.partitionBy(*by, corner).orderBy(tick)
    moved = corners.withColumns({"_t": F.lag(tick).over(along), "_d": F.sqrt(F.pow(F.col(x) - F.lag(x).over(along), 2) + F.pow(F.col(y) - F.lag(y).over(along), 2))})
    common = moved.where(F.col("_t") == F.col(tick) - 1)
    return common.groupBy(*by, tick).agg(F.count(F.lit(1)).alias("common"), F.median("_d").alias("shift")).withColumn("still", (F.col("common") >= least) & (F.col("shift") <= most))


def novel_views(views: DataFrame, by: str, order: str, vector: str, least: float) -> DataFrame:
    """Views that are at least ``least`` away from every view kept before: a greedy fold in order, so it can't be parallel inside a camera.

    A session saves some dozens of views; the fold sees one camera's candidates of one session.
    """
    def fold(part: pd.DataFrame) -> pd.DataFrame:
        kept: list[np.ndarray] = []
        flags = []
        part = part.sort_values(order)
        for v in part[vector]:
            x = np.asarray(v, float)
            new = all(len(k) != len(x) or np.linalg.norm(k - x) >= least for k in kept)
            flags.append(bool(new))
            if new:
                kept.append(x)
        return part[[by, order]].assign(novel=flags)

    rows = views.select(by, order, vector)
    return rows.groupBy(by).applyInPandas(fold, f"{by} {rows.schema[by].dataType.simpleString()}, {order} {rows.schema[order].dataType.simpleString()}, novel boolean")


def calibration_document(camera: str, matrix: list[list[float]], size: tuple[int, int], distortion: list[float] | None = None) -> str:
    """Calibration of an undistorted camera as JSON: new matrix, zero distortion unless given, size."""
    return json.dumps({"camera": camera, "camera_matrix": matrix, "dist_coeffs": distortion or [0.0] * 5, "width": size[0], "height": size[1]}, sort_keys=True)


def report_lines(rows: Iterator[dict]) -> list[str]:
    """The report as Markdown table lines."""
    out = ["| camera | views | coverage | factory | new | recommendation |", "|---|---|---|---|---|---|"]
    return out + [f"| {r['camera']} | {r['views']} | {r['coverage']:.0%} | {r['factory_rms']:.3f} | {r['rms']:.3f} | {r['recommendation']} |" for r in rows]
