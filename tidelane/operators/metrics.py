"""Scores of predictions in long form (episode_idx, t, joint, predicted, ground_truth)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelane.operators.medians import grouped_percentiles
from tidelane.plans.joins import join_null_safe
from tidelane.plans.places import number_bin, with_places


def paired(rows: DataFrame) -> DataFrame:
    """Rows with a finite prediction and truth and their error; copies count once."""
    ok = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return rows.where(ok("predicted") & ok("ground_truth")).select("episode_idx", "t", "joint", "predicted", "ground_truth").distinct().withColumn("err", F.col("predicted") - F.col("ground_truth"))


def joint_metrics(pairs: DataFrame) -> DataFrame:
    """mse, mae, rmse and bias of each joint of an episode."""
    return pairs.groupBy("episode_idx", "joint").agg(F.count(F.lit(1)).alias("frames"), F.avg(F.col("err") * F.col("err")).alias("mse"), F.avg(F.abs("err")).alias("mae"), F.sqrt(F.avg(F.col("err") * F.col("err"))).alias("rmse"), F.avg("err").alias("bias"))


def episode_metrics(pairs: DataFrame) -> DataFrame:
    """mse, mae, rmse, largest error with its joint (the first in frame, then joint order), mean cosine of the frames' vectors, and smoothness.

    A frame's cosine is 0 where a vector's product of norms is at most 1e-8.  Smoothness is mean and population deviation of the
    length of the step between successive frames, 0 with one frame.  Per-frame sums come first, so the errors are read
    once; the step of a joint comes from its own row before, over (episode, joint).
    """
    e, p, g = F.col("err"), F.col("predicted"), F.col("ground_truth")
    base = pairs.groupBy("episode_idx").agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.max(F.abs(e)).alias("max_abs_error"), F.max(F.struct(F.abs(e).alias("e"), (-F.col("t")).alias("t"))).alias("at"))
    first = pairs.select("episode_idx", "t", "joint", F.abs(e).alias("a")).join(base.select("episode_idx", (-F.col("at.t")).alias("t"), F.col("at.e").alias("a")), ["episode_idx", "t", "a"]).groupBy("episode_idx").agg(F.min("joint").alias("max_abs_error_joint"))
    along = Window.partitionBy("episode_idx", "joint").orderBy("t")
    steps = pairs.withColumns({"dp": p - F.lag("predicted").over(along), "dg": g - F.lag("ground_truth").over(along)})
    frames = steps.groupBy("episode_idx", "t").agg(
        F.sum(p * g).alias("dot"),
        (F.sqrt(F.sum(p * p)) * F.sqrt(F.sum(g * g))).alias("norms"),
        F.sqrt(F.sum(F.col("dp") * F.col("dp"))).alias("sp"),
        F.sqrt(F.sum(F.col("dg") * F.col("dg"))).alias("sg"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    cosine = F.when(F.col("norms") > 1e-8, F.col("dot") / F.col("norms")).otherwise(0.0)
    smooth = frames.groupBy("episode_idx").agg(
        F.count(F.lit(1)).alias("num_frames"),
        F.avg(cosine).alias("cosine_similarity"),
        zero(F.avg("sp")).alias("pred_smoothness_mean"),
        zero(F.stddev_pop("sp")).alias("pred_smoothness_std"),
        zero(F.avg("sg")).alias("gt_smoothness_mean"),
        zero(F.stddev_pop("sg")).alias("gt_smoothness_std"),
    )
    return base.drop("at").join(first, "episode_idx").join(smooth, "episode_idx")


def summary(metrics: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Mean and population deviation of the episodes' metrics, over all (``by`` NULL) and by split."""
    each = [f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    return metrics.groupingSets([[], [F.col(by)]], F.col(by)).agg(F.count(F.lit(1)).alias("episodes"), *each, F.grouping(by).alias("over_all"))


def metrics_table(joints: DataFrame, names: list[str], metric: str = "mae") -> DataFrame:
    """One row per episode with a column ``mae_<joint>`` for each of ``names`` (the fixed joints of a rig)."""
    wide = joints.groupBy("episode_idx").pivot("joint", names).agg(F.first(metric))
    return wide.select("episode_idx", *(F.col(n).alias(f"{metric}_{n}") for n in names))


def joint_spread(joints: DataFrame, splits: DataFrame, metric: str = "mae") -> DataFrame:
    """Quartiles of the episodes' metric by split and joint, with the counts beyond 1.5 interquartile ranges."""
    rows = joints.join(splits, "episode_idx")
    quartiles = grouped_percentiles(rows, ["split", "joint"], metric, [0.25, 0.5, 0.75])
    q = join_null_safe(rows.groupBy("split", "joint").agg(F.count(F.lit(1)).alias("episodes")), quartiles, ["split", "joint"], "left")
    q = q.select("split", "joint", *(F.get("percentiles", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))), "episodes")
    m, width = F.col(metric), F.col("q75") - F.col("q25")
    out = rows.join(q, ["split", "joint"]).groupBy("split", "joint").agg(F.count_if((m < F.col("q25") - 1.5 * width) | (m > F.col("q75") + 1.5 * width)).alias("outliers"))
    return q.join(out, ["split", "joint"])


def batch_loss(rows: DataFrame, by: str, order: str, loss: str, size: int) -> DataFrame:
    """Unweighted mean of the batches' mean losses (the last batch may be smaller); ``order`` is a BIGINT column."""
    placed = with_places(rows.select(by, order, loss), [by], [F.col(order)], number_bin(order))
    batches = placed.withColumn("batch", F.call_function("div", "_place", F.lit(size).cast("bigint"))).groupBy(by, "batch").agg(F.avg(loss).alias("m"))
    return batches.groupBy(by).agg(F.avg("m").alias("loss"), F.count(F.lit(1)).alias("batches"))


def with_split(rows: DataFrame, splits: DataFrame, episode: str) -> DataFrame:
    """Rows with the first split (in the order train, val, test) that lists their episode, else ``manual``."""
    order = F.array_position(F.array(F.lit("train"), F.lit("val"), F.lit("test")), F.col("split"))
    first = splits.groupBy(F.col(episode)).agg(F.min_by("split", order).alias("split"))
    return rows.join(first, episode, "left").withColumn("split", F.coalesce("split", F.lit("manual")))
