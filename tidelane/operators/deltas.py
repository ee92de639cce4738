"""Actions as differences, back again, and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.functions.arrays import add, subtract


def delta_to_state(action: Column, state: Column, kept: list[int] | None = None) -> Column:
    """Actions relative to the state at the observation; excluded places stay absolute."""
    return subtract(action, state, kept)


def delta_from_state(delta: Column, state: Column, kept: list[int] | None = None) -> Column:
    return add(delta, state, kept)


def sequential_deltas(rows: DataFrame, *, chunk: list[str], step: str, action: str, state: str) -> DataFrame:
    """Long rows (chunk, step, action, state): the first action relative to the state, each other to the one before."""
    before = F.lag(action).over(Window.partitionBy(*chunk).orderBy(step))
    return rows.withColumn("delta", F.col(action) - F.coalesce(before, F.col(state)))


def restored_actions(rows: DataFrame, *, chunk: list[str], step: str, delta: str, state: str, sequential: bool) -> DataFrame:
    """Absolute actions from deltas: the running sum on the chunk's first state, or each on its own state."""
    if not sequential:
        return rows.withColumn("action", F.col(delta) + F.col(state))
    along = Window.partitionBy(*chunk).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("action", F.first(state).over(along) + F.sum(delta).over(along))


def truth_deltas(rows: DataFrame, *, by: list[str], order: str, truth: str, observed: str, sequential: bool) -> DataFrame:
    """Ground truth in delta space: against the truth before (the first against what was observed), or always against what was observed."""
    base = F.coalesce(F.lag(truth).over(Window.partitionBy(*by).orderBy(order)), F.col(observed)) if sequential else F.col(observed)
    return rows.withColumn("delta", F.col(truth) - base)


def pooled_delta_stats(rows: DataFrame, *, episode: str, joint: str, t: str, action: str, state: str, steps: int, floor: float = 1e-6) -> DataFrame:
    """Statistics of action[t + k] - state[t] for k = 0..steps-1 inside an episode, pooled per joint.

    ``count`` is the number of original rows, ``n_samples`` that of pooled differences; the deviation is at least ``floor``.
    """
    along = Window.partitionBy(episode, joint).orderBy(t)
    deltas = rows.select(joint, F.col(state).alias("s"), F.array(*(F.lead(action, k).over(along) for k in range(steps))).alias("ahead"))
    long = deltas.select(joint, F.posexplode("ahead").alias("k", "a"), "s").where(F.col("a").isNotNull() & F.col("s").isNotNull()).select(joint, "k", (F.col("a") - F.col("s")).alias("d"))
    return long.groupBy(joint).agg(F.count_if(F.col("k") == 0).alias("count"), F.count(F.lit(1)).alias("n_samples"), F.avg("d").alias("mean"), F.greatest(F.stddev_pop("d"), F.lit(floor)).alias("std"), F.min("d").alias("min"), F.max("d").alias("max"))


def with_kept_stats(deltas: DataFrame, original: DataFrame, joint: str, kept: list[str]) -> DataFrame:
    """Delta statistics, but the original ones for the joints that stay absolute."""
    cols = [c for c in deltas.columns if c in original.columns]
    return deltas.where(~F.col(joint).isin(kept)).select(*cols).unionByName(original.where(F.col(joint).isin(kept)).select(*cols))


def monitor_step(rows: DataFrame, *, by: list[str], order: str, command: str, observed: str, sequential: bool) -> DataFrame:
    """What a monitor logs as the step of a command: from the command before, or from what was observed."""
    base = F.lag(command).over(Window.partitionBy(*by).orderBy(order)) if sequential else F.col(observed)
    return rows.withColumn("step", F.col(command) - base)
