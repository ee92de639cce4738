"""Checks of topic reports against those of the other episodes, and summaries of them.

Reports have the columns episode, topic, label, role, avg_fps, severity, reason (others are handed on where rows are).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.operators.coverage import rank, severity_of, worst
from tidelane.operators.medians import grouped_median, ranked_values
from tidelane.plans.joins import join_null_safe


def latest_reports(reports: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The last report of each key (largest ``by``); one of several equal ones."""
    others = [c for c in reports.columns if c not in keys]
    latest = reports.groupBy(*keys).agg(F.max(F.struct(*by, *(c for c in others if c not in by))).alias("r"))
    return latest.select(*keys, *(F.col(f"r.{c}").alias(c) for c in others))


def rate_degradation(reports: DataFrame, tolerance: float = 0.15, group: list[str] | None = None) -> DataFrame:
    """Streams whose rate is below (1 - tolerance) x the median of the *other* episodes' rates; pass becomes warning.

    One report per episode in each ``group`` (default topic and label).  The median without oneself is read from the ranks of
    all rates: others' k-th rate is the k-th or (k + 1)-th of all, by whether the own one is before it.  The four ranks come from
    counts by bin (:func:`ranked_values`), so a topic that every episode has is never ordered in one task.  A rate alone in its
    group is not degraded; NULL rates have no part; equal rates are one value with its count.
    """
    group = group or ["topic", "label"]
    rated = reports.where((F.col("role") == "stream") & F.col("avg_fps").isNotNull() & ~F.isnan("avg_fps")).select(*group, "episode", "avg_fps")
    # From 0, of n rates: the places at which the others' two middle ones may stand.
    places = F.array_distinct(F.transform(F.array(F.expr("(n - 2) div 2"), F.expr("(n - 2) div 2 + 1"), F.expr("(n - 1) div 2"), F.expr("(n - 1) div 2 + 1")), lambda k: F.least(k, F.col("n") - 1)))
    values = ranked_values(rated, group, "avg_fps", places)
    at = values.groupBy(*group).agg(F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("v")).where("n > 1")
    near = join_null_safe(rated, at, group)
    # The own rate stands before place k if it is below the value there; an equal one changes nothing.
    own = lambda k: F.when(F.col("avg_fps") <= F.element_at("v", k), F.element_at("v", k + 1)).otherwise(F.element_at("v", k))
    median = (own(F.expr("(n - 2) div 2")) + own(F.expr("(n - 1) div 2"))) / 2
    return near.select(*group, "episode", "avg_fps", median.alias("others_median"), (F.col("avg_fps") < (1 - tolerance) * median).alias("degraded"))


def apply_rate_check(reports: DataFrame, tolerance: float = 0.15) -> DataFrame:
    """Reports with degraded streams raised from pass to warning; others as they were, unreadable ones included."""
    slow = rate_degradation(reports, tolerance).where("degraded").select("topic", "label", "episode").withColumn("slow", F.lit(True))
    return reports.join(slow, ["topic", "label", "episode"], "left").withColumn("severity", F.when(F.col("slow") & (F.col("severity") == "pass"), "warning").otherwise(F.col("severity"))).drop("slow")


def missing_topics(reports: DataFrame, episodes: DataFrame | None = None) -> DataFrame:
    """A critical row for each (topic, role) that most episodes have (n div 2 + 1 of n) and an episode hasn't; none with fewer than two episodes."""
    monitored = reports.where(F.col("role").isin("stream", "action")).select("episode", "topic", "role").distinct()
    episodes = (reports if episodes is None else episodes).select("episode").where(F.col("episode").isNotNull()).distinct()
    total = episodes.agg(F.count(F.lit(1)).alias("n"))
    have = monitored.groupBy("topic", "role").agg(F.count(F.lit(1)).alias("have"))
    # Each topic of the quorum is in most episodes, so it holds at most twice the mean number of topics of an episode: one short array.
    usual = have.join(total).where((F.col("n") > 1) & (F.col("have") >= F.expr("n div 2 + 1"))).agg(F.collect_set(F.struct("topic", "role")).alias("usual"))
    own = monitored.groupBy("episode").agg(F.collect_set(F.struct("topic", "role")).alias("own"))
    lacking = episodes.join(own, "episode", "left").join(F.broadcast(usual)).select("episode", F.explode(F.array_except("usual", F.coalesce("own", F.array().cast(own.schema["own"].dataType)))).alias("x"))
    return lacking.select("episode", "x.topic", "x.role", F.lit("critical").alias("severity"), F.lit("missing_topic").alias("reason_code"))


def topic_health(reports: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts by severity and smallest, median and largest rate of each label."""
    of = lambda s: F.count_if(F.col("severity") == s)
    rate = F.when(~F.isnan("avg_fps"), F.col("avg_fps"))
    by = by or ["label"]
    counts = reports.groupBy(*by).agg(of("pass").alias("passes"), of("warning").alias("warnings"), of("critical").alias("criticals"), F.min(rate).alias("min_fps"), F.max(rate).alias("max_fps"))
    medians = grouped_median(reports.select(*by, rate.alias("_rate")), by, "_rate").withColumnRenamed("median", "median_fps")
    return join_null_safe(counts, medians, by, "left")


def flagged(reports: DataFrame) -> DataFrame:
    return reports.where(F.col("severity") != "pass")


def flagged_episodes(reports: DataFrame) -> DataFrame:
    """Each episode of each (label, severity) that isn't pass, with its first reason: one row each, all of them."""
    return flagged(reports).groupBy("label", "severity", "episode").agg(F.min("reason").alias("reason"))


def flagged_groups(reports: DataFrame) -> DataFrame:
    """For each (label, severity) that isn't pass: number of episodes, the first of them and its reason.

    The episodes themselves are rows of :func:`flagged_episodes`, never a list.
    """
    first = F.min(F.struct("episode", "reason"))
    per = flagged_episodes(reports).groupBy("label", "severity").agg(F.count(F.lit(1)).alias("episodes"), first.alias("_f"))
    return per.select("label", "severity", "episodes", F.col("_f.episode").alias("first_episode"), F.col("_f.reason").alias("first_reason"))


def readiness(episodes: DataFrame) -> DataFrame:
    """One row: episodes by severity and the verdict (unreadable counts as critical: severity NULL)."""
    s = F.coalesce(F.col("severity"), F.lit("critical"))
    n = lambda v: F.count_if(s == v)
    return episodes.agg(F.count(F.lit(1)).alias("episodes"), n("pass").alias("passes"), n("warning").alias("warnings"), n("critical").alias("criticals"), F.when(n("critical") > 0, "not_ready").when(n("warning") > 0, "ready_with_warnings").otherwise("ready").alias("verdict"))


def quality_gate(episodes: DataFrame, allowed: str = "pass") -> DataFrame:
    """The episodes (episode, severity) that are no worse than ``allowed``; without a severity an episode is critical."""
    return episodes.where(F.coalesce(rank(F.col("severity")), F.lit(2)) <= rank(F.lit(allowed)))


def severity_order(severity: Column) -> Column:
    """Sort key: worst first."""
    return -rank(severity)


__all__ = ["apply_rate_check", "flagged", "flagged_episodes", "flagged_groups", "latest_reports", "missing_topics", "quality_gate", "rate_degradation", "readiness", "severity_of", "severity_order", "topic_health", "worst"]
