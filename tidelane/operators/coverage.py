"""Quality of recorded topics: rates, gaps, coverage and severity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.functions import names
from tidelane.operators.medians import grouped_median

#: Order of severities.
SEVERITIES = ("pass", "warning", "critical")


@dataclass(frozen=True)
class QualityLimits:
    """What counts as a gap: streams by factor of their median step (and a floor), actions by an idle time; seconds."""

    stream_factor: float = 5.0
    stream_floor_s: float = 0.5
    action_idle_s: float = 1.0
    rate_tolerance: float = 0.15


def rank(severity: Column) -> Column:
    return F.array_position(F.array(*(F.lit(s) for s in SEVERITIES)), severity).cast("int") - 1


def severity_of(rank_: Column) -> Column:
    """The severity of a rank; pass for NULL."""
    return F.get(F.array(*(F.lit(s) for s in SEVERITIES)), F.coalesce(rank_, F.lit(0)))


def worst(severity: Column) -> Column:
    """Aggregate: the worst severity, pass if there is none."""
    return severity_of(F.max(rank(severity)))


def message_stamp(header_ns: Column, log_ns: Column) -> Column:
    """Header stamp, else log time."""
    return F.coalesce(header_ns, log_ns)


def record_stamp(publish_ns: Column, log_ns: Column) -> Column:
    """Publish time, else log time; a publish time of 0 is missing."""
    return F.coalesce(F.nullif(publish_ns, F.lit(0)), log_ns)


def topic_inventory(messages: DataFrame, *, episode: str = "episode", topic: str = "topic", ts: str = "ts_ns") -> DataFrame:
    """Count, first and last stamp of each topic, and its rate over the span of the whole episode (NULL below two messages or without a span)."""
    per = messages.groupBy(episode, topic).agg(F.count(F.lit(1)).alias("messages"), F.min(ts).alias("first_ns"), F.max(ts).alias("last_ns"))
    whole = Window.partitionBy(episode)
    span = (F.max("last_ns").over(whole) - F.min("first_ns").over(whole)) / 1e9
    return per.select("*", F.when((F.col("messages") >= 2) & (span > 0), (F.col("messages") - 1) / span).alias("file_rate"))


def with_empty_channels(counts: DataFrame, channels: DataFrame, on: list[str], count: str) -> DataFrame:
    """Counts of all channels of the summary; 0 where no message came, several channels of one topic added up."""
    listed = channels.select(*on).distinct()
    return listed.join(counts.groupBy(*on).agg(F.sum(count).alias(count)), on, "left").select(*on, F.coalesce(count, F.lit(0)).alias(count))


def topic_steps(messages: DataFrame) -> DataFrame:
    """Each message (episode, topic, role, ts_ns) with the step from the one before and the session's bounds (streams and actions only)."""
    along = Window.partitionBy("episode", "topic").orderBy("ts_ns")
    bounds = messages.where(F.col("role").isin("stream", "action")).groupBy("episode").agg(F.min("ts_ns").alias("session_start"), F.max("ts_ns").alias("session_end"))
    steps = messages.select("episode", "topic", "role", "ts_ns", F.lag("ts_ns").over(along).alias("prev_ns"))
    return steps.join(bounds, "episode")


def coverage_report(messages: DataFrame, limits: QualityLimits | None = None) -> DataFrame:
    """Report of each topic of an episode from messages (episode, topic, role, ts_ns).

    Returns episode, topic, role, messages, avg_fps, gaps (ARRAY<STRUCT<start_s, end_s, duration_s, kind>>, seconds from
    the session's start), total_gap_s, longest_gap_s, coverage, severity.

    A stream's gaps are steps above max(floor, factor x median step) and silences that long at its ends; any gap is critical, as
    is a single message.  An action's gaps are steps above the idle time; they are a warning.  Topics of another role
    pass with coverage 1.  Null stamps are left out; copies are steps of 0; an empty table gives no row.
    """
    limits = limits or QualityLimits()
    rows = messages.where(F.col("ts_ns").isNotNull() & F.col("episode").isNotNull())
    steps = topic_steps(rows)
    step_s = (F.col("ts_ns") - F.col("prev_ns")) / 1e9
    medians = grouped_median(steps.where("role = 'stream' AND prev_ns IS NOT NULL").withColumn("step_s", step_s), ["episode", "topic"], "step_s").withColumnRenamed("median", "median_step")
    ruled = steps.join(medians, ["episode", "topic"], "left")
    threshold = F.when(F.col("role") == "action", F.lit(limits.action_idle_s)).otherwise(F.greatest(F.lit(limits.stream_floor_s), limits.stream_factor * F.coalesce("median_step", F.lit(0.0))))
    since = lambda c: (c - F.col("session_start")) / 1e9
    kind = F.when(F.col("role") == "action", "idle").otherwise("dropframe")
    inner = F.when((F.col("prev_ns").isNotNull()) & (step_s > threshold), F.struct(since(F.col("prev_ns")).alias("start_s"), since(F.col("ts_ns")).alias("end_s"), step_s.alias("duration_s"), kind.alias("kind")))
    per = ruled.groupBy("episode", "topic", "role").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("ts_ns").alias("first"),
        F.max("ts_ns").alias("last"),
        F.first("session_start").alias("s0"),
        F.first("session_end").alias("s1"),
        F.first(threshold).alias("threshold"),
        F.array_sort(F.collect_list(inner)).alias("inner"),
    )
    lead, trail = (F.col("first") - F.col("s0")) / 1e9, (F.col("s1") - F.col("last")) / 1e9
    span = F.greatest((F.col("s1") - F.col("s0")) / 1e9, F.lit(1e-9))
    stream = (F.col("role") == "stream") & (F.col("messages") > 1)
    edge = lambda cond, a, b, d, k: F.when(stream & cond, F.array(F.struct(a.alias("start_s"), b.alias("end_s"), d.alias("duration_s"), F.lit(k).alias("kind")))).otherwise(F.expr("cast(array() as array<struct<start_s:double,end_s:double,duration_s:double,kind:string>>)"))
    front = edge(lead > F.col("threshold"), F.lit(0.0), lead, lead, "leading")
    back = edge(trail > F.col("threshold"), (F.col("last") - F.col("s0")) / 1e9, (F.col("s1") - F.col("s0")) / 1e9, trail, "trailing")
    monitored = F.col("role").isin("stream", "action")
    none = F.expr("cast(array() as array<struct<start_s:double,end_s:double,duration_s:double,kind:string>>)")
    gaps = F.when(monitored & (F.col("messages") > 1), F.concat(front, F.col("inner"), back)).otherwise(none)
    per = per.withColumns({"gaps": gaps, "span": span})
    lone = monitored & (F.col("messages") <= 1) & (F.col("role") == "stream")
    total = F.when(lone, F.col("span")).otherwise(F.aggregate("gaps", F.lit(0.0), lambda s, g: s + g["duration_s"]))
    longest = F.when(lone, F.col("span")).otherwise(F.coalesce(F.array_max(F.transform("gaps", lambda g: g["duration_s"])), F.lit(0.0)))
    severity = F.when(lone | ((F.col("role") == "stream") & (F.size("gaps") > 0)), "critical").when((F.col("role") == "action") & (F.size("gaps") > 0), "warning").otherwise("pass")
    rate = F.when((F.col("role") == "stream") & (F.col("messages") > 1) & (F.col("last") > F.col("first")), (F.col("messages") - 1) / ((F.col("last") - F.col("first")) / 1e9))
    return per.select(
        "episode",
        "topic",
        "role",
        "messages",
        rate.alias("avg_fps"),
        "gaps",
        total.alias("total_gap_s"),
        longest.alias("longest_gap_s"),
        F.when(lone, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - total / F.col("span"))).alias("coverage"),
        severity.alias("severity"),
    )


def classify(topics: DataFrame, topic: str, message_type: str) -> DataFrame:
    """Role, label and plain message type of each topic."""
    return topics.withColumns({"role": names.topic_role(F.col(message_type)), "label": names.topic_label(F.col(topic), F.col(message_type)), "plain_type": names.normalize_schema_name(F.col(message_type))})


def episode_severity(report: DataFrame, aborted: DataFrame | None = None) -> DataFrame:
    """Worst severity of each episode, whether it passed, and its flagged topics; an aborted episode (episode, status) is critical whatever its topics."""
    per = report.groupBy("episode").agg(worst(F.col("severity")).alias("severity"), F.count_if(F.col("severity") != "pass").alias("flagged"))
    if aborted is not None:
        bad = aborted.where("status = 'aborted'").select("episode").distinct().withColumn("stopped", F.lit(True))
        per = per.join(bad, "episode", "full_outer").select("episode", F.when(F.col("stopped"), "critical").otherwise(F.col("severity")).alias("severity"), F.coalesce("flagged", F.lit(0)).alias("flagged"))
    return per.withColumn("passed", F.col("severity") == "pass")


def report_documents(report: DataFrame, severity: DataFrame) -> DataFrame:
    """(episode, document): one JSON text per episode with its severity and its topics' reports in name order.  An episode has a handful of topics."""
    topics = report.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("topic", "role", "messages", "avg_fps", "coverage", "total_gap_s", "longest_gap_s", "severity", "gaps"))).alias("topics"))
    rows = severity.join(topics, "episode", "left")
    return rows.select("episode", F.to_json(F.struct("episode", "severity", "passed", F.coalesce("topics", F.array().cast(topics.schema["topics"].dataType)).alias("topics"))).alias("document"))


def markdown_lines(rows: list[dict]) -> list[str]:
    """A short report of episodes as Markdown table lines."""
    return ["| episode | severity | flagged |", "|---|---|---|", *(f"| {r['episode']} | {r['severity']} | {r['flagged']} |" for r in rows)]
