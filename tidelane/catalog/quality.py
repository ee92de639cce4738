"""Queries of the quality scan: topics, coverage, batch checks, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.catalog.tables import table
from tidelane.functions import names, rates
from tidelane.functions.integers import seconds_to_ns
from tidelane.operators import batch_checks, coverage, shaping


#: The cameras of a rig.
CAMERAS = ("waist", "chest", "wrist_l", "wrist_r")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages (episode, topic, message_type, ts_ns, seq) of frames and sensor readings; the wrist readings stand for the arms' commands."""
    frames = table(spark, folder, "frames").select(
        F.col("episode_idx").alias("episode"),
        F.concat(F.lit("/cam_"), F.col("camera"), F.lit("/image_raw/compressed")).alias("topic"),
        F.lit("sensor_msgs/msg/CompressedImage").alias("message_type"),
        coverage.record_stamp(F.greatest("stamp_ns", F.lit(0)), F.col("log_time_ns")).alias("ts_ns"),
        F.col("frame_id").alias("seq"),
    )
    stream = F.col("stream")
    arm = F.when(stream == "wrist_l", "l").when(stream == "wrist_r", "r")
    readings = (
        table(spark, folder, "sensor_readings")
        .where(F.col("ros_timestamp") > 0)
        .select(
            F.col("episode_idx").alias("episode"),
            F.when(stream == "joint_states", "/joint_states").when(arm.isNotNull(), F.concat(F.lit("/follower_"), arm, F.lit("_forward_position_controller/commands"))).otherwise(F.concat(F.lit("/debug/"), stream)).alias("topic"),
            F.when(stream == "joint_states", "ros2msg://sensor_msgs/JointState").when(arm.isNotNull(), "std_msgs/msg/Float64MultiArray").otherwise("std_msgs/String").alias("message_type"),
            seconds_to_ns(F.col("ros_timestamp")).alias("ts_ns"),
            F.col("reading_id").alias("seq"),
        )
    )
    return frames.unionByName(readings).distinct()


MESSAGES_SQL = """
msg AS (SELECT episode_idx AS episode, '/cam_' || camera || '/image_raw/compressed' AS topic, 'sensor_msgs/msg/CompressedImage' AS message_type,
          CASE WHEN stamp_ns > 0 THEN stamp_ns ELSE log_time_ns END AS ts_ns, frame_id AS seq FROM frames
        UNION SELECT episode_idx, CASE stream WHEN 'joint_states' THEN '/joint_states' WHEN 'wrist_l' THEN '/follower_l_forward_position_controller/commands'
          WHEN 'wrist_r' THEN '/follower_r_forward_position_controller/commands' ELSE '/debug/' || stream END,
          CASE stream WHEN 'joint_states' THEN 'ros2msg://sensor_msgs/JointState' WHEN 'wrist_l' THEN 'std_msgs/msg/Float64MultiArray' WHEN 'wrist_r' THEN 'std_msgs/msg/Float64MultiArray' ELSE 'std_msgs/String' END,
          CAST(round_even(ros_timestamp * 1e9, 0) AS BIGINT), reading_id FROM sensor_readings WHERE ros_timestamp > 0)
"""


def topic_inventory(spark: SparkSession, folder: str) -> DataFrame:
    out = coverage.topic_inventory(messages(spark, folder))
    return out.select("episode", "topic", "messages", ((F.col("last_ns") - F.col("first_ns")) / 1e9).alias("duration_s"), F.round("file_rate", 6).alias("file_rate"), rates.snap_rate(F.round("file_rate", 6)).alias("snapped"))


SNAP_SQL = """coalesce(list_min([{struct} for s in [15.0, 20.0, 24.0, 25.0, 30.0, 50.0, 60.0] if abs({x} - s) / s <= 0.15]).r, greatest(5.0, round_even({x} / 5, 0) * 5))"""
INVENTORY_SQL = (
    "WITH "
    + MESSAGES_SQL
    + """, t AS (SELECT episode, topic, count(*) AS messages, min(ts_ns) AS a, max(ts_ns) AS b FROM msg GROUP BY ALL),
w AS (SELECT *, (max(b) OVER (PARTITION BY episode) - min(a) OVER (PARTITION BY episode)) / 1e9 AS span FROM t),
r AS (SELECT *, round(CASE WHEN messages >= 2 AND span > 0 THEN (messages - 1) / span END, 6) AS file_rate FROM w)
SELECT episode, topic, messages, (b - a) / 1e9 AS duration_s, file_rate,
  CAST("""
    + SNAP_SQL.format(struct="{'d': abs(file_rate - s), 'r': s}", x="file_rate")
    + " AS INTEGER) AS snapped FROM r"
)


def classified_topics(spark: SparkSession, folder: str) -> DataFrame:
    topics = table(spark, folder, "topic_reports").select("topic", "message_type").distinct()
    return coverage.classify(topics, "topic", "message_type").select("topic", "message_type", F.col("role").alias("found_role"), F.col("label").alias("found_label"), "plain_type", names.camera_name(F.col("topic")).alias("camera"), names.source_camera_name(F.col("topic")).alias("head"))


CLASSIFIED_SQL = """
WITH t AS (SELECT DISTINCT topic, message_type, replace(replace(message_type, 'ros2msg://', ''), '/msg/', '/') AS k, replace(ltrim(topic, '/'), '/', '_') AS plain, ltrim(topic, '/') AS x FROM topic_reports)
SELECT topic, message_type, CASE WHEN k IN ('sensor_msgs/JointState', 'sensor_msgs/CompressedImage', 'sensor_msgs/Image') THEN 'stream' WHEN k = 'std_msgs/Float64MultiArray' THEN 'action' ELSE 'unclassified' END AS found_role,
  CASE WHEN k = 'sensor_msgs/JointState' THEN 'joint_states' WHEN k IN ('sensor_msgs/CompressedImage', 'sensor_msgs/Image') THEN coalesce(nullif(regexp_extract(topic, '^/cam_([^/]+)/image_raw', 1), ''), plain)
    WHEN k = 'std_msgs/Float64MultiArray' THEN 'action[' || CASE regexp_extract(topic, '^/follower_([lr])_.*controller/commands$', 1) WHEN 'l' THEN 'left' WHEN 'r' THEN 'right' ELSE plain END || ']' ELSE plain END AS found_label,
  k AS plain_type,
  coalesce(nullif(rtrim(replace(CASE WHEN x LIKE '%image_raw/compressed' THEN left(x, -20) WHEN x LIKE '%image/compressed' THEN left(x, -16) WHEN x LIKE '%compressed' THEN left(x, -10) WHEN x LIKE '%image_raw' THEN left(x, -9) WHEN x LIKE '%image' THEN left(x, -5) ELSE x END, '/', '_'), '_'), ''), 'camera') AS camera,
  split_part(x, '/', 1) AS head FROM t
"""


def _classed(spark: SparkSession, folder: str) -> DataFrame:
    return messages(spark, folder).select("episode", "topic", names.topic_role(F.col("message_type")).alias("role"), "ts_ns")


def _report(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.coverage_report(_classed(spark, folder))


REPORT_SQL = (
    MESSAGES_SQL
    + """, c AS (SELECT episode, topic, ts_ns, CASE WHEN message_type LIKE '%JointState' OR message_type LIKE '%Image' THEN 'stream' WHEN message_type LIKE '%MultiArray' THEN 'action' ELSE 'unclassified' END AS role FROM msg),
b AS (SELECT episode, min(ts_ns) AS s0, max(ts_ns) AS s1 FROM c WHERE role <> 'unclassified' GROUP BY 1),
d AS (SELECT *, lag(ts_ns) OVER (PARTITION BY episode, topic ORDER BY ts_ns) AS p FROM c),
md AS (SELECT episode, topic, median((ts_ns - p) / 1e9) AS m FROM d WHERE role = 'stream' AND p IS NOT NULL GROUP BY ALL),
x AS (SELECT d.*, s0, s1, CASE WHEN role = 'action' THEN 1.0 ELSE greatest(0.5, 5 * coalesce(m, 0)) END AS th FROM d JOIN b USING (episode) LEFT JOIN md USING (episode, topic)),
e AS (SELECT episode, topic, role, count(*) AS n, min(ts_ns) AS f, max(ts_ns) AS l, any_value(s0) AS s0, any_value(s1) AS s1, any_value(th) AS th FROM x GROUP BY 1, 2, 3),
g AS (SELECT episode, topic, (p - s0) / 1e9 AS start_s, (ts_ns - s0) / 1e9 AS end_s, (ts_ns - p) / 1e9 AS duration_s, CASE role WHEN 'action' THEN 'idle' ELSE 'dropframe' END AS kind FROM x WHERE role <> 'unclassified' AND (ts_ns - p) / 1e9 > th
      UNION ALL SELECT episode, topic, 0.0, (f - s0) / 1e9, (f - s0) / 1e9, 'leading' FROM e WHERE role = 'stream' AND n > 1 AND (f - s0) / 1e9 > th
      UNION ALL SELECT episode, topic, (l - s0) / 1e9, (s1 - s0) / 1e9, (s1 - l) / 1e9, 'trailing' FROM e WHERE role = 'stream' AND n > 1 AND (s1 - l) / 1e9 > th),
gs AS (SELECT episode, topic, count(*) AS gaps, sum(duration_s) AS total, max(duration_s) AS longest FROM g GROUP BY 1, 2),
rep AS (SELECT episode, topic, role, n AS messages, CASE WHEN role = 'stream' AND n > 1 AND l > f THEN (n - 1) / ((l - f) / 1e9) END AS avg_fps, coalesce(gaps, 0) AS gaps,
  CASE WHEN role = 'stream' AND n <= 1 THEN greatest((s1 - s0) / 1e9, 1e-9) ELSE coalesce(total, 0) END AS total_gap_s, CASE WHEN role = 'stream' AND n <= 1 THEN greatest((s1 - s0) / 1e9, 1e-9) ELSE coalesce(longest, 0) END AS longest_gap_s,
  CASE WHEN role = 'stream' AND n <= 1 THEN 0 ELSE greatest(0, 1 - coalesce(total, 0) / greatest((s1 - s0) / 1e9, 1e-9)) END AS coverage,
  CASE WHEN role = 'stream' AND (n <= 1 OR gaps > 0) THEN 'critical' WHEN role = 'action' AND gaps > 0 THEN 'warning' ELSE 'pass' END AS severity FROM e LEFT JOIN gs USING (episode, topic))
"""
)


def coverage_by_topic(spark: SparkSession, folder: str) -> DataFrame:
    r = _report(spark, folder)
    return r.select("episode", "topic", "role", "messages", F.round("avg_fps", 9).alias("avg_fps"), F.size("gaps").cast("bigint").alias("gaps"), F.round("total_gap_s", 9).alias("total_gap_s"), F.round("longest_gap_s", 9).alias("longest_gap_s"), F.round("coverage", 9).alias("coverage"), "severity")


def coverage_gaps(spark: SparkSession, folder: str) -> DataFrame:
    g = _report(spark, folder).select("episode", "topic", F.explode("gaps").alias("g"))
    return g.select("episode", "topic", F.round("g.start_s", 9).alias("start_s"), F.round("g.end_s", 9).alias("end_s"), F.round("g.duration_s", 9).alias("duration_s"), "g.kind")


def episode_severity(spark: SparkSession, folder: str) -> DataFrame:
    aborted = table(spark, folder, "annotations").select(F.col("episode_idx").alias("episode"), F.col("recorder_status").alias("status"))
    return coverage.episode_severity(_report(spark, folder), aborted)


SEVERITY_SQL = (
    "WITH "
    + REPORT_SQL
    + """, s AS (SELECT episode, max(CASE severity WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS r, count(*) FILTER (severity <> 'pass') AS flagged FROM rep GROUP BY 1),
a AS (SELECT DISTINCT episode_idx AS episode FROM annotations WHERE recorder_status = 'aborted')
SELECT episode, CASE WHEN a.episode IS NOT NULL THEN 'critical' ELSE ['pass', 'warning', 'critical'][r + 1] END AS severity, coalesce(flagged, 0) AS flagged, (a.episode IS NULL AND r = 0) AS passed FROM s FULL JOIN a USING (episode)
"""
)


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    reports = table(spark, folder, "topic_reports").select("report_id", "dataset", "episode", "topic", "label", "role", "avg_fps", "severity", "reason", "scanned_at")
    return batch_checks.latest_reports(reports, ["episode", "topic"], ["scanned_at", "report_id"])


LATEST_SQL = """lat AS (SELECT * FROM (SELECT DISTINCT report_id, dataset, episode, topic, label, role, avg_fps, severity, reason, scanned_at FROM topic_reports) QUALIFY row_number() OVER (PARTITION BY episode, topic ORDER BY scanned_at DESC, report_id DESC) = 1)"""


def rate_degradation(spark: SparkSession, folder: str) -> DataFrame:
    out = batch_checks.rate_degradation(_latest(spark, folder), group=["dataset", "topic", "label"])
    return out.select("dataset", "topic", "label", "episode", "avg_fps", F.round("others_median", 6).alias("others_median"), "degraded")


DEGRADATION_SQL = (
    "WITH "
    + LATEST_SQL
    + """, r AS (SELECT * FROM lat WHERE role = 'stream' AND avg_fps IS NOT NULL AND NOT isnan(avg_fps))
SELECT a.dataset, a.topic, a.label, a.episode, a.avg_fps, round(median(b.avg_fps), 6) AS others_median, a.avg_fps < 0.85 * median(b.avg_fps) AS degraded
FROM r a JOIN r b ON a.dataset = b.dataset AND a.topic = b.topic AND a.label = b.label AND a.episode <> b.episode GROUP BY a.dataset, a.topic, a.label, a.episode, a.avg_fps
"""
)


def rate_checked(spark: SparkSession, folder: str) -> DataFrame:
    return batch_checks.apply_rate_check(_latest(spark, folder), 0.15).groupBy("severity").agg(F.count(F.lit(1)).alias("reports"))


CHECKED_SQL = (
    "WITH "
    + LATEST_SQL
    + """, r AS (SELECT * FROM lat WHERE role = 'stream' AND avg_fps IS NOT NULL AND NOT isnan(avg_fps)),
k AS (SELECT topic, label, list_sort(list(avg_fps)) AS f, count(*) AS n FROM r GROUP BY ALL),
d AS (SELECT r.episode, r.topic, r.label, r.avg_fps, f, n, list_position(f, r.avg_fps) AS p FROM r JOIN k USING (topic, label) WHERE n > 1),
x AS (SELECT episode, topic, label FROM d WHERE avg_fps < 0.85 * ((CASE WHEN (n - 2) // 2 + 1 < p THEN f[(n - 2) // 2 + 1] ELSE f[(n - 2) // 2 + 2] END) + (CASE WHEN (n - 1) // 2 + 1 < p THEN f[(n - 1) // 2 + 1] ELSE f[(n - 1) // 2 + 2] END)) / 2)
SELECT CASE WHEN x.episode IS NOT NULL AND severity = 'pass' THEN 'warning' ELSE severity END AS severity, count(*) AS reports FROM lat LEFT JOIN x USING (episode, topic, label) GROUP BY 1
"""
)


def topic_presence(spark: SparkSession, folder: str) -> DataFrame:
    return batch_checks.missing_topics(_latest(spark, folder))


PRESENCE_SQL = (
    "WITH "
    + LATEST_SQL
    + """, m AS (SELECT DISTINCT episode, topic, role FROM lat WHERE role IN ('stream', 'action')), e AS (SELECT DISTINCT episode FROM lat),
q AS (SELECT topic, role FROM m GROUP BY ALL HAVING count(*) >= (SELECT count(*) FROM e) // 2 + 1 AND (SELECT count(*) FROM e) > 1)
SELECT e.episode, q.topic, q.role, 'critical' AS severity, 'missing_topic' AS reason_code FROM e CROSS JOIN q LEFT JOIN m ON m.episode = e.episode AND m.topic = q.topic AND m.role = q.role WHERE m.episode IS NULL
"""
)


def topic_health(spark: SparkSession, folder: str) -> DataFrame:
    out = batch_checks.topic_health(_latest(spark, folder))
    return out.select("label", "passes", "warnings", "criticals", "min_fps", F.round("median_fps", 6).alias("median_fps"), "max_fps")


HEALTH_SQL = (
    "WITH "
    + LATEST_SQL
    + """ SELECT label, count(*) FILTER (severity = 'pass') AS passes, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'critical') AS criticals,
min(avg_fps) FILTER (NOT isnan(avg_fps)) AS min_fps, round(median(avg_fps) FILTER (NOT isnan(avg_fps)), 6) AS median_fps, max(avg_fps) FILTER (NOT isnan(avg_fps)) AS max_fps FROM lat GROUP BY label"""
)


def flagged_groups(spark: SparkSession, folder: str) -> DataFrame:
    return batch_checks.flagged_groups(_latest(spark, folder))


FLAGGED_BODY = "WITH " + LATEST_SQL + ", f AS (SELECT label, severity, episode, min(reason) AS reason FROM lat WHERE severity <> 'pass' GROUP BY ALL)"
FLAGGED_SQL = FLAGGED_BODY + " SELECT label, severity, count(*) AS episodes, min(episode) AS first_episode, arg_min(reason, episode) AS first_reason FROM f GROUP BY ALL"


def flagged_episodes(spark: SparkSession, folder: str) -> DataFrame:
    return batch_checks.flagged_episodes(_latest(spark, folder))


def _episode_table(spark: SparkSession, folder: str) -> DataFrame:
    return _latest(spark, folder).groupBy("episode").agg(coverage.worst(F.col("severity")).alias("severity"))


EPISODES_SQL = LATEST_SQL + """, eps AS (SELECT episode, ['pass', 'warning', 'critical'][max(CASE severity WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) + 1] AS severity FROM lat GROUP BY 1)"""


def readiness(spark: SparkSession, folder: str) -> DataFrame:
    return batch_checks.readiness(_episode_table(spark, folder))


READINESS_SQL = "WITH " + EPISODES_SQL + """ SELECT count(*) AS episodes, count(*) FILTER (severity = 'pass') AS passes, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'critical') AS criticals,
CASE WHEN count(*) FILTER (severity = 'critical') > 0 THEN 'not_ready' WHEN count(*) FILTER (severity = 'warning') > 0 THEN 'ready_with_warnings' ELSE 'ready' END AS verdict FROM eps"""


def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return batch_checks.quality_gate(_episode_table(spark, folder), "warning")


def manual_skip(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "raw_reports").select("file_name")
    return shaping.episode_order(files, "file_name").where(~F.col("place").isin(shaping.parse_positions("1,3:5,8", 1 << 40))).select("file_name", F.col("place").cast("bigint").alias("place"))


def topic_names(spark: SparkSession, folder: str) -> DataFrame:
    """Topics of each dataset's episodes, the first three by name and how many more."""
    rows = table(spark, folder, "topic_reports").select("dataset", "topic").distinct()
    listed = rows.groupBy("dataset").agg(F.array_sort(F.collect_set("topic")).alias("t"))
    return listed.select("dataset", names.shown_names(F.col("t"), 3).alias("shown"))


NAMES_SQL = "WITH t AS (SELECT dataset, list_sort(list(DISTINCT topic)) AS t FROM topic_reports GROUP BY 1) SELECT dataset, array_to_string(t[1:3], ', ') || CASE WHEN len(t) > 3 THEN ' ... and ' || (len(t) - 3) || ' more' ELSE '' END AS shown FROM t"


def empty_channels(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of every camera of every episode, 0 where an episode has none of it."""
    frames = table(spark, folder, "frames").select("frame_id", "episode_idx", "camera").distinct()
    channels = frames.select("episode_idx").distinct().select("episode_idx", F.explode(F.array(*map(F.lit, CAMERAS))).alias("camera"))
    counts = frames.groupBy("episode_idx", "camera").agg(F.count(F.lit(1)).alias("messages"))
    return coverage.with_empty_channels(counts, channels, ["episode_idx", "camera"], "messages")


EMPTY_SQL = "WITH f AS (SELECT DISTINCT frame_id, episode_idx, camera FROM frames), e AS (SELECT DISTINCT episode_idx FROM f), c AS (SELECT unnest(['waist', 'chest', 'wrist_l', 'wrist_r']) AS camera) SELECT e.episode_idx, c.camera, count(f.frame_id) AS messages FROM e CROSS JOIN c LEFT JOIN f ON f.episode_idx = e.episode_idx AND f.camera = c.camera GROUP BY ALL"

QUERIES = {
    "topic_inventory": (topic_inventory, INVENTORY_SQL),
    "classify_roles": (classified_topics, CLASSIFIED_SQL),
    "coverage_by_topic": (coverage_by_topic, "WITH " + REPORT_SQL + " SELECT episode, topic, role, messages, round(avg_fps, 9) AS avg_fps, gaps, round(total_gap_s, 9) AS total_gap_s, round(longest_gap_s, 9) AS longest_gap_s, round(coverage, 9) AS coverage, severity FROM rep"),
    "coverage_gaps": (coverage_gaps, "WITH " + REPORT_SQL + " SELECT episode, topic, round(start_s, 9) AS start_s, round(end_s, 9) AS end_s, round(duration_s, 9) AS duration_s, kind FROM g"),
    "episode_severity": (episode_severity, SEVERITY_SQL),
    "rate_degradation_loo": (rate_degradation, DEGRADATION_SQL),
    "rate_check_severities": (rate_checked, CHECKED_SQL),
    "topic_presence_quorum": (topic_presence, PRESENCE_SQL),
    "topic_health": (topic_health, HEALTH_SQL),
    "flagged_groups": (flagged_groups, FLAGGED_SQL),
    "flagged_episodes": (flagged_episodes, FLAGGED_BODY + " SELECT * FROM f"),
    "readiness_summary": (readiness, READINESS_SQL),
    "quality_gate": (quality_gate, "WITH " + EPISODES_SQL + " SELECT * FROM eps WHERE severity <> 'critical'"),
    "manual_skip": (manual_skip, "SELECT file_name, place FROM (SELECT file_name, row_number() OVER (ORDER BY file_name) - 1 AS place FROM (SELECT DISTINCT file_name FROM raw_reports)) WHERE place NOT IN (0, 2, 3, 7)"),
    "shown_topic_names": (topic_names, NAMES_SQL),
    "empty_channels": (empty_channels, EMPTY_SQL),
}
