"""Queries of the general problems: intervals, drifting schemas, regular grids, faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.catalog.tables import table
from tidelane.functions.integers import floor_div
from tidelane.operators.intervals import merge_intervals
from tidelane.operators.regular_grid import regular_grid
from tidelane.operators.schema_drift import damaged, ingest, promote, schema_changes
from tidelane.operators.signal_faults import flag_faults

#: The schema that report lines are read into.
REPORT_SCHEMA = {
    "episode": "string",
    "topic": "string",
    "label": "string",
    "role": "string",
    "codebase_version": "string",
    "message_type": "string",
    "message_count": "bigint",
    "avg_fps": "double",
    "coverage_ratio": "double",
    "total_gap_s": "double",
    "longest_gap_s": "double",
    "severity": "string",
    "reason": "string",
    "ok": "boolean",
}
FRAME_SLOT_NS = 500_000_000
HOUR_S = 3600


def _milliseconds(seconds: object) -> object:
    ms = F.rint(seconds * 1000)
    return F.when(F.abs(ms) < 1e15, ms).cast("bigint")


def quiet_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Quiet periods of each topic of an episode, and the gaps between them."""
    gaps = table(spark, folder, "topic_reports").select("episode", "topic", F.explode("gaps").alias("g"))
    spans = gaps.select("episode", "topic", _milliseconds(F.col("g.start_s")).alias("start"), _milliseconds(F.col("g.end_s")).alias("end"))
    pieces = merge_intervals(spans, ["episode", "topic"], "start", "end")
    return pieces.select("episode", "topic", "piece", F.col("piece_start").alias("start_ms"), F.col("piece_end").alias("end_ms"))


QUIET_SQL = """
WITH i AS (SELECT episode, topic, CAST(round_even(g.start_s * 1000, 0) AS BIGINT) s, CAST(round_even(g.end_s * 1000, 0) AS BIGINT) e
           FROM (SELECT episode, topic, unnest(gaps) g FROM topic_reports) WHERE g.start_s IS NOT NULL AND g.end_s IS NOT NULL),
v AS (SELECT DISTINCT * FROM i WHERE e > s),
r AS (SELECT *, max(e) OVER (PARTITION BY episode, topic ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach FROM v),
p AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY episode, topic ORDER BY s, e ROWS UNBOUNDED PRECEDING) n FROM r),
q AS (SELECT episode, topic, n, min(s) s, max(e) e FROM p GROUP BY 1, 2, 3),
g AS (SELECT episode, topic, 'gap' piece, lag(e) OVER (PARTITION BY episode, topic ORDER BY n) start_ms, s end_ms FROM q)
SELECT episode, topic, 'period' piece, s start_ms, e end_ms FROM q UNION ALL SELECT * FROM g WHERE start_ms IS NOT NULL
"""


def report_records(spark: SparkSession, folder: str) -> DataFrame:
    """Report lines read into one schema, with what doesn't fit kept in the rescue column."""
    return ingest(table(spark, folder, "raw_reports"), "payload", ["raw_id", "feed", "file_no", "line_no"], REPORT_SCHEMA)


def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    """Each field added, removed, renamed or retyped from file to file."""
    raw = table(spark, folder, "raw_reports")
    return schema_changes(raw, "payload", REPORT_SCHEMA, feed="feed", file_no="file_no", pair_keys=["episode", "topic"])


SCHEMA_SQL = """
WITH rec AS (SELECT DISTINCT feed, file_no, line_no, payload FROM raw_reports
             WHERE CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT' ELSE false END),
f AS (SELECT feed, file_no, payload, unnest(json_keys(payload)) AS name FROM rec),
v AS (SELECT *, json_extract(payload, '$."' || name || '"') AS val, json_extract_string(payload, '$.episode') || chr(31) || json_extract_string(payload, '$.topic') AS pair FROM f),
k AS (SELECT feed, file_no, name, pair, CAST(val AS VARCHAR) AS val,
      CASE json_type(val) WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN NULL ELSE 'number' END AS kind FROM v),
has AS (SELECT feed, file_no, name, list_sort(list(DISTINCT kind) FILTER (kind IS NOT NULL)) AS kinds FROM k GROUP BY ALL),
files AS (SELECT DISTINCT feed, file_no FROM raw_reports),
step AS (SELECT feed, file_no, lag(file_no) OVER (PARTITION BY feed ORDER BY file_no) AS prev FROM files QUALIFY prev IS NOT NULL),
now AS (SELECT s.feed, s.file_no, s.prev, h.name, h.kinds FROM step s JOIN has h ON h.feed = s.feed AND h.file_no = s.file_no),
was AS (SELECT s.feed, s.file_no, s.prev, h.name, h.kinds FROM step s JOIN has h ON h.feed = s.feed AND h.file_no = s.prev),
gone AS (SELECT w.* FROM was w LEFT JOIN now n USING (feed, file_no, name) WHERE n.name IS NULL),
came AS (SELECT n.* FROM now n LEFT JOIN was w USING (feed, file_no, name) WHERE w.name IS NULL),
old_v AS (SELECT g.feed, g.file_no, g.name, k.pair, min(k.val) lo, max(k.val) hi FROM gone g JOIN k ON k.feed = g.feed AND k.file_no = g.prev AND k.name = g.name WHERE k.kind IS NOT NULL GROUP BY ALL),
new_v AS (SELECT c.feed, c.file_no, c.name, k.pair, min(k.val) lo, max(k.val) hi FROM came c JOIN k ON k.feed = c.feed AND k.file_no = c.file_no AND k.name = c.name WHERE k.kind IS NOT NULL GROUP BY ALL),
ren AS (SELECT o.feed, o.file_no, o.name AS old_name, n.name AS new_name FROM old_v o JOIN new_v n ON o.feed = n.feed AND o.file_no = n.file_no AND o.pair = n.pair
        GROUP BY ALL HAVING bool_and(o.lo = n.lo AND o.hi = n.hi))
SELECT feed, file_no, 'renamed' AS change_kind, old_name AS field, new_name AS new_field FROM ren
UNION ALL SELECT feed, file_no, 'removed', name, name FROM gone WHERE (feed, file_no, name) NOT IN (SELECT (feed, file_no, old_name) FROM ren)
UNION ALL SELECT feed, file_no, 'added', name, name FROM came WHERE (feed, file_no, name) NOT IN (SELECT (feed, file_no, new_name) FROM ren)
UNION ALL SELECT n.feed, n.file_no, 'retyped', n.name, n.name FROM now n JOIN was w USING (feed, file_no, name) WHERE len(n.kinds) > 0 AND len(w.kinds) > 0 AND n.kinds <> w.kinds
"""


def _frame_slots(spark: SparkSession, folder: str) -> DataFrame:
    frames = table(spark, folder, "frames").where(F.col("stamp_ns") > 0)
    series = F.concat(F.col("episode_idx").cast("string"), F.lit("|"), F.col("camera"))
    return frames.select(series.alias("series"), floor_div(F.col("stamp_ns"), FRAME_SLOT_NS).alias("slot"), F.col("stamp_ns").alias("at"), F.lit(None).cast("double").alias("reading"))


def _report_slots(spark: SparkSession, folder: str) -> DataFrame:
    reports = table(spark, folder, "topic_reports").where((F.col("avg_fps") > 0) & ~F.isnan("avg_fps"))
    seconds = F.unix_micros(F.col("scanned_at").cast("timestamp"))
    return reports.select(F.concat(F.col("dataset"), F.lit("|"), F.col("topic")).alias("series"), floor_div(seconds, HOUR_S * 1_000_000).alias("slot"), seconds.alias("at"), F.col("avg_fps").alias("reading"))


def regular_series(spark: SparkSession, folder: str) -> DataFrame:
    """Frames in half-second slots and report rates in hours, every slot with its reading, filled or missing."""
    slots = _frame_slots(spark, folder).withColumn("series_kind", F.lit("frame")).unionByName(_report_slots(spark, folder).withColumn("series_kind", F.lit("report")))
    return regular_grid(slots, ["series_kind", "series"], "slot", value="reading", order="at", max_gap=6)


def silent_slots(spark: SparkSession, folder: str) -> DataFrame:
    """Slots without a reading between the first and last slot of a series with one."""
    return regular_series(spark, folder).where(F.col("status") != "read").select("series_kind", "series", "slot")


SILENT_SQL = """
WITH s AS (SELECT 'frame' series_kind, episode_idx || '|' || camera series, stamp_ns // 500000000 slot FROM frames WHERE stamp_ns > 0
           UNION SELECT 'report', dataset || '|' || topic, CAST(floor(epoch_us(scanned_at) / 3600000000) AS BIGINT) FROM topic_reports WHERE avg_fps > 0 AND NOT isnan(avg_fps)),
n AS (SELECT *, lead(slot) OVER (PARTITION BY series_kind, series ORDER BY slot) nxt FROM s)
SELECT series_kind, series, unnest(range(slot + 1, nxt)) AS slot FROM n WHERE nxt > slot + 1
"""


def joint_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Impossible, spiking and stuck joint measurements with their probability."""
    limits = table(spark, folder, "joint_limits").select(F.col("joint").alias("key"), F.col("lower_limit").alias("lower"), F.col("upper_limit").alias("upper"))
    return flag_faults(table(spark, folder, "predictions"), ["episode_idx", "joint"], "t", ["obs_state", "ground_truth"], limits=limits, limit_key="joint")


def faulty_readings(spark: SparkSession, folder: str) -> DataFrame:
    return joint_faults(spark, folder).select("episode_idx", "t", "joint", "field")


FAULTS_SQL = """
WITH r AS (SELECT episode_idx, joint, t, 'obs_state' AS field, min(obs_state) AS v FROM predictions WHERE obs_state IS NOT NULL GROUP BY ALL
           UNION ALL SELECT episode_idx, joint, t, 'ground_truth', min(ground_truth) FROM predictions WHERE ground_truth IS NOT NULL GROUP BY ALL),
x AS (SELECT r.*, isnan(v) OR isinf(v) OR coalesce(v < lower_limit, false) OR coalesce(v > upper_limit, false) AS bad FROM r LEFT JOIN joint_limits USING (joint)),
p AS (SELECT *, lag(v) OVER w p1, lag(v, 2) OVER w p2, lag(v, 3) OVER w p3, lead(v) OVER w n1, lead(v, 2) OVER w n2, lead(v, 3) OVER w n3 FROM x WHERE NOT bad
      WINDOW w AS (PARTITION BY episode_idx, joint, field ORDER BY t)),
m AS (SELECT episode_idx, joint, field, median(abs(v - p1)) FILTER (v <> p1) AS m FROM p GROUP BY ALL),
g AS (SELECT p.*, m.m * 15 AS far,
      [[v, v, p1, n1], [least(v, n1), greatest(v, n1), p1, n2], [least(v, p1), greatest(v, p1), p2, n1],
       [least(v, n1, n2), greatest(v, n1, n2), p1, n3], [least(v, p1, n1), greatest(v, p1, n1), p2, n2], [least(v, p1, p2), greatest(v, p1, p2), p3, n1]] AS c FROM p JOIN m USING (episode_idx, joint, field)),
sp AS (SELECT episode_idx, t, joint, field FROM g
       WHERE len(list_filter(c, lambda a: a[3] IS NOT NULL AND a[4] IS NOT NULL AND (a[1] - greatest(a[3], a[4]) > far OR least(a[3], a[4]) - a[2] > far))) > 0),
b AS (SELECT *, sum(CASE WHEN p1 IS NULL OR v <> p1 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_idx, joint, field ORDER BY t) AS run FROM p),
l AS (SELECT episode_idx, joint, field, run, count(*) AS n FROM b GROUP BY ALL),
lm AS (SELECT *, median(n) OVER (PARTITION BY episode_idx, joint, field) AS usual FROM l),
st AS (SELECT b.episode_idx, b.t, b.joint, b.field FROM b JOIN lm USING (episode_idx, joint, field, run) WHERE lm.n >= 24 AND lm.n >= 3 * usual)
SELECT episode_idx, t, joint, field FROM x WHERE bad UNION SELECT * FROM sp UNION SELECT * FROM st
"""


FAULT_COUNTS_SQL = FAULTS_SQL.rsplit("SELECT episode_idx, t, joint, field FROM x WHERE bad", 1)[0] + """
SELECT joint, field, fault, count(*) AS readings FROM (
  SELECT joint, field, 'impossible' AS fault FROM x WHERE bad UNION ALL SELECT joint, field, 'stuck' FROM st
  UNION ALL SELECT joint, field, 'spike' FROM sp WHERE (episode_idx, t, joint, field) NOT IN (SELECT (episode_idx, t, joint, field) FROM st)) GROUP BY ALL
"""


def rescued_report(spark: SparkSession, folder: str) -> DataFrame:
    """Records by feed after the approved field ``retries`` was promoted: typed values, rescued lines."""
    rows = promote(report_records(spark, folder), "retries", "bigint")
    return rows.groupBy("feed").agg(F.count("t_avg_fps").alias("typed_rates"), F.count("t_retries").alias("typed_retries"), F.count("rescued").alias("rescued"), F.count(F.lit(1)).alias("records"))


def damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    return damaged(table(spark, folder, "raw_reports"), "payload").groupBy("feed").agg(F.countDistinct("raw_id").alias("lines"))


DAMAGED_SQL = "SELECT feed, count(DISTINCT raw_id) AS lines FROM raw_reports WHERE NOT coalesce(CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT' ELSE false END, false) GROUP BY feed"


STATUS_SQL = """
WITH s AS (SELECT 'frame' k, episode_idx || '|' || camera series, stamp_ns // 500000000 slot, stamp_ns AS tm, NULL::DOUBLE AS v FROM frames WHERE stamp_ns > 0
           UNION ALL SELECT 'report', dataset || '|' || topic, CAST(floor(epoch_us(scanned_at) / 3600000000) AS BIGINT), epoch_us(scanned_at), avg_fps FROM topic_reports WHERE avg_fps > 0 AND NOT isnan(avg_fps)),
b AS (SELECT k, series, slot, arg_max(v, {'tm': tm, 'v': v}) AS v FROM s WHERE series IS NOT NULL GROUP BY ALL),
n AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN slot END IGNORE NULLS) OVER w AS held, coalesce(lead(slot) OVER (PARTITION BY k, series ORDER BY slot), slot + 1) AS nxt FROM b WINDOW w AS (PARTITION BY k, series ORDER BY slot ROWS UNBOUNDED PRECEDING)),
g AS (SELECT k, slot AS seen, held, unnest(range(slot, nxt)) AS slot FROM n)
SELECT k AS series_kind, CASE WHEN slot = seen THEN 'read' WHEN slot - held <= 6 THEN 'filled' ELSE 'missing' END AS status, count(*) AS slots FROM g GROUP BY ALL
"""


def slot_status(spark: SparkSession, folder: str) -> DataFrame:
    return regular_series(spark, folder).groupBy("series_kind", "status").agg(F.count(F.lit(1)).alias("slots"))


def fault_counts(spark: SparkSession, folder: str) -> DataFrame:
    return joint_faults(spark, folder).groupBy("joint", "field", "fault").agg(F.count(F.lit(1)).alias("readings"))


QUERIES = {
    "p3_found": (quiet_pieces, QUIET_SQL),
    "p5_found": (schema_report, SCHEMA_SQL),
    "p5_damaged_lines": (damaged_lines, DAMAGED_SQL),
    "p5_rescued": (rescued_report, None),
    "p6_found": (silent_slots, SILENT_SQL),
    "p6_slot_status": (slot_status, STATUS_SQL),
    "p7_found": (faulty_readings, FAULTS_SQL),
    "p7_fault_counts": (fault_counts, FAULT_COUNTS_SQL),
}
