"""Queries of the stateful operators, over finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.catalog.alignment import ALIGNED_BODY, aligned_streams, camera
from tidelane.catalog.tables import table
from tidelane.streaming.folds import WatchLimits, align_fold, complete_fold, fold_batch, watchdog_fold
from tidelane.streaming.windows import interval_rates, silence_sessions

CAMERAS = ["waist", "chest", "wrist_l", "wrist_r"]


def complete_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Moments at which every camera and the joints had advanced since the last such moment."""
    rows = table(spark, folder, "sensor_readings").where("last_seen_monotonic IS NOT NULL").select("reading_id", "episode_idx", "stream", "sequence", F.col("last_seen_monotonic").alias("at")).distinct()
    return fold_batch(rows, ["episode_idx"], ["at", "reading_id"], complete_fold("stream", "sequence", "at", ["joint_states", *CAMERAS]))


def watchdog(spark: SparkSession, folder: str) -> DataFrame:
    """Watchdog over each episode's readings: a check at each chest reading, a rearm at each wrist reading."""
    rows = table(spark, folder, "sensor_readings").where("last_seen_monotonic IS NOT NULL").select("reading_id", "episode_idx", "stream", "sequence", F.col("last_seen_monotonic").alias("seen")).distinct()
    rows = rows.withColumns({"at": F.col("seen"), "command": F.when(F.col("stream") == "chest", "check").when(F.col("stream") == "wrist_l", "rearm")})
    limits = WatchLimits({"joint_states": 0.1, "waist": 1.5, "chest": 1.5}, skew_s=1.5, grace_s=2.0)
    return fold_batch(rows, ["episode_idx"], ["at", "reading_id"], watchdog_fold(limits))


def buffered_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """The aligned frames by the buffered fold, with a buffer that is longer than any wait."""
    rows = camera(spark, folder, "waist").select("episode", "ts", "seq", F.lit("main").alias("stream"), F.lit(None).cast("double").alias("value"))
    others = aligned_streams(spark, folder)
    for name, (df, _) in others.items():
        rows = rows.unionByName(df.select("episode", "ts", "seq", F.lit(name).alias("stream"), "value"))
    end = rows.groupBy("episode").agg(F.max("ts").alias("ts")).select("episode", "ts", F.lit(1 << 62).alias("seq"), F.lit("end").alias("stream"), F.lit(None).cast("double").alias("value"))
    fold = align_fold({name: mode for name, (_, mode) in others.items()}, 20_000_000_000)
    out = fold_batch(rows.unionByName(end), ["episode"], ["ts", "seq"], fold)
    part = lambda n: F.get_json_object("matched", f"$.{n}").cast("bigint").alias(n)
    return out.select("episode", "ts", "seq", *map(part, others))


def event_sessions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = silence_sessions(rows, ["event_type"], "ts", "10 minutes", "1 hour")
    return out.select("event_type", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")


SESSION_SQL = """WITH o AS (SELECT event_type, CAST(ts AS TIMESTAMP) AS ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL '10 minutes' THEN 1 ELSE 0 END AS o FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
p AS (SELECT *, sum(o) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS p FROM o) SELECT event_type, min(ts) AS session_start, count(*) AS n FROM p GROUP BY event_type, p"""


def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return interval_rates(rows, ["event_type"], "ts", "5 seconds", "1 hour").select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


QUERIES = {
    "complete_snapshots": (complete_snapshots, None),
    "watchdog_rearm": (watchdog, None),
    "buffered_alignment": (buffered_alignment, "WITH " + ALIGNED_BODY + " SELECT * FROM al"),
    "session_windows": (event_sessions, SESSION_SQL),
    "tumbling_windows": (event_windows, "SELECT event_type, time_bucket(INTERVAL '5 seconds', CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-01') AS window_start, count(*) AS n FROM events GROUP BY 1, 2"),
}
