"""Queries over recordings: nearest readings, related episodes, percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.catalog.tables import table
from tidelane.functions.integers import seconds_to_ns
from tidelane.llm.nearest_time import nearest_in_time
from tidelane.llm.percentiles import DIGITS, error_bound, merge, percentiles, percentiles_from, summarise
from tidelane.plans.joins import join_null_safe, small_side
from tidelane.plans.lineage import cut
from tidelane.llm.related_splits import assign_splits, broken_components, record_components

TOLERANCE_NS = 15_000_000
#: Spellings of the three splits.
SPLITS = {"train": "train", "training": "train", "val": "val", "valid": "val", "validation": "val", "test": "test", "testing": "test"}
POINTS = {"q01": 0.01, "q10": 0.10, "q50": 0.50, "q90": 0.90, "q99": 0.99}
OFF_BY = 0.1


def frame_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Each usable frame stamp with the joint-state reading of its episode that is nearest within 15 ms."""
    frames = table(spark, folder, "frames").where(F.col("stamp_ns") > 0)
    readings = table(spark, folder, "sensor_readings").where((F.col("stream") == "joint_states") & (F.col("ros_timestamp") > 0))
    readings = readings.select("episode_idx", "reading_id", seconds_to_ns(F.col("ros_timestamp")).alias("ns"))
    return nearest_in_time(frames, readings, left_entity="episode_idx", left_id="frame_id", left_stamp="stamp_ns", right_entity="episode_idx", right_id="reading_id", right_stamp="ns", tolerance=TOLERANCE_NS)


def paired_frames(spark: SparkSession, folder: str) -> DataFrame:
    return frame_readings(spark, folder).select(F.col("left_id").alias("frame_id"), F.col("right_id").alias("reading_id"))


PAIRED_SQL = """
WITH f AS (SELECT DISTINCT frame_id, episode_idx, stamp_ns FROM frames WHERE stamp_ns > 0),
r AS (SELECT episode_idx, CAST(round_even(ros_timestamp * 1e9, 0) AS BIGINT) AS ns, min(reading_id) AS reading_id FROM sensor_readings WHERE stream = 'joint_states' AND ros_timestamp > 0 AND NOT isnan(ros_timestamp) GROUP BY ALL)
SELECT frame_id, reading_id FROM f JOIN r ON f.episode_idx = r.episode_idx AND r.ns BETWEEN f.stamp_ns - 15000000 AND f.stamp_ns + 15000000
QUALIFY row_number() OVER (PARTITION BY frame_id, stamp_ns ORDER BY abs(r.ns - f.stamp_ns), r.ns) = 1
"""


def session_key(session: Column) -> Column:
    """One text for a session however written: recording day, rig and running number; other texts stand for themselves."""
    text = F.lower(F.trim(session))
    day = F.concat(*(F.regexp_extract(text, r"(20\d{2})[-_]?(\d{2})[-_]?(\d{2})", i) for i in (1, 2, 3)))
    rig = F.regexp_extract(text, r"rig[^0-9a-z]{0,2}0*(\d+)", 1)
    number = F.regexp_extract(text, r"(?:^|[^a-z])s0*(\d+)", 1)
    return F.when((day != "") & (rig != "") & (number != ""), F.concat_ws("|", day, rig, number)).when(text != "", text)


def recording_key(source: Column) -> Column:
    """The ``rec_`` number of a recording however written; other texts stand for themselves."""
    text = F.lower(F.trim(source))
    number = F.regexp_extract(text, r"rec_([0-9a-z]+)", 1)
    return F.when(number != "", number).when(text != "", text)


def split_name(label: Column) -> Column:
    """train, val or test by any spelling; NULL for others."""
    names = F.create_map(*(F.lit(x) for pair in SPLITS.items() for x in pair))
    return F.try_element_at(names, F.lower(F.trim(label)))


def episode_components(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes and the component of related episodes that each is in."""
    return record_components(table(spark, folder, "annotations"), "episode_idx", [session_key(F.col("session")), recording_key(F.col("source_mcap"))])


def broken_episodes(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluated episodes whose related episodes carry two or more splits."""
    labels = table(spark, folder, "episode_metrics").select(F.col("episode_idx").alias("record"), split_name(F.col("split_label")).alias("split"))
    return broken_components(episode_components(spark, folder), labels).select(F.col("record").cast("bigint").alias("episode_idx"))


BROKEN_SQL = r"""
WITH RECURSIVE a AS (SELECT DISTINCT episode_idx AS e, lower(trim(session)) AS s, lower(trim(source_mcap)) AS r FROM annotations WHERE episode_idx IS NOT NULL),
k AS (SELECT DISTINCT e, 's' || regexp_extract(s, '(20\d{2})[-_]?(\d{2})[-_]?(\d{2})', 1) || regexp_extract(s, '(20\d{2})[-_]?(\d{2})[-_]?(\d{2})', 2) || regexp_extract(s, '(20\d{2})[-_]?(\d{2})[-_]?(\d{2})', 3)
        || '|' || regexp_extract(s, 'rig[^0-9a-z]{0,2}0*(\d+)', 1) || '|' || regexp_extract(s, '(?:^|[^a-z])s0*(\d+)', 1) AS k FROM a WHERE s <> ''
      UNION SELECT e, 'r' || regexp_extract(r, 'rec_([0-9a-z]+)', 1) FROM a WHERE r <> ''),
m AS (SELECT DISTINCT episode_idx AS e, CASE WHEN lower(trim(split_label)) IN ('train', 'training') THEN 'train' WHEN lower(trim(split_label)) IN ('val', 'valid', 'validation') THEN 'val'
        WHEN lower(trim(split_label)) IN ('test', 'testing') THEN 'test' END AS split FROM episode_metrics),
p AS (SELECT DISTINCT x.e AS a, y.e AS b FROM k x JOIN k y USING (k)),
reach AS (SELECT e AS a, e AS b FROM (SELECT e FROM a UNION SELECT e FROM m) UNION SELECT reach.a, p.b FROM reach JOIN p ON p.a = reach.b)
SELECT DISTINCT a AS episode_idx FROM reach JOIN m ON m.e = reach.b
WHERE m.split IS NOT NULL AND a IN (SELECT e FROM m WHERE split IS NOT NULL) GROUP BY a HAVING count(DISTINCT m.split) > 1
"""


def episode_splits(spark: SparkSession, folder: str) -> DataFrame:
    """A new split of all annotated episodes, 8 : 1 : 1, that keeps related episodes together."""
    splits = assign_splits(episode_components(spark, folder), {"train": 0.8, "val": 0.1, "test": 0.1})
    return splits.select(F.col("record").cast("bigint").alias("episode_idx"), "component", "split")


SPLITS_SQL = BROKEN_SQL.split("m AS (")[0] + """p AS (SELECT DISTINCT x.e AS a, y.e AS b FROM k x JOIN k y USING (k)),
reach AS (SELECT DISTINCT e AS a, e AS b FROM a UNION SELECT reach.a, p.b FROM reach JOIN p ON p.a = reach.b),
named AS (SELECT a AS episode_idx, min(CAST(b AS VARCHAR)) AS component FROM reach GROUP BY a),
size AS (SELECT component, count(*) AS n FROM named GROUP BY component),
placed AS (SELECT component, (sum(n) OVER (ORDER BY md5(component), component) - n / 2) / sum(n) OVER () AS middle FROM size)
SELECT episode_idx, component, CASE WHEN middle < 0.8 / 1.0 THEN 'train' WHEN middle < 0.9 THEN 'val' ELSE 'test' END AS split FROM named JOIN placed USING (component)
"""


CAMERA = ["dataset", "camera_key", "channel"]
EPISODE = [*CAMERA, "episode_index"]


def usable_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The brightness samples that count, copies among them."""
    return table(spark, folder, "camera_samples").select("sample_id", *EPISODE, "file_index", "luma").where(F.col("luma").between(0.0, 1.0))


def luma_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Each usable brightness sample once."""
    return usable_samples(spark, folder).dropDuplicates()


def luma_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of luma per camera and channel: over all episodes of the dataset (level 0) and per episode (level 1)."""
    return percentiles(luma_samples(spark, folder), [CAMERA, EPISODE], "luma", POINTS)


def file_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of each video file on its own: counts of leading digits by episode, camera and channel."""
    return summarise(luma_samples(spark, folder), ["file_index", *EPISODE], "luma")


def summed_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles and their bounds per dataset (level 0) and episode (level 1) from the merged summaries of the files."""
    episodes = cut(merge(file_summaries(spark, folder), EPISODE))
    whole = percentiles_from(merge(episodes, CAMERA), CAMERA, POINTS).select(F.lit(0).alias("level"), *CAMERA, F.lit(None).cast("bigint").alias("episode_index"), "n", "stat", "result", "low", "high")
    return whole.unionByName(percentiles_from(episodes, EPISODE, POINTS).withColumn("level", F.lit(1)))


def wrong_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Stored percentiles that are off by more than 0.1.

    Merged summaries decide wherever both of their bounds do; the groups of the others are followed to the last digit.
    """
    group = ["level", *EPISODE]
    stats = table(spark, folder, "camera_stats").where(F.col("stats_scope").isin("global", "episode"))
    stored = stats.select(
        "stats_id",
        *CAMERA,
        F.when(F.col("stats_scope") == "episode", F.col("episode_index")).alias("episode_index"),
        F.when(F.col("stats_scope") == "episode", 1).otherwise(0).alias("level"),
        F.explode(F.array(*(F.struct(F.lit(q).alias("stat"), F.col(q).alias("stored")) for q in POINTS))).alias("s"),
    ).select("stats_id", *group, "s.stat", "s.stored").where(F.col("stored").isNotNull())
    off = lambda at: F.isnan("stored") | (F.abs(F.col("stored") - F.col(at)) > OFF_BY)
    held = cut(join_null_safe(stored, summed_percentiles(spark, folder), [*group, "stat"]))
    # Beyond the reach of both bounds it is off wherever the percentile lies between them, within the reach of both nowhere.
    inside = F.col("stored").between(F.col("low") - OFF_BY, F.col("high") + OFF_BY)
    sure = F.isnan("stored") | ~inside | (~off("low") & ~off("high"))
    found = held.where(sure & off("result")).select("stats_id", "stat")
    open_ = held.where(~sure)
    if open_.isEmpty():
        return found.distinct()
    samples = usable_samples(spark, folder)
    asked = small_side(open_.select(*CAMERA, F.when(F.col("level") == 1, F.col("episode_index")).alias("episode"), (F.col("level") == 0).alias("any")).distinct())
    near = [samples[c].eqNullSafe(asked[c]) for c in CAMERA] + [asked["any"] | samples["episode_index"].eqNullSafe(asked["episode"])]
    exact = percentiles(samples.join(asked, near, "left_semi").dropDuplicates(), [CAMERA, EPISODE], "luma", POINTS, digits=DIGITS)
    settled = join_null_safe(open_.drop("n", "result", "low", "high"), exact, [*group, "stat"]).where(off("result"))
    return found.unionByName(settled.select("stats_id", "stat")).distinct()


WRONG_SQL = """
WITH v AS (SELECT DISTINCT sample_id, dataset, camera_key, channel, episode_index, luma FROM camera_samples WHERE luma BETWEEN 0 AND 1),
q AS (SELECT 'global' AS stats_scope, dataset, camera_key, channel, NULL AS episode_index, quantile_cont(luma, [0.01, 0.1, 0.5, 0.9, 0.99]) AS q FROM v GROUP BY ALL
      UNION ALL SELECT 'episode', dataset, camera_key, channel, episode_index, quantile_cont(luma, [0.01, 0.1, 0.5, 0.9, 0.99]) FROM v GROUP BY ALL),
s AS (SELECT DISTINCT stats_id, stats_scope, dataset, camera_key, channel, CASE WHEN stats_scope = 'episode' THEN episode_index END AS episode_index,
        unnest(['q01', 'q10', 'q50', 'q90', 'q99']) AS stat, unnest([q01, q10, q50, q90, q99]) AS stored, unnest([1, 2, 3, 4, 5]) AS i FROM camera_stats)
SELECT DISTINCT stats_id, stat FROM s JOIN q ON s.stats_scope = q.stats_scope AND s.dataset = q.dataset AND s.camera_key = q.camera_key AND s.channel = q.channel AND s.episode_index IS NOT DISTINCT FROM q.episode_index
WHERE stored IS NOT NULL AND (isnan(stored) OR abs(stored - q.q[i]) > 0.1)
"""

PERCENTILE_SQL = """
WITH v AS (SELECT DISTINCT sample_id, dataset, camera_key, channel, episode_index, luma FROM camera_samples WHERE luma BETWEEN 0 AND 1)
SELECT dataset, camera_key, channel, episode_index, count(*) AS n, round(quantile_cont(luma, 0.5), 9) AS median FROM v GROUP BY GROUPING SETS ((dataset, camera_key, channel), (dataset, camera_key, channel, episode_index))
"""


def luma_medians(spark: SparkSession, folder: str) -> DataFrame:
    return luma_percentiles(spark, folder).where("stat = 'q50'").select("dataset", "camera_key", "channel", "episode_index", "n", F.round("result", 9).alias("median"))


SUMMED_SQL = """
WITH v AS (SELECT DISTINCT sample_id, dataset, camera_key, channel, episode_index, luma FROM camera_samples WHERE luma BETWEEN 0 AND 1),
q AS (SELECT 0 AS level, dataset, camera_key, channel, NULL AS episode_index, count(*) AS n, quantile_cont(luma, [0.01, 0.1, 0.5, 0.9, 0.99]) AS q FROM v GROUP BY ALL
      UNION ALL SELECT 1, dataset, camera_key, channel, episode_index, count(*), quantile_cont(luma, [0.01, 0.1, 0.5, 0.9, 0.99]) FROM v GROUP BY ALL)
SELECT level, dataset, camera_key, channel, episode_index, n, unnest(['q01', 'q10', 'q50', 'q90', 'q99']) AS stat, true AS within_bound FROM q
"""


def summed_within_bound(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each percentile from merged summaries of files is within the stated error of the exact one, and between its bounds."""
    group = ["level", *EPISODE, "stat"]
    both = join_null_safe(summed_percentiles(spark, folder), luma_percentiles(spark, folder).drop("n").withColumnRenamed("result", "exact"), group)
    # A luma's neighbours are at most 1, so this is the bound in luma.
    within = (F.abs(F.col("result") - F.col("exact")) <= error_bound(1)) & F.col("exact").between(F.col("low"), F.col("high"))
    return both.select(*group, "n", within.alias("within_bound"))


QUERIES = {
    "p1_found": (paired_frames, PAIRED_SQL),
    "p2_found": (broken_episodes, BROKEN_SQL),
    "p2_splits": (episode_splits, SPLITS_SQL),
    "p4_found": (wrong_percentiles, WRONG_SQL),
    "p4_medians": (luma_medians, PERCENTILE_SQL),
    "p4_summaries": (summed_within_bound, SUMMED_SQL),
}
