"""Queries of alignment and frame shaping.

The main clock is the waist camera, the observations are joint readings, the commands are the chest camera's readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.catalog.tables import table
from tidelane.functions.integers import seconds_to_ns
from tidelane.operators import asof as joins
from tidelane.operators import shaping

RATE = 10
BUFFER_FRAMES = 75


def camera(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """(episode, ts, seq) of the usable stamps of a camera."""
    frames = table(spark, folder, "frames").where((F.col("camera") == name) & (F.col("stamp_ns") > 0))
    return frames.select(F.col("episode_idx").alias("episode"), F.col("stamp_ns").alias("ts"), F.col("frame_id").alias("seq")).distinct()


def readings(spark: SparkSession, folder: str, stream: str) -> DataFrame:
    """(episode, ts, seq, value) of the usable stamps of a stream; the value is the sequence number."""
    rows = table(spark, folder, "sensor_readings").where((F.col("stream") == stream) & (F.col("ros_timestamp") > 0))
    return rows.select(F.col("episode_idx").alias("episode"), seconds_to_ns(F.col("ros_timestamp")).alias("ts"), F.col("reading_id").alias("seq"), F.col("sequence").cast("double").alias("value")).distinct()


def cam_sql(name: str, camera_name: str) -> str:
    return f"{name} AS (SELECT DISTINCT episode_idx AS episode, stamp_ns AS ts, frame_id AS seq FROM frames WHERE camera = '{camera_name}' AND stamp_ns > 0)"


def read_sql(name: str, stream: str) -> str:
    return f"{name} AS (SELECT DISTINCT episode_idx AS episode, CAST(round_even(ros_timestamp * 1e9, 0) AS BIGINT) AS ts, reading_id AS seq, CAST(sequence AS DOUBLE) AS value FROM sensor_readings WHERE stream = '{stream}' AND ros_timestamp > 0)"


def causal(spark: SparkSession, folder: str) -> DataFrame:
    pairs = joins.asof(camera(spark, folder, "waist"), readings(spark, folder, "joint_states"), by=["episode"], ts="ts", seq="seq")
    return pairs.select("l.seq", F.col("r.seq").alias("reading"), "dt")


LAST_SQL = "{n} AS (SELECT episode, ts, max(seq) AS seq, arg_max(value, seq) AS value FROM {s} GROUP BY 1, 2)"
FIRST_SQL = "{n} AS (SELECT episode, ts, min(seq) AS seq, arg_min(value, seq) AS value FROM {s} GROUP BY 1, 2)"
CAUSAL_SQL = f"WITH {cam_sql('m', 'waist')}, {read_sql('j', 'joint_states')}, {LAST_SQL.format(n='d', s='j')} SELECT m.seq, d.seq AS reading, d.ts - m.ts AS dt FROM m ASOF LEFT JOIN d ON m.episode = d.episode AND m.ts >= d.ts"


def nearest(spark: SparkSession, folder: str) -> DataFrame:
    pairs = joins.asof(camera(spark, folder, "waist"), readings(spark, folder, "joint_states"), by=["episode"], ts="ts", seq="seq", mode="nearest")
    return pairs.select("l.seq", F.col("r.seq").alias("reading"), "dt")


NEAR_SQL = """{out} AS (SELECT a.*, CASE WHEN a.bts IS NULL OR (f.ts IS NOT NULL AND f.ts - a.ts < a.ts - a.bts) THEN f.seq ELSE a.bseq END AS {p}seq, CASE WHEN a.bts IS NULL OR (f.ts IS NOT NULL AND f.ts - a.ts < a.ts - a.bts) THEN f.ts ELSE a.bts END AS {p}ts,
  CASE WHEN a.bts IS NULL OR (f.ts IS NOT NULL AND f.ts - a.ts < a.ts - a.bts) THEN f.value ELSE a.bval END AS {p}value
  FROM (SELECT m.*, b.ts AS bts, b.seq AS bseq, b.value AS bval FROM {m} m ASOF LEFT JOIN {d} b ON m.episode = b.episode AND m.ts >= b.ts) a ASOF LEFT JOIN {d} f ON a.episode = f.episode AND a.ts < f.ts)"""
NEAREST_SQL = f"WITH {cam_sql('m', 'waist')}, {read_sql('j', 'joint_states')}, {FIRST_SQL.format(n='d', s='j')}, {NEAR_SQL.format(out='o', m='m', d='d', p='r')} SELECT seq, rseq AS reading, rts - ts AS dt FROM o"


def fill_kinds(spark: SparkSession, folder: str) -> DataFrame:
    kinds = joins.fill_kind(camera(spark, folder, "waist"), readings(spark, folder, "chest"), readings(spark, folder, "joint_states"), buffer_frames=BUFFER_FRAMES)
    return joins.fill_counts(kinds, ["episode"])


FILL_SQL = f"""WITH {cam_sql('m', 'waist')}, {read_sql('c', 'chest')}, {LAST_SQL.format(n='cd', s='c')}, {read_sql('j', 'joint_states')}, {FIRST_SQL.format(n='jd', s='j')},
p AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY ts, seq) - 1 AS f, count(*) OVER (PARTITION BY episode) AS n FROM m),
q AS (SELECT *, CASE WHEN f > n - 75 THEN greatest(0, n - 150) ELSE greatest(0, f - 76) END AS o FROM p),
x AS (SELECT q.episode, q.ts, q.seq, p.ts AS ots FROM q JOIN p ON q.episode = p.episode AND q.o = p.f),
y AS (SELECT x.*, cd.ts AS cts FROM x ASOF LEFT JOIN cd ON x.episode = cd.episode AND x.ts >= cd.ts),
{NEAR_SQL.format(out='z', m='y', d='jd', p='o')},
k AS (SELECT episode, CASE WHEN cts >= ots THEN 'exact' WHEN cts IS NOT NULL THEN 'hold_last' WHEN ovalue IS NOT NULL THEN 'fallback_to_observation' ELSE 'dropped' END AS kind FROM z)
SELECT episode, count(*) FILTER (kind = 'exact') AS exact, count(*) FILTER (kind = 'hold_last') AS hold_last, count(*) FILTER (kind = 'fallback_to_observation') AS fallback_to_observation, count(*) FILTER (kind = 'dropped') AS dropped FROM k GROUP BY 1"""


#: The other cameras, whose frames are matched by distance.
OTHERS = ("chest", "wrist_l", "wrist_r")


def aligned_streams(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, str]]:
    """What is aligned with the waist camera: joint readings, the other cameras' frames, and a reading of each of them as the commands."""
    cameras = {c: (camera(spark, folder, c).withColumn("value", F.lit(0.0)), "nearest") for c in OTHERS}
    commands = {f"{c}_command": (readings(spark, folder, c), "causal") for c in OTHERS}
    return {"joints": (readings(spark, folder, "joint_states"), "nearest"), **cameras, **commands}


def aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of the waist camera with what belongs to them of all other streams; frames that lack one are left out."""
    streams = aligned_streams(spark, folder)
    out = joins.align(camera(spark, folder, "waist"), streams, by=["episode"], ts="ts", seq="seq")
    return out.select("episode", "ts", "seq", *(F.col(f"{n}.seq").alias(n) for n in streams))


def _aligned_body() -> str:
    parts = [cam_sql("m", "waist"), read_sql("j", "joint_states"), FIRST_SQL.format(n="jd", s="j"), NEAR_SQL.format(out="n0", m="m", d="jd", p="x"), "a0 AS (SELECT episode, ts, seq, xseq AS joints FROM n0)"]
    kept = ["joints"]
    for i, c in enumerate(OTHERS, 1):
        parts += [cam_sql(f"c{i}", c), f"d{i} AS (SELECT episode, ts, min(seq) AS seq, 0.0 AS value FROM c{i} GROUP BY 1, 2)", NEAR_SQL.format(out=f"n{i}", m=f"a{i - 1}", d=f"d{i}", p="x")]
        parts += [f"a{i} AS (SELECT episode, ts, seq, {', '.join(kept)}, xseq AS {c} FROM n{i})"]
        kept.append(c)
    last = len(OTHERS)
    for i, c in enumerate(OTHERS, 1):
        parts += [read_sql(f"r{i}", c), LAST_SQL.format(n=f"l{i}", s=f"r{i}")]
        parts += [f"b{i} AS (SELECT x.*, l{i}.seq AS {c}_command FROM {f'a{last}' if i == 1 else f'b{i - 1}'} x ASOF LEFT JOIN l{i} ON x.episode = l{i}.episode AND x.ts >= l{i}.ts)"]
        kept.append(f"{c}_command")
    return ", ".join(parts) + f", al AS (SELECT * FROM b{last} WHERE {' AND '.join(f'{k} IS NOT NULL' for k in kept)})"


ALIGNED_BODY = _aligned_body()


def subsampled(spark: SparkSession, folder: str) -> DataFrame:
    rows = camera(spark, folder, "waist")
    return shaping.grid_subsample(rows, by="episode", ts="ts", seq="seq", rate=RATE).select("episode", "ts", "seq")


GRID_BODY = f"""{cam_sql('m', 'waist')}, g AS (SELECT *, row_number() OVER w AS i, (ts - min(ts) OVER (PARTITION BY episode)) * {RATE} // 1000000000 + 1 AS g FROM m WINDOW w AS (PARTITION BY episode ORDER BY ts, seq)),
k AS (SELECT *, i + least(0, min(g - i) OVER (PARTITION BY episode ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)) AS k FROM g),
sub AS (SELECT episode, ts, seq FROM (SELECT *, coalesce(lag(k) OVER (PARTITION BY episode ORDER BY ts, seq), 0) AS p FROM k) WHERE k > p)"""


def look_ahead(spark: SparkSession, folder: str) -> DataFrame:
    rows = subsampled(spark, folder)
    paired = joins.asof(rows, readings(spark, folder, "joint_states"), by=["episode"], ts="ts", seq="seq", mode="nearest").select("l.*", F.col("r.value").alias("state")).where(F.col("state").isNotNull())
    return shaping.look_ahead(paired, by=["episode"], order=["ts", "seq"], state="state", steps=3).select("episode", "seq", "state", "action")


LOOK_SQL = f"""WITH {GRID_BODY}, {read_sql('j', 'joint_states')}, {FIRST_SQL.format(n='jd', s='j')}, {NEAR_SQL.format(out='o', m='sub', d='jd', p='r')},
a AS (SELECT episode, seq, rvalue AS state, lead(rvalue, 3) OVER (PARTITION BY episode ORDER BY ts, seq) AS action FROM o WHERE rvalue IS NOT NULL) SELECT * FROM a WHERE action IS NOT NULL"""


def strided(spark: SparkSession, folder: str) -> DataFrame:
    rows = readings(spark, folder, "joint_states")
    return shaping.stride_rate(rows, by="episode", ts="ts", seq="seq", rate=30.0).select("episode", "ts", "seq", "stride")


STRIDE_SQL = f"""WITH {read_sql('j', 'joint_states')}, p AS (SELECT *, row_number() OVER w - 1 AS place, ts - lag(ts) OVER w AS d, count(*) OVER (PARTITION BY episode) AS n FROM j WINDOW w AS (PARTITION BY episode ORDER BY ts, seq)),
h AS (SELECT episode, list_sort(list(d)) AS d FROM p WHERE place BETWEEN 1 AND 20 GROUP BY 1), s AS (SELECT p.*, CASE WHEN n < 4 OR coalesce(h.d[len(h.d) // 2 + 1], 0) <= 0 THEN 1 ELSE greatest(1, round_even(1e9 / h.d[len(h.d) // 2 + 1] / 30.0, 0)) END AS stride FROM p LEFT JOIN h USING (episode))
SELECT episode, ts, seq, CAST(stride AS BIGINT) AS stride FROM s WHERE place % CAST(stride AS BIGINT) = 0"""


def previous(spark: SparkSession, folder: str) -> DataFrame:
    rows = readings(spark, folder, "joint_states")
    return shaping.previous_sample(rows, by=["episode"], order=["ts", "seq"], value="value").select("episode", "seq", "value", "command")


def _arm_vectors(spark: SparkSession, folder: str, column: str, late: int = 0) -> DataFrame:
    """(episode, arm, ts, seq, values): all joints of an arm in a frame, in the order of their names; frames without any value are left out.

    Copies go inside the frame's list and the key is the final stamp, so that one shuffle does for the as-of join's first arrivals too.
    """
    arm = F.substring_index("joint", "_", 1)
    # The right arm's samples come 4 ms late.
    ts = F.col("t") * 33 + late + F.when(arm == "right", 4).otherwise(0)
    rows = table(spark, folder, "predictions").select(F.col("episode_idx").alias("episode"), arm.alias("arm"), ts.alias("ts"), "t", F.struct("joint", F.col(column).alias("value")).alias("j"))
    vectors = rows.groupBy("episode", "arm", "ts").agg(F.min("t").alias("seq"), F.array_sort(F.array_distinct(F.collect_list("j"))).alias("j"), F.count("j.value").alias("n")).where("n > 0")
    return vectors.select("episode", "arm", "ts", "seq", F.col("j.value").alias("values"))


def vectors_sql(name: str, column: str, late: int = 0) -> str:
    return f"""{name} AS (SELECT episode_idx AS e, split_part(joint, '_', 1) AS arm, concat(episode_idx, '/', split_part(joint, '_', 1)) AS episode, t * 33 + {late} + CASE WHEN split_part(joint, '_', 1) = 'right' THEN 4 ELSE 0 END AS ts, t AS seq, list(x ORDER BY joint) AS value
FROM (SELECT DISTINCT episode_idx, t, joint, {column} AS x FROM predictions) GROUP BY ALL HAVING count(x) > 0)"""


def truth_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Whole vectors of every arm of every episode, each with the nearest raw output of the same arm, which comes 5 ms late."""
    truth = _arm_vectors(spark, folder, "ground_truth")
    late = _arm_vectors(spark, folder, "raw_output", 5)
    return joins.pair_vectors(truth, late, by=["episode", "arm"], ts="ts", seq="seq").select("episode", "arm", "ts", "dt", "truth", "predicted")


TRUTH_VECTORS_SQL = f"""WITH {vectors_sql('m', 'ground_truth')}, {vectors_sql('d', 'raw_output', 5)}, {NEAR_SQL.format(out='o', m='m', d='d', p='r')}
SELECT e AS episode, arm, ts, rts - ts AS dt, value[1:least(len(value), len(rvalue))] AS truth, rvalue[1:least(len(value), len(rvalue))] AS predicted FROM o WHERE rts IS NOT NULL"""


def whole_arms(spark: SparkSession, folder: str) -> DataFrame:
    """All joints of an episode's arms on the clock of the first arm that it has."""
    vectors = _arm_vectors(spark, folder, "ground_truth")
    arms = {arm: vectors.where(F.col("arm") == arm).drop("arm") for arm in ("left", "right")}
    return joins.merge_rigs(arms, by=["episode"], ts="ts", seq="seq").select("episode", "ts", "values")


WHOLE_ARMS_SQL = f"""WITH {vectors_sql('v', 'ground_truth')}, h AS (SELECT e, min(arm) AS arm FROM v GROUP BY 1), m AS (SELECT v.e AS episode, ts, seq, value FROM v JOIN h ON v.e = h.e AND v.arm = h.arm),
d AS (SELECT v.e AS episode, ts, seq, value FROM v JOIN h ON v.e = h.e AND v.arm > h.arm), {NEAR_SQL.format(out='o', m='m', d='d', p='r')} SELECT episode, ts, CASE WHEN rts IS NULL THEN value ELSE list_concat(value, rvalue) END AS values FROM o"""


def fresh_readings(spark: SparkSession, folder: str) -> DataFrame:
    pairs = joins.asof(camera(spark, folder, "waist"), readings(spark, folder, "joint_states"), by=["episode"], ts="ts", seq="seq")
    return pairs.select("l.seq", joins.fresh(F.col("r.seq"), -F.col("dt"), 20_000_000).alias("reading"))


def session_rates(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "topic_reports").where((F.col("avg_fps") > 0) & ~F.isnan("avg_fps") & (F.col("role") == "stream"))
    return shaping.smallest_rate(rows, "dataset", "avg_fps")


def unbroken(spark: SparkSession, folder: str) -> DataFrame:
    """Frames per episode without the episodes that have a frame without a stamp."""
    rows = table(spark, folder, "frames").select("frame_id", "episode_idx", "stamp_ns").distinct().withColumn("broken", F.col("stamp_ns") == 0)
    return shaping.drop_broken(rows, "episode_idx", "broken").groupBy("episode_idx").agg(F.count(F.lit(1)).alias("frames"))


QUERIES = {
    "asof_causal": (causal, CAUSAL_SQL),
    "asof_nearest": (nearest, NEAREST_SQL),
    "action_fill_kinds": (fill_kinds, FILL_SQL),
    "aligned_frames": (aligned, "WITH " + ALIGNED_BODY + " SELECT * FROM al"),
    "grid_subsample": (subsampled, "WITH " + GRID_BODY + " SELECT * FROM sub"),
    "lookahead_action": (look_ahead, LOOK_SQL),
    "stride_downsample": (strided, STRIDE_SQL),
    "prev_sample_command": (previous, f"WITH {read_sql('j', 'joint_states')} SELECT episode, seq, value, coalesce(lag(value) OVER (PARTITION BY episode ORDER BY ts, seq), 0.0) AS command FROM j"),
    "arm_merge": (whole_arms, WHOLE_ARMS_SQL),
    "pred_gt_align": (truth_vectors, TRUTH_VECTORS_SQL),
    "fresh_readings": (fresh_readings, CAUSAL_SQL.replace("d.seq AS reading, d.ts - m.ts AS dt", "CASE WHEN m.ts - d.ts <= 20000000 THEN d.seq END AS reading")),
    "session_rates": (session_rates, "SELECT dataset, min(avg_fps) AS rate, min(avg_fps) <> max(avg_fps) AS mixed FROM topic_reports WHERE avg_fps > 0 AND NOT isnan(avg_fps) AND role = 'stream' GROUP BY 1"),
    "drop_broken_episodes": (unbroken, "WITH f AS (SELECT DISTINCT frame_id, episode_idx, stamp_ns FROM frames) SELECT episode_idx, count(*) AS frames FROM f WHERE episode_idx NOT IN (SELECT episode_idx FROM f WHERE stamp_ns = 0) GROUP BY 1"),
}
