"""Queries of statistics, contracts, vectors and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.catalog.tables import table
from tidelane.functions import arrays, names
from tidelane.operators import contracts, deltas, statistics, transforms

STATS = ["count", "min", "max", "mean", "std", *statistics.POINTS]
LUMA_LEVELS = 256


def _rounded(df: DataFrame, keys: list[str], stats: list[str] = STATS) -> DataFrame:
    return df.select(*keys, *(F.round(F.col(s).cast("double"), 10).alias(s) for s in stats))


def _stats_sql(x: str) -> str:
    return f"round(CAST(count({x}) AS DOUBLE), 10) AS count, round(min({x}), 10) AS min, round(max({x}), 10) AS max, round(avg({x}), 10) AS mean, round(stddev_pop({x}), 10) AS std, " + ", ".join(f"round(quantile_cont({x}, {p}), 10) AS {n}" for n, p in statistics.POINTS.items())


def _truth(spark: SparkSession, folder: str) -> DataFrame:
    x = F.col("ground_truth")
    return table(spark, folder, "predictions").where(statistics.finite(x)).select("episode_idx", "t", "joint", "ground_truth").distinct()


TRUTH_SQL = "tr AS (SELECT DISTINCT episode_idx, t, joint, ground_truth FROM predictions WHERE ground_truth IS NOT NULL AND NOT isnan(ground_truth) AND NOT isinf(ground_truth))"


def stats_global(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(statistics.feature_stats(_truth(spark, folder), ["joint"], "ground_truth"), ["joint"])


def stats_by_episode(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(statistics.feature_stats(_truth(spark, folder), ["episode_idx", "joint"], "ground_truth"), ["episode_idx", "joint"])


def stats_both(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(statistics.grouped_stats(_truth(spark, folder), ["joint"], "episode_idx", "ground_truth"), ["joint", "episode_idx"])


def embedding_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = statistics.vector_rows(table(spark, folder, "embeddings"), ["label"], "embedding").withColumn("x", F.col("x").cast("double"))
    return _rounded(statistics.feature_stats(rows, ["label", "dim"], "x"), ["label", "dim"])


def _levels(spark: SparkSession, folder: str) -> DataFrame:
    samples = table(spark, folder, "camera_samples").where(F.col("luma").between(0.0, 1.0)).select("sample_id", "dataset", "camera_key", "channel", F.rint(F.col("luma") * 255).cast("int").alias("level")).distinct()
    return statistics.histogram(samples, ["dataset", "camera_key", "channel"], "level", LUMA_LEVELS)


def histogram_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["dataset", "camera_key", "channel"]
    return _rounded(statistics.histogram_stats(_levels(spark, folder), keys), keys)


HISTOGRAM_SQL = "WITH s AS (SELECT DISTINCT sample_id, dataset, camera_key, channel, CAST(round_even(luma * 255, 0) AS INTEGER) / 255.0 AS x FROM camera_samples WHERE luma BETWEEN 0 AND 1) SELECT dataset, camera_key, channel, " + _stats_sql("x") + " FROM s GROUP BY ALL"


def approximate(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.approximate_stats(_truth(spark, folder), ["joint"], "ground_truth")


def normalize_check(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.round_trip(_truth(spark, folder), ["joint"], "ground_truth")


NORMALIZE_SQL = "WITH " + TRUTH_SQL + ", b AS (SELECT joint, quantile_cont(ground_truth, 0.01) AS lo, quantile_cont(ground_truth, 0.99) AS hi FROM tr GROUP BY 1) SELECT joint, count(*) FILTER (abs((2 * (ground_truth - lo) / (hi - lo) - 1 + 1) / 2 * (hi - lo) + lo - ground_truth) > 1e-9) AS changed, count(*) AS values FROM tr JOIN b USING (joint) GROUP BY 1"


def stored_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Stored extremes of global statistics that differ from those of the samples by more than 0.01."""
    keys = ["dataset", "camera_key", "channel"]
    samples = table(spark, folder, "camera_samples").where(F.col("luma").between(0.0, 1.0)).groupBy(*keys).agg(F.min("luma").alias("min"), F.max("luma").alias("max"))
    stored = table(spark, folder, "camera_stats").where("stats_scope = 'global'").select(*keys, F.col("min_luma").alias("min"), F.col("max_luma").alias("max")).distinct()
    out = statistics.stats_differences(stored, samples, keys, ["min", "max"], 0.01)
    return out.select(*keys, "stat", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"))


DIFFERENCES_SQL = """WITH a AS (SELECT DISTINCT dataset, camera_key, channel, unnest(['min', 'max']) AS stat, unnest([min_luma, max_luma]) AS x FROM camera_stats WHERE stats_scope = 'global'),
b AS (SELECT dataset, camera_key, channel, unnest(['min', 'max']) AS stat, unnest([min(luma), max(luma)]) AS x FROM camera_samples WHERE luma BETWEEN 0 AND 1 GROUP BY 1, 2, 3)
SELECT dataset, camera_key, channel, stat, round(a.x, 6) AS left, round(b.x, 6) AS right FROM a FULL JOIN b USING (dataset, camera_key, channel, stat) WHERE a.x IS DISTINCT FROM b.x AND NOT coalesce(abs(a.x - b.x) <= 0.01, false)"""


def finite_check(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "predictions").distinct()
    bad = lambda c: F.count_if(F.col(c).isNotNull() & ~statistics.finite(F.col(c))).alias(c)
    return rows.groupBy("joint").agg(bad("ground_truth"), bad("obs_state"), bad("predicted"))


FINITE_SQL = "SELECT joint, " + ", ".join(f"count(*) FILTER ({c} IS NOT NULL AND (isnan({c}) OR isinf({c}))) AS {c}" for c in ("ground_truth", "obs_state", "predicted")) + " FROM (SELECT DISTINCT * FROM predictions) GROUP BY 1"


def index_contract(spark: SparkSession, folder: str) -> DataFrame:
    frames = table(spark, folder, "frames").select("frame_id", "camera", F.concat(F.col("episode_idx").cast("string"), F.lit("|"), F.col("camera")).alias("series"), "frame_index").distinct()
    return contracts.index_contract(frames, "series", "frame_index")


INDEX_SQL = "WITH f AS (SELECT DISTINCT frame_id, episode_idx || '|' || camera AS series, frame_index AS i FROM frames) SELECT series, count(*) AS frames, min(i) = 0 AND max(i) = count(*) - 1 AND count(DISTINCT i) = count(*) AS contiguous, max(i) + 1 - count(DISTINCT i) AS lost, count(*) - count(DISTINCT i) AS repeated FROM f GROUP BY 1"


def _lengths(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "episode_metrics").groupBy("episode_idx").agg(F.max("num_frames").alias("length"))


def episode_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.episode_ranges(_lengths(spark, folder), "episode_idx", "length")


RANGES_SQL = "WITH l AS (SELECT episode_idx, max(num_frames) AS length FROM episode_metrics GROUP BY 1) SELECT episode_idx, CAST(sum(length) OVER w - length AS BIGINT) AS from_index, CAST(sum(length) OVER w AS BIGINT) AS to_index FROM l WINDOW w AS (ORDER BY episode_idx ROWS UNBOUNDED PRECEDING)"


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """Recorded intervals of each topic as segments of a file."""
    gaps = table(spark, folder, "topic_reports").select(F.concat("episode", F.lit("|"), "topic").alias("file"), F.explode("gaps").alias("g"))
    return gaps.select("file", F.col("g.start_s").alias("start_s"), F.col("g.end_s").alias("end_s")).where(F.col("end_s") > F.col("start_s")).distinct()


SEGMENTS_SQL = "seg AS (SELECT DISTINCT file, g.start_s AS start_s, g.end_s AS end_s FROM (SELECT episode || '|' || topic AS file, unnest(gaps) AS g FROM topic_reports) WHERE g.end_s > g.start_s)"


def segment_faults(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.segment_faults(_segments(spark, folder), "file", "start_s", "end_s", 10.0)


SEGMENT_SQL = "WITH " + SEGMENTS_SQL + """, f AS (SELECT *, start_s * 10.0 AS a, end_s * 10.0 AS b, lag(round_even(end_s * 10.0, 0)) OVER (PARTITION BY file ORDER BY start_s, end_s) AS p FROM seg),
x AS (SELECT file, start_s, end_s, CASE WHEN abs(a - round_even(a, 0)) > 1e-3 OR abs(b - round_even(b, 0)) > 1e-3 THEN 'off_grid' WHEN round_even(a, 0) < p THEN 'overlap' WHEN round_even(a, 0) > p THEN 'gap' END AS fault FROM f) SELECT * FROM x WHERE fault IS NOT NULL"""


def segment_assign(spark: SparkSession, folder: str) -> DataFrame:
    """The middle of each segment and how many segments of its file hold it."""
    segments = _segments(spark, folder)
    points = segments.select("file", ((F.col("start_s") + F.col("end_s")) / 2).alias("middle")).distinct()
    return contracts.assign_segments(points, segments, "file", "middle", "start_s", "end_s").select("file", F.round("middle", 6).alias("middle"), "segments")


ASSIGN_SQL = "WITH " + SEGMENTS_SQL + ", p AS (SELECT DISTINCT file, (start_s + end_s) / 2 AS m FROM seg) SELECT p.file, round(m, 6) AS middle, count(seg.file) AS segments FROM p JOIN seg ON p.file = seg.file AND m >= start_s AND m < end_s GROUP BY p.file, m"


def coverage_faults(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.coverage_faults(table(spark, folder, "episode_metrics").where(F.col("split_label").isNotNull()), table(spark, folder, "predictions"), ["episode_idx"])


COVERAGE_SQL = "WITH w AS (SELECT DISTINCT episode_idx FROM episode_metrics WHERE split_label IS NOT NULL), h AS (SELECT DISTINCT episode_idx FROM predictions) SELECT episode_idx, 'missing' AS fault FROM w WHERE episode_idx NOT IN (FROM h) UNION ALL SELECT episode_idx, 'unknown' FROM h WHERE episode_idx NOT IN (FROM w)"


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    """One row per frame of an evaluated episode: joints by name, truth and observed vectors; frames with every value only."""
    rows = table(spark, folder, "predictions").select("episode_idx", "t", "joint", "ground_truth", "obs_state").distinct()
    ok = statistics.finite(F.col("ground_truth")) & statistics.finite(F.col("obs_state"))
    per = rows.groupBy("episode_idx", "t").agg(F.sort_array(F.collect_list(F.when(ok, F.struct("joint", "ground_truth", "obs_state")))).alias("v"), F.count(F.lit(1)).alias("n"))
    # At most the joints of a rig are in one frame's list.
    per = per.where(F.size("v") == F.col("n"))
    return per.select("episode_idx", "t", F.transform("v", lambda x: x["joint"]).alias("joints"), F.transform("v", lambda x: x["ground_truth"]).alias("truth"), F.transform("v", lambda x: x["obs_state"]).alias("state"))


VECTORS_SQL = """vec AS (SELECT episode_idx, t, list(joint ORDER BY joint) AS joints, list(ground_truth ORDER BY joint) AS truth, list(obs_state ORDER BY joint) AS state FROM (SELECT DISTINCT episode_idx, t, joint, ground_truth, obs_state FROM predictions)
GROUP BY 1, 2 HAVING bool_and(coalesce(isfinite(ground_truth) AND isfinite(obs_state), false)))"""


def canonical_order(spark: SparkSession, folder: str) -> DataFrame:
    """Truth vectors given in reverse joint order, brought into the order of names; the sum of place times value checks the order."""
    rows = _vectors(spark, folder).select("episode_idx", "t", arrays.canonical_order(F.reverse("joints"), F.reverse("truth")).alias("v"))
    return rows.select("episode_idx", "t", F.size("v").alias("n"), F.round(F.aggregate(F.transform("v", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6).alias("check"))


CANONICAL_SQL = "WITH " + VECTORS_SQL + " SELECT episode_idx, t, CAST(len(truth) AS INTEGER) AS n, round(list_sum(list_transform(truth, lambda x, i: x * i)), 6) AS check FROM vec"
RIGHT = [f"right_{j}" for j in ("finger_joint1", *(f"joint{i}" for i in range(1, 8)))]


def controller_order(spark: SparkSession, folder: str) -> DataFrame:
    target = list(reversed(RIGHT))
    rows = _vectors(spark, folder).select("episode_idx", "t", arrays.controller_order(F.col("truth"), RIGHT, target).alias("v"))
    return rows.select("episode_idx", "t", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.size("v").alias("n"))


CONTROLLER_SQL = "WITH " + VECTORS_SQL + " SELECT episode_idx, t, round(CASE WHEN len(truth) = 8 THEN truth[8] ELSE truth[1] END, 6) AS first, CAST(len(truth) AS INTEGER) AS n FROM vec"


def step_limit(spark: SparkSession, folder: str) -> DataFrame:
    rows = _vectors(spark, folder)
    limited = arrays.limit_step(F.col("truth"), F.col("state"), 0.01)
    return rows.select("episode_idx", "t", F.round(F.aggregate(limited, F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.array_join(arrays.limited_joints(F.col("truth"), F.col("state"), 0.01), ",").alias("limited"))


LIMIT_SQL = "WITH " + VECTORS_SQL + " SELECT episode_idx, t, round(list_sum(list_transform(truth, lambda x, i: state[i] + greatest(-0.01, least(0.01, x - state[i])))), 6) AS total, array_to_string(list_filter(list_transform(truth, lambda x, i: CASE WHEN abs(x - state[i]) > 0.01 THEN i - 1 END), lambda i: i IS NOT NULL), ',') AS limited FROM vec"


def delta_obs(spark: SparkSession, folder: str) -> DataFrame:
    rows = _vectors(spark, folder).select("episode_idx", "t", deltas.delta_to_state(F.col("truth"), F.col("state"), [0]).alias("d"))
    return rows.select("episode_idx", "t", F.round(F.get("d", F.lit(0)), 6).alias("kept"), F.round(F.get("d", F.lit(1)), 6).alias("delta"))


DELTA_OBS_SQL = "WITH " + VECTORS_SQL + " SELECT episode_idx, t, round(truth[1], 6) AS kept, round(truth[2] - state[2], 6) AS delta FROM vec"
LONG_SQL = "lng AS (SELECT DISTINCT episode_idx, t, joint, t // 16 AS chunk, ground_truth AS a, obs_state AS s FROM predictions WHERE isfinite(ground_truth) AND isfinite(obs_state))"


def _long(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "predictions").where(statistics.finite(F.col("ground_truth")) & statistics.finite(F.col("obs_state")))
    return rows.select("episode_idx", "t", "joint", F.expr("t div 16").alias("chunk"), F.col("ground_truth").alias("a"), F.col("obs_state").alias("s")).distinct()


CHUNK = ["episode_idx", "joint", "chunk"]


def delta_sequential(spark: SparkSession, folder: str) -> DataFrame:
    return deltas.sequential_deltas(_long(spark, folder), chunk=CHUNK, step="t", action="a", state="s").select("episode_idx", "t", "joint", F.round("delta", 6).alias("delta"))


def delta_restore(spark: SparkSession, folder: str) -> DataFrame:
    made = deltas.sequential_deltas(_long(spark, folder), chunk=CHUNK, step="t", action="a", state="s")
    back = deltas.restored_actions(made, chunk=CHUNK, step="t", delta="delta", state="s", sequential=True)
    return back.select("episode_idx", "t", "joint", F.round("action", 4).alias("action"), (F.abs(F.col("action") - F.col("a")) < 1e-9).alias("same"))


def delta_stats(spark: SparkSession, folder: str) -> DataFrame:
    out = deltas.pooled_delta_stats(_long(spark, folder), episode="episode_idx", joint="joint", t="t", action="a", state="s", steps=4)
    return out.select("joint", "count", "n_samples", *(F.round(c, 9).alias(c) for c in ("mean", "std", "min", "max")))


DELTA_STATS_SQL = "WITH " + LONG_SQL + """, x AS (SELECT joint, s, unnest([0, 1, 2, 3]) AS k, unnest([a, lead(a, 1) OVER w, lead(a, 2) OVER w, lead(a, 3) OVER w]) AS a FROM lng WINDOW w AS (PARTITION BY episode_idx, joint ORDER BY t))
SELECT joint, count(*) FILTER (k = 0) AS count, count(*) AS n_samples, round(avg(a - s), 9) AS mean, round(greatest(stddev_pop(a - s), 1e-6), 9) AS std, round(min(a - s), 9) AS min, round(max(a - s), 9) AS max FROM x WHERE a IS NOT NULL GROUP BY 1"""


def truth_delta(spark: SparkSession, folder: str) -> DataFrame:
    return deltas.truth_deltas(_long(spark, folder), by=["episode_idx", "joint"], order="t", truth="a", observed="s", sequential=True).select("episode_idx", "t", "joint", F.round("delta", 6).alias("delta"))


def monitor_delta(spark: SparkSession, folder: str) -> DataFrame:
    return deltas.monitor_step(_long(spark, folder), by=["episode_idx", "joint"], order="t", command="a", observed="s", sequential=True).select("episode_idx", "t", "joint", F.round("step", 6).alias("step"))


def joint_names(spark: SparkSession, folder: str) -> DataFrame:
    """Joint names of a two-armed recording made from the limits' names, in all shapes a name can have."""
    joints = table(spark, folder, "joint_limits").select("joint")
    shapes = F.array(
        F.concat(F.lit("follower_"), F.regexp_replace("joint", "^(left|right)_", ""), F.lit("")),
        F.concat(F.lit("leader_"), F.substring("joint", 1, 1), F.lit("_"), F.regexp_replace("joint", "^(left|right)_", "")),
        F.concat(F.lit("follower_x_"), F.regexp_replace("joint", "^(left|right)_", "")),
        F.concat(F.lit("other_"), F.col("joint")),
        F.concat(F.lit("leader_"), F.substring("joint", 1, 1)),
    )
    rows = joints.select(F.explode(shapes).alias("name")).distinct().withColumn("p", names.parse_joint_name(F.col("name")))
    return rows.select("name", F.col("p.role").alias("role"), F.col("p.robot").alias("robot"), F.col("p.joint").alias("joint"))


JOINT_SQL = """WITH j AS (SELECT joint, regexp_replace(joint, '^(left|right)_', '') AS b, left(joint, 1) AS c FROM joint_limits), n AS (SELECT DISTINCT unnest(['follower_' || b, 'leader_' || c || '_' || b, 'follower_x_' || b, 'other_' || joint, 'leader_' || c]) AS name FROM j),
r AS (SELECT name, CASE WHEN name LIKE 'leader\\_%' ESCAPE '\\' THEN 'action' WHEN name LIKE 'follower\\_%' ESCAPE '\\' THEN 'observation' END AS role, regexp_replace(name, '^(leader|follower)_', '') AS rest FROM n),
h AS (SELECT *, split_part(rest, '_', 1) AS head, contains(rest, '_') AS more FROM r), k AS (SELECT *, CASE head WHEN 'r' THEN 'right' WHEN 'l' THEN 'left' END AS arm FROM h), d AS (SELECT *, role IS NULL OR (arm IS NULL AND more) AS gone FROM k)
SELECT name, CASE WHEN NOT gone THEN role END AS role, CASE WHEN NOT gone THEN coalesce(arm, '') END AS robot, CASE WHEN gone THEN NULL WHEN arm IS NULL THEN rest WHEN more THEN substr(rest, strpos(rest, '_') + 1) ELSE head END AS joint FROM d"""


def pose_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Distance and angle between successive poses of a label; a pose is the first seven numbers of an embedding."""
    from pyspark.sql import Window

    rows = table(spark, folder, "embeddings").select("label", "vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 7).alias("p"))
    before = F.lag("p").over(Window.partitionBy("label").orderBy("vec_id"))
    d = rows.withColumn("b", before).where(F.col("b").isNotNull()).withColumn("d", arrays.pose_delta(F.col("b"), F.col("p")))
    return d.select("vec_id", F.round("d.metres", 6).alias("metres"), F.round("d.degrees", 4).alias("degrees"))


POSE_SQL = """WITH e AS (SELECT label, vec_id, list_transform(embedding[1:7], lambda x: CAST(x AS DOUBLE)) AS p FROM embeddings), b AS (SELECT *, lag(p) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM e)
SELECT vec_id, round(sqrt(list_sum(list_transform([1, 2, 3], lambda i: (p[i] - b[i]) * (p[i] - b[i])))), 6) AS metres,
round(degrees(2 * acos(least(1.0, abs(list_sum(list_transform([4, 5, 6, 7], lambda i: p[i] * b[i]))) / (sqrt(list_sum(list_transform([4, 5, 6, 7], lambda i: p[i] * p[i]))) * sqrt(list_sum(list_transform([4, 5, 6, 7], lambda i: b[i] * b[i]))))))), 4) AS degrees FROM b WHERE b IS NOT NULL"""
def shaped_features(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluations through a pipeline of transforms: features dropped, a task set, one step switched off."""
    rows = table(spark, folder, "episode_metrics").select("eval_id", "episode_idx", F.col("mse").alias("observation.mse"), F.col("mae").alias("observation.state"), "rmse").distinct()
    steps = [
        transforms.Step("exclude", transforms.exclude_observations(["mse", "state"])),
        transforms.Step("drop", transforms.drop_features(["rmse"])),
        transforms.Step("task", transforms.set_task("sort envelopes")),
        transforms.Step("off", transforms.drop_features(["eval_id"]), enabled=False),
    ]
    return transforms.pipeline(rows, steps).withColumnRenamed("observation.state", "state")


def command_episodes(spark: SparkSession, folder: str) -> DataFrame:
    return transforms.has_suffix(table(spark, folder, "topic_reports"), ["episode"], "topic", "/commands")


def scanned_joints(spark: SparkSession, folder: str) -> DataFrame:
    """Joints of a recording whose messages name the limits' joints as leader joints of both arms."""
    joints = table(spark, folder, "joint_limits").agg(F.array_sort(F.collect_set(F.concat(F.lit("leader_"), F.substring("joint", 1, 1), F.lit("_"), F.regexp_replace("joint", "^(left|right)_", "")))).alias("names"))
    rows = joints.select(F.explode(F.array(F.struct(F.lit("b").alias("file"), F.lit(1).alias("n"), F.col("names")), F.struct(F.lit("a").alias("file"), F.lit(2).alias("n"), F.col("names")), F.struct(F.lit("a").alias("file"), F.lit(1).alias("n"), F.array(F.lit("other_joint")).alias("names")))).alias("m")).select("m.*")
    out = transforms.first_joints(rows, file="file", order="n", names="names")
    return out.select("role", "robot", F.array_join("joints", ",").alias("joints"))


SCANNED_SQL = "SELECT 'action' AS role, CASE WHEN joint LIKE 'left%' THEN 'left' ELSE 'right' END AS robot, string_agg(regexp_replace(joint, '^(left|right)_', ''), ',' ORDER BY regexp_replace(joint, '^(left|right)_', '')) AS joints FROM joint_limits GROUP BY 2"
SEQ = "WITH " + LONG_SQL + ", d AS (SELECT *, a - coalesce(lag(a) OVER (PARTITION BY episode_idx, joint, chunk ORDER BY t), s) AS delta FROM lng)"

QUERIES = {
    "vector_stats_global": (stats_global, "WITH " + TRUTH_SQL + " SELECT joint, " + _stats_sql("ground_truth") + " FROM tr GROUP BY 1"),
    "vector_stats_by_episode": (stats_by_episode, "WITH " + TRUTH_SQL + " SELECT episode_idx, joint, " + _stats_sql("ground_truth") + " FROM tr GROUP BY 1, 2"),
    "stats_grouping_sets": (stats_both, "WITH " + TRUTH_SQL + " SELECT joint, episode_idx, " + _stats_sql("ground_truth") + " FROM tr GROUP BY GROUPING SETS ((joint), (joint, episode_idx))"),
    "embedding_stats": (embedding_stats, "WITH v AS (SELECT label, unnest(range(0, len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) SELECT label, CAST(dim AS INTEGER) AS dim, " + _stats_sql("x") + " FROM v GROUP BY 1, 2"),
    "histogram_quantiles": (histogram_quantiles, HISTOGRAM_SQL),
    "approx_stats": (approximate, None),
    "quantile_normalize_check": (normalize_check, NORMALIZE_SQL),
    "stats_differences": (stored_differences, DIFFERENCES_SQL),
    "finite_check": (finite_check, FINITE_SQL),
    "index_contract": (index_contract, INDEX_SQL),
    "episode_ranges": (episode_ranges, RANGES_SQL),
    "segment_faults": (segment_faults, SEGMENT_SQL),
    "segment_assign": (segment_assign, ASSIGN_SQL),
    "coverage_faults": (coverage_faults, COVERAGE_SQL),
    "canonical_joint_order": (canonical_order, CANONICAL_SQL),
    "controller_reorder": (controller_order, CONTROLLER_SQL),
    "delta_limit": (step_limit, LIMIT_SQL),
    "delta_obs_t": (delta_obs, DELTA_OBS_SQL),
    "delta_sequential": (delta_sequential, SEQ + " SELECT episode_idx, t, joint, round(delta, 6) AS delta FROM d"),
    "delta_restore": (delta_restore, SEQ + ", r AS (SELECT *, first_value(s) OVER w + sum(delta) OVER w AS action FROM d WINDOW w AS (PARTITION BY episode_idx, joint, chunk ORDER BY t ROWS UNBOUNDED PRECEDING)) SELECT episode_idx, t, joint, round(action, 4) AS action, abs(action - a) < 1e-9 AS same FROM r"),
    "delta_stats_k": (delta_stats, DELTA_STATS_SQL),
    "truth_delta": (truth_delta, "WITH " + LONG_SQL + " SELECT episode_idx, t, joint, round(a - coalesce(lag(a) OVER (PARTITION BY episode_idx, joint ORDER BY t), s), 6) AS delta FROM lng"),
    "monitor_delta": (monitor_delta, "WITH " + LONG_SQL + " SELECT episode_idx, t, joint, round(a - lag(a) OVER (PARTITION BY episode_idx, joint ORDER BY t), 6) AS step FROM lng"),
    "joint_name_parse": (joint_names, JOINT_SQL),
    "pose_delta": (pose_steps, POSE_SQL),
    "transform_pipeline": (shaped_features, "SELECT DISTINCT eval_id, episode_idx, mae AS state, 'sort envelopes' AS task FROM episode_metrics"),
    "command_episodes": (command_episodes, "SELECT episode, bool_or(topic LIKE '%/commands') AS found FROM topic_reports GROUP BY 1"),
    "scanned_joint_names": (scanned_joints, SCANNED_SQL),
}
