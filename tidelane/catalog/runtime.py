"""Queries of runtime analytics and calibration data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelane.catalog.features import _vectors
from tidelane.catalog.tables import table
from tidelane.functions import imagebytes, rates
from tidelane.operators import calibration, deadband, runtime

ROW_SQL = "rd AS (SELECT DISTINCT reading_id, episode_idx, stream, sequence, last_seen_monotonic AS m FROM sensor_readings WHERE last_seen_monotonic IS NOT NULL)"


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sensor_readings").where("last_seen_monotonic IS NOT NULL")
    return rows.select("reading_id", "episode_idx", "stream", "sequence", F.col("last_seen_monotonic").alias("m")).distinct()


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").alias("ts"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))


EV_SQL = "ev AS (SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) / 1e6 AS ats FROM events)"


def smoothness(spark: SparkSession, folder: str) -> DataFrame:
    """Smoothness of each episode's observed motion over the last 100 steps: the length of the step of all joints; a frame counts as clamped if any joint's own step is beyond 0.02."""
    rows = table(spark, folder, "predictions").where(F.col("predicted").isNotNull()).select("episode_idx", "joint", "t", "predicted").distinct()
    rows = rows.withColumn("d", F.col("predicted") - F.lag("predicted").over(Window.partitionBy("episode_idx", "joint").orderBy("t")))
    frames = rows.groupBy("episode_idx", "t").agg(F.sqrt(F.sum(F.col("d") * F.col("d"))).alias("step"), F.coalesce(F.max(F.abs("d")) > 0.02, F.lit(False)).alias("clamped"))
    out = runtime.rolling_smoothness(frames, by=["episode_idx"], order="t", vector_step="step", clamped="clamped")
    return out.select("episode_idx", "t", *(F.round(c, 9).alias(c) for c in ("step_mean", "step_std", "step_max", "jerk_mean", "jerk_max", "clamped_pct")))


SMOOTH_SQL = """WITH r AS (SELECT DISTINCT episode_idx, joint, t, predicted AS p FROM predictions WHERE predicted IS NOT NULL), d AS (SELECT episode_idx, t, p - lag(p) OVER (PARTITION BY episode_idx, joint ORDER BY t) AS d FROM r),
s AS (SELECT episode_idx, t, sqrt(sum(d * d)) AS st, coalesce(max(abs(d)) > 0.02, false) AS c FROM d GROUP BY 1, 2), k AS (SELECT *, abs(st - lag(st) OVER w) AS j, count(st) OVER (w ROWS UNBOUNDED PRECEDING) >= 2 AS ok FROM s WINDOW w AS (PARTITION BY episode_idx ORDER BY t))
SELECT episode_idx, t, round(CASE WHEN ok THEN avg(st) OVER l END, 9) AS step_mean, round(CASE WHEN ok THEN stddev_pop(st) OVER l END, 9) AS step_std, round(CASE WHEN ok THEN max(st) OVER l END, 9) AS step_max, round(CASE WHEN ok THEN avg(j) OVER l END, 9) AS jerk_mean, round(CASE WHEN ok THEN max(j) OVER l END, 9) AS jerk_max,
round(CASE WHEN ok THEN 100 * avg(CAST(c AS INTEGER)) OVER (PARTITION BY episode_idx ORDER BY t ROWS UNBOUNDED PRECEDING) END, 9) AS clamped_pct FROM k WINDOW l AS (PARTITION BY episode_idx ORDER BY t ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"""


def latency(spark: SparkSession, folder: str) -> DataFrame:
    out = runtime.rolling_latency(_events(spark, folder), by=["user_id"], order="event_id", latency="value", window=50)
    return out.select("event_id", *(F.round(c, 9).alias(c) for c in ("latency_mean", "latency_std", "latency_max")))


LATENCY_SQL = "WITH " + EV_SQL + " SELECT event_id, round(coalesce(avg(value) OVER w, 0), 9) AS latency_mean, round(coalesce(stddev_pop(value) OVER w, 0), 9) AS latency_std, round(coalesce(max(value) OVER w, 0), 9) AS latency_max FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)"


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of the sequence counter between successive readings of a stream."""
    rows = _readings(spark, folder).groupBy("episode_idx", "stream", "m").agg(F.max("sequence").alias("sequence"))
    return runtime.counter_rates(rows, by=["episode_idx", "stream"], at_s="m", counter="sequence").select("episode_idx", "stream", "m", "sequence", F.round("rate", 6).alias("rate"))


COUNTER_SQL = "WITH " + ROW_SQL + ", r AS (SELECT episode_idx, stream, m, max(sequence) AS sequence FROM rd GROUP BY 1, 2, 3) SELECT episode_idx, stream, m, sequence, round((sequence - lag(sequence) OVER w) / greatest(m - lag(m) OVER w, 0.001), 6) AS rate FROM r WINDOW w AS (PARTITION BY episode_idx, stream ORDER BY m)"


def windows(spark: SparkSession, folder: str) -> DataFrame:
    out = runtime.window_rates(_events(spark, folder), by=["event_type"], at="ts", width="6 hours")
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("rate", 9).alias("rate"))


WINDOW_SQL = "SELECT event_type, CAST(time_bucket(INTERVAL '6 hours', CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-01') AS TIMESTAMP) AS window_start, count(*) AS n, round(count(*) / 21600.0, 9) AS rate FROM events GROUP BY 1, 2"


def stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    return runtime.totals(_readings(spark, folder), by=["episode_idx", "stream"], at_s="m").select("episode_idx", "stream", "n", F.round("rate", 6).alias("rate"))


TOTALS_SQL = "WITH " + ROW_SQL + " SELECT episode_idx, stream, count(*) AS n, round(count(*) / greatest(max(m) - min(m), 0.001), 6) AS rate FROM rd GROUP BY 1, 2"


def bad_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Frames by camera and reason: no stamp, zero stamp, no size."""
    rows = table(spark, folder, "frames").select("frame_id", "camera", "stamp_ns", "jpg_bytes").distinct()
    reason = F.when(F.col("stamp_ns").isNull(), "no_stamp").when(F.col("stamp_ns") <= 0, "zero_stamp").when(F.col("jpg_bytes").isNull(), "no_size")
    return runtime.reason_counts(rows.withColumn("reason", reason), ["camera"], "reason")


BAD_SQL = "WITH f AS (SELECT camera, CASE WHEN stamp_ns IS NULL THEN 'no_stamp' WHEN stamp_ns <= 0 THEN 'zero_stamp' WHEN jpg_bytes IS NULL THEN 'no_size' END AS reason FROM (SELECT DISTINCT frame_id, camera, stamp_ns, jpg_bytes FROM frames)) SELECT camera, reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY 1, 2"


def advances(spark: SparkSession, folder: str) -> DataFrame:
    """Readings, in the order of their stamps, whose sequence doesn't grow."""
    rows = table(spark, folder, "sensor_readings").where("ros_timestamp > 0").select("reading_id", "episode_idx", "stream", "sequence", F.struct("ros_timestamp", "reading_id").alias("at")).distinct()
    return runtime.sequence_faults(rows, by=["episode_idx", "stream"], order="at", sequence="sequence").select("reading_id", "sequence", "previous")


ADVANCE_SQL = "WITH r AS (SELECT DISTINCT reading_id, episode_idx, stream, sequence, ros_timestamp AS x FROM sensor_readings WHERE ros_timestamp > 0), p AS (SELECT reading_id, sequence, lag(sequence) OVER (PARTITION BY episode_idx, stream ORDER BY x, reading_id) AS previous FROM r) SELECT * FROM p WHERE sequence <= previous"


def settle(spark: SparkSession, folder: str) -> DataFrame:
    """Islands of small prediction error of a joint that last 30 frames."""
    rows = table(spark, folder, "predictions").select("episode_idx", "joint", "t", "predicted", "obs_state").distinct().withColumns({"valid": F.abs(F.col("predicted") - F.col("obs_state")) <= 0.02, "at": F.col("t").cast("double")})
    return runtime.settled(rows, by=["episode_idx", "joint"], order="t", at_s="at", valid="valid", seconds=30.0, samples=20)


SETTLE_SQL = """WITH r AS (SELECT DISTINCT episode_idx, joint, t, predicted, obs_state FROM predictions), v AS (SELECT *, coalesce(NOT isnan(obs_state) AND abs(predicted - obs_state) <= 0.02, false) AS ok FROM r),
i AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY episode_idx, joint ORDER BY t ROWS UNBOUNDED PRECEDING) AS i FROM v)
SELECT episode_idx, joint, CAST(min(t) AS DOUBLE) AS since, CAST(max(t) AS DOUBLE) AS until, count(*) AS samples, max(t) - min(t) >= 30 AND count(*) >= 20 AS settled FROM i WHERE ok GROUP BY episode_idx, joint, i"""


def silences(spark: SparkSession, folder: str) -> DataFrame:
    return runtime.silence_sessions(_readings(spark, folder), by=["episode_idx", "stream"], ts_s="m", gap_s=1.0)


SILENCE_SQL = "WITH " + ROW_SQL + """, o AS (SELECT *, CASE WHEN lag(m) OVER w IS NULL OR m - lag(m) OVER w > 1.0 THEN 1 ELSE 0 END AS o FROM rd WINDOW w AS (PARTITION BY episode_idx, stream ORDER BY m)),
p AS (SELECT *, sum(o) OVER (PARTITION BY episode_idx, stream ORDER BY m ROWS UNBOUNDED PRECEDING) AS part FROM o) SELECT episode_idx, stream, CAST(part AS BIGINT) AS part, min(m) AS first_s, max(m) AS last_s, count(*) AS n FROM p GROUP BY 1, 2, 3"""


def latch(spark: SparkSession, folder: str) -> DataFrame:
    """Latch of each user's event stream: an error event is a fault."""
    rows = _events(spark, folder).withColumn("fault", F.col("event_type") == "error")
    return runtime.latched(rows, by=["user_id"], order="event_id", fault="fault", at_s="at", grace_s=86400.0).select("event_id", "state", "epoch")


LATCH_SQL = "WITH " + EV_SQL + """, k AS (SELECT event_id, user_id, event_type = 'error' AS bad, coalesce(max(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ok, ats - min(ats) OVER (PARTITION BY user_id) AS age FROM ev),
l AS (SELECT *, max(CASE WHEN bad AND (ok = 1 OR age >= 86400) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS l FROM k) SELECT event_id, CASE WHEN l = 1 THEN 'latched' WHEN ok = 1 OR NOT bad THEN 'armed' ELSE 'starting' END AS state, l AS epoch FROM l"""


def homing(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder)
    return runtime.homing_result(rows, by=["user_id"], order="event_id", status=F.col("event_type"), active=["click"], done=["purchase"], failed=["err"])


HOMING_SQL = """WITH e AS (SELECT user_id, event_id, CASE WHEN contains(lower(event_type), 'err') THEN 'failed' WHEN lower(event_type) = 'purchase' AND max(CASE WHEN lower(event_type) = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) = 1 THEN 'succeeded' END AS o FROM events)
SELECT user_id, arg_min(o, event_id) AS outcome, min(event_id) AS at FROM e WHERE o IS NOT NULL GROUP BY 1"""


def refill(spark: SparkSession, folder: str) -> DataFrame:
    """Queue arithmetic with the orders' numbers as delays and latencies."""
    k = F.col("o_orderkey").cast("int")
    rows = table(spark, folder, "orders").select("o_orderkey", F.pmod(k, F.lit(23)).alias("delay"), ((F.pmod(k, F.lit(37)) + 1) / 100.0).alias("latency"), (F.pmod(k, F.lit(11)) / 10.0).alias("age"))
    r = rates.refill_readiness(chunk=F.lit(50), delay=F.col("delay"), latency=F.col("latency"), rate=F.lit(30.0), threshold=F.lit(25), age=F.col("age"), max_age=F.lit(2.0), horizon=F.lit(35))
    rows = rows.withColumn("r", r)
    return rows.select("o_orderkey", F.col("r.q_start").cast("int").alias("q_start"), F.col("r.q_required").cast("int").alias("q_required"), F.col("r.delay_bound").cast("bigint").alias("delay_bound"), F.round("r.next_age", 6).alias("next_age"), F.col("r.overlap").cast("bigint").alias("overlap"), F.array_join("r.failures", ",").alias("failures"), "r.sustainable")


REFILL_SQL = """WITH o AS (SELECT o_orderkey, CAST(o_orderkey AS INTEGER) % 23 AS d, (CAST(o_orderkey AS INTEGER) % 37 + 1) / 100.0 AS l, (CAST(o_orderkey AS INTEGER) % 11) / 10.0 AS a FROM orders),
q AS (SELECT *, greatest(0, 50 - d) AS s FROM o), w AS (SELECT *, greatest(0, s - 25) AS w FROM q), x AS (SELECT *, greatest(0, s - w - 1) AS rq, CAST(ceil(CAST(l AS DOUBLE) * 30.0) AS BIGINT) + 2 AS b, CAST(a AS DOUBLE) + (w + 1) / 30.0 + CAST(l AS DOUBLE) + 2 / 30.0 AS na FROM w),
y AS (SELECT *, greatest(0, least(35, rq) - b) AS ov FROM x), z AS (SELECT *, array_to_string(list_filter([CASE WHEN s <= 0 THEN 'empty_queue' END, CASE WHEN rq < b + 1 THEN 'coverage' END, CASE WHEN na >= 2.0 THEN 'source_age' END, CASE WHEN ov < 3 THEN 'overlap' END], lambda t: t IS NOT NULL), ',') AS f FROM y)
SELECT o_orderkey, CAST(s AS INTEGER) AS q_start, CAST(rq AS INTEGER) AS q_required, b AS delay_bound, round(na, 6) AS next_age, CAST(ov AS BIGINT) AS overlap, f AS failures, f = '' AS sustainable FROM z"""


def bottlenecks(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "topic_reports").where((F.col("avg_fps") > 0) & ~F.isnan("avg_fps")).select("episode", "topic", "avg_fps", F.lit(60.0).alias("expected"))
    return runtime.slow_streams(rows, ["episode"], "topic", "avg_fps", "expected")


def _limited(spark: SparkSession, folder: str) -> DataFrame:
    limits = table(spark, folder, "joint_limits")
    return table(spark, folder, "predictions").select("episode_idx", "t", "joint", "obs_state").where("obs_state IS NOT NULL").distinct().join(limits, "joint")


def saturation(spark: SparkSession, folder: str) -> DataFrame:
    """Per joint: readings that a mechanical stop clips, and the sum of what is left of finite ones."""
    rows = _limited(spark, folder).where(~F.isnan("obs_state") & (F.abs("obs_state") != float("inf")))
    s = runtime.saturated(F.col("obs_state"), F.col("lower_limit"), F.col("upper_limit"), F.col("saturate_margin"))
    return rows.withColumn("s", s).groupBy("joint").agg(F.count_if(F.col("s") != F.col("obs_state")).alias("clipped"), F.round(F.sum("s"), 4).alias("total"))


SATURATION_SQL = """WITH r AS (SELECT DISTINCT episode_idx, t, joint, obs_state AS v FROM predictions WHERE isfinite(obs_state)), s AS (SELECT joint, v, CASE WHEN saturate_margin IS NOT NULL AND v >= lower_limit - saturate_margin AND v <= upper_limit + saturate_margin THEN greatest(lower_limit, least(upper_limit, v)) ELSE v END AS s FROM r JOIN joint_limits USING (joint))
SELECT joint, count(*) FILTER (s <> v) AS clipped, round(sum(s), 4) AS total FROM s GROUP BY 1"""


def targets(spark: SparkSession, folder: str) -> DataFrame:
    rows = _limited(spark, folder).withColumn("c", runtime.target_check(F.col("obs_state"), F.col("lower_limit"), F.col("upper_limit"), F.lit(0.05)))
    return rows.groupBy("joint", F.coalesce("c.error", F.lit("ok")).alias("result")).agg(F.count(F.lit(1)).alias("n"))


TARGET_SQL = "WITH r AS (SELECT DISTINCT episode_idx, t, joint, obs_state AS v FROM predictions WHERE obs_state IS NOT NULL) SELECT joint, CASE WHEN NOT isfinite(v) THEN 'not_finite' WHEN v < lower_limit - 0.05 OR v > upper_limit + 0.05 THEN 'out_of_limits' ELSE 'ok' END AS result, count(*) AS n FROM r JOIN joint_limits USING (joint) GROUP BY 1, 2"


def pose_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Frames in which every joint is within 0.5 of the middle of its limits and moves at most 0.05 a frame."""
    rows = table(spark, folder, "predictions").where("obs_state IS NOT NULL").groupBy("episode_idx", "t", "joint").agg(F.min("obs_state").alias("position"))
    rows = rows.withColumn("velocity", F.coalesce(F.col("position") - F.lag("position").over(Window.partitionBy("episode_idx", "joint").orderBy("t")), F.lit(0.0)))
    # The contract is configuration of one rig; one with too many joints is refused by the operator, none is left out.
    limits = table(spark, folder, "joint_limits").orderBy("joint").take(runtime.MOST_JOINTS + 1)
    contract = [(r.joint, (r.lower_limit + r.upper_limit) / 2, 0.5, 0.05) for r in limits]
    return runtime.pose_gate(rows, contract, by=["episode_idx", "t"])


POSE_SQL = """WITH p AS (SELECT episode_idx, t, joint, min(obs_state) AS p FROM predictions WHERE obs_state IS NOT NULL GROUP BY 1, 2, 3), v AS (SELECT *, coalesce(p - lag(p) OVER (PARTITION BY episode_idx, joint ORDER BY t), 0.0) AS v FROM p),
c AS (SELECT joint, (lower_limit + upper_limit) / 2 AS g FROM joint_limits), k AS (SELECT DISTINCT episode_idx, t FROM p),
x AS (SELECT k.episode_idx, k.t, c.joint, CASE WHEN p IS NULL AND v IS NULL THEN 'missing' WHEN NOT isfinite(p) OR NOT isfinite(v) THEN 'non_finite' WHEN abs(p - g) > 0.5 THEN 'position' WHEN abs(v) > 0.05 THEN 'velocity' END AS why FROM k CROSS JOIN c LEFT JOIN v ON v.episode_idx = k.episode_idx AND v.t = k.t AND v.joint = c.joint),
y AS (SELECT *, CASE why WHEN 'missing' THEN 0 ELSE 1 END AS o FROM x WHERE why IS NOT NULL), z AS (SELECT episode_idx, t, why, joint FROM y QUALIFY row_number() OVER (PARTITION BY episode_idx, t ORDER BY o, joint) = 1)
SELECT episode_idx, t, why IS NULL AS ok, why AS reason, joint FROM k LEFT JOIN z USING (episode_idx, t)"""


def refused(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder).select("event_id", (F.col("event_id") % 3).alias("epoch"), F.lit(1).cast("bigint").alias("current"), (F.col("value") - 5).alias("age"))
    return runtime.authorized(rows, epoch="epoch", current="current", age_s="age", most_s=60.0).select("event_id", "refused")


REFUSED_SQL = "SELECT event_id, CASE WHEN event_id % 3 <> 1 THEN 'epoch' WHEN value - 5 < 0 OR value IS NULL THEN 'invalid_time' WHEN value - 5 > 60 THEN 'too_old' END AS refused FROM events"


def complete(spark: SparkSession, folder: str) -> DataFrame:
    return runtime.complete_observations(table(spark, folder, "sensor_readings"), ["episode_idx"], "stream", ["joint_states", "waist", "chest", "wrist_l", "wrist_r"])


COMPLETE_SQL = "SELECT episode_idx, count(DISTINCT stream) FILTER (stream IN ('joint_states', 'waist', 'chest', 'wrist_l', 'wrist_r')) = 5 AS complete FROM sensor_readings GROUP BY 1"


def still(spark: SparkSession, folder: str) -> DataFrame:
    return runtime.still(_vectors(spark, folder), by=["episode_idx"], order="t", vector="state", most=0.01).select("episode_idx", "t", "still")


STILL_SQL = """WITH vec AS (SELECT episode_idx, t, list(obs_state ORDER BY joint) AS s FROM (SELECT DISTINCT episode_idx, t, joint, ground_truth, obs_state FROM predictions) GROUP BY 1, 2 HAVING bool_and(coalesce(isfinite(ground_truth) AND isfinite(obs_state), false))),
b AS (SELECT *, lag(s) OVER (PARTITION BY episode_idx ORDER BY t) AS b FROM vec) SELECT episode_idx, t, coalesce(len(b) = len(s) AND list_max(list_transform(s, lambda x, i: abs(x - b[i]))) <= 0.01, false) AS still FROM b"""


def drift(spark: SparkSession, folder: str) -> DataFrame:
    """Largest minus smallest of each episode's last reading times by camera."""
    rows = _readings(spark, folder).groupBy("episode_idx").agg(*(F.max(F.when(F.col("stream") == s, F.col("m"))).alias(s) for s in ("waist", "chest", "wrist_l", "wrist_r")))
    return rows.select("episode_idx", F.round(rates.time_drift("waist", "chest", "wrist_l", "wrist_r"), 6).alias("drift"))


DRIFT_SQL = "WITH " + ROW_SQL + ", l AS (SELECT episode_idx, stream, max(m) AS m FROM rd WHERE stream <> 'joint_states' GROUP BY 1, 2), e AS (SELECT DISTINCT episode_idx FROM rd) SELECT episode_idx, round(CASE WHEN count(m) >= 2 THEN max(m) - min(m) END, 6) AS drift FROM e LEFT JOIN l USING (episode_idx) GROUP BY 1"


def jpeg_markers(spark: SparkSession, folder: str) -> DataFrame:
    """Envelope check of byte strings made from the documents' texts: some with both JPEG markers, some with one, some cut."""
    k = F.pmod("doc_id", F.lit(4))
    body = F.coalesce("text", F.lit("")).cast("binary")
    soi, eoi = F.unhex(F.lit("FFD8")), F.unhex(F.lit("FFD9"))
    data = F.when(k == 0, F.concat(soi, body, eoi)).when(k == 1, F.concat(soi, body)).when(k == 2, F.concat(body, eoi)).otherwise(soi)
    rows = table(spark, folder, "documents").select("doc_id", imagebytes.jpeg_fault(data).alias("fault"))
    return rows.groupBy(F.coalesce("fault", F.lit("ok")).alias("fault")).agg(F.count(F.lit(1)).alias("n"))


JPEG_SQL = """WITH d AS (SELECT doc_id % 4 AS k, octet_length(encode(coalesce(text, ''))) AS n FROM documents)
SELECT CASE k WHEN 0 THEN 'ok' WHEN 1 THEN CASE WHEN n + 2 < 4 THEN 'invalid_jpeg_markers' ELSE 'missing_eoi' END WHEN 2 THEN CASE WHEN n + 2 < 4 THEN 'invalid_jpeg_markers' ELSE 'missing_soi' END ELSE 'invalid_jpeg_markers' END AS fault, count(*) AS n FROM d GROUP BY 1"""


# Calibration ------------------------------------------------------------------------------------------------------
def _corners(spark: SparkSession, folder: str) -> DataFrame:
    """Corners of a board: pairs of an embedding's numbers as pixels of a 640 x 480 image."""
    e = table(spark, folder, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("i", "x"))
    pair = e.groupBy("label", "vec_id", F.expr("i div 2").alias("corner")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("x"))).cast("double").alias("u"), F.max(F.when(F.col("i") % 2 == 1, F.col("x"))).cast("double").alias("v"))
    return pair.select("label", "vec_id", "corner", (320 + 100 * F.col("u")).alias("x"), (240 + 100 * F.col("v")).alias("y"), F.lit(640).alias("w"), F.lit(480).alias("h"), "u", "v")


CORNERS_SQL = "cn AS (SELECT label, vec_id, i AS corner, CAST(embedding[2 * i + 1] AS DOUBLE) AS u, CAST(embedding[2 * i + 2] AS DOUBLE) AS v FROM (SELECT label, vec_id, embedding, unnest(range(0, len(embedding) // 2)) AS i FROM embeddings))"


def coverage_grid(spark: SparkSession, folder: str) -> DataFrame:
    return calibration.coverage_grid(_corners(spark, folder), ["label"], "x", "y", "w", "h")


GRID_SQL = "WITH " + CORNERS_SQL + " SELECT label, count(DISTINCT greatest(0, least(7, floor((320 + 100 * u) / 640 * 8))) * 8 + greatest(0, least(7, floor((240 + 100 * v) / 480 * 8)))) / 64 AS coverage FROM cn GROUP BY 1"


def residual_rms(spark: SparkSession, folder: str) -> DataFrame:
    out = calibration.residual_rms(_corners(spark, folder), ["label"], "u", "v", "vec_id")
    return out.select("label", *(F.round(c, 6).alias(c) for c in ("rms", "rms_even", "rms_odd")))


RMS_SQL = "WITH " + CORNERS_SQL + " SELECT label, round(sqrt(avg(u * u + v * v)), 6) AS rms, round(sqrt(avg(u * u + v * v) FILTER (vec_id % 2 = 0)), 6) AS rms_even, round(sqrt(avg(u * u + v * v) FILTER (vec_id % 2 = 1)), 6) AS rms_odd FROM cn GROUP BY 1"


def calibration_report(spark: SparkSession, folder: str) -> DataFrame:
    views = calibration.view_counts(table(spark, folder, "embeddings").select("label", "vec_id"), "label")
    rows = coverage_grid(spark, folder).join(residual_rms(spark, folder), "label").join(views, "label").withColumn("factory_rms", F.col("rms_even"))
    return calibration.recommendation(rows, least_coverage=0.2).select("label", "views", "enough", "coverage", "rms", "recommendation")


REPORT_SQL = "WITH " + CORNERS_SQL + """, g AS (SELECT label, count(DISTINCT greatest(0, least(7, floor((320 + 100 * u) / 640 * 8))) * 8 + greatest(0, least(7, floor((240 + 100 * v) / 480 * 8)))) / 64 AS coverage, round(sqrt(avg(u * u + v * v)), 6) AS rms, round(sqrt(avg(u * u + v * v) FILTER (vec_id % 2 = 0)), 6) AS f, count(DISTINCT vec_id) AS views FROM cn GROUP BY 1)
SELECT label, views, views >= 12 AS enough, coverage, rms, CASE WHEN coverage >= 0.2 AND rms <= f + 0.02 THEN 'use_new' ELSE 'keep_factory' END AS recommendation FROM g"""


def novel_views(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("label", "vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 3).alias("pose"))
    return calibration.novel_views(rows, "label", "vec_id", "pose", 0.15)


def board_still(spark: SparkSession, folder: str) -> DataFrame:
    rows = _corners(spark, folder).withColumn("tick", F.dense_rank().over(Window.partitionBy("label", "corner").orderBy("vec_id")))
    return calibration.board_still(rows, ["label"], "tick", "corner", "x", "y", 12.0).select("label", "tick", "common", F.round("shift", 6).alias("shift"), "still")


BOARD_SQL = "WITH " + CORNERS_SQL + """, t AS (SELECT *, dense_rank() OVER (PARTITION BY label, corner ORDER BY vec_id) AS tick, 320 + 100 * u AS x, 240 + 100 * v AS y FROM cn),
d AS (SELECT label, tick, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS d FROM t WINDOW w AS (PARTITION BY label, corner ORDER BY tick)) SELECT label, CAST(tick AS INTEGER) AS tick, count(*) AS common, round(median(d), 6) AS shift, count(*) >= 4 AND median(d) <= 12.0 AS still FROM d WHERE d IS NOT NULL GROUP BY 1, 2"""


def published(spark: SparkSession, folder: str) -> DataFrame:
    """Commands that a deadband lets through: a joint is published when what is pending reaches 0.02."""
    rows = table(spark, folder, "predictions").where("predicted IS NOT NULL").groupBy("episode_idx", "joint", "t").agg(F.min("predicted").alias("predicted"))
    return deadband.deadband(rows, by=["episode_idx", "joint"], order="t", value="predicted", threshold=0.02)


QUERIES = {
    "smoothness_rolling": (smoothness, SMOOTH_SQL),
    "latency_rolling": (latency, LATENCY_SQL),
    "counter_rates": (counters, COUNTER_SQL),
    "rate_windows": (windows, WINDOW_SQL),
    "stream_totals": (stream_totals, TOTALS_SQL),
    "bad_frame_reasons": (bad_frames, BAD_SQL),
    "sequence_advance": (advances, ADVANCE_SQL),
    "settle_islands": (settle, SETTLE_SQL),
    "silence_sessions": (silences, SILENCE_SQL),
    "watchdog_latch": (latch, LATCH_SQL),
    "homing_result": (homing, HOMING_SQL),
    "readiness_math": (refill, REFILL_SQL),
    "bottleneck_streams": (bottlenecks, "SELECT episode, arg_min(topic, {'r': avg_fps, 't': topic}) AS bottleneck, min(avg_fps) AS rate FROM topic_reports WHERE avg_fps > 0 AND NOT isnan(avg_fps) AND avg_fps < 40 GROUP BY 1"),
    "saturate_stops": (saturation, SATURATION_SQL),
    "target_check": (targets, TARGET_SQL),
    "pose_gate": (pose_gate, POSE_SQL),
    "refused_actions": (refused, REFUSED_SQL),
    "complete_observations": (complete, COMPLETE_SQL),
    "still_frames": (still, STILL_SQL),
    "time_drift": (drift, DRIFT_SQL),
    "jpeg_markers": (jpeg_markers, JPEG_SQL),
    "coverage_grid": (coverage_grid, GRID_SQL),
    "residual_rms": (residual_rms, RMS_SQL),
    "calibration_report": (calibration_report, REPORT_SQL),
    "novel_views": (novel_views, None),
    "board_still": (board_still, BOARD_SQL),
    "deadband": (published, None),
}

