"""Analytics of running systems: rates, smoothness, advances, settling, limits, latches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest number of joints of a contract.
MOST_JOINTS = 256


def rolling_smoothness(rows: DataFrame, *, by: list[str], order: str, vector_step: str, clamped: str | None = None, window: int = 100) -> DataFrame:
    """Mean, deviation and maximum of the last ``window`` steps and mean and maximum of their jerk; share of clamped steps over all so far.

    ``vector_step`` is the length of the step from the row before (NULL at the first).  NULL before the second step.
    """
    along = Window.partitionBy(*by).orderBy(order)
    last = along.rowsBetween(1 - window, 0)
    rows = rows.withColumn("_j", F.abs(F.col(vector_step) - F.lag(vector_step).over(along)))
    enough = F.count(vector_step).over(along.rowsBetween(Window.unboundedPreceding, 0)) >= 2
    stat = lambda f, c: F.when(enough, f(c).over(last))
    out = rows.withColumns({"step_mean": stat(F.avg, vector_step), "step_std": stat(F.stddev_pop, vector_step), "step_max": stat(F.max, vector_step), "jerk_mean": stat(F.avg, "_j"), "jerk_max": stat(F.max, "_j")})
    if clamped:
        out = out.withColumn("clamped_pct", F.when(enough, 100 * F.avg(F.col(clamped).cast("double")).over(along.rowsBetween(Window.unboundedPreceding, 0))))
    return out.drop("_j")


def rolling_latency(rows: DataFrame, *, by: list[str], order: str, latency: str, window: int) -> DataFrame:
    """Mean, deviation and maximum of the last latencies; 0 where there is none."""
    last = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - window, 0)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return rows.withColumns({"latency_mean": zero(F.avg(latency).over(last)), "latency_std": zero(F.stddev_pop(latency).over(last)), "latency_max": zero(F.max(latency).over(last))})


def counter_rates(rows: DataFrame, *, by: list[str], at_s: str, counter: str, least_s: float = 0.001) -> DataFrame:
    """Rate of a counter between successive reports."""
    along = Window.partitionBy(*by).orderBy(at_s)
    dt = F.greatest(F.col(at_s) - F.lag(at_s).over(along), F.lit(least_s))
    return rows.withColumn("rate", (F.col(counter) - F.lag(counter).over(along)) / dt)


def window_rates(rows: DataFrame, *, by: list[str], at: str, width: str) -> DataFrame:
    """Rows and rate per second in tumbling windows of a timestamp."""
    w = F.window(at, width)
    out = rows.groupBy(*by, w.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    seconds = F.unix_micros(F.col("w.end").cast("timestamp")) - F.unix_micros(F.col("w.start").cast("timestamp"))
    return out.select(*by, F.col("w.start").alias("window_start"), "n", (F.col("n") / (seconds / 1e6)).alias("rate"))


def totals(rows: DataFrame, *, by: list[str], at_s: str, least_s: float = 0.001) -> DataFrame:
    """Count and mean rate over the elapsed time."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) / F.greatest(F.max(at_s) - F.min(at_s), F.lit(least_s))).alias("rate"))


def reason_counts(rows: DataFrame, by: list[str], reason: str) -> DataFrame:
    return rows.where(F.col(reason).isNotNull()).groupBy(*by, reason).agg(F.count(F.lit(1)).alias("n"))


def sequence_faults(rows: DataFrame, *, by: list[str], order: str, sequence: str) -> DataFrame:
    """Rows whose sequence number doesn't grow over the one before, with what it was."""
    before = F.lag(sequence).over(Window.partitionBy(*by).orderBy(order))
    return rows.withColumn("previous", before).where(F.col("previous").isNotNull() & (F.col(sequence) <= F.col("previous")))


def settled(rows: DataFrame, *, by: list[str], order: str, at_s: str, valid: str, seconds: float, samples: int) -> DataFrame:
    """Islands of valid samples: start, end, samples, and whether the island lasts long enough with enough samples."""
    along = Window.partitionBy(*by).orderBy(order)
    island = F.sum((~F.coalesce(F.col(valid), F.lit(False))).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    runs = rows.withColumn("_i", island).where(F.col(valid))
    out = runs.groupBy(*by, "_i").agg(F.min(at_s).alias("since"), F.max(at_s).alias("until"), F.count(F.lit(1)).alias("samples"))
    return out.select(*by, "since", "until", "samples", ((F.col("until") - F.col("since") >= seconds) & (F.col("samples") >= samples)).alias("settled"))


def silence_sessions(rows: DataFrame, *, by: list[str], ts_s: str, gap_s: float) -> DataFrame:
    """Parts of a stream between silences longer than ``gap_s``: number, first, last, rows."""
    along = Window.partitionBy(*by).orderBy(ts_s)
    opens = F.when(F.lag(ts_s).over(along).isNull() | (F.col(ts_s) - F.lag(ts_s).over(along) > gap_s), 1).otherwise(0)
    parts = rows.withColumn("_o", opens).withColumn("part", F.sum("_o").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy(*by, "part").agg(F.min(ts_s).alias("first_s"), F.max(ts_s).alias("last_s"), F.count(F.lit(1)).alias("n"))


def latched(rows: DataFrame, *, by: list[str], order: str, fault: str, at_s: str, grace_s: float = 0.0) -> DataFrame:
    """State of a latch without rearm: starting, armed or latched, and the epoch.

    It arms at the first healthy row.  A fault latches for good once armed, or once ``grace_s`` has passed since the start.
    """
    along = Window.partitionBy(*by).orderBy(order)
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    bad = F.coalesce(F.col(fault), F.lit(True))
    rows = rows.withColumns({"_ok": F.max((~bad).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, -1)), "_t0": F.min(at_s).over(Window.partitionBy(*by))})
    trips = bad & ((F.coalesce("_ok", F.lit(0)) == 1) | (F.col(at_s) - F.col("_t0") >= grace_s))
    rows = rows.withColumn("_l", F.max(trips.cast("int")).over(upto))
    state = F.when(F.col("_l") == 1, "latched").when((F.coalesce("_ok", F.lit(0)) == 1) | ~bad, "armed").otherwise("starting")
    return rows.withColumns({"state": state, "epoch": F.col("_l")}).drop("_ok", "_t0", "_l")


def homing_result(rows: DataFrame, *, by: list[str], order: str, status: str, active: list[str], done: list[str], failed: list[str]) -> DataFrame:
    """First outcome of a homing run: success counts only after an active state, failures always."""
    along = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    s = F.lower(status)
    seen = F.max(s.isin(active).cast("int")).over(along) == 1
    fails = F.lit(False)
    for word in failed:
        fails = fails | F.contains(s, F.lit(word))
    outcome = F.when(fails, "failed").when(seen & s.isin(done), "succeeded")
    marked = rows.withColumn("_out", outcome).where(F.col("_out").isNotNull())
    return marked.groupBy(*by).agg(F.min_by("_out", order).alias("outcome"), F.min(order).alias("at"))


def saturated(value: Column, low: Column, high: Column, margin: Column) -> Column:
    """A value clipped to its limits, but only within ``margin`` beyond them (NULL margin: never)."""
    near = margin.isNotNull() & (value >= low - margin) & (value <= high + margin)
    return F.when(near, F.greatest(low, F.least(high, value))).otherwise(value)


def target_check(value: Column, low: Column, high: Column, tolerance: Column) -> Column:
    """STRUCT<value, error>: clipped to the limits, or an error code if beyond the tolerance or not finite."""
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    beyond = (value < low - tolerance) | (value > high + tolerance)
    error = F.when(bad, "not_finite").when(beyond, "out_of_limits")
    return F.struct(F.when(error.isNull(), F.greatest(low, F.least(high, value))).alias("value"), error.alias("error"))


def slow_streams(rows: DataFrame, by: list[str], stream: str, rate: str, expected: str) -> DataFrame:
    """The slowest of the streams that run below two thirds of the expected rate."""
    slow = rows.where(F.col(rate) < F.col(expected) * 2 / 3)
    return slow.groupBy(*by).agg(F.min_by(stream, F.struct(rate, stream)).alias("bottleneck"), F.min(rate).alias("rate"))


def pose_gate(samples: DataFrame, contract: list[tuple[str, float, float, float]], *, by: list[str]) -> DataFrame:
    """Per sample: whether every joint of the contract (joint, target, position and velocity tolerance) holds, and the first reason if not.

    ``samples`` are long rows (by, joint, position, velocity); a joint that isn't there fails as missing, before any other reason.
    The contract is configuration, at most MOST_JOINTS joints, and goes into the plan as a literal.
    """
    if not 0 < len(contract) <= MOST_JOINTS:
        raise ValueError("a contract has 1 to MOST_JOINTS joints")
    wish = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(j).alias("joint"), F.lit(float(t)).alias("target"), F.lit(float(p)).alias("position_tolerance"), F.lit(float(v)).alias("velocity_tolerance")) for i, (j, t, p, v) in enumerate(contract)))
    wanted = samples.select(*by).distinct().select(*by, F.inline(wish))
    rows = wanted.join(samples, [*by, "joint"], "left")
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    reason = (
        F.when(F.col("position").isNull() & F.col("velocity").isNull(), F.struct(F.lit(0).alias("o"), "place", F.lit("missing").alias("why")))
        .when(~finite("position") | ~finite("velocity"), F.struct(F.lit(1).alias("o"), "place", F.lit("non_finite").alias("why")))
        .when(F.abs(F.col("position") - F.col("target")) > F.col("position_tolerance"), F.struct(F.lit(1).alias("o"), "place", F.lit("position").alias("why")))
        .when(F.abs("velocity") > F.col("velocity_tolerance"), F.struct(F.lit(1).alias("o"), "place", F.lit("velocity").alias("why")))
    )
    out = rows.groupBy(*by).agg(F.min(F.when(reason.isNotNull(), F.struct(reason["o"].alias("o"), reason["place"].alias("place"), reason["why"].alias("why"), F.col("joint")))).alias("r"))
    return out.select(*by, F.col("r").isNull().alias("ok"), F.col("r.why").alias("reason"), F.col("r.joint").alias("joint"))


def joint_message_faults(names: Column, positions: Column, required: list[str] | None = None) -> Column:
    """Codes of what is wrong with a joint message: lengths, repeats, missing and non-finite joints."""
    wanted = F.array(*(F.lit(r) for r in required)) if required else F.array().cast("array<string>")
    broken = F.exists(positions, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.array_compact(F.array(F.when(F.size(names) != F.size(positions), "length"), F.when(F.size(F.array_distinct(names)) != F.size(names), "repeated"), F.when(F.size(F.array_except(wanted, names)) > 0, "missing"), F.when(broken, "non_finite")))


def observation_vector(values: Column, arms: list[str], joints: list[str]) -> Column:
    """Vector of a MAP<STRING, DOUBLE> ``arm_joint`` in sorted arm order times joint order; NULL unless every value is there and finite."""
    vector = F.array(*(F.try_element_at(values, F.lit(f"{a}_{j}")) for a in sorted(arms) for j in joints))
    return F.when(~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), vector)


def complete_observations(rows: DataFrame, by: list[str], stream: str, needed: list[str]) -> DataFrame:
    """Whether each key has all needed streams."""
    return rows.groupBy(*by).agg(F.bool_and(F.lit(True)).alias("_x"), F.countDistinct(F.when(F.col(stream).isin(needed), F.col(stream))).alias("n")).select(*by, (F.col("n") == len(needed)).alias("complete"))


def authorized(rows: DataFrame, *, epoch: str, current: str, age_s: str, most_s: float) -> DataFrame:
    """Queued actions with the reason they are refused: another epoch, no or negative age, too old."""
    age = F.col(age_s)
    why = F.when(~F.col(epoch).eqNullSafe(F.col(current)), "epoch").when(age.isNull() | F.isnan(age) | (age < 0), "invalid_time").when(age > most_s, "too_old")
    return rows.withColumn("refused", why)


def still(rows: DataFrame, *, by: list[str], order: str, vector: str, most: float) -> DataFrame:
    """Whether the largest change of any joint since the tick before is at most ``most``; false without an equally long one."""
    before = F.lag(vector).over(Window.partitionBy(*by).orderBy(order))
    rows = rows.withColumn("_b", before)
    change = F.array_max(F.zip_with("_b", vector, lambda a, b: F.abs(a - b)))
    return rows.withColumn("still", F.coalesce((F.size("_b") == F.size(vector)) & (change <= most), F.lit(False))).drop("_b")
