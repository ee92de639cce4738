"""Rates, durations, sizes, and the arithmetic of queue refills."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rates that recordings run at.
COMMON_RATES = (15, 20, 24, 25, 30, 50, 60)


def snap_rate(rate: Column, tolerance: float = 0.15) -> Column:
    """The common rate nearest to ``rate`` within ``tolerance`` of it (ties: the lowest), else the nearest multiple of 5 from 5 up (half to even)."""
    near = F.filter(F.array(*(F.lit(float(r)) for r in COMMON_RATES)), lambda r: F.abs(rate - r) / r <= tolerance)
    best = F.array_min(F.transform(near, lambda r: F.struct(F.abs(rate - r).alias("d"), r.alias("r"))))["r"]
    return F.coalesce(best, F.greatest(F.lit(5.0), F.rint(rate / 5) * 5)).cast("int")


def normalize_timestamp(value: Column) -> Column:
    """Nanoseconds (beyond a million in magnitude) to seconds."""
    return F.when(F.abs(value) > 1e6, value / 1e9).otherwise(value.cast("double"))


def output_height(width: Column, height: Column, new_width: int) -> Column:
    """Even height that keeps the aspect ratio at a new width."""
    return F.greatest(F.lit(2), F.rint(height * new_width / width / 2).cast("int") * 2)


def same_aspect(w1: Column, h1: Column, w2: Column, h2: Column, tolerance: float = 0.01) -> Column:
    a, b = w1 / h1, w2 / h2
    return F.abs(a - b) <= tolerance * F.greatest(a, b)


def duration_text(seconds: Column) -> Column:
    """Seconds as ``12.3s``, ``4m 05s`` or ``1h 02m``."""
    whole = F.floor(seconds).cast("bigint")
    part = lambda unit, of: F.call_function("div", F.pmod(whole, F.lit(of)), F.lit(unit)).cast("string")
    return (
        F.when(seconds < 60, F.format_string("%.1fs", seconds))
        .when(seconds < 3600, F.concat(F.call_function("div", whole, F.lit(60)).cast("string"), F.lit("m "), F.lpad(part(1, 60), 2, "0"), F.lit("s")))
        .otherwise(F.concat(F.call_function("div", whole, F.lit(3600)).cast("string"), F.lit("h "), F.lpad(part(60, 3600), 2, "0"), F.lit("m")))
    )


def time_drift(*stamps: Column) -> Column:
    """Largest minus smallest of the stamps that are there; NULL with fewer than two."""
    there = F.array_compact(F.array(*stamps))
    return F.when(F.size(there) >= 2, F.array_max(there) - F.array_min(there))


def refill_delay_steps(latest: Column, rate: Column, fallback: Column) -> Column:
    """Steps that pass during the longest inference; the fallback without one."""
    return F.when(latest > 0, F.ceil(latest * rate)).otherwise(fallback)


def waits_for_refill(queue: Column, threshold: Column, ready: Column) -> Column:
    return ready & (queue > threshold)


def refill_readiness(*, chunk: Column, delay: Column, latency: Column, rate: Column, threshold: Column, age: Column, max_age: Column, horizon: Column, latency_guard: int = 2, scheduler_guard: int = 1, min_overlap: int = 3) -> Column:
    """Whether a chunk survives until the refill after the next, with each quantity and the codes of what fails."""
    zero = F.lit(0)
    start = F.greatest(zero, chunk - delay)
    wait = F.greatest(zero, start - threshold)
    required = F.greatest(zero, start - wait - scheduler_guard)
    bound = F.ceil(latency * rate) + latency_guard
    next_age = age + (wait + scheduler_guard) / rate + latency + latency_guard / rate
    overlap = F.greatest(zero, F.least(horizon, required) - bound)
    failures = F.array_compact(F.array(F.when(start <= 0, "empty_queue"), F.when(required < bound + 1, "coverage"), F.when(next_age >= max_age, "source_age"), F.when(overlap < min_overlap, "overlap")))
    return F.struct(start.alias("q_start"), wait.alias("wait_steps"), required.alias("q_required"), bound.alias("delay_bound"), next_age.alias("next_age"), overlap.alias("overlap"), failures.alias("failures"), (F.size(failures) == 0).alias("sustainable"))


def merge_alignment(*, same_queue: Column, queue_before: Column, queue_at: Column, index_before: Column, index_at: Column, requested_s: Column, merged_s: Column, rate: Column, ready: Column, tolerance: int = 1) -> Column:
    """How many steps passed while a chunk was inferred, or the code of why the merge is invalid.

    Once ready, what the queue consumed counts, bounded by what the elapsed time explains (plus ``tolerance`` steps); before,
    nothing may have been consumed and the elapsed steps count.
    """
    wall = F.ceil((merged_s - requested_s) * rate)
    consumed = index_at - index_before
    error = (
        F.when(F.isnan(requested_s) | F.isnan(merged_s) | (merged_s < requested_s) | ~(rate > 0), "timing")
        .when(~same_queue, "queue_changed")
        .when((queue_before < 0) | (queue_at < 0) | (index_before < 0) | (consumed < 0), "regressed")
        .when(queue_before - queue_at != consumed, "mismatch")
        .when(~ready & (consumed != 0), "consumed_before_ready")
        .when(ready & (queue_at < 1), "queue_empty")
        .when(ready & (consumed > wall + tolerance), "consumed_too_much")
    )
    return F.struct(wall.alias("wall_steps"), consumed.alias("consumed_steps"), F.when(error.isNull(), F.when(ready, consumed).otherwise(wall)).alias("delay_steps"), error.alias("error"))
