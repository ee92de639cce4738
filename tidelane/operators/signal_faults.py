"""Spikes, stuck values and impossible values in measurements, relative to each source's own behaviour.

A source is one entity and one measured field.  Its readings pass through a hidden Markov model
with the states normal, spike, stuck and out of range.  The evidence of a reading is how far it
leaves its neighbours in units of the source's median non-zero change, how long its run of one value
is against the source's median run, and the hard bounds.  Forward-backward probabilities give the
candidates; an exact check of the stated rule then decides each candidate.

Layout: readings are packed, before the shuffle, into one row per source and block of ``BLOCK`` frames,
so a source of any length is many small rows.  What crosses block borders (four neighbouring
readings, runs, medians) is exchanged through small summary rows.  The chain restarts at a block
border from its stationary start; the evidence does not, it is carried exactly, and a reading at its threshold
outweighs the start and the transitions on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.functions import segments
from tidelane.functions.chains import forward_backward
from tidelane.functions.integers import STAMP_LIMIT
from tidelane.operators.medians import grouped_median
from tidelane.plans.joins import join_null_safe
from tidelane.plans.lineage import cut

#: Frames per block; offsets in a block fit 16 bits.
BLOCK = 1 << 12
#: Readings handled at a time by a worker.
READINGS = 1 << 18
#: Neighbours that a block needs from each side: a spike has at most three frames and one neighbour beyond.
REACH = 4
STATES = ("normal", "spike", "stuck", "impossible")


@dataclass(frozen=True)
class FaultRule:
    """The stated rule and the model around it.

    A spike is one to ``spike_frames`` readings that leave the neighbours on both sides in one direction
    by more than ``spike_factor`` median non-zero changes.  A run is stuck if it has at least
    ``stuck_frames`` readings and ``stuck_factor`` median runs.  Readings whose posterior of the state
    reaches ``posterior`` are candidates.
    """

    spike_factor: float = 15.0
    spike_frames: int = 3
    stuck_frames: int = 24
    stuck_factor: float = 3.0
    posterior: float = 0.05

    def __post_init__(self) -> None:
        if not 1 <= self.spike_frames < REACH:
            raise ValueError(f"spike_frames must be 1 to {REACH - 1}")


#: Fixed values of the chain: where it starts, and the probability of the next state (columns) by state (rows).
INITIAL = np.array([0.97, 0.01, 0.01, 0.01])
TRANSITION = np.array([[0.997, 0.001, 0.001, 0.001], [0.50, 0.40, 0.05, 0.05], [0.02, 0.005, 0.97, 0.005], [0.50, 0.05, 0.05, 0.40]])


def group_median(values: np.ndarray, gid: np.ndarray, n_groups: int) -> np.ndarray:
    """Exact median per group; NaN where a group is empty."""
    order = np.lexsort((values, gid))
    values, gid = values[order], gid[order]
    start = np.searchsorted(gid, np.arange(n_groups + 1))
    count = np.diff(start)
    out = np.full(n_groups, np.nan)
    some = count > 0
    low, high = start[:-1][some] + (count[some] - 1) // 2, start[:-1][some] + count[some] // 2
    out[some] = (values[low] + values[high]) / 2
    return out


def run_table(values: np.ndarray, gid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of one value within its group."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (gid[1:] != gid[:-1])])
    return at, np.diff(np.r_[at, len(values)])


def leaving(values: np.ndarray, gid: np.ndarray, frames: int) -> np.ndarray:
    """How far each reading, in a run of up to ``frames``, leaves the neighbours on both sides in one direction (0 if it doesn't)."""
    out = np.zeros(len(values))
    for k in range(1, frames + 1):
        n = len(values) - k - 1
        if n < 1:
            break
        low = high = values[1 : 1 + n]
        for i in range(1, k):
            low, high = np.minimum(low, values[1 + i : 1 + i + n]), np.maximum(high, values[1 + i : 1 + i + n])
        left, right = values[:n], values[k + 1 :]
        gap = np.maximum(low - np.maximum(left, right), np.minimum(left, right) - high)
        gap[gid[:n] != gid[k + 1 :]] = 0
        for i in range(k):
            np.maximum(out[1 + i : 1 + i + n], gap, out=out[1 + i : 1 + i + n])
    return out


def likelihoods(leave: np.ndarray, run: np.ndarray, impossible: np.ndarray, rule: FaultRule) -> np.ndarray:
    """Likelihood of each reading under each state, up to a factor; ``leave`` and ``run`` as shares of the rule's thresholds."""
    out = np.ones((len(leave), len(STATES)))
    out[:, 1] = np.exp(np.clip(30 * (leave - 2 / 3), -30, 30))
    out[:, 2] = np.exp(np.clip(45 * (run - 0.8), -30, 30))
    out[:, 3] = 1e-12
    out[impossible] = [1e-12, 1e-12, 1e-12, 1.0]
    return out


def _pack(n_keys: int, n_fields: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(i) for i in range(n_keys)]
            stamp = batch.column(n_keys).to_numpy()
            block = np.floor_divide(stamp, BLOCK)
            gid, first = segments.group_numbers([*keys, pa.array(block)])
            for f in range(n_fields):
                column = batch.column(n_keys + 1 + f)
                there = np.asarray(column.is_valid())
                value = column.to_numpy(zero_copy_only=False)[there]
                g, t, v = _distinct(gid[there], stamp[there] - block[there] * BLOCK, value)
                groups, g = np.unique(g, return_inverse=True)
                if not len(groups):
                    continue
                at = pa.array(first[groups])
                arrays = [*(k.take(at) for k in keys), pa.array(np.full(len(groups), f, np.int32)), pa.array(block[first[groups]]), segments.lists_of(t.astype(np.int16), g, len(groups), pa.int16()), segments.lists_of(v, g, len(groups), pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*(f"k{i}" for i in range(n_keys)), "f", "blk", "t", "v"])

    return run


def _distinct(gid: np.ndarray, t: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by group and frame, one reading a frame (of several, the smallest)."""
    order = np.lexsort((v, t, gid))
    gid, t, v = gid[order], t[order], v[order]
    keep = np.r_[True, (gid[1:] != gid[:-1]) | (t[1:] != t[:-1])] if len(gid) else np.zeros(0, bool)
    return gid[keep], t[keep], v[keep]


def _slices(batch: pa.RecordBatch, lists: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose list column has about READINGS values each."""
    offsets = batch.column(lists).offsets.to_numpy()
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + READINGS, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _summarise(n_group: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted partial packs to one row per source and block, with what other blocks need of it."""

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [batch.column(i) for i in range(n_group)]
        n = batch.num_rows
        t, row = segments.flatten(batch.column(n_group))
        v, _ = segments.flatten(batch.column(n_group + 1))
        low, high = (batch.column(n_group + 2 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(2))
        fine = possible(v, low[row], high[row])
        pv, pg = v[fine], row[fine]
        count = np.bincount(pg, minlength=n)
        start = np.r_[0, np.cumsum(count)]
        inner = pg[1:] == pg[:-1]
        change = np.abs(np.diff(pv))[inner]
        changed = change > 0
        run_at, run_len = run_table(pv, pg)
        run_gid = pg[run_at]
        runs = np.bincount(run_gid, minlength=n)
        run_start = np.r_[0, np.cumsum(runs)]
        some = count > 0
        lead, trail = np.zeros(n, np.int64), np.zeros(n, np.int64)
        lead[some], trail[some] = run_len[run_start[:-1][some]], run_len[run_start[1:][some] - 1]
        rank = np.arange(len(pv)) - start[pg]
        is_head, is_tail = rank < REACH, rank >= count[pg] - REACH
        arrays = [
            *keys,
            *(batch.column(n_group + i) for i in range(4)),
            pa.array(count),
            segments.lists_of(pv[is_head], pg[is_head], n, pa.float64()),
            segments.lists_of(pv[is_tail], pg[is_tail], n, pa.float64()),
            pa.array(lead),
            pa.array(trail),
            pa.array(runs <= 1),
            pa.array(group_median(change[changed], pg[1:][inner][changed], n)),
            pa.array(group_median(run_len.astype(float), run_gid, n)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[*(batch.schema.names), "n", "head", "tail", "lead_len", "trail_len", "whole", "med_change", "med_run"])

    def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, _ = segments.group_numbers([batch.column(i) for i in range(n_group)])
        at = segments.segment_starts(raw)
        row_gid = np.cumsum(np.r_[True, raw[1:] != raw[:-1]]) - 1
        t, row = segments.flatten(batch.column(n_group))
        v, _ = segments.flatten(batch.column(n_group + 1))
        g, t, v = _distinct(row_gid[row], t, v)
        take = pa.array(at)
        arrays = [*(batch.column(i).take(take) for i in range(n_group)), segments.lists_of(t, g, len(at), pa.int16()), segments.lists_of(v, g, len(at), pa.float64()), *(batch.column(n_group + 2 + i).take(take) for i in range(2))]
        return pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for whole in batches:
            for batch in _slices(whole, n_group) if whole.num_rows else ():
                out = merged(batch if held is None else pa.concat_batches([held, batch]))
                if out.num_rows > 1:
                    yield finish(out.slice(0, out.num_rows - 1))
                held = out.slice(out.num_rows - 1)
        if held is not None:
            yield finish(held)

    return run


def possible(v: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Finite and inside the bounds; a missing (NaN) bound doesn't bound."""
    with np.errstate(invalid="ignore"):
        return np.isfinite(v) & ~(v < low) & ~(v > high)


def _spread(n_group: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the non-zero changes (kind 0) and of the inner runs (kind 1) of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, n_group) if whole.num_rows else ():
                v, row = segments.flatten(batch.column(n_group))
                low, high = (batch.column(n_group + 1 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(2))
                fine = possible(v, low[row], high[row])
                pv, pg = v[fine], row[fine]
                inner = pg[1:] == pg[:-1]
                change = np.abs(np.diff(pv))[inner]
                g0, x0 = pg[1:][inner][change > 0], change[change > 0]
                run_at, run_len = run_table(pv, pg)
                rg = pg[run_at]
                edge = np.r_[True, rg[1:] != rg[:-1]] | np.r_[rg[1:] != rg[:-1], True] if len(rg) else np.zeros(0, bool)
                g = np.r_[g0, rg[~edge]]
                kind = np.r_[np.zeros(len(g0), np.int32), np.ones(int((~edge).sum()), np.int32)]
                x = np.r_[x0, run_len[~edge].astype(float)]
                order = np.lexsort((x, kind, g))
                g, kind, x = g[order], kind[order], x[order]
                if not len(g):
                    continue
                at = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (kind[1:] != kind[:-1]) | (x[1:] != x[:-1])])
                count = np.diff(np.r_[at, len(g)])
                take = pa.array(g[at])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(n_group)), pa.array(kind[at]), pa.array(x[at]), pa.array(count)], names=[*batch.schema.names[:n_group], "kind", "x", "c"])

    return run


def _judge(n_group: int, n_keys: int, rule: FaultRule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks with their context to flagged readings."""

    def flags(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        t, row = segments.flatten(col["t"])
        v, _ = segments.flatten(col["v"])
        number = lambda name: col[name].to_numpy(zero_copy_only=False).astype(float)
        fine = possible(v, number("low")[row], number("high")[row])
        pv, pg = v[fine], row[fine]

        # With the neighbours beyond the block's borders, whose places sort before and after its own.
        before, before_row = segments.flatten(col["before"])
        after, after_row = segments.flatten(col["after"])
        ext_v, ext_g = np.r_[before, pv, after], np.r_[before_row, pg, after_row]
        side = np.r_[np.zeros(len(before), np.int8), np.ones(len(pv), np.int8), np.full(len(after), 2, np.int8)]
        order = np.lexsort((side, ext_g))
        away = leaving(ext_v[order], ext_g[order], rule.spike_frames)[side[order] == 1]

        run_at, run_len = run_table(pv, pg)
        run_gid = pg[run_at]
        total = run_len.astype(float)
        if len(run_at):
            first, last = np.r_[True, run_gid[1:] != run_gid[:-1]], np.r_[run_gid[1:] != run_gid[:-1], True]
            total[last] = np.fmax(total[last], number("trail_total")[run_gid[last]])
            total[first] = np.fmax(total[first], number("lead_total")[run_gid[first]])
        lasting = np.repeat(total, run_len)

        usual, rest = number("med_change")[pg], number("med_run")[pg]
        with np.errstate(invalid="ignore", divide="ignore"):
            leave = np.nan_to_num(away / (rule.spike_factor * usual), nan=0.0, posinf=0.0)
            run = np.minimum(lasting / rule.stuck_frames, lasting / (rule.stuck_factor * rest))
            spiked = away > rule.spike_factor * usual  # False where a source never changes
        stuck = (lasting >= rule.stuck_frames) & (lasting >= rule.stuck_factor * rest)

        shares = np.zeros((2, len(v)))
        shares[:, fine] = leave, run
        posterior = forward_backward(likelihoods(shares[0], shares[1], ~fine, rule), np.bincount(row, minlength=batch.num_rows), INITIAL, TRANSITION)
        exact = np.zeros((len(v), 4), bool)
        exact[fine, 1], exact[fine, 2], exact[:, 3] = spiked, stuck, ~fine
        candidate = posterior[:, 1:] >= rule.posterior
        kept = candidate & exact[:, 1:]
        # A reading has one flag: out of range before stuck before spike.
        at = np.flatnonzero(kept.any(1))
        state = np.where(kept[at, 2], 3, np.where(kept[at, 1], 2, 1))
        take = pa.array(row[at])
        stamp = col["blk"].to_numpy()[row[at]] * BLOCK + t[at]
        arrays = [*(batch.column(i).take(take) for i in range(n_keys)), col["f"].take(take), pa.array(stamp), pa.array(v[at]), pa.array(np.array(STATES, dtype=object)[state], pa.string()), pa.array(posterior[at, state])]
        return pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:n_keys], "f", "ts", "v", "fault", "probability"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lists = whole.schema.get_field_index("t")
            for batch in _slices(whole, lists) if whole.num_rows else ():
                out = flags(batch)
                if out.num_rows:
                    yield out

    return run


def flag_faults(df: DataFrame, entity: list[str], order: str, fields: list[str], *, limits: DataFrame | None = None, limit_key: str | None = None, rule: FaultRule | None = None) -> DataFrame:
    """Impossible, spiking and stuck readings of each source (``entity`` columns and one of ``fields``).

    Args: ``order`` is the BIGINT frame number; ``limits`` has the columns ``key``, ``lower``, ``upper``
    for values of the entity column ``limit_key``.

    Returns the entity columns, ``order``, ``field``, ``value``, ``fault`` ('impossible', 'stuck' or 'spike')
    and ``probability`` (posterior of that state).

    Defined cases: null measurements are skipped, so neighbours are successive readings; rows with a null
    or unusable frame number are left out; copies of a row count once (of several readings of one frame the
    smallest counts, NaN last); null entity columns form a source like any other; without a limit only
    non-finite readings are impossible; a source that never changes has no spikes; a reading at either end of
    a source has a neighbour on one side only and is no spike; an empty table gives no row.
    Other columns are not read, whatever their names.
    """
    rule = rule or FaultRule()
    n = len(entity)
    keys = [f"k{i}" for i in range(n)]
    rows = df.select(*(F.col(c).alias(k) for c, k in zip(entity, keys, strict=True)), F.col(order).cast("bigint").alias("ts"), *(F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(fields)))
    rows = rows.where((F.col("ts") > -STAMP_LIMIT) & (F.col("ts") < STAMP_LIMIT))
    kept = [rows.schema[k] for k in keys]
    packs = [T.StructField("f", T.IntegerType()), T.StructField("blk", T.LongType()), T.StructField("t", T.ArrayType(T.ShortType())), T.StructField("v", T.ArrayType(T.DoubleType()))]
    packed = rows.mapInArrow(_pack(n, len(fields)), T.StructType([*kept, *packs]))
    if limits is None:
        packed = packed.withColumns({"low": F.lit(None).cast("double"), "high": F.lit(None).cast("double")})
    else:
        bounds = limits.groupBy(F.col("key").alias("limit_key")).agg(F.max("lower").alias("low"), F.min("upper").alias("high"))
        packed = packed.join(bounds, packed[keys[entity.index(limit_key)]] == bounds["limit_key"], "left").drop("limit_key")
    group = [*keys, "f", "blk"]
    source = [*keys, "f"]
    packed = packed.select(*group, "t", "v", "low", "high").repartition(*group).sortWithinPartitions(*group)
    double, long = T.DoubleType(), T.LongType()
    extra = [("n", long), ("head", T.ArrayType(double)), ("tail", T.ArrayType(double)), ("lead_len", long), ("trail_len", long), ("whole", T.BooleanType()), ("med_change", double), ("med_run", double)]
    blocks = cut(packed.mapInArrow(_summarise(len(group)), T.StructType([*packed.schema.fields, *(T.StructField(*x) for x in extra)])))

    # What each block needs of the others: the nearest readings on both sides.
    along = Window.partitionBy(*source).orderBy("blk")
    small = blocks.select(*group, "n", "head", "tail", "lead_len", "trail_len", "whole").where(F.col("n") > 0)
    context = small.select(
        *group,
        "head",
        "lead_len",
        "trail_len",
        "whole",
        F.flatten(F.collect_list("tail").over(along.rowsBetween(-REACH, -1))).alias("before"),
        F.flatten(F.collect_list("head").over(along.rowsBetween(1, REACH))).alias("after"),
        F.count(F.lit(1)).over(Window.partitionBy(*source)).alias("blocks"),
    )
    context = context.withColumns({"before": F.slice("before", F.greatest(F.size("before") - REACH + 1, F.lit(1)), REACH), "after": F.slice("after", 1, REACH)})
    several = context.where(F.col("blocks") > 1)

    # Runs that cross borders: a block's first and last run are pieces; equal neighbours are one run.
    prior = F.try_element_at("before", F.lit(-1))
    pieces = several.select(
        *group,
        prior.alias("prior"),
        F.posexplode(
            F.when(F.col("whole"), F.array(F.struct(F.col("head")[0].alias("x"), F.col("lead_len").alias("len")))).otherwise(
                F.array(F.struct(F.col("head")[0].alias("x"), F.col("lead_len").alias("len")), F.struct(F.lit(None).cast("double").alias("x"), F.col("trail_len").alias("len")))
            )
        ).alias("pos", "piece"),
    )
    opens = (F.col("pos") == 1) | F.col("prior").isNull() | (F.col("prior") != F.col("piece.x"))
    stepped = Window.partitionBy(*source).orderBy("blk", "pos")
    pieces = pieces.select(*group, "pos", F.col("piece.len").alias("len"), opens.alias("opens"), F.sum(opens.cast("long")).over(stepped).alias("run"))
    pieces = pieces.withColumn("total", F.sum("len").over(Window.partitionBy(*source, "run")))
    borders = pieces.groupBy(*group).agg(F.max(F.when(F.col("pos") == 0, F.col("total"))).alias("lead_total"), F.max_by("total", "pos").alias("trail_total"))

    # Medians of sources with several blocks, from counts that merge.
    inner = join_null_safe(blocks, several.select(*group), group).select(*source, "v", "low", "high")
    counts = T.StructType([*(blocks.schema[c] for c in source), T.StructField("kind", T.IntegerType()), T.StructField("x", double), T.StructField("c", long)])
    spread = inner.mapInArrow(_spread(len(source)), counts)
    steps = several.select(*source, F.lit(0).alias("kind"), F.abs(prior - F.col("head")[0]).alias("x"), F.lit(1).cast("long").alias("c")).where(F.col("x") > 0)
    crossing = pieces.where("opens").select(*source, F.lit(1).alias("kind"), F.col("total").cast("double").alias("x"), F.lit(1).cast("long").alias("c"))
    medians = grouped_median(spread.unionByName(steps).unionByName(crossing), [*source, "kind"], "x", "c")
    pooled = medians.groupBy(*source).agg(F.max(F.when(F.col("kind") == 0, F.col("median"))).alias("m_change"), F.max(F.when(F.col("kind") == 1, F.col("median"))).alias("m_run"))

    notes = several.select(*group, "before", "after")
    notes = join_null_safe(join_null_safe(notes, borders, group, "left"), pooled, source, "left")
    full = join_null_safe(blocks.drop("n", "head", "tail", "lead_len", "trail_len", "whole"), notes, group, "left")
    many = F.col("before").isNotNull()
    none = F.array().cast("array<double>")
    full = full.select(
        *group,
        "t",
        "v",
        "low",
        "high",
        F.coalesce("before", none).alias("before"),
        F.coalesce("after", none).alias("after"),
        F.col("lead_total").cast("double").alias("lead_total"),
        F.col("trail_total").cast("double").alias("trail_total"),
        F.when(many, F.col("m_change")).otherwise(F.col("med_change")).alias("med_change"),
        F.when(many, F.col("m_run")).otherwise(F.col("med_run")).alias("med_run"),
    )
    found = full.mapInArrow(_judge(len(group), n, rule), T.StructType([*kept, T.StructField("f", T.IntegerType()), T.StructField("ts", long), T.StructField("v", double), T.StructField("fault", T.StringType()), T.StructField("probability", double)]))
    names = F.array(*(F.lit(c) for c in fields))
    return found.select(*(F.col(k).alias(c) for k, c in zip(keys, entity, strict=True)), F.col("ts").alias(order), names[F.col("f")].alias("field"), F.col("v").alias("value"), "fault", "probability")

