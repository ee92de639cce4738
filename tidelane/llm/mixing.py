"""Mixing sources to target shares of a total size, with repeats capped per source.

Documents are counted by exact token length per source.  A source's budget is used up in three steps: all its documents
as often as fits whole; of the rest, a share of every length so that the lengths stay mixed as they are; and what
then remains (``SPARE`` tokens or a few of the longest documents) by a bounded knapsack over the counts that are left, as a
subset sum that comes as near to the budget as any.  Which documents of a length are taken is decided by a seeded hash order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelane.plans.lineage import cut

#: Tokens left to the knapsack, if a few of the longest documents aren't more.
SPARE = 1 << 14
#: Longest documents that the knapsack has room for.
LONGEST_LEFT = 3
BINS_BITS = 12


def subset_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that the total is the largest possible that is at most ``budget``.

    Bounded knapsack by dynamic programming over reachable totals, in units of the lengths' greatest common divisor;
    counts are divided into powers of two.  Reachable totals are the bits of one number, so a step is a shift; about
    five bytes a total are held, whatever the budget.
    """
    take = np.zeros(len(lengths), np.int64)
    usable = np.flatnonzero((lengths > 0) & (lengths <= budget) & (counts > 0))
    if not len(usable):
        return take
    unit = int(np.gcd.reduce(lengths[usable]))
    budget = min(int(budget) // unit, int((lengths[usable] * counts[usable]).sum()) // unit)
    within = (1 << (budget + 1)) - 1
    reach, step = 1, []
    by = np.full(budget + 1, -1, np.int32)
    for i in usable[np.argsort(-lengths[usable], kind="stable")]:
        size, k = int(lengths[i]) // unit, 1
        left = min(int(counts[i]), budget // size)
        while left > 0 and not reach >> budget:
            n = min(k, left)
            fresh = (reach << (size * n)) & within & ~reach
            if fresh:
                bits = np.frombuffer(fresh.to_bytes(budget // 8 + 1, "little"), np.uint8)
                by[np.flatnonzero(np.unpackbits(bits, bitorder="little"))] = len(step)
                step.append((i, n, size * n))
                reach |= fresh
            left, k = left - n, k * 2
    at = reach.bit_length() - 1
    while at:
        i, n, weight = step[by[at]]
        take[i] += n
        at -= weight
    return take


def plan_source(lengths: np.ndarray, counts: np.ndarray, budget: int, repeats: int) -> tuple[int, np.ndarray]:
    """Whole repeats of all documents, and how many of each length (ascending) once more."""
    total = int((lengths * counts).sum())
    whole = repeats if total == 0 else min(repeats, budget // total)
    take = np.zeros(len(lengths), np.int64)
    rest = budget - whole * total
    if whole == repeats or rest <= 0 or not total:
        return int(whole), take
    # Documents longer than the rest can't be in it; of the others the longest ones need room in the knapsack.
    fit = lengths <= rest
    lengths, counts = lengths[fit], counts[fit]
    chosen = np.zeros(len(lengths), np.int64)
    fitting = int((lengths * counts).sum())
    aim = min(rest, fitting) - max(SPARE, LONGEST_LEFT * int(lengths[-1])) if len(lengths) else 0
    if aim > 0:
        # Shares of every length; the running remainder carries what rounding leaves to the next length, so
        # that in the end less than the longest document remains of the aim.
        upto = np.cumsum(lengths * counts) * (aim / fitting)
        taken = 0
        for i in np.flatnonzero(lengths > 0):
            chosen[i] = min(counts[i], max(0, int((upto[i] - taken) // lengths[i])))
            taken += int(chosen[i] * lengths[i])
        rest -= taken
    take[fit] = chosen + subset_sum(lengths, counts - chosen, rest)
    return int(whole), take


def mix(documents: DataFrame, targets: DataFrame, *, doc_id: str, source: str, tokens: str, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Choose documents for a mixture as large as all of ``documents``; ``targets`` has source, target_share, max_repeats.

    Returns (chosen, report).  ``chosen``: (doc_id, source, tokens, repeats) of the documents used, repeats at least 1.
    ``report``: per source of ``targets`` the available tokens and documents, the target, the tokens reached, the share of the mixture
    that it got, and ``missed``: the plan uses all its documents ``max_repeats`` times and is still below the target.

    Defined cases: null or negative sizes count as 0, and documents of size 0 are taken only in whole repeats; null ids are documents;
    exact copies (id, source, tokens) count once; documents of other sources (or none) count only for the
    total; a source without documents misses a positive target; a null share or repeat cap is 0; repeated
    target rows count once (largest values); an empty table of documents gives an empty choice and nothing missed.

    Scale: sizes are summed map-side to counts per source and length; a plan row per source and length comes back.
    Documents are ranked inside 4,096 hash bins of each source and length, so no group is ordered whole.
    """
    sizes = cut(documents.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), F.greatest(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)), F.lit(0)).alias("size")).distinct())
    wanted = targets.groupBy("source").agg(F.coalesce(F.max("target_share"), F.lit(0.0)).alias("share"), F.coalesce(F.max("max_repeats"), F.lit(0)).cast("bigint").alias("cap")).where(F.col("source").isNotNull())
    counts = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum(F.col("size") * F.col("n")), F.lit(0)).alias("total"))
    aims = wanted.crossJoin(F.broadcast(total)).withColumn("budget", F.col("share") * F.col("total"))
    rows = aims.join(counts, "source", "left")

    def plan(part: pa.Table) -> pa.Table:
        part = part.filter(pc.is_valid(part["size"])).sort_by("size")
        whole, extra = 0, np.zeros(0, np.int64)
        if part.num_rows:
            whole, extra = plan_source(part["size"].to_numpy(), part["n"].to_numpy(), int(np.floor(part["budget"][0].as_py() + 0.5)), part["cap"][0].as_py())
        return part.select(["source", "size", "n"]).append_column("whole", pa.array(np.full(part.num_rows, whole, np.int64))).append_column("extra", pa.array(extra))

    plans = rows.groupBy("source").applyInArrow(plan, "source string, size long, n long, whole long, extra long")
    h = F.xxhash64(F.col("id").cast("string"), F.lit(seed))
    binned = sizes.withColumns({"h": h, "bin": F.shiftrightunsigned(h, 64 - BINS_BITS)})
    ranked = binned.withColumn("rank", F.row_number().over(Window.partitionBy("source", "size", "bin").orderBy("h", "id")))
    below = binned.groupBy("source", "size", "bin").agg(F.count(F.lit(1)).alias("c"))
    below = below.select("source", "size", "bin", F.coalesce(F.sum("c").over(Window.partitionBy("source", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"))
    bins = below.join(plans, ["source", "size"]).where((F.col("whole") > 0) | (F.col("below") < F.col("extra")))
    chosen = ranked.join(bins, ["source", "size", "bin"]).select("id", "source", "size", (F.col("whole") + (F.col("below") + F.col("rank") <= F.col("extra")).cast("bigint")).alias("repeats")).where("repeats > 0")

    reached = plans.groupBy("source").agg(F.max("whole").alias("whole"), F.sum(F.col("size") * (F.col("n") * F.col("whole") + F.col("extra"))).alias("reached"))
    own = counts.groupBy("source").agg(F.sum("n").alias("documents"), F.sum(F.col("size") * F.col("n")).alias("available"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    report = aims.join(own, "source", "left").join(reached, "source", "left")
    # Missed: the plan has used everything as often as allowed and is still below the target.
    missed = (F.coalesce("whole", "cap") >= F.col("cap")) & (zero("reached") < F.col("budget"))
    report = report.select("source", F.col("share").alias("target_share"), F.col("cap").alias("max_repeats"), zero("documents").alias("documents"), zero("available").alias("available"), F.col("budget").alias("target_tokens"), zero("reached").alias("reached"), missed.alias("missed"))
    report = report.withColumn("reached_share", F.try_divide("reached", F.sum("reached").over(Window.partitionBy())))
    return chosen.toDF(doc_id, source, tokens, "repeats"), report
