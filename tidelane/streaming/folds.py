"""Stateful folds over the rows of a key, the same function in batch and in a stream.

A fold is a start state and a step: (state, row as dict) -> (state, rows to emit); the step may change the state in place.
States are JSON values, so a stream keeps them in its state store; a batch streams sorted rows through and keeps one key's state at a time.
"""

from __future__ import annotations

import copy
import json
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelane.operators.deadband import deadband_step

Step = Callable[[dict, dict], tuple[dict, list[dict]]]


@dataclass(frozen=True)
class Fold:
    """``output`` is the DDL of emitted rows without the key columns."""

    start: dict
    step: Step
    output: str


def _schema(df: DataFrame, by: list[str], fold: Fold) -> T.StructType:
    return T.StructType([*(df.schema[b] for b in by), *T.StructType.fromDDL(fold.output).fields])


def fold_batch(df: DataFrame, by: list[str], order: list[str], fold: Fold) -> DataFrame:
    """The fold over a finished table: rows of a key in ``order``, streamed through in sorted batches."""
    source = df.repartition(*by).sortWithinPartitions(*by, *order)
    schema = _schema(df, by, fold)
    arrow = [(f.name, f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        key, state = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                k = tuple(row[b] for b in by)
                if state is None or k != key:
                    key, state = k, copy.deepcopy(fold.start)
                state, emitted = fold.step(state, row)
                out += [dict(zip(by, k, strict=True)) | e for e in emitted]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n, _ in arrow} for r in out], schema=target)

    return source.mapInArrow(run, schema)


def fold_stream(df: DataFrame, by: list[str], order: list[str], fold: Fold) -> DataFrame:
    """The fold over a stream: a micro-batch's rows of a key in ``order``, the state kept between batches.

    Rows that arrive in a later micro-batch count after those of earlier ones, whatever their order column says.
    """
    schema = _schema(df, by, fold)
    names = schema.fieldNames()

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = json.loads(state.get[0]) if state.exists else copy.deepcopy(fold.start)
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        out = []
        for row in rows.astype(object).where(rows.notna(), None).to_dict("records"):
            own, emitted = fold.step(own, row)
            out += [dict(zip(by, key, strict=True)) | e for e in emitted]
        state.update((json.dumps(own),))
        yield pd.DataFrame(out, columns=names)

    return df.groupBy(*by).applyInPandasWithState(run, schema, T.StructType([T.StructField("state", T.StringType())]), "append", GroupStateTimeout.NoTimeout)


def deadband_fold(value: str, order: str, threshold: float) -> Fold:
    """Values that a deadband publishes; see :func:`tidelane.operators.deadband.deadband_step`."""
    def step(state: dict, row: dict) -> tuple[dict, list[dict]]:
        x = row[value]
        if x is None:
            return state, []
        own = tuple(float("nan") if v is None else v for v in state["s"])
        own, shown, fresh = deadband_step(own, float(x), threshold)
        return {"s": list(own)}, [{order: row[order], "published": shown}] if fresh else []

    return Fold({"s": [None, None, 0.0]}, step, f"{order} long, published double")


def complete_fold(stream: str, sequence: str, at: str, needed: list[str]) -> Fold:
    """A row each time every needed stream has advanced since the last such row; later or equal numbers than seen don't count."""
    def step(state: dict, row: dict) -> tuple[dict, list[dict]]:
        name, n = row[stream], row[sequence]
        latest, used = state["latest"], state["used"]
        if name not in needed or n is None or n <= latest.get(name, -1):
            return state, []
        latest = latest | {name: int(n)}
        if all(latest.get(s, -1) > used.get(s, -1) for s in needed):
            return {"latest": latest, "used": dict(latest)}, [{"at": row[at], "sequences": json.dumps(latest, sort_keys=True)}]
        return {"latest": latest, "used": used}, []

    return Fold({"latest": {}, "used": {}}, step, "at double, sequences string")


def triple_fold(kind: str, value: str, at: str) -> Fold:
    """At each tick row, observation, raw output and command if all are there; raw and command are used up, the observation stays."""
    def step(state: dict, row: dict) -> tuple[dict, list[dict]]:
        if row[kind] != "tick":
            return state | {row[kind]: row[value]}, []
        if any(state.get(k) is None for k in ("obs", "raw", "cmd")):
            return state, []
        return state | {"raw": None, "cmd": None}, [{"at": row[at], "obs": state["obs"], "raw": state["raw"], "cmd": state["cmd"]}]

    return Fold({"obs": None, "raw": None, "cmd": None}, step, "at double, obs double, raw double, cmd double")


@dataclass(frozen=True)
class WatchLimits:
    """Freshness and skew limits of inputs in seconds, and how long a start may take."""

    stale_s: dict[str, float]
    skew_s: float
    grace_s: float = 0.0


def health_issues(limits: WatchLimits, seen: dict[str, float | None], sequence: dict[str, int | None], now: float) -> list[str]:
    """Codes of what is wrong with the inputs just now."""
    out = []
    for name, most in sorted(limits.stale_s.items()):
        at = seen.get(name)
        if at is None or (sequence.get(name) or 0) <= 0:
            out.append(f"{name}:missing")
        elif at != at or now < at:
            out.append(f"{name}:invalid_time")
        elif now - at > most:
            out.append(f"{name}:stale")
    times = [seen.get(n) for n in limits.stale_s]
    if all(t is not None and t == t for t in times) and times and max(times) - min(times) > limits.skew_s:
        out.append("skew")
    return out


def watchdog_fold(limits: WatchLimits) -> Fold:
    """Latch with explicit rearm over rows (at, stream, sequence, seen, command).

    A reading updates its stream; a row with command ``check`` evaluates; ``rearm`` leaves the latch only if the inputs are
    healthy and each has advanced since the fault.  Emits state, epoch and reason at every evaluation.
    """
    def step(state: dict, row: dict) -> tuple[dict, list[dict]]:
        now, command = row["at"], row["command"]
        state["t0"] = now if state["t0"] is None else state["t0"]
        if row["stream"] is not None:
            state["seen"][row["stream"]], state["sequence"][row["stream"]] = row["seen"], None if row["sequence"] is None else int(row["sequence"])
        if command is None:
            return state, []
        issues = health_issues(limits, state["seen"], state["sequence"], now)
        if command == "rearm" and state["state"] == "latched":
            advanced = all((state["sequence"].get(n) or 0) > (state["fault"].get(n) or 0) for n in limits.stale_s)
            if not issues and advanced:
                state |= {"state": "armed", "epoch": state["epoch"] + 1, "reason": "rearmed"}
            else:
                state["reason"] = ";".join(issues) or "not_advanced"
        elif command == "check" and state["state"] != "latched":
            if not issues:
                state |= {"state": "armed", "reason": "healthy"}
            elif state["state"] == "armed" or now - state["t0"] >= limits.grace_s:
                state |= {"state": "latched", "epoch": state["epoch"] + 1, "reason": ";".join(issues), "fault": dict(state["sequence"])}
            else:
                state["reason"] = ";".join(issues)
        return state, [{"at": now, "state": state["state"], "epoch": state["epoch"], "reason": state["reason"]}]

    return Fold({"state": "starting", "epoch": 0, "reason": "", "seen": {}, "sequence": {}, "fault": {}, "t0": None}, step, "at double, state string, epoch long, reason string")


def align_fold(streams: dict[str, str], ahead_ns: int) -> Fold:
    """Buffered alignment over rows (ts, seq, stream, value): rows of ``main`` wait until ``ahead_ns`` has passed, then match each stream.

    ``streams`` gives each stream's mode, 'nearest' or 'causal'.  A row of stream ``end`` flushes what waits.  Of a stream only the
    rows since the oldest waiting frame, and the last before it, are kept.  A frame without a match in some stream is left out.
    """
    def match(rows: list, ts: int, mode: str) -> list | None:
        i = bisect_right(rows, [ts, float("inf")])
        before = rows[i - 1] if i else None
        if mode == "causal":
            return before
        if before is not None:
            before = rows[bisect_left(rows, [before[0], float("-inf")])]
        after = rows[i] if i < len(rows) else None
        if before is None or (after is not None and after[0] - ts < ts - before[0]):
            return after
        return before

    def step(state: dict, row: dict) -> tuple[dict, list[dict]]:
        name, ts = row["stream"], row["ts"]
        if name == "main" and ts is not None:
            insort(state["main"], [int(ts), int(row["seq"])])
        elif name in streams and ts is not None:
            insort(state["rows"].setdefault(name, []), [int(ts), int(row["seq"]), row["value"]])
        if ts is not None:
            state["newest"] = max(state["newest"] or int(ts), int(ts))
        out = []
        while state["main"] and (name == "end" or state["main"][0][0] + ahead_ns <= state["newest"]):
            at, seq = state["main"].pop(0)
            found = {s: match(state["rows"].get(s, []), at, mode) for s, mode in streams.items()}
            if all(found.values()):
                out.append({"ts": at, "seq": seq, "matched": json.dumps({s: f[1] for s, f in sorted(found.items())})})
        oldest = state["main"][0][0] if state["main"] else (state["newest"] or 0) - ahead_ns
        for s, rows in state["rows"].items():
            before = bisect_right(rows, [oldest, float("-inf")]) - 1
            if before > 0:
                # Of equal stamps the first is kept too, as a nearest match takes it.
                del rows[: bisect_left(rows, [rows[before][0], float("-inf")])]
        return state, out

    return Fold({"main": [], "rows": {}, "newest": None}, step, "ts long, seq long, matched string")
