"""Feature transforms as functions from DataFrame to DataFrame, and the choice of features and topics."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Step:
    """A named transform that can be switched off."""

    name: str
    apply: Transform
    enabled: bool = True


def pipeline(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """The enabled steps in order; the planner sees one plan."""
    for step in steps:
        if step.enabled:
            df = df.transform(step.apply)
    return df


def exclude_observations(suffixes: list[str], prefix: str = "observation.") -> Transform:
    """Drops observation columns by what follows the prefix; the state always stays."""
    gone = {f"{prefix}{s}" for s in suffixes} - {f"{prefix}state"}
    return lambda df: df.select(*(F.col(f"`{c}`") for c in df.columns if c not in gone))


def drop_features(names: list[str]) -> Transform:
    """Drops columns; unknown names are an error."""
    def apply(df: DataFrame) -> DataFrame:
        unknown = [n for n in names if n not in df.columns]
        if unknown:
            raise ValueError(f"no such features: {unknown}")
        return df.select(*(F.col(f"`{c}`") for c in df.columns if c not in names))

    return apply


def set_task(text: str, column: str = "task") -> Transform:
    return lambda df: df.withColumn(column, F.lit(text))


def used_features(df: DataFrame, candidates: list[str]) -> list[str]:
    """Those of the optional vector features that are non-empty somewhere (one row of counts)."""
    there = [c for c in candidates if c in df.columns]
    if not there:
        return []
    counts = df.agg(*(F.count_if(F.size(F.col(f"`{c}`")) > 0).alias(c) for c in there)).first()
    return [c for c in there if counts[c]]


def state_index(actions: list[str], states: list[str], excluded: Iterable[str] = ()) -> list[int]:
    """Place of each action joint in the state, -1 for excluded ones; a joint that the state lacks is an error."""
    skip, place = set(excluded), {n: i for i, n in enumerate(states)}
    missing = [a for a in actions if a not in skip and a not in place]
    if missing:
        raise ValueError(f"joints without a state: {missing}")
    return [-1 if a in skip else place[a] for a in actions]


def arm_slices(dimension: int, joints_per_arm: int) -> list[tuple[int, int]]:
    """Ranges [from, to) of the arms in an action vector."""
    if joints_per_arm < 1 or dimension % joints_per_arm:
        raise ValueError(f"{dimension} values are no whole number of arms of {joints_per_arm}")
    return [(i, i + joints_per_arm) for i in range(0, dimension, joints_per_arm)]


def wanted_topics(topics: Iterable[str]) -> list[str]:
    """Topics with the compressed variants of image topics."""
    listed = list(dict.fromkeys(topics))
    return listed + [f"{t}/compressed" for t in listed if t.endswith("/image_raw") and f"{t}/compressed" not in listed]


def require_any(available: DataFrame, column: str, wanted: list[str]) -> None:
    """Stops if none of the wanted values is there; any one is enough (reads at most one row)."""
    if wanted and available.where(F.col(column).isin(wanted)).isEmpty():
        raise ValueError(f"none of {sorted(wanted)} is in the recording")


def has_suffix(rows: DataFrame, by: list[str], column: str, suffix: str) -> DataFrame:
    """Per group whether some value ends with ``suffix``."""
    return rows.groupBy(*by).agg(F.coalesce(F.bool_or(F.endswith(F.col(column), F.lit(suffix))), F.lit(False)).alias("found"))


def first_joints(messages: DataFrame, *, file: str, order: str, names: str) -> DataFrame:
    """(role, robot, joints sorted by name) of the first message, in the order of files, that names a joint with a known role.

    Names whose arm is unknown are dropped, as the parser drops them later.
    """
    from tidelane.functions.names import parse_joint_name

    parsed = messages.select(F.struct(file, order).alias("at"), F.filter(F.transform(names, lambda n: parse_joint_name(n)), lambda p: p.isNotNull()).alias("p")).where(F.size("p") > 0)
    first = parsed.agg(F.min_by("p", "at").alias("p")).where(F.col("p").isNotNull())
    # The joints of one message.
    return first.select(F.inline("p")).groupBy("role", "robot").agg(F.array_sort(F.collect_set("joint")).alias("joints"))
