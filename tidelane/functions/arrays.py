"""Vectors of joints, poses and camera matrices as array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_order(names: Column, values: Column) -> Column:
    """Values in the order of their names as text; places without a value or a name are left out."""
    n = F.least(F.size(names), F.size(values))
    pairs = F.arrays_zip(F.slice(names, 1, n).alias("name"), F.slice(values, 1, n).alias("value"))
    return F.transform(F.array_sort(F.filter(pairs, lambda p: p["name"].isNotNull())), lambda p: p["value"])


def controller_order(values: Column, names: list[str], controller: list[str]) -> Column:
    """Values by model joint to values by controller joint; unchanged if lengths differ, the orders are equal or a name is unknown."""
    if len(names) != len(controller) or names == controller or set(names) != set(controller):
        return values
    return F.when(F.size(values) == len(names), F.array(*(F.get(values, F.lit(names.index(c))) for c in controller))).otherwise(values)


def limit_step(action: Column, current: Column, most: float) -> Column:
    """Each action within ``most`` of the current position; unchanged if the lengths differ."""
    limited = F.zip_with(action, current, lambda a, c: c + F.greatest(F.lit(-most), F.least(F.lit(most), a - c)))
    return F.when(F.size(action) == F.size(current), limited).otherwise(action)


def limited_joints(action: Column, current: Column, most: float) -> Column:
    """Places whose step is larger than ``most``."""
    steps = F.zip_with(action, current, lambda a, c: F.abs(a - c) > most)
    return F.when(F.size(action) == F.size(current), F.filter(F.transform(steps, lambda big, i: F.when(big, i)), lambda i: i.isNotNull())).otherwise(F.array().cast("array<int>"))


def subtract(left: Column, right: Column, kept: list[int] | None = None) -> Column:
    """Elementwise difference; the places in ``kept`` stay absolute."""
    keep = F.array(*(F.lit(i) for i in kept)) if kept else None
    values = F.zip_with(left, right, lambda a, b: a - b)
    if keep is None:
        return values
    return F.transform(values, lambda d, i: F.when(F.array_contains(keep, i), F.get(left, i)).otherwise(d))


def add(left: Column, right: Column, kept: list[int] | None = None) -> Column:
    """Elementwise sum; the places in ``kept`` stay as in ``left``."""
    keep = F.array(*(F.lit(i) for i in kept)) if kept else None
    values = F.zip_with(left, right, lambda a, b: a + b)
    if keep is None:
        return values
    return F.transform(values, lambda s, i: F.when(F.array_contains(keep, i), F.get(left, i)).otherwise(s))


def norm(values: Column) -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: (a * b).cast("double")), F.lit(0.0), lambda s, x: s + x)


def quaternion_matrix(q: Column) -> Column:
    """Rotation matrix (rows) of a quaternion (x, y, z, w) of any positive length."""
    n = norm(q)
    x, y, z, w = (F.get(q, F.lit(i)) / n for i in range(4))
    return F.array(
        F.array(1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
        F.array(2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
        F.array(2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
    )


def pose_delta(a: Column, b: Column) -> Column:
    """Distance and angle in degrees between two poses (x, y, z, qx, qy, qz, qw)."""
    step = F.zip_with(F.slice(a, 1, 3), F.slice(b, 1, 3), lambda x, y: y - x)
    qa, qb = F.slice(a, 4, 4), F.slice(b, 4, 4)
    cosine = F.abs(dot(qa, qb)) / (norm(qa) * norm(qb))
    return F.struct(norm(step).alias("metres"), F.degrees(2 * F.acos(F.least(F.lit(1.0), cosine))).alias("degrees"))


def padded_distortion(d: Column, size: int = 5) -> Column:
    """Distortion coefficients filled up with zeros."""
    return F.slice(F.concat(F.coalesce(d, F.array().cast("array<double>")), F.array_repeat(F.lit(0.0), size)), 1, size)


def unit_pixels(pixels: Column) -> Column:
    """Pixel bytes 0..255 to 0..1."""
    return F.transform(pixels, lambda p: p / 255.0)


def flat_names(nested: Column) -> Column:
    """Names given as a list of lists, as one list."""
    return F.flatten(nested)
