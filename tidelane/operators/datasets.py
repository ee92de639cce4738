"""Datasets on disk: write, append, merge, publish, list and verify."""

from __future__ import annotations

import hashlib
import os
import subprocess
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MARKER = "_PUBLISHED"


def read_dataset(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of a dataset with their schemas merged."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def write_frames(frames: DataFrame, path: str, *, episode: str = "episode_index", order: str = "frame_index", buckets: int | None = None) -> int:
    """Frames as Parquet, ordered inside files; returns the number of buckets.

    Episodes are spread by hash over ``buckets`` directories (default: one per shuffle partition), as a directory per episode
    would be millions of tiny files; the reader prunes by the bucket and by statistics of the sorted episode column.
    """
    n = buckets or int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = frames.withColumn("bucket", F.pmod(F.xxhash64(episode), F.lit(n)).cast("int"))
    rows.repartition(n, "bucket").sortWithinPartitions("bucket", episode, order).write.partitionBy("bucket").mode("errorifexists").parquet(path)
    return n


def read_episode(spark: SparkSession, path: str, number: int, buckets: int, *, episode: str = "episode_index", order: str = "frame_index") -> DataFrame:
    """Frames of one episode of a dataset that :func:`write_frames` wrote with ``buckets``, in order; only its directory is read."""
    frames = spark.read.parquet(path)
    own = F.pmod(F.xxhash64(F.lit(number).cast(frames.schema[episode].dataType)), F.lit(buckets)).cast("int")
    return frames.where((F.col("bucket") == own) & (F.col(episode) == number)).orderBy(order)


def not_yet_written(sources: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """Sources to convert on resume: those whose id isn't in the dataset (by id, not by count)."""
    return sources.join(written.select(key).distinct(), key, "left_anti")


def merge_datasets(datasets: list[DataFrame], *, episode: str, index: str, drop: list[str] | None = None) -> DataFrame:
    """Datasets one after another: episode and row numbers of each go on where the one before ends.

    Schemas must agree after ``drop``; offsets come from one aggregate row per dataset.
    """
    parts = [d.drop(*(drop or [])) for d in datasets]
    names = sorted(parts[0].columns)
    for p in parts[1:]:
        if sorted(p.columns) != names or {f.name: f.dataType for f in p.schema} != {f.name: f.dataType for f in parts[0].schema}:
            raise ValueError("datasets differ in their features")
    tagged = [p.withColumn("_d", F.lit(i)) for i, p in enumerate(parts)]
    rows = tagged[0]
    for t in tagged[1:]:
        rows = rows.unionByName(t)
    sizes = rows.groupBy("_d").agg((F.max(episode) + 1).alias("e"), (F.max(index) + 1).alias("n"))
    before = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_d", F.coalesce(F.sum("e").over(before), F.lit(0)).alias("_e"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"))
    return rows.join(F.broadcast(offsets), "_d").withColumns({episode: F.col(episode) + F.col("_e"), index: F.col(index) + F.col("_n")}).drop("_d", "_e", "_n")


def relative_index(rows: DataFrame, kept: DataFrame, index: str) -> DataFrame:
    """Dense row numbers (``relative``) of the kept rows in the order of their absolute ones.

    Ranks come from bin totals and an order inside each bin, so no task orders all rows.
    """
    chosen = kept.select(index).distinct()
    width = 1 << 16
    binned = rows.join(chosen, index, "left_semi").withColumn("_b", F.call_function("div", F.col(index), F.lit(width).cast("bigint")))
    sums = binned.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    sums = sums.select("_b", F.coalesce(F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inner = F.row_number().over(Window.partitionBy("_b").orderBy(index)) - 1
    return binned.join(sums, "_b").withColumn("relative", F.col("_base") + inner).drop("_b", "_base")


def annotate(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows with the label columns added or replaced; null where there is no label."""
    columns = [c for c in labels.columns if c != key]
    return rows.drop(*columns).join(labels, key, "left")


def publish(staging: str, target: str) -> None:
    """Make a finished local dataset visible by one rename that refuses to overwrite."""
    stage, goal = Path(staging), Path(target)
    (stage / MARKER).touch()
    if goal.exists():
        raise FileExistsError(target)
    os.rename(stage, goal)


def replace_file(path: str, content: bytes) -> None:
    """Write a small file so that a reader sees the old or the new content, never a part."""
    temporary = f"{path}.tmp"
    with open(temporary, "wb") as f:
        f.write(content)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, digest) of every file below a folder; SHA-256 of the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = folder.rstrip("/") + "/"
    return files.select(F.substring_index(F.col("path"), root, -1).alias("path"), "length", F.sha2("content", 256).alias("digest"))


def manifest_changes(before: DataFrame, after: DataFrame, mutable: str = r"(^|/)(stats\.json|_PUBLISHED|episodes/.*)$") -> DataFrame:
    """Files added, removed or changed between manifests, mutable ones (a pattern) left out."""
    both = before.select("path", F.col("digest").alias("a")).join(after.select("path", F.col("digest").alias("b")), "path", "full_outer")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return both.where(~F.col("path").rlike(mutable)).select("path", change.alias("change")).where(F.col("change").isNotNull())


def verify_manifest(lines: DataFrame, line: str, digests: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Problems of a manifest of ``digest  path`` lines against actual (path, digest): malformed, unsafe path, repeated, missing, mismatch."""
    text = F.trim(line)
    parsed = lines.select(text.alias("line"), F.regexp_extract(text, r"^([0-9a-f]{64})\s\s?\*?(.+)$", 1).alias("said"), F.regexp_extract(text, r"^([0-9a-f]{64})\s\s?\*?(.+)$", 2).alias("path")).where(F.col("line") != "")
    bad = parsed.where("said = ''").select(F.col("line").alias("path"), F.lit("malformed").alias("problem"))
    good = parsed.where("said <> ''")
    unsafe = good.where(F.startswith("path", F.lit("/")) | F.array_contains(F.split("path", "/"), "..")).select("path", F.lit("unsafe_path").alias("problem"))
    repeated = good.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("path", F.lit("repeated").alias("problem"))
    compared = good.join(digests.select("path", "digest"), "path", "left")
    missing = compared.where("digest IS NULL").select("path", F.lit("missing").alias("problem"))
    mismatch = compared.where("digest <> said").select("path", F.lit("mismatch").alias("problem"))
    out = bad.unionByName(unsafe).unionByName(repeated).unionByName(missing).unionByName(mismatch)
    if required:
        wanted = lines.sparkSession.createDataFrame([(r,) for r in required], "path string")
        out = out.unionByName(wanted.join(good, "path", "left_anti").select("path", F.lit("required").alias("problem")))
    return out.distinct()


def manifest_digest(entries: list[tuple[str, str]]) -> str:
    """Digest of a list of (path, digest), whatever its order."""
    return hashlib.sha256("\n".join(f"{d}  {p}" for p, d in sorted(entries)).encode()).hexdigest()


def provenance(repository: str) -> dict[str, str]:
    """Commit and tag of a checkout; empty texts where they can't be had."""
    def ask(*args: str) -> str:
        try:
            return subprocess.run(["git", "-C", repository, *args], capture_output=True, text=True, timeout=10).stdout.strip()
        except (OSError, subprocess.SubprocessError):
            return ""

    return {"commit": ask("rev-parse", "HEAD"), "tag": ask("describe", "--tags", "--always")}


def feature_summary(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types of a dataset's features."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


#: Dataset versions that can be read.
VERSIONS = ("v2.0", "v2.1", "v3.0")


def root_problems(info: dict, folders: set[str]) -> list[str]:
    """Errors and warnings of a dataset root, in order: metadata, version, folders, totals."""
    out = []
    if not info:
        return ["error: meta/info.json is missing"]
    if info.get("codebase_version") not in VERSIONS:
        out.append(f"error: unsupported version {info.get('codebase_version')!r}")
    out += [f"error: {name} is missing" for name in ("data", "meta") if name not in folders]
    if not info.get("total_episodes"):
        out.append("warning: no episodes")
    if any(f.get("dtype") == "video" for f in info.get("features", {}).values()) and "videos" not in folders:
        out.append("warning: videos is missing")
    return out
