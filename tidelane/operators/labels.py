"""Labels of episodes: reading their layouts, joining, conflicts, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelane.functions.names import FACE_ALIASES, SIZE_ALIASES, label_alias

LABELS = ("envelope_size", "envelope_facing_side", "destination_basket_side", "arm")
#: Columns that labels may be in, first found wins.
SIZE_COLUMNS = ("envelope_size", "size", "envelope")
FACE_COLUMNS = ("envelope_face", "envelope_facing_side", "facing_side", "face", "orientation", "envelope_orientation")


def join_labels(rows: DataFrame, labels: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with their labels, missing ones empty.  Contract: one label row per key (see :func:`repeated_keys`)."""
    joined = rows.join(labels.select(key, *columns), key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in columns})


def repeated_keys(labels: DataFrame, key: str) -> DataFrame:
    return labels.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def latest_labels(annotations: DataFrame, key: str, at: str, tie: str, columns: list[str]) -> DataFrame:
    """The last annotation of each episode."""
    return annotations.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(at, tie, *columns)).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in columns))


def label_conflicts(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Labels that are given before and differ now: (key, field, old, new)."""
    long = lambda df, name: df.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias(name)) for c in columns))).alias("s")).select(key, "s.*")
    both = long(old, "old").join(long(new, "new"), [key, "field"])
    return both.where((F.coalesce("old", F.lit("")) != "") & ~F.col("old").eqNullSafe(F.col("new")))


def alignment_faults(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Keys without labels ('missing') and labels without rows ('extra')."""
    a, b = rows.select(key).distinct().withColumn("a", F.lit(True)), labels.select(key).distinct().withColumn("b", F.lit(True))
    both = a.join(b, key, "full_outer")
    return both.where(F.col("a").isNull() | F.col("b").isNull()).select(key, F.when(F.col("b").isNull(), "missing").otherwise("extra").alias("fault"))


def spread_session_label(rows: DataFrame, entries: DataFrame, columns: list[str]) -> DataFrame:
    """One session's label on all rows; if the entries disagree the query stops."""
    same = F.lit(True)
    for c in columns:
        same = same & (F.min(F.coalesce(c, F.lit(""))) == F.max(F.coalesce(c, F.lit(""))))
    one = entries.agg(same.alias("_same"), *(F.first(F.coalesce(c, F.lit(""))).alias(c) for c in columns))
    one = one.select(*(F.when(F.col("_same"), F.col(c)).otherwise(F.raise_error(F.lit("the session's entries disagree")).cast("string")).alias(c) for c in columns))
    return rows.crossJoin(F.broadcast(one))


def labels_from_columns(episodes: DataFrame, key: str) -> DataFrame:
    """(key, size, face) from the first candidate columns that the table has; rows with a blank label are left out."""
    pick = lambda names: next((n for n in names if n in episodes.columns), None)
    size, face = pick(SIZE_COLUMNS), pick(FACE_COLUMNS)
    if size is None or face is None:
        raise ValueError("the table has no label columns")
    rows = episodes.select(key, label_alias(F.col(size), SIZE_ALIASES).alias("size"), label_alias(F.col(face), FACE_ALIASES).alias("face"), (F.trim(F.coalesce(size, F.lit(""))) != "").alias("_a"), (F.trim(F.coalesce(face, F.lit(""))) != "").alias("_b"))
    return rows.where("_a AND _b").drop("_a", "_b")


def labels_from_text(texts: DataFrame, text: str) -> DataFrame:
    """(episode_index, size, face) from label documents, grouped {size: {face: [episodes]}} or flat {episode: {...} | [size, face] | "size|face"}.

    A document is grouped if all its top keys are size aliases and their values objects.
    """
    top = F.try_parse_json(text).try_cast("map<string,variant>")
    rows = texts.select(F.monotonically_increasing_id().alias("_d"), top.alias("_m")).where(F.col("_m").isNotNull())
    is_group = F.forall(F.map_entries("_m"), lambda e: label_alias(e["key"], SIZE_ALIASES).isNotNull() & F.startswith(F.schema_of_variant(e["value"]), F.lit("OBJECT")))
    rows = rows.withColumn("_g", is_group)
    grouped = rows.where("_g").select(F.explode("_m").alias("size", "v")).select("size", F.explode(F.col("v").try_cast("map<string,array<bigint>>")).alias("face", "eps")).select(F.explode("eps").alias("episode_index"), "size", "face")
    flat = rows.where("NOT _g").select(F.explode("_m").alias("k", "v"))
    text_of = lambda path: F.try_variant_get("v", path, "string")
    kind = F.schema_of_variant("v")
    plain = F.split(F.col("v").try_cast("string"), r"\|")
    size = F.when(F.startswith(kind, F.lit("OBJECT")), F.coalesce(*(text_of(f"$.{c}") for c in SIZE_COLUMNS))).when(F.startswith(kind, F.lit("ARRAY")), text_of("$[0]")).otherwise(F.get(plain, F.lit(0)))
    face = F.when(F.startswith(kind, F.lit("OBJECT")), F.coalesce(*(text_of(f"$.{c}") for c in FACE_COLUMNS))).when(F.startswith(kind, F.lit("ARRAY")), text_of("$[1]")).otherwise(F.get(plain, F.lit(1)))
    flat = flat.select(F.try_to_number("k", F.lit("9999999999999")).cast("bigint").alias("episode_index"), size.alias("size"), face.alias("face"))
    return grouped.unionByName(flat).select("episode_index", label_alias(F.col("size"), SIZE_ALIASES).alias("size"), label_alias(F.col("face"), FACE_ALIASES).alias("face"))


def episode_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of session documents: ``loop.episodes`` or else ``episodes``, exploded with their place."""
    text = spark.read.text(path, wholetext=True)
    v = F.try_parse_json("value")
    entries = F.coalesce(F.try_variant_get(v, "$.loop.episodes", "array<variant>"), F.try_variant_get(v, "$.episodes", "array<variant>"))
    return text.select(F.posexplode(entries).alias("place", "entry"))


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Sidecar documents as (file, status, fields); a corrupt one has no fields."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
    return text.select("file", F.try_variant_get("v", "$.status", "string").alias("status"), F.coalesce(F.col("v").try_cast("map<string,string>"), F.create_map().cast("map<string,string>")).alias("fields"))


def session_episodes(labels: DataFrame, session: str, episode: str, status: str) -> DataFrame:
    """One row per episode of a session: (session, episode, aborted), all of them; an episode is aborted if any of its rows says so."""
    return labels.groupBy(session, episode).agg(F.max(F.coalesce(F.col(status) == "aborted", F.lit(False))).alias("aborted"))


def session_metadata(labels: DataFrame, session: str, size: str, status: str, basket_of_size: dict[str, str]) -> DataFrame:
    """Per session: episodes, how many of them were aborted, and the basket by the rule of sizes if it is one for all.

    The episodes themselves, aborted ones among them, are rows of :func:`session_episodes`, never a list.
    """
    from tidelane.functions.names import lookup

    rows = labels.withColumn("_b", lookup(label_alias(F.col(size), SIZE_ALIASES), basket_of_size))
    one = F.when(F.min("_b") == F.max("_b"), F.min("_b"))
    return rows.groupBy(session).agg(F.count(F.lit(1)).alias("episodes"), F.count_if(F.col(status) == "aborted").alias("aborted"), one.alias("basket"))


def stamp_sidecars(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Sidecars with the new labels over the old ones; keys only in one stay."""
    a, b = old.select(key, *columns), new.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in columns))
    both = a.join(b, a[key] == b["_k"], "full_outer")
    return both.select(F.coalesce(key, "_k").alias(key), *(F.coalesce(F.nullif(F.col(f"_{c}"), F.lit("")), F.col(c)).alias(c) for c in columns))
