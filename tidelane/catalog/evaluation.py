"""Queries of evaluation, splits, labels and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.catalog.tables import table
from tidelane.functions import names
from tidelane.operators import datasets, labels, metrics, splits

METRICS = ["mse", "mae", "rmse", "max_abs_error", "cosine_similarity", "pred_smoothness_mean", "pred_smoothness_std", "gt_smoothness_mean", "gt_smoothness_std"]
JOINTS = [f"{side}_{j}" for side in ("left", "right") for j in ("finger_joint1", *(f"joint{i}" for i in range(1, 8)))]
PAIRS_SQL = "pr AS (SELECT DISTINCT episode_idx, t, joint, predicted, ground_truth, predicted - ground_truth AS err FROM predictions WHERE isfinite(predicted) AND isfinite(ground_truth))"
EPISODE_SQL = (
    PAIRS_SQL
    + """, fr AS (SELECT episode_idx, t, sum(predicted * ground_truth) AS d, sqrt(sum(predicted * predicted)) * sqrt(sum(ground_truth * ground_truth)) AS n, sqrt(sum(dp * dp)) AS sp, sqrt(sum(dg * dg)) AS sg
  FROM (SELECT *, predicted - lag(predicted) OVER w AS dp, ground_truth - lag(ground_truth) OVER w AS dg FROM pr WINDOW w AS (PARTITION BY episode_idx, joint ORDER BY t)) GROUP BY 1, 2),
a AS (SELECT episode_idx, avg(err * err) AS mse, avg(abs(err)) AS mae, sqrt(avg(err * err)) AS rmse, max(abs(err)) AS max_abs_error FROM pr GROUP BY 1),
j AS (SELECT episode_idx, joint AS max_abs_error_joint FROM pr QUALIFY row_number() OVER (PARTITION BY episode_idx ORDER BY abs(err) DESC, t, joint) = 1),
s AS (SELECT episode_idx, count(*) AS num_frames, avg(CASE WHEN n > 1e-8 THEN d / n ELSE 0 END) AS cosine_similarity, coalesce(avg(sp), 0) AS pred_smoothness_mean, coalesce(stddev_pop(sp), 0) AS pred_smoothness_std, coalesce(avg(sg), 0) AS gt_smoothness_mean, coalesce(stddev_pop(sg), 0) AS gt_smoothness_std FROM fr GROUP BY 1),
em AS (SELECT * FROM a JOIN j USING (episode_idx) JOIN s USING (episode_idx))"""
)


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.paired(table(spark, folder, "predictions"))


def _round(columns: list[str]) -> list[Column]:
    return [F.round(c, 10).alias(c) for c in columns]


def _round_sql(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 10) AS {c}" for c in columns)


def episode_scores(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.episode_metrics(_pairs(spark, folder)).select("episode_idx", "num_frames", "max_abs_error_joint", *_round(METRICS))


def joint_scores(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.joint_metrics(_pairs(spark, folder)).select("episode_idx", "joint", "frames", F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"), *_round(["mae", "bias"]))


def _split_of(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "predictions").groupBy("episode_idx").agg(F.min("split_label").alias("split"))


def split_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = metrics.episode_metrics(_pairs(spark, folder)).join(_split_of(spark, folder), "episode_idx")
    out = metrics.summary(rows, "split", ["mse", "mae", "cosine_similarity"])
    return out.select("split", "episodes", *_round([f"{m}_{s}" for m in ("mse", "mae", "cosine_similarity") for s in ("mean", "std")]))


SPLIT_SCORES_SQL = (
    "WITH "
    + EPISODE_SQL
    + ", sp AS (SELECT episode_idx, min(split_label) AS split FROM predictions GROUP BY 1) SELECT split, count(*) AS episodes, "
    + ", ".join(f"round({f}({m}), 10) AS {m}_{n}" for m in ("mse", "mae", "cosine_similarity") for f, n in (("avg", "mean"), ("stddev_pop", "std")))
    + " FROM em JOIN sp USING (episode_idx) GROUP BY GROUPING SETS ((), (split))"
)


def score_table(spark: SparkSession, folder: str) -> DataFrame:
    wide = metrics.metrics_table(metrics.joint_metrics(_pairs(spark, folder)), JOINTS)
    return wide.select("episode_idx", *_round([f"mae_{j}" for j in JOINTS]))


TABLE_SQL = "WITH " + PAIRS_SQL + " SELECT episode_idx, " + ", ".join(f"round(avg(abs(err)) FILTER (joint = '{j}'), 10) AS mae_{j}" for j in JOINTS) + " FROM pr GROUP BY 1"


def score_spread(spark: SparkSession, folder: str) -> DataFrame:
    out = metrics.joint_spread(metrics.joint_metrics(_pairs(spark, folder)), _split_of(spark, folder))
    return out.select("split", "joint", "episodes", "outliers", *_round(["q25", "q50", "q75"]))


SPREAD_SQL = "WITH " + PAIRS_SQL + """, m AS (SELECT episode_idx, joint, avg(abs(err)) AS mae FROM pr GROUP BY 1, 2), sp AS (SELECT episode_idx, min(split_label) AS split FROM predictions GROUP BY 1),
q AS (SELECT split, joint, quantile_cont(mae, 0.25) AS q25, quantile_cont(mae, 0.5) AS q50, quantile_cont(mae, 0.75) AS q75, count(*) AS episodes FROM m JOIN sp USING (episode_idx) GROUP BY 1, 2)
SELECT split, joint, any_value(episodes) AS episodes, count(*) FILTER (mae < q25 - 1.5 * (q75 - q25) OR mae > q75 + 1.5 * (q75 - q25)) AS outliers, round(any_value(q25), 10) AS q25, round(any_value(q50), 10) AS q50, round(any_value(q75), 10) AS q75
FROM m JOIN sp USING (episode_idx) JOIN q USING (split, joint) GROUP BY 1, 2"""


def losses(spark: SparkSession, folder: str) -> DataFrame:
    """Validation loss of each split: unweighted mean of batches of eight evaluations."""
    rows = table(spark, folder, "episode_metrics").select("eval_id", "split_label", "mse").where(F.col("split_label").isNotNull()).distinct()
    return metrics.batch_loss(rows, "split_label", "eval_id", "mse", 8).select("split_label", "batches", F.round("loss", 10).alias("loss"))


LOSS_SQL = "WITH r AS (SELECT split_label, mse, (row_number() OVER (PARTITION BY split_label ORDER BY eval_id) - 1) // 8 AS b FROM (SELECT DISTINCT eval_id, split_label, mse FROM episode_metrics WHERE split_label IS NOT NULL)), m AS (SELECT split_label, b, avg(mse) AS m FROM r GROUP BY 1, 2) SELECT split_label, count(*) AS batches, round(avg(m), 10) AS loss FROM m GROUP BY 1"


def split_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Annotated episodes with the first split that lists them, else manual."""
    rows = table(spark, folder, "annotations").select("episode_idx").distinct()
    listed = table(spark, folder, "predictions").select("episode_idx", F.col("split_label").alias("split")).distinct()
    return metrics.with_split(rows, listed, "episode_idx")


WITH_SPLIT_SQL = "WITH a AS (SELECT DISTINCT episode_idx FROM annotations), s AS (SELECT episode_idx, arg_min(split_label, CASE split_label WHEN 'train' THEN 1 WHEN 'val' THEN 2 WHEN 'test' THEN 3 ELSE 0 END) AS split FROM predictions GROUP BY 1) SELECT a.episode_idx, coalesce(split, 'manual') AS split FROM a LEFT JOIN s USING (episode_idx)"

# Splits -----------------------------------------------------------------------------------------------------------
LABEL_COLUMNS = ["envelope_size", "envelope_facing_side", "destination_basket_side", "arm"]
LATEST_SQL = "la AS (SELECT * FROM (SELECT DISTINCT annotation_id, episode_idx, envelope_size, envelope_facing_side, destination_basket_side, arm, labelled_at FROM annotations WHERE episode_idx IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY episode_idx ORDER BY labelled_at DESC NULLS LAST, annotation_id DESC) = 1)"


def _alias_sql(column: str, aliases: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in aliases.items())
    return f"CASE replace(lower(trim({column})), ' ', '_') {whens} END"


STRATA_SQL = LATEST_SQL + f", st AS (SELECT episode_idx, {_alias_sql('envelope_size', names.SIZE_ALIASES)} AS size, {_alias_sql('envelope_facing_side', names.FACE_ALIASES)} AS face FROM la)"


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    return labels.latest_labels(table(spark, folder, "annotations"), "episode_idx", "labelled_at", "annotation_id", LABEL_COLUMNS)


def strata(spark: SparkSession, folder: str) -> DataFrame:
    rows = _latest(spark, folder)
    size, face = names.label_alias(F.col("envelope_size"), names.SIZE_ALIASES), names.label_alias(F.col("envelope_facing_side"), names.FACE_ALIASES)
    return rows.select("episode_idx", size.alias("size"), face.alias("face"), names.stratum(size, face).alias("stratum"))


def _stratified(spark: SparkSession, folder: str) -> DataFrame:
    return splits.stratified_split(strata(spark, folder).where("stratum IS NOT NULL"), episode="episode_idx", stratum="stratum", ratios=(0.8, 0.1, 0.1), seed=42)


STRATIFIED_SQL = STRATA_SQL + """, r AS (SELECT episode_idx, size || '|' || face AS stratum, row_number() OVER (PARTITION BY size, face ORDER BY sha256('42:' || size || '|' || face || ':' || episode_idx), episode_idx) AS r, count(*) OVER (PARTITION BY size, face) AS n FROM st WHERE size IS NOT NULL AND face IS NOT NULL),
sf AS (SELECT episode_idx, stratum, CASE WHEN r <= n - round_even(n * 0.1 / 1.0, 0) * 2 THEN 'train' WHEN r <= n - round_even(n * 0.1 / 1.0, 0) THEN 'val' ELSE 'test' END AS split FROM r)"""


def strata_summary(spark: SparkSession, folder: str) -> DataFrame:
    return splits.strata_summary(_stratified(spark, folder), "stratum")


def split_check(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "episode_metrics").select("episode_idx", F.lower("split_label").alias("split")).distinct()
    return splits.split_problems(rows, "episode_idx", 3000)


CHECK_SQL = """WITH r AS (SELECT DISTINCT episode_idx AS e, lower(split_label) AS s FROM episode_metrics)
SELECT DISTINCT 'unknown_split' AS problem, e AS episode FROM r WHERE coalesce(s, '') NOT IN ('train', 'val', 'test') UNION ALL SELECT DISTINCT 'out_of_range', e FROM r WHERE e IS NULL OR e < 0 OR e >= 3000
UNION ALL SELECT 'several_splits', e FROM r GROUP BY e HAVING min(s) <> max(s) UNION ALL SELECT 'empty_train', NULL FROM r HAVING count(*) FILTER (s = 'train') = 0"""


def contiguous(spark: SparkSession, folder: str) -> DataFrame:
    return splits.contiguous_split(table(spark, folder, "annotations"), "episode_idx", (0.8, 0.1, 0.1))


CONTIGUOUS_SQL = """WITH e AS (SELECT episode_idx, row_number() OVER (ORDER BY episode_idx) - 1 AS p, count(*) OVER () AS n FROM (SELECT DISTINCT episode_idx FROM annotations)),
k AS (SELECT *, CASE WHEN n >= 3 THEN greatest(1, CAST(round_even(n * 0.1 / 1.0, 0) AS BIGINT)) ELSE 0 END AS v FROM e) SELECT episode_idx, CASE WHEN p < n - 2 * v THEN 'train' WHEN p < n - v THEN 'val' ELSE 'test' END AS split FROM k"""


def shard_plan(spark: SparkSession, folder: str) -> DataFrame:
    return splits.shards(table(spark, folder, "annotations"), "episode_idx", 7).groupBy("shard").agg(F.count(F.lit(1)).alias("episodes"), F.min("episode_idx").alias("first"), F.max("episode_idx").alias("last"))


SHARD_SQL = "WITH e AS (SELECT episode_idx, ntile(7) OVER (ORDER BY episode_idx) - 1 AS shard FROM (SELECT DISTINCT episode_idx FROM annotations)) SELECT CAST(shard AS INTEGER) AS shard, count(*) AS episodes, min(episode_idx) AS first, max(episode_idx) AS last FROM e GROUP BY 1"


def sampled(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "predictions").select(F.col("split_label").alias("split"), "episode_idx").where("split IS NOT NULL")
    return splits.sample_per_split(rows, split="split", episode="episode_idx", n=5, seed=7)


SAMPLE_SQL = "SELECT split_label AS split, episode_idx FROM (SELECT DISTINCT split_label, episode_idx FROM predictions WHERE split_label IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY split_label ORDER BY sha256('7:' || split_label || ':' || episode_idx), episode_idx) <= 5"


def document(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_document(_stratified(spark, folder), "episode_idx")


# Labels -----------------------------------------------------------------------------------------------------------
def labelled(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "episode_metrics").select("eval_id", "episode_idx").distinct()
    return labels.join_labels(rows, _latest(spark, folder), "episode_idx", LABEL_COLUMNS)


LABEL_JOIN_SQL = "WITH " + LATEST_SQL + ", r AS (SELECT DISTINCT eval_id, episode_idx FROM episode_metrics) SELECT eval_id, episode_idx, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in LABEL_COLUMNS) + " FROM r LEFT JOIN la USING (episode_idx)"


def _first_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "annotations").where(F.col("episode_idx").isNotNull())
    return rows.groupBy("episode_idx").agg(F.min(F.struct("annotation_id", *LABEL_COLUMNS)).alias("r")).select("episode_idx", *(F.col(f"r.{c}").alias(c) for c in LABEL_COLUMNS))


FIRST_SQL = "fi AS (SELECT * FROM (SELECT DISTINCT annotation_id, episode_idx, envelope_size, envelope_facing_side, destination_basket_side, arm FROM annotations WHERE episode_idx IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY episode_idx ORDER BY annotation_id) = 1)"


def conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_conflicts(_first_labels(spark, folder), _latest(spark, folder), "episode_idx", LABEL_COLUMNS)


CONFLICT_SQL = "WITH " + LATEST_SQL + ", " + FIRST_SQL + " " + " UNION ALL ".join(f"SELECT episode_idx, '{c}' AS field, fi.{c} AS old, la.{c} AS new FROM fi JOIN la USING (episode_idx) WHERE coalesce(fi.{c}, '') <> '' AND fi.{c} IS DISTINCT FROM la.{c}" for c in LABEL_COLUMNS)


def alignment(spark: SparkSession, folder: str) -> DataFrame:
    return labels.alignment_faults(table(spark, folder, "predictions"), table(spark, folder, "annotations").where("envelope_size IS NOT NULL"), "episode_idx")


ALIGN_SQL = "WITH a AS (SELECT DISTINCT episode_idx FROM predictions), b AS (SELECT DISTINCT episode_idx FROM annotations WHERE envelope_size IS NOT NULL) SELECT episode_idx, 'missing' AS fault FROM a WHERE episode_idx NOT IN (FROM b) UNION ALL SELECT episode_idx, 'extra' FROM b WHERE episode_idx NOT IN (FROM a)"


def repeated(spark: SparkSession, folder: str) -> DataFrame:
    return labels.repeated_keys(table(spark, folder, "annotations").distinct(), "episode_idx")


def spread(spark: SparkSession, folder: str) -> DataFrame:
    """One session's label on all its episodes."""
    rows = table(spark, folder, "annotations").select("episode_idx").distinct()
    entries = table(spark, folder, "joint_limits").select(F.lit("big").alias("envelope_size"), F.lit("left").alias("destination_basket_side"))
    return labels.spread_session_label(rows, entries, ["envelope_size", "destination_basket_side"])


def usable_labels(spark: SparkSession, folder: str) -> DataFrame:
    return labels.labels_from_columns(_latest(spark, folder), "episode_idx")


USABLE_SQL = "WITH " + STRATA_SQL + " SELECT st.episode_idx, size, face FROM st JOIN la USING (episode_idx) WHERE trim(coalesce(envelope_size, '')) <> '' AND trim(coalesce(envelope_facing_side, '')) <> ''"


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "annotations").where("session IS NOT NULL").distinct()
    return labels.session_metadata(rows, "session", "envelope_size", "recorder_status", {"big": "left", "medium": "right", "small": "right"})


SESSION_SQL = f"""WITH a AS (SELECT DISTINCT annotation_id, session, recorder_status = 'aborted' AS ab, CASE {_alias_sql('envelope_size', names.SIZE_ALIASES)} WHEN 'big' THEN 'left' WHEN 'medium' THEN 'right' WHEN 'small' THEN 'right' END AS b FROM annotations WHERE session IS NOT NULL)
SELECT session, count(*) AS episodes, count(*) FILTER (ab) AS aborted, CASE WHEN min(b) = max(b) THEN min(b) END AS basket FROM a GROUP BY 1"""


def session_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Every annotation of every session, and whether it was aborted."""
    rows = table(spark, folder, "annotations").where("session IS NOT NULL").distinct()
    return labels.session_episodes(rows, "session", "annotation_id", "recorder_status")


def stamped(spark: SparkSession, folder: str) -> DataFrame:
    return labels.stamp_sidecars(_first_labels(spark, folder), _latest(spark, folder), "episode_idx", LABEL_COLUMNS)


STAMP_SQL = "WITH " + LATEST_SQL + ", " + FIRST_SQL + " SELECT episode_idx, " + ", ".join(f"coalesce(nullif(la.{c}, ''), fi.{c}) AS {c}" for c in LABEL_COLUMNS) + " FROM fi FULL JOIN la USING (episode_idx)"


# Datasets ---------------------------------------------------------------------------------------------------------
def _dataset(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "episode_metrics").groupBy("episode_idx").agg(F.max("num_frames").alias("n"))
    return rows.select(F.col("episode_idx").alias("episode_index"), (F.col("episode_idx") * 10).alias("index"), "n")


def merged(spark: SparkSession, folder: str) -> DataFrame:
    rows = _dataset(spark, folder)
    return datasets.merge_datasets([rows, rows], episode="episode_index", index="index")


MERGE_SQL = "WITH d AS (SELECT episode_idx AS e, episode_idx * 10 AS i, max(num_frames) AS n FROM episode_metrics GROUP BY 1) SELECT e AS episode_index, i AS index, n FROM d UNION ALL SELECT e + (SELECT max(e) + 1 FROM d), i + (SELECT max(i) + 1 FROM d), n FROM d"


def resumed(spark: SparkSession, folder: str) -> DataFrame:
    sources = table(spark, folder, "annotations").select("episode_idx").distinct()
    return datasets.not_yet_written(sources, table(spark, folder, "predictions"), "episode_idx")


def relative(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "annotations").select("annotation_id", "recorder_status").distinct()
    return datasets.relative_index(rows.select("annotation_id"), rows.where("recorder_status = 'success'"), "annotation_id")


def annotated(spark: SparkSession, folder: str) -> DataFrame:
    rows = _dataset(spark, folder)
    return datasets.annotate(rows, _latest(spark, folder).select(F.col("episode_idx").alias("episode_index"), "envelope_size", "arm"), "episode_index")


QUERIES = {
    "episode_metrics": (episode_scores, "WITH " + EPISODE_SQL + " SELECT episode_idx, num_frames, max_abs_error_joint, " + _round_sql(METRICS) + " FROM em"),
    "per_joint_metrics": (joint_scores, "WITH " + PAIRS_SQL + " SELECT episode_idx, joint, count(*) AS frames, round(avg(err * err), 6) AS mse, round(avg(abs(err)), 10) AS mae, round(sqrt(avg(err * err)), 6) AS rmse, round(avg(err), 10) AS bias FROM pr GROUP BY 1, 2"),
    "metrics_by_split": (split_scores, SPLIT_SCORES_SQL),
    "metrics_table": (score_table, TABLE_SQL),
    "joint_spread": (score_spread, SPREAD_SQL),
    "batch_loss": (losses, LOSS_SQL),
    "split_or_manual": (split_labels, WITH_SPLIT_SQL),
    "episode_strata": (strata, "WITH " + STRATA_SQL + " SELECT episode_idx, size, face, size || '|' || face AS stratum FROM st"),
    "stratified_split_hash": (_stratified, "WITH " + STRATIFIED_SQL + " SELECT * FROM sf"),
    "strata_summary": (strata_summary, "WITH " + STRATIFIED_SQL + " SELECT stratum, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM sf GROUP BY 1"),
    "split_validate": (split_check, CHECK_SQL),
    "contiguous_split": (contiguous, CONTIGUOUS_SQL),
    "shard_plan": (shard_plan, SHARD_SQL),
    "sample_per_split": (sampled, SAMPLE_SQL),
    "split_document": (document, None),
    "label_join": (labelled, LABEL_JOIN_SQL),
    "label_conflicts": (conflicts, CONFLICT_SQL),
    "alignment_check": (alignment, ALIGN_SQL),
    "repeated_labels": (repeated, "SELECT episode_idx, count(*) AS rows FROM (SELECT DISTINCT * FROM annotations) GROUP BY 1 HAVING count(*) > 1"),
    "session_label_spread": (spread, "SELECT DISTINCT episode_idx, 'big' AS envelope_size, 'left' AS destination_basket_side FROM annotations"),
    "usable_labels": (usable_labels, USABLE_SQL),
    "session_metadata": (sessions, SESSION_SQL),
    "session_episodes": (session_entries, "SELECT session, annotation_id, bool_or(coalesce(recorder_status = 'aborted', false)) AS aborted FROM annotations WHERE session IS NOT NULL GROUP BY 1, 2"),
    "stamped_sidecars": (stamped, STAMP_SQL),
    "merge_datasets": (merged, MERGE_SQL),
    "resume_sources": (resumed, "SELECT DISTINCT episode_idx FROM annotations WHERE episode_idx NOT IN (SELECT episode_idx FROM predictions)"),
    "relative_index": (relative, "SELECT annotation_id, row_number() OVER (ORDER BY annotation_id) - 1 AS relative FROM (SELECT DISTINCT annotation_id FROM annotations WHERE recorder_status = 'success')"),
    "annotate_dataset": (annotated, "WITH " + LATEST_SQL + ", d AS (SELECT episode_idx, max(num_frames) AS n FROM episode_metrics GROUP BY 1) SELECT d.episode_idx AS episode_index, d.episode_idx * 10 AS index, n, envelope_size, arm FROM d LEFT JOIN la USING (episode_idx)"),
}
