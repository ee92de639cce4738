"""Scores for abusive, hateful or sexually explicit language by nearest labelled examples.

A document is read as passages (sentences, lines) in a form that disguises don't change.  Each passage is compared
with all labelled passages by exact TF-IDF cosine; the nearest vote with weights that fall with distance, and a
document's score is that of its worst passage, with the nearest example as evidence.

Reviewers label documents, not passages, so the vote of a labelled passage is learned: a passage of a flagged document
keeps its vote only if passages like it in *other* documents are flagged as well.  Scores become probabilities by
isotonic regression on the labelled documents, each scored without its own votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.llm.passages import passages
from tidelane.llm.similar_examples import BlockMaxIndex, known_terms, vocabulary

#: Default bounds of the labelled sample that the classifier is fitted on (parameters of :func:`fit_examples`).
MOST_LABELLED = 20_000
MOST_PASSAGES = 300_000
#: Letters of these passages: at most one n-gram each, so at most 48 MB of lists in the index (see BlockMaxIndex).
MOST_LETTERS = 1 << 22
NEIGHBOURS = 12
#: Weight of a neighbour: cosine to this power, times its documents up to this many.
POWER = 4
VOTES = 3
#: Weight with which a passage unlike all examples counts as inoffensive.
DOUBT = 1e-3
ROUNDS = 2
#: Passages whose result a worker remembers.
REMEMBERED = 50_000
#: Spellings of the two labels.
YES = ("yes", "y", "1", "true", "t")
NO = ("no", "n", "0", "false", "f")


@dataclass
class ExampleModel:
    """Index of the labelled passages, their learned votes, an example document of each, and the calibration."""

    index: BlockMaxIndex
    vote: np.ndarray
    weight: np.ndarray
    example: np.ndarray
    score_at: np.ndarray
    probability_at: np.ndarray
    #: What a worker remembers of passages it has judged, between tasks too.
    memory: dict = field(default_factory=dict)

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, cosine and number of the nearest example of each passage."""
        found, cosine = self.index.nearest(texts, NEIGHBOURS)
        by = np.where(found >= 0, cosine**POWER * self.weight[np.maximum(found, 0)], 0) if len(self.vote) else np.zeros(found.shape)
        votes = self.vote[np.maximum(found, 0)] if len(self.vote) else by
        return (by * votes).sum(1) / (by.sum(1) + DOUBT), cosine[:, 0], found[:, 0]

    def probability(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.score_at, self.probability_at) if len(self.score_at) else np.zeros(len(score))


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points (score, probability) of the non-decreasing step function that fits the labels best, by pooling adjacent violators."""
    order = np.argsort(score, kind="stable")
    levels: list[list[float]] = []
    for x, y in zip(score[order], label[order], strict=True):
        levels.append([x, x, float(y), 1.0])
        while len(levels) > 1 and (levels[-2][2] * levels[-1][3] >= levels[-1][2] * levels[-2][3] or levels[-2][1] == levels[-1][0]):
            b = levels.pop()
            a = levels[-1]
            levels[-1] = [a[0], b[1], a[2] + b[2], a[3] + b[3]]
    return np.array([x for a in levels for x in a[:2]]), np.array([a[2] / a[3] for a in levels for _ in range(2)])


def fit_votes(index: BlockMaxIndex, entry: np.ndarray, doc: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Learned vote and weight of each entry, and the score of each (document, entry) row without that document's votes."""
    n = len(index.entries)
    near, cosine = index.nearest(index.entries, NEIGHBOURS + 1)
    key = doc * n + entry
    order = np.argsort(key)
    key = key[order]
    flagged = label > 0.5
    vote = label.astype(float)
    count = np.bincount(entry, minlength=n).astype(float)
    around, similar = near[entry], cosine[entry]
    own_key = doc[:, None] * n + np.maximum(around, 0)
    at = np.minimum(np.searchsorted(key, own_key), len(key) - 1)
    own = (key[at] == own_key) & (around >= 0)

    def without_own() -> np.ndarray:
        total = np.bincount(entry, vote, minlength=n)
        rest = count[np.maximum(around, 0)] - own
        votes = total[np.maximum(around, 0)] - np.where(own, vote[order][at], 0)
        by = np.where((around >= 0) & (rest > 0), similar**POWER * np.minimum(rest, VOTES), 0)
        return (by * votes / np.maximum(rest, 1)).sum(1) / (by.sum(1) + DOUBT)

    for _ in range(ROUNDS):
        vote = np.where(flagged, (without_own() >= 0.5).astype(float), 0.0)
    return np.bincount(entry, vote, minlength=n) / np.maximum(count, 1), np.minimum(count, VOTES), without_own()


def _labelled_passages(documents: DataFrame, labels: DataFrame, *, doc_id: str, text: str, label_id: str, label: str, most_labelled: int, most_passages: int) -> DataFrame:
    """(id, label, passage) of at most ``most_labelled`` labelled documents, chosen by hash; the label is the share of yes."""
    said = F.lower(F.trim(F.col(label).cast("string")))
    known = labels.select(F.col(label_id).alias("id"), F.when(said.isin(*YES), 1.0).when(said.isin(*NO), 0.0).alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull())
    known = known.groupBy("id").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(most_labelled)
    texts = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(passages(x))) for x in batch.column(1).to_pylist()]
            take = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), pa.array([p for x in found for p in x], pa.string())], names=["id", "y", "passage"])

    schema = T.StructType([texts.schema["id"], texts.schema["y"], T.StructField("passage", T.StringType())])
    return texts.select("id", "text", "y").mapInArrow(run, schema).distinct().orderBy(F.xxhash64("id"), "id", "passage").limit(most_passages)


def corpus_counts(documents: DataFrame, text: str, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """How many passages of all documents hold each of ``terms``, and the number of passages.

    Each task sums its own counts; what is gathered is one number per term of the bounded vocabulary.
    """
    shared = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            times: dict[str, int] = {}
            for x in batch.column(0).to_pylist():
                for p in passages(x):
                    times[p] = times.get(p, 0) + 1
            total += sum(times.values())
            names = list(times)
            for i in range(0, len(names), 4096):
                row, term, _, _ = known_terms(names[i : i + 4096], shared.value)
                own += np.bincount(term, np.array([times[p] for p in names[i : i + 4096]])[row], minlength=len(own)).astype(np.int64)
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[total, own[some]])], names=["term", "n"])

    sums = documents.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(len(terms), np.int64)
    inside = sums[sums["term"] >= 0]
    seen[inside["term"].to_numpy(np.int64)] = inside["n"].to_numpy(np.int64)
    return seen, int(sums.loc[sums["term"] < 0, "n"].sum())


def fit_examples(documents: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "offensive", most_labelled: int = MOST_LABELLED, most_passages: int = MOST_PASSAGES, most_letters: int = MOST_LETTERS) -> ExampleModel:
    """Fit on the labelled documents; corpus counts are over all documents.

    The labelled sample is bounded: at most ``most_labelled`` documents, chosen by the hash of their id, and of these at most
    ``most_passages`` different passages in the same order, up to ``most_letters`` letters in all.

    Labels in unknown spellings, of null ids or of documents that don't exist are left out; several labels of a document
    are averaged.  Without labels the model scores everything 0.
    """
    rows = _labelled_passages(documents, labels, doc_id=doc_id, text=text, label_id=label_id, label=label, most_labelled=most_labelled, most_passages=most_passages).toPandas()
    rows = rows[rows["passage"].str.len().cumsum() <= most_letters] if len(rows) else rows
    entries, entry = np.unique(rows["passage"].to_numpy(dtype=str), return_inverse=True) if len(rows) else (np.zeros(0, str), np.zeros(0, np.int64))
    names = [str(x) for x in entries]
    terms = vocabulary(names)
    seen, total = corpus_counts(documents, text, terms) if len(terms) else (np.zeros(0, np.int64), 0)
    index = BlockMaxIndex(names, terms, seen, total)
    if not len(rows):
        return ExampleModel(index, np.zeros(0), np.zeros(0), np.zeros(0, object), np.zeros(0), np.zeros(0))
    ids, doc = np.unique(rows["id"].to_numpy(), return_inverse=True)
    label_of = rows["y"].to_numpy(float)
    vote, weight, alone = fit_votes(index, entry, doc, label_of)
    worst, of = np.zeros(len(ids)), np.zeros(len(ids))
    np.maximum.at(worst, doc, alone)
    of[doc] = label_of
    # As example of a passage, the document that flags it most (the smallest id of several).
    order = np.lexsort((doc, -label_of, entry))
    first = order[np.r_[True, entry[order][1:] != entry[order][:-1]]]
    return ExampleModel(index, vote, weight, ids[doc[first]], *isotonic(worst, of))


def score_documents(documents: DataFrame, model: ExampleModel, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each document with ``score``, ``probability``, its worst ``passage``, and the nearest example: ``example`` (document id) and ``cosine``.

    ``keep`` names further columns to hand on.  Defined cases: null, empty and letterless texts score 0 without a passage;
    whole texts are read, however long; every row gives a row, copies too; of equally bad passages the first in
    text order of its squashed form counts; an empty table gives none.  One pass over the documents, no shuffle.
    """
    keep = keep or []
    shared = documents.sparkSession.sparkContext.broadcast(model)
    source = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *(F.col(c).alias(f"x{i}") for i, c in enumerate(keep)))
    schema = T.StructType([source.schema["id"], *(source.schema[f"x{i}"] for i in range(len(keep))), *(T.StructField(n, t) for n, t in (("score", T.DoubleType()), ("probability", T.DoubleType()), ("passage", T.StringType()), ("example", T.StringType()), ("cosine", T.DoubleType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        memory = model.memory
        for batch in batches:
            found = [sorted(set(passages(x))) for x in batch.column(1).to_pylist()]
            fresh = sorted({p for x in found for p in x} - memory.keys())
            if len(memory) + len(fresh) > REMEMBERED:
                kept = {p: memory[p] for x in found for p in x if p in memory}
                memory.clear()
                memory.update(kept)
            for i in range(0, len(fresh), 4096):
                part = fresh[i : i + 4096]
                memory.update(zip(part, zip(*model.judge(part), strict=True), strict=True))
            worst = [max(x, key=lambda p: memory[p][0], default=None) for x in found]
            score = np.array([memory[p][0] if p is not None else 0.0 for p in worst])
            near = [memory[p][2] if p is not None else -1 for p in worst]
            arrays = [
                batch.column(0),
                *(batch.column(2 + i) for i in range(len(keep))),
                pa.array(score),
                pa.array(model.probability(score)),
                pa.array(worst, pa.string()),
                pa.array([str(model.example[e]) if e >= 0 else None for e in near], pa.string()),
                pa.array([float(memory[p][1]) if p is not None else None for p in worst], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    out = source.mapInArrow(run, schema)
    return out.select(F.col("id").alias(doc_id), *(F.col(f"x{i}").alias(c) for i, c in enumerate(keep)), "score", "probability", "passage", "example", "cosine")


def offence_rates(scored: DataFrame, source: str, threshold: float = 0.5) -> DataFrame:
    """Per source (null is one): documents, offending documents (probability from ``threshold``) and their rate."""
    bad = F.count_if(F.col("probability") >= threshold)
    return scored.groupBy(source).agg(F.count(F.lit(1)).alias("documents"), bad.alias("offending"), (bad / F.count(F.lit(1))).alias("rate"))
