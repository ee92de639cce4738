"""Queries over the documents: packing, mixing, offensive language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.catalog.tables import table
from tidelane.llm.abusive import fit_examples, offence_rates, score_documents
from tidelane.llm.mixing import mix
from tidelane.llm.packing import Container, fill_report, pack
from tidelane.llm.tokens import token_count

BOX = Container(tokens=4096)
OFFENDING = 0.5


def sized_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source, tokens) of every document; the text stays where it is read."""
    return table(spark, folder, "documents").select("doc_id", "source", token_count(F.col("text")).alias("tokens"))


def packed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, or piece of one that is longer than a sequence, with its training sequence."""
    return pack(sized_documents(spark, folder), item="doc_id", tokens="tokens", box=BOX)


def divided_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that had to be cut: their pieces lie in several sequences."""
    spread = packed_documents(spark, folder).groupBy("doc_id").agg(F.min("bin").alias("a"), F.max("bin").alias("b")).where("a <> b")
    return spread.select(F.col("doc_id").cast("bigint").alias("doc_id"))


def packing_report(spark: SparkSession, folder: str) -> DataFrame:
    return fill_report(packed_documents(spark, folder), BOX)


def _mixture(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return mix(sized_documents(spark, folder), table(spark, folder, "mix_targets"), doc_id="doc_id", source="source", tokens="tokens", seed=17)


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mixture and how often each is used."""
    return _mixture(spark, folder)[0]


def mixture_report(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached tokens and shares of each source."""
    return _mixture(spark, folder)[1]


def missing_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Sources that miss their share even with all documents repeated as often as allowed."""
    return mixture_report(spark, folder).where("missed").select("source")


def document_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score, probability and evidence of offensive language for every document."""
    documents = table(spark, folder, "documents")
    return score_documents(documents, fit_examples(documents, table(spark, folder, "review_labels")), keep=["source"])


def offending_documents(spark: SparkSession, folder: str) -> DataFrame:
    return document_scores(spark, folder).where(F.col("probability") >= OFFENDING).select("doc_id")


def offending_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of offending documents of each source."""
    return offence_rates(document_scores(spark, folder), "source", OFFENDING)


QUERIES = {
    "p8_found": (divided_documents, None),
    "p8_packing": (packed_documents, None),
    "p8_fill": (packing_report, None),
    "p9_found": (missing_sources, None),
    "p9_mixture": (mixture, None),
    "p9_report": (mixture_report, None),
    "p10_found": (offending_documents, None),
    "p10_scores": (document_scores, None),
    "p10_rates": (offending_rates, None),
}
