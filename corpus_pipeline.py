"""A corpus pipeline of dealt operators: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.llm import jaccard, langid, mixing, packing, secrets
from replyloom.llm.queries import table, tokenizer_path
from replyloom.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages the models learned; texts without letters or far from all of them go."""
    models = langid.fit(docs.filter(langid.training_fold(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return langid.known_languages(docs, models)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: a Jaccard similarity of 0.8 or more over five-word shingles."""
    return jaccard.one_per_group(docs, width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; what the scan finds is replaced by marks."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place there."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Token ids and the packing search are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None
