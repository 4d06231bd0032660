"""A corpus pipeline of five stages: language ID, n-gram Jaccard join, secret scans, source mixing, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return documents'
columns. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from navnet.llm import langid, mixing, ngram_join, packing, secret_scan
from navnet.llm.common import numbered, read, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no learnt language go: null, or without any letter. The model is learnt from this stage's documents."""
    return langid.recognised(docs, langid.fitted(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that link, the one with the smallest doc_id stays."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in their texts, of which n_chars counts anew; all documents stay."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are put in the order that mixes their sources to the target weights; all stay."""
    return mixing.in_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 1024 tokens, which follow the documents' order."""
    return packing.pack_in_order(packing.pieces(numbered(docs, "at"), order="at", kept_words=100_000))


STAGES = [("language_id", language), ("ngram_jaccard", near_copies), ("secret_scan", secrets), ("source_mixing", mixture), ("best_fit_packing", packed)]

#: Token ids and code lengths are beyond SQL: tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
