"""The corpus pipeline: each stage reads the documents that the stage before it has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobsift.llm import grace, langid, mixing, packing, parity
from jobsift.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents whose language cannot be told go."""
    return langid.accepted(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of texts equal after lower-casing A-Z, the document with the largest id stays."""
    return grace.kept_documents(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of texts linked by 0.8 of their five-word shingles, the document with the smallest id stays."""
    return parity.kept_documents(docs, n=5, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a sample with the target shares of sources, languages and topics."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of sequences of 2048 tokens, the sources in proportion."""
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", told_language),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_contents),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: Language and topic models, component search and packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
