"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

Each stage reads the documents that its predecessor wrote and applies one operator of
``ledgerline.llm`` to all of them. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import mixing, pii, quality_rules, queries, simhash
from ledgerline.llm.common import materialise, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the isolation forest."""
    return quality_rules.kept_documents(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal fingerprints."""
    return simhash.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by marks."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: documents repeated for whole epochs, sampled for the rest."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: pieces of documents with their token ids."""
    return queries.pack_documents(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact),
    ("source_mixing", mix_sources),
    ("packing", pack),
]

#: fingerprints, forest and tokenizer can't be expressed in SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
