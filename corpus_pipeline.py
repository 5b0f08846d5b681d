"""A corpus pipeline over the documents table: each stage's result is written as Parquet and read as the next one's input.

Every stage works on all that its predecessor kept and returns the columns of documents; the last one returns the packed
pieces. A null text or a repeated row passes a stage as the stage's operator defines; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import minhash, mixing, packing, quality, secrets
from cohortlens.llm.common import table
from cohortlens.sources.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or meet a learned rule go."""
    return quality.judged(docs, table(spark, sf_dir, "labels")).where("__kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (shingles of five words, similarity 0.8) stays."""
    return minhash.without_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials are replaced in the texts."""
    return secrets.redacted(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their budgets; repeated documents occur in several rows."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixed_sources", mixed_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Learned rules, signatures and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), name)
    return rows
