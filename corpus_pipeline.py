"""The corpus pipeline: from raw documents to packed training windows.

Each stage is written as Parquet and read again as the next one's documents.  All but the
last return the columns of `documents`.  SQL can express neither the models nor the
packing, so there is no oracle; tests hold each stage against a brute-force version.

Empty tables give no pieces.  Null texts fail the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomstar.llm import exact_dedup, language_id, near_dedup, packing, quality
from loomstar.llm.common import store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read like trusted text."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    return language_id.keep_known_language(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.drop_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
