"""A training corpus from `documents`: language, near duplicates, repeated passages, benchmark passages, packing.

Each stage works on all that the one before it kept, written as Parquet and read again, and all but
the last return the columns of `documents`. Every stage is one of the operators in `skyledger.llm`.
Executors and their workers live through all stages, so each sends its rows to Python in small batches.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.common import small_batches, staged, table
from skyledger.llm.decontaminate import without_contaminated
from skyledger.llm.language import accepted_documents
from skyledger.llm.near_dedup import CORPUS_PERCENT, one_of_each
from skyledger.llm.packing import pack_documents, tokenizer_path
from skyledger.llm.suffix_dedup import without_repeated_bytes

KEPT_PIECES = 150_000           # text pieces whose ids a worker remembers beside the other stages' memory (speed only)


def _in_small_batches(stage: Callable) -> Callable:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


@_in_small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go."""
    return accepted_documents(docs)


@_in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (word shingles 80 % alike) the document with the smallest id stays."""
    return one_of_each(docs, CORPUS_PERCENT)


@_in_small_batches
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that a smaller document has are taken out of the texts."""
    return without_repeated_bytes(docs)


@_in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of token sequences."""
    return pack_documents(docs, tokenizer_path(), keep=KEPT_PIECES)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language models, byte spans and tokens are beyond SQL; tests compare every stage with a direct version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
