"""From raw documents to packed sequences, in five stages.

Each stage takes all documents that the one before kept and returns the columns of
documents; the last returns the packed pieces. Between stages rows are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bugtide.llm import decontamination, language, packing, simhash, substrings
from bugtide.llm.queries import tokenizer_path
from bugtide.llm.tools import table
from bugtide.storage import release, stored, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that is told with some certainty go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return simhash.keep_one(docs)


def remove_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeated strings cover go."""
    return substrings.remove_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans that occur in the benchmark go."""
    return decontamination.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.packing_digest(packing.pack(docs, tokenizer_path()))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_repeated_substrings),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: SQL can express none of the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage stored on its way goes when its result is stored."""
    docs, before = table(spark, sf_dir, "documents"), stored()
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
            release(spark, since=before, keep=1)
    return docs
