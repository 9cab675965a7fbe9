"""The corpus pipeline: quality rules, language ID, near-duplicate removal, packing.

Each stage takes and returns the columns of ``documents`` (the last one returns packed
pieces) and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import grouping_packer, prob_minhash, quality_rules, subword_langid
from ledgerloom.llm.common import prepare, read, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality rules reject."""
    prepare(spark)
    return quality_rules.accepted(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language, or whose language is not told with enough certainty."""
    prepare(spark)
    return subword_langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    prepare(spark)
    return prob_minhash.deduplicated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    prepare(spark)
    return grouping_packer.pack(docs)


STAGES = [("quality rules", quality), ("language ID", language), ("near-duplicates", near_duplicates), ("packing", packing)]
ORACLE_SQL = None       # trained and randomised stages: tested against brute force in tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one before."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
