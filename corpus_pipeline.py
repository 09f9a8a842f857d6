"""The corpus pipeline: documents in, packed token sequences out.

Each stage applies one operator of ``quarry.llm`` to all rows that the stage
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, exact_dedup, langid, near_dup, packing
from quarry.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of a language stay; null texts and texts without a letter go."""
    return langid.identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near copies (five-word shingles, similarity 0.8) the smallest id stays."""
    return near_dup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark passage go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence."""
    return packing.packed_table(docs)


STAGES = [("language_id", language_id), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("decontaminate", drop_contaminated), ("pack", pack)]

# Trained classifiers, sketches and edit distances are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
