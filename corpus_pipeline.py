"""A corpus from raw documents: filter, deduplicate, decontaminate and pack.

Each stage takes (spark, docs, sf_dir) and returns what the next one gets; ``run`` writes
each result to the shared folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terrapop.llm.common import table, written
from terrapop.llm.decontam import drop_contaminated
from terrapop.llm.line_dedup import dedup_lines
from terrapop.llm.packing import PackConfig, pack_documents
from terrapop.llm.simhash import drop_near_duplicates
from terrapop.llm.toxicity import drop_toxic

#: Words that a worker remembers: few, as the same workers serve all stages.
CACHED_WORDS = 150_000
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the table ``labels``."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal to an earlier line, or within the edit bound of it, go; all documents
    stay, and all their columns."""
    return dedup_lines(docs, count=None)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8) stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the table ``benchmark`` go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, each with its place in a sequence of 2048 tokens."""
    return pack_documents(docs, PackConfig(public_tokenizers.path("word_bpe_49k.json"), cached_words=CACHED_WORDS))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
