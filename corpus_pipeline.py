"""Cleaning a corpus in five stages, each over all that its predecessor kept.

Every stage takes (spark, docs, folder of the tables) and returns a table; all but the
last return the columns of ``documents``. Between stages the table is written to the
shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lurewatch import ship
from lurewatch.llm import bpe_codec, decontaminate, exact_dedup, jaccard_join, quality
from lurewatch.llm.common import stored, table
from lurewatch.llm.queries import vocabulary_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of documents at hand."""
    ship(spark)
    return quality.keep_good(docs, quality.fit_classifier(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the smallest id stays."""
    ship(spark)
    return jaccard_join.drop_similar(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def code_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and of the text that they decode to."""
    ship(spark)
    return bpe_codec.round_trip(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_text),
    ("bpe_round_trip", code_tokens),
]

#: The stages fit a network and follow links: SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
