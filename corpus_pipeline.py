"""A corpus cleaned in five stages, each a job over all that its predecessor kept.

``run`` writes what a stage returns as a table in the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import decontaminate, line_dedup, ngram_join, quality
from tallybook.llm.common import table, written
from tallybook.llm.queries import bpe_digests
from tallybook.session import release_shuffles


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail; n_chars stays that of the source."""
    return quality.cut_failed_lines(docs)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that match an earlier one; n_chars stays that of the source."""
    release_shuffles(spark)
    return line_dedup.without_repeated_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each near-duplicate group."""
    return ngram_join.representatives(docs)


def drop_benchmark_holders(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of each text."""
    return bpe_digests(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", cut_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_holders),
    ("byte-level BPE", encode_bytes),
]

#: Template windows have no form in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
