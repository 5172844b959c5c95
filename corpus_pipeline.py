"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, fm_quality, jaccard, line_dedup
from tidemark.llm.common import settle, table


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return fm_quality.keep_good(docs, table(spark, folder, "labels"))


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without lines whose template recurs; those that repeat others whole go."""
    return line_dedup.without_recurring(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that SimHash or exact similarity links: the one with the smallest id."""
    return jaccard.deduplicate(docs, by_prints=True)


def benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.decontaminate(docs, table(spark, folder, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The ids of each document, packed, with their number and the text they decode to."""
    return bpe.round_trip(docs).select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("bpe", tokens),
]

#: SQL can neither train the classifier nor encode; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
