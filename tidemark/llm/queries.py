"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, fm_quality, lexical, line_dedup, lm_score, packing, pii, quotes, rules_quality, secrets_forest, simhash, spelling
from tidemark.llm.common import table


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(table(spark, folder, "documents"))


def op2_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """The table holds no quotations; its turns are first put into mails that quote each other."""
    mail = quotes.quoted_mail(table(spark, folder, "conversations"))
    found = quotes.conversations(mail)
    return found.select(
        "id", "thread", "parent", "depth", "n_levels", F.sha2("own", 256).alias("own_sha256")
    )


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_forest.report(table(spark, folder, "documents"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, folder, "documents")))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return fm_quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return rules_quality.judge(docs, rules_quality.train(docs, table(spark, folder, "labels")))


def op9_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(table(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"), slip=spelling.SLIP)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quotes": op2_quotes,
    "op3_secrets": op3_secrets,
    "op4_pii": op4_pii,
    "op5_bpe": op5_bpe,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_quality_rules": op8_quality_rules,
    "op9_lm_score": op9_lm_score,
    "op10_simhash": op10_simhash,
    "op11_packing": op11_packing,
    "op12_ranked_search": op12_ranked_search,
    "op13_spelling_variants": op13_spelling_variants,
}
