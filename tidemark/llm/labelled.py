"""The bounded sample of labelled documents that quality models are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out


def labelled_sample(
    docs: DataFrame, labels: DataFrame, bound: int, key: str = "doc_id", text: str = "text", label: str = "quality", extra: tuple = ()
) -> DataFrame:
    """(key, text, label, *extra) of at most ``bound`` labelled documents outside the held-out fold.

    The sample is the same for the same tables: ids in the order of their hash. A document with
    several labels counts by the lowest, of rows that repeat an id the first by text counts. Null
    ids and labels are left out. Labels are cut to the bound before they meet the documents, so
    what is broadcast has at most ``bound`` rows.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(bound)
    )
    mine = docs.select(F.col(key).alias("key"), F.struct(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *extra).alias("row"))
    found = mine.join(F.broadcast(known), "key").groupBy("key", "label").agg(F.min("row").alias("row"))
    return found.select("key", "label", "row.*")
