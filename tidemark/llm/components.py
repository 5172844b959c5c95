"""Connected components of a table of links, by stars that grow and contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    moved = both.where("b > a").join(least, "a")
    return moved.select(F.col("least").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node move to the smallest of them, the node too."""
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    moved = links.join(least, "b")
    near = moved.where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return near.unionByName(least.select(F.col("least").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    ``links`` has columns a and b with a < b, any order and repeats. A node without links has
    no row. Each round halves the distances; a node with very many links is the many side of a
    join whose other side has one row for it, which adaptive execution splits.
    """
    links = settle(links.select("a", "b").where("a < b").distinct(), "links")
    before = _state(links)
    while before[0]:
        links = settle(_small_star(settle(_large_star(links), "stars")), "stars")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
