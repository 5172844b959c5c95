"""Time cells: cutting the rows of every key so that none is one task.

A cell is a second of one key, a block 8,192 cells. A task sees the rows of a cell, or one row per
cell of a block, or one row per block of a key, never all rows of a key. What a cell needs
from earlier times comes to it as one row. There is no list of large keys and no threshold: all
keys are cut alike, and rows at the same instant are one row before they are cut.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import floor_div, micros
from tidemark.operators.points import AT

CELL = "_cell"
BLOCK = "_block"
SECOND = micros(timedelta(seconds=1))
PER_BLOCK = 8192


def with_cell(df: DataFrame) -> DataFrame:
    return df.withColumn(CELL, floor_div(F.col(AT), SECOND))


def _earlier(rows: DataFrame, ends: DataFrame, group: list[str], by: str, values: list[str]) -> DataFrame:
    """For each end, the maximum of every value over the rows of its group before it."""
    both = rows.unionByName(ends.withColumn("_end", F.lit(True)), allowMissingColumns=True)
    before = Window.partitionBy(*group).orderBy(by).rangeBetween(Window.unboundedPreceding, -1)
    found = both.select(*ends.columns, "_end", *[F.max(v).over(before).alias(v) for v in values])
    return found.filter("_end").drop("_end")


def inherited(rows: DataFrame, marks: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The maximum of each value over all cells before a cell, for each cell that holds a mark.

    First from the blocks before its block, then from the cells before it in its block.
    """
    newest = [F.max(v).alias(v) for v in values]
    block = floor_div(F.col(CELL), PER_BLOCK)
    cells = rows.groupBy(*keys, CELL).agg(*newest).withColumn(BLOCK, block)
    ends = marks.select(*keys, CELL).distinct().withColumn(BLOCK, block)
    blocks = cells.groupBy(*keys, BLOCK).agg(*newest)
    from_blocks = _earlier(blocks, ends.select(*keys, BLOCK).distinct(), keys, BLOCK, values)
    first = from_blocks.withColumn(CELL, F.col(BLOCK) * PER_BLOCK - 1)
    group = [*keys, BLOCK]
    return _earlier(cells.unionByName(first), ends, group, CELL, values).drop(BLOCK)
