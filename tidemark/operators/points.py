"""Lookups by point: each distinct (key, time) of a spine is answered once.

A spine may hold many rows for one key, or score every row at one moment. What a row gets
depends only on its key and time, so these are made distinct first, combining before the
shuffle, then answered, then joined back. The join has one answer row per point, so a point
with very many spine rows is a skewed left side, which Spark splits at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AT = "_at"


def all_present(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def points_of(spine: DataFrame, keys: list[str], at: Column) -> DataFrame:
    """Distinct keys and position ``_at``; rows without a key or time have no point."""
    return spine.select(*keys, at.alias(AT)).filter(all_present([*keys, AT])).distinct()


def attach(spine: DataFrame, keys: list[str], at: Column, answers: DataFrame) -> DataFrame:
    """Every spine row once, its columns unchanged and first, then the answer's columns."""
    added = [c for c in answers.columns if c not in (*keys, AT)]
    taken = [c for c in added if c in spine.columns]
    if taken:
        raise ValueError(f"the spine already has columns {taken}; use a service to prefix them")
    joined = spine.withColumn(AT, at).join(answers, [*keys, AT], "left")
    return joined.select(*[f"`{c}`" for c in spine.columns], *[f"`{c}`" for c in added])
