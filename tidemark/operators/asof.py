"""Point-in-time (as-of) left join of feature rows onto a spine.

For each spine row: the newest feature row of its key that was visible at its time.
All feature tables with the same key share one union and one window, so a service
pays one window shuffle per key set rather than one per table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import as_micros, effective_micros, instant_micros, micros
from tidemark.operators.cells import CELL, SECOND, inherited, with_cell
from tidemark.operators.points import AT, all_present, attach, points_of

RANK = "_rank"


@dataclass(frozen=True)
class FeatureTable:
    """Feature rows to look up. ``prefix`` goes in front of the output columns.

    Rows of equal time resolve by ``order``, the values of all columns of the view, so that a
    table with some of its features answers from the same row as one with all.
    """

    frame: DataFrame
    ts: str
    features: tuple[str, ...]
    prefix: str = ""
    schedule: timedelta | None = None
    ttl: timedelta | None = None
    order: tuple[str, ...] = ()


def _candidates(table: FeatureTable, keys: list[str], column: str) -> DataFrame:
    # The struct compares by visibility, then event time, then values: its maximum is
    # the newest row, and ties resolve the same way on every run.
    ts = F.col(f"`{table.ts}`")
    seen = effective_micros(ts, table.schedule)
    names = [*table.order, *(f for f in table.features if f not in table.order)]
    row = F.struct(*[F.col(f"`{n}`") for n in names])
    value = F.struct(seen.alias("seen"), as_micros(ts).alias("ts"), row.alias("row"))
    rows = table.frame.select(*[f"`{k}`" for k in keys], seen.alias(AT), value.alias(column))
    return rows.filter(all_present([*keys, AT]))


def asof_answers(
    points: DataFrame,
    keys: list[str],
    tables: list[FeatureTable],
    effective: bool = False,
) -> DataFrame:
    """Features at distinct ``points``, given by keys and ``_at`` in microseconds.

    One window by key and time cell, over the rows of the cell and the one it inherits.
    """
    values = [f"_v{i}" for i in range(len(tables))]
    candidates = [_candidates(t, keys, v) for t, v in zip(tables, values)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), candidates)
    newest = [F.max(v).alias(v) for v in values]
    rows = with_cell(stacked).groupBy(*keys, CELL, AT).agg(*newest)
    marks = with_cell(points)
    before = inherited(rows, marks, keys, values).withColumn(AT, F.col(CELL) * SECOND)
    ranked = [df.withColumn(RANK, F.lit(rank)) for rank, df in enumerate([before, rows, marks])]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    # At one time: what a cell inherits, then its own row, then points.
    order = Window.partitionBy(*keys, CELL).orderBy(AT, RANK)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    newest = [F.last(v, ignorenulls=True).over(so_far).alias(v) for v in values]
    found = both.select(*keys, AT, RANK, *newest).filter(F.col(RANK) == 2)
    out: list[Column] = []
    for table, value in zip(tables, values):
        alive = F.col(value).isNotNull()
        if table.ttl is not None:
            alive = F.col(f"{value}.ts") > F.col(AT) - F.lit(micros(table.ttl))
        for name in table.features:
            out.append(F.when(alive, F.col(f"{value}.row.`{name}`")).alias(table.prefix + name))
        if effective:
            seen = F.timestamp_micros(F.col(f"{value}.seen"))
            out.append(F.when(alive, seen).alias(f"{table.prefix}effective_ts"))
    return found.select(*keys, AT, *out)


def asof_join(
    spine: DataFrame,
    keys: list[str],
    ts: str,
    tables: list[FeatureTable],
    effective: bool = False,
) -> DataFrame:
    """Spine columns first and unchanged, then each table's features as of the row's time.

    A feature older than its table's ``ttl`` reads as null. ``effective`` also returns
    when the value used became visible.
    """
    at = as_micros(F.col(ts))
    answers = asof_answers(points_of(spine, keys, at), keys, tables, effective)
    return attach(spine, keys, at, answers)


def latest(table: FeatureTable, keys: list[str], moment: datetime | None = None) -> DataFrame:
    """Newest feature row per key, of those visible at a moment; combined before the shuffle."""
    rows = _candidates(table, keys, "_v")
    if moment is not None:
        rows = rows.filter(F.col(AT) <= instant_micros(moment))
    return (
        rows.groupBy(*keys)
        .agg(F.max("_v").alias("_v"))
        .select(
            *keys,
            F.timestamp_micros("_v.ts").alias(table.ts),
            F.timestamp_micros("_v.seen").alias("effective_ts"),
            *[F.col(f"_v.row.`{f}`").alias(f) for f in table.features],
        )
    )
