"""Window aggregates joined onto a spine, tiled or continuous."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.aggregates import MERGED, SUMMED, Aggregate, check
from tidemark.functions.time import CONTINUOUS, bucket, bucket_start
from tidemark.operators.points import AT, attach, points_of
from tidemark.operators.rolling import linear_answers
from tidemark.operators.tiles import TileSet, boundaries, fill_empty, finish

#: Windows over more intervals are put together from cells instead of adding up every tile for
#: every point. Values are the same but for the order in which floats are added.
LONG = 1024


def combine(sets: list[tuple[TileSet, list[Aggregate]]]) -> tuple[TileSet, list[Aggregate]]:
    """Tiles of several views with the same keys and interval as one set.

    Columns are numbered by view. A window adds up rows, so cells of different views may
    stay rows of their own.
    """
    keys, interval = sets[0][0].keys, sets[0][0].interval
    merged, distinct, recent, newest, wanted = [], {}, {}, {}, []
    for i, (tiles, aggregates) in enumerate(sets):
        if tiles.merged is not None:
            partials = [c for c in tiles.merged.columns if c not in (*keys, AT)]
            renamed = [F.col(c).alias(f"{c[:2]}{i}_{c[2:]}") for c in partials]
            merged.append(tiles.merged.select(*keys, AT, *renamed))
        distinct |= {f"{i}_{c}": part for c, part in tiles.distinct.items()}
        recent |= {(f"{i}_{c}", n): part for (c, n), part in tiles.recent.items()}
        newest |= {(f"{i}_{c}", n): part for (c, n), part in tiles.newest.items()}
        wanted += [replace(a, column=f"{i}_{a.column}") for a in aggregates]
    stacked = None
    if merged:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), merged)
    return TileSet(keys, interval, stacked, distinct, recent, newest), wanted


def answers(points: DataFrame, tiles: TileSet, aggregates: list[Aggregate]) -> DataFrame:
    """Values at distinct points.

    Counts, sums and means over very many intervals, and all continuous ones, take the way
    whose work does not grow with the window; so do least and greatest values and sketches, which
    cannot be taken out of a window again.
    """

    def is_long(a: Aggregate) -> bool:
        return a.function in MERGED and (a.function not in SUMMED or a.buckets(tiles.interval) > LONG)

    long = [a for a in aggregates if tiles.interval == CONTINUOUS or is_long(a)]
    short = [a for a in aggregates if a not in long]
    parts = []
    if short:
        parts.append(finish(points, tiles, short))
    if long:
        parts.append(linear_answers(points, tiles, long))
    return reduce(lambda a, b: a.join(b, [*tiles.keys, AT], "inner"), parts)


Part = tuple[str, TileSet, list[Aggregate]]


def part_answers(points: DataFrame, parts: list[Part]) -> DataFrame:
    """Values of several parts at distinct points, under their output names.

    A part is an output prefix, its tiles and its aggregates. Parts share keys and interval,
    and with that one window.
    """
    sets = [(tiles, aggregates) for _, tiles, aggregates in parts]
    tiles, wanted = combine(sets) if len(sets) > 1 else sets[0]
    check(wanted, tiles.interval)
    found = answers(points, tiles, wanted)
    renamed = [
        F.col(a.feature(tiles.interval)).alias(n) for a, n in zip(wanted, part_names(parts))
    ]
    return found.select(*tiles.keys, AT, *renamed)


def part_names(parts: list[Part]) -> list[str]:
    return [p + a.feature(tiles.interval) for p, tiles, listed in parts for a in listed]


def complete(df: DataFrame, ts: str, parts: list[Part], effective: bool) -> DataFrame:
    """0 where a part has nothing to count and, if asked for, effective times."""
    done = fill_empty(df, part_names(parts), [a for _, _, listed in parts for a in listed])
    if not effective:
        return done
    return done.withColumns(
        {
            f"{prefix}effective_ts": bucket_start(bucket(F.col(ts), tiles.interval), tiles.interval)
            for prefix, tiles, _ in parts
        }
    )


def aggregates_asof(
    spine: DataFrame, ts: str, parts: list[Part], effective: bool = False
) -> DataFrame:
    """Spine columns first and unchanged, then the aggregates of all parts."""
    _, tiles, _ = parts[0]
    keys, at = list(tiles.keys), bucket(F.col(ts), tiles.interval)
    found = part_answers(points_of(spine, keys, at), parts)
    return complete(attach(spine, keys, at, found), ts, parts, effective)


def aggregate_asof(
    spine: DataFrame, ts: str, tiles: TileSet, aggregates: list[Aggregate], **options
) -> DataFrame:
    """Spine columns first and unchanged, then each aggregate as of the row's time."""
    return aggregates_asof(spine, ts, [("", tiles, aggregates)], **options)


def rolled(
    tiles: TileSet,
    aggregates: list[Aggregate],
    low: int | None = None,
    high: int | None = None,
) -> DataFrame:
    """Values per key at each interval boundary in ``[low, high)``, while not empty."""
    check(aggregates, tiles.interval)
    reach = max(a.buckets(tiles.interval) for a in aggregates)
    points = boundaries(tiles, reach, low, high)
    names = [a.feature(tiles.interval) for a in aggregates]
    done = fill_empty(answers(points, tiles, aggregates), names, aggregates)
    return done.select(
        *tiles.keys, bucket_start(F.col(AT), tiles.interval).alias("window_end"), *names
    )
