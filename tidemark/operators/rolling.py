"""Window aggregates in linear time, for continuous windows and very long ones.

A sliding frame re-adds the whole window for every row, which a dense key cannot afford, and what
has no inverse, such as a maximum, cannot be taken out of a running total either.
Here time is cut into cells, a whole number per window, and a value is put together from
three parts: the end of the cell the window starts in, the whole cells between, and the
start of the cell it ends in. Moving the events of the starting cell forward by one window
length puts all three parts of a point into one (key, cell) group, so two running totals, one
from the front and one from the back, finish it: linear work, one shuffle, and a group that is a small fraction of a window long
however many events a key has.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.aggregates import MERGED, PARTIALS, Aggregate, merge_of, partials_of
from tidemark.functions.time import CONTINUOUS, floor_div, micros
from tidemark.operators.points import AT
from tidemark.operators.tiles import EPOCH, EPOCH_WINDOWS, TileSet, keep_newest, repeat_over_epochs

CELL = "_cell"
#: Cells per window at most. A longer continuous window has longer cells; results are the same.
MAX_CELLS = 512
MANY_CELLS = 4096
HOUR = micros(timedelta(hours=1))


def _cells_per_window(window: int, interval: timedelta) -> int:
    """Number of equal cells, for a window given in intervals.

    Continuous windows get cells of about an hour, so that a dense key is split over many
    tasks and short windows need no whole cells in between. Windows over tiles balance
    the tiles in a cell against the cells in a window.
    """
    if interval == CONTINUOUS:
        least = -(-window // HOUR)
    else:
        least = math.isqrt(window)
    least = min(least, MAX_CELLS)
    fine = [n for n in range(least, MAX_CELLS + 1) if window % n == 0]
    return fine[0] if fine else next(n for n in range(least, 0, -1) if window % n == 0)


def _between(
    ends: DataFrame,
    events: DataFrame,
    keys: list[str],
    interval: timedelta,
    cell: int,
    wanted: dict[int, list[str]],
) -> DataFrame:
    """Partials over the whole cells of each window before an end cell, as rows in front of it.

    ``wanted`` has the partials of each window, by the window's length in intervals.
    """
    partials = sorted({p for listed in wanted.values() for p in listed})
    coarse = (
        events.withColumn(AT, floor_div(F.col(AT), cell))
        .groupBy(*keys, AT)
        .agg(*[merge_of(p)(p).alias(p) for p in partials])
    )
    done = over_cells(ends, coarse, keys, {w // cell - 1: listed for w, listed in wanted.items()})
    return done.select(
        *keys,
        F.col(AT).alias(CELL),
        (F.col(AT) * cell - 1).alias(AT),
        *[F.col(f"_{w // cell - 1}_{p}").alias(f"_mid{w}_{p}") for w, listed in wanted.items() for p in listed],
    )


def over_cells(points: DataFrame, cells: DataFrame, keys: list[str], wanted: dict[int, list[str]]) -> DataFrame:
    """Partials over the ``w`` cells before each point, as ``_<w>_<partial>``; a sliding frame each.

    Cells are few per window, so the frames are short; epochs bound what a task sees of a key.
    """
    reach = max(wanted)
    length = EPOCH_WINDOWS * reach
    marks = points.select(*keys, AT, floor_div(F.col(AT), length).alias(EPOCH), F.lit(True).alias("_point"))
    both = repeat_over_epochs(cells, reach, length).unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy(*keys, EPOCH).orderBy(AT)
    found = both.select(
        *keys, AT, "_point",
        *[merge_of(p)(p).over(order.rangeBetween(-w, -1)).alias(f"_{w}_{p}") for w, listed in wanted.items() for p in listed],
    )
    return found.filter("_point").drop("_point")


def _passes(merged: list[Aggregate], interval: timedelta) -> list[list[Aggregate]]:
    """All windows together, or one length at a time where they have no usable common cell."""
    lengths = sorted({a.buckets(interval) for a in merged})
    if not lengths:
        return []
    common = math.gcd(*lengths)
    if lengths[-1] * _cells_per_window(common, interval) // common <= MANY_CELLS:
        return [merged]
    return [[a for a in merged if a.buckets(interval) == w] for w in lengths]


def _all_windows(points: DataFrame, tiles: TileSet, wanted: list[Aggregate]) -> DataFrame:
    """All window lengths in one union and one pair of running totals.

    The cells are the same for all lengths, so the events before a point in its cell are summed
    once; each length adds the events of the cell it starts in, moved forward, and its sum over
    the whole cells between.
    """
    keys, interval = list(tiles.keys), tiles.interval
    lengths = sorted({a.buckets(interval) for a in wanted})
    common = math.gcd(*lengths)
    cell = common // _cells_per_window(common, interval)
    needed: dict[int, list[str]] = {}
    for w in lengths:
        mine = [a for a in wanted if a.buckets(interval) == w]
        needed[w] = partials_of(mine)
    partials = sorted({p for listed in needed.values() for p in listed})
    events = tiles.merged.select(*keys, AT, *partials)
    # A continuous point sees events up to and including its own microsecond.
    after = 1 if interval == CONTINUOUS else 0
    end = F.col(AT) + after
    marks = points.select(
        *keys, floor_div(end, cell).alias(CELL), end.alias(AT), F.lit(True).alias("_point")
    )
    late = events.select(
        *keys,
        floor_div(F.col(AT), cell).alias(CELL),
        AT,
        *[F.col(p).alias(f"_pre_{p}") for p in partials],
    )
    early = [
        events.select(
            *keys,
            floor_div(F.col(AT) + w, cell).alias(CELL),
            (F.col(AT) + w).alias(AT),
            *[F.col(p).alias(f"_suf{w}_{p}") for p in needed[w]],
        )
        for w in lengths
    ]
    parts = [late, *early, marks]
    spread = {w: needed[w] for w in lengths if w > cell}
    if spread:
        ends = marks.select(*keys, F.col(CELL).alias(AT)).distinct()
        parts.append(_between(ends, events, keys, interval, cell, spread))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    by = Window.partitionBy(*keys, CELL)
    forward = by.orderBy(AT).rangeBetween(Window.unboundedPreceding, -1)
    backward = by.orderBy(F.desc(AT)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = [f"_pre_{p}" for p in partials] + [f"_mid{w}_{p}" for w, listed in spread.items() for p in listed]
    behind = [f"_suf{w}_{p}" for w in lengths for p in needed[w]]
    found = both.select(
        *keys,
        (F.col(AT) - after).alias(AT),
        "_point",
        *[merge_of(c.split("_", 2)[2])(c).over(forward).alias(c) for c in before],
        *[merge_of(c.split("_", 2)[2])(c).over(backward).alias(c) for c in behind],
    ).filter("_point")

    def total(p: str, w: int) -> Column:
        """What the three parts come to; a part without events is null and adds nothing."""
        names = [f"_pre_{p}", f"_suf{w}_{p}", *([f"_mid{w}_{p}"] if w in spread else [])]
        combine = PARTIALS[p[0]].combine
        return reduce(lambda a, b: F.coalesce(combine(a, b), a, b), [F.col(n) for n in names])

    def value(a: Aggregate) -> Column:
        w = a.buckets(interval)
        if a.function == "count":
            return total(f"n_{a.column}", w)
        if a.function == "sum":
            return total(f"s_{a.column}", w)
        if a.function in ("min", "max"):
            return total(*a.partials, w)
        if a.function == "approx_distinct":
            return F.hll_sketch_estimate(total(*a.partials, w))
        n = total(f"n_{a.column}", w)
        return F.when(n > 0, total(f"s_{a.column}", w) / n)

    return found.select(*keys, AT, *[value(a).alias(a.feature(interval)) for a in wanted])


def _before_cells(
    rows: DataFrame,
    ends: DataFrame,
    keys: list[str],
    value: Callable[[WindowSpec], Column],
    name: str,
) -> DataFrame:
    """What each end cell inherits from all cells before it, as a row in front of the cell.

    ``rows`` has one row per key and cell; ``value`` turns a window into the inherited value.
    """
    marks = ends.withColumn("_end", F.lit(True))
    both = rows.unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy(CELL)
    earlier = order.rangeBetween(Window.unboundedPreceding, -1)
    found = both.select(*keys, CELL, "_end", value(earlier).alias(name)).filter("_end")
    return found.select(*keys, CELL, (F.col(CELL) * HOUR - 1).alias(AT), name)


def _hourly(points: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Points as marks in hour cells, at the first microsecond they do not see."""
    end = F.col(AT) + 1
    marks = points.select(
        *keys, floor_div(end, HOUR).alias(CELL), end.alias(AT), F.lit(True).alias("_point")
    )
    return marks, marks.select(*keys, CELL).distinct()


def _distinct(points: DataFrame, tiles: TileSet, a: Aggregate) -> DataFrame:
    """Continuous distinct counts, as running sums of values entering and leaving.

    The next sighting of a value is found within hour cells, each closed by the first
    sighting of the next one, so that no task gets all sightings of a frequent value.
    """
    keys, window = list(tiles.keys), micros(a.window)
    seen = tiles.distinct[a.column].withColumn(CELL, floor_div(F.col(AT), HOUR))
    cells = seen.groupBy(*keys, "_value", CELL).agg(F.min(AT).alias("_first"))
    by_value = Window.partitionBy(*keys, "_value").orderBy(CELL)
    closing = cells.select(
        *keys, "_value", CELL, F.lead("_first").over(by_value).alias(AT), F.lit(True).alias("_closing")
    ).filter(F.col(AT).isNotNull())
    in_cell = Window.partitionBy(*keys, "_value", CELL).orderBy(AT)
    spans = (
        seen.unionByName(closing, allowMissingColumns=True)
        .withColumn("_next", F.lead(AT).over(in_cell))
        .filter(F.col("_closing").isNull())
    )
    until = F.least(F.col(AT) + window, F.col("_next")) + 1
    enter = F.struct((F.col(AT) + 1).alias(AT), F.lit(1).cast("long").alias("_step"))
    leave = F.struct(until.alias(AT), F.lit(-1).cast("long").alias("_step"))
    steps = (
        spans.select(*keys, F.explode(F.array(enter, leave)).alias("_s"))
        .select(*keys, "_s.*")
        .groupBy(*keys, AT)
        .agg(F.sum("_step").alias("_step"))
        .withColumn(CELL, floor_div(F.col(AT), HOUR))
    )
    marks, ends = _hourly(points, keys)
    per_cell = steps.groupBy(*keys, CELL).agg(F.sum("_step").alias("_step"))
    inherited = _before_cells(per_cell, ends, keys, lambda w: F.sum("_step").over(w), "_step")
    both = steps.unionByName(inherited).unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy(*keys, CELL).orderBy(AT)
    so_far = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    name = a.feature(CONTINUOUS)
    found = both.select(*keys, AT, "_point", F.sum("_step").over(so_far).alias(name))
    return found.filter("_point").select(*keys, (F.col(AT) - 1).alias(AT), name)


def _last(points: DataFrame, tiles: TileSet, wanted: list[Aggregate]) -> DataFrame:
    """Continuous last N: the newest few of the hour so far, after those it inherits."""
    keys, size = list(tiles.keys), wanted[0].size
    rows = tiles.recent[(wanted[0].column, size)].withColumn(CELL, floor_div(F.col(AT), HOUR))
    item = F.struct("_ts", "_value")

    def lists(df: DataFrame, by: list[str], until: str, name: str) -> DataFrame:
        """Newest few up to and including each value of ``until``."""
        order = Window.partitionBy(*by).orderBy("_ts", "_value")
        listed = df.select(
            *keys,
            CELL,
            AT,
            F.collect_list(item).over(order.rowsBetween(1 - size, 0)).alias(name),
            F.lead(until).over(order).alias("_next"),
        )
        return listed.filter(F.col("_next").isNull() | (F.col("_next") != F.col(until)))

    own = lists(rows, [*keys, CELL], AT, "_own").drop("_next")
    few = keep_newest(rows, [*keys, CELL], size)
    per_cell = lists(few, keys, CELL, "_list").select(*keys, CELL, "_list")
    marks, ends = _hourly(points, keys)
    inherited = _before_cells(
        per_cell, ends, keys, lambda w: F.last("_list", ignorenulls=True).over(w), "_old"
    )
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [own, inherited, marks])
    order = Window.partitionBy(*keys, CELL).orderBy(AT)
    earlier = order.rangeBetween(Window.unboundedPreceding, -1)
    newest = [F.last(c, ignorenulls=True).over(earlier).alias(c) for c in ("_own", "_old")]
    found = both.select(*keys, (F.col(AT) - 1).alias(AT), "_point", *newest).filter("_point")
    joined = F.coalesce(F.concat("_old", "_own"), "_own", "_old")

    def value(a: Aggregate):
        oldest = F.col(AT) - micros(a.window)
        inside = F.filter(F.col("_all"), lambda i: i["_ts"] > oldest)
        kept = F.slice(F.reverse(F.transform(inside, lambda i: i["_value"])), 1, size)
        return F.when(F.size(inside) > 0, kept).alias(a.feature(CONTINUOUS))

    return found.withColumn("_all", joined).select(*keys, AT, *[value(a) for a in wanted])


def linear_answers(points: DataFrame, tiles: TileSet, aggregates: list[Aggregate]) -> DataFrame:
    """Values at distinct ``points``: one pass for all windows, and one per distinct count or list.

    Distinct counts and lists are linear over tiles anyway, so they come here only for the
    continuous interval.
    """
    merged = [a for a in aggregates if a.function in MERGED]
    listed = [a for a in aggregates if a.function == "last"]
    done = [_all_windows(points, tiles, g) for g in _passes(merged, tiles.interval)]
    done += [_distinct(points, tiles, a) for a in aggregates if a.function == "distinct"]
    done += [
        _last(points, tiles, [a for a in listed if (a.column, a.size) == pair])
        for pair in sorted({(a.column, a.size) for a in listed})
    ]
    return reduce(lambda a, b: a.join(b, [*tiles.keys, AT], "inner"), done)
