"""Tiled time-window aggregates.

Events collapse into one partial aggregate per key and interval (a tile). A value as of
time ``t`` is finished from the tiles of ``[T - window, T)`` with ``T`` the start of the
interval that holds ``t``. Tiles can be stored, appended to and merged, because every
partial here is mergeable.

The window over tiles is cut into epochs of a few window lengths; a tile near the end of
an epoch is repeated in the next one. A task therefore sees a bounded number of tiles of
a key, however long the history and however many events the key has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.aggregates import COUNTS, LISTS, MERGED, PARTIALS, Aggregate, check, merge_of, partials_of
from tidemark.functions.time import as_micros, bucket, floor_div, micros
from tidemark.operators.points import AT, all_present

EPOCH = "_epoch"
EPOCH_WINDOWS = 4


@dataclass(frozen=True)
class TileSet:
    """Tiles of one view. All frames carry the keys and the interval number ``_at``.

    ``merged`` has one row per key and interval with its partials: counts ``n_<column>``, sums
    ``s_<column>``, least and greatest values ``l_<column>`` and ``g_<column>``, sketches
    ``h_<column>``. ``distinct`` has one row per key, interval and value; ``recent`` the newest few
    values of each interval, ``newest`` the newest few different ones at their newest times.
    """

    keys: tuple[str, ...]
    interval: timedelta
    merged: DataFrame | None = None
    distinct: dict[str, DataFrame] = field(default_factory=dict)
    recent: dict[tuple[str, int], DataFrame] = field(default_factory=dict)
    newest: dict[tuple[str, int], DataFrame] = field(default_factory=dict)

    def parts(self) -> dict[str, DataFrame]:
        """Every frame under a name that can serve as a folder name."""
        named = {} if self.merged is None else {"merged": self.merged}
        named |= {f"distinct_{c}": d for c, d in self.distinct.items()}
        named |= {f"recent{n}_{c}": d for (c, n), d in self.recent.items()}
        return named | {f"newest{n}_{c}": d for (c, n), d in self.newest.items()}

    def map(self, change: Callable[[DataFrame], DataFrame]) -> TileSet:
        return self.replace({name: change(df) for name, df in self.parts().items()})

    def replace(self, named: dict[str, DataFrame]) -> TileSet:
        return TileSet(
            self.keys,
            self.interval,
            named.get("merged"),
            {c: named[f"distinct_{c}"] for c in self.distinct},
            {(c, n): named[f"recent{n}_{c}"] for c, n in self.recent},
            {(c, n): named[f"newest{n}_{c}"] for c, n in self.newest},
        )

    def cells(self) -> DataFrame:
        """The (key, interval) pairs that hold any event."""
        pairs = [df.select(*self.keys, AT) for df in self.parts().values()]
        if len(pairs) == 1 and self.merged is not None:
            return pairs[0]
        return reduce(DataFrame.unionByName, pairs).distinct()


def keep_newest(df: DataFrame, by: list[str], size: int) -> DataFrame:
    # A rank filter: Spark drops all but `size` rows per group before the shuffle too.
    order = Window.partitionBy(*by).orderBy(F.desc("_ts"), F.desc("_value"))
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= size).drop("_rank")


def keep_newest_values(df: DataFrame, by: list[str], size: int) -> DataFrame:
    """The newest few different values, each with its newest time."""
    return keep_newest(df.groupBy(*by, "_value").agg(F.max("_ts").alias("_ts")), by, size)


def build_tiles(
    events: DataFrame,
    keys: list[str],
    ts: str,
    aggregates: list[Aggregate],
    interval: timedelta,
) -> TileSet:
    """Partial aggregates per key and interval. Rows without key or time count nowhere."""
    check(aggregates, interval)
    rows = events.filter(all_present([*keys, ts])).withColumn(AT, bucket(F.col(ts), interval))
    by = [*keys, AT]
    partials = partials_of(aggregates)
    merged = None
    if partials:
        merged = rows.groupBy(*by).agg(*[PARTIALS[p[0]].build(p[2:]).alias(p) for p in partials])
    distinct = {
        c: rows.select(*by, F.col(c).alias("_value")).filter("_value IS NOT NULL").distinct()
        for c in sorted({a.column for a in aggregates if a.function == "distinct"})
    }

    def stamped(c: str) -> DataFrame:
        found = rows.select(*by, as_micros(F.col(ts)).alias("_ts"), F.col(c).alias("_value"))
        return found.filter("_value IS NOT NULL")

    lists = {f: sorted({(a.column, a.size) for a in aggregates if a.function == f}) for f in LISTS}
    recent = {(c, n): keep_newest(stamped(c), by, n) for c, n in lists["last"]}
    newest = {(c, n): keep_newest_values(stamped(c), by, n) for c, n in lists["last_distinct"]}
    return TileSet(tuple(keys), interval, merged, distinct, recent, newest)


def merge_tiles(tiles: TileSet) -> TileSet:
    """One row per cell again, after partial tiles of several writes were put together."""
    by = [*tiles.keys, AT]

    def merge(name: str, df: DataFrame) -> DataFrame:
        if name == "merged":
            added = [c for c in df.columns if c not in by]
            return df.groupBy(*by).agg(*[merge_of(c)(c).alias(c) for c in added])
        if name.startswith("distinct_"):
            return df.select(*by, "_value").distinct()
        kind, size = name[:6], int(name.split("_", 1)[0][6:])
        keep = keep_newest if kind == "recent" else keep_newest_values
        return keep(df.select(*by, "_ts", "_value"), by, size)

    return tiles.replace({name: merge(name, df) for name, df in tiles.parts().items()})


def repeat_over_epochs(df: DataFrame, reach: int, length: int) -> DataFrame:
    """Each tile in every epoch that holds a point whose window can reach it: one or two."""
    first = floor_div(F.col(AT) + 1, length)
    final = floor_div(F.col(AT) + reach, length)
    return df.withColumn(EPOCH, F.explode(F.sequence(first, final)))


def _presence_steps(
    df: DataFrame, keys: list[str], column: str, windows: list[int], length: int
) -> DataFrame:
    """Distinct counts as steps: +1 when a value enters the window, -1 when it leaves.

    A value seen in interval ``b`` is inside the window of the points ``b+1 .. b+W``. Cut
    at the value's next sighting, these spans never overlap for one value, so the running
    sum of steps is the number of different values, and no set is ever collected.
    """
    order = Window.partitionBy(*keys, "_value").orderBy(AT)
    begin, until = F.col("_from"), F.col("_until")
    spans = (
        df.withColumn("_next", F.lead(AT).over(order))
        .withColumn("_w", F.explode(F.array(*[F.lit(w) for w in windows])))
        .select(
            *keys,
            "_w",
            (F.col(AT) + 1).alias("_from"),
            (F.least(F.col(AT) + F.col("_w"), F.col("_next")) + 1).alias("_until"),
        )
    )
    epochs = F.sequence(floor_div(begin, length), floor_div(until - 1, length))
    enter = F.struct(F.greatest(begin, F.col(EPOCH) * length).alias(AT), F.lit(1).alias("_step"))
    leave = F.struct(until.alias(AT), F.lit(-1).alias("_step"))
    steps = (
        spans.withColumn(EPOCH, F.explode(epochs))
        .select(*keys, EPOCH, "_w", F.explode(F.array(enter, leave)).alias("_s"))
        .select(*keys, EPOCH, "_w", "_s.*")
        .filter(floor_div(F.col(AT), length) == F.col(EPOCH))
    )
    return steps.groupBy(*keys, EPOCH, AT).agg(
        *[
            F.sum(F.when(F.col("_w") == w, F.col("_step")).otherwise(0)).alias(f"d_{column}_{w}")
            for w in windows
        ]
    )


def _recent_lists(df: DataFrame, keys: list[str], name: str, size: int) -> DataFrame:
    """Per cell, the newest ``size`` values up to and including it."""
    order = Window.partitionBy(*keys, EPOCH).orderBy("_ts", "_value")
    item = F.struct("_ts", "_value")
    listed = df.select(
        *keys,
        EPOCH,
        AT,
        F.collect_list(item).over(order.rowsBetween(1 - size, 0)).alias(name),
        F.lead(AT).over(order).alias("_next"),
    )
    ends = F.col("_next").isNull() | (F.col("_next") != F.col(AT))
    return listed.filter(ends).drop("_next")


def _newest_lists(df: DataFrame, keys: list[str], name: str, size: int, reach: int) -> DataFrame:
    """Per cell, the newest ``size`` different values up to and including it, newest first.

    A value may be in any number of cells, so no fixed number of earlier rows is enough. Lists are
    put together by doubling: after k steps a cell's list covers 2^k cells that hold data, and no
    window has more of them than intervals. All steps share one order of the rows.
    """
    order = Window.partitionBy(*keys, EPOCH).orderBy(AT)
    item = F.struct("_ts", "_value")
    listed = df.groupBy(*keys, EPOCH, AT).agg(F.sort_array(F.collect_list(item), asc=False).alias(name))
    for k in range((reach - 1).bit_length()):
        listed = listed.withColumn("_older", F.lag(name, 1 << k).over(order))
        known = F.transform(F.col(name), lambda i: i["_value"])
        more = F.filter("_older", lambda i: ~F.array_contains(known, i["_value"]))
        both = F.slice(F.concat(F.col(name), F.coalesce(more, F.filter(name, lambda _: F.lit(False)))), 1, size)
        listed = listed.withColumn(name, both).drop("_older")
    return listed


def finish(points: DataFrame, tiles: TileSet, aggregates: list[Aggregate]) -> DataFrame:
    """Values at distinct ``points``, given by keys and an interval number ``_at``.

    All aggregates share one union and one window shuffle.
    """
    keys, interval = list(tiles.keys), tiles.interval
    reach = max(a.buckets(interval) for a in aggregates)
    length = EPOCH_WINDOWS * reach
    wanted = [a for a in aggregates if a.function in MERGED]
    rows = []
    if wanted:
        merged = tiles.merged.select(*keys, AT, *partials_of(wanted))
        rows.append(repeat_over_epochs(merged, reach, length))
    for column in {a.column: None for a in aggregates if a.function == "distinct"}:
        windows = sorted(
            a.buckets(interval)
            for a in aggregates
            if a.function == "distinct" and a.column == column
        )
        rows.append(_presence_steps(tiles.distinct[column], keys, column, windows, length))
    for column, size in {(a.column, a.size): None for a in aggregates if a.function == "last"}:
        repeated = repeat_over_epochs(tiles.recent[(column, size)], reach, length)
        rows.append(_recent_lists(repeated, keys, f"r_{column}_{size}", size))
    different = [a for a in aggregates if a.function == "last_distinct"]
    for column, size in {(a.column, a.size): None for a in different}:
        repeated = repeat_over_epochs(tiles.newest[(column, size)], reach, length)
        longest = max(a.buckets(interval) for a in different if (a.column, a.size) == (column, size))
        rows.append(_newest_lists(repeated, keys, f"v_{column}_{size}", size, longest))
    marks = points.select(
        *keys, AT, floor_div(F.col(AT), length).alias(EPOCH), F.lit(True).alias("_point")
    )
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*rows, marks])
    order = Window.partitionBy(*keys, EPOCH).orderBy(AT)
    raw = [_raw(a, order, interval).alias(f"_a{i}") for i, a in enumerate(aggregates)]
    found = both.select(*keys, AT, "_point", *raw).filter("_point")
    done = [
        _finished(a, F.col(f"_a{i}"), interval).alias(a.feature(interval))
        for i, a in enumerate(aggregates)
    ]
    return found.select(*keys, AT, *done)


def _raw(a: Aggregate, order: WindowSpec, interval: timedelta) -> Column:
    trailing = order.rangeBetween(-a.buckets(interval), -1)
    if a.function == "count":
        return F.sum(f"n_{a.column}").over(trailing)
    if a.function == "sum":
        return F.sum(f"s_{a.column}").over(trailing)
    if a.function == "mean":
        # A window of nothing but nulls counts 0 and has no mean.
        total, n = F.sum(f"s_{a.column}").over(trailing), F.sum(f"n_{a.column}").over(trailing)
        return F.when(n > 0, total / n)
    if a.function == "distinct":
        steps = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum(f"d_{a.column}_{a.buckets(interval)}").over(steps)
    if a.function in LISTS:
        before = order.rangeBetween(Window.unboundedPreceding, -1)
        name = "r" if a.function == "last" else "v"
        return F.last(f"{name}_{a.column}_{a.size}", ignorenulls=True).over(before)
    raise ValueError(f"{a.function} is finished in linear time only")


def _finished(a: Aggregate, raw: Column, interval: timedelta) -> Column:
    if a.function not in LISTS:
        return raw
    oldest = (F.col(AT) - a.buckets(interval)) * F.lit(micros(interval))
    inside = F.filter(raw, lambda item: item["_ts"] >= oldest)
    values = F.transform(inside, lambda item: item["_value"])
    values = F.reverse(values) if a.function == "last" else values
    return F.when(F.size(inside) > 0, values)


def fill_empty(df: DataFrame, names: list[str], aggregates: list[Aggregate]) -> DataFrame:
    """Nothing seen counts as 0; sums, means and lists of nothing stay null."""
    zero = [n for n, a in zip(names, aggregates) if a.function in COUNTS]
    return df.withColumns({n: F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in zero})


def boundaries(tiles: TileSet, reach: int, low: int | None, high: int | None) -> DataFrame:
    """Interval boundaries at which a key has a non-empty window, each once.

    A cell covers the boundaries after it, up to the key's next cell or the window length.
    """
    keys = list(tiles.keys)
    following = F.lead(AT).over(Window.partitionBy(*keys).orderBy(AT))
    spans = tiles.cells().withColumn("_next", following)
    final = F.least(F.col(AT) + reach, F.col("_next"))
    first = F.col(AT) + 1
    if low is not None:
        first = F.greatest(first, F.lit(low))
    if high is not None:
        final = F.least(final, F.lit(high - 1))
    spans = spans.select(*keys, first.alias("_first"), final.alias("_final"))
    spans = spans.filter(F.col("_first") <= F.col("_final"))
    return spans.select(*keys, F.explode(F.sequence("_first", "_final")).alias(AT))
