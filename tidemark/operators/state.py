"""Values of every key at one moment, kept so that a later moment costs only what has changed.

The state of a moment holds, for each key, the counts and sums of every window, the newest
sighting of every value that is to be told apart, and the newest few values of a list. To move on,
tiles that have arrived since are added, and those that have left a window are taken out again.
Values that cannot be taken out (least, greatest, sketches) are put together from the tiles of
their window.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.aggregates import LISTS, SUMMED, Aggregate
from tidemark.functions.time import CONTINUOUS, bucket_start, instant_micros, micros
from tidemark.operators.lookup import current_values, newest_lists
from tidemark.operators.points import AT
from tidemark.operators.tiles import TileSet, fill_empty, keep_newest, keep_newest_values

#: Functions that keep rows of their own between two moments.
KEPT = ("distinct", *LISTS)
State = dict[str, DataFrame]
#: Tiles that touch ``[start, end)``, given in interval numbers.
Reader = Callable[[int, int], TileSet]


def boundary_of(moment: datetime, aggregates: list[Aggregate], interval) -> int:
    """Number of the first interval that a moment does not see."""
    now = instant_micros(moment) // micros(interval)
    return now + 1 if interval == CONTINUOUS else now


def joined_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges apart from one another, in order; empty ones left out."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(r for r in ranges if r[0] < r[1]):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def _read(read: Reader, ranges: list[tuple[int, int]], part: str) -> DataFrame:
    """One part of the tiles of some ranges, each read by itself so that nothing between is."""
    found = [
        read(low, high).parts()[part].filter((F.col(AT) >= low) & (F.col(AT) < high)) for low, high in joined_ranges(ranges)
    ]
    return reduce(DataFrame.unionByName, found)


def _sums(read: Reader, wanted: list[Aggregate], keys, interval, old: tuple[int, DataFrame] | None, now: int) -> DataFrame:
    """Counts and sums of each column and window, named ``n_<window>_<column>``."""
    windows = sorted({a.buckets(interval) for a in wanted})
    before = None if old is None else old[0]
    # a window that none of the old tiles is in starts afresh
    kept = {w for w in windows if before is not None and now - before < w}
    ranges = [(now - w, now) for w in windows if w not in kept]
    if kept:
        ranges += [(before, now), *((before - w, now - w) for w in kept)]
    if not joined_ranges(ranges):
        return old[1]
    tiles = _read(read, ranges, "merged")
    at, rows = F.col(AT), []
    names, columns = [], {}
    for w in windows:
        sign = ((at >= now - w) & (at < now)).cast("int")
        if w in kept:
            sign = sign - ((at >= before - w) & (at < before)).cast("int")
        for column in sorted({a.column for a in wanted if a.buckets(interval) == w}):
            summed = any(a.function != "count" and a.column == column and a.buckets(interval) == w for a in wanted)
            for p in ("n", "s") if summed else ("n",):
                name = f"{p}_{w}_{column}"
                names.append(name)
                columns[name] = F.when(sign != 0, F.col(f"{p}_{column}") * sign)
    rows.append(tiles.select(*keys, *[c.alias(n) for n, c in columns.items()]))
    if kept:
        carried = [F.col(n) if int(n.split("_")[1]) in kept else F.lit(None).alias(n) for n in names]
        rows.append(old[1].select(*keys, *carried))
    totals = reduce(DataFrame.unionByName, rows).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])
    counts = [n for n in names if n.startswith("n_")]
    # what an empty window once added up to is gone for good, with its rounding errors
    clean = {n: F.when(F.col(f"n_{n[2:]}") > 0, F.col(n)) for n in names}
    alive = reduce(lambda a, b: a | b, [F.col(n) > 0 for n in counts])
    return totals.filter(alive).withColumns(clean)


def next_state(
    read: Reader,
    aggregates: list[Aggregate],
    keys: list[str],
    interval,
    now: int,
    old: tuple[int, State] | None = None,
) -> State:
    """The state at a boundary, from tiles alone or from the state at an earlier boundary."""
    out: State = {}
    before = None if old is None else old[0]
    summed = [a for a in aggregates if a.function in SUMMED]
    if summed:
        out["sums"] = _sums(read, summed, keys, interval, None if old is None else (before, old[1]["sums"]), now)
    step = micros(interval)
    for name, mine in _listed(aggregates).items():
        reach = max(a.buckets(interval) for a in mine)
        first = now - reach if before is None else max(before, now - reach)
        rows = None if first >= now else _read(read, [(first, now)], name)
        if old is not None:
            time = F.col(AT) if name.startswith("distinct_") else F.col("_ts")
            limit = now - reach if name.startswith("distinct_") else (now - reach) * step
            carried = old[1][name].filter(time >= limit)
            rows = carried if rows is None else rows.select(*carried.columns).unionByName(carried)
        if name.startswith("distinct_"):
            out[name] = rows.groupBy(*keys, "_value").agg(F.max(AT).alias(AT))
        elif name.startswith("recent"):
            out[name] = keep_newest(rows.select(*keys, "_ts", "_value"), keys, mine[0].size)
        else:
            out[name] = keep_newest_values(rows.select(*keys, "_ts", "_value"), keys, mine[0].size)
    return out


def state_names(aggregates: list[Aggregate]) -> list[str]:
    """The frames that a state is made of."""
    return ["sums"] * any(a.function in SUMMED for a in aggregates) + list(_listed(aggregates))


def _listed(aggregates: list[Aggregate]) -> dict[str, list[Aggregate]]:
    """Aggregates that keep rows of their own, by the part of the tiles they need."""
    out: dict[str, list[Aggregate]] = {}
    for a in aggregates:
        if a.function in KEPT:
            out.setdefault(a.part, []).append(a)
    return out


def values_of(
    state: State, read: Reader, aggregates: list[Aggregate], keys: list[str], interval, now: int, moment: datetime
) -> DataFrame:
    """Keys, ``effective_ts`` and every aggregate, as ``current_values`` gives them."""
    step, parts = micros(interval), []
    summed = [a for a in aggregates if a.function in SUMMED]
    if summed:
        columns = []
        for a in summed:
            at = f"{a.buckets(interval)}_{a.column}"
            n = F.col(f"n_{at}")
            value = n if a.function == "count" else F.col(f"s_{at}") if a.function == "sum" else F.when(n > 0, F.col(f"s_{at}") / n)
            columns.append(value.alias(a.feature(interval)))
        parts.append(state["sums"].select(*keys, *columns))
    for name, mine in _listed(aggregates).items():
        for a in mine:
            first = now - a.buckets(interval)
            if a.function == "distinct":
                inside = state[name].filter(F.col(AT) >= first)
                parts.append(inside.groupBy(*keys).agg(F.count(F.lit(1)).alias(a.feature(interval))))
            else:
                inside = state[name].filter(F.col("_ts") >= first * step)
                parts.append(newest_lists(inside, keys, a.feature(interval)))
    rest = [a for a in aggregates if a.function not in (*SUMMED, *KEPT)]
    if rest:
        reach = max(a.buckets(interval) for a in rest)
        parts.append(current_values(read(now - reach, now), rest, moment).drop("effective_ts"))
    table = reduce(lambda a, b: a.join(b, keys, "full"), parts)
    names = [a.feature(interval) for a in aggregates]
    shown = now - 1 if interval == CONTINUOUS else now
    seen = bucket_start(F.lit(shown).cast("long"), interval).alias("effective_ts")
    return fill_empty(table, names, aggregates).select(*keys, seen, *names)
