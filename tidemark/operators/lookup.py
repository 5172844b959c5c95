"""Latest values by key, for a batch of requests."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.aggregates import MERGED, Aggregate, check, merge_of
from tidemark.functions.time import CONTINUOUS, bucket_start, instant_micros, micros
from tidemark.operators.points import AT, all_present
from tidemark.operators.tiles import TileSet, fill_empty, keep_newest, keep_newest_values
from tidemark.sources.tables import instant


def newest_lists(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One list of values per key, newest first, from few rows of each."""
    ordered = F.sort_array(F.collect_list(F.struct("_ts", "_value")), asc=False)
    listed = rows.groupBy(*keys).agg(ordered.alias("_l"))
    return listed.select(*keys, F.transform("_l", lambda item: item["_value"]).alias(name))


def current_values(tiles: TileSet, aggregates: list[Aggregate], moment: datetime) -> DataFrame:
    """Aggregates of every key as of one moment.

    One moment needs no window over time: only tiles inside the longest window are read,
    and each key is one grouped aggregate of them, combined before the shuffle.
    """
    check(aggregates, tiles.interval)
    keys, interval = list(tiles.keys), tiles.interval
    now = instant_micros(moment) // micros(interval)
    seen = bucket_start(F.lit(now).cast("long"), interval).alias("effective_ts")
    if interval == CONTINUOUS:
        # Continuous windows include the moment itself.
        now += 1
    reach = max(a.buckets(interval) for a in aggregates)
    recent = tiles.map(lambda t: t.filter((F.col(AT) >= now - reach) & (F.col(AT) < now)))
    parts = []
    merged = []
    for a in aggregates:
        inside = F.col(AT) >= now - a.buckets(interval)
        name = a.feature(interval)
        if a.function in MERGED:
            held = {p[0]: merge_of(p)(F.when(inside, F.col(p))) for p in a.partials}
            if a.function == "mean":
                value = F.when(held["n"] > 0, held["s"] / held["n"])
            elif a.function == "approx_distinct":
                value = F.hll_sketch_estimate(held["h"])
            else:
                value = held[a.partials[-1][0]]
            merged.append(value.alias(name))
        elif a.function == "distinct":
            values = recent.distinct[a.column].filter(inside)
            pairs = values.select(*keys, "_value").distinct()
            parts.append(pairs.groupBy(*keys).agg(F.count("_value").alias(name)))
        else:
            rows = recent.parts()[a.part].filter(inside).select(*keys, "_ts", "_value")
            keep = keep_newest if a.function == "last" else keep_newest_values
            parts.append(newest_lists(keep(rows, keys, a.size), keys, name))
    if merged:
        parts.insert(0, recent.merged.groupBy(*keys).agg(*merged))
    table = parts[0]
    for part in parts[1:]:
        table = table.join(part, keys, "full")
    names = [a.feature(interval) for a in aggregates]
    return fill_empty(table, names, aggregates).select(*keys, seen, *names)


@dataclass(frozen=True)
class Snapshot:
    """One row per key: ``effective_ts``, the features and, for a ttl, the event time.

    Aggregates are known for every key, also one without data: ``zero`` names the counts
    that are then 0, and ``seen`` is the one time all values stand for.
    """

    frame: DataFrame
    keys: tuple[str, ...]
    features: tuple[str, ...]
    prefix: str = ""
    ts: str | None = None
    ttl: timedelta | None = None
    zero: tuple[str, ...] = ()
    seen: datetime | None = None


def lookup(
    requests: DataFrame,
    snapshots: list[Snapshot],
    moment: datetime,
    effective: bool = False,
) -> DataFrame:
    """Requests with the latest values of their keys; unknown keys get nulls.

    Tables with the same keys meet on the distinct keys that are asked for, which are narrow, so
    requests with all their columns are joined once per key set. Plain equi joins: Spark broadcasts
    what is small and splits a key asked for often.
    """
    out = requests
    groups: dict[tuple[str, ...], list[Snapshot]] = {}
    for snap in snapshots:
        groups.setdefault(snap.keys, []).append(snap)
    for keys, mine in groups.items():
        tables = [_shown(snap, moment, effective) for snap in mine]
        if len(tables) > 1:
            asked = requests.select(*keys).filter(all_present(list(keys))).distinct()
            tables = [reduce(lambda a, b: a.join(b, list(keys), "left"), [asked, *tables])]
        out = out.join(tables[0], list(keys), "left")
    zeros = [snap.prefix + f for snap in snapshots for f in snap.zero]
    out = out.withColumns({z: F.coalesce(F.col(f"`{z}`"), F.lit(0)) for z in zeros})
    seen = {f"{s.prefix}effective_ts": instant(s.seen) for s in snapshots if effective and s.seen is not None}
    out = out.withColumns(seen)
    added = []
    for snap in snapshots:
        added += [snap.prefix + f for f in snap.features] + [f"{snap.prefix}effective_ts"] * effective
    return out.select(*[f"`{c}`" for c in (*requests.columns, *added)])


def _shown(snap: Snapshot, moment: datetime, effective: bool) -> DataFrame:
    """The keys and output columns of a snapshot; values older than its age limit are null."""
    alive = F.lit(True)
    if snap.ttl is not None:
        limit = instant_micros(moment) - micros(snap.ttl)
        alive = F.unix_micros(F.col(snap.ts)) > F.lit(limit)
    columns = [F.when(alive, F.col(f"`{f}`")).alias(snap.prefix + f) for f in snap.features]
    if effective and snap.seen is None:
        columns.append(F.when(alive, F.col("effective_ts")).alias(f"{snap.prefix}effective_ts"))
    return snap.frame.select(*snap.keys, *columns)


def vector(df: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """Kept columns and one array of (name, value) pairs; values are text, or JSON if nested."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def text(name):
        nested = isinstance(types[name], (T.ArrayType, T.StructType, T.MapType))
        return F.to_json(F.col(f"`{name}`")) if nested else F.col(f"`{name}`").cast("string")

    pairs = [F.struct(F.lit(n).alias("name"), text(n).alias("value")) for n in names]
    return df.select(*keep, F.array(*pairs).alias("features"))
