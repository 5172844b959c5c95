"""Feature views: what is computed, keyed by what, at which times."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.aggregates import COUNTS, Aggregate, check
from tidemark.functions.time import (
    CONTINUOUS,
    EPOCH,
    bucket,
    bucket_start,
    effective_micros,
    instant_micros,
    micros,
)
from tidemark.operators.asof import FeatureTable, asof_join, latest
from tidemark.operators.lookup import Snapshot, current_values
from tidemark.operators.tiles import TileSet, build_tiles
from tidemark.operators.windows import aggregates_asof, rolled
from tidemark.sources.spine import spine_of
from tidemark.sources.tables import Source, between, only_between


@dataclass(frozen=True)
class View:
    """A declared feature view over one or more sources.

    ``body`` takes one argument per source and returns a frame, or SQL text in which
    ``{name}`` stands for a source. Without ``aggregations`` every row is a feature row.
    With them, rows feed time-window aggregates at ``interval``, or continuously.
    """

    name: str
    keys: tuple[str, ...]
    ts: str
    sources: tuple[Source, ...]
    body: Callable
    mode: str = "sql"
    schedule: timedelta | None = None
    ttl: timedelta | None = None
    aggregations: tuple[Aggregate, ...] = ()
    interval: timedelta = CONTINUOUS
    start: datetime | None = None
    columns: tuple[str, ...] = ()
    every: timedelta | None = None

    def __post_init__(self):
        if self.mode not in ("sql", "frame"):
            raise ValueError(f"mode is 'sql' or 'frame', not {self.mode!r}")
        if self.aggregations:
            check(list(self.aggregations), self.interval)

    # -- definition ---------------------------------------------------------

    @property
    def features(self) -> list[str]:
        if self.aggregations:
            return [a.feature(self.interval) for a in self.aggregations]
        if self.columns:
            return list(self.columns)
        return [c for c in self.frame().columns if c not in (*self.keys, self.ts)]

    @property
    def reach(self) -> timedelta:
        """Longest window."""
        return max((a.window for a in self.aggregations), default=timedelta(0))

    def __getitem__(self, names) -> View:
        """The view with some of its features; windows left out are never computed."""
        names = [names] if isinstance(names, str) else list(names)
        unknown = set(names) - set(self.features)
        if unknown:
            raise KeyError(f"view {self.name} has no features {sorted(unknown)}")
        if not self.aggregations:
            return replace(self, columns=tuple(names))
        by_name = {a.feature(self.interval): a for a in self.aggregations}
        return replace(self, aggregations=tuple(by_name[n] for n in names))

    def _apply(self, inputs: dict[str, DataFrame]) -> DataFrame:
        if self.mode == "frame":
            return self.body(**inputs)
        spark = next(iter(inputs.values())).sparkSession
        text = self.body(**{name: f"{{{name}}}" for name in inputs})
        return spark.sql(text, **inputs)

    def frame(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Rows of the view over the sources' time range ``[start, end)``."""
        start = self._from(start)
        rows = self._apply({s.name: s.read(start, end) for s in self.sources})
        return between(rows, self.ts, self.start, None)

    def _from(self, start: datetime | None) -> datetime | None:
        """A range's start, no earlier than the view's own."""
        if start is None or self.start is None:
            return start or self.start
        return max(start, self.start, key=instant_micros)

    def stream(self) -> DataFrame:
        """The same transform on the sources' streams."""
        return self._apply({s.name: s.read_stream() for s in self.sources})

    def validate(self) -> View:
        """Check the declaration against the analyzed schema. Runs no job."""
        schema = {f.name: f.dataType for f in self.frame().schema.fields}
        for key in self.keys:
            if key not in schema:
                raise ValueError(f"view {self.name}: no key column {key}")
        if not isinstance(schema.get(self.ts), (T.TimestampType, T.TimestampNTZType)):
            raise ValueError(f"view {self.name}: {self.ts} is not a timestamp column")
        if not set(schema) - {*self.keys, self.ts}:
            raise ValueError(f"view {self.name}: no feature columns")
        for a in self.aggregations:
            if a.column not in schema:
                raise ValueError(f"view {self.name}: no column {a.column} to aggregate")
            if a.function in ("sum", "mean") and not isinstance(schema[a.column], T.NumericType):
                raise ValueError(f"view {self.name}: {a.column} is not numeric")
        for name in self.columns:
            if name not in schema:
                raise ValueError(f"view {self.name}: no feature column {name}")
        return self

    def contract_report(self) -> DataFrame:
        """One row: how many rows break the contract of the view."""
        rows = self.frame()
        gaps = [
            F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in (*self.keys, self.ts)
        ]
        return rows.agg(F.count(F.lit(1)).alias("n_rows"), *gaps)

    # -- history ------------------------------------------------------------

    def table(self, rows: DataFrame | None = None, prefix: str = "") -> FeatureTable:
        """The view as a lookup table; stored rows may stand in for computed ones."""
        rows = self.frame() if rows is None else rows
        order = tuple(c for c in rows.columns if c not in (*self.keys, self.ts))
        return FeatureTable(
            rows, self.ts, tuple(self.features), prefix, self.schedule, self.ttl, order
        )

    def whole_table(self, rows: DataFrame) -> FeatureTable:
        """Rows as a table of all columns, so that newest rows of parts resolve ties as the whole does."""
        if self.aggregations:
            raise ValueError(f"view {self.name} aggregates: its latest values come from its tiles")
        table = self.table(rows)
        return replace(table, features=table.order)

    def tiles(self, start: datetime | None = None, end: datetime | None = None) -> TileSet:
        return self.tiles_of(between(self.frame(start, end), self.ts, start, end))

    def tiles_of(self, rows: DataFrame) -> TileSet:
        return build_tiles(rows, list(self.keys), self.ts, list(self.aggregations), self.interval)

    def latest(self, moment: datetime | None = None, store=None) -> DataFrame:
        """Newest row per key, of those visible at a moment."""
        rows = self.stored_rows(store, moment and (moment, moment + CONTINUOUS))
        return latest(self.table(rows), list(self.keys), moment)

    def snapshot(self, moment: datetime, store=None, prefix: str = "") -> Snapshot:
        """One row per key with the view's values at a moment."""
        if not self.aggregations:
            return self.snapshot_of(self.latest(moment, store), moment, prefix)
        _, tiles, _ = self.part(store, (moment, moment + CONTINUOUS), prefix)
        return self.snapshot_of(current_values(tiles, list(self.aggregations), moment), moment, prefix)

    def snapshot_of(self, rows: DataFrame, moment: datetime, prefix: str = "") -> Snapshot:
        """A table with the values of each key at a moment, as lookups take it."""
        names = tuple(self.features)
        if not self.aggregations:
            return Snapshot(rows, self.keys, names, prefix, self.ts, self.ttl)
        zero = [a.feature(self.interval) for a in self.aggregations if a.function in COUNTS]
        step = micros(self.interval)
        seen = EPOCH + timedelta(microseconds=instant_micros(moment) // step * step)
        return Snapshot(rows, self.keys, names, prefix, zero=tuple(zero), seen=seen)

    def reads(self, period: tuple[datetime, datetime] | None):
        """Range of event times that can matter for spine times in a period."""
        if period is None:
            return None, None
        start, end = period
        if self.aggregations:
            return start - self.reach - self.interval, end
        return (start - self.ttl if self.ttl else None), end

    def historical(
        self,
        spine,
        ts: str,
        store=None,
        effective: bool = False,
        period: tuple[datetime, datetime] | None = None,
    ) -> DataFrame:
        """Spine rows with the view's features, under their bare names, as of each row's time.

        Computes from the sources, unless a ``store`` holds the view. A ``period`` promises
        that all spine times lie in it; only events that can matter there are then read. Without
        one, the days that a store reads are those that the spine's times ask for.
        """
        spine = spine_of(self.sources[0].batch.sparkSession, spine)
        if period is not None:
            spine = only_between(spine, ts, period)
        times = spine if period is None else None
        if not self.aggregations:
            table = self.table(self.stored_rows(store, period, times, ts))
            return asof_join(spine, list(self.keys), ts, [table], effective)
        return aggregates_asof(spine, ts, [self.part(store, period, "", times, ts)], effective)

    def days_for(self, spine: DataFrame, ts: str) -> DataFrame | None:
        """The days of events that can matter for the times of a spine; None if that is all before them.

        One row per day of the calendar at most.
        """
        back = self.reach + self.interval if self.aggregations else self.ttl
        if back is None:
            return None
        day = F.to_date(F.col(ts))
        days = spine.select(day.alias("last")).distinct().filter(F.col("last") > F.lit("0001-01-01").cast("date"))
        first = F.date_sub("last", -(-back // timedelta(days=1)))
        every = days.select(F.explode(F.sequence(first, F.col("last"))).alias("date")).distinct()
        return every.select(F.date_format("date", "yyyy-MM-dd").alias("day"))

    def stored_rows(self, store, period=None, spine: DataFrame | None = None, ts: str | None = None) -> DataFrame:
        """Rows for a period or the times of a spine, from a store that holds the view or else computed."""
        start, end = self.reads(period)
        if store is not None and store.has(self):
            days = None if spine is None else self.days_for(spine, ts)
            return store.rows_or_computed(self, start, end, days)
        return between(self.frame(start, end), self.ts, start, end)

    def part(self, store, period, prefix: str, spine: DataFrame | None = None, ts: str | None = None):
        """Prefix, tiles for a period or the times of a spine, and aggregates, as the joins take them."""
        start, end = self.reads(period)
        if store is not None and store.has(self):
            days = None if spine is None else self.days_for(spine, ts)
            tiles = store.tiles_or_computed(self, start, end, days)
        else:
            tiles = self.tiles(start, end)
        return prefix, tiles, list(self.aggregations)

    def history(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Feature values of ``[start, end)`` without a spine.

        Rows of a row-level view come with the time they became effective; an
        aggregating view gives its values at each interval boundary.
        """
        if self.aggregations:
            return self.run(start, end)
        seen = F.timestamp_micros(effective_micros(F.col(self.ts), self.schedule))
        rows = between(self.frame(start, end), self.ts, start, end)
        return rows.select(*self.keys, self.ts, *self.features, seen.alias("effective_ts"))

    def run(
        self,
        start: datetime | None = None,
        end: datetime | None = None,
        widen: bool = True,
        complete: bool = False,
        tiles: TileSet | None = None,
    ) -> DataFrame:
        """Ad-hoc values of ``[start, end)``, from source unless ``tiles`` are given.

        An aggregating view lists each key at each boundary at which it has data. It
        reads one longest window more than asked for; with ``widen`` off, early
        windows are cut short. ``complete`` adds a flag per feature that says whether
        the rows read cover its whole window.
        """
        if not self.aggregations:
            return self.history(start, end)
        if self.interval == CONTINUOUS:
            raise ValueError(f"view {self.name} is continuous and has no boundaries to list")
        read_from = start
        if start is not None and widen:
            read_from = start - self.reach
        read_from = self._from(read_from)
        low = None if start is None else boundary(start, self.interval)
        high = None if end is None else boundary(end, self.interval)
        tiles = tiles or self.tiles(read_from, end)
        listed = rolled(tiles, list(self.aggregations), low, high)
        if not complete:
            return listed
        return listed.withColumns(
            {
                f"window_complete_{a.feature(self.interval)}": window_complete(
                    F.col("window_end"), a.window, read_from
                )
                for a in self.aggregations
            }
        )


def boundary(moment: datetime, interval: timedelta) -> int:
    """Number of the first interval boundary at or after a moment."""
    return -(-instant_micros(moment) // micros(interval))


def window_complete(end, window: timedelta, read_from: datetime | None):
    if read_from is None:
        return F.lit(True)
    first = instant_micros(read_from) + micros(window)
    return F.unix_micros(end) >= F.lit(first)


def coverage(df: DataFrame, ts: str, interval: timedelta, loaded: list[tuple[datetime, datetime]]) -> DataFrame:
    """Whether stored tiles reach up to each row: its boundary against the loaded ranges."""
    end = bucket_start(bucket(F.col(ts), interval), interval)
    at, covered = F.unix_micros(end), F.lit(False)
    for low, high in loaded:
        covered = covered | at.between(instant_micros(low), instant_micros(high))
    return df.withColumns({"boundary": end, "covered": covered})


def batch_view(
    *,
    sources: list[Source],
    keys: list[str],
    ts: str,
    schedule: timedelta,
    mode: str = "sql",
    ttl: timedelta | None = None,
    aggregations: list[Aggregate] | None = None,
    interval: timedelta | None = None,
    start: datetime | None = None,
) -> Callable[[Callable], View]:
    """Declare a view that runs on a batch schedule.

    An aggregating batch view tiles at its schedule unless ``interval`` says otherwise.
    """

    def declare(body: Callable) -> View:
        return View(
            body.__name__,
            tuple(keys),
            ts,
            tuple(sources),
            body,
            mode,
            None if aggregations else schedule,
            ttl,
            tuple(aggregations or ()),
            (interval or schedule) if aggregations else CONTINUOUS,
            start,
            every=schedule,
        )

    return declare


def stream_view(
    *,
    source: Source,
    keys: list[str],
    ts: str,
    mode: str = "sql",
    ttl: timedelta | None = None,
    aggregations: list[Aggregate] | None = None,
    interval: timedelta | None = None,
    start: datetime | None = None,
) -> Callable[[Callable], View]:
    """Declare a view fed by a stream: every ``interval``, or continuously without one."""

    def declare(body: Callable) -> View:
        return View(
            body.__name__,
            tuple(keys),
            ts,
            (source,),
            body,
            mode,
            None,
            ttl,
            tuple(aggregations or ()),
            interval or CONTINUOUS,
            start,
        )

    return declare
