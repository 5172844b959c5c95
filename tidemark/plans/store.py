"""Stored history: rows and tiles on disk, written by repeatable range jobs."""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import delete, found
from tidemark.functions.time import CONTINUOUS, EPOCH, bucket_start, instant_micros, micros
from tidemark.operators.asof import latest
from tidemark.operators.lookup import Snapshot, current_values
from tidemark.operators.points import AT
from tidemark.operators.state import boundary_of, next_state, state_names, values_of
from tidemark.operators.tiles import TileSet
from tidemark.plans.declared import body_digest, finished_digest, shape, start_of
from tidemark.plans.views import View
from tidemark.sources.tables import between

DAY = timedelta(days=1)
RUN = "_run"
MARK = "low long, high long, run long, part string, fields string, shape string, body string, start long"
PUBLISHED = "at long, run long, loaded long, features array<string>, shape string, body string, start long, rules string, buckets int"
Segment = tuple[int, int, int]


def moment_of(at: int) -> datetime:
    return EPOCH + timedelta(microseconds=at)


def day_of(at: int) -> str:
    return f"{moment_of(at):%Y-%m-%d}"


def fields_of(schema: T.StructType) -> set[str]:
    """Columns with their types, as marks name them."""
    return {f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields}


def slices(
    start: datetime, end: datetime, jobs: int, step: timedelta = DAY
) -> list[tuple[datetime, datetime]]:
    """``[start, end)`` cut into at most ``jobs`` ranges of whole steps, widened to steps."""
    first = (start - EPOCH) // step
    last = -((EPOCH - end) // step)
    jobs = max(1, min(jobs, last - first))
    cuts = [first + (last - first) * i // jobs for i in range(jobs + 1)]
    return [(EPOCH + a * step, EPOCH + b * step) for a, b in zip(cuts, cuts[1:])]


def overlaid(segments: list[Segment], new: Segment) -> list[Segment]:
    """Ranges with the job that counts there, after a later job loaded a range."""
    low, high, _ = new
    out = [new]
    for a, b, run in segments:
        if a < low:
            out.append((a, min(b, low), run))
        if b > high:
            out.append((max(a, high), b, run))
    return [s for s in out if s[0] < s[1]]


def ranges_of(segments: list[Segment]) -> list[tuple[int, int]]:
    """The covered ranges, apart from one another and in order of time."""
    joined: list[list[int]] = []
    for low, high, _ in sorted(segments):
        if joined and low <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    return [(low, high) for low, high in joined]


def uncovered(ranges: list[tuple[int, int]], low: int | None, high: int | None) -> list[tuple]:
    """The parts of ``[low, high)`` outside some ranges; None stands for no bound."""
    out = []
    for a, b in ranges:
        if high is not None and a >= high:
            break
        if low is None or a > low:
            out.append((low, a))
        low = b if low is None else max(low, b)
    if high is None or low is None or low < high:
        out.append((low, high))
    return out


def _common(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    both = [(max(x, u), min(y, v)) for x, y in a for u, v in b]
    return [r for r in both if r[0] < r[1]]


def _at(moment: datetime | None) -> int | None:
    return None if moment is None else instant_micros(moment)


def _moment(at: int | None) -> datetime | None:
    return None if at is None else moment_of(at)


def _micros_of(part: str, ts: str, interval: int | None) -> Column:
    """The time of a stored row or tile in microseconds."""
    return F.unix_micros(F.col(ts).cast("timestamp")) if part == "rows" else F.col(AT) * F.lit(interval)


class Store:
    """History of views under one folder, partitioned by day and by the job that wrote it.

    A job adds its rows under a number of its own and then one mark for each part it wrote: the
    range, the columns, and a digest of what computed them. Of all jobs that loaded a time with the
    columns a view needs, by the same code and from the same start, the latest one counts; so a job
    replaces its whole range, also where it finds nothing, and one that died half-way leaves no
    trace. What no such job loaded is computed from the sources, part by part: a view that was
    declared anew since gets right answers at the cost of that, never zeros for what was not kept.

    With ``beyond``, the history that streams have written, what lies after the last loaded range
    comes from there: the daily load answers up to its end and the stream from there on, and every
    interval is taken from one of them only.
    """

    def __init__(self, spark: SparkSession, path: str, beyond=None):
        self.spark = spark
        self.path = path
        self.beyond = beyond

    # -- marks ----------------------------------------------------------------

    def _read(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{path}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _all_marks(self, view: View) -> list[Row]:
        marks = self._read(f"{view.name}/loaded", MARK)
        return [] if marks is None else sorted(marks.collect(), key=lambda m: m["run"])

    def _marks(self, view: View) -> list[Row]:
        """What jobs loaded in the layout of the view, in the order in which they ran."""
        marks = self._all_marks(view)
        own = [m for m in marks if m["shape"] == shape(view)]
        if marks and not own:
            raise ValueError(
                f"view {view.name} is stored as {marks[-1]['shape']} but declared as {shape(view)}; store it anew"
            )
        return own

    def _segments(self, view: View, marks: list[Row], name: str, like: DataFrame) -> list[Segment]:
        """Where one part of a view can be read, and from which job."""
        need, body, start = fields_of(like.schema), body_digest(view), start_of(view)
        step = micros(view.interval) if view.aggregations else 1
        out: list[Segment] = []
        for mark in marks:
            if mark["part"] != name or mark["body"] != body or not need <= set(mark["fields"].split("\n")):
                continue
            low = mark["low"]
            if mark["start"] != start:
                # up to the later start, a job counted other rows than the view does
                later = max(s for s in (mark["start"], start) if s is not None)
                low = max(low, -(-later // step) * step)
            if low < mark["high"]:
                out = overlaid(out, (low, mark["high"], mark["run"]))
        return sorted(out)

    def _parts(self, view: View) -> dict[str, DataFrame]:
        return view.tiles().parts() if view.aggregations else {"rows": view.frame()}

    def has(self, view: View) -> bool:
        """Whether anything stored can answer for any part of the view."""
        marks = self._marks(view)
        return any(self._segments(view, marks, n, like) for n, like in self._parts(view).items())

    def loaded(self, view: View) -> list[tuple[datetime, datetime]]:
        """The ranges in which every part of the view is stored."""
        marks, ranges = self._marks(view), None
        for name, like in self._parts(view).items():
            mine = ranges_of(self._segments(view, marks, name, like))
            ranges = mine if ranges is None else _common(ranges, mine)
        return [(moment_of(low), moment_of(high)) for low, high in ranges or []]

    def loaded_until(self, view: View) -> datetime | None:
        """The end of what is loaded without a gap from the first stored range on."""
        ranges = self.loaded(view)
        return ranges[0][1] if ranges else None

    def gaps(self, view: View, start: datetime | None, end: datetime | None) -> list[tuple]:
        """The parts of ``[start, end)`` that are not loaded whole; None stands for no bound."""
        ranges = [(instant_micros(a), instant_micros(b)) for a, b in self.loaded(view)]
        return [(_moment(a), _moment(b)) for a, b in uncovered(ranges, _at(start), _at(end))]

    # -- jobs -----------------------------------------------------------------

    def _write(self, df: DataFrame, time, run: int, path: str) -> None:
        marked = df.withColumns({"day": F.date_format(time, "yyyy-MM-dd"), RUN: F.lit(run)})
        marked.hint("rebalance", "day").write.mode("append").partitionBy("day", RUN).parquet(f"{self.path}/{path}")

    def _mark(self, view: View, marks: list[tuple]) -> None:
        """All marks of a job in one file, so that all of its parts count from the same moment on."""
        self.spark.createDataFrame(marks, MARK).coalesce(1).write.mode("append").parquet(f"{self.path}/{view.name}/loaded")

    def _next_run(self, view: View) -> int:
        return max([time.time_ns(), *(m["run"] + 1 for m in self._all_marks(view))])

    def materialize(self, view: View, start: datetime, end: datetime) -> None:
        """Compute and store one range; the bounds of tiles lie on tile intervals."""
        low, high = instant_micros(start), instant_micros(end)
        if low >= high:
            raise ValueError(f"range {start} .. {end} is empty")
        if view.aggregations and (low % micros(view.interval) or high % micros(view.interval)):
            raise ValueError(f"range {start} .. {end} does not lie on intervals of {view.interval}")
        run = self._next_run(view)
        rows = between(view.frame(start, end), view.ts, start, end)
        if view.aggregations:
            parts = view.tiles_of(rows).parts()
            if len(parts) > 1:
                rows = rows.persist()
                parts = view.tiles_of(rows).parts()
            for name, part in parts.items():
                self._write(part, bucket_start(F.col(AT), view.interval), run, f"{view.name}/{name}")
            rows.unpersist()
        else:
            parts = {"rows": rows}
            self._write(rows, F.col(view.ts), run, f"{view.name}/rows")
        # The marks are written last: a range counts once its data is there.
        same = (shape(view), body_digest(view), start_of(view))
        self._mark(view, [(low, high, run, n, "\n".join(sorted(fields_of(p.schema))), *same) for n, p in parts.items()])

    def backfill(self, view: View, start: datetime, end: datetime, jobs: int = 10) -> None:
        """A history in at most ``jobs`` ranges of whole days or schedule periods."""
        step = max(DAY, view.interval if view.aggregations else view.schedule or DAY)
        for low, high in slices(start, end, jobs, step):
            self.materialize(view, low, high)

    def incremental(self, view: View, start: datetime) -> None:
        """The recurring job: one schedule period, or a day without a schedule."""
        self.materialize(view, start, start + (view.every or view.schedule or DAY))

    def compact(self, view: View) -> None:
        """Write what is left of partly replaced jobs anew, and delete all files that nothing reads.

        Reads then name whole jobs only, however often a range was loaded. Marks of other
        declarations of the view keep their data. For a time at which no job writes this view and
        nobody reads it.
        """
        groups: dict[tuple, list[Row]] = {}
        for mark in self._all_marks(view):
            groups.setdefault((mark["part"], mark["fields"], mark["shape"], mark["body"], mark["start"]), []).append(mark)
        run, fresh = self._next_run(view), []
        for at, ((part, fields, *same), marks) in enumerate(groups.items()):
            segments: list[Segment] = []
            for mark in marks:
                segments = overlaid(segments, (mark["low"], mark["high"], mark["run"]))
            whole = {(m["low"], m["high"], m["run"]) for m in marks}
            left = [s for s in segments if s not in whole]
            if left:
                schema = ", ".join(f"`{n}` {kind}" for n, _, kind in (f.partition(":") for f in fields.split("\n")))
                stored = self._read(f"{view.name}/{part}", f"{schema}, day string, {RUN} long")
                number = run + at
                if stored is not None:
                    facts = json.loads(same[0])
                    when = _micros_of(part, facts["ts"], facts.get("interval"))
                    kept = stored.filter(self._inside(left, when)).drop("day", RUN)
                    self._write(kept, F.timestamp_micros(when), number, f"{view.name}/{part}")
                fresh += [(low, high, number, part, fields, *same) for low, high, _ in left]
        if fresh:
            self._mark(view, fresh)
        self._prune(view)

    def _prune(self, view: View) -> None:
        marks = self._read(f"{view.name}/loaded", MARK)
        if marks is None:
            return
        rows = marks.select("*", F.input_file_name().alias("file")).collect()
        segments: dict[tuple, list[Segment]] = {}

        def group(m: Row) -> tuple:
            return m["part"], m["fields"], m["shape"], m["body"], m["start"]

        for m in sorted(rows, key=lambda m: m["run"]):
            segments[group(m)] = overlaid(segments.get(group(m), []), (m["low"], m["high"], m["run"]))
        alive = {(g, run) for g, listed in segments.items() for *_, run in listed}
        needed = {(g[0], run) for g, run in alive}
        # marks first: data without a mark is not read, a mark without its data would be a hole
        used = {m["file"] for m in rows if (group(m), m["run"]) in alive}
        for file in {m["file"] for m in rows} - used:
            delete(self.spark, file)
        for folder in found(self.spark, f"{self.path}/{view.name}/*/day=*/{RUN}=*"):
            part, _, run = folder.rsplit("/", 3)[-3:]
            if (part, int(run.partition("=")[2])) not in needed:
                delete(self.spark, folder)

    def emit_window(self, view: View, moment: datetime) -> None:
        """Store finished values at one boundary, reading one longest window of source.

        Each boundary has a folder of its own, which a later run for it replaces.
        """
        at = instant_micros(moment)
        if at % micros(view.interval):
            raise ValueError(f"{moment} is no boundary of {view.interval}")
        tiles = view.tiles(moment - view.reach, moment)
        done = current_values(tiles, list(view.aggregations), moment)
        done = done.withColumnRenamed("effective_ts", "window_end")
        done.write.mode("overwrite").parquet(f"{self._finished(view)}/boundary={at}")

    def _finished(self, view: View) -> str:
        return f"{self.path}/{view.name}/finished/of={finished_digest(view)}"

    def finished(self, view: View) -> DataFrame:
        """What was emitted for the view as it is declared now."""
        return self.spark.read.parquet(self._finished(view)).drop("boundary")

    # -- latest values ----------------------------------------------------------

    def _published(self, view: View, at: int, exactly: bool = False) -> Row | None:
        """The newest published values up to a moment that have the view's features, or just those."""
        marks = self._read(f"{view.name}/published", PUBLISHED)
        rules = f"{view.schedule} {view.ttl}"
        fits = [
            m
            for m in (marks.filter(F.col("at") <= at).collect() if marks is not None else [])
            if (m["shape"], m["body"], m["start"], m["rules"]) == (shape(view), body_digest(view), start_of(view), rules)
            and (set(view.features) == set(m["features"]) if exactly else set(view.features) <= set(m["features"]))
        ]
        return max(fits, key=lambda m: (m["at"], m["run"]), default=None)

    def publish(self, view: View, moment: datetime, anew: bool = False, buckets: int | None = None) -> None:
        """Keep the view's values per key at a moment as a table that lookups read.

        Values published earlier are carried forward: rows that became visible since are merged
        in, tiles that arrived are added and those that left their windows taken out; nothing else
        is read. All is computed anew if nothing was published, if ``anew`` says so, or if a range
        before the last publish was loaded again since. Rows that reached a source late, without
        their range being loaded again, are seen only then.

        Each publish has a folder of its own; its mark follows, so readers see all of it or none. With
        ``buckets`` the values lie sorted in so many parts by their keys: lookups then shuffle their
        requests and never the table, and tables of one key set with as many buckets meet in one
        pass. Spark keeps that only for tables with a name, so the session's catalog has one for the
        moment of writing or opening it.
        """
        at = instant_micros(moment)
        marks = self._marks(view)
        before = None if anew else self._published(view, at, exactly=True)
        if before is not None and any(m["run"] > before["loaded"] and m["low"] < before["at"] for m in marks):
            before = None
        run = max([time.time_ns(), *([before["run"] + 1] if before else [])])
        write = self._publish_tiles if view.aggregations else self._publish_rows
        folder = f"{self.path}/{view.name}/latest/run={run}"
        self._write_values(write(view, moment, before, folder), f"{folder}/values", view.keys, buckets)
        loaded = max([0, *(m["run"] for m in marks)])
        rules = f"{view.schedule} {view.ttl}"
        mark = (at, run, loaded, list(view.features), shape(view), body_digest(view), start_of(view), rules, buckets or 0)
        self.spark.createDataFrame([mark], PUBLISHED).coalesce(1).write.mode("append").parquet(
            f"{self.path}/{view.name}/published"
        )

    def _write_values(self, values: DataFrame, folder: str, keys: tuple[str, ...], buckets: int | None) -> None:
        if not buckets:
            values.write.parquet(folder)
            return
        name, by = f"published_{uuid.uuid4().hex}", list(keys)
        writer = values.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*by)
        writer.option("path", folder).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def _values(self, view: View, mark: Row) -> DataFrame:
        folder = f"{self.path}/{view.name}/latest/run={mark['run']}/values"
        plain = self.spark.read.parquet(folder)
        if not mark["buckets"]:
            return plain
        name, by = f"published_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in view.keys)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
            f"INTO {mark['buckets']} BUCKETS LOCATION '{folder}'"
        )
        table = self.spark.table(name)
        table.schema  # noqa: B018  opened before its name goes; the files stay
        self.spark.sql(f"DROP TABLE {name}")
        return table

    def _publish_rows(self, view: View, moment: datetime, before: Row | None, folder: str) -> DataFrame:
        low, carried = None, None
        if before is not None:
            # the first time that was not visible yet
            low = before["at"] + 1
            if view.schedule is not None:
                low = before["at"] // micros(view.schedule) * micros(view.schedule)
            carried = self.spark.read.parquet(f"{self.path}/{view.name}/latest/run={before['run']}/values")
        rows = self.rows_or_computed(view, _moment(low), moment + CONTINUOUS)
        if carried is not None:
            rows = rows.unionByName(carried.select(*[f"`{c}`" for c in rows.columns]))
        return latest(view.whole_table(rows), list(view.keys), moment)

    def _publish_tiles(self, view: View, moment: datetime, before: Row | None, folder: str) -> DataFrame:
        keys, wanted, step = list(view.keys), list(view.aggregations), view.interval
        now = boundary_of(moment, wanted, step)

        def read(low: int, high: int) -> TileSet:
            return self.tiles_or_computed(view, EPOCH + low * step, EPOCH + high * step)

        old = None
        if before is not None:
            top = f"{self.path}/{view.name}/latest/run={before['run']}"
            states = {n: self.spark.read.parquet(f"{top}/state_{n}") for n in state_names(wanted)}
            old = boundary_of(moment_of(before["at"]), wanted, step), states
        state = next_state(read, wanted, keys, step, now, old)
        for name, part in state.items():
            part.write.parquet(f"{folder}/state_{name}")
        state = {n: self.spark.read.schema(p.schema).parquet(f"{folder}/state_{n}") for n, p in state.items()}
        return values_of(state, read, wanted, keys, step, now, moment)

    def published(self, view: View, moment: datetime, prefix: str = "") -> Snapshot:
        """The newest published values that are not newer than a moment."""
        mark = self._published(view, instant_micros(moment))
        if mark is None:
            raise ValueError(f"view {view.name} has nothing published up to {moment}")
        return view.snapshot_of(self._values(view, mark), moment_of(mark["at"]), prefix)

    def newest(self, view: View, moment: datetime, stale: timedelta = timedelta(0), prefix: str = "") -> Snapshot | None:
        """Published values that are as of a moment, or at most ``stale`` older; None if there are none."""
        mark = self._published(view, instant_micros(moment))
        if mark is None:
            return None
        at, least = mark["at"], instant_micros(moment - stale)
        if view.aggregations and view.interval != CONTINUOUS:
            # between two boundaries nothing changes
            at, least = at // micros(view.interval), least // micros(view.interval)
        return self.published(view, moment, prefix) if at >= least else None

    # -- reads ----------------------------------------------------------------

    @staticmethod
    def _inside(segments: list[Segment], time: Column, whole: set[Segment] = frozenset()) -> Column:
        """Rows of the jobs that count; only jobs of which a part counts need their times compared."""
        kept = F.col(RUN).isin(sorted({run for *_, run in segments}))
        for run in sorted({s[2] for s in segments if s not in whole}):
            pieces = [(time >= a) & (time < b) for a, b, r in segments if r == run]
            any_of = pieces[0]
            for piece in pieces[1:]:
                any_of = any_of | piece
            kept = kept & ((F.col(RUN) != run) | any_of)
        return kept

    def _part(
        self, view: View, marks: list[Row], name: str, like: DataFrame, low: int | None, high: int | None, days: DataFrame | None = None
    ):
        """The stored rows of one part in ``[low, high)``, and the ranges that are not stored, each
        with whether it lies after all that is. ``days`` lists the days that matter; Spark learns
        them when the job runs and opens only their partitions."""
        segments = self._segments(view, marks, name, like)
        ranges = ranges_of(segments)
        gaps = [(a, b, bool(ranges) and a is not None and a >= ranges[-1][1]) for a, b in uncovered(ranges, low, high)]
        touched = [s for s in segments if (low is None or s[1] > low) and (high is None or s[0] < high)]
        if not touched:
            return like.limit(0), gaps
        time = _micros_of(name, view.ts, micros(view.interval))
        whole = {(m["low"], m["high"], m["run"]) for m in marks if m["part"] == name}
        first, last = min(s[0] for s in touched), max(s[1] for s in touched) - 1
        first = first if low is None else max(first, low)
        last = last if high is None else min(last, high)
        schema = T.StructType([*like.schema.fields, T.StructField("day", T.StringType()), T.StructField(RUN, T.LongType())])
        try:
            part = self.spark.read.schema(schema).parquet(f"{self.path}/{view.name}/{name}")
        except AnalysisException as missing:
            # jobs that found no rows at all wrote no files either
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return like.limit(0), gaps
        part = part.filter((F.col("day") >= day_of(first)) & (F.col("day") <= day_of(last)))
        if low is not None:
            part = part.filter(time >= low)
        if high is not None:
            part = part.filter(time < high)
        part = part.filter(self._inside(touched, time, whole))
        if days is not None:
            # one row per day of the calendar at most, whatever the spine
            part = part.join(F.broadcast(days), "day", "left_semi")
        return part.select(*[f"`{c}`" for c in like.columns]), gaps

    def rows(self, view: View, start: datetime | None = None, end: datetime | None = None):
        """Stored rows of ``[start, end)``."""
        return self._part(view, self._marks(view), "rows", view.frame(), _at(start), _at(end))[0]

    def _tiles(
        self, view: View, start: datetime | None, end: datetime | None, days: DataFrame | None = None
    ) -> tuple[TileSet, dict]:
        """Stored tiles, whole where they touch the range, and the gaps of each part."""
        step, marks, like = micros(view.interval), self._marks(view), view.tiles()
        low = None if start is None else instant_micros(start) // step * step
        found_ = {n: self._part(view, marks, n, df, low, _at(end), days) for n, df in like.parts().items()}
        return like.replace({n: df for n, (df, _) in found_.items()}), {n: gaps for n, (_, gaps) in found_.items()}

    def tiles(
        self, view: View, start: datetime | None = None, end: datetime | None = None
    ) -> TileSet:
        """Stored tiles in the shape the view would compute them, whole where they touch the range."""
        return self._tiles(view, start, end)[0]

    def rows_or_computed(self, view: View, start, end, days: DataFrame | None = None) -> DataFrame:
        """The rows of a range: stored ones, and others where nothing is loaded."""
        rows, gaps = self._part(view, self._marks(view), "rows", view.frame(), _at(start), _at(end), days)
        for low, high, after in gaps:
            low, high = _moment(low), _moment(high)
            if after and self._streams(view):
                more = between(self.beyond.rows_or_computed(view, low, high), view.ts, view.start, None)
            else:
                more = between(view.frame(low, high), view.ts, low, high)
            rows = rows.unionByName(more)
        return rows

    def tiles_or_computed(self, view: View, start, end, days: DataFrame | None = None) -> TileSet:
        """The tiles of a range: each part stored where it is loaded, and others elsewhere."""
        stored, gaps = self._tiles(view, start, end, days)
        more = {gap: self._more(view, *gap) for gap in {g for listed in gaps.values() for g in listed}}
        parts = {}
        for name, df in stored.parts().items():
            for gap in gaps[name]:
                df = df.unionByName(more[gap][name])
            parts[name] = df
        return stored.replace(parts)

    def _more(self, view: View, low: int | None, high: int | None, after: bool) -> dict[str, DataFrame]:
        """The tiles of a gap, from what streams have written or from the sources."""
        if not (after and self._streams(view)):
            return view.tiles(_moment(low), _moment(high)).parts()
        first = -(-max(low, start_of(view) or low) // micros(view.interval))
        tiles = self.beyond.tiles_or_computed(view, _moment(low), _moment(high))
        return tiles.map(lambda t: t.filter(F.col(AT) >= first)).parts()

    def _streams(self, view: View) -> bool:
        return self.beyond is not None and self.beyond.has(view)
