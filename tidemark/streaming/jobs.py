"""Streaming jobs: partial tiles, latest values, previews.

Each micro-batch writes its own partial result under its batch number, once. Late events
simply land in a later partial of the same tile, so nothing is dropped and nothing counts twice.
Readers merge the partials; a periodic batch job folds old ones into bases by day.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.files import delete, found
from tidemark.functions.time import EPOCH, bucket_start, instant_micros, micros
from tidemark.operators.asof import latest
from tidemark.operators.lookup import current_values
from tidemark.operators.points import AT
from tidemark.operators.tiles import TileSet, build_tiles, merge_tiles
from tidemark.plans.views import View
from tidemark.session import workdir
from tidemark.sources.tables import between


FOLDED = "number long, part string, days array<string>"
#: The one day of a part whose rows have none.
NO_DAY = "all"


class BatchLog:
    """Partial results by batch number, and bases by day that fold all batches up to a number.

    A result may have several named parts. A batch counts once its mark is there, which is
    written after all its parts, so readers see either all of them or none. Batches run one after
    another, so everything up to the highest mark is whole. A batch that has its mark is never
    written again: a retry of it would only repeat what is there.

    A fold writes the days that its batches touched and leaves the bases of all other days as they
    are; of a day, the base of its newest fold counts. So both folds and reads of a range cost what
    the days they touch hold, however long the history is.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _mark(self, kind: str, rows: list[tuple], schema: str) -> None:
        mark = self.spark.createDataFrame(rows, schema).coalesce(1)
        mark.write.mode("append").parquet(f"{self.path}/{kind}")

    def _marks(self, kind: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}")
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _written(self, above: int) -> list[int]:
        """Whole batches above a number: those since the last fold, not all there ever were."""
        marks = self._marks("written", "number long")
        if marks is None:
            return []
        return sorted(r[0] for r in marks.filter(F.col("number") > above).distinct().collect())

    def _folds(self, upto: int | None = None) -> list[Row]:
        marks = self._marks("folded", FOLDED)
        rows = [] if marks is None else marks.collect()
        return [r for r in rows if upto is None or r["number"] <= upto]

    def _folded(self) -> int:
        return max((r["number"] for r in self._folds()), default=-1)

    def write(self, parts: dict[str, DataFrame], batch: int) -> None:
        if batch <= self._folded() or batch in self._written(batch - 1):
            return
        for name, df in parts.items():
            df.write.mode("overwrite").parquet(f"{self.path}/{name}/batches/batch={batch}")
        self._mark("written", [(batch,)], "number long")

    def upto(self) -> int:
        """The newest whole batch."""
        folded = self._folded()
        written = self._written(folded)
        if folded < 0 and not written:
            raise ValueError(f"nothing written yet under {self.path}")
        return max([folded, *written])

    def _bases(self, name: str, folds: list[Row]) -> dict[str, int]:
        """The newest fold of each day of a part."""
        newest: dict[str, int] = {}
        for fold in folds:
            for day in fold["days"] if fold["part"] == name else []:
                newest[day] = max(newest.get(day, -1), fold["number"])
        return newest

    def _base(self, name: str, days: dict[str, int]) -> list[DataFrame]:
        """The bases of some days; only their folders are listed."""
        if not days:
            return []
        top = f"{self.path}/{name}/bases"
        folders = [f"{top}/upto={n}/day={day}" for day, n in sorted(days.items())]
        return [self.spark.read.parquet(*folders)]

    def _batches(self, name: str, numbers: list[int]) -> list[DataFrame]:
        folders = [f"{self.path}/{name}/batches/batch={n}" for n in numbers]
        return [self.spark.read.parquet(*folders)] if folders else []

    def read(
        self, name: str, upto: int | None = None, days: tuple[str, str] | None = None, like: DataFrame | None = None
    ) -> DataFrame:
        """One part: the newest base of each day, and the whole batches after the last fold.

        ``days`` gives the first and the last day whose bases are read; rows of batches come
        whole. Where there is nothing to read, the result has no rows of ``like``. Readers of
        several parts take ``upto`` once.
        """
        upto = self.upto() if upto is None else upto
        folds = self._folds(upto)
        bases = self._bases(name, folds)
        if days is not None:
            bases = {d: n for d, n in bases.items() if d == NO_DAY or days[0] <= d <= days[1]}
        folded = max((f["number"] for f in folds), default=-1)
        parts = self._base(name, bases) + self._batches(name, [n for n in self._written(folded) if n <= upto])
        if not parts and like is not None:
            return like.limit(0)
        return reduce(DataFrame.unionByName, parts)

    def fold(self, merge: dict[str, Callable[[DataFrame], DataFrame]], day: Column | None = None) -> None:
        """Merge all whole batches of every part into the bases of the days they touch.

        ``day`` says which day a row belongs to. The number is taken once, so a batch that ends
        meanwhile stays above the bases. Readers switch once the mark is there, which is written
        after all parts.
        """
        upto, folds = self.upto(), self._folds()
        folded = max((f["number"] for f in folds), default=-1)
        if upto == folded:
            return
        day = F.lit(NO_DAY) if day is None else day
        numbers, marks = [n for n in self._written(folded) if n <= upto], []
        for name, work in merge.items():
            new = reduce(DataFrame.unionByName, self._batches(name, numbers))
            touched = sorted(r[0] for r in new.select(day.alias("day")).distinct().collect())
            bases = {d: n for d, n in self._bases(name, folds).items() if d in touched}
            whole = reduce(DataFrame.unionByName, [new, *self._base(name, bases)])
            folder = f"{self.path}/{name}/bases/upto={upto}"
            dated = work(whole).withColumn("day", day)
            dated.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(folder)
            marks.append((upto, name, touched))
        self._mark("folded", marks, FOLDED)

    def prune(self, names: list[str]) -> None:
        """Delete the batches that are in bases, and the bases of days that have a newer one.

        For a time at which no reader still reads them.
        """
        folds = self._folds()
        folded = max((f["number"] for f in folds), default=-1)
        for name in names:
            newest = self._bases(name, folds)
            for folder in found(self.spark, f"{self.path}/{name}/batches/batch=*"):
                if int(folder.rpartition("=")[2]) <= folded:
                    delete(self.spark, folder)
            for folder in found(self.spark, f"{self.path}/{name}/bases/upto=*/day=*"):
                *_, fold, day = folder.split("/")
                number, day = int(fold.partition("=")[2]), day.partition("=")[2]
                # a fold without its mark may still be at work
                if number <= folded and newest.get(day) != number:
                    delete(self.spark, folder)


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def tile_stream(view: View, path: str, every: str | None = None) -> StreamingQuery:
    """Write partial tiles of an aggregating view's stream under ``path``.

    ``every`` is the wall-clock cadence, such as ``5 minutes``; without it the query
    takes what is there and stops.
    """
    wanted = (list(view.keys), view.ts, list(view.aggregations), view.interval)
    several = len(view.tiles().parts()) > 1

    def write(batch: DataFrame, number: int) -> None:
        if several:
            batch = batch.persist()
        BatchLog(batch.sparkSession, path).write(build_tiles(batch, *wanted).parts(), number)
        if several:
            batch.unpersist()

    writer = view.stream().writeStream.foreachBatch(write)
    return _start(writer, f"{path}/checkpoint-tiles", every)


def _day_of_tile(view: View) -> Column:
    return F.date_format(bucket_start(F.col(AT), view.interval), "yyyy-MM-dd")


def stream_tiles(
    spark: SparkSession, view: View, path: str, start: datetime | None = None, end: datetime | None = None
) -> TileSet:
    """Whole tiles from everything the stream has written, all parts up to the same batch.

    With bounds, the tiles that touch ``[start, end)``; the bases of other days are not read.
    """
    shape, log = view.tiles(), BatchLog(spark, path)
    upto, step, days = log.upto(), micros(view.interval), None
    low = None if start is None else instant_micros(start) // step
    high = None if end is None else -(-instant_micros(end) // step)
    if low is not None or high is not None:
        first = "" if low is None else f"{EPOCH + low * view.interval:%Y-%m-%d}"
        last = "~" if high is None else f"{EPOCH + (high - 1) * view.interval:%Y-%m-%d}"
        days = first, last

    def inside(df: DataFrame) -> DataFrame:
        df = df if low is None else df.filter(F.col(AT) >= low)
        return df if high is None else df.filter(F.col(AT) < high)

    parts = {name: inside(log.read(name, upto, days, df).select(*df.columns)) for name, df in shape.parts().items()}
    return merge_tiles(shape.replace(parts))


def fold_tiles(spark: SparkSession, view: View, path: str) -> None:
    shape = view.tiles()

    def merger(name: str) -> Callable[[DataFrame], DataFrame]:
        def merge(df: DataFrame) -> DataFrame:
            return merge_tiles(shape.replace({**shape.parts(), name: df})).parts()[name].select(*df.columns)

        return merge

    BatchLog(spark, path).fold({name: merger(name) for name in shape.parts()}, _day_of_tile(view))


def latest_stream(view: View, path: str, every: str | None = None) -> StreamingQuery:
    """Keep the newest feature row per key, as per-batch partials under ``path``."""
    table, keys = view.whole_table(view.frame()), list(view.keys)

    def write(batch: DataFrame, number: int) -> None:
        rows = latest(replace(table, frame=batch), keys)
        BatchLog(batch.sparkSession, f"{path}/newest").write({"latest": rows}, number)

    writer = view.stream().writeStream.foreachBatch(write)
    return _start(writer, f"{path}/checkpoint-latest", every)


def stream_latest(spark: SparkSession, view: View, path: str) -> DataFrame:
    """The newest row per key over everything the stream has written."""
    rows = BatchLog(spark, f"{path}/newest").read("latest")
    return latest(replace(view.table(), frame=rows), list(view.keys))


def stream_current(spark: SparkSession, view: View, path: str, moment: datetime) -> DataFrame:
    """The values of an aggregating view per key at a moment, finished from its stream's tiles."""
    return current_values(stream_tiles(spark, view, path), list(view.aggregations), moment)


def fold_latest(spark: SparkSession, view: View, path: str) -> None:
    table, keys = view.whole_table(view.frame()), list(view.keys)
    log = BatchLog(spark, f"{path}/newest")
    log.fold({"latest": lambda df: latest(replace(table, frame=df), keys)})


def row_stream(view: View, path: str, every: str | None = None) -> StreamingQuery:
    """Append the rows of a row-level view's stream to its history, partitioned by day."""
    dated = view.stream().withColumn("day", F.date_format(view.ts, "yyyy-MM-dd"))
    writer = dated.writeStream.format("parquet").partitionBy("day").option("path", f"{path}/rows")
    return _start(writer, f"{path}/checkpoint-rows", every)


def stream_rows(spark: SparkSession, view: View, path: str) -> DataFrame:
    """The history a row stream has written."""
    schema = view.frame().schema.add("day", "string")
    return spark.read.schema(schema).parquet(f"{path}/rows").drop("day")


class StreamHistory:
    """What streams have written, where a service or view takes a store.

    ``tiles`` and ``rows`` name the folder of each aggregating and each row-level view. Answers
    reach as far as the newest whole batch; there is nothing to fill in from elsewhere.
    """

    def __init__(self, spark: SparkSession, tiles: dict[str, str] | None = None, rows: dict[str, str] | None = None):
        self.spark, self.folders = spark, {**(tiles or {}), **(rows or {})}

    def has(self, view: View) -> bool:
        return view.name in self.folders

    def rows_or_computed(
        self, view: View, start: datetime | None, end: datetime | None, days: DataFrame | None = None
    ) -> DataFrame:
        return between(stream_rows(self.spark, view, self.folders[view.name]), view.ts, start, end)

    def tiles_or_computed(
        self, view: View, start: datetime | None, end: datetime | None, days: DataFrame | None = None
    ) -> TileSet:
        # one interval more: a continuous window sees its own moment
        end = None if end is None else end + view.interval
        return stream_tiles(self.spark, view, self.folders[view.name], start, end)


class Preview:
    """A stream written as it comes into files that can be queried as a temporary view.

    The rows lie in the working folder, so a long preview fills no driver memory.
    """

    def __init__(self, stream: DataFrame, name: str, every: str | None = None):
        self.spark, self.schema, self.name = stream.sparkSession, stream.schema, name
        self.path = workdir(self.spark, "preview")
        writer = stream.writeStream.format("parquet").option("path", f"{self.path}/table")
        self.query = _start(writer, f"{self.path}/checkpoint", every)

    def table(self) -> DataFrame:
        """What has arrived so far, also registered under the preview's name."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/table")
        rows.createOrReplaceTempView(self.name)
        return rows

    def stop(self) -> None:
        self.query.stop()


def finish(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself; its failure is raised here."""
    query.awaitTermination()
