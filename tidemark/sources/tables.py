"""Tables and streams as sources of events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import date_parts, instant_micros


def utc(df: DataFrame) -> DataFrame:
    """Zone-less timestamps read as UTC instants; other columns stay as they are."""
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def zoneless(df: DataFrame) -> DataFrame:
    """The inverse of :func:`utc`, for outputs that are compared across engines."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return utc(spark.read.parquet(f"{folder}/{name}.parquet"))


def stream_table(spark: SparkSession, folder: str, name: str, files: int = 1000) -> DataFrame:
    """A stream over the same files, at most ``files`` new ones per micro-batch."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    # As a pattern, the path may also name a table that is one file.
    return utc(reader.parquet(f"{folder}/{name}.parque[t]"))


def stream_from(
    spark: SparkSession, format: str, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """A stream from any connector on the class path, such as a message broker."""
    reader = spark.readStream.format(format).options(**options)
    return reader.schema(schema).load() if schema is not None else reader.load()


def with_times(df: DataFrame, format: str | None = None, *columns: str) -> DataFrame:
    """Text columns as instants, by a pattern or in ISO form; what does not parse is null."""
    options = [] if format is None else [F.lit(format)]
    return utc(df.withColumns({c: F.try_to_timestamp(F.col(c), *options) for c in columns}))


def instant(moment: datetime):
    """A literal for a Python datetime; one without a zone is UTC."""
    return F.timestamp_micros(F.lit(instant_micros(moment)))


def between(df: DataFrame, ts: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows of ``[start, end)``. The bounds are plain comparisons, so they reach the scan."""
    if start is not None:
        df = df.filter(F.col(ts) >= instant(start))
    if end is not None:
        df = df.filter(F.col(ts) < instant(end))
    return df


@dataclass(frozen=True)
class Source:
    """A named source: a batch table and, if it streams, the same events as a stream.

    The stream may be a function that opens it. A ``filtered`` source hands out only the rows of a job's time range.
    """

    name: str
    batch: DataFrame
    ts: str | None = None
    stream: DataFrame | Callable[[], DataFrame] | None = None
    filtered: bool = False

    def filter_by_time(self) -> Source:
        if self.ts is None:
            raise ValueError(f"source {self.name} has no time column")
        return replace(self, filtered=True)

    def read(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        return between(self.batch, self.ts, start, end) if self.filtered else self.batch

    def read_stream(self) -> DataFrame:
        if self.stream is None:
            raise ValueError(f"source {self.name} does not stream")
        stream = self.stream() if callable(self.stream) else self.stream
        if [(f.name, f.dataType) for f in stream.schema.fields] != [
            (f.name, f.dataType) for f in self.batch.schema.fields
        ]:
            raise ValueError(f"source {self.name}: stream and batch schemas differ")
        return stream


def only_between(df: DataFrame, ts: str, period: tuple[datetime, datetime]) -> DataFrame:
    """``df``, failing at run time on a row whose time lies outside ``[start, end)``."""
    start, end = period
    inside = (F.col(ts) >= instant(start)) & (F.col(ts) < instant(end))
    message = F.concat(F.lit(f"{ts} outside {start} .. {end}: "), F.col(ts).cast("string"))
    failed = F.raise_error(message).cast("timestamp")
    return df.withColumn(ts, F.when(F.col(ts).isNull() | inside, F.col(ts)).otherwise(failed))


# Names of the string partition columns for year, month and day.
PARTITIONS = ("partition_0", "partition_1", "partition_2")


def write_partitioned(df: DataFrame, ts: str, path: str) -> None:
    """A table partitioned by year, month and day strings.

    The rebalance groups rows by day and lets Spark split a day too large for one task.
    """
    dated = df.withColumns(dict(zip(PARTITIONS, date_parts(F.col(ts)))))
    grouped = dated.hint("rebalance", *PARTITIONS)
    grouped.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(path)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """The partitioned table with its partition columns kept as strings."""
    reader = spark.read.option("mergeSchema", "false")
    schema = reader.parquet(path).schema
    strings = [
        T.StructField(f.name, T.StringType()) if f.name in PARTITIONS else f
        for f in schema.fields
    ]
    return spark.read.schema(T.StructType(strings)).parquet(path)


def on_day(df: DataFrame, day: datetime) -> DataFrame:
    """Partition-pruned rows of one day."""
    year, month, number = f"{day.year:04d}", f"{day.month:02d}", f"{day.day:02d}"
    for column, value in zip(PARTITIONS, (year, month, number)):
        df = df.filter(F.col(column) == value)
    return df
