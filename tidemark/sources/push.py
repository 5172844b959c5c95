"""Pushed events: JSON envelopes that carry records of several sources at once."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The wire format of an envelope.
ENVELOPE = (
    "workspace_name string, dry_run boolean, "
    "records map<string, array<struct<record: string>>>"
)
_BAD = "_corrupt_record"


def unpack(envelopes: DataFrame, column: str = "value") -> DataFrame:
    """One row per pushed record: workspace, dry-run flag, source and the record's JSON.

    The flag travels inside the exploded array. A filter on it then cannot move below the
    explode, where it would parse every envelope a second time.
    """
    parsed = envelopes.select(F.from_json(F.col(column), ENVELOPE).alias("e"))

    def row(source: Column, item: Column) -> Column:
        return F.struct(
            F.col("e.workspace_name").alias("workspace_name"),
            F.coalesce(F.col("e.dry_run"), F.lit(False)).alias("dry_run"),
            source.alias("source"),
            item["record"].alias("record"),
        )

    by_source = F.transform(
        F.map_entries("e.records"),
        lambda entry: F.transform(entry["value"], lambda item: row(entry["key"], item)),
    )
    return parsed.select(F.inline(F.flatten(by_source)))


def _parsed(schema: T.StructType) -> Column:
    marked = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    return F.from_json("record", marked, {"columnNameOfCorruptRecord": _BAD})


def _fits(parsed: Column) -> Column:
    return parsed.isNotNull() & parsed[_BAD].isNull()


def typed(records: DataFrame, source: str, schema: T.StructType) -> DataFrame:
    """Records of one source as columns; records that do not fit the schema are left out."""
    # Filtering inside an array parses each record once; a row filter would be pushed
    # below the projection together with another copy of the parser.
    fitting = F.filter(F.array(_parsed(schema)), _fits)
    rows = records.filter(F.col("source") == source).select(F.inline(fitting))
    return rows.select(*[f"`{n}`" for n in schema.fieldNames()])


def accepted(records: DataFrame, source: str, schema: T.StructType) -> DataFrame:
    """What an ingest writes for one source: fitting records of envelopes not on dry run."""
    return typed(records.filter(~F.col("dry_run")), source, schema)


def report(records: DataFrame, schemas: dict[str, T.StructType]) -> DataFrame:
    """Good and bad records per source and dry-run flag. Writes nothing.

    A record is bad if it does not fit its source's schema or its source is unknown.
    """
    good = F.lit(False)
    for source, schema in schemas.items():
        fits = F.exists(F.array(_parsed(schema)), _fits)
        good = F.when(F.col("source") == source, fits).otherwise(good)
    return (
        records.select("source", "dry_run", good.alias("good"))
        .groupBy("source", "dry_run")
        .agg(
            F.count_if("good").alias("n_good"),
            F.count_if(~F.col("good")).alias("n_bad"),
        )
    )


def _lacks(schema: T.StructType, needed: str | None) -> Column:
    if needed is None:
        return F.lit(False)
    return F.exists(F.array(_parsed(schema)), lambda p: p[needed].isNull())


LANDED = "source string, record string, reason string, kind string"
RUNS = "run string, attempt long"
REJECTED, MALFORMED = "_rejected", "_malformed"


def sorted_out(
    envelopes: DataFrame, schemas: dict[str, T.StructType], column: str = "value", required: dict[str, str] | None = None
) -> DataFrame:
    """(source, record, reason, kind) of all that is no dry run, each envelope parsed once.

    The kind is the record's source if it is accepted, else ``_rejected`` with a reason;
    an envelope that cannot be unpacked is ``_malformed`` and its own record.
    """
    marked = T.StructType([*T.StructType.fromDDL(ENVELOPE).fields, T.StructField(_BAD, T.StringType())])
    parsed = envelopes.select(F.col(column).alias("text"), F.from_json(F.col(column), marked, {"columnNameOfCorruptRecord": _BAD}).alias("e"))
    bad = F.col("e").isNull() | F.col(f"e.{_BAD}").isNotNull() | F.col("e.records").isNull() | F.col("text").isNull()

    def row(source: Column, record: Column, malformed: bool) -> Column:
        return F.struct(source.alias("source"), record.alias("record"), F.lit(malformed).alias("malformed"))

    by_source = F.transform(
        F.map_entries("e.records"), lambda entry: F.transform(entry["value"], lambda item: row(entry["key"], item["record"], False))
    )
    whole = F.array(row(F.lit(None).cast("string"), F.col("text"), True))
    taken = F.when(F.coalesce(F.col("e.dry_run"), F.lit(False)), F.slice(whole, 1, 0)).otherwise(F.flatten(by_source))
    rows = parsed.select(F.inline(F.when(bad, whole).otherwise(taken)))
    reason = F.lit("unknown source")
    for source, schema in schemas.items():
        fits = F.exists(F.array(_parsed(schema)), _fits)
        mine = F.when(~fits, "does not fit").when(_lacks(schema, (required or {}).get(source)), f"no {(required or {}).get(source)}")
        reason = F.when(F.col("source") == source, mine).otherwise(reason)
    told = rows.withColumn("reason", F.when(~F.col("malformed"), reason))
    kind = F.when(F.col("malformed"), MALFORMED).when(F.col("reason").isNotNull(), REJECTED).otherwise(F.col("source"))
    return told.select("source", "record", "reason", kind.alias("kind"))


def ingest(
    envelopes: DataFrame,
    schemas: dict[str, T.StructType],
    path: str,
    run: str,
    column: str = "value",
    required: dict[str, str] | None = None,
) -> None:
    """Write the accepted records of every source, and keep aside all that is not accepted.

    ``run`` names the job's input. Envelopes are unpacked once, into a table by kind, and each
    source is written from its own part of it. The mark of the attempt comes last: readers see all
    of a run or none, and of a run that is tried again the newest whole attempt only.
    """
    spark, attempt = envelopes.sparkSession, time.time_ns()
    landed = _folder(path, "_landed", run, attempt)
    sorted_out(envelopes, schemas, column, required).write.partitionBy("kind").parquet(landed)
    records = spark.read.schema(LANDED).parquet(landed)
    for source, schema in schemas.items():
        typed(records.filter(F.col("kind") == source), source, schema).write.parquet(_folder(path, source, run, attempt))
    mark = spark.createDataFrame([(run, attempt)], RUNS)
    mark.coalesce(1).write.mode("append").parquet(f"{path}/_runs")


def _folder(path: str, name: str, run: str, attempt: int) -> str:
    return f"{path}/{name}/run={run}/attempt={attempt}"


def ingested(spark: SparkSession, path: str, name: str) -> DataFrame:
    """What whole runs have taken in for a source, or what they kept aside as rejected or malformed."""
    runs = spark.read.schema(RUNS).parquet(f"{path}/_runs").groupBy("run").agg(F.max("attempt").alias("attempt")).collect()
    if name not in (REJECTED, MALFORMED):
        return spark.read.parquet(*[_folder(path, name, r["run"], r["attempt"]) for r in runs])
    rows = spark.read.schema(LANDED).parquet(*[_folder(path, "_landed", r["run"], r["attempt"]) for r in runs])
    rows = rows.filter(F.col("kind") == name)
    return rows.select("source", "record", "reason") if name == REJECTED else rows.select(F.col("record").alias("envelope"))
