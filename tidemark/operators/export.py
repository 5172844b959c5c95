"""Feature vectors as CSV and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Times keep their microseconds.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _flat(df: DataFrame) -> DataFrame:
    """Lists, maps and structs as JSON text, which CSV has no other way to hold."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    options = {"ignoreNullFields": "false", **_TIMES}
    return df.withColumns({n: F.to_json(F.col(f"`{n}`"), options) for n in nested}) if nested else df


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """Rows as CSV files; nested values are JSON text and are read back as text."""
    _flat(df).write.mode("overwrite").options(**_TIMES).option("header", header).csv(path)


def read_csv(spark: SparkSession, path: str, schema, header: bool = False) -> DataFrame:
    return spark.read.schema(schema).options(**_TIMES).option("header", header).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_TIMES).json(path)


def csv_lines(df: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """One CSV line per row, without a header."""
    places = [f"_value{i}" for i in range(len(names))]
    packed = _flat(df.select(*keep, *[F.col(n).alias(p) for n, p in zip(names, places)]))
    return packed.select(*keep, F.to_csv(F.struct(*places), _TIMES).alias("line"))


def json_lines(df: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """One JSON object per row; nulls are kept as nulls."""
    options = {"ignoreNullFields": "false", **_TIMES}
    return df.select(*keep, F.to_json(F.struct(*names), options).alias("line"))


def csv_header(names: list[str]) -> str:
    return ",".join(names)
