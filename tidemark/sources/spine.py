"""Spines: the rows to enrich, and the request columns that ride on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import utc


def spine_of(spark: SparkSession, rows, schema: T.StructType | str | None = None) -> DataFrame:
    """A spine from a Spark frame, a pandas frame or a list of records.

    Records need a schema, so that a column of mixed whole and broken numbers is double.
    """
    if isinstance(rows, DataFrame):
        return utc(rows)
    if isinstance(rows, list):
        if schema is None:
            raise ValueError("a list of records needs a schema")
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        doubles = {f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)}
        rows = [
            {k: float(v) if k in doubles and v is not None else v for k, v in r.items()}
            for r in rows
        ]
    return utc(spark.createDataFrame(rows, schema))


@dataclass(frozen=True)
class Request:
    """Columns whose values are known only when a feature is asked for."""

    name: str
    schema: T.StructType

    @staticmethod
    def of(name: str, ddl: str) -> Request:
        return Request(name, T.StructType.fromDDL(ddl))

    def apply(self, spine: DataFrame) -> DataFrame:
        """The spine with the request columns checked and cast to their declared types."""
        missing = [f.name for f in self.schema.fields if f.name not in spine.columns]
        if missing:
            raise ValueError(f"request {self.name} needs columns {missing}")
        return spine.withColumns(
            {f.name: F.col(f.name).cast(f.dataType) for f in self.schema.fields}
        )
