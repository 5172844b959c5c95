"""On-demand features: computed from request columns and stored features when asked for.

One declaration, three ways to write the function:

* ``native``: mappings of columns in, mapping of columns out. Stays in the JVM.
* ``pandas``: pandas frames in, pandas frame out, one Arrow batch at a time.
* ``python``: dicts in, dict out, one row at a time, sent in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.spine import Request

MODES = ("native", "pandas", "python")


@dataclass(frozen=True)
class OnDemand:
    """``inputs`` are requests and views (or subsets of views), in argument order."""

    name: str
    inputs: tuple
    mode: str
    schema: T.StructType
    body: Callable

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode is one of {MODES}, not {self.mode!r}")

    @property
    def features(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def requests(self) -> list[Request]:
        return [i for i in self.inputs if isinstance(i, Request)]

    @property
    def views(self) -> list:
        return [i for i in self.inputs if not isinstance(i, Request)]

    def fields(self, item) -> list[str]:
        return item.schema.fieldNames() if isinstance(item, Request) else item.features

    def columns(self, locate: Callable[[str, str], Column]) -> list[Column]:
        """Output columns, given where to find field ``f`` of input ``i``.

        Values are held to the declared schema in every mode.
        """
        found = [{f: locate(i.name, f) for f in self.fields(i)} for i in self.inputs]
        if self.mode == "native":
            made = self.body(*found)
            if list(made) != self.features:
                raise ValueError(f"{self.name} returned {list(made)}, declared {self.features}")
            return [made[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields]
        structs = [F.struct(*[c.alias(n) for n, c in one.items()]) for one in found]
        call = _pandas(self.body, self.schema) if self.mode == "pandas" else _rows(
            self.body, self.schema
        )
        result = call(*structs)
        return [result[name].alias(name) for name in self.features]

    def apply(self, df: DataFrame, locate: Callable[[str, str], Column], prefix: str = ""):
        """``df`` with the output columns added."""
        made = self.columns(locate)
        if self.mode == "native":
            return df.select(
                "*", *[c.alias(prefix + n) for n, c in zip(self.features, made)]
            )
        # One call per row: the struct is computed once and then taken apart.
        packed = df.withColumn("_made", F.struct(*made))
        return packed.select(
            *df.columns, *[F.col(f"_made.`{n}`").alias(prefix + n) for n in self.features]
        )

    def run(self, df: DataFrame, *keep: str) -> DataFrame:
        """Try the function on given inputs: a frame with one struct column per input."""
        made = self.columns(lambda name, field: F.col(f"{name}.`{field}`"))
        return df.select(*keep, *made)

    def validate(self) -> OnDemand:
        """Check the declaration; for native functions also the type of the result."""
        names = [i.name for i in self.inputs]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: inputs share a name: {names}")
        if not self.features:
            raise ValueError(f"{self.name}: declares no output")
        for view in self.views:
            view.validate()
        return self


def _rows(body: Callable, schema: T.StructType):
    def call(*structs):
        return body(*[s.asDict() for s in structs])

    return F.udf(call, schema, useArrow=True)


def _pandas(body: Callable, schema: T.StructType):
    names = schema.fieldNames()

    # A struct column arrives as a pandas frame.
    def call(*frames: pd.DataFrame) -> pd.DataFrame:
        return body(*frames)[names]

    # Spark reads the types from the annotations, which must not be strings here.
    call.__annotations__ = {"frames": pd.DataFrame, "return": pd.DataFrame}
    return F.pandas_udf(call, schema)


def on_demand(*, inputs: list, mode: str, schema: str | T.StructType):
    """Declare an on-demand feature view."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)

    def declare(body: Callable) -> OnDemand:
        return OnDemand(body.__name__, tuple(inputs), mode, schema, body)

    return declare
