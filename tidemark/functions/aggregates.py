"""Time-window aggregates: what they are called and which partials they need."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.time import CONTINUOUS, label, micros

#: Functions whose partials can be taken out of a running total again.
SUMMED = ("count", "sum", "mean")
#: Functions of which one row per key and interval holds everything.
MERGED = (*SUMMED, "min", "max", "approx_distinct")
LISTS = ("last", "last_distinct")
FUNCTIONS = (*MERGED, "distinct", *LISTS)
#: 0 where nothing was seen; all others are null.
COUNTS = ("count", "distinct", "approx_distinct")
#: Sketches have 2 to this power cells: a relative standard error of 1.04 / sqrt(4096) = 1.6 %.
SKETCH = 12


@dataclass(frozen=True)
class Partial:
    """How a partial aggregate is made from values, merged as rows, and merged as two columns."""

    build: Callable[[str], Column]
    merge: Callable[[str], Column]
    combine: Callable[[Column, Column], Column]


def _sketched(column: str) -> Column:
    return F.hll_sketch_agg(F.col(f"`{column}`").cast("string"), SKETCH)


#: Partials by the letter that their columns start with: number, sum, least, greatest, sketch.
PARTIALS = {
    "n": Partial(F.count, F.sum, lambda a, b: a + b),
    "s": Partial(F.sum, F.sum, lambda a, b: a + b),
    "l": Partial(F.min, F.min, F.least),
    "g": Partial(F.max, F.max, F.greatest),
    "h": Partial(_sketched, F.hll_union_agg, F.hll_union),
}
NEEDS = {"count": "n", "sum": "ns", "mean": "ns", "min": "l", "max": "g", "approx_distinct": "h"}


def merge_of(partial: str) -> Callable[[str], Column]:
    """How rows of a partial column merge."""
    return PARTIALS[partial.lstrip("_")[0]].merge


@dataclass(frozen=True)
class Aggregate:
    """One function of one column over one trailing window.

    ``count`` counts non-null values, also zeros. ``last`` keeps the newest ``size``
    values, newest first; ``last_distinct`` the newest ``size`` different ones, each at its newest
    time. ``approx_distinct`` counts different values by a sketch of fixed size.
    """

    column: str
    function: str
    window: timedelta
    size: int | None = None

    def __post_init__(self):
        if self.function not in FUNCTIONS:
            raise ValueError(f"unknown function {self.function!r}; have {FUNCTIONS}")
        if (self.function in LISTS) != (self.size is not None):
            raise ValueError(f"size belongs to functions {LISTS} and only there")
        if self.size is not None and self.size < 1:
            raise ValueError("size must be at least 1")
        micros(self.window)

    @property
    def partials(self) -> list[str]:
        """Columns of a tile that hold what the aggregate needs, if one row does."""
        return [f"{p}_{self.column}" for p in NEEDS.get(self.function, "")]

    @property
    def part(self) -> str:
        """The part of the tiles that holds what the aggregate needs."""
        if self.function in MERGED:
            return "merged"
        if self.function == "distinct":
            return f"distinct_{self.column}"
        return f"{'recent' if self.function == 'last' else 'newest'}{self.size}_{self.column}"

    def feature(self, interval: timedelta) -> str:
        """Generated feature name: column, function, window, interval."""
        function = self.function
        if self.size is not None:
            function = function.replace("last", f"last{self.size}", 1)
        return f"{self.column}_{function}_{label(self.window)}_{label(interval)}"

    def buckets(self, interval: timedelta) -> int:
        """Window length in intervals; a window is a whole number of them."""
        whole, rest = divmod(micros(self.window), micros(interval))
        if rest:
            raise ValueError(f"window {self.window} is not a multiple of {interval}")
        return whole


def partials_of(aggregates: list[Aggregate]) -> list[str]:
    """The columns of a tile that some aggregates need, counts first."""
    needed = {p for a in aggregates for p in a.partials}
    return sorted(needed, key=lambda p: (list(PARTIALS).index(p[0]), p))


def check(aggregates: list[Aggregate], interval: timedelta) -> None:
    names = [a.feature(interval) for a in aggregates]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate aggregates: {sorted(names)}")
    for a in aggregates:
        a.buckets(interval)
        if a.function == "last_distinct" and interval == CONTINUOUS:
            raise ValueError(f"{names[aggregates.index(a)]}: lists of different values need an interval")
