"""Feature services: several views asked for together."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import CONTINUOUS, bucket, floor_div, micros
from tidemark.operators.asof import FeatureTable, asof_answers
from tidemark.operators.lookup import Snapshot, lookup
from tidemark.operators.ondemand import OnDemand
from tidemark.operators.points import AT, attach, points_of
from tidemark.operators.windows import Part, complete, part_answers
from tidemark.plans.views import View
from tidemark.sources.spine import spine_of
from tidemark.sources.tables import instant, only_between

SEP = "__"


@dataclass(frozen=True)
class Service:
    """An ordered list of views, subsets of views and on-demand views.

    Output columns are the spine's, unchanged, then ``<view>__<feature>`` in order.
    A name is free text: ``fraud`` and ``fraud:v3`` are two services.
    """

    name: str
    features: tuple

    @staticmethod
    def of(name: str, features: list) -> Service:
        return Service(name, tuple(features))

    def variant(self, suffix: str, features: list) -> Service:
        return Service(f"{self.name}:{suffix}", tuple(features))

    def _on_demand(self) -> list[OnDemand]:
        return [f for f in self.features if isinstance(f, OnDemand)]

    def _views(self) -> list[View]:
        """Stored views the service needs, listed or as input of an on-demand view.

        A view needed twice, with different subsets, is looked up once.
        """
        needed: dict[str, View] = {}
        listed = [f for f in self.features if isinstance(f, View)]
        for view in [*listed, *[v for o in self._on_demand() for v in o.views]]:
            known = needed.get(view.name)
            needed[view.name] = view if known is None else _merged(known, view)
        return list(needed.values())

    @property
    def join_keys(self) -> list[str]:
        return list(dict.fromkeys(k for v in self._views() for k in v.keys))

    @property
    def request_columns(self) -> list[str]:
        names = [f for o in self._on_demand() for r in o.requests for f in r.schema.fieldNames()]
        return list(dict.fromkeys(names))

    @property
    def names(self) -> list[str]:
        return [f"{item.name}{SEP}{f}" for item in self.features for f in item.features]

    def validate(self) -> Service:
        if len(set(self.names)) != len(self.names):
            raise ValueError(f"service {self.name} lists a feature twice")
        for item in self.features:
            item.validate()
        return self

    def historical(
        self,
        spine,
        ts: str,
        store=None,
        effective: bool = False,
        period: tuple[datetime, datetime] | None = None,
        spark: SparkSession | None = None,
    ) -> DataFrame:
        """Every spine row once, with all features as of its time.

        Features come from ``store`` where it holds the view, else from the sources. Views
        with the same keys share one join of the spine. Of these, row-level views share one
        window, and so do aggregating views with the same interval. ``effective`` adds the effective time per view. A
        ``period`` promises that all spine times lie in it and limits what is read.

        The spine is read once per group of views; one that is dear to compute is better
        cached or written first.
        """
        views = self._views()
        spark = spark or (views[0].sources[0].batch.sparkSession if views else None)
        df = spine_of(spark, spine)
        missing = [c for c in [*self.join_keys, ts] if c not in df.columns]
        if missing:
            raise ValueError(f"service {self.name} needs spine columns {missing}")
        if period is not None:
            df = only_between(df, ts, period)
        for request in [r for o in self._on_demand() for r in o.requests]:
            df = request.apply(df)
        # All lookups take their points from the spine itself, not from one another.
        base, kept, parts = df, df.columns, []
        times = base if period is None else None
        for keys in dict.fromkeys(v.keys for v in views):
            mine = [v for v in views if v.keys == keys]
            tables = [
                v.table(v.stored_rows(store, period, times, ts), f"{v.name}{SEP}")
                for v in mine
                if not v.aggregations
            ]
            tiled: dict[timedelta, list[Part]] = {}
            for view in [v for v in mine if v.aggregations]:
                part = view.part(store, period, f"{view.name}{SEP}", times, ts)
                tiled.setdefault(view.interval, []).append(part)
                parts.append(part)
            finest, found = _by_key(base, list(keys), ts, tables, tiled, effective)
            df = attach(df, list(keys), bucket(F.col(ts), finest), found)
        df = complete(df, ts, parts, effective)
        return self._finish(df, kept, effective)

    def _finish(self, df: DataFrame, kept: list[str], effective: bool) -> DataFrame:
        """On-demand features on top of the looked-up ones, and the columns asked for."""
        for item in self._on_demand():
            asked = {r.name for r in item.requests}

            def locate(name, field, asked=asked):
                return F.col(f"`{field}`" if name in asked else f"`{name}{SEP}{field}`")

            df = item.apply(df, locate, f"{item.name}{SEP}")
        out = [f"`{n}`" for n in self.names]
        if effective:
            listed = [f.name for f in self.features if isinstance(f, View)]
            out += [f"`{n}{SEP}effective_ts`" for n in listed]
        return df.select(*kept, *out)

    def lookup(
        self,
        requests,
        moment: datetime,
        store=None,
        snapshots: dict[str, Snapshot] | None = None,
        effective: bool = False,
        spark: SparkSession | None = None,
        stale: timedelta = timedelta(0),
    ) -> DataFrame:
        """The latest features for a batch of requests: keys, and request columns if needed.

        Values are what was visible at the moment. A view's values come from ``snapshots``
        if given there, else from what the store has published as of the moment, or at most
        ``stale`` before it, else from the store's history or the sources.
        """
        views = self._views()
        spark = spark or (views[0].sources[0].batch.sparkSession if views else None)
        df = spine_of(spark, requests)
        for request in [r for o in self._on_demand() for r in o.requests]:
            df = request.apply(df)
        given = snapshots or {}
        published = getattr(store, "newest", lambda *_: None)
        shots = [
            given.get(v.name)
            or published(v, moment, stale, f"{v.name}{SEP}")
            or v.snapshot(moment, store, f"{v.name}{SEP}")
            for v in views
        ]
        return self._finish(lookup(df, shots, moment, effective), df.columns, effective)

    def at(self, spine, moment: datetime | None = None, **options) -> DataFrame:
        """Features as of one moment, by default now, for every row of a spine."""
        time = F.current_timestamp() if moment is None else instant(moment)
        views = self._views()
        spark = views[0].sources[0].batch.sparkSession if views else options.get("spark")
        stamped = spine_of(spark, spine).withColumn("current_timestamp", time)
        return self.historical(stamped, "current_timestamp", **options)


def _by_key(
    base: DataFrame,
    keys: list[str],
    ts: str,
    tables: list[FeatureTable],
    tiled: dict[timedelta, list[Part]],
    effective: bool,
) -> tuple[timedelta, DataFrame]:
    """All features of one key set, at points of the finest time step that they need.

    Values of coarser steps are joined onto these points, which are narrow. So the spine
    itself, with all its columns, is joined only once per key set.
    """
    steps = [CONTINUOUS] if tables else list(tiled)
    finest = math.gcd(*[micros(s) for s in steps]) * CONTINUOUS
    points = points_of(base, keys, bucket(F.col(ts), finest))
    found = asof_answers(points, keys, tables, effective) if tables else None
    for interval in sorted(tiled):
        ratio = interval // finest
        step = floor_div(F.col(AT), ratio)
        at = points if ratio == 1 else points.select(*keys, step.alias(AT)).distinct()
        answers = part_answers(at, tiled[interval])
        if found is None and ratio == 1:
            found = answers
            continue
        coarse = answers.withColumnRenamed(AT, "_step")
        left = points if found is None else found
        found = left.withColumn("_step", step).join(coarse, [*keys, "_step"], "left").drop("_step")
    return finest, found


def on_demand_historical(item: OnDemand, spine, ts: str, **options) -> DataFrame:
    """Spine rows with one on-demand view's features under their bare names."""
    done = Service.of(item.name, [item]).historical(spine, ts, **options)
    return done.withColumnsRenamed({f"{item.name}{SEP}{f}": f for f in item.features})


def _code(view: View) -> tuple:
    """What the body of a view does: its code and what it encloses."""
    cells = getattr(view.body, "__closure__", None) or ()
    return getattr(view.body, "__code__", view.body), tuple(c.cell_contents for c in cells)


def _merged(a: View, b: View) -> View:
    """One lookup for two subsets of a view; two views of one name are an error."""
    rest = {"aggregations": (), "columns": (), "body": None}
    if replace(a, **rest) != replace(b, **rest) or _code(a) != _code(b):
        raise ValueError(f"two different views are named {a.name}")
    if a.aggregations:
        return replace(a, aggregations=tuple(dict.fromkeys(a.aggregations + b.aggregations)))
    return replace(a, columns=tuple(dict.fromkeys(a.features + b.features)))
