"""Runnable queries, one per operator or group of operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.aggregates import Aggregate
from tidemark.functions.scalar import joined
from tidemark.functions.time import CONTINUOUS, bucket, bucket_start
from tidemark.operators.asof import FeatureTable, asof_join
from tidemark.operators.export import csv_lines, json_lines, read_csv, write_csv
from tidemark.operators.lookup import current_values, vector
from tidemark.operators.points import AT
from tidemark.operators.tiles import build_tiles
from tidemark.operators.windows import aggregate_asof
from tidemark.plans.service import Service
from tidemark.plans.store import Store
from tidemark.plans.views import coverage, stream_view
from tidemark.queries.fraud import DAY, HOUR, Fraud
from tidemark.session import configure, workdir
from tidemark.sources import push
from tidemark.sources.tables import (
    Source,
    between,
    on_day,
    read_partitioned,
    read_table,
    with_times,
    write_partitioned,
    zoneless,
)
from tidemark.streaming.jobs import (
    Preview,
    StreamHistory,
    finish,
    fold_tiles,
    latest_stream,
    row_stream,
    stream_current,
    stream_latest,
    stream_rows,
    stream_tiles,
    tile_stream,
)

NOW = datetime(2024, 1, 31)
ONE_DAY = datetime(2024, 1, 15)
CLICK = (
    T.StructType()
    .add("timestamp", T.TimestampType())
    .add("content_keyword", T.StringType())
    .add("clicked", T.IntegerType())
)
USER_CLICK = (
    T.StructType()
    .add("timestamp", T.TimestampType())
    .add("user_id", T.StringType())
    .add("clicked", T.IntegerType())
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(body: Callable[[Fraud], DataFrame]) -> Callable[[Fraud], DataFrame]:
    """Register a query; times come back zone-less and doubles rounded to six places."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(zoneless(body(Fraud(spark, folder))))

    QUERIES[body.__name__] = run
    return body


def rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in doubles})


def keyed(df: DataFrame, features: list[str], *also: str) -> DataFrame:
    return df.select("event_id", *also, *features)


# -- windows ----------------------------------------------------------------


@query
def flagship_over50_counts(fraud):
    view = fraud.over_50_counts.validate()
    done = view.historical(fraud.spine, "timestamp")
    return keyed(done, view.features, "user_id", "timestamp")


@query
def over50_literal_count(fraud):
    view = fraud.over_50_flags
    return keyed(view.historical(fraud.spine, "timestamp"), view.features)


@query
def amount_metrics(fraud):
    view = fraud.amounts
    return keyed(view.historical(fraud.spine, "timestamp"), view.features)


@query
def user_txn_counts(fraud):
    view = fraud.txn_counts
    return keyed(view.historical(fraud.spine, "timestamp"), view.features)


@query
def merchant_fraud_rate(fraud):
    view = fraud.merchant_fraud
    return keyed(view.historical(fraud.spine, "timestamp"), view.features, "merchant")


@query
def distinct_merchants_30d(fraud):
    view = fraud.variety
    return keyed(view.historical(fraud.spine, "timestamp"), view.features)


@query
def last10_merchants_14d(fraud):
    view = fraud.last_stores
    (name,) = view.features
    done = view.historical(fraud.spine, "timestamp")
    return done.select("event_id", F.array_join(name, ",").alias("merchants"))


@query
def last10_different_stores(fraud):
    view = fraud.different_stores
    (name,) = view.features
    done = view.historical(fraud.spine, "timestamp")
    return done.select("event_id", F.array_join(name, ",").alias("merchants"))


@query
def stream_different_stores(fraud):
    """The same lists, from tiles that shuffled micro-batches wrote and a fold merged."""
    view = _shuffled(fraud, fraud.different_stores)
    path = workdir(fraud.spark, "tiles")
    finish(tile_stream(view, path))
    fold_tiles(fraud.spark, view, path)
    (name,) = view.features
    history = StreamHistory(fraud.spark, {view.name: path})
    done = view.historical(fraud.spine, "timestamp", store=history)
    return done.select("event_id", F.array_join(name, ",").alias("merchants"))


@query
def amount_extremes(fraud):
    view = fraud.extremes
    return keyed(view.historical(fraud.spine, "timestamp"), view.features)


@query
def continuous_extremes(fraud):
    view = fraud.live_extremes
    return keyed(view.historical(fraud.spine, "timestamp"), view.features)


@query
def approximate_users(fraud):
    """Exact counts, and whether the sketches are within five standard errors of them."""
    view = fraud.rough_variety
    done = view.historical(fraud.spine, "timestamp")
    out = []
    for w in ("7d", "30d"):
        exact, rough = F.col(f"user_id_distinct_{w}_1d"), F.col(f"user_id_approx_distinct_{w}_1d")
        out += [exact, (F.abs(rough - exact) <= F.ceil(exact * (5 * 1.04 / 64))).alias(f"within_{w}")]
    return done.select("event_id", *out)


@query
def continuous_count_1h(fraud):
    view = fraud.live
    return keyed(view.historical(fraud.spine, "timestamp"), view.features)


@query
def continuous_stores(fraud):
    view = fraud.live_stores
    done = view.historical(fraud.spine, "timestamp")
    one, seven, listed = view.features
    return done.select("event_id", one, seven, F.array_join(listed, ",").alias("merchants"))


@query
def merchant_rate_listing(fraud):
    return fraud.merchant_fraud.run()


@query
def merchant_rate_range(fraud):
    """A range of boundaries, reading no more than the range: long windows are cut."""
    start, end = datetime(2024, 1, 8), datetime(2024, 1, 22)
    return fraud.merchant_fraud.run(start, end, widen=False, complete=True)


@query
def merchant_rate_widened(fraud):
    """The same range with whole windows, reading what they need before it."""
    start, end = datetime(2024, 1, 8), datetime(2024, 1, 22)
    return fraud.merchant_fraud.run(start, end)


@query
def merchant_rate_top50(fraud):
    rate = "is_fraud_mean_1d_1d"
    listed = fraud.merchant_fraud[[rate]].run()
    return listed.orderBy(F.desc_nulls_last(rate), "merchant", "window_end").limit(50)


@query
def sliding_1h_by_5m(fraud):
    return fraud.hourly.run()


@query
def distinct_window_emitted(fraud):
    """One incremental run: the finished 30-day window that ends on one day."""
    store = Store(fraud.spark, workdir(fraud.spark, "store"))
    store.emit_window(fraud.variety, NOW)
    return store.finished(fraud.variety)


@query
def staleness_invariant(fraud):
    """A value is never older than its interval: it counts all events up to the interval's start.

    Tiled values against continuous windows asked for at the microsecond before that start, and
    how many rows have events after it, which a later value will count.
    """
    view = fraud.over_50_counts
    start = bucket_start(bucket(F.col("timestamp"), view.interval), view.interval)
    spine = fraud.spine.select("event_id", "user_id", "timestamp", start.alias("start"))
    tiled = view.historical(spine, "timestamp").select("event_id", F.struct(*view.features).alias("tiled"))
    live = replace(view, interval=CONTINUOUS)
    before = spine.select("event_id", "user_id", (F.col("start") - F.expr("INTERVAL 0.000001 SECOND")).alias("timestamp"))
    exact = live.historical(before, "timestamp").select("event_id", F.struct(*live.features).alias("exact"))
    both = tiled.join(exact, "event_id").join(spine, "event_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.hash("tiled") != F.hash("exact")).alias("n_mismatches"),
        F.max(F.unix_micros("timestamp") - F.unix_micros("start")).alias("oldest_micros"),
    )


@query
def customer_spend_windows(fraud):
    """Daily tiles over years of orders: sums, counts and distinct states per customer."""
    orders = read_table(fraud.spark, fraud.folder, "orders")
    wanted = [
        Aggregate("o_totalprice", "sum", 365 * DAY),
        Aggregate("o_totalprice", "count", 90 * DAY),
        Aggregate("o_orderpriority", "distinct", 365 * DAY),
    ]
    tiles = build_tiles(orders, ["o_custkey"], "o_orderdate", wanted, DAY)
    done = aggregate_asof(orders, "o_orderdate", tiles, wanted)
    return done.select("o_orderkey", *[a.feature(DAY) for a in wanted])


# -- rows as of a time ------------------------------------------------------


@query
def card_issuer(fraud):
    return fraud.card_now.frame().select("cc_num", "user_id", "issuer", "signup_timestamp")


@query
def card_issuer_history(fraud):
    return fraud.card.history(datetime(2024, 1, 5), datetime(2024, 1, 25))


@query
def sql_view_over50(fraud):
    return fraud.over_50.validate().frame()


@query
def asof_plain(fraud):
    done = fraud.card_now.historical(fraud.spine, "timestamp")
    return done.select("event_id", "user_id", "cc_num", "issuer")


@query
def asof_card_issuer(fraud):
    done = fraud.card.historical(fraud.spine, "timestamp", effective=True)
    return done.select("event_id", "user_id", "issuer", "effective_ts")


@query
def asof_order_ties(fraud):
    """Several orders of a customer on one day: the largest total stands for the day."""
    orders = read_table(fraud.spark, fraud.folder, "orders")
    table = FeatureTable(orders, "o_orderdate", ("o_totalprice", "o_orderstatus"), "latest_")
    customers = orders.select(
        "o_orderkey", "o_custkey", F.date_add("o_orderdate", 30).cast("timestamp").alias("asked")
    )
    return asof_join(customers, ["o_custkey"], "asked", [table])


@query
def score_at_fixed_now(fraud):
    service = Service.of("scoring", [fraud.card, fraud.amounts[["amt_sum_3d_10m"]]])
    scored = service.at(fraud.spine, datetime(2024, 1, 26, 12))
    return scored.select("event_id", *service.names)


@query
def view_contract_report(fraud):
    return fraud.card.contract_report()


# -- services ---------------------------------------------------------------


@query
def service_training(fraud):
    return fraud.service.historical(fraud.spine, "timestamp")


@query
def service_variant(fraud):
    service = fraud.small_service
    return service.historical(fraud.spine.drop("amt"), "timestamp")


@query
def service_effective_times(fraud):
    service = Service.of(
        "timed", [fraud.card, fraud.card_now[["issuer"]], fraud.txn_counts[["event_id_count_7d_1d"]]]
    )
    done = service.historical(fraud.spine, "timestamp", effective=True)
    times = [c for c in done.columns if c.endswith("__effective_ts")]
    return done.select("event_id", *service.names, *times)


def _on_demand(fraud: Fraud, mode: str) -> DataFrame:
    mean = fraud.amounts[["amt_mean_3d_10m"]]
    service = Service.of("check", [mean, fraud.amount_check(mode)]).validate()
    return service.historical(fraud.spine, "timestamp").select("event_id", *service.names)


@query
def on_demand_native(fraud):
    return _on_demand(fraud, "native")


@query
def on_demand_pandas(fraud):
    return _on_demand(fraud, "pandas")


@query
def on_demand_python(fraud):
    return _on_demand(fraud, "python")


@query
def on_demand_run(fraud):
    """The bare function on given inputs: each event's amount against its fraud flag."""
    limit = F.when(F.col("is_fraud") == 1, F.lit(75.0)).alias("amt_mean_3d_10m")
    inputs = fraud.spine.select(
        F.struct("event_id", "amt").alias("purchase"), F.struct(limit).alias("amounts")
    )
    return fraud.amount_check().run(inputs, "purchase.event_id")


# -- stored history ---------------------------------------------------------


def _stored(fraud: Fraud, view, jobs: int, until: datetime | None = None) -> Store:
    store = Store(fraud.spark, workdir(fraud.spark, "store"))
    first, last = fraud.days
    store.backfill(view, first, until or last, jobs)
    return store


@query
def from_source_parity(fraud):
    view = fraud.amounts
    store = _stored(fraud, view, 3)
    done = view.historical(fraud.spine, "timestamp", store=store)
    return keyed(done, view.features)


@query
def partly_loaded_store(fraud):
    """One stored day out of a month; the rest comes from the source."""
    store = Store(fraud.spark, workdir(fraud.spark, "store"))
    store.incremental(fraud.amounts, ONE_DAY)
    done = fraud.amounts.historical(fraud.spine, "timestamp", store=store)
    return keyed(done, fraud.amounts.features)


@query
def store_after_redeclaration(fraud):
    """A view stored under earlier declarations: another body, a later start, fewer aggregates.

    What was not stored, or was stored by something else, comes from the source.
    """
    view, (first, last) = fraud.amounts, fraud.days
    store = Store(fraud.spark, workdir(fraud.spark, "store"))

    def tenfold(transactions):
        return f"SELECT user_id, timestamp, amt * 10 AS amt FROM {transactions}"

    store.backfill(replace(view, body=tenfold), first, last, 1)
    store.backfill(replace(view, start=ONE_DAY), first, datetime(2024, 1, 25), 1)
    store.incremental(view[["amt_sum_1d_10m"]], datetime(2024, 1, 27))
    counted = (*view.aggregations, Aggregate("merchant", "distinct", DAY))

    def wider(transactions):
        return f"SELECT user_id, timestamp, amt, merchant FROM {transactions}"

    store.incremental(replace(view, body=wider, aggregations=counted), datetime(2024, 1, 20))
    done = view.historical(fraud.spine, "timestamp", store=store)
    return keyed(done, view.features)


@query
def store_compacted(fraud):
    """A range loaded again and again in overlapping pieces, then written anew in one."""
    view, (first, last) = fraud.amounts, fraud.days
    store = _stored(fraud, view, 2)
    for k in range(3):
        store.materialize(view, datetime(2024, 1, 10, 6 * k), datetime(2024, 1, 12, 6 * k))
    store.compact(view)
    done = view.historical(fraud.spine, "timestamp", store=store)
    return keyed(done, view.features)


@query
def hybrid_store_stream(fraud):
    """The daily load up to a day, the stream's tiles from there on, each interval from one of them."""
    view = _shuffled(fraud, fraud.amounts)
    tiles = workdir(fraud.spark, "tiles")
    finish(tile_stream(view, tiles))
    fold_tiles(fraud.spark, view, tiles)
    store = Store(fraud.spark, workdir(fraud.spark, "store"), beyond=StreamHistory(fraud.spark, {view.name: tiles}))
    store.backfill(view, fraud.days[0], ONE_DAY, 1)
    done = view.historical(fraud.spine, "timestamp", store=store)
    return keyed(done, view.features)


@query
def view_start_respected(fraud):
    """A view that starts at a day counts nothing from before it, stored or not."""
    view = replace(fraud.amounts, start=ONE_DAY)
    done = view.historical(fraud.spine, "timestamp")
    return keyed(done, view.features)


@query
def adhoc_from_source(fraud):
    """A service with nothing stored falls back to the sources."""
    service = Service.of("adhoc", [fraud.amounts])
    empty = Store(fraud.spark, workdir(fraud.spark, "store"))
    done = service.historical(fraud.spine, "timestamp", store=empty)
    return done.select("event_id", *service.names)


@query
def training_period(fraud):
    """One week of spine against a stored history, reading only the days that matter."""
    start, end = datetime(2024, 1, 20), datetime(2024, 1, 27)
    service = Service.of("week", [fraud.amounts[["amt_mean_3d_10m"]], fraud.card])
    store = _stored(fraud, fraud.amounts, 1)
    store.backfill(fraud.card, *fraud.days, 1)
    week = between(fraud.spine, "timestamp", start, end)
    done = service.historical(week, "timestamp", store=store, period=(start, end))
    return done.select("event_id", *service.names)


@query
def incremental_day(fraud):
    store = Store(fraud.spark, workdir(fraud.spark, "store"))
    store.incremental(fraud.amounts, ONE_DAY)
    tiles = store.tiles(fraud.amounts).merged
    start = bucket_start(F.col(AT), fraud.amounts.interval).alias("tile_start")
    return tiles.select("user_id", start, "n_amt", "s_amt")


@query
def coverage_report(fraud):
    """Transactions whose windows the stored tiles do not reach: a gap, and the last days."""
    view = fraud.hourly
    store = _stored(fraud, view, 1, until=datetime(2024, 1, 10))
    store.materialize(view, datetime(2024, 1, 12), datetime(2024, 1, 25))
    checked = coverage(fraud.spine, "timestamp", view.interval, store.loaded(view))
    return checked.filter(~F.col("covered")).select("event_id", "boundary")


@query
def partition_pruned_spine(fraud):
    path = f"{workdir(fraud.spark, 'partitioned')}/transactions"
    write_partitioned(fraud.spine, "timestamp", path)
    rows = on_day(read_partitioned(fraud.spark, path), ONE_DAY)
    return rows.select(
        "event_id", "user_id", "merchant", "timestamp", "amt", "partition_1", "partition_2"
    )


# -- lookups ----------------------------------------------------------------


def _requests(fraud: Fraud) -> DataFrame:
    return fraud.spine.select("event_id", "user_id", "amt")


@query
def latest_lookup(fraud):
    kept = fraud.amounts[["amt_mean_3d_10m", "amt_sum_1d_10m"]]
    service = Service.of("latest", [fraud.card, kept])
    return service.lookup(_requests(fraud), NOW, effective=True).drop("amounts__effective_ts")


@query
def latest_published(fraud):
    """The same requests, answered from published tables of latest values."""
    kept = fraud.amounts[["amt_mean_3d_10m", "amt_sum_1d_10m"]]
    service = Service.of("latest", [fraud.card, kept])
    store = Store(fraud.spark, workdir(fraud.spark, "store"))
    for view in (fraud.card, kept):
        store.publish(view, NOW, buckets=8)
    shots = {v.name: store.published(v, NOW, f"{v.name}__") for v in (fraud.card, kept)}
    found = service.lookup(_requests(fraud), NOW, snapshots=shots, effective=True)
    return found.drop("amounts__effective_ts")


@query
def latest_published_twice(fraud):
    """Values published two days apart: the second publish only adds and takes out what changed."""
    kept = fraud.amounts[["amt_mean_3d_10m", "amt_sum_1d_10m"]]
    service = Service.of("latest", [fraud.card, kept])
    store = Store(fraud.spark, workdir(fraud.spark, "store"))
    for view in (fraud.card, kept):
        for moment in (NOW - 2 * DAY, NOW):
            store.publish(view, moment)
    shots = {v.name: store.published(v, NOW, f"{v.name}__") for v in (fraud.card, kept)}
    found = service.lookup(_requests(fraud), NOW, snapshots=shots, effective=True)
    return found.drop("amounts__effective_ts")


@query
def latest_vector(fraud):
    """One array of names and values per request, shown as its parts."""
    found = Service.of("vector", [fraud.card]).lookup(_requests(fraud), NOW)
    packed = vector(found, ["card__issuer", "user_id"], ["event_id"])
    return packed.select("event_id", F.inline("features"))


@query
def on_demand_lookup(fraud):
    service = Service.of("ask", [fraud.amounts[["amt_mean_3d_10m"]], fraud.amount_check()])
    return service.lookup(_requests(fraud), NOW).select("event_id", *service.names)


@query
def lookup_parity(fraud):
    """Requests whose looked-up values differ from a training join at the same moment."""
    service = Service.of("both", [fraud.card, fraud.amounts, fraud.merchant_fraud, fraud.variety])
    requests = fraud.spine.select("event_id", "user_id", "merchant")
    moment = datetime(2024, 1, 29, 7, 3)
    values = F.hash(*[F.round(n, 6) if "_mean_" in n or "_sum_" in n else n for n in service.names])
    online = service.lookup(requests, moment).select("event_id", values.alias("online"))
    offline = service.at(requests, moment).select("event_id", values.alias("offline"))
    both = online.join(offline, "event_id", "full")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("online").eqNullSafe(F.col("offline"))).alias("n_mismatches"),
    )


@query
def latest_windows(fraud):
    """Every kind of aggregate per user as of one moment."""
    wanted = [
        Aggregate("merchant", "distinct", 7 * DAY),
        Aggregate("merchant", "last", 14 * DAY, 3),
        Aggregate("amt", "count", DAY),
        Aggregate("amt", "mean", 7 * DAY),
    ]
    tiles = build_tiles(fraud.txn, ["user_id"], "timestamp", wanted, HOUR)
    done = current_values(tiles, wanted, NOW).drop("effective_ts")
    listed = wanted[1].feature(HOUR)
    return done.withColumn(listed, F.array_join(listed, ","))


# -- streams ----------------------------------------------------------------


@query
def stream_tiles_5m(fraud):
    view = fraud.over_50_flags
    path = workdir(fraud.spark, "tiles")
    finish(tile_stream(view, path))
    tiles = stream_tiles(fraud.spark, view, path).merged
    start = bucket_start(F.col(AT), view.interval).alias("tile_start")
    return tiles.select("user_id", start, "n_over_50", "s_over_50")


def _shuffled(fraud: Fraud, view, files: int = 4):
    """The view over its events dealt into files at random, one file per micro-batch."""
    path = f"{workdir(fraud.spark, 'shuffled')}/events"
    fraud.txn.repartition(files, F.xxhash64("event_id")).write.parquet(path)
    schema = fraud.txn.schema
    stream = lambda: fraud.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    return replace(view, sources=(replace(fraud.txn_source, stream=stream),))


@query
def stream_tiles_shuffled(fraud):
    """Late events in every batch, and a fold before the last reading."""
    view = _shuffled(fraud, fraud.over_50_flags)
    path = workdir(fraud.spark, "tiles")
    finish(tile_stream(view, path))
    fold_tiles(fraud.spark, view, path)
    tiles = stream_tiles(fraud.spark, view, path).merged
    start = bucket_start(F.col(AT), view.interval).alias("tile_start")
    return tiles.select("user_id", start, "n_over_50", "s_over_50")


@query
def stream_latest_counts(fraud):
    """Latest values of an aggregating stream view at one moment."""
    view = _shuffled(fraud, fraud.amounts)
    path = workdir(fraud.spark, "tiles")
    finish(tile_stream(view, path))
    done = stream_current(fraud.spark, view, path, datetime(2024, 1, 20, 12))
    return done.select("user_id", *[F.round(c, 6).alias(c) for c in view.features])


@query
def stream_asof(fraud):
    """Values as of each transaction, finished from tiles a stream has written."""
    view = fraud.over_50_counts
    path = workdir(fraud.spark, "tiles")
    finish(tile_stream(view, path))
    tiles = stream_tiles(fraud.spark, view, path)
    done = aggregate_asof(fraud.spine, "timestamp", tiles, list(view.aggregations))
    return keyed(done, view.features)


@query
def stream_latest_card(fraud):
    view = fraud.card_now
    path = workdir(fraud.spark, "latest")
    finish(latest_stream(view, path))
    rows = stream_latest(fraud.spark, view, path)
    return rows.select("user_id", "signup_timestamp", "cc_num", "issuer")


@query
def stream_row_history(fraud):
    """A row-level stream appended to its history, then joined like any stored view."""
    view = fraud.card_now
    path = workdir(fraud.spark, "rows")
    finish(row_stream(view, path))
    rows = stream_rows(fraud.spark, view, path)
    done = asof_join(fraud.spine, list(view.keys), "timestamp", [view.table(rows)])
    return done.select("event_id", "user_id", "cc_num", "issuer")


@query
def service_from_stream(fraud):
    """A service whose views are read from what their streams have written."""
    tiled = _shuffled(fraud, fraud.amounts)
    tiles, rows = workdir(fraud.spark, "tiles"), workdir(fraud.spark, "rows")
    finish(tile_stream(tiled, tiles))
    finish(row_stream(fraud.card_now, rows))
    service = Service.of("streamed", [tiled, fraud.card_now])
    history = StreamHistory(fraud.spark, {tiled.name: tiles}, {fraud.card_now.name: rows})
    done = service.historical(fraud.spine, "timestamp", store=history)
    names = [F.round(n, 6).alias(n) if n.startswith(tiled.name) else F.col(n) for n in service.names]
    return done.select("event_id", *names)


@query
def stream_preview(fraud):
    shown = Preview(fraud.over_50.stream(), "over_50_preview")
    finish(shown.query)
    shown.table()
    return fraud.spark.sql("SELECT event_id, user_id, over_50, timestamp FROM over_50_preview")


# -- pushed events ----------------------------------------------------------


def _envelopes(fraud: Fraud) -> DataFrame:
    """One pushed envelope per event: a click and two user clicks; sign-ups are dry runs.

    The user of an error event cannot be parsed into the declared types.
    """
    event = fraud.events.withColumn("at", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    number = F.pmod("event_id", F.lit(5)).cast("string")
    clicked = F.when(F.col("event_type") == "error", F.lit("\"many\"")).otherwise(number)

    def record(*fields):
        text = F.concat(F.lit('{"record":{'), F.concat_ws(",", *fields), F.lit("}}"))
        return text

    def quoted(name, value):
        return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))

    time = quoted("timestamp", F.col("at"))
    click = record(
        time,
        quoted("content_keyword", F.col("event_type")),
        F.concat(F.lit('"clicked":'), number),
    )
    first = record(time, quoted("user_id", user), F.lit('"clicked":1'))
    second = record(time, quoted("user_id", user), F.concat(F.lit('"clicked":'), clicked))
    dry = F.when(F.col("event_type") == "signup", "true").otherwise("false")
    return event.select(
        F.concat(
            F.lit('{"workspace_name":"push","dry_run":'),
            dry,
            F.lit(',"records":{"clicks":['),
            click,
            F.lit('],"user_clicks":['),
            first,
            F.lit(","),
            second,
            F.lit("]}}"),
        ).alias("value")
    )


@query
def ingest_explode(fraud):
    """Accepted user clicks; the number of equal records stands for the records."""
    records = push.unpack(_envelopes(fraud))
    rows = push.accepted(records, "user_clicks", USER_CLICK)
    return rows.groupBy("timestamp", "user_id", "clicked").agg(F.count(F.lit(1)).alias("n"))


@query
def ingest_dry_run(fraud):
    records = push.unpack(_envelopes(fraud))
    return push.report(records, {"clicks": CLICK, "user_clicks": USER_CLICK})


@query
def ingest_rejects(fraud):
    """What an ingest keeps aside, by reason: bad records, unknown sources, broken envelopes."""
    good = _envelopes(fraud)
    broken = fraud.events.select(
        F.when(F.col("event_id") % 3 == 0, F.lit("{not json"))
        .when(F.col("event_id") % 3 == 1, F.lit('{"workspace_name": "w"}'))
        .otherwise(F.lit('{"records": {"elsewhere": [{"record": {"a": 1}}]}}'))
        .alias("value")
    )
    envelopes, schemas = good.unionByName(broken), {"clicks": CLICK, "user_clicks": USER_CLICK}
    path = workdir(fraud.spark, "ingest")
    for _ in range(2):  # a retry replaces what the run wrote
        push.ingest(envelopes, schemas, path, "0", required={"clicks": "timestamp", "user_clicks": "timestamp"})
    kept = [push.ingested(fraud.spark, path, s).select(F.lit(s).alias("kind")) for s in schemas]
    rejected, broken = (push.ingested(fraud.spark, path, n) for n in (push.REJECTED, push.MALFORMED))
    aside = [rejected.select(F.col("reason").alias("kind")), broken.select(F.lit("malformed").alias("kind"))]
    every = kept[0]
    for df in [*kept[1:], *aside]:
        every = every.unionByName(df)
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def string_times(fraud):
    """A time column that arrives as text, aggregated like any other."""
    as_text = zoneless(fraud.txn).withColumn("timestamp", F.date_format("timestamp", "dd.MM.yyyy HH:mm:ss.SSSSSS"))
    parsed = with_times(as_text, "dd.MM.yyyy HH:mm:ss.SSSSSS", "timestamp")
    view = replace(fraud.amounts, sources=(replace(fraud.txn_source, batch=parsed),))
    return keyed(view.historical(fraud.spine, "timestamp"), view.features)


@query
def stream_ingest_tiles(fraud):
    """Envelopes landed as text files, read as a stream, aggregated in hourly tiles."""
    spark, path = fraud.spark, workdir(fraud.spark, "pushed")
    _envelopes(fraud).write.text(f"{path}/landed")
    landed = push.unpack(spark.readStream.text(f"{path}/landed"))
    clicks = push.accepted(landed, "clicks", CLICK)
    batch = push.accepted(push.unpack(spark.read.text(f"{path}/landed")), "clicks", CLICK)
    view = _click_view(batch, clicks)
    finish(tile_stream(view, path))
    tiles = stream_tiles(spark, view, path).merged
    start = bucket_start(F.col(AT), view.interval).alias("tile_start")
    return tiles.select("content_keyword", start, "n_clicked", "s_clicked")


def _click_view(batch: DataFrame, stream: DataFrame):
    @stream_view(
        source=Source("clicks", batch, "timestamp", stream),
        keys=["content_keyword"],
        ts="timestamp",
        interval=HOUR,
        aggregations=[Aggregate("clicked", "count", DAY), Aggregate("clicked", "sum", DAY)],
    )
    def click_counts(clicks):
        return f"SELECT content_keyword, timestamp, clicked FROM {clicks}"

    return click_counts


# -- export -----------------------------------------------------------------


@query
def export_csv_row(fraud):
    return csv_lines(fraud.spine, ["user_id", "merchant", "is_fraud"], ["event_id"])


@query
def export_joined_row(fraud):
    columns = [F.col(c) for c in ("user_id", "merchant", "is_fraud")]
    return fraud.spine.select("event_id", joined(columns, "|").alias("line"))


@query
def export_json_row(fraud):
    return json_lines(fraud.spine, ["user_id", "merchant", "is_fraud"], ["event_id"])


@query
def export_csv_files(fraud):
    """Vectors written with a header and read back by name."""
    rows = zoneless(fraud.spine.select("event_id", "merchant", "amt", "timestamp"))
    path = f"{workdir(fraud.spark, 'export')}/vectors"
    write_csv(rows, path, header=True)
    return read_csv(fraud.spark, path, rows.schema, header=True)


def entry(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["flagship_over50_counts"](configure(spark), folder)
