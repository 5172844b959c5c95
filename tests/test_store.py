from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from help import DAY, EVENT, HOUR, MINUTE, plain, random_events

from tidemark.functions.aggregates import Aggregate
from tidemark.plans.service import Service
from tidemark.plans.store import Store, slices
from tidemark.plans.views import batch_view, stream_view
from tidemark.sources.tables import Source

FIRST, LAST = datetime(2024, 1, 1), datetime(2024, 1, 6)
SPINE = "id int, k string, t timestamp"


@pytest.fixture(scope="module")
def source(spark):
    events = random_events(500, 1, minutes=5 * 24 * 60)
    return Source("events", spark.createDataFrame(events, EVENT), "t", filtered=True)


@pytest.fixture(scope="module")
def spine(spark):
    rows = random_events(120, 2, minutes=5 * 24 * 60)
    return spark.createDataFrame([(i, k, t) for i, (k, t, _, _) in enumerate(rows)], SPINE)


def row_view(source):
    @batch_view(sources=[source], keys=["k"], ts="t", schedule=DAY)
    def rows(events):
        return f"SELECT k, t, v FROM {events}"

    return rows


def mixed_view(source):
    @stream_view(
        source=source,
        keys=["k"],
        ts="t",
        interval=30 * MINUTE,
        aggregations=[
            Aggregate("v", "sum", DAY),
            Aggregate("v", "mean", 3 * HOUR),
            Aggregate("s", "distinct", 2 * DAY),
            Aggregate("s", "last", DAY, 3),
        ],
    )
    def mixed(events):
        return f"SELECT k, t, v, s FROM {events}"

    return mixed


def test_slices_are_aligned_and_cover_the_range():
    start, end = datetime(2016, 12, 31, 5), datetime(2023, 4, 6, 7)
    cut = slices(start, end, 10)
    assert len(cut) == 10
    assert cut[0][0] == datetime(2016, 12, 31) and cut[-1][1] == datetime(2023, 4, 7)
    assert all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
    assert slices(FIRST, FIRST + DAY, 10) == [(FIRST, FIRST + DAY)]


def live_view(source):
    @stream_view(
        source=source,
        keys=["k"],
        ts="t",
        aggregations=[Aggregate("v", "mean", 3 * HOUR), Aggregate("s", "distinct", DAY)],
    )
    def live(events):
        return f"SELECT k, t, v, s FROM {events}"

    return live


@pytest.mark.parametrize("make", [row_view, mixed_view, live_view])
def test_stored_equals_computed_for_any_number_of_jobs(spark, source, spine, make, tmp_path):
    view = make(source)
    service = Service.of("s", [view])
    want = plain(service.historical(spine, "t"))
    for jobs in (1, 5):
        store = Store(spark, str(tmp_path / str(jobs)))
        assert not store.has(view)
        store.backfill(view, FIRST, LAST, jobs)
        assert store.has(view) and store.loaded_until(view) == LAST
        assert plain(service.historical(spine, "t", store=store)) == want


def test_running_a_slice_again_changes_nothing(spark, source, tmp_path):
    view = mixed_view(source)
    store = Store(spark, str(tmp_path))
    store.backfill(view, FIRST, LAST, 2)
    before = {n: plain(p) for n, p in store.tiles(view).parts().items()}
    store.materialize(view, FIRST + DAY, FIRST + 2 * DAY)
    store.incremental(view, FIRST + 3 * DAY)
    assert {n: plain(p) for n, p in store.tiles(view).parts().items()} == before


def test_a_range_must_lie_on_intervals(spark, source, tmp_path):
    store = Store(spark, str(tmp_path))
    for end in (FIRST + 30 * HOUR + MINUTE, FIRST):
        with pytest.raises(ValueError):
            store.materialize(mixed_view(source), FIRST, end)


@pytest.mark.parametrize("make", [row_view, mixed_view, live_view])
def test_what_is_not_loaded_comes_from_the_source(spark, source, spine, make, tmp_path):
    view = make(source)
    want = plain(view.historical(spine, "t"))
    store = Store(spark, str(tmp_path))
    store.materialize(view, FIRST + DAY, FIRST + 2 * DAY)
    store.materialize(view, FIRST + 3 * DAY, FIRST + 3 * DAY + 6 * HOUR)
    assert store.loaded_until(view) == FIRST + 2 * DAY
    assert store.gaps(view, FIRST, LAST) == [
        (FIRST, FIRST + DAY), (FIRST + 2 * DAY, FIRST + 3 * DAY), (FIRST + 3 * DAY + 6 * HOUR, LAST)
    ]
    assert store.gaps(view, FIRST + DAY, FIRST + 2 * DAY) == []
    assert plain(view.historical(spine, "t", store=store)) == want
    some = spine.filter(f"t >= '{FIRST + DAY}' AND t < '{FIRST + 4 * DAY}'")
    part = view.historical(some, "t", store=store, period=(FIRST + DAY, FIRST + 4 * DAY))
    assert plain(part) == plain(view.historical(some, "t"))


@pytest.mark.parametrize("make", [row_view, mixed_view])
def test_a_job_replaces_its_range_also_with_nothing(spark, source, make, tmp_path):
    store, view = Store(spark, str(tmp_path)), make(source)
    store.backfill(view, FIRST, LAST, 1)
    low, high = FIRST + DAY, FIRST + DAY + 12 * HOUR
    fewer = Source("events", source.batch.filter(f"t < '{low}' OR t >= '{high}'"), "t", filtered=True)
    store.materialize(make(fewer), low, high)
    assert plain(make(fewer).historical(spark.createDataFrame([(0, "hot", LAST)], SPINE), "t", store=store)) == plain(
        make(fewer).historical(spark.createDataFrame([(0, "hot", LAST)], SPINE), "t")
    )
    if make is mixed_view:
        assert plain(store.tiles(view).merged) == plain(make(fewer).tiles(FIRST, LAST).merged)


def test_a_loaded_range_without_rows(spark, source, tmp_path):
    store = Store(spark, str(tmp_path))
    later = FIRST + 300 * DAY
    for view in (row_view(source), mixed_view(source)):
        store.materialize(view, later, later + DAY)
        spine = spark.createDataFrame([(0, "hot", later + HOUR)], SPINE)
        got = view.historical(spine, "t", store=store, period=(later, later + DAY))
        assert plain(got) == plain(view.historical(spine, "t", period=(later, later + DAY)))


def test_a_store_refuses_another_shape(spark, source, tmp_path):
    store, view = Store(spark, str(tmp_path)), mixed_view(source)
    store.materialize(view, FIRST, FIRST + DAY)
    with pytest.raises(ValueError, match="store it anew"):
        store.has(replace(view, interval=HOUR))


def test_a_period_in_another_zone(spark, source, tmp_path):
    store, view = Store(spark, str(tmp_path)), row_view(source)
    store.backfill(view, FIRST, LAST, 1)
    zone = timezone(timedelta(hours=14))
    start, end = (FIRST + 2 * DAY), (FIRST + 3 * DAY)
    shifted = tuple((m.replace(tzinfo=timezone.utc)).astimezone(zone) for m in (start, end))
    assert plain(store.rows(view, *shifted)) == plain(store.rows(view, start, end))
    assert store.rows(view, *shifted).count()


def test_several_windows_emitted_on_one_day(spark, source, tmp_path):
    view = mixed_view(source)
    store = Store(spark, str(tmp_path))
    moments = [FIRST + 2 * DAY + k * HOUR for k in range(3)]
    for moment in moments:
        store.emit_window(view, moment)
    assert plain(store.finished(view)) == [r for r in plain(view.run()) if r[1] in moments]


@pytest.mark.parametrize("every", [HOUR, 2 * DAY])
def test_incremental_runs_of_any_period(spark, source, tmp_path, every):
    @batch_view(sources=[source], keys=["k"], ts="t", schedule=every, aggregations=[Aggregate("v", "sum", 4 * every)])
    def view(events):
        return f"SELECT k, t, v FROM {events}"

    store, first = Store(spark, str(tmp_path)), FIRST + DAY  # a boundary of two days too
    for k in range(2):
        store.incremental(view, first + k * every)
    assert store.loaded(view) == [(first, first + 2 * every)]
    assert plain(store.tiles(view).merged) == plain(view.tiles(first, first + 2 * every).merged)


@pytest.mark.parametrize("filtered", [True, False])
def test_nothing_before_the_start_of_a_view_counts(spark, source, spine, filtered):
    start = FIRST + 2 * DAY
    view = replace(mixed_view(replace(source, filtered=filtered)), start=start)
    late = Source("events", source.batch.filter(f"t >= '{start}'"), "t", filtered=True)
    want = plain(mixed_view(late).historical(spine, "t"))
    assert plain(view.historical(spine, "t")) == want
    assert plain(view.historical(spine, "t", period=(FIRST - DAY, LAST + DAY))) == want


def test_emitted_window_equals_the_listing(spark, source, tmp_path):
    view = mixed_view(source)
    store = Store(spark, str(tmp_path))
    moments = [FIRST + 2 * DAY, FIRST + 3 * DAY]
    for moment in moments + moments[:1]:
        store.emit_window(view, moment)
    listed = [r for r in plain(view.run()) if r[1] in moments]
    assert plain(store.finished(view)) == listed


def test_a_period_reads_less_and_answers_the_same(spark, source, spine, tmp_path):
    start, end = FIRST + 3 * DAY, FIRST + 4 * DAY
    some = spine.filter(f"t >= '{start}' AND t < '{end}'")
    service = Service.of("s", [row_view(source), mixed_view(source)])
    want = plain(service.historical(some, "t"))
    assert want
    store = Store(spark, str(tmp_path))
    for view in service.features:
        store.backfill(view, FIRST, LAST, 1)
        alone = view.historical(some, "t", period=(start, end))
        assert plain(alone) == plain(view.historical(some, "t"))
    assert plain(service.historical(some, "t", period=(start, end))) == want
    assert plain(service.historical(some, "t", store=store, period=(start, end))) == want
    pruned = store.tiles(mixed_view(source), start, end).merged
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="outside"):
        service.historical(spine, "t", period=(start, end)).collect()


def test_load_mark_of_nothing(spark, source, tmp_path):
    assert Store(spark, str(tmp_path)).loaded_until(row_view(source)) is None


def test_schedule_longer_than_a_day(spark, source, tmp_path):
    @batch_view(
        sources=[source],
        keys=["k"],
        ts="t",
        schedule=timedelta(days=2),
        aggregations=[Aggregate("v", "count", timedelta(days=4))],
    )
    def slow(events):
        return f"SELECT k, t, v FROM {events}"

    store = Store(spark, str(tmp_path))
    store.backfill(slow, FIRST, LAST, 3)
    assert plain(store.tiles(slow).merged) == plain(slow.tiles().merged)


def test_lookups_read_published_values(spark, source, tmp_path):
    store, moment = Store(spark, str(tmp_path)), FIRST + 3 * DAY
    requests = spark.createDataFrame([(0, "hot"), (1, "k1"), (2, "none")], "id int, k string")
    service = Service.of("s", [row_view(source), mixed_view(source)])
    want = plain(service.lookup(requests, moment, effective=True))
    for view in service.features:
        for at_ in (FIRST + DAY, moment):
            store.publish(view, at_)
    shots = {v.name: store.published(v, moment, f"{v.name}__") for v in service.features}
    found = service.lookup(requests, moment, snapshots=shots, effective=True)
    assert plain(found) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "ExistingRDD[k" not in plan.replace("ExistingRDD[id", "")
    with pytest.raises(ValueError, match="nothing published"):
        store.published(row_view(source), FIRST)


# -- declarations that changed ------------------------------------------------


def wide_view(source, factor=1, **changes):
    @stream_view(
        source=source, keys=["k"], ts="t", interval=30 * MINUTE, aggregations=[Aggregate("v", "sum", DAY)],
    )
    def wide(events):
        return f"SELECT k, t, v * {factor} AS v, s FROM {events}"

    return replace(wide, **changes)


def frame_view(source, factor):
    @batch_view(sources=[source], keys=["k"], ts="t", schedule=DAY, mode="frame")
    def framed(events):
        return events.select("k", "t", (events["v"] * factor).alias("v"))

    return framed


def unequal(a, b):
    return a != b


MORE = (Aggregate("v", "sum", DAY), Aggregate("s", "distinct", DAY), Aggregate("s", "count", DAY), Aggregate("v", "max", DAY))


@pytest.mark.parametrize(
    "change",
    [
        {"aggregations": MORE},
        {"factor": 10},
        {"start": None, "before": {"start": FIRST + 2 * DAY + 10 * MINUTE}},
        {"start": FIRST + 2 * DAY + 10 * MINUTE},
        {"start": FIRST + 3 * DAY, "before": {"start": FIRST + DAY}},
    ],
)
def test_what_was_stored_under_another_declaration(spark, source, spine, change, tmp_path):
    """Never an answer from what was not stored: what is missing comes from the source."""
    change = dict(change)
    before, now = wide_view(source, **change.pop("before", {})), wide_view(source, **change)
    store = Store(spark, str(tmp_path))
    store.backfill(before, FIRST, LAST, 2)
    want = plain(now.historical(spine, "t"))
    assert unequal(want, plain(before.historical(spine, "t")))
    assert plain(now.historical(spine, "t", store=store)) == want
    # and the earlier declaration still finds all of its own
    assert store.loaded(before) == [(FIRST, LAST)]
    store.materialize(now, FIRST + DAY, FIRST + 2 * DAY)
    assert plain(now.historical(spine, "t", store=store)) == want
    assert plain(before.historical(spine, "t", store=store)) == plain(before.historical(spine, "t"))


def test_rows_with_another_column_or_other_code(spark, source, spine, tmp_path):
    store, view = Store(spark, str(tmp_path)), row_view(source)
    store.backfill(view, FIRST, LAST, 1)

    @batch_view(sources=[source], keys=["k"], ts="t", schedule=DAY)
    def rows(events):
        return f"SELECT k, t, v, s FROM {events}"

    assert not store.has(rows)
    assert plain(rows.historical(spine, "t", store=store)) == plain(rows.historical(spine, "t"))
    store.backfill(frame_view(source, 1), FIRST, LAST, 1)
    assert store.has(frame_view(source, 1)) and not store.has(frame_view(source, 2))
    tenfold = frame_view(source, 10)
    assert plain(tenfold.historical(spine, "t", store=store)) == plain(tenfold.historical(spine, "t"))


def test_a_layout_can_be_stored_anew(spark, source, spine, tmp_path):
    store, view = Store(spark, str(tmp_path)), mixed_view(source)
    store.backfill(view, FIRST, LAST, 1)
    other = replace(view, interval=HOUR, aggregations=view.aggregations[:2])
    store.backfill(other, FIRST, LAST, 1)
    for v in (view, other):
        assert store.loaded(v) == [(FIRST, LAST)]
        assert plain(v.historical(spine, "t", store=store)) == plain(v.historical(spine, "t"))


def test_finished_windows_of_another_declaration_are_not_shown(spark, source, tmp_path):
    store = Store(spark, str(tmp_path))
    store.emit_window(wide_view(source, 10), FIRST + 2 * DAY)
    store.emit_window(wide_view(source), FIRST + 2 * DAY)
    assert plain(store.finished(wide_view(source))) == [r for r in plain(wide_view(source).run()) if r[1] == FIRST + 2 * DAY]


def test_many_runs_leave_one_job_to_name(spark, source, tmp_path):
    store, view = Store(spark, str(tmp_path)), row_view(source)
    for _ in range(12):
        store.materialize(view, FIRST, FIRST + 2 * DAY)
    plan = store.rows(view)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_run") and " OR " not in plan
    store.materialize(view, FIRST + DAY, FIRST + 3 * DAY)
    other = frame_view(source, 3)
    store.materialize(replace(other, name="rows"), FIRST, FIRST + DAY)
    want = plain(store.rows(view))
    # what a job that died left behind
    spark.range(3).selectExpr("'x' AS k", "timestamp'2024-01-01 01:00:00' AS t", "1D AS v").withColumns(
        {"day": F.lit("2024-01-01"), "_run": F.lit(5)}
    ).write.partitionBy("day", "_run").mode("append").parquet(f"{tmp_path}/rows/rows")
    assert plain(store.rows(view)) == want
    store.compact(view)
    assert plain(store.rows(view)) == want
    assert store.loaded(view) == [(FIRST, FIRST + 3 * DAY)]
    plan = store.rows(view)._jdf.queryExecution().executedPlan().toString()
    assert " OR " not in plan
    # of the first day the rewritten job, and the one of the other code; of the others one each
    folders = sorted(p.parent.name for p in (tmp_path / "rows" / "rows").glob("day=*/_run=*"))
    assert folders == ["day=2024-01-01", "day=2024-01-01", "day=2024-01-02", "day=2024-01-03"]
    assert len(list((tmp_path / "rows" / "loaded").glob("*.parquet"))) == 3
    assert plain(store.rows(replace(other, name="rows"))) == plain(other.frame().filter(f"t < '{FIRST + DAY}'"))
    store.compact(view)
    assert plain(store.rows(view)) == want


# -- published values that are carried forward --------------------------------

ALL_KINDS = (
    Aggregate("v", "count", 6 * HOUR), Aggregate("v", "sum", DAY), Aggregate("v", "mean", 2 * DAY), Aggregate("s", "count", DAY),
    Aggregate("s", "distinct", DAY), Aggregate("s", "distinct", 6 * HOUR), Aggregate("s", "last", DAY, 3), Aggregate("s", "last_distinct", DAY, 3),
    Aggregate("v", "min", DAY), Aggregate("v", "max", 6 * HOUR), Aggregate("s", "approx_distinct", DAY),
)


class Watched(Store):
    """A store that notes which ranges are asked for."""

    def __init__(self, *args):
        super().__init__(*args)
        self.asked = []

    def rows_or_computed(self, view, start, end, days=None):
        self.asked.append((start, end))
        return super().rows_or_computed(view, start, end, days)

    def tiles_or_computed(self, view, start, end, days=None):
        self.asked.append((start, end))
        return super().tiles_or_computed(view, start, end, days)


def current(store, view, moment):
    frame = store.published(view, moment).frame
    return plain(frame.select(*view.keys, *view.features))


@pytest.mark.parametrize("some", [ALL_KINDS, ALL_KINDS[:4]])
def test_published_windows_move_on(spark, source, tmp_path, some):
    view = replace(mixed_view(source), aggregations=some)
    store, fresh = Watched(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    for hours in (30, 31, 37, 37, 90):  # a short step, one past a window, none, one past all windows
        moment = FIRST + hours * HOUR + 10 * MINUTE
        store.asked.clear()
        store.publish(view, moment)
        fresh.publish(view, moment, anew=True)
        assert current(store, view, moment) == current(fresh, view, moment)
        want = view.snapshot(moment).frame.select("k", *view.features)
        assert current(store, view, moment) == plain(want)
        if hours == 31 and some == ALL_KINDS[:4]:
            # what arrived, and what left each of the windows
            ends = sorted({(a, b) for a, b in store.asked})
            assert all(b - a == HOUR for a, b in ends) and len(ends) == 4


def test_published_rows_move_on(spark, source, tmp_path):
    for view in (row_view(source), replace(row_view(source), schedule=None)):
        store = Watched(spark, str(tmp_path / str(view.schedule)))
        for moment in (FIRST + DAY, FIRST + 2 * DAY + 5 * HOUR, FIRST + 2 * DAY + 6 * HOUR, FIRST + 4 * DAY):
            store.asked.clear()
            store.publish(view, moment)
            assert current(store, view, moment) == plain(view.snapshot(moment).frame.select("k", "v"))
            if moment != FIRST + DAY:
                ((low, _),) = store.asked
                assert low >= FIRST + DAY


def test_a_range_that_is_loaded_again_is_published_anew(spark, source, tmp_path):
    store, view = Watched(spark, str(tmp_path)), wide_view(source)
    fewer = Source("events", source.batch.filter(f"t < '{FIRST + DAY}'"), "t", filtered=True)
    store.backfill(wide_view(fewer), FIRST, FIRST + 2 * DAY, 1)
    store.publish(view, FIRST + 2 * DAY)
    store.backfill(view, FIRST, FIRST + 3 * DAY, 1)
    store.publish(view, FIRST + 2 * DAY + HOUR)
    assert current(store, view, FIRST + 3 * DAY) == plain(view.snapshot(FIRST + 2 * DAY + HOUR).frame.select("k", *view.features))
    # another body has nothing published
    with pytest.raises(ValueError, match="nothing published"):
        store.published(wide_view(source, 10), LAST)


def test_the_digest_follows_what_a_body_does(source):
    from tidemark.plans.declared import body_digest

    assert body_digest(wide_view(source)) == body_digest(wide_view(source))
    assert body_digest(wide_view(source)) != body_digest(wide_view(source, 2))
    assert body_digest(frame_view(source, 2)) == body_digest(frame_view(source, 2))
    assert body_digest(frame_view(source, 2)) != body_digest(frame_view(source, 3))
    assert body_digest(wide_view(source)) != body_digest(wide_view(replace(source, filtered=False)))


def test_lookups_take_what_the_store_has_published(spark, source, tmp_path):
    """By itself, and only values as of the moment, or as old as the caller allows."""
    store, moment = Store(spark, str(tmp_path)), FIRST + 3 * DAY + 10 * MINUTE
    requests = spark.createDataFrame([(0, "hot"), (1, "k1"), (2, "none"), (3, None)], "id int, k string")
    service = Service.of("s", [row_view(source), mixed_view(source)])
    for view in service.features:
        store.publish(view, moment)
    want = plain(service.lookup(requests, moment, effective=True))

    def reads_published(df):
        return sorted({f.split("/latest/")[0].rsplit("/", 1)[1] for f in df.inputFiles() if "/latest/" in f})

    found = service.lookup(requests, moment, store=store, effective=True)
    assert plain(found) == want and reads_published(found) == ["mixed", "rows"]
    # within the same interval tiles have not changed, rows may have
    later = service.lookup(requests, moment + 5 * MINUTE, store=store)
    assert plain(later) == plain(service.lookup(requests, moment + 5 * MINUTE)) and reads_published(later) == ["mixed"]
    old = service.lookup(requests, moment + HOUR, store=store, stale=HOUR)
    assert plain(old) == plain(service.lookup(requests, moment)) and reads_published(old) == ["mixed", "rows"]


def test_requests_are_joined_once_per_key_set(spark, source):
    requests = spark.createDataFrame([(i, "hot", f"wide{i}") for i in range(50)], "id int, k string, w string")
    found = Service.of("s", [row_view(source), mixed_view(source)]).lookup(requests, LAST)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) >= 2 and found.count() == 50
    wide = [line for line in plan.splitlines() if "LogicalRDD" in line and "w#" in line]
    assert len(wide) <= 2


def test_the_times_of_a_spine_prune_the_store_by_themselves(spark, source, spine, tmp_path):
    """Without a period, only days that some row of the spine can see are opened."""
    store, aged = Store(spark, str(tmp_path)), replace(row_view(source), ttl=DAY)
    some = spine.filter(f"t >= '{FIRST + 4 * DAY}'")
    service = Service.of("s", [aged, mixed_view(source)])
    want = plain(service.historical(some, "t"))
    for view in service.features:
        store.backfill(view, FIRST, LAST, 1)
        done = view.historical(some, "t", store=store)
        assert plain(done) == plain(view.historical(some, "t"))
        assert "dynamicpruning" in done._jdf.queryExecution().executedPlan().toString()
    assert plain(service.historical(some, "t", store=store)) == want
    # without an age limit all earlier rows can matter
    endless = row_view(source)
    assert "dynamicpruning" not in endless.historical(some, "t", store=store)._jdf.queryExecution().executedPlan().toString()
    assert plain(service.historical(spine.filter("false"), "t", store=store)) == []


def test_bucketed_tables_are_not_shuffled(spark, source, tmp_path):
    """Two published tables of one key set meet the requests without an exchange of their own."""
    store, moment = Store(spark, str(tmp_path)), FIRST + 3 * DAY
    requests = spark.createDataFrame([(i, k) for i, k in enumerate(["hot", "k1", "none", None])], "id int, k string")
    service = Service.of("s", [row_view(source), wide_view(source)])
    want = plain(service.lookup(requests, moment))
    for at_ in (FIRST + DAY, moment):
        for view in service.features:
            store.publish(view, at_, buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = service.lookup(requests, moment, store=store)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plain(found) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    assert len(scans) == 2 and all("Bucketed: true" in lines[i] for i in scans)
    for i in scans:
        above, depth = [], len(lines[i]) - len(lines[i].lstrip(" :+-"))
        for line in reversed(lines[:i]):
            indent = len(line) - len(line.lstrip(" :+-"))
            if indent < depth:
                above.append(line)
                depth = indent
        until = next(j for j, line in enumerate(above) if "Join" in line)
        assert not any("Exchange" in line for line in above[:until])
    assert spark.catalog.listTables() == [] or all("published_" not in t.name for t in spark.catalog.listTables())
