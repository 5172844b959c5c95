from __future__ import annotations

from datetime import datetime

import pandas as pd
import pytest
from help import DAY, EVENT, HOUR, MINUTE, T0, at, plain, random_events
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.aggregates import Aggregate
from tidemark.functions.scalar import card_issuer, flag_above, joined, or_zero
from tidemark.operators.ondemand import on_demand
from tidemark.plans.service import Service, on_demand_historical
from tidemark.plans.views import batch_view, coverage, stream_view
from tidemark.sources.spine import Request, spine_of
from tidemark.sources.tables import (
    Source,
    on_day,
    read_partitioned,
    utc,
    write_partitioned,
    zoneless,
)

SPINE = "id int, k string, m string, t timestamp, amt double"


@pytest.fixture(scope="module")
def source(spark):
    df = spark.createDataFrame(random_events(200, 1), EVENT).withColumn("m", F.col("s"))
    return Source("events", df, "t", filtered=True)


def row_view(source, **options):
    @batch_view(sources=[source], keys=["k"], ts="t", schedule=HOUR, **options)
    def rows(events):
        return f"SELECT k, t, v, s, v > 50 AS high FROM {events} WHERE v IS NOT NULL"

    return rows


def sum_view(source, **options):
    @stream_view(
        source=source,
        keys=["k"],
        ts="t",
        interval=5 * MINUTE,
        aggregations=[Aggregate("v", f, w) for f in ("sum", "mean") for w in (15 * MINUTE, HOUR)],
        **options,
    )
    def sums(events):
        return f"SELECT k, t, v FROM {events}"

    return sums


def store_view(source):
    @batch_view(
        sources=[source],
        keys=["m"],
        ts="t",
        schedule=DAY,
        mode="frame",
        aggregations=[Aggregate("v", "count", DAY)],
    )
    def stores(events):
        return events.select("m", "t", "v")

    return stores


def hours(source):
    @stream_view(
        source=source, keys=["k"], ts="t", interval=HOUR, aggregations=[Aggregate("v", "count", 3 * HOUR)]
    )
    def hours(events):
        return f"SELECT k, t, v FROM {events}"

    return hours


def minutes_21(source):
    @stream_view(
        source=source,
        keys=["k"],
        ts="t",
        interval=21 * MINUTE,
        aggregations=[Aggregate("v", "sum", 42 * MINUTE)],
    )
    def minutes_21(events):
        return f"SELECT k, t, v FROM {events}"

    return minutes_21


def check_mode(source, mode):
    amounts = sum_view(source)[["v_mean_1h_5m"]]
    request = Request.of("purchase", "amt double")

    def native(purchase, sums):
        return {"above": purchase["amt"] > or_zero(sums["v_mean_1h_5m"])}

    def pandas(purchase, sums):
        return pd.DataFrame({"above": purchase["amt"] > sums["v_mean_1h_5m"].fillna(0)})

    def python(purchase, sums):
        return {"above": purchase["amt"] > (sums["v_mean_1h_5m"] or 0)}

    body = {"native": native, "pandas": pandas, "python": python}[mode]
    return on_demand(inputs=[request, amounts], mode=mode, schema="above boolean")(body)


def spine_rows(n=60):
    rows = random_events(n, 9)
    return [
        {"id": i, "k": k, "m": s, "t": t, "amt": i % 100} for i, (k, t, _, s) in enumerate(rows)
    ]


def test_features_subsets_and_unknown_names(source):
    view = row_view(source)
    assert view.features == ["v", "s", "high"]
    assert view[["high"]].features == ["high"]
    sums = sum_view(source)
    assert sums.features == ["v_sum_15m_5m", "v_sum_1h_5m", "v_mean_15m_5m", "v_mean_1h_5m"]
    assert len(sums["v_sum_1h_5m"].aggregations) == 1
    with pytest.raises(KeyError):
        sums[["v_sum_2h_5m"]]


def test_validate_finds_broken_declarations(source):
    row_view(source).validate()
    for keys, ts, text in [
        (["nope"], "t", "SELECT k, t, v FROM {events}"),
        (["k"], "v", "SELECT k, t, v FROM {events}"),
        (["k"], "t", "SELECT k, t FROM {events}"),
    ]:
        declare = batch_view(sources=[source], keys=keys, ts=ts, schedule=DAY)
        with pytest.raises(ValueError):
            declare(lambda events, text=text: text).validate()
    words = stream_view(
        source=source, keys=["k"], ts="t", interval=HOUR, aggregations=[Aggregate("s", "sum", DAY)]
    )
    with pytest.raises(ValueError):
        words(lambda events: f"SELECT k, t, s FROM {events}").validate()


def test_contract_report_counts_gaps(spark, source):
    view = row_view(Source("events", source.batch, "t"))
    row = view.contract_report().first()
    kept = source.batch.filter("v IS NOT NULL")
    assert row.n_rows == kept.count()
    assert row.null_k == kept.filter("k IS NULL").count()
    assert row.null_t == kept.filter("t IS NULL").count()


def test_time_range_of_a_filtered_source_is_half_open(spark):
    df = spark.createDataFrame([("a", at(m), 1.0, "x") for m in (0, 5, 10)], EVENT)
    read = Source("e", df, "t").filter_by_time().read(at(0), at(10))
    assert sorted(r.t for r in zoneless(read).collect()) == [at(0), at(5)]
    assert Source("e", df, "t").read(at(0), at(10)).count() == 3
    with pytest.raises(ValueError):
        Source("e", df).filter_by_time()


def test_history_without_a_spine(source):
    view = row_view(source)
    rows = zoneless(view.history(at(100), at(200))).collect()
    assert rows and all(at(100) <= r.t < at(200) for r in rows)
    for r in rows:
        assert r.effective_ts == T0 + ((r.t - T0) // HOUR + 1) * HOUR


def test_run_widens_and_flags_complete_windows(source):
    view = sum_view(source)
    start, end = at(120), at(180)
    wide = view.run(start, end, complete=True)
    assert {r.window_complete_v_sum_1h_5m for r in wide.collect()} == {True}
    every = {r for r in plain(view.run()) if start <= r[1] < end}
    assert set(plain(view.run(start, end))) == every
    cut = zoneless(view.run(start, end, widen=False, complete=True)).collect()
    for r in cut:
        assert r.window_complete_v_sum_1h_5m == (r.window_end - HOUR >= start)
        assert r.window_complete_v_sum_15m_5m == (r.window_end - 15 * MINUTE >= start)


def test_start_of_a_view_limits_what_it_reads(source):
    view = row_view(source, start=at(300))
    assert view.frame().filter(F.col("t") < F.lit("2024-01-01 05:00:00")).count() == 0


def test_bare_names_for_a_view_prefixed_names_for_a_service(spark, source):
    spine = spine_of(spark, spine_rows(), SPINE)
    alone = sum_view(source).historical(spine, "t")
    assert alone.columns == [*spine.columns, *sum_view(source).features]
    service = Service.of("one", [row_view(source)[["high"]], sum_view(source)["v_sum_1h_5m"]])
    done = service.validate().historical(spine, "t")
    assert done.columns == [*spine.columns, "rows__high", "sums__v_sum_1h_5m"]
    assert done.count() == spine.count()


def test_a_feature_may_not_replace_a_spine_column(spark, source):
    spine = spine_of(spark, spine_rows(), SPINE).withColumn("high", F.lit(1))
    with pytest.raises(ValueError, match="already has"):
        row_view(source).historical(spine, "t")
    done = Service.of("s", [row_view(source)]).historical(spine, "t")
    assert {"high", "rows__high"} <= set(done.columns)


def test_service_joins_views_with_different_keys(spark, source):
    spine = spine_of(spark, spine_rows(), SPINE)
    parts = [row_view(source), sum_view(source), store_view(source)]
    service = Service.of("all", parts)
    assert service.join_keys == ["k", "m"]
    together = {r.id: r for r in service.historical(spine, "t").collect()}
    for view in parts:
        for r in view.historical(spine, "t").collect():
            for f in view.features:
                assert r[f] == together[r.id][f"{view.name}__{f}"]


def test_service_variants_need_less(spark, source):
    base = Service.of("fraud", [sum_view(source), check_mode(source, "native")])
    assert base.request_columns == ["amt"]
    lean = base.variant("v3", [sum_view(source)[["v_sum_1h_5m"]]])
    assert (lean.name, lean.request_columns) == ("fraud:v3", [])
    more = Service.of("more", [*base.features, store_view(source)])
    assert more.names[-1] == "stores__v_count_1d_1d"
    spine = spine_of(spark, spine_rows(), SPINE).drop("amt")
    assert lean.historical(spine, "t").count() == 60
    with pytest.raises(ValueError):
        base.historical(spine, "t")
    with pytest.raises(ValueError):
        lean.historical(spine.drop("k"), "t")
    with pytest.raises(ValueError):
        Service.of("twice", [sum_view(source), sum_view(source)]).validate()


def test_on_demand_input_is_looked_up_but_not_returned(spark, source):
    spine = spine_of(spark, spine_rows(), SPINE)
    only = Service.of("only", [check_mode(source, "native")]).historical(spine, "t")
    assert only.columns == [*spine.columns, "native__above"]
    both = Service.of("both", [sum_view(source)["v_sum_1h_5m"], check_mode(source, "native")])
    done = both.historical(spine, "t")
    assert done.columns[-2:] == ["sums__v_sum_1h_5m", "native__above"]
    assert sorted(r.native__above for r in only.collect()) == sorted(
        r.native__above for r in done.collect()
    )


def test_on_demand_modes_agree(spark, source):
    spine = spine_of(spark, spine_rows(), SPINE)

    def run(mode):
        service = Service.of("s", [check_mode(source, mode)])
        return sorted((r.id, r[-1]) for r in service.historical(spine, "t").collect())

    assert run("native") == run("pandas") == run("python")


@pytest.mark.parametrize("mode", ["native", "pandas", "python"])
@pytest.mark.parametrize("amt,mean,above", [(1000, 750, True), (500, 800, False), (1, None, True)])
def test_on_demand_on_mock_inputs(spark, source, mode, amt, mean, above):
    schema = "purchase struct<amt double>, sums struct<v_mean_1h_5m double>"
    row = ((float(amt),), (None if mean is None else float(mean),))
    mock = spark.createDataFrame([row], schema)
    assert check_mode(source, mode).run(mock).first().above is above


def test_on_demand_output_is_held_to_its_schema(spark, source):
    request = Request.of("r", "amt double")
    declared = on_demand(inputs=[request], mode="native", schema="half float")
    made = declared(lambda r: {"half": r["amt"] / 2})
    out = made.run(spark.createDataFrame([((3.0,),)], "r struct<amt double>"))
    assert out.schema["half"].dataType == T.FloatType()
    wrong = on_demand(inputs=[request], mode="native", schema="x float")(lambda r: {"y": r["amt"]})
    with pytest.raises(ValueError):
        wrong.run(spark.createDataFrame([((3.0,),)], "r struct<amt double>"))
    with pytest.raises(ValueError):
        on_demand(inputs=[request], mode="fortran", schema="x float")(lambda r: r)


def test_scoring_at_one_moment(spark, source):
    spine = spine_of(spark, spine_rows(), SPINE)
    service = Service.of("s", [row_view(source)[["high"]], sum_view(source)])
    done = service.at(spine, at(300))
    fixed = spine.withColumn("t", F.lit("2024-01-01 05:00:00").cast("timestamp"))
    want = service.historical(fixed, "t")
    assert sorted((r.id, *r[-5:]) for r in done.collect()) == sorted(
        (r.id, *r[-5:]) for r in want.collect()
    )
    now = service.at(spine).select("id", "rows__high").collect()
    assert len(now) == 60


def test_spines_of_every_kind(spark):
    records = [
        {"k": "a", "amt": 135.72, "t": datetime(2023, 3, 29)},
        {"k": "b", "amt": 227, "t": datetime(2023, 3, 29)},
    ]
    from_records = spine_of(spark, records, "k string, amt double, t timestamp")
    from_pandas = spine_of(spark, pd.DataFrame.from_records(records))
    assert plain(from_records) == plain(from_pandas.select("k", "amt", "t"))
    assert spine_of(spark, from_records).columns == ["k", "amt", "t"]
    assert from_records.schema["amt"].dataType == T.DoubleType()
    assert from_records.toPandas().shape == (2, 3)
    assert from_records.first().asDict()["k"] == "a"
    with pytest.raises(ValueError):
        spine_of(spark, records)


def test_request_columns_are_checked_and_cast(spark):
    request = Request.of("r", "amt double")
    df = request.apply(spark.createDataFrame([("3",)], "amt string"))
    assert df.schema["amt"].dataType == T.DoubleType()
    with pytest.raises(ValueError):
        request.apply(df.drop("amt"))


def test_coverage_of_stored_tiles(spark):
    rows = [(0, at(4)), (1, at(10)), (2, at(15))]
    df = spark.createDataFrame(rows, "id int, t timestamp")
    got = {r.id: r.covered for r in coverage(df, "t", 5 * MINUTE, [(at(0), at(5)), (at(8), at(10))]).collect()}
    assert got == {0: True, 1: True, 2: False}


def test_scalar_functions(spark):
    df = spark.createDataFrame(
        [(4111, 50.0), (5111, 50.01), (6111, None), (3111, 0.0)], "cc long, amt double"
    )
    rows = df.select(
        card_issuer(F.col("cc")).alias("issuer"),
        flag_above(F.col("amt"), 50).alias("over"),
        joined([F.col("cc"), F.col("amt")]).alias("line"),
    ).collect()
    assert [r.issuer for r in rows] == ["Visa", "MasterCard", "Discover", "other"]
    assert [r.over for r in rows] == [0, 1, 0, 0]
    assert rows[2].line == "6111,"


def test_partitioned_table_keeps_strings_and_prunes(spark, tmp_path):
    rows = [("a", datetime(2024, 2, d, 5), 1.0, "x") for d in range(1, 12)]
    path = str(tmp_path / "events")
    write_partitioned(spark.createDataFrame(rows, EVENT), "t", path)
    day = on_day(read_partitioned(spark, path), datetime(2024, 2, 3))
    assert [(r.partition_1, r.partition_2) for r in day.collect()] == [("02", "03")]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_0" in plan


def test_zoneless_round_trip(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00' AS t, 1 AS x")
    assert zoneless(utc(df)).collect() == df.collect()


def test_time_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(random_events(50, 3), EVENT).withColumn(
        "t", F.col("t").cast("timestamp_ntz")
    ).write.parquet(path)
    view = sum_view(Source("events", utc(spark.read.parquet(path)), "t", filtered=True))
    tiles = view.tiles(at(10), at(20)).merged
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan
    assert "s:string" not in plan


def test_lookup_equals_training_join_at_the_same_moment(spark, source):
    requests = spine_of(spark, spine_rows(), SPINE).drop("t")
    service = Service.of(
        "s", [row_view(source, ttl=2 * HOUR), sum_view(source), store_view(source), check_mode(source, "native")]
    )
    for minutes in (123.4, 300, 660):
        online = service.lookup(requests, at(minutes), effective=True)
        offline = service.at(requests, at(minutes), effective=True).drop("current_timestamp")
        assert online.columns == offline.columns
        assert plain(online) == plain(offline)


def test_lookup_of_a_continuous_view(spark, source):
    @stream_view(
        source=source, keys=["k"], ts="t", aggregations=[Aggregate("v", "sum", HOUR), Aggregate("v", "count", HOUR)]
    )
    def live(events):
        return f"SELECT k, t, v FROM {events}"

    requests = spine_of(spark, spine_rows(), SPINE).drop("t")
    service = Service.of("s", [live])
    moment = at(300)
    assert plain(service.lookup(requests, moment)) == plain(
        service.at(requests, moment).drop("current_timestamp")
    )


def test_lookup_from_given_snapshots(spark, source):
    view = row_view(source)[["high"]]
    shot = view.snapshot(at(300), prefix="rows__")
    requests = spine_of(spark, spine_rows(), SPINE).select("id", "k")
    service = Service.of("s", [view])
    given = service.lookup(requests, at(300), snapshots={"rows": shot})
    assert plain(given) == plain(service.lookup(requests, at(300)))


def test_on_demand_history_has_bare_names(spark, source):
    spine = spine_of(spark, spine_rows(), SPINE)
    check = check_mode(source, "native")
    done = on_demand_historical(check, spine, "t")
    assert done.columns == [*spine.columns, "above"]
    listed = Service.of("s", [check]).historical(spine, "t")
    assert plain(done) == plain(listed)


def test_views_of_one_service_share_a_window(spark, source):
    @stream_view(
        source=source,
        keys=["k"],
        ts="t",
        interval=5 * MINUTE,
        aggregations=[Aggregate("v", "count", HOUR), Aggregate("s", "distinct", HOUR), Aggregate("s", "last", HOUR, 2)],
    )
    def others(events):
        return f"SELECT k, t, v, s FROM {events}"

    spine = spine_of(spark, spine_rows(), SPINE)
    views = [sum_view(source), others]
    done = Service.of("s", views).historical(spine, "t", effective=True)
    joins = done._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
    assert joins == 1
    # A third view with another interval joins the points, not the spine.
    more = Service.of("m", [*views, hours(source), row_view(source)]).historical(spine, "t")
    assert plain(more.select(*done.columns[:-2])) == plain(done.select(*done.columns[:-2]))
    for view in (hours(source), row_view(source)):
        alone = view.historical(spine, "t").select("id", *view.features)
        assert plain(more.select("id", *[f"{view.name}__{f}" for f in view.features])) == plain(alone)
    odd = Service.of("o", [hours(source), minutes_21(source)]).historical(spine, "t")
    for view in (hours(source), minutes_21(source)):
        alone = view.historical(spine, "t").select("id", *view.features)
        assert plain(odd.select("id", *[f"{view.name}__{f}" for f in view.features])) == plain(alone)
    for view in views:
        alone = view.historical(spine, "t").select("id", *view.features)
        assert plain(done.select("id", *[f"{view.name}__{f}" for f in view.features])) == plain(alone)


def test_a_skewed_point_is_split_in_every_join(spark, source):
    """One key scored at one moment: Spark must cut the rows of that point in each join."""
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {name: spark.conf.get(name, None) for name in tight}
    for name, value in tight.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        spine = spark.range(0, 60000, 1, 8).select(
            "id", key.alias("k"), key.alias("m"), F.uuid().alias("note")
        )
        service = Service.of("s", [row_view(source)[["high"]], sum_view(source), store_view(source)])
        done = service.at(spine, at(300)).groupBy().agg(F.max("note"), *[F.max(n) for n in service.names])
        done.collect()
        plan = done._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("SortMergeJoin(skew=true)") == 2
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_service_of_request_features_only_can_be_looked_up(spark):
    request = Request.of("r", "amt double")

    @on_demand(inputs=[request], mode="native", schema="big boolean")
    def check(r):
        return {"big": r["amt"] > 10}

    service = Service.of("only", [check])
    rows = spark.createDataFrame([(1, 5.0), (2, 50.0)], "id int, amt double")
    got = service.lookup(rows, at(0)).orderBy("id").collect()
    assert [r["check__big"] for r in got] == [False, True]


def test_two_views_of_one_name_are_refused(spark):
    events = Source("events", spark.createDataFrame([("a", at(0), 1.0, "x")], EVENT), "t")

    def declare(column):
        @stream_view(source=events, keys=["k"], ts="t", interval=HOUR, aggregations=[Aggregate(column, "count", DAY)])
        def same(events):
            return f"SELECT k, t, {column} FROM {events}"

        return same

    with pytest.raises(ValueError, match="named same"):
        Service.of("two", [declare("v"), declare("s")]).join_keys


def test_nested_values_in_csv(spark, tmp_path):
    from tidemark.operators.export import csv_lines, read_csv, write_csv

    rows = spark.createDataFrame([(1, ["a", "b"], 2.0)], "id int, names array<string>, v double")
    assert csv_lines(rows, ["names", "v"], ["id"]).first()["line"] == '"[\\"a\\",\\"b\\"]",2.0'
    write_csv(rows, str(tmp_path / "csv"))
    back = read_csv(spark, str(tmp_path / "csv"), "id int, names string, v double")
    assert back.first()["names"] == '["a","b"]'


def test_text_times(spark):
    from tidemark.sources.tables import with_times, zoneless

    rows = spark.createDataFrame([("2024-01-01 00:05:00",), ("never",), (None,)], "t string")
    assert [r.t for r in zoneless(with_times(rows, None, "t")).collect()] == [at(5), None, None]


def test_ties_resolve_the_same_for_some_features_as_for_all(spark):
    rows = [("a", at(0), 2.0, "Z"), ("a", at(0), 3.0, "A")]
    events = Source("events", spark.createDataFrame(rows, EVENT), "t")

    @batch_view(sources=[events], keys=["k"], ts="t", schedule=DAY)
    def tied(events):
        return f"SELECT k, t, v, s FROM {events}"

    spine = spark.createDataFrame([(0, "a", at(0) + 2 * DAY)], "id int, k string, t timestamp")
    whole, part = tied.historical(spine, "t").first(), tied[["s"]].historical(spine, "t").first()
    assert (whole["v"], whole["s"], part["s"]) == (3.0, "A", "A")
    assert tied[["s"]].latest().first()["s"] == "A"
