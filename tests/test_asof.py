from __future__ import annotations

from datetime import timedelta

import pytest
from help import DAY, EVENT, HOUR, MINUTE, T0, at, plain, random_events
from pyspark.sql import functions as F

from tidemark.operators.asof import FeatureTable, asof_join, latest
from tidemark.operators.cells import CELL, with_cell
from tidemark.sources.tables import zoneless

SPINE = "id int, k string, t timestamp"


def brute(spine, features, schedule=None, ttl=None):
    """Newest visible row per spine row; ties go to the later time, then larger values."""
    out = []
    for ident, key, time in spine:
        best = None
        for fk, ft, v, s in features:
            if None in (key, time, fk, ft) or fk != key:
                continue
            seen = ft if schedule is None else T0 + ((ft - T0) // schedule + 1) * schedule
            rank = (seen, ft, v is not None, v or 0, s is not None, s or "")
            if seen <= time and (best is None or rank > best[0]):
                best = (rank, v, s, ft)
        alive = best is not None and (ttl is None or best[3] > time - ttl)
        out.append((ident, best[1] if alive else None, best[2] if alive else None))
    return out


def spine_rows(events):
    return [(i, k, t) for i, (k, t, _, _) in enumerate(events)]


@pytest.mark.parametrize("schedule,ttl", [(None, None), (HOUR, None), (None, HOUR), (HOUR, 2 * HOUR)])
def test_matches_brute_force_(spark, schedule, ttl):
    features = random_events(300, seed=1)
    spine = spine_rows(random_events(200, seed=2))
    table = FeatureTable(
        spark.createDataFrame(features, EVENT), "t", ("v", "s"), "", schedule, ttl
    )
    done = asof_join(spark.createDataFrame(spine, SPINE), ["k"], "t", [table])
    got = sorted((r.id, r.v, r.s) for r in done.collect())
    assert got == sorted(brute(spine, features, schedule, ttl))


def test_several_tables_share_a_window(spark):
    one, two = random_events(100, seed=3), random_events(100, seed=4)
    spine = spine_rows(random_events(100, seed=5))
    tables = [
        FeatureTable(spark.createDataFrame(one, EVENT), "t", ("v",), "one_"),
        FeatureTable(spark.createDataFrame(two, EVENT), "t", ("v", "s"), "two_", None, HOUR),
    ]
    done = asof_join(spark.createDataFrame(spine, SPINE), ["k"], "t", tables)
    assert done.columns == ["id", "k", "t", "one_v", "two_v", "two_s"]
    got = sorted((r.id, r.one_v, r.two_v, r.two_s) for r in done.collect())
    first = {i: v for i, v, _ in brute(spine, one)}
    second = {i: (v, s) for i, v, s in brute(spine, two, ttl=HOUR)}
    assert got == sorted((i, first[i], *second[i]) for i in first)


def test_edges_of_visibility_and_age(spark):
    features = spark.createDataFrame([("a", at(0), 1.0, "x")], EVENT)
    spine = [(0, "a", at(-1)), (1, "a", at(0)), (2, "a", at(60)), (3, "a", at(59)), (4, "b", at(5))]
    table = FeatureTable(features, "t", ("v",), "", None, HOUR)
    done = asof_join(spark.createDataFrame(spine, SPINE), ["k"], "t", [table], effective=True)
    got = {r.id: (r.v, r.effective_ts) for r in zoneless(done).collect()}
    # Visible from its own time on; an hour later it is too old; an unknown key keeps its row.
    assert got == {
        0: (None, None), 1: (1.0, at(0)), 2: (None, None), 3: (1.0, at(0)), 4: (None, None)
    }


def test_schedule_always_moves_to_the_next_boundary(spark):
    features = spark.createDataFrame([("a", T0, 1.0, "x"), ("a", at(90), 2.0, "y")], EVENT)
    table = FeatureTable(features, "t", ("v",), "", DAY)
    spine = [(0, "a", T0 + DAY - MINUTE), (1, "a", T0 + DAY)]
    done = asof_join(spark.createDataFrame(spine, SPINE), ["k"], "t", [table])
    # A row exactly on midnight still waits for the following midnight.
    assert {r.id: r.v for r in done.collect()} == {0: None, 1: 2.0}


def test_every_spine_row_once_even_copies_and_rows_without_key(spark):
    spine = [(0, "a", at(5))] * 3 + [(1, None, at(5)), (2, "a", None)]
    table = FeatureTable(spark.createDataFrame([("a", at(1), 7.0, "x")], EVENT), "t", ("v",))
    done = asof_join(spark.createDataFrame(spine, SPINE), ["k"], "t", [table])
    got = sorted((r.id, r.v) for r in done.collect() if r.id == 0)
    assert got == [(0, 7.0)] * 3
    assert {r.id: r.v for r in done.collect()} == {0: 7.0, 1: None, 2: None}


def test_later_feature_rows_change_nothing(spark):
    features = random_events(200, seed=6)
    spine = [(i, k, t) for i, k, t in spine_rows(random_events(50, seed=7)) if t]
    cut = at(300)
    early = [s for s in spine if s[2] <= cut]
    known = [f for f in features if f[1] is None or f[1] <= cut]
    frame = spark.createDataFrame(early, SPINE)

    def run(rows):
        table = FeatureTable(spark.createDataFrame(rows, EVENT), "t", ("v", "s"))
        return plain(asof_join(frame, ["k"], "t", [table]))

    assert run(features) == run(known)


def test_input_order_and_partitioning_do_not_matter(spark):
    features = spark.createDataFrame(random_events(200, seed=8), EVENT)
    spine = spark.createDataFrame(spine_rows(random_events(100, seed=9)), SPINE)

    def run(f, s):
        return plain(asof_join(s, ["k"], "t", [FeatureTable(f, "t", ("v", "s"))]))

    assert run(features, spine) == run(
        features.orderBy(F.desc("t")).repartition(7), spine.repartition(3)
    )


def test_a_burst_of_half_of_all_rows_is_cut(spark):
    """Half of the rows are one key in ten seconds, and as many points ask in them."""
    burst = [("hot", T0 + timedelta(microseconds=1000 * i), float(i), "s") for i in range(10_000)]
    other = [(f"k{i % 50}", at(i % 600), float(i), "s") for i in range(10_000)]
    frame = spark.createDataFrame(burst + other, EVENT).withColumn("_at", F.unix_micros("t"))
    largest = with_cell(frame).groupBy("k", CELL).count().agg(F.max("count")).first()[0]
    assert largest <= 1_000
    spine = [(i, "hot", T0 + timedelta(microseconds=1000 * i + 500)) for i in range(0, 10_000, 7)]
    spine += [(20_000, "hot", T0 + 400 * DAY), (20_001, "hot", T0 - DAY)]
    done = asof_join(spark.createDataFrame(spine, SPINE), ["k"], "t", [FeatureTable(frame, "t", ("v",))])
    want = {i: float(i) for i in range(0, 10_000, 7)} | {20_000: 9999.0, 20_001: None}
    assert {r.id: r.v for r in done.collect()} == want
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_features_named_like_internal_columns(spark):
    rows = spark.createDataFrame([("a", at(0), 1, 2, 3, 4)], "n string, t timestamp, ts int, seen int, row int, lo int")
    table = FeatureTable(rows, "t", ("ts", "seen", "row", "lo"))
    spine = spark.createDataFrame([(0, "a", at(1))], "id int, n string, t timestamp")
    assert tuple(asof_join(spine, ["n"], "t", [table]).first())[3:] == (1, 2, 3, 4)


def test_latest_row_per_key(spark):
    rows = [("a", at(1), 1.0, "x"), ("a", at(2), 2.0, "y"), ("a", at(2), 3.0, "z"), ("b", at(0), 4.0, "w")]
    table = FeatureTable(spark.createDataFrame(rows, EVENT), "t", ("v",), "", timedelta(hours=1))
    got = {r.k: (r.v, r.effective_ts) for r in zoneless(latest(table, ["k"])).collect()}
    assert got == {"a": (3.0, at(60)), "b": (4.0, at(60))}
