from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from help import (
    DAY,
    EVENT,
    HOUR,
    MINUTE,
    T0,
    aggregate,
    at,
    floor,
    plain,
    random_events,
    same,
    window_rows,
)
from pyspark.sql import functions as F

from tidemark.functions.aggregates import Aggregate
from tidemark.functions.time import CONTINUOUS, bucket
from tidemark.operators.lookup import current_values
from tidemark.operators.rolling import linear_answers
from tidemark.operators.points import points_of
from tidemark.operators.tiles import TileSet, build_tiles, finish, merge_tiles
from tidemark.operators.windows import aggregate_asof, rolled

SPINE = "id int, k string, t timestamp"
COLUMN = {"v": 2, "s": 3}
FIVE = 5 * MINUTE
MIXED = [
    Aggregate("v", "count", 15 * MINUTE),
    Aggregate("v", "sum", HOUR),
    Aggregate("v", "mean", 30 * MINUTE),
    Aggregate("s", "distinct", 15 * MINUTE),
    Aggregate("s", "distinct", HOUR),
    Aggregate("s", "last", HOUR, 3),
    Aggregate("v", "last", 15 * MINUTE, 1),
]


def spine_of(seed, n=150):
    return [(i, k, t) for i, (k, t, _, _) in enumerate(random_events(n, seed, minutes=800))]


def expected(spine, events, aggregates, interval):
    out = {}
    for ident, key, time in spine:
        end = None if time is None else floor(time, interval)
        out[ident] = [
            aggregate(
                [] if end is None else window_rows(events, key, end - a.window, end),
                a.function,
                a.size,
                COLUMN[a.column],
            )
            for a in aggregates
        ]
    return out


def check(done, want, aggregates, interval):
    rows = done.collect()
    assert len(rows) == len(want)
    for r in rows:
        got = [r[a.feature(interval)] for a in aggregates]
        assert all(same(x, y) for x, y in zip(got, want[r.id])), (r, want[r.id])


WITHOUT_INVERSE = [
    Aggregate("v", "min", 15 * MINUTE),
    Aggregate("v", "min", 2 * HOUR),
    Aggregate("v", "max", HOUR),
    Aggregate("s", "max", 30 * MINUTE),
    Aggregate("s", "approx_distinct", HOUR),
    Aggregate("s", "last_distinct", HOUR, 3),
    Aggregate("s", "last_distinct", 15 * MINUTE, 3),
    Aggregate("v", "last_distinct", 5 * MINUTE, 2),
    Aggregate("v", "mean", HOUR),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_least_greatest_sketched_and_different_values(spark, seed):
    events, spine = random_events(400, seed), spine_of(seed + 200)
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", WITHOUT_INVERSE, FIVE)
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, WITHOUT_INVERSE)
    check(done, expected(spine, events, WITHOUT_INVERSE, FIVE), WITHOUT_INVERSE, FIVE)


def test_values_without_inverse_over_many_cells(spark):
    """A window of 600 tiles is cut into cells, of which some are whole."""
    events = random_events(500, 11, minutes=3000)
    spine = [(i, k, t) for i, (k, t, _, _) in enumerate(random_events(120, 12, minutes=3300))]
    wanted = [Aggregate("v", "min", 600 * MINUTE), Aggregate("v", "max", 77 * MINUTE), Aggregate("s", "approx_distinct", 600 * MINUTE)]
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, MINUTE)
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, wanted)
    check(done, expected(spine, events, wanted, MINUTE), wanted, MINUTE)


def test_no_tile_and_no_frame_holds_a_row_per_value(spark):
    events = spark.range(20_000).selectExpr("'a' AS k", "timestamp_micros(id * 1000) AS t", "CAST(id AS string) AS s")
    wanted = [Aggregate("s", "approx_distinct", 5 * MINUTE)]
    tiles = build_tiles(events, ["k"], "t", wanted, FIVE)
    assert list(tiles.parts()) == ["merged"] and tiles.merged.count() == 1
    got = current_values(tiles, wanted, datetime(1970, 1, 1, 0, 5)).first()[wanted[0].feature(FIVE)]
    assert abs(got - 20_000) < 20_000 * 5 * 1.04 / 64


def test_merging_keeps_what_has_no_inverse(spark):
    events = random_events(300, 21)
    halves = [build_tiles(spark.createDataFrame(events[i::2], EVENT), ["k"], "t", WITHOUT_INVERSE, FIVE) for i in (0, 1)]
    stacked = halves[0].replace({n: p.unionByName(halves[1].parts()[n]) for n, p in halves[0].parts().items()})
    merged, spine = merge_tiles(stacked), spine_of(22)
    assert merged.merged.count() == merged.merged.select("k", "_at").distinct().count()
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", merged, WITHOUT_INVERSE)
    check(done, expected(spine, events, WITHOUT_INVERSE, FIVE), WITHOUT_INVERSE, FIVE)


def test_continuous_values_without_inverse(spark):
    events = random_events(300, 31)
    spine = [(i, k, t) for i, (k, t, _, _) in enumerate(events) if t is not None]
    wanted = [Aggregate("v", f, w) for f in ("min", "max") for w in (40 * MINUTE, 5 * HOUR)]
    wanted.append(Aggregate("s", "approx_distinct", 3 * HOUR))
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, CONTINUOUS)
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, wanted)
    want = {
        i: [aggregate(window_rows(events, k, t - a.window, t, "right"), a.function, a.size, COLUMN[a.column]) for a in wanted]
        for i, k, t in spine
    }
    check(done, want, wanted, CONTINUOUS)
    with pytest.raises(ValueError, match="need an interval"):
        build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", [Aggregate("s", "last_distinct", HOUR, 2)], CONTINUOUS)


def test_listings_of_values_without_inverse(spark):
    events = random_events(120, 41, minutes=200)
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", WITHOUT_INVERSE, FIVE)
    rows = rolled(tiles, WITHOUT_INVERSE).collect()
    assert rows
    for r in rows:
        for a in WITHOUT_INVERSE:
            inside = window_rows(events, r.k, r.window_end - a.window, r.window_end)
            assert same(r[a.feature(FIVE)], aggregate(inside, a.function, a.size, COLUMN[a.column])), (r, a)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tiled_aggregates_match_brute_force(spark, seed):
    events, spine = random_events(400, seed), spine_of(seed + 100)
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", MIXED, FIVE)
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, MIXED)
    assert done.columns == ["id", "k", "t", *[a.feature(FIVE) for a in MIXED]]
    check(done, expected(spine, events, MIXED, FIVE), MIXED, FIVE)


def test_windows_much_shorter_than_history_cross_epochs(spark):
    wanted = [Aggregate("v", "sum", FIVE), Aggregate("s", "distinct", FIVE), Aggregate("s", "last", FIVE, 2)]
    events, spine = random_events(500, 11, minutes=300), spine_of(12, 300)
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, MINUTE)
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, wanted)
    check(done, expected(spine, events, wanted, MINUTE), wanted, MINUTE)


def test_times_before_the_epoch(spark):
    events = [("a", datetime(1969, 12, 31, 23, m), 1.0, "x") for m in (50, 55, 58)]
    spine = [(0, "a", datetime(1969, 12, 31, 23, 59)), (1, "a", datetime(1970, 1, 1, 0, 1))]
    wanted = [Aggregate("v", "count", 15 * MINUTE)]
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, FIVE)
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, wanted)
    check(done, expected(spine, events, wanted, FIVE), wanted, FIVE)


def test_edges_of_a_tiled_window(spark):
    events = [("a", at(0), 1.0, "x"), ("a", at(5), 2.0, "x")]
    wanted = [Aggregate("v", "count", FIVE), Aggregate("v", "sum", FIVE)]
    spine = [(0, "a", at(4.9)), (1, "a", at(5)), (2, "a", at(9.9)), (3, "a", at(10)), (4, "a", at(15))]
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, FIVE)
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, wanted)
    got = {r.id: (r.v_count_5m_5m, r.v_sum_5m_5m) for r in done.collect()}
    # An event on a tile edge opens the next tile; a quiet key decays to nothing.
    assert got == {0: (0, None), 1: (1, 1.0), 2: (1, 1.0), 3: (1, 2.0), 4: (0, None)}


def test_value_only_moves_at_interval_starts(spark):
    events = random_events(200, 21)
    wanted = [Aggregate("v", "sum", HOUR)]
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, FIVE)
    spine = [s for s in spine_of(22) if s[2]]
    moved = [(i, k, floor(t, FIVE)) for i, k, t in spine]

    def run(rows):
        done = aggregate_asof(spark.createDataFrame(rows, SPINE), "t", tiles, wanted)
        return {r.id: r.v_sum_1h_5m for r in done.collect()}

    assert run(spine) == run(moved)


def test_all_null_window_has_zero_count_and_no_mean(spark):
    events = [("a", at(0), None, None)]
    wanted = [Aggregate("v", f, HOUR) for f in ("count", "sum", "mean")]
    wanted += [Aggregate("s", "distinct", HOUR), Aggregate("s", "last", HOUR, 2)]
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, FIVE)
    done = aggregate_asof(spark.createDataFrame([(0, "a", at(30))], SPINE), "t", tiles, wanted)
    assert [done.first()[a.feature(FIVE)] for a in wanted] == [0, None, None, 0, None]


def test_partial_tiles_merge_to_the_whole(spark):
    events = random_events(400, 31)
    halves = [events[::2], events[1::2]]
    built = [
        build_tiles(spark.createDataFrame(h, EVENT), ["k"], "t", MIXED, FIVE) for h in halves
    ]
    both = built[0].replace(
        {n: p.unionByName(built[1].parts()[n]) for n, p in built[0].parts().items()}
    )
    whole = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", MIXED, FIVE)
    merged = merge_tiles(both)
    for name, part in whole.parts().items():
        assert plain(part) == plain(merged.parts()[name].select(part.columns)), name


def test_rolled_listing_has_every_non_empty_boundary(spark):
    events = random_events(200, 41, minutes=200)
    wanted = [Aggregate("v", "sum", 15 * MINUTE), Aggregate("s", "distinct", 30 * MINUTE)]
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, FIVE)
    want = set()
    for key in {e[0] for e in events} - {None}:
        for step in range(0, 60):
            end = at(5 * step)
            # A row without values still opens a tile of its key.
            longest = window_rows(events, key, end - 30 * MINUTE, end)
            names = [r for r in longest if r[3] is not None]
            if any(r for r in longest):
                total = aggregate(window_rows(events, key, end - 15 * MINUTE, end), "sum")
                want.add((key, end, total, aggregate(names, "distinct", column=3)))
    assert set(plain(rolled(tiles, wanted))) == want
    first = (at(60) - datetime(1970, 1, 1)) // FIVE
    some = plain(rolled(tiles, wanted, first, first + 6))
    assert set(some) == {w for w in want if at(60) <= w[1] < at(90)}


def test_values_at_one_moment_equal_the_windowed_ones(spark):
    events = random_events(400, 51)
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", MIXED, FIVE)
    moment = at(333)
    keys = sorted({e[0] for e in events} - {None})
    spine = [(i, k, moment) for i, k in enumerate(keys)]
    slow = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, MIXED)
    names = [a.feature(FIVE) for a in MIXED]
    fast = {r.k: [r[n] for n in names] for r in current_values(tiles, MIXED, moment).collect()}
    empty = [0, None, None, 0, 0, None, None]
    for r in slow.collect():
        got = fast.get(r.k, empty)
        assert all(same(a, b) for a, b in zip(got, [r[n] for n in names])), r


@pytest.mark.parametrize(
    "window", [HOUR, 7 * MINUTE, timedelta(microseconds=1), 3 * HOUR, 3 * DAY, 90 * DAY]
)
def test_continuous_aggregates_match_brute_force(spark, window):
    events, spine = random_events(300, 61), spine_of(62)
    wanted = [Aggregate("v", f, window) for f in ("count", "sum", "mean")]
    wanted += [Aggregate("v", "sum", 2 * HOUR), Aggregate("s", "distinct", window)]
    wanted += [Aggregate("s", "last", window, 3), Aggregate("s", "last", 2 * HOUR, 3)]
    wanted += [Aggregate("v", "last", window, 1)]
    wanted = list(dict.fromkeys(wanted))
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, CONTINUOUS)
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, wanted)
    want = {}
    for i, key, time in spine:
        want[i] = [
            aggregate(
                [] if time is None else window_rows(events, key, time - a.window, time, "right"),
                a.function,
                a.size,
                COLUMN[a.column],
            )
            for a in wanted
        ]
    check(done, want, wanted, CONTINUOUS)


@pytest.mark.parametrize("interval", [MINUTE, timedelta(seconds=1)])
def test_long_windows_take_the_linear_way_to_the_same_values(spark, interval):
    events, spine = random_events(300, 71), spine_of(72)
    wanted = [Aggregate("v", f, 2 * HOUR) for f in ("count", "sum", "mean")]
    wanted += [Aggregate("v", "sum", 20 * HOUR), Aggregate("s", "distinct", 2 * HOUR)]
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, interval)
    frame = spark.createDataFrame(spine, SPINE)
    done = aggregate_asof(frame, "t", tiles, wanted)
    check(done, expected(spine, events, wanted, interval), wanted, interval)
    points = points_of(frame, ["k"], bucket(F.col("t"), interval))
    merged = wanted[:4]
    assert plain(linear_answers(points, tiles, merged)) == plain(finish(points, tiles, merged))


def test_continuous_window_edges(spark):
    events = [("a", at(0), 1.0, "x")]
    wanted = [Aggregate("v", "count", HOUR)]
    tiles = build_tiles(spark.createDataFrame(events, EVENT), ["k"], "t", wanted, CONTINUOUS)
    tick = timedelta(microseconds=1)
    spine = [(0, "a", T0 - tick), (1, "a", T0), (2, "a", T0 + HOUR - tick), (3, "a", T0 + HOUR)]
    done = aggregate_asof(spark.createDataFrame(spine, SPINE), "t", tiles, wanted)
    assert {r.id: r.v_count_1h_continuous for r in done.collect()} == {0: 0, 1: 1, 2: 1, 3: 0}


def test_names_and_checks():
    assert Aggregate("amt", "mean", 3 * DAY).feature(10 * MINUTE) == "amt_mean_3d_10m"
    assert Aggregate("amt", "sum", HOUR).feature(10 * MINUTE) == "amt_sum_1h_10m"
    assert Aggregate("f", "count", 90 * MINUTE).feature(CONTINUOUS) == "f_count_90m_continuous"
    assert Aggregate("m", "last", 14 * DAY, 10).feature(DAY) == "m_last10_14d_1d"
    with pytest.raises(ValueError):
        Aggregate("v", "median", HOUR)
    with pytest.raises(ValueError):
        Aggregate("v", "last", HOUR)
    with pytest.raises(ValueError):
        Aggregate("v", "sum", HOUR).buckets(7 * MINUTE)
    with pytest.raises(ValueError):
        Aggregate("v", "sum", timedelta(0))


def test_tile_set_names_its_parts(spark):
    df = spark.createDataFrame([], EVENT)
    tiles = build_tiles(df, ["k"], "t", MIXED, FIVE)
    assert set(tiles.parts()) == {"merged", "distinct_s", "recent3_s", "recent1_v"}
    assert isinstance(tiles.map(lambda d: d), TileSet)


def test_keys_named_like_internal_columns(spark):
    names = ["value", "ts", "step", "first", "final", "w"]
    rows = [(*"abcdef", at(i), float(i % 3), "xy"[i % 2]) for i in range(6)]
    schema = ", ".join(f"{n} string" for n in names) + ", t timestamp, v double, s string"
    events = spark.createDataFrame(rows, schema)
    wanted = [Aggregate("v", "sum", HOUR), Aggregate("s", "distinct", HOUR), Aggregate("s", "last", HOUR, 2)]
    spine = spark.createDataFrame([(*"abcdef", at(60))], ", ".join(f"{n} string" for n in names) + ", t timestamp")
    for interval, total in ((HOUR, 6.0), (timedelta(microseconds=1), 6.0)):
        tiles = build_tiles(events, names, "t", wanted, interval)
        got = aggregate_asof(spine, "t", tiles, wanted).first()
        values = tuple(got)[len(names) + 1 :]
        assert values[1] == 2 and values[2] == ["y", "x"]
        assert values[0] == (6.0 if interval == HOUR else 6.0 - rows[0][7])
