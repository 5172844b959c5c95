from __future__ import annotations

import json

from help import DAY, HOUR, at, plain

from tidemark.operators.export import csv_header, csv_lines, json_lines, read_csv, write_csv, write_json
from tidemark.operators.lookup import Snapshot, lookup, vector


def frames(spark):
    rows = [("a", at(0), at(60), "Visa", [1, 2]), ("b", at(-600), at(-540), "other", None)]
    snap = spark.createDataFrame(
        rows, "k string, t timestamp, effective_ts timestamp, issuer string, l array<int>"
    )
    requests = spark.createDataFrame(
        [(0, "a"), (1, "b"), (2, "c"), (3, None), (4, "a")], "id int, k string"
    )
    return requests, snap


def test_every_request_is_answered_once(spark):
    requests, snap = frames(spark)
    found = lookup(requests, [Snapshot(snap, ("k",), ("issuer",), "card__")], at(100))
    got = {r.id: r.card__issuer for r in found.collect()}
    assert got == {0: "Visa", 1: "other", 2: None, 3: None, 4: "Visa"}


def test_age_limit_and_effective_time(spark):
    requests, snap = frames(spark)
    shot = Snapshot(snap, ("k",), ("issuer",), "card__", "t", 5 * HOUR)
    found = lookup(requests, [shot], at(100), effective=True)
    got = {r[0]: (r[2], r[3]) for r in plain(found)}
    assert got[0] == ("Visa", at(60)) and got[1] == (None, None) and got[2] == (None, None)


def test_counts_of_unknown_keys_are_zero(spark):
    requests, _ = frames(spark)
    counts = spark.createDataFrame([("a", 3, 1.5)], "k string, n long, s double")
    shot = Snapshot(counts, ("k",), ("n", "s"), zero=("n",))
    got = {r.id: (r.n, r.s) for r in lookup(requests, [shot], at(0)).collect()}
    assert got == {0: (3, 1.5), 1: (0, None), 2: (0, None), 3: (0, None), 4: (3, 1.5)}


def test_vector_of_names_and_values(spark):
    requests, snap = frames(spark)
    found = lookup(requests, [Snapshot(snap, ("k",), ("issuer", "l"))], at(0))
    rows = {r.id: r.features for r in vector(found, ["issuer", "l"], ["id"]).collect()}
    assert [(f.name, f.value) for f in rows[0]] == [("issuer", "Visa"), ("l", "[1,2]")]
    assert [f.value for f in rows[2]] == [None, None]


def test_lines_and_files(spark, tmp_path):
    df = spark.createDataFrame([(0, 'a,"b', None), (1, "c", 2.5)], "id int, x string, y double")
    lines = {r.id: r.line for r in json_lines(df, ["x", "y"], ["id"]).collect()}
    assert json.loads(lines[0]) == {"x": 'a,"b', "y": None}
    rows = {r.id: r.line for r in csv_lines(df, ["x", "y"], ["id"]).collect()}
    assert rows[1] == "c,2.5"
    assert csv_header(["x", "y"]) == "x,y"
    for header in (True, False):
        path = str(tmp_path / f"csv-{header}")
        write_csv(df, path, header)
        assert plain(read_csv(spark, path, df.schema, header)) == plain(df)
    write_json(df, str(tmp_path / "json"))
    assert plain(spark.read.schema(df.schema).json(str(tmp_path / "json"))) == plain(df)


def test_times_survive_a_csv_file(spark, tmp_path):
    df = spark.createDataFrame([(at(0.123456),)], "t timestamp")
    write_csv(df, str(tmp_path / "t"))
    assert plain(read_csv(spark, str(tmp_path / "t"), df.schema)) == plain(df)
    assert DAY > HOUR
