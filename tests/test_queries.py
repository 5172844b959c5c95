"""Every registered query against its SQL on another engine, on the smallest tables."""

from __future__ import annotations

import datetime
import math

import duckdb
import pytest

import __spark_entry__
from __spark_entry__ import entry
from tidemark.queries.oracles import ORACLES
from tidemark.queries.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(canonical(r[c]) for c in columns)) for r in df.collect())
    result = engine.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(repr(tuple(canonical(r[i]) for i in places)) for r in result.fetchall())
    assert got == want
    assert got
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 1000
