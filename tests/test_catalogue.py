"""Every query of the catalogue against its DuckDB equivalent on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from navnet.plans.catalogue import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df, want = QUERIES[name](spark, FOLDER), duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    got, wanted = rows(df.columns, df.collect()), rows(want.columns, want.fetchall())
    assert len(got) == len(wanted)
    for a, b in zip(got, wanted, strict=True):
        assert all(x == y if not isinstance(x, float) or y is None else x == pytest.approx(y, rel=1e-9, abs=1e-9) for x, y in zip(a, b, strict=True)), (a, b)


def test_queries_without_sql_run(spark):
    for name in sorted(set(QUERIES) - set(SQL)):
        assert QUERIES[name](spark, FOLDER).count() >= 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["edge", "total_cargo", "trips"] and df.count() > 0


def test_names_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())
