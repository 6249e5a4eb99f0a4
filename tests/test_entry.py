"""Driver contract: entry runs, every query has a stable schema, oracle keys match."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001
from feedworks.sources.tables import TABLES


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["p_type", "unique_followers", "avg_followers"]
    assert df.count() >= 0


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, list):
        return tuple(v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=key)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle_sf0001(spark, duck, name):
    df = entry.queries()[name](spark, SF001)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _canon(cols, cur.fetchall())
