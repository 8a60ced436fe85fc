"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float | decimal.Decimal):
        return "nan" if math.isnan(v) else round(float(v), 5) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in SQL:
        assert len(set(df.columns)) == len(df.columns)
        return
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table_of(df.columns, rows) == table_of(columns, result.fetchall())


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["user_id", "tick_ns", "value"]
