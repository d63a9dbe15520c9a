"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registry
from check_oracles import TABLES, canonical
from registered.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_equals_sql(spark, sql, name):
    df = registry.queries()[name](spark, SMALL)
    result = sql.execute(registry.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = canonical(df.columns, [tuple(row) for row in df.collect()])
    assert got == canonical(columns, result.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() == 1000
