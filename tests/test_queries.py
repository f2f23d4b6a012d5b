"""Every registered query against its SQL oracle at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    kinds = {d[0]: d[1] for d in duck.execute("DESCRIBE " + entry.oracle_sql()[name]).fetchall()}
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    cursor = duck.execute(entry.oracle_sql()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
