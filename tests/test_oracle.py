"""Every registered query against its DuckDB oracle, on the smallest tables."""

import datetime as dt
import decimal

import duckdb
import pytest
from testdata import SF_SMALL

import __spark_entry__ as E
from zerobill.plans.registry import QUERIES

TABLES = ["region", "nation", "customer", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    o_cols = rel.columns
    o_types = dict(zip(rel.columns, map(str, rel.types)))
    o_rows = rel.fetchall()
    s_rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(o_cols)
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert o_types[f.name] == SPARK_TO_DUCK.get(t, t.upper()), f.name
    assert _bag(s_rows, df.columns) == _bag(o_rows, o_cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 15
    assert len(df.columns) == 55
