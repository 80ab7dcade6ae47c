"""Every query of the library against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import tidemark.plans  # noqa: F401
from tidemark.plans.registry import ORACLE, QUERIES

SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def cell(x):
    if x is None or isinstance(x, (bool, int, str)):
        return x
    if isinstance(x, float):
        return None if x != x else round(x, 6)
    return str(x)


@pytest.fixture(scope="module")
def duck(sf001):
    con = duckdb.connect()
    for name in os.listdir(sf001):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf001}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf001, duck, name):
    df = QUERIES[name](spark, sf001)
    columns = sorted(df.columns)
    told = duck.execute(ORACLE[name])
    names = [c[0] for c in told.description]
    assert sorted(names) == columns
    kinds = {c[0]: str(c[1]) for c in told.description}
    assert {c: SQL_TYPES.get(k, k) for c, k in df.dtypes} == kinds
    want = sorted(repr([cell(r[names.index(c)]) for c in columns]) for r in told.fetchall())
    got = sorted(repr([cell(r[c]) for c in columns]) for r in df.collect())
    assert got == want
