"""Every registered query of the engine against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from lexisift.plans import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    if isinstance(v, (bool, int, float)):
        return repr(float(v))
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        assert got
        return
    found = duck.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, found.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
