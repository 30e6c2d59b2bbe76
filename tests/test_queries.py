"""Registered queries against DuckDB on the smallest tables, for queries of the raster engine."""

import glob
import os

import pytest

import __spark_entry__ as entry
from fringeframe.plans.kernel_queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(columns, data):
    by = sorted(range(len(columns)), key=lambda k: columns[k])
    out = [tuple(round(v, 5) + 0.0 if isinstance(v, float) else v for v in (r[k] for k in by)) for r in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLE_SQL[name])
    want = rows([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want


def test_entry_registers_everything(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
