"""Every registered query against its DuckDB statement on the smallest tables, and the driver contract."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

CORE = [n for n, f in entry.queries().items() if not f.__module__.startswith("correlia.llm")]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return str(v)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", CORE)
def test_query(name, spark, con, sf):
    df = entry.queries()[name](spark, sf)
    rows = df.collect()
    if name not in entry.oracle_sql():
        return
    r = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    expected = sorted([tuple(norm(x[cols.index(c)]) for c in order) for x in r.fetchall()], key=str)
    assert sorted([tuple(norm(x[c]) for c in order) for x in rows], key=str) == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.schema == entry.entry(spark).schema


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
