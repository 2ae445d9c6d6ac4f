"""Registered queries against DuckDB on the smallest data set."""

import datetime as dt
import math
import os

import pytest

from tidemark.plans import QUERIES, oracle_queries

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
#: One of each family; the driver compares all of them.
NAMES = [
    n for n in QUERIES
    if n in oracle_queries() and (n[0] in "spjauo" or n[:3] in ("w01", "w02", "w03", "w04", "w05", "w06", "w08", "w09", "w12", "w15", "w16", "w17", "w18", "f01", "f02", "f03", "f04", "c01", "c02", "c03", "c04", "c20"))
]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test data here")
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def key(row):
    return tuple((v is None, f"{v:.8e}" if isinstance(v, float) else str(v)) for v in row)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=key)
    rel = con.execute(oracle_queries()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    want = sorted(([plain(r[names.index(c)]) for c in columns] for r in rel.fetchall()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            same = math.isclose(float(x), float(y), rel_tol=1e-6, abs_tol=2e-6) if isinstance(x, float) or isinstance(y, float) and x is not None and y is not None else str(x) == str(y)
            assert same, (a, b)
