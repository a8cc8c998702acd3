"""Every query of the catalog against its SQL in DuckDB, over the smallest tables."""

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb
import pytest

from folioflow import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_same_rows(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = Counter(tuple(plain(r[c]) if not isinstance(r[c], list) else str(r[c]) for c in columns) for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert columns
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert rows == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
