"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from siftgate.workload.catalog import QUERIES, SQL
from siftgate.workload.views import TABLES


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, small, duck):
    df = QUERIES[name](spark, small)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert got
        return
    cur = duck.execute(SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, cur.fetchall())


def test_only_page_structure_has_no_sql():
    assert set(QUERIES) - set(SQL) == {"e9_text_blocks"}
