"""Every registered query against its DuckDB oracle at sf0.001, and the
driver contract."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from palimpsest.plans import REGISTRY

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_amt" in df.columns


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every registered query has an oracle"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, res.fetchall())
