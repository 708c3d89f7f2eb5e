"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("LOADSMITH_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted(tuple(repr(norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(rows, df.columns) == canon(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
