"""Registered queries against their DuckDB oracles on the sf0.001 tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tumbleweed.oracle_sql import ORACLES
from tumbleweed.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _norm(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "feature_name" in df.columns
