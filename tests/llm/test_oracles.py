"""Queries with oracle SQL, against DuckDB on the sf0.001 tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tumbleweed.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(tuple(r[i] for i in idx) for r in res.fetchall())


def test_all_operators_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
