"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from termweave.plans.oracle import ORACLE
from termweave.plans.queries import QUERIES
from tests.conftest import SMALL

TABLES = ["documents", "pages", "benchmark", "conversations", "labels"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t + '.parquet')}')")
    return c




@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    cols = df.columns
    got = Counter(tuple(_norm(x) for x in r) for r in df.collect())
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == sorted(cols)
    idx = [rel.columns.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(QUERIES) - set(ORACLE) == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "lang", "term", "pos", "sentence", "score"]
    assert df.count() > 0
