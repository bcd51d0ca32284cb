"""The queries of this subpackage that SQL can express, against DuckDB."""

import os

import duckdb
import pytest
from llm_data import SMALL

from termweave.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t)}.parquet')")
    want = con.sql(ORACLE[name])
    assert sorted(want.columns) == sorted(df.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
