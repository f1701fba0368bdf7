"""Every named query of the library against its SQL in DuckDB."""

import datetime

import duckdb
import pytest

from marlstone.plans import catalog, filing_queries

QUERIES = catalog.QUERIES | filing_queries.QUERIES
ORACLE_SQL = catalog.ORACLE_SQL | filing_queries.ORACLE_SQL
FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else repr(v)


def test_every_query_has_sql():
    assert not set(catalog.QUERIES) & set(filing_queries.QUERIES)
    assert set(QUERIES) - set(ORACLE_SQL) <= {"parse_xbrl"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLE_SQL[name])
    columns = [x[0] for x in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted(tuple(plain(dict(zip(columns, r, strict=True))[c]) for c in order) for r in result.fetchall())
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    assert got == want
