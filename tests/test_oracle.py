"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in ORACLE:
        assert len(got.columns) > 0
        return
    want = con.sql(ORACLE[name]).df()
    c1, r1 = rows_of(got)
    c2, r2 = rows_of(want)
    assert c1 == c2
    assert r1 == r2
