"""Every registered query equals its SQL oracle (DuckDB) on the small tables,
and the entry point runs."""

import duckdb
import pytest

import check_oracle
from paths import SF001

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check_oracle.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    rows = entry(spark).collect()
    assert len(rows) > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SF001).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert list(got.columns)  # queries without SQL have tests of their own
        return
    exp = duck.sql(sql).df()
    c1, r1 = check_oracle.rows_of(got)
    c2, r2 = check_oracle.rows_of(exp)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
