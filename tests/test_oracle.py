"""Every registered query against its DuckDB statement on sf0.001 (exact)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, norm

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_model_bound():
    from shelfwise.plans.queries import NO_ORACLE, QUERIES
    assert set(QUERIES) - set(SQL) == NO_ORACLE and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    a, b = norm(got), norm(want)
    for c in a.columns:
        assert list(a[c]) == list(b[c]), c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "sku_id" in df.columns and len(df.columns) == 30
