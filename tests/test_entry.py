"""Driver contract: entry() runs; every query equals its oracle SQL (DuckDB)
on the sf0.001 tables. Queries without SQL are checked against brute force."""

import duckdb
import pytest

import __spark_entry__ as se
from tests.conftest import SF
from tools.oracle_check import compare

TABLES = ["part", "lineitem", "embeddings", "customer", "supplier"]
#: The library's own queries; those of the optional text operators have tests beside them.
OWN = sorted(se._QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_runs(spark):
    df = se.entry(spark)
    assert set(df.columns) == {"query_id", "true_label", "prediction"}
    assert df.count() == 500


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(se.queries()) and set(OWN) <= set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(se.oracle_sql()[name])
    err = compare(rows, df.columns, rel.fetchall(), rel.columns)
    assert err is None, err
