"""Every registered query against its DuckDB oracle (row count, columns,
order-insensitive values) on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E
from tickyard.plans import ORACLE, QUERIES
from conftest import SMALL
from scripts.oracle_check import TABLES, digest, type_mismatches

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "open_price" in df.columns
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    frame = E.queries()[name](spark, SMALL)
    sdf = frame.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) > 0
        return
    rel = con.sql(sql)
    assert type_mismatches(frame.schema, rel) == {}
    odf = rel.df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert digest(sdf)[0] == digest(odf)[0]
