"""The queries that SQL can express against their DuckDB twins."""

import duckdb
import pytest

from tickyard.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    rel = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})")
    assert sorted(rel.columns) == columns
    got = sorted((tuple(r) for r in frame.select(columns).collect()), key=str)
    assert got == sorted(rel.fetchall(), key=str)
