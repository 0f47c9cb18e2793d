"""The queries that SQL can say too."""

import os

import duckdb
import pytest
from keyloom.llm import queries

SF = os.environ.get("SQL_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_matches_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    want = c.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda found: sorted((tuple(r) for r in found), key=repr)
    assert rows(got.select(*columns).collect()) == rows(want.select(*[f'"{x}"' for x in columns]).fetchall())
