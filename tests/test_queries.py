import os

import duckdb
import pytest

import __spark_entry__
from keyloom import queries

SF = "/root/testdata/sf0.001"


def plain(frame):
    def one(x):
        if x is None or x != x:
            return None
        return round(x, 6) if isinstance(x, float) else int(x) if hasattr(x, "__index__") and not isinstance(x, bool) else x

    return sorted(repr(tuple(map(one, r))) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query_matches_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    if name not in queries.ORACLE_SQL:
        assert len(got)
        return
    want = duck.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["key", "value", "crts", "sequence"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
