"""Every registered query against its SQL on the given tables."""

import duckdb
import pytest

from cellspark.plans import ORACLE, QUERIES
from tools.check_oracle import TABLES, rows_of


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert got
        return
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, cur.fetchall())
