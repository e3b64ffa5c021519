"""Each query against its SQL in another engine."""

import duckdb
import pytest

from nephogrid.plans.catalogue import ORACLES, QUERIES

TABLES = ("events", "orders", "embeddings", "lineitem", "supplier")


@pytest.fixture(scope="module")
def other(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, small, other, name):
    df = QUERIES[name](spark, small)
    cur = other.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted(cur.fetchall(), key=repr)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=repr) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
