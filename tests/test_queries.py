"""Every query of the catalogue against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from scenewright.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def shown(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    if name in catalogue.ORACLES:
        relation = duck.sql(catalogue.ORACLES[name])
        assert sorted(relation.columns) == columns
        at = [relation.columns.index(c) for c in columns]
        assert got == sorted(tuple(shown(r[i]) for i in at) for r in relation.fetchall())


def test_streamed_changes_agree_with_the_batch(spark):
    rows = catalogue.QUERIES["stream_state_changes"](spark, DATA).filter("change_type = 'updated'").count()
    con = duckdb.connect()
    want = con.sql(f"SELECT count(*) FROM (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS p FROM '{DATA}/events.parquet') WHERE p IS NOT NULL AND p <> event_type").fetchall()[0][0]
    assert rows == want
