"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import norm

FOLDER = "/root/testdata/sf0.001"
QUERIES, TWINS = entry.queries(), entry.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def table(rows, names):
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted((tuple(norm(r[i]) for i in at) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_twin(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    if name not in TWINS:
        assert rows
        return
    cur = duck.execute(TWINS[name])
    names = [d[0] for d in cur.description]
    assert table(rows, df.columns) == table(cur.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(QUERIES)
