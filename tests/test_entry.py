"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from winnow import queries as engine

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


def plain(v):
    if v is None or v != v:
        return "-"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(engine.ORACLES))
def test_against_sql(spark, con, name):
    df = engine.QUERIES[name](spark, DATA)
    want = con.execute(engine.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(engine.QUERIES) - set(engine.ORACLES)))
def test_without_sql(spark, name):
    assert engine.QUERIES[name](spark, DATA).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_whole_benchmark_texts(spark):
    """No item is left out and no design is cut to its first letters."""
    from pyspark.sql import functions as F

    from winnow import queries as q

    sf = "/root/testdata/sf0.001"
    n = {str(r.item_id): r.n for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", F.length(F.regexp_replace("text", "[^A-Za-z]", "")).alias("n")).collect()}
    got = {r.ID: r.construct for r in q.order_constructs(spark, sf).collect()}
    assert set(got) == set(n) and all(len(got[i]) > 3 * n[i] for i in n)
    assert {r[0] for r in q.sequence_identity(spark, sf).collect()} == set(n)
