"""Targets by repeated resharing, copies by a plain prefix sum, odd inputs."""

import math
import random

import pytest

from made import DOCUMENTS
from winnow.llm import mixing


def targets(sizes):
    """sizes: source -> words.  Shares by weight, the excess over 3 times reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    full, left = {}, float(sum(sizes.values()))
    rest = list(order)
    while rest:
        level = left / sum(w[s] for s in rest)
        over = [s for s in rest if level * w[s] >= 3 * sizes[s]]
        if not over:
            return full | {s: level * w[s] for s in rest}
        for s in over:
            full[s] = 3.0 * sizes[s]
            left -= full[s]
            rest.remove(s)
    return full


def documents(rng):
    out = []
    for i in range(900):
        source = rng.choice(["a"] * 6 + ["b", "c", "dé", None, "tiny"] if i % 40 else ["tiny"])
        out.append((i * 3, "w " * rng.choice([0, 1, 5, 40, 200]) if i % 50 else None, "en", source, 0))
    return out


def test_against_plain_code(spark):
    rows = documents(random.Random(2))
    got = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert len(got) == len(rows)
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    src = {r[0]: r[3] for r in rows}
    total = {s: sum(size[i] for i in src if src[i] == s) for s in set(src.values())}
    t = targets(total)
    order = lambda i: (math.floor(math.log2(size[i] + 1.0) * 8), i % mixing.SLOTS, i)
    for s in total:
        rate = t[s] / total[s] if total[s] else 0.0
        for k, i in enumerate(sorted((i for i in src if src[i] == s), key=order), 1):
            copies = min(3, math.floor(rate * k + mixing.OFFSET) - math.floor(rate * (k - 1) + mixing.OFFSET))
            assert got[i].taken == copies * size[i] and got[i].source_size == total[s]
            assert got[i].target == pytest.approx(t[s]) and got[i].taken <= 3 * size[i]
        near = sum(got[i].taken for i in src if src[i] == s)
        assert abs(near - t[s]) <= 0.05 * t[s] + 250


def test_emitted_rows(spark):
    rows = documents(random.Random(3))
    df = spark.createDataFrame(rows, DOCUMENTS)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    want = {r.id: r.copies for r in mixing.copies(mixing.sized(df)).collect() if r.copies}
    assert n == want


def test_odd_tables(spark):
    assert mixing.mix(spark.createDataFrame([], DOCUMENTS)).collect() == []
    got = mixing.mix(spark.createDataFrame([(1, None, "", "a", 0), (2, "", "", None, 0)], DOCUMENTS)).collect()
    assert [r.taken for r in got] == [0, 0]
    extra = spark.createDataFrame([(1, "a b", "s", 9, 9)], "doc_id long, text string, source string, size int, k int")
    assert mixing.mix(extra).first().taken == 2
    assert mixing.mixed(extra).columns == extra.columns


def test_sql_on_the_smallest_tables(spark):
    import os

    import duckdb

    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no tables here")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.ORACLE})").fetchall()}
    got = {r.doc_id: tuple(r)[1:] for r in mixing.mix(spark.read.parquet(path)).collect()}
    assert got == want


def test_repeated_rows_large_ids_and_names_that_clash(spark):
    rows = [(4_000_000_000, "a b", "s", 1, 2), (4_000_000_000, "a b", "s", 1, 2), (4_000_000_000, "c d", "s", 3, 2), (-(1 << 62), "e f", "s", 4, 2), (None, "g h", "s", 5, 2), (None, "x " * 300_000, "s", 6, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, _id int")
    got = mixing.mix(df).collect()
    assert len(got) == 6 and sum(r.taken for r in got) == sum(r.size for r in got)  # one source: each row once
    out = mixing.mixed(df)
    assert out.columns == df.columns and sorted(out.collect(), key=str) == sorted(df.collect(), key=str)
    other = spark.createDataFrame(rows, "doc_id long, text string, source string, TEXT int, Doc_Id int")
    assert mixing.mix(other).count() == 6
