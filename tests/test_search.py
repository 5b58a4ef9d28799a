"""Nearest vectors among ties and greedy clusters, against brute force."""

import random

import numpy as np

from winnow.operators import cluster, hits, similarity


def test_ties_go_to_the_least_id(spark):
    r = random.Random(1)
    rows = [(i, [1.0, 2.0]) for i in range(1000, 0, -2)] + [(i, [float(r.randrange(4)), float(r.randrange(4))]) for i in range(1, 1000, 2)]
    v = {i: np.array(x) for i, x in rows}
    got: dict = {}
    for x in similarity.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2, self_mode=True, block_rows=300).collect():
        got.setdefault(x.query_id, {})[x.rank] = (x.neighbour_id, round(x.score, 9))
    for i in list(v)[:60] + list(v)[-60:]:
        want = sorted((round(float(np.linalg.norm(v[i] - v[j])), 9), j) for j in v if j != i)[:2]
        assert got[i] == {k + 1: (j, d) for k, (d, j) in enumerate(want)}


def every_distance(vectors, queries, k, apart):
    out = {}
    for i, x in queries:
        d = sorted((round(float(np.linalg.norm(np.array(x) - np.array(y))), 9), j) for j, y in vectors if not (apart and i == j))
        out[i] = [(j, v) for v, j in d[:k]]
    return out


def test_search_by_pivots_against_every_distance(spark, monkeypatch):
    """Clusters, a third of all rows alike, several blocks a pivot, pivots without members, and queries far from all."""
    r = random.Random(4)
    centres = [[r.gauss(0, 10) for _ in range(5)] for _ in range(8)]
    rows = [(i, [x + r.gauss(0, 0.5) for x in centres[i % 8]]) for i in range(400)] + [(i, [1.0] * 5) for i in range(400, 600)]
    df = spark.createDataFrame([*rows, (1000, None), (None, [0.0] * 5)], "vec_id long, embedding array<double>")
    asked = [x for x in rows if x[0] % 7 == 0 or 395 <= x[0] < 410] + [(2000, [500.0] * 5), (2001, [1.0] * 5)]
    q = spark.createDataFrame(asked, "vec_id long, embedding array<double>")
    for k, block, pivot, apart in ((3, 40, 30, True), (1, 40, 100, False), (300, 64, 50, True), (5, 4096, 16_384, True)):
        got: dict = {}
        for x in similarity.nearest(q, df, k, self_mode=apart, block_rows=block, pivot_rows=pivot).orderBy("query_id", "rank").collect():
            got.setdefault(x.query_id, []).append((x.neighbour_id, round(x.score, 9)))
        assert got == every_distance(rows, asked, k, apart)
    assert similarity.nearest(q, df.limit(0), 2).collect() == [] and similarity.nearest(q.limit(0), df, 2, pivot_rows=50).collect() == []


def test_equal_vectors_are_looked_for_once_and_the_search_runs_once(spark, monkeypatch):
    """Most rows alike: one row a vector is asked for, k + 1 of each can be found, and readers of the result search no more."""
    met, plain = [], similarity._met

    def counted(queries, ref, *a, **kw):
        met.append((queries.count(), ref.count()))
        return plain(queries, ref, *a, **kw)

    monkeypatch.setattr(similarity, "_met", counted)
    rows = [(i, [float(i % 3)]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = similarity.nearest(df, df, 2, self_mode=True)
    assert met == [(3, 9)]
    got: dict = {}
    for x in found.orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.neighbour_id, round(x.score, 9)))
    assert got == every_distance(rows, rows, 2, True)
    assert "FlatMapGroups" not in found._jdf.queryExecution().toString()


def test_first_look_in_single_precision_loses_none(spark):
    """Far from the origin, near each other, of any scale, with values that are no numbers."""
    r = np.random.default_rng(5)
    for offset, scale in ((0.0, 1.0), (1e6, 1e-3), (-1e3, 1e-9), (0.0, 1e30), (0.0, 1e-30)):
        b = offset + scale * r.normal(size=(3000, 8))
        b[::500] = np.nan
        b[1::500] = np.inf
        a, ids = b[:40], np.arange(3000)
        got: dict = {}
        for part in similarity._k_nearest(ids[:40], a, ids, b, 7):
            for q, n in zip(part["query_id"], part["neighbour_id"], strict=True):
                got.setdefault(q, []).append(n)
        fine = np.isfinite(b).all(1)
        for i in range(40):
            if not fine[i]:
                assert i not in got
                continue
            d = np.sqrt(((a[i] - b[fine]) ** 2).sum(1)).round(12)
            assert got[i] == ids[fine][np.lexsort((ids[fine], d))[:7]].tolist(), (offset, scale, i)


def test_blocks_of_short_vectors_hold_more_rows(spark, monkeypatch):
    """Blocks are bounded by their numbers, so that short vectors are copied to few of them, and long ones don't fill a task."""
    from pyspark.sql import functions as F

    class Asked(Exception):
        pass

    def blocks(queries, ref, blocks, *a):
        raise Asked(blocks[0])

    monkeypatch.setattr(similarity, "_met", blocks)
    short = spark.range(140_000).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double")).alias("embedding"))
    long = spark.range(10_000).select(F.col("id").alias("vec_id"), F.array_repeat(F.col("id").cast("float"), 4096).alias("embedding"))
    for df, most in ((short, 4), (long, 3)):  # 4 cores: four blocks by four, each of a fourth of the rows, but of 4,096 rows at least
        try:
            similarity.nearest(df, df, 2, self_mode=True, pivot_rows=1 << 30)
        except Asked as e:
            assert e.args == (most,)


def test_all_pairs_meet_without_copies_of_rows(spark, monkeypatch):
    """However many blocks there are, a query has few lists to merge, and no vector is copied to the blocks of the other side."""
    met, plain = [], similarity._met
    monkeypatch.setattr(similarity, "_met", lambda *a, **kw: met.append(plain(*a, **kw)) or met[-1])
    r = random.Random(6)
    rows = [(f"v{i:03}", [r.gauss(0, 1) for _ in range(6)]) for i in range(600)] + [("w", None), ("x", [float("nan")] * 6), ("y", [0.0] * 5 + [None])]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    got: dict = {}
    for x in similarity.nearest(df, df, 4, self_mode=True, block_rows=30).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.neighbour_id, round(x.score, 9)))
    single = [(i, [float(np.float32(y)) for y in v]) for i, v in rows[:600]]
    assert got == every_distance(single, single, 4, True)
    lists = met[0].groupBy("query_id").count().agg({"count": "max"}).first()[0]
    assert lists <= similarity.REF_PARTS < 600 // 30
    assert "Generate" not in met[0]._jdf.queryExecution().toString()


def test_references_that_come_in_blocks(spark):
    """Each block's bound is that of all before: the same as all at once, of any scale, with ties over blocks and values that are no numbers."""
    r = np.random.default_rng(7)
    for offset, scale in ((0.0, 1.0), (1e6, 1e-3), (-1e3, 1e-9), (0.0, 1e30), (0.0, 1e-30)):
        b = offset + scale * r.normal(size=(3000, 8)) * (1 + 9 * (np.arange(3000) % 2))[:, None]
        b[2000:2600] = b[:600]
        b[::500] = np.nan
        b[1::500] = np.inf
        ids = r.permutation(3000)
        one = similarity._Nearest(b[:700], 7)
        for at in (*range(0, 60, 3), *range(60, 3000, 490)):
            to = at + 3 if at < 60 else at + 490
            one.meet(ids[at:to], b[at:to])
        row, found, _ = one.result()
        fine = np.isfinite(b).all(1)
        for i in range(0, 700, 7):
            d = np.sqrt(((b[i] - b[fine]) ** 2).sum(1)).round(12) if fine[i] else np.zeros(0)
            assert found[row == i].tolist() == (ids[fine][np.lexsort((ids[fine], d))[:7]].tolist() if fine[i] else []), (offset, scale, i)


def test_few_pairs_are_looked_at_exactly(monkeypatch):
    """References that come nearer and nearer: all pass the bound of the first ones, few that of all."""
    exactly, plain = [], np.lexsort

    def counted(keys):
        exactly.append(len(keys[-1]))
        return plain(keys)

    b = np.arange(10_000.0, 0, -1)[:, None] * np.ones(3)
    a, ids = np.arange(-20.0, 0)[:, None] * np.ones(3), np.arange(10_000)
    with monkeypatch.context() as m:
        m.setattr(np, "lexsort", counted)
        got = next(iter(similarity._k_nearest(ids[:20], a, ids, b, 5)))
    assert got["neighbour_id"].tolist() == list(range(9999, 9994, -1)) * 20
    assert sum(exactly) < 20 * 1000


def plain_greedy(seqs, threshold, coverage):
    """Longest first: a sequence joins the first representative that fits, else becomes one."""
    reps, out = [], {}
    for i in sorted(seqs, key=lambda x: (-len(seqs[x]), x)):
        for c in reps:
            ident, cov = cluster.identity_and_coverage(seqs[c], seqs[i])
            if ident >= threshold and cov >= coverage:
                out[i] = c
                break
        else:
            reps.append(i)
            out[i] = i
    return out


def test_clusters_against_plain_greedy(spark):
    r = random.Random(2)
    seqs = {}
    for f in range(6):
        base = "".join(r.choices("ACDEFGHIKLMNPQRSTVWY", k=60 + 10 * f))
        for k in range(6):
            s = list(base[: len(base) - r.randrange(14)])
            for at in r.sample(range(len(s)), r.randrange(0, 24)):
                s[at] = r.choice("ACDEFGHIKLMNPQRSTVWY")
            seqs[f"s{f}{k}"] = "".join(s)
    seqs["long"] = seqs["s00"] + "".join(r.choices("ACDEFGHIKLMNPQRSTVWY", k=90))  # holds another's k-mers
    seqs["twin"] = seqs["s00"]
    df = spark.createDataFrame(list(seqs.items()), "ID string, sequence string")
    want = plain_greedy(seqs, 0.7, 0.8)
    exact = {x.member: x.representative for x in cluster.cluster_sequences(df, shared=0).collect()}
    assert exact == want
    fast = {x.member: x.representative for x in cluster.cluster_sequences(df).collect()}
    assert sum(fast[i] == want[i] for i in want) >= 0.9 * len(want)
    assert fast["twin"] == fast["s00"]


def test_panel_prefixes_and_empty_sides(spark):
    ids = spark.createDataFrame([("a_1",), ("a",), ("b",), (None,), ("zz",)], "id string")
    panel = spark.createDataFrame([("a",), ("b_7",), (None,), ("b_2",)], "reference_id string")
    assert {(x.id, x.reference_id) for x in hits.panel_match(ids, panel).collect()} == {("a_1", "a"), ("a", "a"), ("b", "b_2")}
    assert hits.panel_match(ids, panel.limit(0)).collect() == [] and hits.panel_match(ids.limit(0), panel).collect() == []


def test_gc_windows_against_every_window(spark):
    from winnow.functions import seq

    r = random.Random(3)
    texts = ["".join(r.choices("ACGTgcn", k=n)) for n in (1, 4, 49, 50, 51, 400)] + ["", None, "GC" * 60_000]
    lo, hi = seq.gc_window(__import__("pyspark.sql.functions").sql.functions.col("s"), 50)
    got = {x.i: (x.lo, x.hi) for x in spark.createDataFrame(list(enumerate(texts)), "i int, s string").select("i", lo.alias("lo"), hi.alias("hi")).collect()}
    for i, t in enumerate(texts[:6]):
        w = min(50, len(t))
        f = [sum(x in "GCgc" for x in t[k : k + w]) / w for k in range(len(t) - w + 1)]
        assert got[i] == (min(f), max(f))
    assert got[6] == got[7] == (None, None) and got[8] == (1.0, 1.0)
