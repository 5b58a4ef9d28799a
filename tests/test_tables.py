"""Merging, statistics, hits, label transfer, sources and plans."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.functions import values as v
from winnow.operators import cluster, hits, knn, merge, similarity, stats
from winnow.plans import dashboard, pipeline
from winnow.sources import text as src


def test_missing_and_numbers(spark):
    df = spark.createDataFrame([("1", "NA", float("nan")), ("2.5e1", "x", 1.0), (None, "None", None)], "a string, b string, c double")
    got = v.infer_numbers(v.without_missing(df)).collect()
    assert [r.a for r in got] == [1.0, 25.0, None] and [r.b for r in got] == [None, "x", None] and [r.c for r in got] == [None, 1.0, None]
    t = spark.createDataFrame([("1d",), ("nan",), (" 3 ",), ("0x1",), ("-.5",)], "x string")
    assert [r.n for r in t.select(v.number_of(t, "x").alias("n")).collect()] == [None, None, 3.0, None, -0.5]


def test_merge(spark):
    a = spark.createDataFrame([("i1", "1", "NA"), ("i2", "NA", "q")], "ID string, m string, k string")
    b = spark.createDataFrame([("i1", "9"), ("i2", "8"), ("i3", "7")], "fa_id string, m string")
    got = {r.ID: (r.m, r.k) for r in merge.first_wins([a, b]).collect()}
    assert got == {"i1": ("1", None), "i2": ("8", "q"), "i3": ("7", None)}
    seen = {r.ID: r.m for r in merge.first_wins([a, b], keep_blank=True).collect()}
    assert seen == {"i1": "1", "i2": None, "i3": "7"}
    wide = spark.createDataFrame([("i1", *["1"] * 300)], ["ID", *[f"c{i}" for i in range(300)]])
    assert merge.first_wins([a, wide], max_columns=256).columns == ["ID", "m", "k"]
    assert len(merge.first_wins([a, wide]).columns) == 303


def test_statistics(spark):
    df = spark.createDataFrame([(10.0, "a", True), (20.0, "a", True), (30.0, "b", False), (40.0, None, None), (None, "c", None)], "x double, g string, f boolean")
    s = {(r.labeling, r.label): r for r in stats.numeric_stats(df, ["x"], ["g"]).collect()}
    r = s[None, None]
    assert (r.n, r.n_missing, r.mean, r.p25, r.p75) == (4, 1, 25.0, 17.5, 32.5) and r.std == pytest.approx((500 / 3) ** 0.5)
    assert s["g", "b"].std == 0.0 and s["g", "c"].n == 0 and s["g", "c"].mean is None and ("g", None) not in s
    assert {(x.value, x.freq) for x in stats.categorical_stats(df, "f").collect()} == {("True", 2), ("False", 1)}
    kinds = stats.classify(df.withColumn("t", F.lit("5")).withColumn("u", F.lit("z")), ["x", "g", "f", "t", "u"])
    assert kinds == {"x": "numeric", "g": "categorical", "f": "categorical", "t": "numeric", "u": "categorical"}
    bands = stats.export_bands(stats.numeric_stats(df, ["x"]), {"x": {"min": "p25", "max": None}})
    assert json.loads(stats.bands_json(bands)) == {"x": {"min": 17.5}}
    assert json.loads(stats.stats_json(stats.numeric_stats(df, ["x"])))["metrics"]["x"]["count" if False else "n"] == 4
    m = {r.g: r.label for r in stats.mode_label(spark.createDataFrame([("k", "FPP"), ("k", "GPP"), ("k", None)], "g string, l string"), "g", "l", {"GPP": 10, "FPP": 15}).collect()}
    assert m == {"k": "GPP"}


def test_hits(spark):
    h = spark.createDataFrame([("q", "t1", 90.0, 50.0, 0.5), ("q", "t2", 95.0, 50.0, 0.6), ("q", "q", 100.0, 99.0, 1.0), ("r", "t1", 10.0, 5.0, 0.1), ("r", "t1", 12.0, 6.0, 0.1)], "query string, target string, identity double, bits double, score double")
    assert {r.query: r.target for r in hits.best_hits(h, True).collect()} == {"q": "t2", "r": "t1"}
    top = [(r.query_id, r.rank, r.neighbour_id) for r in hits.top_k_hits(h, 2, True).orderBy("query_id", "rank").collect()]
    assert top == [("q", 1, "t2"), ("q", 2, "t1"), ("r", 1, "t1")]
    members = spark.createDataFrame([("T2.1",)], "member string")
    assert [r.is_member for r in hits.membership(h.filter("target = 't2'"), "target", members).collect()] == [True]
    e = spark.createDataFrame([("d", "ref_E1_A"), ("d", "weird_id")], "query_id string, neighbour_id string")
    assert sorted(r.neighbour_id for r in hits.strip_chain(e, spark.createDataFrame([("ref_E1",)], "id string")).collect()) == ["ref_E1", "weird_id"]
    p = hits.panel_match(spark.createDataFrame([("ref1_x",), ("re",), ("ref1",)], "id string"), spark.createDataFrame([("ref1",)], "reference_id string"))
    assert {r.id: r.reference_id for r in p.collect()} == {"ref1_x": "ref1", "re": "ref1", "ref1": "ref1"}


def test_calibrate_and_transfer(spark):
    refs = {f"r{i}": "A" if i < 15 else "B" for i in range(30)}
    rows = []
    for a, la in refs.items():
        near = sorted(refs, key=lambda b: (refs[b] != la, b))
        rows += [(a, k + 1, b, 85.0 if refs[b] == la else 20.0) for k, b in enumerate([x for x in near if x != a][:5] + [x for x in near if refs[x] != la][:2])]
    edges = spark.createDataFrame(rows, "query_id string, rank int, neighbour_id string, score double")
    labels = spark.createDataFrame(list(refs.items()), "id string, label string")
    cal = knn.calibrate({"sequence": edges}, labels)
    assert cal["spaces"]["sequence"]["accuracy"] == 1.0 and cal["spaces"]["sequence"]["tau"] == 0.40 and cal["ensemble"]["n_predicted"] == 30
    d = spark.createDataFrame([("d1", 1, "r1", 80.0), ("d1", 2, "r2", 78.0), ("d2", 1, "r1", 12.0), ("d2", 2, "r20", 10.0)], "query_id string, rank int, neighbour_id string, score double")
    got = {r.query_id: r for r in knn.transfer({"sequence": d}, labels, cal).collect()}
    assert got["d1"].label == "A" and got["d1"].confidence == 1.0
    assert got["d2"].label == "unknown" and got["d2"].confidence == 0.0 and got["d2"].sequence_nn_similarity == pytest.approx(0.12)
    with pytest.raises(ValueError):
        knn.similarity("colour", F.lit(1))


def test_curve_leaves_out_one_and_looks_down(spark):
    rec = spark.createDataFrame([("a", 1.0, 1.0), ("b", 0.96, 1.0), ("c", 0.35, 0.0), ("d", 0.15, 1.0)], "query_id string, nn double, correct double")
    c = {r.lo: (r.n, r.accuracy) for r in knn.calibration_curve(rec).collect()}
    assert c[0.95] == (1, 1.0) and c[0.35] == (1, 0.0) and c[0.15] == (1, 1.0) and sum(x[0] for x in c.values()) == 3
    curve = [{"lo": lo, "hi": lo + 0.05, "n": n, "accuracy": a} for lo, (n, a) in sorted(c.items())]
    x = spark.createDataFrame([(0.36,), (0.6,), (1.0,), (0.01,), (None,)], "s double").select(knn.calibrated(F.col("s"), curve).alias("c"))
    assert [r.c for r in x.collect()] == [0.0, 0.0, 1.0, 1.0, None]


def test_neighbours_and_blocks(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(60)] + [(60, x[3].tolist())], "vec_id long, embedding array<double>")
    a = sorted(map(tuple, similarity.nearest(df, df, 4, self_mode=True).collect()))
    b = sorted(map(tuple, similarity.nearest(df, df, 4, self_mode=True, block_rows=7).collect()))
    assert [r[:3] for r in a] == [r[:3] for r in b] and [r for r in a if r[0] == 3][0][2] == 60
    one = df.filter("vec_id = 1")
    assert similarity.min_distance(one, one, self_mode=True).first().hit is None


def score_of(x, y, match=4, mismatch=-2, opening=-11, extend=-1):
    total, gap = 0, None
    for p, q in zip(x, y, strict=True):
        if p == "-" or q == "-":
            kind = "a" if p == "-" else "b"
            total += extend if gap == kind else opening
            gap = kind
        else:
            total += match if p == q else mismatch
            gap = None
    return total


def best_score(a, b):
    from functools import lru_cache

    @lru_cache(None)
    def f(i, j, gap):
        if i == len(a) and j == len(b):
            return 0
        out = []
        if i < len(a) and j < len(b):
            out.append((4 if a[i] == b[j] else -2) + f(i + 1, j + 1, None))
        if j < len(b):
            out.append((-1 if gap == "a" else -11) + f(i, j + 1, "a"))
        if i < len(a):
            out.append((-1 if gap == "b" else -11) + f(i + 1, j, "b"))
        return max(out)

    return f(0, 0, None)


def test_alignment():
    import random

    r = random.Random(1)
    for _ in range(120):
        a, b = ("".join(r.choices("ACD", k=r.randint(0, 9))) for _ in range(2))
        s, x, y = similarity.align(a, b)
        assert x.replace("-", "") == a and y.replace("-", "") == b
        if a or b:
            assert s == score_of(x, y) == best_score(a, b)
    assert similarity.pair_metrics("AAAA", "SSSS", {("A", "S"): 1, ("A", "A"): 4, ("S", "S"): 4}) == (0.0, 1.0)


def test_clusters(spark):
    base = "MKTAYIAKQRQISFVKSHFSRQLEERLGLIEVQ"
    df = spark.createDataFrame([("a", base + "AA"), ("b", base), ("c", base.replace("R", "K", 1)), ("z", "WWWWWPPPPPGGGGGWWWWWHHHHHCCCCC"), ("n", None)], "ID string, sequence string")
    got = {r.member: r.representative for r in cluster.cluster_sequences(df, 0.7).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "z": "z"}


def test_fasta(spark, tmp_path):
    p = tmp_path / "x.fasta"
    p.write_text(">d1 first\nMK-V\nLL\n>d2\nAA\n>d1 first\nGG\n")
    df = src.read_fasta(spark, str(p), token=True)
    assert {(r.id, r.sequence) for r in df.collect()} == {("d1", "MKVLL"), ("d2", "AA"), ("d1", "GG")}
    assert {r.id: r.sequence for r in src.fasta_map(df).collect()} == {"d1": "GG", "d2": "AA"}
    assert src.read_fasta(spark, str(p), keep_gaps=True).filter("sequence LIKE '%-%'").count() == 1
    out = str(tmp_path / "out")
    src.write_fasta(src.fasta_map(df), out, 1)
    assert {(r.id, r.sequence) for r in src.read_fasta(spark, out).collect()} == {("d1", "GG"), ("d2", "AA")}
    assert src.result_paths("a/b.fa", ["knn"]) == {"knn": "a/b_knn.csv"}
    with pytest.raises(ValueError):
        src.result_paths("b.txt", [])


def test_tables_of_tools(spark, tmp_path):
    (tmp_path / "fs.tsv").write_text("\t".join(["q", "t", "0.5", "10", "x", "0", "1", "2", "3", "4", "1e-5", "50", "0.9", "nan", "0.7", "0.6"]) + "\n")
    r = src.read_foldseek(spark, str(tmp_path / "fs.tsv")).first()
    assert (r.fident, r.mismatch, r.qtmscore, r.evalue) == (0.5, None, None, 1e-5)
    (tmp_path / "l.csv").write_text("name,cls\na,1\na,2\nb,NaN\n")
    assert {x.id: x.label for x in src.read_labels(spark, str(tmp_path / "l.csv")).collect()} == {"a": "2"}
    (tmp_path / "p.csv").write_text("# note\nreference_id,resnum,expected_residue\nT,274,S\nT,x,S\n")
    assert [x.resnum for x in src.read_panel(spark, str(tmp_path / "p.csv")).collect()] == [274]
    (tmp_path / "d.csv").write_text("Name,aa_seq\nk,MK\n")
    assert src.read_designs(spark, str(tmp_path / "d.csv")).first() == ("k", "MK")
    assert src.resolve_paths(spark, [f"{tmp_path}/l.csv", f"{tmp_path}/*.csv"])[0].endswith("l.csv")
    e = spark.createDataFrame([("a", "[1.0, 2.5]")], "ID string, embedding string")
    assert src.read_vectors(e).first().embedding == [1.0, 2.5]
    w = spark.createDataFrame([("a", 1.0, 2.0)], "id string, e0 double, e1 double")
    assert src.read_vectors(w).first().embedding == [1.0, 2.0]
    j = json.loads(src.fold_inputs(spark.createDataFrame([('x"1', "MK", "CC")], "ID string, p string, l string"), ["p"], ["l"], []).first().json)
    assert j["name"] == 'x"1' and j["sequences"][0]["protein"]["id"] == ["A"] and j["sequences"][1]["ligand"]["smiles"] == "CC"


def test_engine_and_funnel(spark, tmp_path):
    made = []

    def step(name, deps=(), **kw):
        return pipeline.Step(name, lambda inputs, n=name: made.append((n, sorted(inputs))) or spark.createDataFrame([(n,)], "x string"), list(deps), **kw)

    steps = [step("a"), step("b", ["a"]), step("gpu", needs=["gpu"]), step("c", ["gpu"]), step("d", ["b"], soft_deps=["c"])]
    e = pipeline.Engine(spark, str(tmp_path))
    assert set(e.run(steps)) == {"a", "b", "d"} and dict(e.log)["c"] == "waits for gpu"
    e2 = pipeline.Engine(spark, str(tmp_path))
    e2.run(steps)
    assert dict(e2.log)["a"] == "exists" and made == [("a", []), ("b", ["a"]), ("d", ["b"])]
    assert pipeline.enabled({"a": True, "b": False}, None, ["b"], ["a"]) == {"b"}
    pool = spark.createDataFrame([(f"i{k}", float(k)) for k in range(10)], "ID string, v double")
    tiers = [{"spec": {"ops": [{"op": "gate", "conditions": [{"col": "v", "ge": 3}]}]}}, {"metrics": [lambda s: s.select("ID", (F.col("v") * 10).alias("w"))], "spec": {"ops": [{"op": "gate", "conditions": [{"col": "w", "ge": 80}]}]}}]
    assert sorted(r.ID for r in pipeline.run_funnel(spark, pool, tiers, f"{tmp_path}/funnel").collect()) == ["i8", "i9"]


def test_dashboard(spark):
    df = dashboard.demo_batch(spark, {"m": (0.0, 1.0)})
    data = dashboard.build({"demo": df}, {}, {"m": "numeric"}, sample=5, large=3)
    assert len(data["sets"]["demo"]["ids"]) == 5 and data["sets"]["demo"]["large"]
    import base64

    assert len(base64.b64decode(data["sets"]["demo"]["values"]["m"]["data"])) == 20
    assert "</script" not in dashboard.render({"x": "</script>"}, "<script>__DATA__")
    assert dashboard.tool_label("x/run_plddt.csv", {"plddt": "pLDDT", "t": "T"}) == "pLDDT"


def test_stream(spark, tmp_path):
    from winnow.streaming.ingest import ingest_available

    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.csv").write_text(f"ID,v\ni{k},{k}\n")
        ingest_available(spark, str(tmp_path / "in"), "ID string, v double", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == k + 1
