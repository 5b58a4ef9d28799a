"""Row numbers under any splits, whole-file statistics, sinks read back, command lines, scaling of distances."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnow.__main__ import main
from winnow.functions import geometry, seq
from winnow.operators import stats
from winnow.sources import lines
from winnow.sources import text as src


def under(spark, size, f):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        return f()
    finally:
        spark.conf.set(key, old)


def test_row_numbers_do_not_depend_on_splits(spark, tmp_path):
    """One split and some fifty, three files, one of them empty; the last row of an id wins in each."""
    for k, n in enumerate((700, 0, 500)):
        (tmp_path / f"f{k}.csv").write_text("id,label\n" + "".join(f"i{(k * 700 + j) % 400},l{k}_{j}\n" for j in range(n)))
    read = lambda: spark.read.option("header", True).csv(str(tmp_path))
    rows = lambda: [(r.row, r.id, r.label) for r in lines.numbered(read()).orderBy("row").collect()]
    want = [(j, f"i{j % 400}", f"l0_{j}") for j in range(700)] + [(700 + j, f"i{(1400 + j) % 400}", f"l2_{j}") for j in range(500)]
    for size in (1 << 27, 400):
        assert under(spark, size, rows) == want
    assert under(spark, 400, lambda: read().rdd.getNumPartitions()) > 20
    last = {i: label for _, i, label in want}
    for size in (1 << 27, 400):
        assert under(spark, size, lambda: {r.id: r.label for r in src.read_labels(spark, str(tmp_path)).collect()}) == last
    fasta = tmp_path / "x.fasta"
    fasta.write_text("".join(f">s{j % 60} x\nAC{'D' * (j % 7)}\nEF\n" for j in range(300)))
    for size in (1 << 27, 300):
        got = under(spark, size, lambda: {r.id: r.sequence for r in src.fasta_map(src.read_fasta(spark, str(fasta), token=True)).collect()})
        assert got == {f"s{j % 60}": f"AC{'D' * (j % 7)}EF" for j in range(300)}


def test_labels_by_position(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n" + "".join(f"{j},{j * 2}\n" for j in range(300)))
    (tmp_path / "b.csv").write_text("cls\n" + "".join(f"c{j % 3}\n" for j in range(300)))
    a, b = (lines.numbered(spark.read.option("header", True).csv(str(tmp_path / x))) for x in ("a.csv", "b.csv"))
    got = under(spark, 500, lambda: lines.labels_by_position(a, b, "cls").collect())
    assert len(got) == 300 and all(r.label == f"c{int(r.x) % 3}" for r in got)
    with pytest.raises(ValueError, match="299 labels"):
        lines.labels_by_position(a, b.where("row < 299"), "cls")


def test_statistics_of_a_whole_table(spark):
    """Against pandas and numpy: numbers as text, flags, an empty column, ties, classes of two labelings."""
    rng = np.random.default_rng(1)
    n = 400
    df = pd.DataFrame({"ID": [f"i{k}" for k in range(n)], "num": [None if k % 9 == 0 else str(round(1e6 + rng.normal(), 3)) for k in range(n)], "tie": [str(k % 4) for k in range(n)], "flag": ["True" if k % 3 else "False" for k in range(n)], "mixed": ["x" if k == 5 else str(k) for k in range(n)], "none": [None] * n})
    spread = spark.createDataFrame(df.values.tolist(), "ID string, num string, tie string, flag string, mixed string, none string").repartition(4)
    first = spark.createDataFrame([(f"i{k}", f"c{k % 5}") for k in range(0, n, 2)], "id string, label string")
    summary, freq = stats.table_statistics(spread, {"first": first, "other": first.where("label = 'c0'")})
    got = {(r.stat_column, r.labeling, r.label): r for r in summary.collect()}
    assert len(got) == 5 * (1 + 5 + 1)
    classes = {(None, None): df, **{("first", f"c{c}"): df[[k % 2 == 0 and k % 5 == c for k in range(n)]] for c in range(5)}}
    classes["other", "c0"] = classes["first", "c0"]
    for (labeling, label), part in classes.items():
        for c in ("num", "tie"):
            x = part[c].dropna().astype(float).to_numpy()
            r = got[c, labeling, label]
            assert (r.kind, r.n, r.n_missing, r.n_unique) == ("numeric", len(x), len(part) - len(x), None)
            assert r.mean == pytest.approx(x.mean(), rel=1e-12) and r.std == pytest.approx(x.std(ddof=1), rel=1e-6) and (r.min, r.max) == (x.min(), x.max())
            assert [r[k] for k in stats.PERCENTS] == pytest.approx([np.quantile(x, p) for p in stats.PERCENTS.values()], rel=1e-12)
        for c in ("flag", "mixed"):
            r = got[c, labeling, label]
            assert (r.kind, r.n, r.n_unique, r.mean) == ("categorical", len(part), part[c].nunique(), None)
    assert (got["none", None, None].kind, got["none", None, None].n, got["none", None, None].n_missing) == ("categorical", 0, n)
    f = {(r.stat_column, r.value): r.freq for r in freq.where("labeling IS NULL").collect()}
    assert {k[1]: v for k, v in f.items() if k[0] == "flag"} == df["flag"].value_counts().to_dict() and not any(k[0] in ("num", "tie") for k in f)


def test_sinks_read_back(spark, tmp_path):
    edges = spark.createDataFrame([("q2", 1, "b", 0.25), ("q1", 2, 'a "x", y', 1e-12), ("q1", 1, "c", 3.0)], "query_id string, rank int, neighbour_id string, score double")
    src.write_top_k(edges.repartition(3), str(tmp_path / "top"))
    back = src.read_top_k(spark, str(tmp_path / "top"))
    assert [tuple(r) for r in back.orderBy("query_id", "rank").collect()] == [("q1", 1, "c", 3.0), ("q1", 2, 'a "x", y', 1e-12), ("q2", 1, "b", 0.25)]
    near = spark.createDataFrame([("b", 0.5, "x"), ("a", None, None)], "ID string, min_embedding_distance double, hit string")
    src.write_nearest(near, str(tmp_path / "near"))
    assert [tuple(r) for r in src.read_nearest(spark, str(tmp_path / "near")).orderBy("ID").collect()] == [("a", None, None), ("b", 0.5, "x")]


def test_given_scores_and_substances(spark):
    d = spark.createDataFrame([("a", 2.0), ("a", float("nan")), ("a", 1.0), ("a", None), ("b", float("inf"))], "ID string, rmsd double")
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "ID string")
    assert {r.ID: (r.sc_rmsd_min, r.sc_rmsd_mean, r.n_samples) for r in stats.self_consistency(d, ids).collect()} == {"a": (1.0, 1.5, 2), "b": (None, None, 0), "c": (None, None, 0)}
    s = spark.createDataFrame([("gpp",), ("DMAPP",), ("EDSQ",), (None,)], "c string").select("c", seq.smiles(F.col("c")).alias("s"), seq.cofoldable(F.col("c")).alias("k"))
    assert {r.c: (r.s is not None, r.k) for r in s.collect()} == {"gpp": (True, True), "DMAPP": (True, False), "EDSQ": (False, False), None: (False, False)}


def test_command_lines(spark, tmp_path):
    for name, rows in (("a", "ID,score,cls\nx,1,u\ny,5,u\nz,3,v\n"), ("b", "id,plddt\nx,90\ny,95\nz,20\nw,99\n")):
        (tmp_path / f"{name}.csv").write_text(rows)
    out, glob = str(tmp_path / "wide"), str(tmp_path / "?.csv")
    main(["merge", "--entries", glob, "--output", out], spark)
    assert {(r.ID, r.score, r.plddt) for r in spark.read.option("header", True).csv(out).collect()} == {("x", "1", "90"), ("y", "5", "95"), ("z", "3", "20"), ("w", None, "99")}
    spec = {"group_by": "cls", "n_out_per_group": 1, "ops": [{"op": "gate", "conditions": [{"col": "plddt", "ge": 50}]}, {"op": "score", "terms": [{"col": "score", "direction": "higher"}]}]}
    (tmp_path / "spec.json").write_text(json.dumps(spec))
    (tmp_path / "s.fasta").write_text(">x\nAC\n>y\nACD\n")
    main(["select", "--entries", glob, "--spec", str(tmp_path / "spec.json"), "--output-prefix", str(tmp_path / "run"), "--fasta", str(tmp_path / "s.fasta")], spark)
    assert [(r.ID, r.sequence) for r in spark.read.parquet(str(tmp_path / "run_survivors.parquet")).collect()] == [("y", "ACD")]
    tiers = {"tiers": [{"spec": {"ops": [{"op": "gate", "conditions": [{"col": "cls", "notnull": True}]}]}}, {"metrics": [str(tmp_path / "b.csv")], "spec": {"ops": [{"op": "gate", "conditions": [{"col": "plddt", "ge": 50}]}]}}]}
    (tmp_path / "f.json").write_text(json.dumps(tiers))
    main(["funnel", "--entries", str(tmp_path / "a.csv"), "--spec", str(tmp_path / "f.json"), "--folder", str(tmp_path / "funnel")], spark)
    assert sorted(r.ID for r in spark.read.parquet(str(tmp_path / "funnel/tier_1")).collect()) == ["x", "y"]
    with pytest.raises(ValueError, match="no tables"):
        main(["merge", "--entries", str(tmp_path / "none*.csv"), "--output", out], spark)


def test_scaling_of_distances(spark):
    """Agrees with the dense form, for distances that are Euclidean and for others."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 6)) * [9, 5, 1, 1, 1, 1]
    for d in (np.linalg.norm(x[:, None] - x[None], axis=2), np.abs(x[:, None] - x[None]).sum(2) ** 1.4):
        rows = [(f"p{i:03}", f"p{j:03}", float(d[i, j])) for i in range(150) for j in range(150) if i != j]
        out, values = geometry.pcoa(spark.createDataFrame(rows, "a string, b string, d double"))
        want, _ = geometry.pcoa_2d(d)
        got = np.array([[r.pc1, r.pc2] for r in out.orderBy("id").collect()])
        assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-5 * np.abs(want).max() and values[0] >= values[1] > 0
