"""Gates, bands, scores, top-N, specificity, diversity and the interpreter."""

import json
import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import gate
from winnow.operators import select as sel


@pytest.fixture()
def frame(spark):
    rows = [("a1", "c0", 1.0, "x", True, "True"), ("a2", "c0", None, "y", None, None), ("b1", "c1", 3.0, "x", False, "False"), ("b2", None, float("nan"), "y", False, "1"), ("b3", "c1", 5.0, "7", True, "0")]
    return spark.createDataFrame(rows, "ID string, cls string, x double, s string, flag boolean, text string")


def ids(df):
    return sorted(r.ID for r in df.collect())


@pytest.mark.parametrize(
    ("cond", "want"),
    [
        ({"col": "x", "ge": 3}, ["b1", "b3"]), ({"col": "x", "isnull": True}, ["a2", "b2"]), ({"col": "x", "notnull": True}, ["a1", "b1", "b3"]), ({"col": "x", "between": [1, 3]}, ["a1", "b1"]),
        ({"col": "flag", "eq": False}, ["b1", "b2"]), ({"col": "flag", "ne": False}, ["a1", "b3"]), ({"col": "text", "eq": True}, ["a1", "b2"]), ({"col": "text", "ne": True}, ["b1", "b3"]),
        ({"col": "s", "in": ["x", 7]}, ["a1", "b1"]), ({"col": "s", "in": [7]}, []), ({"col": "s", "not_in": ["x"]}, ["a2", "b2", "b3"]), ({"col": "s", "lt": 8}, ["b3"]), ({"any_of": []}, []), ({"all_of": []}, ["a1", "a2", "b1", "b2", "b3"]),
        ({"when": {"col": "cls", "eq": "c1"}, "col": "x", "ge": 4}, ["a1", "a2", "b2", "b3"]),
    ],
)
def test_gate(frame, cond, want):
    assert ids(gate.apply_gate(frame, [cond])) == want


def test_gate_errors(frame):
    for bad in ({"col": "nope", "eq": 1}, {"col": "x"}):
        with pytest.raises(ValueError):
            gate.apply_gate(frame, [bad])


def plain(row, c):
    """A naive evaluator of the same conditions."""
    if "when" in c:
        return not plain(row, c["when"]) or plain(row, {k: v for k, v in c.items() if k != "when"})
    if "all_of" in c:
        return all(plain(row, x) for x in c["all_of"])
    if "any_of" in c:
        return any(plain(row, x) for x in c["any_of"])
    v = row[c["col"]]
    v = None if v is None or v != v else v
    if "isnull" in c:
        return v is None
    if v is None:
        return False
    return {"eq": lambda t: v == t, "ne": lambda t: v != t, "lt": lambda t: v < t, "ge": lambda t: v >= t, "in": lambda t: v in t}[op := next(k for k in c if k != "col")](c[op])


def tree(r, depth):
    if depth and r.random() < 0.6:
        kind = r.choice(["all_of", "any_of", "when"])
        if kind == "when":
            return {"when": tree(r, depth - 1), **leaf(r)}
        return {kind: [tree(r, depth - 1) for _ in range(r.randint(0, 3))]}
    return leaf(r)


def leaf(r):
    if r.random() < 0.5:
        return {"col": "x", r.choice(["lt", "ge", "eq", "ne"]): float(r.randint(0, 5))}
    return r.choice([{"col": "s", "in": ["x", "y"]}, {"col": "s", "eq": "x"}, {"col": "s", "isnull": True}])


def test_gate_trees(spark):
    r = random.Random(0)
    rows = [(f"i{k}", r.choice([None, *map(float, range(6))]), r.choice([None, "x", "y", "z"])) for k in range(60)]
    df = spark.createDataFrame(rows, "ID string, x double, s string")
    conds = [tree(r, 3) for _ in range(40)]
    got = df.select("ID", *[gate.compile_condition(df, c).alias(f"c{i}") for i, c in enumerate(conds)]).collect()
    for row, g in zip(rows, got, strict=True):
        for i, c in enumerate(conds):
            assert g[f"c{i}"] == plain(dict(zip(("ID", "x", "s"), row, strict=True)), c), c


def test_bands(spark, tmp_path):
    df = spark.createDataFrame([("a", 10.0, "one"), ("b", 20.0, "one"), ("c", 30.0, "two"), ("d", None, "two"), ("e", 15.0, None), ("f", 1.0, "other")], "ID string, v double, arch string")
    assert ids(sel.band_filter(df, {"v": {"min": 10, "max": 20}})) == ["a", "b", "e"]
    by = {"v": {"by": "arch", "one": {"min": 15}, "two": {"max": 30}}}
    assert ids(sel.band_filter(df, by)) == ["b", "c", "f"]
    p = tmp_path / "bands.json"
    p.write_text(json.dumps({"v": {"min": 100}}))
    assert ids(sel.band_filter(df, {}, str(p))) == []
    assert ids(sel.band_filter(df, {"v": {"min": 25}}, str(p))) == ["c"]
    with pytest.raises(ValueError):
        sel.band_filter(df, {"nope": {}})


def test_score(spark):
    df = spark.createDataFrame([("a", "g", 1000.0), ("b", "g", 3000.0), ("c", "h", 1.0), ("d", "h", 3.0), ("e", "k", 5.0), ("f", "k", 5.0), ("g", "h", None), ("h", None, 2.0)], "ID string, g string, v double")
    out = {r.ID: r for r in sel.score(df, [{"col": "v", "direction": "higher"}], "g").collect()}
    assert [out[i].score for i in "abcdef"] == [-1, 1, -1, 1, 0, 0]
    assert out["g"].score is None and out["h"].score is None and out["g"].score_rank is None
    assert out["e"].score_rank == 1 and out["f"].score_rank == 2
    flat = {r.ID: r.score for r in sel.score(df.filter("g = 'g'"), [{"col": "v", "direction": "lower", "weight": 2}]).collect()}
    assert flat == {"a": 2.0, "b": -2.0}


def test_specificity(spark):
    df = spark.createDataFrame([("a", 0.7, 0.1, 0.2), ("b", 0.4, 0.6, 0.2), ("c", 0.7, 0.1, 0.4), ("d", None, 0.9, None), ("e", None, None, 0.1)], "ID string, GGPP_score double, `CPP_score ` double, `X (farnesyl pyrophosphate)` double")
    assert ids(sel.substrate_specificity(df, "GGPP")) == ["a", "b", "d"]
    assert ids(sel.substrate_specificity(df, "ggpp", ceilings={"fpp": 0.5})) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError):
        sel.substrate_specificity(df, "DMAPP")
    two = spark.createDataFrame([("a", 0.9)], "ID string, `q (2x geranylgeranyl pyrophosphate)` double")
    assert ids(sel.substrate_specificity(two, "2xGGPP")) == ["a"]


def test_diversity(spark):
    df = spark.createDataFrame([("a", "s", 1.0, "g"), ("b", "s", 2.0, "g"), ("c", None, 9.0, "g"), ("d", "t", 0.0, "g"), ("e", "u", 1.0, "solo"), ("f", None, 2.0, "solo"), ("x", "v", 1.0, None)], "ID string, sequence string, score double, g string")
    clusters = spark.createDataFrame([("a", "a"), ("b", "a"), ("d", "d")], "member string, representative string")
    assert ids(sel.diversity_dedup(df, clusters, "score", "g")) == ["b", "c", "d", "e", "f"]
    assert ids(sel.diversity_dedup(df, clusters, "score", "g", 1)) == ["c", "f"]


def test_interpreter(spark):
    df = spark.createDataFrame([(f"x_{g}_w{i}", float(i)) for g in ("c0", "c1") for i in range(6)], "ID string, v double")
    spec = {"group_by": "cls", "group_from_id": r"_(c\d+)_w", "n_out_per_group": 2, "ops": [{"op": "gate", "conditions": [{"col": "v", "ge": 1}]}, {"op": "score", "terms": [{"col": "v", "direction": "higher"}]}]}
    trace = []
    out = sel.run_selection(df, spec, trace=trace)
    assert ids(out) == ["x_c0_w4", "x_c0_w5", "x_c1_w4", "x_c1_w5"]
    text = sel.manifest(trace, spec)
    assert "| gate | 10 | c0=5, c1=5 |" in text and "| top_n | 4 | c0=2, c1=2 |" in text
    with pytest.raises(ValueError):
        sel.run_selection(df, {"ops": [{"op": "magic"}]})
    seqs = spark.createDataFrame([("x_c0_w5", "MKV")], "id string, sequence string")
    assert sel.run_selection(df, {"ops": []}, sequences=seqs).filter(F.col("sequence").isNotNull()).count() == 1


def test_few_groups_are_sent_whatever_their_sides_look_like(spark):
    """Bands and moments of a few groups are no shuffle join by the group, even where Spark itself would send nothing."""
    df = spark.range(2000).select(F.col("id").cast("string").alias("ID"), (F.col("id") % 3).cast("string").alias("cls"), (F.col("id") * 1.5).alias("x"))
    bands = df.groupBy("cls").agg(F.expr("percentile(x, 0.1)").alias("lo"), F.expr("percentile(x, 0.9)").alias("hi")).withColumnRenamed("cls", "category")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inside = df.join(bands, df.cls == bands.category).where("x BETWEEN lo AND hi").count()
        for out, n in ((sel.band_join(df, bands, "x", "cls"), inside), (sel.scored(df, [{"col": "x", "direction": "higher"}], "cls"), 2000)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
            assert out.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
