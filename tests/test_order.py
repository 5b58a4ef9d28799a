"""Ranks by ranges and quantiles by search, against numpy and windows."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from winnow.operators import quantiles, ranks, stats
from winnow.operators import select as sel

FRACTIONS = {"p1": 0.01, "q1": 0.25, "q2": 0.5, "q3": 0.75, "p99": 0.99}


def values(kind, r, n):
    if kind == "normal":
        return [r.gauss(0, 1) for _ in range(n)]
    if kind == "decades":
        return [10 ** r.uniform(-250, 250) * r.choice([-1, 1]) for _ in range(n)]
    if kind == "ties":  # most at one value, and some beside it
        return [r.choice([5.0] * 8 + [r.random() * 1e-9 + 5, r.uniform(0, 10)]) for _ in range(n)]
    if kind == "two":
        return [r.choice([0.0, 1.0]) for _ in range(n)]
    return [float(r.randrange(50)) for _ in range(n)]


@pytest.mark.parametrize("cuts", [100])
def test_searched_quantiles_are_exact(spark, monkeypatch, cuts):
    """Small sketches and a small end, so that several passes are needed; groups with one value and with none, and one without a name."""
    monkeypatch.setattr(quantiles, "LAST_VALUES", 20)
    monkeypatch.setattr(quantiles, "CUTS", cuts)
    monkeypatch.setattr(quantiles, "_FRACTIONS", f"array({', '.join(str(k / cuts) for k in range(cuts + 1))})")
    r = random.Random(cuts)
    groups = {k: values(k, r, 1500) for k in ("normal", "decades", "ties", "two", "few")} | {"one": [3.5], "none": [None], None: values("normal", r, 300)}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("normal", None)] * 9
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double")
    for exact_rows in (0, 10**6):
        got = {x.g: x for x in quantiles.exact_quantiles(df, ["g"], FRACTIONS, exact_rows).collect()}
        assert set(got) == set(groups)
        for g, xs in groups.items():
            for name, p in FRACTIONS.items():
                want = None if xs == [None] else float(np.quantile(xs, p))
                assert got[g][name] == want if want is None else got[g][name] == pytest.approx(want, rel=1e-12, abs=1e-300), (g, name)


def test_a_wrong_sketch_costs_passes_and_no_result(spark, monkeypatch):
    """Cuts far from the ranks: the counts find the side that the rank is on, by halves."""
    monkeypatch.setattr(quantiles, "LAST_VALUES", 40)
    monkeypatch.setattr(quantiles, "CUTS", 2)
    monkeypatch.setattr(quantiles, "_FRACTIONS", "array(0.9, 0.95, 1.0)")
    r = random.Random(3)
    xs = [float(r.randrange(12)) for _ in range(100)]
    got = quantiles.exact_quantiles(spark.createDataFrame([("a", x) for x in xs], "g string, x double"), ["g"], {"q2": 0.5}, 0).first()
    assert got.q2 == np.quantile(xs, 0.5)


def test_a_pass_meets_each_value_once(spark, monkeypatch):
    """Seven percentiles are up to fourteen ranks: no pass reads a value beside each of them."""
    monkeypatch.setattr(quantiles, "LAST_VALUES", 20)
    met, plain = [], quantiles._met

    def counted(*a):
        m = plain(*a)
        met.append(m.count())
        return m

    monkeypatch.setattr(quantiles, "_met", counted)
    r = random.Random(5)
    df = spark.createDataFrame([("a", r.gauss(0, 1)) for _ in range(3000)], "g string, x double")
    quantiles.exact_quantiles(df, ["g"], stats.PERCENTS, 0).collect()
    assert met and max(met) <= 3000


def test_summary_is_the_same_either_way(spark):
    r = random.Random(4)
    df = spark.createDataFrame([(r.choice("abc"), r.choice(["u", None]), r.gauss(0, 5) if r.random() < 0.9 else None) for _ in range(9000)], "g string, h string, x double")
    rows = lambda n: sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in x) for x in stats.numeric_stats(df, ["x"], ["g", "h"], n).collect())
    assert rows(0) == rows(None)


def test_one_group_is_spread_and_ranked(spark):
    """Ranks equal a window's; a single group lies in many tasks of like size."""
    df = spark.range(20_000).select("id", (F.hash("id") % 1000).alias("v"), F.when(F.col("id") % 5 > 0, "hot").alias("g"))
    order = [F.col("v").desc(), F.col("id")]
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    got = ranks.ranked(df, ["g"], order, "w", ranges=16)
    assert got.exceptAll(want.withColumn("w", F.col("w").cast("long"))).count() == 0 and got.count() == 20_000
    sizes = [r["count"] for r in ranks.placed(df, order, ranges=16).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 4 * 20_000 / 16
    places = [r.place for r in ranks.placed(df, order, ranges=16).orderBy(*order).collect()]
    assert places == list(range(1, 20_001))
    assert ranks.ranked(df.limit(0), ["g"], order).collect() == [] and ranks.placed(df.limit(0), order).collect() == []


def test_rank_and_top_n_of_scores(spark):
    df = spark.createDataFrame([("a", "g", 1.0), ("b", "g", None), ("c", "g", 3.0), ("d", None, 9.0), ("e", "h", 2.0)], "ID string, grp string, x double")
    terms = [{"col": "x", "direction": "higher"}]
    got = {r.ID: (r.score, r.score_rank) for r in sel.score(df, terms, "grp").collect()}
    assert got == {"a": (-1.0, 2), "b": (None, None), "c": (1.0, 1), "d": (None, None), "e": (0.0, 1)}
    spec = {"group_by": "grp", "n_out_per_group": 1, "ops": [{"op": "score", "terms": terms}]}
    assert {r.ID: r.score_rank for r in sel.run_selection(df, spec).collect()} == {"c": 1, "e": 1}
    spec["ops"].append({"op": "gate", "conditions": [{"col": "score_rank", "le": 2}]})
    assert {r.ID: r.score_rank for r in sel.run_selection(df, spec).collect()} == {"c": 1, "e": 1}
    all_rows = sel.run_selection(df, {"n_out_per_group": 2, "ops": [{"op": "score", "terms": terms}]})
    assert {r.ID: r.score_rank for r in all_rows.collect()} == {"d": 1, "c": 2}
