"""Reference statistics per column and stratum, and the bands made from them."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.functions.values import number, number_of
from winnow.operators import quantiles
from winnow.store import stored

PERCENTS = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def classify(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """numeric or categorical, decided once on the whole column: booleans are
    categorical, numbers numeric, text numeric if every present value is a number."""
    kinds, text = {}, []
    for c in columns:
        d = df.schema[c].dataType
        if isinstance(d, T.BooleanType):
            kinds[c] = "categorical"
        elif isinstance(d, T.NumericType):
            kinds[c] = "numeric"
        else:
            text.append(c)
    if text:
        r = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(text)], *[F.count(number_of(df, c)).alias(f"k{i}") for i, c in enumerate(text)]).first()
        for i, c in enumerate(text):
            kinds[c] = "numeric" if r[f"n{i}"] and r[f"n{i}"] == r[f"k{i}"] else "categorical"
    return kinds


def numeric_stats(df: DataFrame, columns: list[str], strata: list[str] | None = None, exact_rows: int | None = None) -> DataFrame:
    """stat_column, labeling, label and the summary, overall (labeling NULL) and per
    class of each labeling, from one pass with grouping sets.  Rows without a
    class are in no stratum of that labeling.  Percentiles are exact (linear); from
    exact_rows values on (quantiles.EXACT_ROWS) they are searched in a few more passes,
    so that no stratum's values are gathered."""
    strata = strata or []
    x = df.select(*[F.col(f"`{s}`").cast("string").alias(f"_s{i}") for i, s in enumerate(strata)], F.explode(F.array(*[F.struct(F.lit(c).alias("stat_column"), number_of(df, c).alias("x")) for c in columns])).alias("e"))
    x = x.select(*[f"_s{i}" for i in range(len(strata))], "e.stat_column", "e.x")
    exact_rows = quantiles.EXACT_ROWS if exact_rows is None else exact_rows
    aggs = [F.count("x").alias("n"), (F.count(F.lit(1)) - F.count("x")).alias("n_missing"), F.avg("x").alias("mean"), F.when(F.count("x") > 0, F.coalesce(F.stddev_samp("x"), F.lit(0.0))).alias("std"), F.min("x").alias("min"), F.max("x").alias("max")]
    # a row for each grouping that it belongs to: overall, and its class of each labeling
    groups = [F.struct(F.lit(None).cast("string").alias("labeling"), F.lit(None).cast("string").alias("label"))]
    groups += [F.when(F.col(f"_s{i}").isNotNull(), F.struct(F.lit(s).alias("labeling"), F.col(f"_s{i}").alias("label"))) for i, s in enumerate(strata)]
    x = x.withColumn("g", F.explode(F.array(*groups))).where("g IS NOT NULL").select("stat_column", "g.labeling", "g.label", "x")
    keys = ["stat_column", "labeling", "label"]
    out = stored(x.groupBy(*keys).agg(*aggs))
    few = (out.where("labeling IS NULL").agg(F.sum("n")).first()[0] or 0) <= exact_rows
    q = quantiles.exact_quantiles(x, keys, PERCENTS, 1 << 62 if few else 0, out.select(*keys, "n", F.col("min").alias("a"), F.col("max").alias("b")))
    q = q.select(*[F.col(k).alias(f"_{k}") for k in keys], *PERCENTS)
    return out.join(q, (F.col("stat_column") == F.col("_stat_column")) & F.col("labeling").eqNullSafe(F.col("_labeling")) & F.col("label").eqNullSafe(F.col("_label")), "left").drop("_stat_column", "_labeling", "_label")


def categorical_stats(df: DataFrame, column: str, stratum: str | None = None) -> DataFrame:
    """(label,) value, freq of a column; booleans are written True and False."""
    v = F.col(f"`{column}`")
    v = F.initcap(v.cast("string")) if isinstance(df.schema[column].dataType, T.BooleanType) else v.cast("string")
    keys = [F.col(f"`{stratum}`").cast("string").alias("label")] if stratum else []
    d = df.filter(F.col(f"`{column}`").isNotNull())
    d = d.filter(F.col(f"`{stratum}`").isNotNull()) if stratum else d
    return d.groupBy(*keys, v.alias("value")).agg(F.count(F.lit(1)).alias("freq"))


def categorical_summary(df: DataFrame, column: str) -> DataFrame:
    c = F.col(f"`{column}`")
    return df.agg(F.count(c).alias("n"), (F.count(F.lit(1)) - F.count(c)).alias("n_missing"), F.countDistinct(c).alias("n_unique"))


def export_bands(stats: DataFrame, metrics: dict[str, dict], edges: tuple[str | None, str | None] = ("p5", "p95"), labeling: str | None = None) -> DataFrame:
    """metric, category (NULL: overall), lo, hi from the statistics; a metric's spec
    may name its own edges, either of which may be absent."""
    out = None
    scope = (F.col("labeling") == labeling) if labeling else F.col("labeling").isNull()
    for metric, spec in metrics.items():
        lo, hi = spec.get("min", edges[0]), spec.get("max", edges[1])
        part = stats.filter((F.col("stat_column") == metric) & scope).select(F.lit(metric).alias("metric"), F.col("label").alias("category"), (F.col(lo) if lo else F.lit(None).cast("double")).alias("lo"), (F.col(hi) if hi else F.lit(None).cast("double")).alias("hi"))
        out = part if out is None else out.unionByName(part)
    return out


def bands_json(bands: DataFrame, by: str | None = None) -> str:
    """The bands (one row per metric and class) as the filter reads them."""
    out: dict = {}
    for r in bands.collect():
        band = {k: v for k, v in (("min", r.lo), ("max", r.hi)) if v is not None}
        if r.category is None:
            out[r.metric] = band
        else:
            out.setdefault(r.metric, {"by": by})[r.category] = band
    return json.dumps(out, sort_keys=True, allow_nan=False)


def stats_json(stats: DataFrame, metadata: dict | None = None) -> str:
    """Nested, strict JSON of the statistics (one row per column and class)."""
    out: dict = {}
    for r in stats.collect():
        d = {k: v for k, v in r.asDict().items() if k not in ("stat_column", "labeling", "label")} | {"kind": "numeric"}
        d = {k: None if isinstance(v, float) and v != v else v for k, v in d.items()}
        col = out.setdefault(r.stat_column, {})
        if r.labeling is None:
            col.update(d)
        else:
            col.setdefault(f"by_{r.labeling}", {})[r.label] = d
    return json.dumps({**(metadata or {}), "metrics": out}, sort_keys=True, allow_nan=False)


# ------------------------------------------------------------------ whole files


def table_statistics(df: DataFrame, labelings: dict[str, DataFrame] | None = None, drop: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The summary and the frequencies of all columns of a text table (with ID), overall and per class of each labeling (id, label).

    One pass counts the rows of each (column, labeling, class, value); all else comes from these counts: what is a number, weighted moments
    and percentiles, and the frequencies.  A column is numeric if all its present values are numbers, decided on the whole of it; an empty
    one is categorical.  Rows without a class are in none of that labeling.  The summary: stat_column, labeling, label, kind, n, n_missing,
    n_unique (categorical) and mean, std, min, max and percentiles (numeric); the frequencies: stat_column, labeling, label, value, freq.
    """
    columns = [c for c in df.columns if c != "ID" and c not in drop]
    base, groups = df, [F.struct(F.lit(None).cast("string").alias("labeling"), F.lit(None).cast("string").alias("label"))]
    for k, (name, labels) in enumerate((labelings or {}).items()):
        one = labels.groupBy(F.col("id").cast("string").alias(f"_id{k}")).agg(F.max(F.col("label").cast("string")).alias(f"_l{k}"))
        base = base.join(one, F.col("ID").cast("string") == F.col(f"_id{k}"), "left")
        groups.append(F.when(F.col(f"_l{k}").isNotNull(), F.struct(F.lit(name).alias("labeling"), F.col(f"_l{k}").alias("label"))))
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("stat_column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    keys = ["stat_column", "labeling", "label"]
    x = base.select(cells.alias("e"), F.filter(F.array(*groups), lambda g: g.isNotNull()).alias("g")).select("e.*", F.explode("g").alias("g")).select("stat_column", "g.*", "value")
    counts = stored(x.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("freq")).withColumn("x", number(F.col("value"))))
    w = F.col("freq").cast("double")
    some = F.col("value").isNotNull()
    shift = counts.groupBy(*keys).agg(F.min("x").alias("_x0"))  # so that the sum of squares stays small
    same = lambda a, b: (F.col(f"{a}stat_column") == F.col(f"{b}stat_column")) & F.col(f"{a}labeling").eqNullSafe(F.col(f"{b}labeling")) & F.col(f"{a}label").eqNullSafe(F.col(f"{b}label"))
    shift = shift.toDF("_stat_column", "_labeling", "_label", "_x0")
    c = counts.join(shift, same("", "_")).drop("_stat_column", "_labeling", "_label").withColumn("_d", F.col("x") - F.col("_x0"))
    p = F.expr(f"percentile(x, array({', '.join(map(str, PERCENTS.values()))}), freq)")
    s = c.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(some, F.col("freq"))), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(~some, F.col("freq"))), F.lit(0)).alias("n_missing"), F.count("value").alias("n_unique"), F.sum(F.when(F.col("x").isNotNull(), F.col("freq"))).alias("_k"),
        F.first("_x0").alias("_x0"), F.sum(F.col("_d") * w).alias("_s1"), F.sum(F.col("_d") * F.col("_d") * w).alias("_s2"), F.min("x").alias("min"), F.max("x").alias("max"), p.alias("_p"))
    kinds = s.where("labeling IS NULL").select(F.col("stat_column").alias("_c"), F.when((F.col("n") > 0) & (F.col("_k") == F.col("n")), "numeric").otherwise("categorical").alias("kind"))
    s = s.join(F.broadcast(kinds), F.col("stat_column") == F.col("_c"))  # a row a column
    numeric, n = F.col("kind") == "numeric", F.col("n")
    std = F.when(n > 1, F.sqrt(F.greatest(F.col("_s2") - F.col("_s1") * F.col("_s1") / n, F.lit(0.0)) / (n - 1))).when(n == 1, 0.0)
    only = lambda v: F.when(numeric, v)
    summary = s.select(*keys, "kind", "n", "n_missing", F.when(~numeric, F.col("n_unique")).alias("n_unique"), only(F.col("_x0") + F.col("_s1") / n).alias("mean"), only(std).alias("std"), only(F.col("min")).alias("min"), only(F.col("max")).alias("max"), *[only(F.col("_p")[i]).alias(k) for i, k in enumerate(PERCENTS)])
    text = F.broadcast(kinds.where("kind = 'categorical'"))
    frequencies = counts.where(some).join(text, F.col("stat_column") == F.col("_c"), "left_semi").select(*keys, "value", "freq")
    return summary, frequencies


def self_consistency(samples: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """ID, sc_rmsd_min, sc_rmsd_mean and n_samples from the RMSD of each refolded sample (ID, rmsd); failed ones, NULL or not finite,
    don't count. ids: every one of these keeps a row."""
    x = F.when(~F.isnan("rmsd") & (F.abs("rmsd") < float("inf")), F.col("rmsd"))
    s = samples.groupBy("ID").agg(F.min(x).alias("sc_rmsd_min"), F.avg(x).alias("sc_rmsd_mean"), F.count(x).alias("n_samples"))
    return ids.select("ID").join(s, "ID", "left").fillna(0, ["n_samples"]) if ids is not None else s


# ------------------------------------------------------------------ labels


def mode_label(df: DataFrame, key: str, label: str, rank: dict[str, int] | None = None) -> DataFrame:
    """The most frequent label of each key; ties go to the lower rank, then the lesser label."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(key, label).agg(F.count(F.lit(1)).alias("c"))
    r = F.lit(0)
    if rank:
        r = F.coalesce(F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])[F.col(label)], F.lit(max(rank.values()) + 1))
    best = F.min(F.struct((-F.col("c")).alias("c"), r.alias("r"), F.col(label).alias("label"))).alias("b")
    return counts.groupBy(key).agg(best, F.sum("c").alias("n")).select(key, F.col("b.label").alias("label"), (-F.col("b.c")).alias("n_votes"), "n")


def class_metadata(df: DataFrame, key: str, label: str) -> DataFrame:
    """The least class as the primary one, the number of classes, and all of them."""
    s = F.sort_array(F.collect_set(label))
    return df.groupBy(key).agg(F.min(label).alias("primary_class"), F.countDistinct(label).alias("n_classes"), F.array_join(s, ";").alias("all_classes"))


def length_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(F.length(column).alias("length")).agg(F.count(F.lit(1)).alias("n"))


def sample_lengths(hist: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n draws from the empirical distribution: a range look-up in the cumulative
    weights, which are as few as there are lengths."""
    rows = sorted((r.length, r.n) for r in hist.collect())
    total, edges, at = sum(k for _, k in rows), [], 0
    for length, k in rows:
        edges.append((at / total, (at + k) / total, length))
        at += k
    table = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(v).alias("v")) for a, b, v in edges])
    d = hist.sparkSession.range(n).withColumn("u", F.rand(seed))
    return d.select("id", F.filter(table, lambda e: (F.col("u") >= e["a"]) & (F.col("u") < e["b"]))[0]["v"].alias("length"))


def boxplot(df: DataFrame, column: str, group: str, exact_rows: int | None = None) -> DataFrame:
    x = df.select(F.col(f"`{group}`").alias("grp"), number_of(df, column).alias("x"))
    ends = x.groupBy(F.col("grp").alias("_grp")).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"))
    q = quantiles.exact_quantiles(x, ["grp"], {"q1": 0.25, "q2": 0.5, "q3": 0.75}, exact_rows)
    return q.join(ends, F.col("grp").eqNullSafe(F.col("_grp"))).select("grp", "q1", "q2", "q3", "lo", "hi", "n")


def density(df: DataFrame, column: str, points: int = 512) -> DataFrame:
    """A Gaussian kernel density (Scott's width) at evenly spaced points, from a
    fine histogram of the column, so that its cost doesn't grow with the rows per point."""
    x = number_of(df, column)
    n, mean, sd, lo, hi = df.agg(F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x)).first()
    spark = df.sparkSession
    if not n:
        return spark.createDataFrame([], "x double, density double")
    if not sd or lo == hi:
        return spark.createDataFrame([(float(mean), 1.0)], "x double, density double")
    h, bins = sd * n ** (-0.2), 4096
    b = F.least(F.floor((x - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
    hist = df.filter(x.isNotNull()).groupBy(b.alias("b")).agg(F.avg(x).alias("m"), F.count(F.lit(1)).alias("k"))
    rows = hist.collect()  # 4096 at most
    m, k = np.array([r.m for r in rows]), np.array([r.k for r in rows], float)
    grid = np.linspace(lo - 3 * h, hi + 3 * h, points)
    d = (np.exp(-0.5 * ((grid[:, None] - m[None]) / h) ** 2) * k).sum(1) / (n * h * np.sqrt(2 * np.pi))
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(grid, d, strict=True)], "x double, density double")
