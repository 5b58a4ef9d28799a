"""Bands, scores, specificity, diversity, top-N, and the interpreter of a JSON spec."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.values import all_of, greatest, number_of
from winnow.operators import gate as gates
from winnow.operators.ranks import ranked
from winnow.store import sent_if_small, stored

# ------------------------------------------------------------------ bands


def _band(x: Column, band: dict) -> Column:
    tests = [x >= float(band["min"])] if band.get("min") is not None else []
    tests += [x <= float(band["max"])] if band.get("max") is not None else []
    return F.coalesce(all_of(tests) & x.isNotNull(), F.lit(False))


def band_predicate(df: DataFrame, metrics: dict) -> Column:
    """All metrics within their bands.  A band may be per category (``by``): a
    category without one passes, a missing category or value fails."""
    parts = []
    for name, spec in metrics.items():
        for c in (name, spec.get("by")):
            if c is not None and c not in df.columns:
                raise ValueError(f"band_filter: no column {c!r}")
        x = number_of(df, name)
        if "by" in spec:
            by = F.col(f"`{spec['by']}`").cast("string")
            bands = {k: v for k, v in spec.items() if k != "by"}
            test = F.when(by.isNull(), False)
            for k, v in bands.items():
                test = test.when(by == F.lit(k), _band(x, v))
            parts.append(test.otherwise(True))
        else:
            parts.append(_band(x, spec))
    return all_of(parts)


def band_filter(df: DataFrame, metrics: dict, bands_file: str | None = None) -> DataFrame:
    """Bands of a file, overridden by those given here."""
    base = json.load(open(bands_file)) if bands_file else {}
    return df.filter(band_predicate(df, base | metrics))


def band_join(df: DataFrame, bands: DataFrame, metric: str, by: str) -> DataFrame:
    """The same for bands in a table (category, lo, hi), one row per category; it is stored
    and counted first, and sent to the tasks while it is small, so that no category's rows meet in one task."""
    b = sent_if_small(stored(bands.select(F.col("category").cast("string").alias("_c"), "lo", "hi")))
    x = number_of(df, metric)
    j = df.join(b, F.col(f"`{by}`").cast("string") == F.col("_c"), "left")
    ok = F.col("_c").isNull() | ((F.col("lo").isNull() | (x >= F.col("lo"))) & (F.col("hi").isNull() | (x <= F.col("hi"))))
    return j.filter(F.col(f"`{by}`").isNotNull() & x.isNotNull() & ok).select(*[df[c] for c in df.columns])


# ------------------------------------------------------------------ scores


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    """(x - mean) / population deviation; 0 where the deviation is none, NULL where x is."""
    flat = sd <= F.greatest(F.lit(1.0), F.abs(mean)) * 1e-12
    return F.when(x.isNotNull(), F.when(flat, F.lit(0.0)).otherwise((x - mean) / sd))


def _best_first(df: DataFrame, score_col: str | None, tie: tuple[str, ...]) -> list[Column]:
    by = [F.col(f"`{score_col}`").desc_nulls_last()] if score_col and score_col in df.columns else []
    return [*by, *[F.col(f"`{c}`") for c in tie if c in df.columns]]


def scored(df: DataFrame, terms: list[dict], zscore_within: str | None = None, score_col: str = "score") -> DataFrame:
    """Sum of signed, weighted z-scores per group; a missing term or group makes it NULL.

    The moments of all groups come from one aggregate that is stored, counted and joined back, sent to the tasks while it is small,
    so no group is gathered in one task.
    """
    for t in terms:
        if t["col"] not in df.columns:
            raise ValueError(f"score: no column {t['col']!r}")
    aggs = [f(number_of(df, t["col"])).alias(f"_{k}{i}") for i, t in enumerate(terms) for k, f in (("m", F.avg), ("s", F.stddev_pop))]
    if zscore_within is None:
        base = df.crossJoin(F.broadcast(df.agg(*aggs)))  # one row
    else:
        moments = df.groupBy(F.col(f"`{zscore_within}`").alias("_g")).agg(*aggs).where("_g IS NOT NULL")
        moments = sent_if_small(stored(moments))
        base = df.join(moments, F.col(f"`{zscore_within}`") == F.col("_g"), "left").drop("_g")
    total = F.lit(0.0)
    for i, t in enumerate(terms):
        sign = -1 if t.get("direction") == "lower" else 1
        total = total + zscore(number_of(df, t["col"]), F.col(f"_m{i}"), F.col(f"_s{i}")) * F.lit(float(t.get("weight", 1)) * sign)
    known = F.col(f"`{zscore_within}`").isNotNull() if zscore_within else F.lit(True)
    return base.withColumn(score_col, F.when(known, total)).drop(*[f"_{k}{i}" for i in range(len(terms)) for k in "ms"])


def score(df: DataFrame, terms: list[dict], zscore_within: str | None = None, score_col: str = "score", tie: tuple[str, ...] = ("ID",)) -> DataFrame:
    """scored() and its rank in the group (score descending, ties by ``tie``), NULL where the score is.

    The ranks come from ranges of the order (see ranks.ranked), which runs jobs; a group of any size is spread over all tasks.
    """
    out = scored(df, terms, zscore_within, score_col)
    name = f"{score_col}_rank"
    out = ranked(out, [zscore_within] if zscore_within else [], _best_first(out, score_col, tie), name)
    return out.withColumn(name, F.when(F.col(f"`{score_col}`").isNotNull(), F.col(name)))


def take_top_n(df: DataFrame, n: int, group: str | None = None, score_col: str | None = "score", tie: tuple[str, ...] = ("ID",), rank_col: str | None = None) -> DataFrame:
    """The best n of each group (rows without a group go); Spark cuts each map
    output to n rows before it shuffles them.  rank_col: keep the rank under this name, NULL where the score is."""
    order = _best_first(df, score_col, tie)
    if group is None:
        out = df.orderBy(*order).limit(n)
        if not rank_col:
            return out
        w, d = Window.orderBy(*order), out  # n rows
    else:
        w, d = Window.partitionBy(f"`{group}`").orderBy(*order), df.filter(F.col(f"`{group}`").isNotNull())
    d = d.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n)
    return d.withColumn(rank_col, F.when(F.col(f"`{score_col}`").isNotNull(), F.col("_n"))).drop("_n") if rank_col else d.drop("_n")


# ------------------------------------------------------------------ specificity

# Codes of the score columns and their names.
FOLD = {"CPP": "GGPP", "2xFPP": "EDSQ"}
NAMES = {
    "dimethylallyl pyrophosphate": "DMAPP", "geranyl pyrophosphate": "GPP", "farnesyl pyrophosphate": "FPP", "geranylgeranyl pyrophosphate": "GGPP", "geranylfarnesyl pyrophosphate": "GFPP",
    "(s)-2,3-epoxysqualene": "EDSQ", "2,3-epoxysqualene": "EDSQ", "copalyl diphosphate": "GGPP", "2x farnesyl pyrophosphate": "EDSQ", "2x geranylgeranyl pyrophosphate": "2xGGPP",
}


#: What a column name says: a code before "_score", or a substance in the last brackets.
_SCORE_NAME = re.compile(r"(?P<code>.*)_score|.*\((?P<substance>[^()]*)\)", re.S)


def score_code(column: str) -> str | None:
    """The substrate code that a column scores, None if it scores none."""
    m = _SCORE_NAME.fullmatch(column.strip())
    if not m:
        return None
    said = m["code"].strip() if m["code"] is not None else NAMES.get((m["substance"] or "").strip().lower(), "")
    return FOLD.get(said, said) if said not in ("", "TPS", "isTPS") else None


def score_columns(columns: list[str]) -> dict[str, list[str]]:
    """Substrate code -> the columns that score it, in their order."""
    codes = [score_code(c) for c in columns]
    return {k: [c for c, x in zip(columns, codes, strict=True) if x == k] for k in dict.fromkeys(codes) if k}


def substrate_specificity(df: DataFrame, target: str, t_hi: float = 0.5, t_off: float = 0.35, ceilings: dict | None = None) -> DataFrame:
    """Rows whose best score for the target is t_hi or more, and for each other
    substrate its ceiling or less (a missing one passes).  Codes match in any case."""
    fold = {k.upper(): v.upper() for k, v in FOLD.items()}
    canon = lambda s: fold.get(s.upper(), s.upper())
    cols = {canon(k): v for k, v in score_columns(df.columns).items()}
    if canon(target) not in cols:
        raise ValueError(f"no score column for {target!r}")
    limit = {canon(k): float(v) for k, v in (ceilings or {}).items()}
    best = {k: greatest([number_of(df, c) for c in v]) for k, v in cols.items()}
    parts = [F.coalesce(best[canon(target)] >= t_hi, F.lit(False))]
    parts += [F.coalesce(x <= limit.get(k, t_off), F.lit(True)) for k, x in best.items() if k != canon(target)]
    return df.filter(all_of(parts))


# ------------------------------------------------------------------ diversity


def diversity_dedup(df: DataFrame, clusters: DataFrame, quality: str, group: str | None = None, n_out: int | None = None, sequence: str = "sequence", tie: str = "ID") -> DataFrame:
    """The best of each cluster (clusters: member, representative) in each group.

    A group with at most one usable sequence keeps all its rows; in larger ones
    a row without cluster is its own.  Rows without a group go.
    """
    c = clusters.select(F.col("member").cast("string").alias("_m"), F.col("representative").cast("string").alias("_r"))
    d = df.withColumn("_g", F.col(f"`{group}`") if group else F.lit("all")).filter(F.col("_g").isNotNull())
    d = d.join(c, F.col(f"`{tie}`").cast("string") == F.col("_m"), "left").withColumn("_c", F.coalesce("_r", F.col(f"`{tie}`").cast("string")))
    usable = F.count(F.when(F.col(f"`{sequence}`").isNotNull() & (F.col(f"`{sequence}`") != ""), 1))
    d = d.join(d.groupBy(F.col("_g").alias("_h")).agg(usable.alias("_u")), F.col("_g") == F.col("_h"))
    order = [F.col(f"`{quality}`").desc_nulls_last(), F.col(f"`{tie}`")]
    # each map output is cut to the best of its clusters before the shuffle, so no large cluster meets in one task
    best = d.filter("_u > 1").withColumn("_k", F.row_number().over(Window.partitionBy("_g", "_c").orderBy(*order))).filter("_k = 1").drop("_k")
    d = best.unionByName(d.filter("_u <= 1"))
    if n_out and group:
        d = d.withColumn("_n", F.row_number().over(Window.partitionBy("_g").orderBy(*order))).filter(F.col("_n") <= n_out)
    elif n_out:
        d = d.orderBy(*order).limit(n_out)
    return d.select(*[F.col(f"`{c}`") for c in df.columns])


# ------------------------------------------------------------------ the interpreter


def with_group(df: DataFrame, spec: dict) -> DataFrame:
    """The group column from group(1) of an expression over ID, where it is absent."""
    g = spec.get("group_by")
    if g and g not in df.columns and spec.get("group_from_id"):
        v = F.regexp_extract("ID", spec["group_from_id"], 1)
        return df.withColumn(g, F.when(v != "", v))
    return df


Op = Callable[[DataFrame, dict, dict], DataFrame]


def _dedup_op(df: DataFrame, op: dict, ctx: dict) -> DataFrame:
    from winnow.operators.cluster import cluster_sequences

    group = op.get("group_col", ctx["spec"].get("group_by"))
    clusters = ctx.get("clusters")
    if clusters is None:
        clusters = cluster_sequences(df, op.get("id_threshold", 0.7), group=group, thresholds=op.get("id_threshold_per_group"))
    return diversity_dedup(df, clusters, op["quality_col"], group, op.get("n_out_per_group"))


def _score_op(df: DataFrame, op: dict, ctx: dict) -> DataFrame:
    """Where the best n of the same groups are all that is kept next, they are ranked then: of the others no rank is needed."""
    spec, name = ctx["spec"], op.get("score_col", "score")
    within = op.get("zscore_within", spec.get("group_by"))
    if op is spec["ops"][-1] and spec.get("n_out_per_group") and name == "score" and within == spec.get("group_by"):
        ctx["rank_later"] = "score_rank"
        return scored(df, op["terms"], within, name)
    return score(df, op["terms"], within, name, ctx["tie"])


REGISTRY: dict[str, Op] = {
    "gate": lambda df, op, ctx: gates.apply_gate(df, op["conditions"], op.get("keep_only_passing", True)),
    "band_filter": lambda df, op, ctx: band_filter(df, op.get("metrics", {}), op.get("bands_file")),
    "score": lambda df, op, ctx: _score_op(df, op, ctx),
    "substrate_specificity": lambda df, op, ctx: substrate_specificity(df, op.get("target_substrate") or ctx["target"], op.get("t_hi", 0.5), op.get("t_off", 0.35), op.get("per_substrate_ceilings")),
    "diversity_dedup": _dedup_op,
}


def run_selection(df: DataFrame, spec: dict, sequences: DataFrame | None = None, clusters: DataFrame | None = None, target: str | None = None, tie: tuple[str, ...] = ("ID",), trace: list | None = None) -> DataFrame:
    """Apply the ops of a spec in order: one lazy plan, but for moments and ranks of groups (see score) and native clusters, which run jobs.
    Every op's name is looked up first.

    trace: gets (op, frame) after each step, for manifest().
    """
    unknown = [op.get("op") for op in spec["ops"] if op.get("op") not in REGISTRY]
    if unknown:
        raise ValueError(f"unknown op {unknown[0]!r}")
    out = with_group(df, spec)
    if sequences is not None and "sequence" not in out.columns:
        out = out.join(sequences.select(F.col("id").alias("ID"), "sequence"), "ID", "left")
    ctx = {"spec": spec, "clusters": clusters, "target": target or spec.get("target_substrate"), "tie": tie}
    if trace is not None:
        trace.append(("input", out))
    for op in spec["ops"]:
        out = REGISTRY[op["op"]](out, op, ctx)
        if trace is not None:
            trace.append((op["op"], out))
    if spec.get("n_out_per_group"):
        out = take_top_n(out, int(spec["n_out_per_group"]), spec.get("group_by"), "score", tie, ctx.get("rank_later"))
        if trace is not None:
            trace.append(("top_n", out))
    return out


def group_counts(df: DataFrame, group: str | None) -> DataFrame:
    g = F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("nan")) if group else F.lit("all")
    return df.groupBy(g.alias("grp")).agg(F.count(F.lit(1)).alias("n"))


def manifest(trace: list, spec: dict, title: str = "Selection") -> str:
    """A Markdown table of survivors per op and group; the counts are one small job per op."""
    lines = [f"# {title}", "", "| step | survivors | per group |", "|---|---|---|"]
    for name, df in trace:
        counts = sorted((r.grp, r.n) for r in group_counts(df, spec.get("group_by")).collect())
        lines.append(f"| {name} | {sum(n for _, n in counts)} | {', '.join(f'{g}={n}' for g, n in counts)} |")
    return "\n".join(lines) + "\n"
