"""Reducing hit tables (query, target, scores) to best hits, top-k edges and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_group(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")


def best_hits(hits: DataFrame, self_mode: bool = False) -> DataFrame:
    """The hit of the highest bits per query; ties by identity, then by target."""
    h = hits.filter(F.col("query") != F.col("target")) if self_mode else hits
    return best_per_group(h, "query", [F.col("bits").desc_nulls_last(), F.col("identity").desc_nulls_last(), F.col("target")])


def best_hit_summary(ids: DataFrame, hits: DataFrame, self_mode: bool = False) -> DataFrame:
    """Every query keeps a row; without a hit: NULL hit, 0 identity."""
    b = best_hits(hits, self_mode).select(F.col("query").alias("ID"), F.col("target").alias("hit"), "identity", "bits")
    return ids.select("ID").join(b, "ID", "left").select("ID", "hit", F.coalesce("identity", F.lit(0.0)).alias("identity"), F.coalesce("bits", F.lit(0.0)).alias("bits"))


def top_k_hits(hits: DataFrame, k: int, self_mode: bool = False, score: str = "score") -> DataFrame:
    """query_id, rank, neighbour_id, score: one hit per pair (best bits), then the best k."""
    h = hits.filter(F.col("query") != F.col("target")) if self_mode else hits
    pair = Window.partitionBy("query", "target").orderBy(F.col("bits").desc_nulls_last(), F.col(score).desc_nulls_last())
    h = h.withColumn("_p", F.row_number().over(pair)).filter("_p = 1")
    w = Window.partitionBy("query").orderBy(F.col(score).desc_nulls_last(), F.col("bits").desc_nulls_last(), F.col("target"))
    h = h.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return h.select(F.col("query").alias("query_id"), "rank", F.col("target").alias("neighbour_id"), F.col(score).alias("score"))


def hit_summary(hits: DataFrame, members: DataFrame, top_n: int, order: str = "bits", value: str = "identity") -> DataFrame:
    """Per query, over its best top_n hits: the top hit and its values, whether it
    is a member, the best value among non-members, and how many members there are."""
    m = members.select(F.col("member").alias("_m")).distinct()
    w = Window.partitionBy("query").orderBy(F.col(order).desc_nulls_last(), F.col("target"))
    h = hits.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= top_n)
    h = h.join(m, F.col("target") == F.col("_m"), "left").withColumn("is_member", F.col("_m").isNotNull())
    top = F.col("rk") == 1
    return h.groupBy("query").agg(
        F.max(F.when(top, F.col("target"))).alias("top_hit"), F.max(F.when(top, F.col(value))).alias("top_value"), F.max(F.when(top, F.col(order))).alias("top_order"), F.max(F.when(top, F.col("is_member"))).alias("top_is_member"),
        F.max(F.when(~F.col("is_member"), F.col(value))).alias("best_other_value"), F.count(F.when(F.col("is_member"), 1)).alias("n_members"),
    )


def independent_best(hits: DataFrame, scores: list[str], key: str = "query") -> DataFrame:
    """For each score on its own the highest value and its target (ties: the lesser target)."""
    aggs = []
    for s in scores:
        b = F.min(F.when(F.col(s).isNotNull(), F.struct((-F.col(s)).alias("k"), F.col("target").alias("t"))))
        aggs += [(-b["k"]).alias(s), b["t"].alias(f"{s}_hit")]
    return hits.groupBy(key).agg(*aggs)


def membership(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """is_member by a canonical accession: upper case, without version."""
    canon = lambda c: F.upper(F.trim(F.regexp_replace(c, r"\.\d+$", "")))
    m = members.select(canon(F.col("member")).alias("_m")).distinct()
    return df.join(m, canon(F.col(column)) == F.col("_m"), "left").withColumn("is_member", F.col("_m").isNotNull()).drop("_m")


def domain_reduce(hits: DataFrame, counts: DataFrame, types: list[str], exclude_self: bool = False) -> DataFrame:
    """Per design: the best score, its type and second score, and the best per type.
    hits: design, reference, type, tm, lddt; counts: design (all that keep a row)."""
    h = hits.filter(F.col("design") != F.col("reference")) if exclude_self else hits
    best = F.min(F.struct((-F.col("tm")).alias("k"), F.col("reference").alias("r"), F.col("type").alias("t"), F.col("lddt").alias("l")))
    agg = h.groupBy("design").agg(best.alias("b"), *[F.max(F.when(F.col("type") == t, F.col("tm"))).alias(f"max_tm_{t}") for t in types])
    agg = agg.select("design", (-F.col("b.k")).alias("best_tm"), F.col("b.t").alias("best_type"), F.col("b.l").alias("best_lddt"), *[f"max_tm_{t}" for t in types])
    return counts.select("design").join(agg, "design", "left")


def domain_composition(regions: DataFrame, ids: DataFrame, types: list[str]) -> DataFrame:
    """Per ID the count of each type and the sorted types joined by '-'; IDs without domains keep a row."""
    g = regions.groupBy("ID").agg(F.count(F.lit(1)).alias("n_domains"), *[F.count(F.when(F.col("domain") == t, 1)).alias(f"n_{t}") for t in types], F.array_join(F.array_sort(F.collect_list("domain")), "-").alias("architecture"))
    return ids.select("ID").join(g, "ID", "left").fillna(0, ["n_domains", *[f"n_{t}" for t in types]]).fillna("", ["architecture"])


def domain_features(tm: DataFrame, modules: DataFrame) -> DataFrame:
    """1 - the best score against each reference module of the same type: design,
    module, feature.  tm: design, type, domain_no, module, tm; alpha domains are
    split into the first and the later ones."""
    n = F.dense_rank().over(Window.partitionBy("design", "type").orderBy("domain_no"))
    t = tm.withColumn("slot", F.when(F.col("type") == "alpha", F.when(n == 1, "alpha1").otherwise("alpha2")).otherwise(F.col("type")))
    best = t.groupBy("design", "slot", "module").agg(F.max("tm").alias("tm"))
    return best.join(modules.select("module"), "module", "left_semi").select("design", "slot", "module", (1 - F.coalesce("tm", F.lit(0.0))).alias("feature"))


def prefer_rank1(structural: DataFrame, sequence: DataFrame, valid: DataFrame) -> DataFrame:
    """The rank-1 neighbour of each query among valid ids: the structural one, else that by sequence."""
    v = valid.select(F.col("id").alias("neighbour_id"))
    s = structural.filter("rank = 1").join(v, "neighbour_id", "left_semi").select("query_id", F.col("neighbour_id").alias("_s"), F.col("score").alias("_ss"))
    q = sequence.filter("rank = 1").join(v, "neighbour_id", "left_semi").select("query_id", F.col("neighbour_id").alias("_q"), F.col("score").alias("_qs"))
    j = s.join(q, "query_id", "full_outer")
    return j.select("query_id", F.coalesce("_s", "_q").alias("neighbour_id"), F.when(F.col("_s").isNotNull(), "structural").otherwise("sequence").alias("space"), F.coalesce(F.when(F.col("_s").isNotNull(), F.col("_ss")), F.col("_qs")).alias("score"))


def panel_match(ids: DataFrame, panel: DataFrame) -> DataFrame:
    """id, reference_id: the panel reference that equals the id, else the least that is a
    prefix of it or that it is a prefix of.

    Both sides are joined on their prefixes of the lengths that the other side has, so neither is broadcast."""
    p = panel.select("reference_id").filter("reference_id IS NOT NULL").distinct()
    i = ids.select("id").filter("id IS NOT NULL").distinct()

    def under(longer: DataFrame, x: str, shorter: DataFrame, y: str) -> DataFrame:
        sizes = sorted(r[0] for r in shorter.select(F.length(y)).distinct().collect())  # lengths of names: a few
        cut = F.filter(F.transform(F.array(*map(F.lit, sizes)), lambda n: F.when(n <= F.length(x), F.substring(F.col(x), F.lit(1), n))), lambda c: c.isNotNull())
        return longer.withColumn("_cut", F.explode(cut)).join(shorter, F.col("_cut") == F.col(y)).select("id", "reference_id")

    if not (i.limit(1).count() and p.limit(1).count()):
        return i.join(p, F.col("id") == F.col("reference_id")).select("id", "reference_id")
    both = under(i, "id", p, "reference_id").union(under(p, "reference_id", i, "id"))
    k = (F.col("id") != F.col("reference_id")).cast("int").alias("k")
    return both.groupBy("id").agg(F.min(F.struct(k, "reference_id")).alias("b")).select("id", F.col("b.reference_id").alias("reference_id"))


def strip_chain(edges: DataFrame, valid: DataFrame, id_col: str = "neighbour_id") -> DataFrame:
    """Neighbour ids as they are where known, else without their last _x where that is known."""
    v = valid.select(F.col("id").alias("_v")).distinct()
    cut = F.regexp_extract(F.col(id_col), r"^(.*)_[^_]*$", 1)
    e = edges.join(v, F.col(id_col) == F.col("_v"), "left").withColumn("_exact", F.col("_v").isNotNull()).drop("_v")
    e = e.withColumn("_cut", cut).join(v, F.col("_cut") == F.col("_v"), "left")
    return e.withColumn(id_col, F.when(F.col("_exact") | F.col("_v").isNull(), F.col(id_col)).otherwise(F.col("_cut"))).drop("_exact", "_cut", "_v")


def distance_matrix(pairs: DataFrame, q: str, t: str, s: str) -> DataFrame:
    """a, b, distance per unordered pair: 1 - the highest similarity, cut to [0, 1]."""
    a, b = F.least(q, t).alias("a"), F.greatest(q, t).alias("b")
    return pairs.filter(F.col(q) != F.col(t)).groupBy(a, b).agg((1 - F.least(F.greatest(F.max(s), F.lit(0.0)), F.lit(1.0))).alias("distance"))


def interdomain_blocks(pae: DataFrame, residues: DataFrame) -> DataFrame:
    """ID, domain_a, domain_b, pae: half the sum of the two block means.  pae: ID, i, j, value;
    residues: ID, residue, domain."""
    ra = residues.select(F.col("ID"), F.col("residue").alias("i"), F.col("domain").alias("da"))
    rb = residues.select(F.col("ID"), F.col("residue").alias("j"), F.col("domain").alias("db"))
    m = pae.join(ra, ["ID", "i"]).join(rb, ["ID", "j"]).filter("da <> db").groupBy("ID", "da", "db").agg(F.avg("value").alias("m"))
    return m.groupBy("ID", F.least("da", "db").alias("domain_a"), F.greatest("da", "db").alias("domain_b")).agg((F.sum("m") / 2).alias("pae"))
