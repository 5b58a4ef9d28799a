"""The registered queries of the selection engine, each with equivalent DuckDB SQL where SQL has one.

Doubles are rounded to six places on both sides, and every order is total.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions import geometry, seq, superpose, values
from winnow.functions.order import prepare_order
from winnow.operators import cluster, gate, hits, knn, merge, ranks, sequence_search, similarity, stats
from winnow.operators import select as sel
from winnow.operators.alignment import Scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c, name: str):
    return F.round(c, 6).alias(name)


# ------------------------------------------------------------------ selection

FLAGSHIP = {
    "group_by": "l_returnflag",
    "n_out_per_group": 16,
    "ops": [
        {"op": "gate", "conditions": [{"col": "l_quantity", "between": [5, 45]}, {"when": {"col": "l_returnflag", "eq": "R"}, "col": "l_discount", "le": 0.05}, {"any_of": [{"col": "p_size", "ge": 10}, {"col": "l_tax", "lt": 0.03}]}]},
        {"op": "band_filter", "metrics": {"l_extendedprice": {"by": "p_brand", "Brand#11": {"min": 5000}, "Brand#12": {"max": 60000}}}},
        {"op": "score", "zscore_within": "l_returnflag", "terms": [{"col": "l_extendedprice", "weight": 1, "direction": "higher"}, {"col": "l_discount", "weight": 1, "direction": "lower"}]},
    ],
}


def items(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return li.withColumn("ID", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


@query("""
WITH i AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS "ID" FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT * FROM i WHERE l_quantity BETWEEN 5 AND 45 AND (l_returnflag <> 'R' OR l_discount <= 0.05::DOUBLE) AND (p_size >= 10 OR l_tax < 0.03::DOUBLE)
  AND CASE p_brand WHEN 'Brand#11' THEN l_extendedprice >= 5000 WHEN 'Brand#12' THEN l_extendedprice <= 60000 ELSE true END),
s AS (SELECT *, (l_extendedprice - avg(l_extendedprice) OVER w) / stddev_pop(l_extendedprice) OVER w - (l_discount - avg(l_discount) OVER w) / stddev_pop(l_discount) OVER w AS score FROM g WINDOW w AS (PARTITION BY l_returnflag))
SELECT "ID", l_returnflag, p_brand, round(score, 6) AS score, n FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY score DESC, "ID") AS n FROM s) WHERE n <= 16
""")
def select_flagship(spark: SparkSession, d: str) -> DataFrame:
    out = sel.run_selection(items(spark, d), FLAGSHIP)
    return out.select("ID", "l_returnflag", "p_brand", r6(F.col("score"), "score"), F.col("score_rank").cast("long").alias("n"))


ORDERS_NULLS = "SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS flag, CASE o_orderkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN NULL ELSE '1' END AS textflag FROM orders"


def orders_nulls(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    o = o.withColumn("price", F.when(k % 7 != 0, F.col("o_totalprice"))).withColumn("flag", F.when(k % 5 != 0, k % 2 == 0))
    return o.withColumn("textflag", F.when(k % 4 == 0, "True").when(k % 4 == 1, "false").when(k % 4 == 3, "1"))


@query(f"""
WITH o AS ({ORDERS_NULLS}) SELECT o_orderkey, price FROM o WHERE price > 50000 AND price < 400000 AND price IS NOT NULL AND o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('1-URGENT') AND o_orderstatus <> 'P' AND price BETWEEN 60000 AND 300000
""")
def gate_leaves(spark: SparkSession, d: str) -> DataFrame:
    conds = [{"col": "price", "gt": 50000}, {"col": "price", "lt": 400000}, {"col": "price", "notnull": True}, {"col": "o_orderstatus", "in": ["F", "O"]}, {"col": "o_orderpriority", "not_in": ["1-URGENT"]}, {"col": "o_orderstatus", "ne": "P"}, {"col": "price", "between": [60000, 300000]}]
    return gate.apply_gate(orders_nulls(spark, d), conds).select("o_orderkey", "price")


@query(f"""
WITH o AS ({ORDERS_NULLS}) SELECT o_orderkey FROM o WHERE (price IS NULL OR (price >= 100000 AND o_orderstatus = 'O')) AND NOT (coalesce(flag, false) AND flag IS NOT NULL AND NOT coalesce(price <= 200000, false))
""")
def gate_nested(spark: SparkSession, d: str) -> DataFrame:
    conds = [{"any_of": [{"col": "price", "isnull": True}, {"all_of": [{"col": "price", "ge": 100000}, {"col": "o_orderstatus", "eq": "O"}]}]}, {"when": {"col": "flag", "eq": True}, "col": "price", "le": 200000}]
    return gate.apply_gate(orders_nulls(spark, d), conds).select("o_orderkey")


@query(f"""
WITH o AS ({ORDERS_NULLS}) SELECT o_orderkey FROM o WHERE flag = false AND lower(textflag) IN ('true', '1')
""")
def gate_boolean(spark: SparkSession, d: str) -> DataFrame:
    return gate.apply_gate(orders_nulls(spark, d), [{"col": "flag", "eq": False}, {"col": "textflag", "ne": False}]).select("o_orderkey")


@query(f"""
WITH o AS ({ORDERS_NULLS}) SELECT 'price >= 100000' AS condition, count(*) FILTER (price >= 100000) AS n_pass FROM o UNION ALL SELECT 'o_orderstatus eq F', count(*) FILTER (o_orderstatus = 'F') FROM o
""")
def gate_report(spark: SparkSession, d: str) -> DataFrame:
    return gate.gate_counts(orders_nulls(spark, d), [{"col": "price", "ge": 100000}, {"col": "o_orderstatus", "eq": "F"}])


@query("SELECT p_partkey FROM part WHERE p_retailprice BETWEEN 950 AND 1500 AND p_size >= 10")
def bands_plain(spark: SparkSession, d: str) -> DataFrame:
    return sel.band_filter(table(spark, d, "part"), {"p_retailprice": {"min": 950, "max": 1500}, "p_size": {"min": 10}}).select("p_partkey")


@query("""
WITH c AS (SELECT *, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_acctbal END AS bal FROM customer)
SELECT c_custkey FROM c WHERE seg IS NOT NULL AND CASE seg WHEN 'BUILDING' THEN coalesce(bal BETWEEN 0 AND 5000, false) WHEN 'MACHINERY' THEN coalesce(bal >= 1000, false) ELSE true END
""")
def bands_by(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").withColumn("seg", F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment"))).withColumn("bal", F.when(F.col("c_custkey") % 8 != 0, F.col("c_acctbal")))
    return sel.band_filter(c, {"bal": {"by": "seg", "BUILDING": {"min": 0, "max": 5000}, "MACHINERY": {"min": 1000}}}).select("c_custkey")


@query("""
WITH b AS (SELECT l_returnflag AS c, quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN b ON l_returnflag = c WHERE l_extendedprice BETWEEN lo AND hi
""")
def bands_from_stats(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    s = stats.numeric_stats(li, ["l_extendedprice"], ["l_returnflag"])
    bands = stats.export_bands(s, {"l_extendedprice": {}}, labeling="l_returnflag")
    return sel.band_join(li, bands, "l_extendedprice", "l_returnflag").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""
WITH o AS ({ORDERS_NULLS}), z AS (SELECT o_orderkey, o_orderpriority, 2 * (price - avg(price) OVER w) / stddev_pop(price) OVER w - (o_custkey - avg(o_custkey) OVER w) / stddev_pop(o_custkey) OVER w AS s FROM o WINDOW w AS (PARTITION BY o_orderpriority))
SELECT o_orderkey, round(s, 6) AS score, CASE WHEN s IS NOT NULL THEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY s DESC NULLS LAST, o_orderkey) END AS rk FROM z
""")
def score_groups(spark: SparkSession, d: str) -> DataFrame:
    out = sel.score(orders_nulls(spark, d), [{"col": "price", "weight": 2, "direction": "higher"}, {"col": "o_custkey", "weight": 1, "direction": "lower"}], "o_orderpriority", tie=("o_orderkey",))
    return out.select("o_orderkey", r6(F.col("score"), "score"), F.col("score_rank").cast("long").alias("rk"))


@query("""
SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS score FROM customer
""")
def score_global(spark: SparkSession, d: str) -> DataFrame:
    return sel.score(table(spark, d, "customer"), [{"col": "c_acctbal", "direction": "higher"}], tie=("c_custkey",)).select("c_custkey", r6(F.col("score"), "score"))


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 25")
def top_n(spark: SparkSession, d: str) -> DataFrame:
    return sel.take_top_n(table(spark, d, "orders"), 25, "o_orderpriority", "o_totalprice", ("o_orderkey",)).select("o_orderkey")


@query("""
WITH c AS (SELECT vec_id, embedding[1]::DOUBLE + 0.5 AS g, embedding[2]::DOUBLE + 0.5 AS f, CASE WHEN vec_id % 6 = 0 THEN NULL ELSE embedding[3]::DOUBLE END AS x FROM embeddings)
SELECT vec_id FROM c WHERE greatest(g, f) >= 0.5 AND coalesce(x <= 0.1, true)
""")
def specificity(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    v = lambda i: F.col("embedding")[i].cast("double")
    c = e.select("vec_id", (v(0) + 0.5).alias("GGPP_score"), (v(1) + 0.5).alias("CPP_score "), F.when(F.col("vec_id") % 6 != 0, v(2)).alias("FPP_score"), F.lit(1.0).alias("TPS_score"))
    return sel.substrate_specificity(c, "ggpp", 0.5, 0.35, {"FPP": 0.1}).select("vec_id")


@query("SELECT regexp_extract(c_name, '#0*([0-9])', 1) AS grp, count(*) AS n FROM customer WHERE regexp_extract(c_name, '#0*([0-9])', 1) <> '' GROUP BY 1")
def group_synthesis(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").withColumnRenamed("c_name", "ID")
    g = sel.with_group(c, {"group_by": "grp", "group_from_id": r"#0*([0-9])"})
    return sel.group_counts(g.filter("grp IS NOT NULL"), "grp")


@query("""
WITH t AS (SELECT doc_id, source, lang, n_chars, doc_id - doc_id % 3 AS rep FROM documents), u AS (SELECT *, count(*) OVER (PARTITION BY lang) AS m FROM t)
SELECT doc_id FROM (SELECT doc_id, m, row_number() OVER (PARTITION BY lang, rep ORDER BY n_chars DESC, doc_id) AS k FROM u) WHERE m <= 1 OR k = 1
""")
def diversity_map(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select(F.col("doc_id").alias("ID"), "lang", "n_chars", F.col("text").alias("sequence"))
    clusters = t.select(F.col("ID").alias("member"), (F.col("ID") - F.col("ID") % 3).alias("representative"))
    return sel.diversity_dedup(t, clusters, "n_chars", "lang").select(F.col("ID").alias("doc_id"))


# ------------------------------------------------------------------ merging

SLICES = """
a AS (SELECT c_custkey::VARCHAR AS "ID", CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal::VARCHAR END AS bal, c_mktsegment AS seg FROM customer WHERE c_custkey % 2 = 0),
b AS (SELECT c_custkey::VARCHAR AS "ID", (c_acctbal + 1)::VARCHAR AS bal, c_nationkey::VARCHAR AS nation FROM customer WHERE c_custkey % 5 <> 0)
"""


def slices(spark: SparkSession, d: str) -> list[DataFrame]:
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    a = c.filter(k % 2 == 0).select(k.alias("id"), F.when(k % 3 == 0, F.lit("NA")).otherwise(F.round(F.col("c_acctbal"), 2).cast("string")).alias("bal"), F.col("c_mktsegment").alias("seg"))
    b = c.filter(k % 5 != 0).select(k.alias("fa_id"), F.round(F.col("c_acctbal") + 1, 2).cast("string").alias("bal"), F.col("c_nationkey").cast("string").alias("nation"))
    return [a, b]


def _num(c: str):
    return r6(F.col(c).cast("double"), c)


@query(f"""WITH {SLICES} SELECT coalesce(a."ID", b."ID") AS "ID", round(coalesce(a.bal, b.bal)::DOUBLE, 2) AS bal, seg, nation FROM a FULL JOIN b ON a."ID" = b."ID" """)
def merge_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return merge.first_wins(slices(spark, d)).select("ID", F.round(F.col("bal").cast("double"), 2).alias("bal"), "seg", "nation")


@query(f"""WITH {SLICES} SELECT coalesce(a."ID", b."ID") AS "ID", round(CASE WHEN a."ID" IS NOT NULL THEN a.bal ELSE b.bal END::DOUBLE, 2) AS bal, seg, nation FROM a FULL JOIN b ON a."ID" = b."ID" """)
def merge_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return merge.first_wins(slices(spark, d), keep_blank=True).select("ID", F.round(F.col("bal").cast("double"), 2).alias("bal"), "seg", "nation")


@query("""
SELECT coalesce(c.k, o.k, l.k) AS k, c.bal, o.n_orders, l.q FROM (SELECT c_custkey AS k, c_acctbal AS bal FROM customer WHERE c_custkey % 3 = 0) c
FULL JOIN (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1) o ON c.k = o.k FULL JOIN (SELECT doc_id AS k, quality AS q FROM labels) l ON coalesce(c.k, o.k) = l.k
""")
def merge_outer(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"))
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    la = table(spark, d, "labels").select(F.col("doc_id").alias("k"), F.col("quality").alias("q"))
    return merge.outer_chain([c, o, la], "k")


@query("SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey")
def merge_reindex(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return merge.reindex(table(spark, d, "customer"), o, "c_custkey", {"n": 0})


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.struct("l_orderkey", "l_linenumber").alias("k"))
    return merge.duplicate_keys(li, "k").select("k.l_orderkey", "k.l_linenumber", F.col("count").alias("n"))


# ------------------------------------------------------------------ statistics

_P = ", ".join(f"round(quantile_cont(x, {q}), 6) AS {k}" for k, q in stats.PERCENTS.items())
_AGG = f"count(x) AS n, count(*) - count(x) AS n_missing, round(avg(x), 6) AS mean, round(coalesce(stddev_samp(x), 0), 6) AS std, min(x) AS min, max(x) AS max, {_P}"


_SUMMARY = f"""
WITH l AS (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS disc FROM lineitem), e AS (SELECT 'l_extendedprice' AS stat_column, l_extendedprice AS x, l_returnflag, l_linestatus FROM l UNION ALL SELECT 'disc', disc, l_returnflag, l_linestatus FROM l)
SELECT stat_column, NULL::VARCHAR AS labeling, NULL::VARCHAR AS label, {_AGG} FROM e GROUP BY 1
UNION ALL SELECT stat_column, 'l_returnflag', l_returnflag, {_AGG} FROM e GROUP BY 1, 3
UNION ALL SELECT stat_column, 'l_linestatus', l_linestatus, {_AGG} FROM e GROUP BY 1, 3
"""


@query(_SUMMARY)
def stats_numeric(spark: SparkSession, d: str, exact_rows: int | None = None) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("disc", F.when(F.col("l_linenumber") != 3, F.col("l_discount")))
    s = stats.numeric_stats(li, ["l_extendedprice", "disc"], ["l_returnflag", "l_linestatus"], exact_rows)
    return s.select("stat_column", "labeling", "label", "n", "n_missing", r6(F.col("mean"), "mean"), r6(F.col("std"), "std"), "min", "max", *[r6(F.col(k), k) for k in stats.PERCENTS])


@query(_SUMMARY)
def stats_searched(spark: SparkSession, d: str) -> DataFrame:
    """The same with every quantile searched for, as it is in large tables."""
    return stats_numeric(spark, d, 0)


@query("""SELECT event_type AS grp, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS q2, round(quantile_cont(v, 0.75), 6) AS q3, min(v) AS lo, max(v) AS hi, count(v) AS n
FROM (SELECT CASE WHEN event_id % 11 > 0 THEN event_type END AS event_type, CASE WHEN event_id % 3 = 0 THEN 1.5 WHEN event_id % 7 > 0 THEN value END AS v FROM events) GROUP BY 1""")
def boxplot_searched(spark: SparkSession, d: str) -> DataFrame:
    """A third of all values alike, some missing, and a group without a name."""
    k = F.col("event_id")
    e = table(spark, d, "events").select(F.when(k % 11 > 0, F.col("event_type")).alias("event_type"), F.when(k % 3 == 0, 1.5).when(k % 7 > 0, F.col("value")).alias("v"))
    return stats.boxplot(e, "v", "event_type", 0).select("grp", *[r6(F.col(c), c) for c in ("q1", "q2", "q3")], "lo", "hi", "n")


@query(f"""WITH o AS ({ORDERS_NULLS}) SELECT o_orderkey, CASE WHEN price IS NOT NULL THEN row_number() OVER (ORDER BY price DESC NULLS LAST, o_orderkey) END AS rk FROM o""")
def score_ranks(spark: SparkSession, d: str) -> DataFrame:
    """All rows in one group."""
    out = sel.score(orders_nulls(spark, d), [{"col": "price", "direction": "higher"}], tie=("o_orderkey",))
    return out.select("o_orderkey", F.col("score_rank").alias("rk"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY CASE WHEN l_tax > 0.01 THEN l_returnflag END ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rk FROM lineitem""")
def ranks_in_groups(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("grp", F.when(F.col("l_tax") > 0.01, F.col("l_returnflag")))
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return ranks.ranked(li, ["grp"], [F.col("l_shipdate").desc(), *map(F.col, key)], "rk").select(*key, "rk")


@query("SELECT event_id, row_number() OVER (ORDER BY value DESC NULLS LAST, event_id) AS place FROM events")
def places_in_order(spark: SparkSession, d: str) -> DataFrame:
    return ranks.placed(table(spark, d, "events"), [F.col("value").desc_nulls_last(), F.col("event_id")]).select("event_id", "place")


@query("""WITH t AS (SELECT doc_id, n_chars, coalesce(lang, '') || (doc_id % 50) AS rep FROM documents)
SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY rep ORDER BY n_chars DESC, doc_id) AS k FROM t) WHERE k = 1 ORDER BY n_chars DESC, doc_id LIMIT 40""")
def diversity_all(spark: SparkSession, d: str) -> DataFrame:
    """No group: the best of each cluster, and the best 40 of these."""
    t = table(spark, d, "documents").select(F.col("doc_id").alias("ID"), "lang", "n_chars", F.col("text").alias("sequence"))
    clusters = t.select(F.col("ID").alias("member"), F.concat(F.coalesce("lang", F.lit("")), F.col("ID") % 50).alias("representative"))
    return sel.diversity_dedup(t, clusters, "n_chars", None, 40).select(F.col("ID").alias("doc_id"))


@query("SELECT lang AS label, CASE WHEN n_chars > 1500 THEN 'True' ELSE 'False' END AS value, count(*) AS freq FROM documents GROUP BY 1, 2")
def stats_categorical(spark: SparkSession, d: str) -> DataFrame:
    return stats.categorical_stats(table(spark, d, "documents").withColumn("long_text", F.col("n_chars") > 1500), "long_text", "lang")


@query("SELECT count(event_type) AS n, count(*) - count(event_type) AS n_missing, count(DISTINCT event_type) AS n_unique FROM events")
def stats_summary(spark: SparkSession, d: str) -> DataFrame:
    return stats.categorical_summary(table(spark, d, "events"), "event_type")


@query("""
SELECT 'o_totalprice' AS metric, o_orderpriority AS category, round(quantile_cont(o_totalprice, 0.01), 6) AS lo, NULL::DOUBLE AS hi FROM orders GROUP BY 2
""")
def stats_bands(spark: SparkSession, d: str) -> DataFrame:
    s = stats.numeric_stats(table(spark, d, "orders"), ["o_totalprice"], ["o_orderpriority"])
    return stats.export_bands(s, {"o_totalprice": {"min": "p1", "max": None}}, labeling="o_orderpriority").select("metric", "category", r6(F.col("lo"), "lo"), "hi")


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY 1, 2)
SELECT user_id, label, n_votes, n FROM (SELECT user_id, event_type AS label, c AS n_votes, sum(c) OVER (PARTITION BY user_id)::BIGINT AS n, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, event_type) AS k FROM c) WHERE k = 1
""")
def mode_label(spark: SparkSession, d: str) -> DataFrame:
    return stats.mode_label(table(spark, d, "events"), "user_id", "event_type")


@query("SELECT user_id, min(event_type) AS primary_class, count(DISTINCT event_type) AS n_classes, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS all_classes FROM events GROUP BY 1")
def class_metadata(spark: SparkSession, d: str) -> DataFrame:
    return stats.class_metadata(table(spark, d, "events"), "user_id", "event_type")


@query("SELECT length(text) AS length, count(*) AS n FROM documents GROUP BY 1")
def length_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.length_histogram(table(spark, d, "documents"), "text")


@query("SELECT o_orderpriority AS grp, round(quantile_cont(o_totalprice, 0.25), 6) AS q1, round(quantile_cont(o_totalprice, 0.5), 6) AS q2, round(quantile_cont(o_totalprice, 0.75), 6) AS q3, min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n FROM orders GROUP BY 1")
def boxplot(spark: SparkSession, d: str) -> DataFrame:
    return stats.boxplot(table(spark, d, "orders"), "o_totalprice", "o_orderpriority").select("grp", *[r6(F.col(c), c) for c in ("q1", "q2", "q3")], "lo", "hi", "n")


# ------------------------------------------------------------------ neighbours and label transfer

_E = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, embedding[1:32]::DOUBLE[] AS v2 FROM embeddings)"
_PAIRS = "p AS (SELECT a.vec_id AS q, b.vec_id AS n, list_distance(a.v, b.v) AS s FROM e a JOIN e b ON a.vec_id <> b.vec_id), k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(s, 12), n) AS rk FROM p) WHERE rk <= 15)"


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


def neighbour_edges(spark: SparkSession, d: str, dims: int = 64) -> DataFrame:
    e = vectors(spark, d).select("vec_id", F.slice("embedding", 1, dims).alias("embedding"))
    return similarity.nearest(e, e, 15, self_mode=True)


@query(f"""WITH {_E}, {_PAIRS} SELECT q AS query_id, rk AS rank, n AS neighbour_id, round(s, 6) AS score FROM k""")
def neighbours_top_k(spark: SparkSession, d: str) -> DataFrame:
    return neighbour_edges(spark, d).select("query_id", F.col("rank").cast("long").alias("rank"), "neighbour_id", r6(F.col("score"), "score"))


@query(f"""WITH {_E}, {_PAIRS} SELECT q AS "ID", round(s, 6) AS min_embedding_distance, n AS hit FROM k WHERE rk = 1""")
def min_distance_self(spark: SparkSession, d: str) -> DataFrame:
    e = vectors(spark, d)
    return similarity.min_distance(e, e, self_mode=True).select("ID", r6(F.col("min_embedding_distance"), "min_embedding_distance"), "hit")


@query(f"""WITH {_E} SELECT q AS "ID", round(s, 6) AS min_embedding_distance, n AS hit FROM (SELECT a.vec_id AS q, b.vec_id AS n, list_distance(a.v, b.v) AS s, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 12), b.vec_id) AS rk FROM e a JOIN e b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id) WHERE rk = 1""")
def min_distance_two_sets(spark: SparkSession, d: str) -> DataFrame:
    e = vectors(spark, d)
    return similarity.min_distance(e.filter("vec_id % 100 = 0"), e, self_mode=True).select("ID", r6(F.col("min_embedding_distance"), "min_embedding_distance"), "hit")


_VOTE = f"""{_E}, {_PAIRS}, s AS (SELECT k.q, k.rk, e.label, 1 / (1 + k.s) AS sim FROM k JOIN e ON e.vec_id = k.n), nn AS (SELECT q, max(sim) AS nn FROM s GROUP BY 1),
c AS (SELECT q, label, sum(sim) AS w, count(*) AS n, min(rk) AS fr FROM s WHERE sim >= 0.43 GROUP BY 1, 2),
v AS (SELECT q, label, w / sum(w) OVER (PARTITION BY q) AS post, n / sum(n) OVER (PARTITION BY q) AS agree, sum(n) OVER (PARTITION BY q) AS voters, fr FROM c),
win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(post, 9) DESC, fr, label::VARCHAR) AS k FROM v) WHERE k = 1)"""


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select(F.col("vec_id").alias("id"), "label")


@query(f"""WITH {_VOTE} SELECT e.vec_id AS query_id, coalesce(label_, 'unknown') AS predicted, round(coalesce(post * agree * nn, 0), 6) AS confidence, round(nn, 6) AS nn, coalesce(voters, 0)::BIGINT AS n_voters
FROM e LEFT JOIN nn ON nn.q = e.vec_id LEFT JOIN (SELECT q, label::VARCHAR AS label_, post, agree, voters FROM win) w ON w.q = e.vec_id""")
def knn_vote(spark: SparkSession, d: str) -> DataFrame:
    le = knn.labelled_edges(neighbour_edges(spark, d), _labels(spark, d), "embedding")
    v = knn.vote(vectors(spark, d).select(F.col("vec_id").alias("query_id")), le, 0.43)
    return v.select("query_id", "predicted", r6(F.col("confidence"), "confidence"), r6(F.col("nn"), "nn"), F.col("n_voters").cast("long").alias("n_voters"))


@query(f"""WITH {_VOTE.replace("0.43", "0.0")}, r AS (SELECT nn.nn, (win.label = e.label)::INT AS ok FROM win JOIN nn ON nn.q = win.q JOIN e ON e.vec_id = win.q), b AS (SELECT round(i / 20.0, 4)::DOUBLE AS lo, round((i + 1) / 20.0, 4)::DOUBLE AS hi FROM range(20) t(i))
SELECT lo, hi, count(nn) AS n, round(avg(ok), 6) AS accuracy FROM b LEFT JOIN r ON nn >= lo AND nn < hi GROUP BY 1, 2""")
def knn_curve(spark: SparkSession, d: str) -> DataFrame:
    lab = _labels(spark, d)
    rec = knn._records(knn.labelled_edges(neighbour_edges(spark, d), lab, "embedding"), lab, 0.0)
    return knn.calibration_curve(rec).select("lo", "hi", "n", r6(F.col("accuracy"), "accuracy"))


@query(f"""WITH {_VOTE.replace("0.43", "0.0")}, r AS (SELECT nn.nn, (win.label = e.label)::INT AS ok FROM win JOIN nn ON nn.q = win.q JOIN e ON e.vec_id = win.q), cand AS (SELECT i / 100.0::DOUBLE AS c FROM range(101) t(i)),
a AS (SELECT c, count(*) AS n, avg(ok) AS acc FROM cand JOIN r ON nn >= c GROUP BY 1) SELECT greatest(coalesce(min(c) FILTER (n >= 20 AND acc >= 0.1), 0.0), 0.0)::DOUBLE AS tau FROM a""")
def knn_tau(spark: SparkSession, d: str) -> DataFrame:
    lab = _labels(spark, d)
    return knn.choose_tau(knn._records(knn.labelled_edges(neighbour_edges(spark, d), lab, "embedding"), lab, 0.0), 0.0, 0.1)


_ENS = f"""{_E}, pp AS (SELECT a.vec_id AS q, b.vec_id AS n, list_distance(a.v, b.v) AS s1, list_distance(a.v2, b.v2) AS s2 FROM e a JOIN e b ON a.vec_id <> b.vec_id),
kk AS (SELECT q, n, 0 AS sp, s1 AS s, row_number() OVER (PARTITION BY q ORDER BY round(s1, 12), n) AS rk FROM pp UNION ALL SELECT q, n, 1, s2, row_number() OVER (PARTITION BY q ORDER BY round(s2, 12), n) FROM pp),
s AS (SELECT q, sp, rk, label, 1 / (1 + s) AS sim FROM kk JOIN e ON e.vec_id = kk.n WHERE rk <= 15), nn AS (SELECT q, max(sim) AS max_nn FROM s GROUP BY 1),
c AS (SELECT q, sp, label, sum(sim) AS w, min(rk) AS fr FROM s GROUP BY 1, 2, 3), v AS (SELECT q, sp, label, w / sum(w) OVER (PARTITION BY q, sp) AS post, fr FROM c),
t AS (SELECT q, label, sum(post) AS p, min(sp * 1000 + fr) AS o FROM v GROUP BY 1, 2)"""


@query(f"""WITH {_ENS} SELECT t.q AS query_id, t.label AS predicted, round(max_nn, 6) AS max_nn FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(p, 9) DESC, o, label::VARCHAR) AS k FROM t) t JOIN nn ON nn.q = t.q WHERE k = 1""")
def knn_ensemble(spark: SparkSession, d: str) -> DataFrame:
    lab = _labels(spark, d)
    post = {i: knn.posteriors(knn.labelled_edges(neighbour_edges(spark, d, n), lab, "embedding"), 0.0) for i, n in ((0, 64), (1, 32))}
    return knn.ensemble(post).select("query_id", "predicted", r6(F.col("max_nn"), "max_nn"))


@query("""
SELECT vec_id, CASE WHEN v < 400 THEN 'GPP' WHEN v < 900 THEN 'FPP' WHEN v < 1600 THEN 'GGPP' ELSE 'GFPP' END AS band, CASE WHEN v < 400 THEN true WHEN v < 900 THEN true WHEN v < 1600 THEN true ELSE false END AS near_fpp FROM (SELECT vec_id, abs(embedding[1]::DOUBLE) * 8000 AS v FROM embeddings)
""")
def pocket_bands(spark: SparkSession, d: str) -> DataFrame:
    v = F.abs(F.col("embedding")[0].cast("double")) * 8000
    b = knn.volume_band(v)
    return vectors(spark, d).select("vec_id", b.alias("band"), knn.within_one_size(F.lit("FPP"), b).alias("near_fpp"))


@query("""
WITH k AS (SELECT vec_id::VARCHAR AS "ID", CASE WHEN vec_id % 4 = 0 THEN 'unknown' WHEN vec_id % 4 = 1 THEN 'FPP' ELSE 'GGPP' END AS kn FROM embeddings), p AS (SELECT vec_id::VARCHAR AS "ID", 300.0::DOUBLE * (vec_id % 7) AS v FROM embeddings WHERE vec_id % 3 <> 0), e AS (SELECT vec_id::VARCHAR AS "ID", CASE WHEN vec_id % 2 = 0 THEN 'FPP' ELSE 'GGPP' END AS ee FROM embeddings WHERE vec_id % 5 <> 0),
j AS (SELECT k."ID", kn, v, ee, CASE WHEN v < 400 THEN 1 WHEN v < 900 THEN 2 WHEN v < 1600 THEN 3 WHEN v >= 1600 THEN 4 END AS b, CASE kn WHEN 'FPP' THEN 2 WHEN 'GGPP' THEN 3 END AS r FROM k LEFT JOIN p ON k."ID" = p."ID" LEFT JOIN e ON k."ID" = e."ID")
SELECT "ID", CASE WHEN kn <> 'unknown' THEN kn WHEN ee IS NOT NULL THEN ee ELSE 'unknown' END AS predicted_substrate, CASE WHEN kn <> 'unknown' THEN 'knn' WHEN ee IS NOT NULL THEN 'ee' ELSE 'none' END AS src, abs(r - b) <= 1 AS substrate_agreement, CASE WHEN kn <> 'unknown' THEN kn = ee END AS ee_agreement,
coalesce((abs(r - b) <= 1)::INT, 0) + coalesce((CASE WHEN kn <> 'unknown' THEN kn = ee END)::INT, 0) AS n_signals_agree FROM j
""")
def substrate_fusion(spark: SparkSession, d: str) -> DataFrame:
    e = vectors(spark, d).select(F.col("vec_id").cast("string").alias("ID"), "vec_id")
    k = e.select("ID", F.when(F.col("vec_id") % 4 == 0, "unknown").when(F.col("vec_id") % 4 == 1, "FPP").otherwise("GGPP").alias("knn_substrate"), F.lit(0.5).alias("knn_confidence"))
    p = e.filter("vec_id % 3 <> 0").select("ID", (F.lit(300.0) * (F.col("vec_id") % 7)).alias("volume"))
    x = e.filter("vec_id % 5 <> 0").select("ID", F.when(F.col("vec_id") % 2 == 0, "FPP").otherwise("GGPP").alias("ee_substrate"), F.lit(0.9).alias("ee_score"))
    return knn.fuse(k, p, x).select("ID", "predicted_substrate", F.col("predicted_substrate_source").alias("src"), "substrate_agreement", "ee_agreement", "n_signals_agree")


# ------------------------------------------------------------------ hits

_H = "h AS (SELECT l_orderkey::VARCHAR AS query, l_partkey::VARCHAR AS target, l_extendedprice AS bits, l_quantity AS identity, l_discount AS score FROM lineitem)"


def hit_table(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("query"), F.col("l_partkey").cast("string").alias("target"), F.col("l_extendedprice").alias("bits"), F.col("l_quantity").alias("identity"), F.col("l_discount").alias("score"))


@query(f"WITH {_H} SELECT query, target, bits, identity FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bits DESC, identity DESC, target) AS k FROM h) WHERE k = 1")
def best_hits(spark: SparkSession, d: str) -> DataFrame:
    return hits.best_hits(hit_table(spark, d)).select("query", "target", "bits", "identity")


@query(f"WITH {_H} SELECT o_orderkey::VARCHAR AS \"ID\", target AS hit, coalesce(identity, 0) AS identity, coalesce(bits, 0) AS bits FROM orders LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bits DESC, identity DESC, target) AS k FROM h) WHERE k = 1) ON query = o_orderkey::VARCHAR")
def best_hit_summary(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("ID"))
    return hits.best_hit_summary(ids, hit_table(spark, d))


@query(f"WITH {_H}, m AS (SELECT p_partkey::VARCHAR AS m FROM part WHERE p_size < 15), r AS (SELECT h.*, row_number() OVER (PARTITION BY query ORDER BY bits DESC, target) AS rk FROM h), t AS (SELECT r.*, m IS NOT NULL AS mem FROM r LEFT JOIN m ON target = m WHERE rk <= 3) SELECT query, max(CASE WHEN rk = 1 THEN target END) AS top_hit, max(CASE WHEN rk = 1 THEN identity END) AS top_value, max(CASE WHEN rk = 1 THEN bits END) AS top_order, bool_or(CASE WHEN rk = 1 THEN mem END) AS top_is_member, max(CASE WHEN NOT mem THEN identity END) AS best_other_value, count(*) FILTER (mem) AS n_members FROM t GROUP BY 1")
def hit_summary(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "part").filter("p_size < 15").select(F.col("p_partkey").cast("string").alias("member"))
    return hits.hit_summary(hit_table(spark, d), m, 3)


@query(f"WITH {_H}, p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query, target ORDER BY bits DESC, score DESC) AS k FROM h) WHERE k = 1) SELECT query AS query_id, rank, target AS neighbour_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, bits DESC, target) AS rank FROM p) WHERE rank <= 2")
def top_k_hits(spark: SparkSession, d: str) -> DataFrame:
    return hits.top_k_hits(hit_table(spark, d), 2).withColumn("rank", F.col("rank").cast("long"))


@query(f"WITH {_H} SELECT a.query, a.bits, a.target AS bits_hit, b.identity, b.target AS identity_hit FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bits DESC, target) AS k FROM h) a JOIN (SELECT *, row_number() OVER (PARTITION BY query ORDER BY identity DESC, target) AS k FROM h) b ON a.query = b.query AND a.k = 1 AND b.k = 1")
def independent_best(spark: SparkSession, d: str) -> DataFrame:
    return hits.independent_best(hit_table(spark, d), ["bits", "identity"])


@query("""
WITH s AS (SELECT doc_id AS q, (doc_id + 1) % 50 AS n FROM documents WHERE doc_id % 3 = 0), z AS (SELECT doc_id AS q, (doc_id * 7) % 50 AS n FROM documents WHERE doc_id % 2 = 0)
SELECT coalesce(s.q, z.q) AS query_id, coalesce(s.n, z.n) AS neighbour_id, CASE WHEN s.q IS NOT NULL THEN 'structural' ELSE 'sequence' END AS space FROM (SELECT * FROM s WHERE n < 30) s FULL JOIN (SELECT * FROM z WHERE n < 30) z ON s.q = z.q
""")
def rank1_preference(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "documents").select(F.col("doc_id").alias("query_id"))
    s = k.filter("query_id % 3 = 0").select("query_id", F.lit(1).alias("rank"), ((F.col("query_id") + 1) % 50).alias("neighbour_id"), F.lit(0.9).alias("score"))
    z = k.filter("query_id % 2 = 0").select("query_id", F.lit(1).alias("rank"), ((F.col("query_id") * 7) % 50).alias("neighbour_id"), F.lit(80.0).alias("score"))
    return hits.prefer_rank1(s, z, spark.range(30)).select("query_id", "neighbour_id", "space")


@query("""
SELECT user_id AS "ID", count(*) AS n_domains, count(*) FILTER (event_type = 'click') AS n_click, count(*) FILTER (event_type = 'view') AS n_view, string_agg(event_type, '-' ORDER BY event_type) AS architecture FROM events GROUP BY 1
""")
def domain_composition(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("ID"), F.col("event_type").alias("domain"))
    return hits.domain_composition(e, e.select("ID").distinct(), ["click", "view"])


@query("""
SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, round(1 - least(greatest(max(l_discount * 12), 0), 1), 6) AS distance FROM lineitem WHERE l_partkey <> l_suppkey GROUP BY 1, 2
""")
def distance_matrix(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "lineitem").withColumn("s", F.col("l_discount") * 12)
    return hits.distance_matrix(p, "l_partkey", "l_suppkey", "s").select("a", "b", r6(F.col("distance"), "distance"))


@query("""
WITH p AS (SELECT l_returnflag AS "ID", l_linenumber AS i, (l_suppkey % 7 + 1)::INT AS j, l_quantity AS v FROM lineitem), r AS (SELECT 1 AS x, 'a' AS d UNION ALL SELECT 2, 'a' UNION ALL SELECT 3, 'b' UNION ALL SELECT 4, 'b' UNION ALL SELECT 5, 'c'),
m AS (SELECT "ID", a.d AS da, b.d AS db, avg(v) AS m FROM p JOIN r a ON a.x = i JOIN r b ON b.x = j WHERE a.d <> b.d GROUP BY 1, 2, 3)
SELECT "ID", least(da, db) AS domain_a, greatest(da, db) AS domain_b, round(sum(m) / 2, 6) AS pae FROM m GROUP BY 1, 2, 3
""")
def interdomain_blocks(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    p = li.select(F.col("l_returnflag").alias("ID"), F.col("l_linenumber").alias("i"), (F.col("l_suppkey") % 7 + 1).cast("int").alias("j"), F.col("l_quantity").alias("value"))
    dom = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c")], "residue int, domain string")
    res = p.select("ID").distinct().crossJoin(F.broadcast(dom))  # five residues
    return hits.interdomain_blocks(p, res).select("ID", "domain_a", "domain_b", r6(F.col("pae"), "pae"))


@query("""
WITH l AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'doc' || doc_id || '_A' ELSE 'doc' || doc_id END AS n FROM documents), v AS (SELECT 'doc' || doc_id AS id FROM documents WHERE doc_id % 3 <> 0)
SELECT doc_id AS query_id, CASE WHEN n IN (SELECT id FROM v) THEN n WHEN n LIKE '%\\_A' ESCAPE '\\' AND regexp_replace(n, '_A$', '') IN (SELECT id FROM v) THEN regexp_replace(n, '_A$', '') ELSE n END AS neighbour_id FROM l
""")
def chain_suffix(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    t = table(spark, d, "documents")
    e = t.select(k.alias("query_id"), F.when(k % 2 == 0, F.concat(F.lit("doc"), k, F.lit("_A"))).otherwise(F.concat(F.lit("doc"), k)).alias("neighbour_id"))
    v = t.filter("doc_id % 3 <> 0").select(F.concat(F.lit("doc"), k).alias("id"))
    return hits.strip_chain(e, v).select("query_id", "neighbour_id")


# ------------------------------------------------------------------ sequences

_U = "t AS (SELECT doc_id, upper(regexp_replace(text, '[^\\x00-\\x7F]', '_', 'g')) AS s FROM documents)"
_DNA = "t AS (SELECT doc_id, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTAC') AS s FROM documents)"


def upper_docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.upper(F.regexp_replace("text", r"[^\x00-\x7F]", "_")).alias("sequence"))


def dna_docs(spark: SparkSession, d: str) -> DataFrame:
    s = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAC")
    return table(spark, d, "documents").select("doc_id", s.alias("sequence"))


@query(f"WITH {_U} SELECT doc_id, regexp_matches(s, '[DE][DE]..[DE]') AS m1, regexp_matches(s, '(N|D)D(L|I|V).(S|T)...E') AS m2 FROM t")
def motifs(spark: SparkSession, d: str) -> DataFrame:
    m = [seq.DDXXD, seq.NSE_DTE]
    return seq.find_motifs(upper_docs(spark, d), m).select("doc_id", F.col(f"`{m[0]}`").alias("m1"), F.col(f"`{m[1]}`").alias("m2"))


@query(f"WITH {_U}, x AS (SELECT doc_id, s, regexp_extract(s, '[DE][DE]..[DE]') AS a, regexp_extract(s, '(N|D)D(L|I|V).(S|T)...E') AS b FROM t) SELECT doc_id, a AS ddxxd_motif, CASE WHEN a <> '' THEN instr(s, a) - 1 END AS ddxxd_start, CASE WHEN a <> '' AND b <> '' THEN instr(s, b) - instr(s, a) END AS motif_start_distance FROM x")
def motif_pair(spark: SparkSession, d: str) -> DataFrame:
    out = seq.motif_pair(upper_docs(spark, d))
    return out.select("doc_id", "ddxxd_motif", F.col("ddxxd_start").cast("long").alias("ddxxd_start"), F.col("motif_start_distance").cast("long").alias("motif_start_distance"))


@query(f"WITH {_DNA} SELECT doc_id, reverse(translate(s, 'ACGT', 'TGCA')) AS rc, length(s) AS n FROM t")
def reverse_complement(spark: SparkSession, d: str) -> DataFrame:
    return dna_docs(spark, d).select("doc_id", seq.revcomp(F.col("sequence")).alias("rc"), F.length("sequence").alias("n"))


@query(f"WITH {_DNA} SELECT doc_id, coalesce(list_max(list_transform(regexp_extract_all(s, 'A+|C+|G+|T+'), lambda x: length(x))), 0)::INT AS longest FROM t")
def homopolymer(spark: SparkSession, d: str) -> DataFrame:
    return dna_docs(spark, d).select("doc_id", seq.max_homopolymer(F.col("sequence")).alias("longest"))


@query(f"""WITH {_DNA}, c AS (SELECT doc_id, least(length(s), 50) AS w, unnest(regexp_extract_all(s, '.')) AS x, unnest(range(length(s))) AS i FROM t WHERE length(s) > 0),
r AS (SELECT doc_id, w, i, sum((x IN ('G', 'C'))::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS 49 PRECEDING) AS k FROM c)
SELECT doc_id, round(min(k / w), 6) AS gc_min, round(max(k / w), 6) AS gc_max FROM r WHERE i >= w - 1 GROUP BY 1""")
def gc_windows(spark: SparkSession, d: str) -> DataFrame:
    lo, hi = seq.gc_window(F.col("sequence"), 50)
    return dna_docs(spark, d).filter("length(sequence) > 0").select("doc_id", r6(lo, "gc_min"), r6(hi, "gc_max"))


@query("SELECT item_id, array_to_string(list_sort(list_distinct(string_split(regexp_replace(upper(regexp_replace(text, '[^ -~]', '', 'g')), '[ACDEFGHIKLMNPQRSTVWY]', '', 'g'), ''))), '') AS odd FROM benchmark")
def alphabet_check(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select("item_id", F.array_join(seq.odd_characters(F.upper(F.regexp_replace("text", "[^ -~]", ""))), "").alias("odd"))


@query("SELECT doc_id, 'P' || doc_id AS a, 'Q' || doc_id AS b, 'x_' || doc_id AS stem FROM documents")
def accessions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id").cast("string")
    t = table(spark, d, "documents")
    return t.select("doc_id", seq.accession(F.concat(F.lit("sp|P"), k, F.lit("|NAME"))).alias("a"), seq.accession(F.concat(F.lit("AF-Q"), k, F.lit("-F1-model_v4"))).alias("b"), seq.query_stem(F.concat(F.lit("/tmp/x_"), k, F.lit("_model.cif"))).alias("stem"))


# ------------------------------------------------------------------ geometry

_XYZ = "(SELECT label, vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS b FROM embeddings)"


def points(spark: SparkSession, d: str) -> DataFrame:
    v = lambda i: F.col("embedding")[i].cast("double")
    return vectors(spark, d).select(F.col("label").alias("struct_id"), "vec_id", v(0).alias("x"), v(1).alias("y"), v(2).alias("z"), v(3).alias("b"))


@query(f"SELECT label AS struct_id, count(*) AS n, round(sqrt(var_pop(x) + var_pop(y) + var_pop(z)), 6) AS radius_of_gyration FROM {_XYZ} GROUP BY 1")
def gyration_radius(spark: SparkSession, d: str) -> DataFrame:
    return geometry.gyration(points(spark, d)).select("struct_id", "n", r6(F.col("radius_of_gyration"), "radius_of_gyration"))


@query(f"SELECT label AS struct_id, round(avg(b), 6) AS avg_score, round(sum(b), 6) AS total_score, max(b) AS max_score, min(b) AS min_score, round(sum(greatest(b, 0)), 6) AS positive_sum, count(b) AS n_residues FROM {_XYZ} GROUP BY 1")
def residue_scores(spark: SparkSession, d: str) -> DataFrame:
    s = geometry.score_summary(points(spark, d), "struct_id", "b")
    return s.select("struct_id", r6(F.col("avg_score"), "avg_score"), r6(F.col("total_score"), "total_score"), "max_score", "min_score", r6(F.col("positive_sum"), "positive_sum"), "n_residues")


@query(f"""
WITH p AS (SELECT label AS s, vec_id % 5 AS k, x, y, z FROM {_XYZ}), m AS (SELECT label AS s, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM {_XYZ} GROUP BY 1), c AS (SELECT s, k, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM p GROUP BY 1, 2),
d AS (SELECT s, k, sqrt((cx - mx) ** 2 + (cy - my) ** 2 + (cz - mz) ** 2) AS d FROM c JOIN m USING (s)) SELECT s AS struct_id, arg_min(k, d) AS pocket, round(min(d), 6) AS distance FROM d GROUP BY 1
""")
def nearest_pocket(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d)
    m = p.groupBy("struct_id").agg(*[F.avg(c).alias(f"m{c}") for c in "xyz"])
    c = p.groupBy("struct_id", (F.col("vec_id") % 5).alias("pocket")).agg(*[F.avg(c).alias(c) for c in "xyz"])
    return geometry.nearest_pocket(c, m).select("struct_id", "pocket", r6(F.col("distance"), "distance"))


# ------------------------------------------------------------------ small joins and look-ups


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 15) AS is_member FROM lineitem")
def membership(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("acc", F.concat(F.lit("p"), F.col("l_partkey"), F.lit(".2")))
    m = table(spark, d, "part").filter("p_size < 15").select(F.concat(F.lit("P"), F.col("p_partkey")).alias("member"))
    return hits.membership(li, "acc", m).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "is_member")


@query("SELECT doc_id, coalesce(q, -1) AS label FROM documents LEFT JOIN (SELECT doc_id, min(quality) AS q FROM labels GROUP BY 1) USING (doc_id)")
def labels_join(spark: SparkSession, d: str) -> DataFrame:
    la = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return merge.labels_join(table(spark, d, "documents"), la, "doc_id")


@query("SELECT vec_id, CASE WHEN x >= 0.6 THEN 0.9 WHEN x >= 0.3 THEN 0.5 ELSE 0.5 END::DOUBLE AS c FROM (SELECT vec_id, abs(embedding[1]::DOUBLE) * 4 AS x FROM embeddings)")
def curve_lookup(spark: SparkSession, d: str) -> DataFrame:
    curve = [{"lo": 0.0, "hi": 0.3, "n": 0, "accuracy": None}, {"lo": 0.3, "hi": 0.6, "n": 4, "accuracy": 0.5}, {"lo": 0.6, "hi": 0.65, "n": 9, "accuracy": 0.9}, {"lo": 0.65, "hi": 1.0, "n": 0, "accuracy": None}]
    return vectors(spark, d).select("vec_id", knn.calibrated(F.abs(F.col("embedding")[0].cast("double")) * 4, curve).alias("c"))


@query("SELECT c_custkey::VARCHAR AS \"ID\", round(c_acctbal, 2) AS bal, CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE '1' END AS mixed FROM customer")
def numeric_inference(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(k.cast("string").alias(" fa_id "), F.round(F.col("c_acctbal"), 2).cast("string").alias("bal"), F.when(k % 2 == 0, "x").otherwise("1").alias("mixed"))
    return values.infer_numbers(values.without_missing(values.with_id(values.strip_names(c))))


@query("""WITH n AS (SELECT doc_id, 'd' || (doc_id % 7) || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '_x' || doc_id END AS n FROM documents), p AS (SELECT unnest(['d0', 'd1', 'd1_x1', 'd2', 'd3', 'd4_x', 'd5_x5_y']) AS r)
SELECT doc_id AS id, r AS reference_id FROM (SELECT doc_id, r, row_number() OVER (PARTITION BY doc_id ORDER BY (n <> r)::INT, r) AS k FROM n JOIN p ON starts_with(n, r) OR starts_with(r, n)) WHERE k = 1""")
def panel_match(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    name = F.concat(F.lit("d"), k % 7, F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("_x"), k)))
    t = table(spark, d, "documents").select(k.alias("doc_id"), name.alias("n"))
    panel = spark.createDataFrame([(x,) for x in ("d0", "d1", "d1_x1", "d2", "d3", "d4_x", "d5_x5_y")], "reference_id string")
    return t.join(hits.panel_match(t.select(F.col("n").alias("id")), panel), F.col("n") == F.col("id")).select(F.col("doc_id").alias("id"), "reference_id")


@query("SELECT * FROM (SELECT a.vec_id AS query_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(abs(a.v - b.v), 12), b.vec_id) AS rank, b.vec_id AS neighbour_id, round(abs(a.v - b.v), 6) AS score FROM (SELECT vec_id, round(embedding[1]::DOUBLE * 10) AS v FROM embeddings) a JOIN (SELECT vec_id, round(embedding[1]::DOUBLE * 10) AS v FROM embeddings) b ON a.vec_id <> b.vec_id) WHERE rank <= 3")
def neighbours_among_ties(spark: SparkSession, d: str) -> DataFrame:
    e = vectors(spark, d).select("vec_id", F.array(F.rint(F.col("embedding")[0].cast("double") * 10)).alias("embedding"))
    return similarity.nearest(e, e, 3, self_mode=True).select("query_id", F.col("rank").cast("long").alias("rank"), "neighbour_id", r6(F.col("score"), "score"))


# ------------------------------------------------------------------ names and scalars


@query("SELECT doc_id, regexp_extract(text, '^([^ \t]*)', 1) AS first FROM documents")
def first_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", values.first_token(F.col("text")).alias("first"))


@query("SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') AS safe FROM pages")
def safe_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", seq.safe_id(F.col("url")).alias("safe"))


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN 'e_' || user_id END AS id, CASE event_id % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' END AS type, CASE WHEN event_id % 3 < 2 THEN (event_id % 9)::INT END AS no FROM events")
def module_names(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    kind = F.when(k % 3 == 0, "alpha").when(k % 3 == 1, "beta").otherwise("gamma")
    m = seq.module_parts(F.concat(F.lit("e_"), F.col("user_id"), F.lit("_"), kind, F.lit("_"), k % 9), ["alpha", "beta"])
    return table(spark, d, "events").select("event_id", m["id"].alias("id"), m["type"].alias("type"), m["no"].alias("no"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(pow(10.0::DOUBLE, l_discount * 10), 6) AS absolute, round(exp(l_tax * 10), 6) AS perplexity FROM lineitem")
def log_scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(seq.from_log10(F.col("l_discount") * 10), "absolute"), r6(seq.pseudo_perplexity(F.col("l_tax") * -10), "perplexity"))


@query(f"""WITH {_U}, x AS (SELECT doc_id, s, regexp_extract(s, '[DE][DE]..[DE]') AS a, regexp_extract(s, '(N|D)D(L|I|V).(S|T)...E') AS b FROM t), y AS (SELECT doc_id, CASE WHEN a <> '' THEN instr(s, a) - 1 END AS i, CASE WHEN b <> '' THEN instr(s, b) - 1 END AS j FROM x)
SELECT doc_id, CASE WHEN i IS NOT NULL THEN array_to_string(list_concat([i, i + 1, i + 4], CASE WHEN j IS NULL THEN [] ELSE [j, j + 1, j + 4, j + 8] END), ',') END AS residues FROM y""")
def coordinating_residues(spark: SparkSession, d: str) -> DataFrame:
    return upper_docs(spark, d).select("doc_id", F.array_join(seq.coordinating_relaxed(F.col("sequence")).cast("array<string>"), ",").alias("residues"))


@query("""WITH c AS (SELECT o_orderpriority AS a, o_totalprice::VARCHAR AS b, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey::VARCHAR END AS c, CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE 'x' END AS e FROM orders)
SELECT 'o_orderkey' AS stat_column, 'numeric' AS kind UNION ALL SELECT 'flag', 'categorical'
UNION ALL SELECT 'a', CASE WHEN count(a) > 0 AND count(try_cast(a AS DOUBLE)) = count(a) THEN 'numeric' ELSE 'categorical' END FROM c
UNION ALL SELECT 'b', CASE WHEN count(b) > 0 AND count(try_cast(b AS DOUBLE)) = count(b) THEN 'numeric' ELSE 'categorical' END FROM c
UNION ALL SELECT 'c', CASE WHEN count(c) > 0 AND count(try_cast(c AS DOUBLE)) = count(c) THEN 'numeric' ELSE 'categorical' END FROM c
UNION ALL SELECT 'e', CASE WHEN count(e) > 0 AND count(try_cast(e AS DOUBLE)) = count(e) THEN 'numeric' ELSE 'categorical' END FROM c""")
def column_kinds(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select("o_orderkey", (k % 2 == 0).alias("flag"), F.col("o_orderpriority").alias("a"), F.col("o_totalprice").cast("string").alias("b"), F.when(k % 3 != 0, k.cast("string")).alias("c"), F.when(k % 2 == 0, "1").otherwise("x").alias("e"))
    return spark.createDataFrame(sorted(stats.classify(o, o.columns).items()), "stat_column string, kind string")


# ------------------------------------------------------------------ domains, substrates, transfer


@query("""WITH h AS (SELECT l_orderkey AS design, l_partkey AS reference, l_returnflag AS type, l_discount AS tm, l_tax AS lddt FROM lineitem WHERE l_orderkey <> l_partkey),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY design ORDER BY tm DESC, reference, type, lddt) AS k FROM h) WHERE k = 1), m AS (SELECT design, max(tm) FILTER (type = 'A') AS max_tm_A, max(tm) FILTER (type = 'N') AS max_tm_N, max(tm) FILTER (type = 'R') AS max_tm_R FROM h GROUP BY 1)
SELECT o_orderkey AS design, tm AS best_tm, type AS best_type, lddt AS best_lddt, max_tm_A, max_tm_N, max_tm_R FROM orders LEFT JOIN b ON b.design = o_orderkey LEFT JOIN m ON m.design = o_orderkey""")
def domain_best(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("design"), F.col("l_partkey").alias("reference"), F.col("l_returnflag").alias("type"), F.col("l_discount").alias("tm"), F.col("l_tax").alias("lddt"))
    return hits.domain_reduce(h, table(spark, d, "orders").select(F.col("o_orderkey").alias("design")), ["A", "N", "R"], exclude_self=True)


@query("""WITH t AS (SELECT l_orderkey AS design, CASE l_returnflag WHEN 'R' THEN 'alpha' ELSE l_returnflag END AS type, l_linenumber AS domain_no, l_suppkey AS module, l_discount AS tm FROM lineitem),
s AS (SELECT *, CASE WHEN type <> 'alpha' THEN type WHEN dense_rank() OVER (PARTITION BY design, type ORDER BY domain_no) = 1 THEN 'alpha1' ELSE 'alpha2' END AS slot FROM t)
SELECT design, slot, module, round(1 - max(tm), 6) AS feature FROM s WHERE module IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 13) GROUP BY 1, 2, 3""")
def domain_feature_rows(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", "alpha").otherwise(F.col("l_returnflag"))
    tm = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("design"), kind.alias("type"), F.col("l_linenumber").alias("domain_no"), F.col("l_suppkey").alias("module"), F.col("l_discount").alias("tm"))
    modules = table(spark, d, "supplier").filter("s_nationkey < 13").select(F.col("s_suppkey").alias("module"))
    return hits.domain_features(tm, modules).select("design", "slot", "module", r6(F.col("feature"), "feature"))


@query("""WITH c AS (SELECT c_custkey::VARCHAR AS id, c_acctbal AS g, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_nationkey * 400.0::DOUBLE END AS f, c_acctbal AS p, CASE WHEN c_custkey % 5 = 0 THEN 9000.0::DOUBLE END AS q FROM customer)
SELECT id AS "ID", CASE WHEN s = g THEN 'GPP' WHEN s = f THEN 'FPP' ELSE 'GGPP' END AS ee_substrate, s AS ee_score FROM (SELECT *, greatest(g, f, p, q) AS s FROM c)""")
def best_substrate(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(k.cast("string").alias("ID"), F.col("c_acctbal").alias("GPP_score"), F.when(k % 4 != 0, F.col("c_nationkey") * 400.0).alias("x (farnesyl pyrophosphate)"), F.col("c_acctbal").alias("CPP_score"), F.when(k % 5 == 0, 9000.0).alias("GGPP_score"), F.lit(1e9).alias("isTPS_score"))
    return knn.ee_argmax(c)


_CURVE = [{"lo": 0.0, "hi": 0.3, "n": 5, "accuracy": 0.2}, {"lo": 0.3, "hi": 0.45, "n": 0, "accuracy": None}, {"lo": 0.45, "hi": 0.46, "n": 4, "accuracy": 0.5}, {"lo": 0.46, "hi": 1.0, "n": 9, "accuracy": 0.9}]


@query(f"""WITH {_VOTE}, c2 AS (SELECT q, nn, CASE WHEN nn >= 0.46 THEN 0.9::DOUBLE WHEN nn >= 0.45 THEN 0.5::DOUBLE ELSE 0.2::DOUBLE END AS cal FROM nn)
SELECT c2.q AS query_id, coalesce(win.label::VARCHAR, 'unknown') AS embedding_label, CASE WHEN win.q IS NULL THEN 0.0::DOUBLE ELSE cal END AS embedding_confidence, round(nn, 6) AS embedding_nn_similarity, coalesce(win.label::VARCHAR, 'unknown') AS label, CASE WHEN win.q IS NULL THEN 0.0::DOUBLE ELSE cal END AS confidence
FROM c2 LEFT JOIN win ON win.q = c2.q""")
def label_transfer(spark: SparkSession, d: str) -> DataFrame:
    calibration = {"spaces": {"embedding": {"tau": 0.43, "calibration_curve": _CURVE}}, "ensemble": {"calibration_curve": _CURVE}}
    t = knn.transfer({"embedding": neighbour_edges(spark, d)}, _labels(spark, d), calibration)
    return t.select("query_id", "embedding_label", "embedding_confidence", r6(F.col("embedding_nn_similarity"), "embedding_nn_similarity"), "label", "confidence")


# ------------------------------------------------------------------ structures

_ATOMS = """a AS (SELECT label::VARCHAR AS struct_id, (vec_id // 4)::INT AS res_idx, ['CA', 'NE', 'OH', 'NZ'][vec_id % 4 + 1] AS atom_name, ['ARG', 'TYR', 'LYS', 'GLY', 'PHE'][(vec_id // 4) % 5 + 1] AS res_name,
  embedding[1]::DOUBLE * 10 AS x, embedding[2]::DOUBLE * 10 AS y, embedding[3]::DOUBLE * 10 AS z, 70 + embedding[4]::DOUBLE * 100 AS b, CASE vec_id % 3 WHEN 0 THEN 'MG' ELSE 'C' END AS element, vec_id % 11 = 0 AS hetero FROM embeddings)"""


def atoms(spark: SparkSession, d: str) -> DataFrame:
    """An atom table made of the vectors."""
    k, at = F.col("vec_id"), lambda names, i: F.array(*map(F.lit, names))[i.cast("int")]
    v = lambda i: F.col("embedding")[i].cast("double")
    res = F.floor(k / 4).cast("int")
    return vectors(spark, d).select(F.col("label").cast("string").alias("struct_id"), res.alias("res_idx"), at(["CA", "NE", "OH", "NZ"], k % 4).alias("atom_name"), at(["ARG", "TYR", "LYS", "GLY", "PHE"], res % 5).alias("res_name"), (v(0) * 10).alias("x"), (v(1) * 10).alias("y"), (v(2) * 10).alias("z"), (70 + v(3) * 100).alias("b"), F.when(k % 3 == 0, "MG").otherwise("C").alias("element"), (k % 11 == 0).alias("hetero"))


# Small structures: one a vector, of 21 residues with C-alpha and C-beta atoms; some lack a motif, some atoms are missing.
FOLDS = ("GDDAADGGRLNDLASAGKEGY", "AGDEFFEGKTRDDIGTPLMEV", "GDDAADDEKLEADASYRKEGY", "KGDDAADGGNDVASAGKESYW")
_THREE = {v: k for k, v in geometry.ONE.items()}
_FOLDS = f"""r AS (SELECT vec_id, i, substr([{', '.join(f"'{x}'" for x in FOLDS)}][vec_id % 4 + 1], i::INT + 1, 1) AS l, embedding::DOUBLE[] AS v FROM embeddings, range(21) t(i)),
a AS (SELECT vec_id::VARCHAR AS struct_id, vec_id, i AS res_idx, l, v[3 * i + 1] * 10 AS x, v[3 * i + 2] * 10 AS y, v[3 * i + 3] * 10 AS z,
  CASE WHEN l <> 'G' AND (vec_id + i) % 13 > 0 THEN v[3 * i + 1] * 10 + v[62 - 3 * i] END AS bx, v[3 * i + 1] * 10 + v[62 - 3 * i] AS sx, v[3 * i + 2] * 10 + v[63 - 3 * i] AS by_, v[3 * i + 3] * 10 + v[64 - 3 * i] AS bz FROM r)"""


def folds(spark: SparkSession, d: str) -> DataFrame:
    """The atom table of the small structures."""
    k, res = F.col("vec_id"), F.col("res_idx")
    e = vectors(spark, d).select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("res_idx"))
    e = e.withColumn("l", F.substring(F.array(*map(F.lit, FOLDS))[(k % 4).cast("int")], res + 1, F.lit(1)))
    v = lambda i: F.col("embedding")[i].cast("double")
    ca = F.struct(F.lit("CA").alias("atom_name"), *[(v(3 * res + c) * 10).alias(x) for c, x in enumerate("xyz")])
    cb = F.struct(F.lit("CB").alias("atom_name"), *[(v(3 * res + c) * 10 + v(61 + c - 3 * res)).alias(x) for c, x in enumerate("xyz")])
    names = F.create_map(*[F.lit(x) for kv in _THREE.items() for x in kv])
    e = e.withColumn("at", F.explode(F.when((F.col("l") != "G") & ((k + res) % 13 > 0), F.array(ca, cb)).otherwise(F.array(ca))))
    return e.select(k.cast("string").alias("struct_id"), "res_idx", names[F.col("l")].alias("res_name"), "at.*", F.lit(False).alias("hetero"), F.lit("C").alias("element"), F.lit(80.0).alias("b"))


_CONSTELLATIONS = f"""{_FOLDS}, q AS (SELECT struct_id, string_agg(l, '' ORDER BY res_idx) AS s FROM a GROUP BY 1),
m AS (SELECT struct_id, strpos(s, regexp_extract(s, '[DE][DE]..[DE]')) - 1 AS p, strpos(s, regexp_extract(s, '(N|D)D(L|I|V).(S|T)...E')) - 1 AS t FROM q WHERE regexp_matches(s, '[DE][DE]..[DE]') AND regexp_matches(s, '(N|D)D(L|I|V).(S|T)...E')),
o AS (SELECT struct_id, unnest([p, p + 1, p + 4, t, t + 1, t + 4, t + 8]) AS res_idx, unnest(range(7)) AS slot FROM m),
c AS (SELECT struct_id, slot, 'CA' AS atom, x, y, z FROM o JOIN a USING (struct_id, res_idx) UNION ALL SELECT struct_id, slot, 'CB', bx, by_, bz FROM o JOIN a USING (struct_id, res_idx) WHERE bx IS NOT NULL)"""


@query(f"WITH {_CONSTELLATIONS} SELECT struct_id, slot * 2 + (atom = 'CB')::INT AS place, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM c")
def constellation_atoms(spark: SparkSession, d: str) -> DataFrame:
    c = superpose.constellations(folds(spark, d)).select("struct_id", F.posexplode("points").alias("place", "p")).where("p IS NOT NULL")
    return c.select("struct_id", F.col("place").cast("long").alias("place"), *[r6(F.col("p")[i], x) for i, x in enumerate("xyz")])


@query(f"""WITH {_CONSTELLATIONS},
s AS (SELECT a.struct_id, b.struct_id AS template, count(*) AS n, {', '.join(f'sum(a.{i} * b.{j}) - sum(a.{i}) * sum(b.{j}) / count(*) AS c{i}{j}' for i in 'xyz' for j in 'xyz')},
  {' + '.join(f'sum({k}.{i} * {k}.{i}) - sum({k}.{i}) * sum({k}.{i}) / count(*)' for i in 'xyz' for k in 'ab')} AS e0 FROM c a JOIN c b ON a.slot = b.slot AND a.atom = b.atom AND b.struct_id::BIGINT % 40 = 0 GROUP BY 1, 2 HAVING count(*) >= 3),
g AS (SELECT *, cxx * (cyy * czz - cyz * czy) - cxy * (cyx * czz - cyz * czx) + cxz * (cyx * czy - cyy * czx) AS det, {', '.join(f"{' + '.join(f'c{k}{i} * c{k}{j}' for k in 'xyz')} AS m{i}{j}" for i, j in ('xx', 'yy', 'zz', 'xy', 'xz', 'yz'))} FROM s),
h AS (SELECT *, (mxx + myy + mzz) / 3 AS q FROM g),
k AS (SELECT *, sqrt(((mxx - q) ** 2 + (myy - q) ** 2 + (mzz - q) ** 2 + 2 * (mxy * mxy + mxz * mxz + myz * myz)) / 6) AS p FROM h),
l AS (SELECT *, acos(greatest(-1, least(1, ((mxx - q) * ((myy - q) * (mzz - q) - myz * myz) - mxy * (mxy * (mzz - q) - myz * mxz) + mxz * (mxy * myz - (myy - q) * mxz)) / (2 * p ** 3)))) / 3 AS f FROM k),
v AS (SELECT *, q + 2 * p * cos(f) AS e1, q + 2 * p * cos(f + 2 * pi() / 3) AS e3 FROM l),
w AS (SELECT struct_id, template, round(sqrt(greatest(0, e0 - 2 * (sqrt(greatest(e1, 0)) + sqrt(greatest(3 * q - e1 - e3, 0)) + sign(det) * sqrt(greatest(e3, 0)))) / n), 4) AS rmsd FROM v)
SELECT struct_id, min(rmsd) AS rmsd, arg_min(template, (rmsd, template)) AS template FROM w GROUP BY 1""")
def template_match(spark: SparkSession, d: str) -> DataFrame:
    c = superpose.constellations(folds(spark, d))
    t = superpose.best_templates(c, c.where(F.col("struct_id").cast("long") % 40 == 0), 4)
    return t.select("struct_id", F.round("catalytic_constellation_rmsd", 4).alias("rmsd"), "template")


@query(f"""WITH {_FOLDS}, p AS (SELECT struct_id, res_idx, l, CASE WHEN (vec_id * 7 + res_idx * 3) % 5 = 0 THEN 'W' ELSE l END AS w, (vec_id % 10) / 20.0 + 0.4 AS sim FROM a WHERE res_idx % 3 = 0),
g AS (SELECT struct_id, any_value(sim) AS sim, count(*) AS n, count(*) FILTER (l = w) AS same, coalesce(string_agg(l || (res_idx + 1) || w, ';' ORDER BY res_idx) FILTER (l <> w), '') AS list FROM p GROUP BY 1)
SELECT 'd' || struct_id AS design, struct_id AS neighbour, CASE WHEN sim >= 0.6 THEN n ELSE 0 END AS n_sdr_positions, CASE WHEN sim >= 0.6 THEN round(same / n, 6) END AS sdr_identity, CASE WHEN sim >= 0.6 THEN n - same END AS n_sdr_mismatches,
  CASE WHEN sim >= 0.6 THEN list ELSE '' END AS divergent_positions, sim >= 0.6 AND same / n <= 0.7 AS specificity_divergence FROM g""")
def sdr_rotated(spark: SparkSession, d: str) -> DataFrame:
    """Every structure beside a copy of itself, turned and shifted, in which some residues are others: every third residue is in the panel."""
    ca = geometry.calphas(folds(spark, d))
    k = F.col("struct_id").cast("long")
    turn = k % 360 * 0.7
    one = F.create_map(*[F.lit(x) for kv in geometry.ONE.items() for x in kv])[F.col("res_name")]

    def made(name, letter, x, y, z):
        r = F.array_sort(F.collect_list(F.struct("res_idx", letter.alias("l"), F.array(x, y, z).alias("p"))))
        return ca.groupBy(name.alias("id")).agg(r.alias("r")).select("id", F.array_join(F.transform("r", lambda e: e["l"]), "").alias("sequence"), F.transform("r", lambda e: e["p"]).alias("ca"))

    known = made(F.col("struct_id"), one, F.col("x"), F.col("y"), F.col("z"))
    changed = F.when((k * 7 + F.col("res_idx") * 3) % 5 == 0, "W").otherwise(one)
    copies = made(F.concat(F.lit("d"), "struct_id"), changed, F.cos(turn) * F.col("x") - F.sin(turn) * F.col("y") + 30, F.sin(turn) * F.col("x") + F.cos(turn) * F.col("y") - 7, F.col("z") * 1.0 + k % 17)
    pairs = vectors(spark, d).select(F.concat(F.lit("d"), "vec_id").alias("design"), F.col("vec_id").cast("string").alias("neighbour"), (F.col("vec_id") % 10 / 20.0 + 0.4).alias("similarity"))
    panel = known.select("id", F.sequence(F.lit(0), F.lit(20), F.lit(3)).alias("residues"))
    out = superpose.divergence(pairs, known.union(copies), panel)
    return out.select("design", "neighbour", "n_sdr_positions", r6(F.col("sdr_identity"), "sdr_identity"), "n_sdr_mismatches", "divergent_positions", "specificity_divergence")


# The same with the tips of side chains and up to two ions beside some of them.
TIPS = {"D": "OD1", "E": "OE1", "N": "OD1", "S": "OG", "T": "OG1", "K": "NZ", "R": "NE", "Y": "OH"}
_MOTIFS = {"p": r"[DE][DE]..[DE]", "t": r"(N|D)D(L|I|V).(S|T)...E"}
_STARTS = {k: str([[m.start() for m in re.finditer(v, x)] for x in FOLDS]) for k, v in _MOTIFS.items()}
_DIST = "sqrt(({a}.x - {b}.x) ** 2 + ({a}.y - {b}.y) ** 2 + ({a}.z - {b}.z) ** 2)"
_SITES = f"""{_FOLDS}, tip AS (SELECT struct_id, vec_id, res_idx, l, sx AS x, by_ AS y, bz AS z FROM a WHERE l IN ({', '.join(f"'{x}'" for x in TIPS)})),
prot AS (SELECT struct_id, res_idx, l, x, y, z FROM a UNION ALL SELECT struct_id, res_idx, l, x, y, z FROM tip),
ion AS (SELECT struct_id, j, sx + 0.3 * (j + 1) AS x, by_ AS y, bz AS z FROM a, range(2) t(j) WHERE j < vec_id % 3 AND res_idx = (vec_id * 5 + j * 9) % 21),
hit AS (SELECT struct_id, vec_id, m, s, s + o AS res_idx FROM (SELECT DISTINCT struct_id, vec_id FROM a), (VALUES ('p', {_STARTS['p']}, [0, 1, 4]), ('t', {_STARTS['t']}, [0, 1, 4, 8])) k(m, starts, offsets), unnest(starts[vec_id % 4 + 1]) u(s), unnest(offsets) w(o)),
lead AS (SELECT h.* FROM hit h WHERE s = {{first}}),
oxy AS (SELECT * FROM tip WHERE l IN ('D', 'E', 'N', 'S', 'T')),
cage AS (SELECT DISTINCT o.* FROM oxy o JOIN lead USING (struct_id, res_idx)),
mp AS (SELECT struct_id, avg(x) AS x, avg(y) AS y, avg(z) AS z, count(*) AS n FROM cage GROUP BY 1)""".replace("{first}", "(SELECT min(s) FROM hit g WHERE g.struct_id = h.struct_id AND g.m = h.m)")


def sites(spark: SparkSession, d: str) -> DataFrame:
    """The atom table with side chains and ions."""
    k, res = F.col("vec_id"), F.col("res_idx")
    e = vectors(spark, d).select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("res_idx"))
    e = e.withColumn("l", F.substring(F.array(*map(F.lit, FOLDS))[(k % 4).cast("int")], res + 1, F.lit(1)))
    v = lambda i: F.col("embedding")[i].cast("double")
    names, tips = (F.create_map(*[F.lit(x) for kv in m.items() for x in kv]) for m in (_THREE, TIPS))
    side = [v(3 * res + c) * 10 + v(61 + c - 3 * res) for c in range(3)]
    atom = lambda r, n, name, xyz, het, el: F.struct(r.cast("int").alias("res_idx"), n.alias("res_name"), name.alias("atom_name"), *[x.alias(c) for x, c in zip(xyz, "xyz", strict=True)], F.lit(het).alias("hetero"), F.lit(el).alias("element"))
    ca = F.array(atom(res, names[F.col("l")], F.lit("CA"), [v(3 * res + c) * 10 for c in range(3)], False, "C"))
    tip = F.when(tips[F.col("l")].isNotNull(), F.array(atom(res, names[F.col("l")], tips[F.col("l")], side, False, "O")))
    ion = [F.when((F.lit(j) < k % 3) & (res == (k * 5 + j * 9) % 21), F.array(atom(F.lit(100 + j), F.lit("MG"), F.lit("MG"), [side[0] + 0.3 * (j + 1), *side[1:]], True, "MG"))) for j in (0, 1)]
    none = F.array().cast(e.select(ca.alias("c")).schema["c"].dataType)
    e = e.withColumn("at", F.explode(F.concat(ca, *[F.coalesce(x, none) for x in (tip, *ion)])))
    return e.select(k.cast("string").alias("struct_id"), "at.*", F.lit(80.0).alias("b"))


@query(f"WITH {_SITES} SELECT struct_id, round(x, 6) AS mx, round(y, 6) AS my, round(z, 6) AS mz, n AS n_coordinating_oxygens FROM mp")
def metal_points(spark: SparkSession, d: str) -> DataFrame:
    return geometry.metal_point(sites(spark, d)).select("struct_id", *[r6(F.col(c), c) for c in ("mx", "my", "mz")], "n_coordinating_oxygens")


@query(f"WITH {_SITES} SELECT struct_id, res_idx, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM cage")
def coordinating_oxygens(spark: SparkSession, d: str) -> DataFrame:
    return geometry.cage(sites(spark, d)).select("struct_id", F.col("res_idx").cast("long").alias("res_idx"), *[r6(F.col(c), c) for c in "xyz"])


@query(f"""WITH {_SITES}, cr AS (SELECT struct_id, avg({_DIST.format(a='c', b='m')}) AS r FROM cage c JOIN mp m USING (struct_id) GROUP BY 1), v AS (SELECT struct_id, min({_DIST.format(a='p', b='m')}) AS v FROM prot p JOIN mp m USING (struct_id) GROUP BY 1)
SELECT s.struct_id, 21 AS n_residues, round(r, 6) AS carboxylate_convergence_radius, n AS n_coordinating_oxygens, round(v, 6) AS metal_point_void FROM (SELECT DISTINCT struct_id FROM a) s LEFT JOIN mp USING (struct_id) LEFT JOIN cr USING (struct_id) LEFT JOIN v USING (struct_id)""")
def active_sites(spark: SparkSession, d: str) -> DataFrame:
    a = geometry.active_site(sites(spark, d))
    return a.select("struct_id", "n_residues", r6(F.col("carboxylate_convergence_radius"), "carboxylate_convergence_radius"), "n_coordinating_oxygens", r6(F.col("metal_point_void"), "metal_point_void"))


@query(f"""WITH {_SITES}, f AS (SELECT m, a.* FROM a JOIN lead USING (struct_id, res_idx)), g AS (SELECT struct_id, m, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM f GROUP BY 1, 2)
SELECT p.struct_id, round(any_value({_DIST.format(a='u', b='w')}), 6) AS motif_centroid_distance, round(min({_DIST.format(a='p', b='t')}), 6) AS motif_min_distance
FROM f p JOIN f t ON p.struct_id = t.struct_id AND p.m = 'p' AND t.m = 't' JOIN g u ON u.struct_id = p.struct_id AND u.m = 'p' JOIN g w ON w.struct_id = p.struct_id AND w.m = 't' GROUP BY 1""")
def motif_structural_distance(spark: SparkSession, d: str) -> DataFrame:
    m = geometry.motif_distance(sites(spark, d))
    return m.select("struct_id", *[r6(F.col(c), c) for c in ("motif_centroid_distance", "motif_min_distance")])


@query(f"""WITH {_SITES}, t AS (SELECT i.struct_id, j, count(c.x) FILTER ({_DIST.format(a='i', b='c')} <= 1.2) AS touch FROM ion i JOIN cage c USING (struct_id) GROUP BY 1, 2), e AS (SELECT i.struct_id, t.touch, {_DIST.format(a='i', b='m')} AS d FROM ion i JOIN mp m USING (struct_id) JOIN t USING (struct_id, j)),
g AS (SELECT struct_id, count(*) AS n, min(d) AS d, count(*) FILTER (d <= 1.5) AS s, count(*) FILTER (touch >= 2) AS c, max(touch) AS k FROM e GROUP BY 1)
SELECT m.struct_id, coalesce(g.n, 0) AS n_ions_modelled, round(d, 6) AS min_ion_to_cage_dist, coalesce(s, 0) AS n_ions_in_site, coalesce(c, 0) AS n_ions_coordinated, coalesce(k, 0) AS max_contacts, coalesce(c, 0) > 0 AS well_placed FROM mp m LEFT JOIN g USING (struct_id)""")
def ion_sites(spark: SparkSession, d: str) -> DataFrame:
    i = geometry.ion_site_check(sites(spark, d), 1.5, 1.2, 2)
    return i.select("struct_id", "n_ions_modelled", r6(F.col("min_ion_to_cage_dist"), "min_ion_to_cage_dist"), "n_ions_in_site", "n_ions_coordinated", "max_contacts", "well_placed")


@query(f"""WITH {_SITES}, held AS (SELECT DISTINCT o.struct_id, o.res_idx FROM oxy o JOIN ion i ON o.struct_id = i.struct_id AND {_DIST.format(a='o', b='i')} <= 1.2), cen AS (SELECT struct_id, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM ion GROUP BY 1),
n AS (SELECT struct_id, count(DISTINCT res_idx) FILTER (m = 'p') AS p, count(DISTINCT res_idx) FILTER (m = 't') AS t FROM hit JOIN held USING (struct_id, res_idx) GROUP BY 1),
oc AS (SELECT struct_id, s, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM hit JOIN oxy USING (struct_id, res_idx) WHERE m = 'p' GROUP BY 1, 2), dd AS (SELECT struct_id, min({_DIST.format(a='oc', b='cen')}) AS d FROM oc JOIN cen USING (struct_id) GROUP BY 1)
SELECT struct_id, coalesce(p, 0) > 0 AND coalesce(t, 0) > 0 AS mg_canonical_motif_coordination, coalesce(p, 0) AS n_motif_coord_asp, coalesce(t, 0) AS n_motif_coord_nse, round(d, 6) AS mg_to_motif_dist FROM cen LEFT JOIN n USING (struct_id) LEFT JOIN dd USING (struct_id)""")
def motif_ions(spark: SparkSession, d: str) -> DataFrame:
    m = geometry.motif_coordination(sites(spark, d), 1.2)
    return m.select("struct_id", "mg_canonical_motif_coordination", "n_motif_coord_asp", "n_motif_coord_nse", r6(F.col("mg_to_motif_dist"), "mg_to_motif_dist"))


@query(f"WITH {_SITES} SELECT i.struct_id, j, p.res_idx, p.l, round({_DIST.format(a='i', b='p')}, 6) AS d FROM ion i JOIN prot p ON i.struct_id = p.struct_id AND {_DIST.format(a='i', b='p')} <= 0.7")
def atoms_near_ions(spark: SparkSession, d: str) -> DataFrame:
    """A join of points by cells."""
    a = sites(spark, d)
    i = geometry.ions(a).select("struct_id", (F.col("res_idx") - 100).cast("long").alias("j"), *[F.col(c).alias(f"b{c}") for c in "xyz"])
    p = geometry.near_pairs(a.where("NOT hetero").withColumn("l", geometry.letters()), i, 0.7)
    return p.select("struct_id", "j", F.col("res_idx").cast("long").alias("res_idx"), "l", r6(F.col("d"), "d"))


@query(f"""WITH {_SITES}, near AS (SELECT DISTINCT p.struct_id, p.res_idx, p.l FROM prot p JOIN mp m ON p.struct_id = m.struct_id AND {_DIST.format(a='p', b='m')} <= 1.5), s AS (SELECT a.*, {_DIST.format(a='a', b='m')} AS d FROM near JOIN a USING (struct_id, res_idx) JOIN mp m USING (struct_id))
SELECT struct_id, count(*) AS n_shell_residues, round(avg((l IN ('D', 'E'))::INT), 6) AS frac_acidic, round(avg((l IN ('F', 'Y', 'W'))::INT), 6) AS frac_aromatic, round(avg((l = 'G')::INT), 6) AS frac_glycine, round(avg((l = 'A')::INT), 6) AS frac_aa_A,
  round(sqrt(var_pop(x) + var_pop(y) + var_pop(z)), 6) AS shell_radius_of_gyration, round(avg(d), 6) AS mean_dist_to_metal_point, count(*) FILTER (l IN ('F', 'Y', 'W') AND d <= 1.2) AS n_aromatic_within_8A FROM s GROUP BY 1""")
def site_shares(spark: SparkSession, d: str) -> DataFrame:
    f = geometry.site_features(sites(spark, d), 1.5, 1.2)
    return f.select("struct_id", "n_shell_residues", *[r6(F.col(c), c) for c in ("frac_acidic", "frac_aromatic", "frac_glycine", "frac_aa_A", "shell_radius_of_gyration", "mean_dist_to_metal_point")], "n_aromatic_within_8A")


@query(f"""WITH {_SITES}, c AS (SELECT a.struct_id, a.res_idx, {_DIST.format(a='a', b='m')} AS ca FROM a JOIN mp m USING (struct_id)), b AS (SELECT t.struct_id, t.res_idx, t.l, t.x, t.y, t.z, {_DIST.format(a='t', b='m')} AS d, ca FROM tip t JOIN mp m USING (struct_id) JOIN c ON c.struct_id = t.struct_id AND c.res_idx = t.res_idx WHERE l IN ('K', 'R')),
k AS (SELECT * FROM b WHERE d <= 2.5 AND d < ca), y AS (SELECT * FROM tip WHERE l = 'Y'), ry AS (SELECT DISTINCT k.struct_id FROM k JOIN y USING (struct_id) WHERE k.l = 'R' AND (abs(k.res_idx - y.res_idx) <= 2 OR {_DIST.format(a='k', b='y')} <= 1.5)), n AS (SELECT struct_id, count(*) AS n, min(d) AS d FROM k GROUP BY 1)
SELECT m.struct_id, coalesce(n.n, 0) AS n_diphosphate_basic_residues, round(d, 6) AS min_basic_distance, ry.struct_id IS NOT NULL AS "has_RY_pair" FROM mp m LEFT JOIN n USING (struct_id) LEFT JOIN ry ON ry.struct_id = m.struct_id""")
def basic_sensors(spark: SparkSession, d: str) -> DataFrame:
    s = geometry.diphosphate_sensor(sites(spark, d), 2.5, 1.5, 2)
    return s.select("struct_id", "n_diphosphate_basic_residues", r6(F.col("min_basic_distance"), "min_basic_distance"), "has_RY_pair")


@query(f"""WITH {_SITES}, p AS (SELECT struct_id, res_idx // 7 AS pocket, x, y, z FROM a), pc AS (SELECT struct_id, pocket, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM p GROUP BY 1, 2),
g AS (SELECT p.struct_id, p.pocket, min({_DIST.format(a='p', b='m')}) AS dmin, avg({_DIST.format(a='p', b='c')}) AS depth, any_value({_DIST.format(a='c', b='m')}) <= max({_DIST.format(a='p', b='c')}) AS enclosed FROM p JOIN pc c ON p.struct_id = c.struct_id AND p.pocket = c.pocket JOIN mp m ON m.struct_id = p.struct_id GROUP BY 1, 2)
SELECT struct_id, pocket, round(dmin, 6) AS dmin, enclosed, round(depth, 6) AS pocket_depth FROM (SELECT *, row_number() OVER (PARTITION BY struct_id ORDER BY enclosed DESC, dmin, pocket) AS k FROM g WHERE dmin <= 1.2) WHERE k = 1""")
def pocket_choice(spark: SparkSession, d: str) -> DataFrame:
    s = sites(spark, d)
    spheres = geometry.calphas(s).select("struct_id", F.floor(F.col("res_idx") / 7).alias("pocket"), "x", "y", "z")
    c = geometry.choose_pocket(spheres, geometry.metal_point(s), 1.2)
    return c.select("struct_id", "pocket", r6(F.col("dmin"), "dmin"), "enclosed", r6(F.col("pocket_depth"), "pocket_depth"))


@query(f"""WITH {_SITES}, near AS (SELECT DISTINCT p.struct_id, p.res_idx, p.l FROM prot p JOIN mp m ON p.struct_id = m.struct_id AND {_DIST.format(a='p', b='m')} <= 1.5)
SELECT struct_id, count(*) AS n_pocket_residues, count(*) FILTER (l = 'W') AS n_trp, count(*) FILTER (l = 'Y') AS n_tyr, count(*) FILTER (l = 'F') AS n_phe, count(*) FILTER (l IN ('W', 'Y', 'F')) AS n_pocket_aromatics, round(avg((l IN ('W', 'Y', 'F'))::INT), 6) AS aromatic_fraction FROM near GROUP BY 1""")
def aromatic_pockets(spark: SparkSession, d: str) -> DataFrame:
    a = geometry.aromatic_lining(sites(spark, d), 1.5)
    return a.select("struct_id", "n_pocket_residues", "n_trp", "n_tyr", "n_phe", "n_pocket_aromatics", r6(F.col("aromatic_fraction"), "aromatic_fraction"))


@query(f"WITH {_ATOMS} SELECT struct_id, round(avg(b), 6) AS mean_plddt, round(quantile_cont(b, 0.5), 6) AS median_plddt, round(min(b), 6) AS min_plddt, round(avg((b >= 70)::INT), 6) AS fraction_confident, count(*) AS n_residues FROM a WHERE atom_name = 'CA' AND NOT hetero GROUP BY 1")
def plddt(spark: SparkSession, d: str) -> DataFrame:
    p = geometry.plddt_summary(atoms(spark, d))
    return p.select("struct_id", *[r6(F.col(c), c) for c in ("mean_plddt", "median_plddt", "min_plddt", "fraction_confident")], "n_residues")


@query(f"WITH {_ATOMS}, r AS (SELECT DISTINCT struct_id, res_idx, CASE res_name WHEN 'ARG' THEN 'R' WHEN 'TYR' THEN 'Y' WHEN 'LYS' THEN 'K' WHEN 'GLY' THEN 'G' ELSE 'F' END AS l FROM a WHERE NOT hetero) SELECT struct_id, string_agg(l, '' ORDER BY res_idx) AS sequence, count(*)::INT AS n_residues FROM r GROUP BY 1")
def structure_sequences(spark: SparkSession, d: str) -> DataFrame:
    return geometry.sequences(atoms(spark, d))


@query(f"WITH {_ATOMS} SELECT struct_id, res_idx, res_name, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(b, 6) AS b FROM a WHERE atom_name = 'CA' AND NOT hetero")
def alpha_carbons(spark: SparkSession, d: str) -> DataFrame:
    return geometry.calphas(atoms(spark, d)).select("struct_id", "res_idx", "res_name", *[r6(F.col(c), c) for c in "xyzb"])


@query(f"WITH {_ATOMS} SELECT struct_id, res_idx, atom_name, round(x, 6) AS x FROM a WHERE hetero AND element = 'MG'")
def ion_atoms(spark: SparkSession, d: str) -> DataFrame:
    return geometry.ions(atoms(spark, d)).select("struct_id", "res_idx", "atom_name", r6(F.col("x"), "x"))


# ------------------------------------------------------------------ without SQL


@query()
def pca(spark: SparkSession, d: str) -> DataFrame:
    return geometry.pca_2d(vectors(spark, d), "vec_id", "embedding")[0]


def _aligned(pairs: str, match: int = 4, mismatch: int = -2, opening: int = -11, extend: int = -1) -> str:
    """SQL: the table best (a, b, v) of the best global alignment of each pair (a, b, sa, sb): its score, equal letters, positive
    columns and columns with both letters, in one number, from a recursion over the anti-diagonals of the table."""
    s, e, p = 1 << 45, 1 << 30, 1 << 15
    return f"""pairs AS ({pairs}),
dp(a, b, sa, sb, n, m, d, h0, h1, u, l) USING KEY (a, b) AS (
  SELECT a, b, sa, sb, length(sa), length(sb), 0::BIGINT, list_transform(range(0, length(sa) + 1), lambda i: NULL::BIGINT), list_transform(range(0, length(sa) + 1), lambda i: CASE WHEN i = 0 THEN 0::BIGINT END),
    list_transform(range(0, length(sa) + 1), lambda i: NULL::BIGINT), list_transform(range(0, length(sa) + 1), lambda i: NULL::BIGINT) FROM pairs
  UNION
  SELECT a, b, sa, sb, n, m, d, h1, list_transform(range(0, n + 1), lambda i: greatest(u2[i + 1], l2[i + 1],
      CASE WHEN i > 0 AND d - i BETWEEN 1 AND m THEN h0[i] + CASE WHEN substr(sa, i, 1) = substr(sb, d - i, 1) THEN {match * s + e + (p if match > 0 else 0) + 1} ELSE {mismatch * s + (p if mismatch > 0 else 0) + 1} END END)), u2, l2
  FROM (SELECT *, list_transform(range(0, n + 1), lambda i: CASE WHEN i > 0 AND d - i BETWEEN 0 AND m THEN greatest(h1[i] + {opening * s}, u[i] + {extend * s}) END) AS u2,
      list_transform(range(0, n + 1), lambda i: CASE WHEN d - i BETWEEN 1 AND m THEN greatest(h1[i + 1] + {opening * s}, l[i + 1] + {extend * s}) END) AS l2
    FROM (SELECT a, b, sa, sb, n, m, d + 1 AS d, h0, h1, u, l FROM dp WHERE d < n + m))
),
best AS (SELECT a, b, ((h1[n + 1] % {s}) + {s}) % {s} AS v, n + m AS letters FROM dp WHERE d = n + m),
scored AS (SELECT a, b, (v // {e}) / (letters - v % {p})::DOUBLE AS identity, ((v // {p}) % {p}) / (letters - v % {p})::DOUBLE AS similarity FROM best)"""


_LETTERS = "SELECT item_id::VARCHAR AS id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS sequence FROM benchmark"
_RANKED = "SELECT a AS query_id, rank, b AS neighbour_id, round(identity, 6) AS identity, round(similarity, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(identity, 12) DESC, b) AS rank FROM scored)"


def letters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("id"), F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("sequence"))


def _ranked(top: DataFrame) -> DataFrame:
    return top.select("query_id", "rank", "neighbour_id", r6(F.col("identity"), "identity"), r6(F.col("similarity"), "similarity"))


@query()
def sequence_identity(spark: SparkSession, d: str) -> DataFrame:
    b = letters(spark, d)
    return _ranked(sequence_search.most_identical(b, b, 1, self_mode=True))


@query(f"""WITH RECURSIVE t AS (SELECT DISTINCT p_name AS id FROM part), {_aligned("SELECT x.id AS a, y.id AS b, x.id AS sa, y.id AS sb FROM t x JOIN t y ON x.id <> y.id", opening=-3)} {_RANKED} WHERE rank <= 3""")
def name_identity(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").select(F.col("p_name").alias("id"), F.col("p_name").alias("sequence"))
    return _ranked(sequence_search.most_identical(n, n, 3, self_mode=True, scores=Scores(opening=-3)))


_TOKENS = r"SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM benchmark"


@query(f"""WITH RECURSIVE t AS ({_TOKENS}), {_aligned("SELECT x.id AS a, y.id AS b, x.id AS sa, y.id AS sb FROM t x JOIN t y ON x.id <> y.id AND levenshtein(x.id, y.id) <= 0.25 * least(length(x.id), length(y.id)) + 1e-9", match=1, mismatch=-1, opening=-1)}
SELECT a AS query_id, b AS neighbour_id, round(identity, 6) AS identity FROM scored WHERE identity >= 0.8 - 1e-9""")
def similar_words(spark: SparkSession, d: str) -> DataFrame:
    """Of L columns with e that don't match, 1 - e / L >= 0.8 gives e <= min / 4, and the edit distance is e at most: the SQL's bound."""
    w = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("id"))
    found = sequence_search.identical_pairs(w.withColumn("sequence", F.col("id")), w.withColumn("sequence", F.col("id")), 0.8, Scores(opening=-1, extend=-1, match=1, mismatch=-1), apart=True)
    return found.select("query_id", "neighbour_id", r6(F.col("identity"), "identity"))


@query(f"""WITH RECURSIVE t AS ({_LETTERS}), {_aligned("SELECT x.id AS a, y.id AS b, x.sequence AS sa, y.sequence AS sb FROM t x JOIN t y ON x.id <> y.id AND x.id::BIGINT % 10 = 0")},
i AS (SELECT a, max(round(identity, 12)) AS v, arg_min(b, (-round(identity, 12), b)) AS hit FROM scored GROUP BY a)
SELECT a AS "ID", round(v * 100, 6) AS max_identity, hit AS identity_hit FROM i""")
def identity_two_sets(spark: SparkSession, d: str) -> DataFrame:
    """Every tenth item against all others."""
    b = letters(spark, d)
    a = b.where(F.col("id").cast("long") % 10 == 0)
    s = sequence_search.summary(sequence_search.most_identical(a, b, 1, self_mode=True), a)
    return s.select("ID", r6(F.col("max_identity"), "max_identity"), "identity_hit")


@query()
def native_clusters(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("ID"), F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("sequence"))
    return cluster.cluster_sequences(b, 0.7)


@query()
def order_constructs(spark: SparkSession, d: str) -> DataFrame:
    s = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "BJOUXZ", "ACDEFG")
    return prepare_order(table(spark, d, "benchmark").select(F.col("item_id").alias("ID"), s.alias("sequence")))


@query("""WITH s AS (SELECT count(o_totalprice) AS n, stddev_samp(o_totalprice) AS sd, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders), k AS (SELECT *, sd * n ** (-0.2::DOUBLE) AS h FROM s),
b AS (SELECT avg(o_totalprice) AS m, count(*) AS c FROM orders, s GROUP BY least(floor((o_totalprice - lo) / ((hi - lo) / 4096)), 4095)), g AS (SELECT lo - 3 * h + i * (hi - lo + 6 * h) / 511 AS x FROM k, range(512) t(i))
SELECT round(x, 6) AS x, round(sum(exp(-0.5::DOUBLE * ((x - m) / h) ** 2) * c) / any_value(n * h * sqrt(2 * pi())) * 1000000, 6) AS density FROM g, b, k GROUP BY x""")
def value_density(spark: SparkSession, d: str) -> DataFrame:
    """The density by a million."""
    return stats.density(table(spark, d, "orders"), "o_totalprice").select(r6(F.col("x"), "x"), r6(F.col("density") * 1000000, "density"))
