"""Registered queries that write the tables in a format of the engine, read the files again and answer from them; and calibration.

Files go to new folders in the shared one.  The SQL is over the tables themselves, so that a row lost or changed on the way shows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.__main__ import merged
from winnow.functions import seq
from winnow.functions import values as v
from winnow.operators import knn, select, similarity, stats
from winnow.plans.pipeline import run_funnel
from winnow.queries import _E, _LETTERS, _VOTE, _labels, letters, neighbour_edges, query, r6, table, vectors
from winnow.sources import lines
from winnow.sources import text as src
from winnow.store import scratch


@query(f"SELECT id, sequence FROM ({_LETTERS})")
def fasta_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "fasta")
    src.write_fasta(letters(spark, d), path, 60)
    return src.read_fasta(spark, path).select("id", "sequence")


@query("SELECT item_id % 7 || '' AS id, arg_max(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), item_id) AS sequence FROM benchmark GROUP BY 1")
def fasta_last(spark: SparkSession, d: str) -> DataFrame:
    """Records that repeat an id: the last in the file counts."""
    path = scratch(spark, "fasta")
    named = letters(spark, d).orderBy(F.col("id").cast("long")).select(F.concat((F.col("id").cast("long") % 7).cast("string"), F.lit(" a note")).alias("id"), "sequence")
    src.write_fasta(named, path)
    return src.fasta_map(src.read_fasta(spark, path, token=True))


@query(f"SELECT id AS \"ID\", sequence FROM ({_LETTERS})")
def fasta_to_table(spark: SparkSession, d: str) -> DataFrame:
    path, out = scratch(spark, "fasta"), scratch(spark, "table")
    src.write_fasta(letters(spark, d), path)
    src.fasta_to_csv(spark, path, out)
    return spark.read.option("header", True).csv(out)


@query(f"WITH {_E}, p AS (SELECT a.vec_id AS q, b.vec_id AS n, list_distance(a.v, b.v) AS s, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 12), b.vec_id) AS rk FROM e a JOIN e b ON a.vec_id <> b.vec_id) SELECT q::VARCHAR AS query_id, rk AS rank, n::VARCHAR AS neighbour_id, round(s, 6) AS score FROM p WHERE rk <= 15")
def top_k_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "top")
    src.write_top_k(neighbour_edges(spark, d), path)
    return src.read_top_k(spark, path).select("query_id", "rank", "neighbour_id", r6(F.col("score"), "score"))


@query(f"WITH {_E}, p AS (SELECT a.vec_id AS q, b.vec_id AS n, list_distance(a.v, b.v) AS s, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 12), b.vec_id) AS rk FROM e a JOIN e b ON a.vec_id <> b.vec_id) SELECT q::VARCHAR AS \"ID\", round(s, 6) AS min_embedding_distance, n::VARCHAR AS hit FROM p WHERE rk = 1")
def nearest_file(spark: SparkSession, d: str) -> DataFrame:
    path, e = scratch(spark, "nearest"), vectors(spark, d)
    src.write_nearest(similarity.min_distance(e, e, self_mode=True), path)
    return src.read_nearest(spark, path).select("ID", r6(F.col("min_embedding_distance"), "min_embedding_distance"), "hit")


@query("SELECT 'u' || user_id AS id, arg_max(event_type, event_id) AS label FROM events WHERE event_id % 9 > 0 GROUP BY 1")
def labels_file(spark: SparkSession, d: str) -> DataFrame:
    """Some labels are missing, an id has many: its last one counts."""
    path = scratch(spark, "labels")
    k = F.col("event_id")
    e = table(spark, d, "events").orderBy(k).select(F.concat(F.lit("u"), "user_id").alias("reference_id"), F.when(k % 9 > 0, F.col("event_type")).otherwise(F.when(k % 2 == 0, "NA")).alias("label"))
    e.write.option("header", True).csv(path)
    return src.read_labels(spark, path)


@query("SELECT o_orderkey, o_orderstatus AS label FROM orders")
def labels_of_rows(spark: SparkSession, d: str) -> DataFrame:
    """Labels in one file, rows in another, joined by their places."""
    a, b = scratch(spark, "rows"), scratch(spark, "labels")
    o = table(spark, d, "orders").orderBy("o_orderkey")
    o.select("o_orderkey", "o_totalprice").write.option("header", True).csv(a)
    o.select(F.col("o_orderstatus").alias("class")).write.option("header", True).csv(b)
    rows, labels = (lines.numbered(spark.read.option("header", True).csv(p)) for p in (a, b))
    return lines.labels_by_position(rows, labels, "class").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "label")


_HITS = "SELECT 'c' || o_custkey AS query, 't' || o_orderkey AS target, o_totalprice / 8 AS identity, o_totalprice AS bits FROM orders"


@query(f"SELECT query, target, identity, bits FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bits DESC, target) AS k FROM ({_HITS})) WHERE k <= 3")
def hits_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "hits")
    o = table(spark, d, "orders")
    h = o.select(F.concat(F.lit("c"), "o_custkey"), F.concat(F.lit("t"), "o_orderkey"), F.col("o_totalprice") / 8, F.lit(1.5), F.lit(80.0), "o_totalprice")
    h.write.option("sep", "\t").csv(path)
    return src.read_diamond(spark, path, 3).select("query", "target", "identity", "bits")


@query("SELECT 'c' || o_custkey AS query, 't' || o_orderkey AS target, round(o_totalprice / 1048576 * 100, 6) AS identity, 75.0::DOUBLE AS coverage, o_totalprice AS bits FROM orders")
def fraction_hits_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "hits")
    h = table(spark, d, "orders").select(F.concat(F.lit("c"), "o_custkey"), F.concat(F.lit("t"), "o_orderkey"), F.col("o_totalprice") / 1048576, F.lit(0.75), "o_totalprice", F.lit(1e-9))
    h.write.option("sep", "\t").csv(path)
    return src.read_mmseqs(spark, path).select("query", "target", r6(F.col("identity"), "identity"), "coverage", "bits")


@query("SELECT 's' || l_orderkey || '_' || l_linenumber AS query, 't' || l_partkey || '_' || l_suppkey AS target, CASE WHEN l_linenumber <> 2 THEN l_discount END AS fident, CASE WHEN l_linenumber <> 2 THEN l_tax END AS alntmscore FROM lineitem")
def structure_hits_file(spark: SparkSession, d: str) -> DataFrame:
    """Cells that are no numbers are NULL."""
    path = scratch(spark, "hits")
    li = table(spark, d, "lineitem")
    given = {"query": F.concat(F.lit("s"), "l_orderkey", F.lit("_"), "l_linenumber"), "target": F.concat(F.lit("t"), "l_partkey", F.lit("_"), "l_suppkey"), "fident": F.when(F.col("l_linenumber") != 2, F.col("l_discount").cast("string")).otherwise("-"), "alntmscore": F.when(F.col("l_linenumber") != 2, F.col("l_tax").cast("string")).otherwise("nan")}
    li.select(*[given.get(c, F.lit("0")).alias(c) for c in src.FOLDSEEK]).write.option("sep", "\t").csv(path)
    return src.read_foldseek(spark, path).select("query", "target", "fident", "alntmscore")


@query("SELECT c_custkey || '' AS \"ID\", CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS bal, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey::DOUBLE END AS nation FROM customer")
def metric_files(spark: SparkSession, d: str) -> DataFrame:
    """Two metric tables in a folder, found, read, merged and turned into numbers."""
    folder = scratch(spark, "metrics")
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    c.select(k.alias("id"), F.when(k % 3 > 0, F.col("c_acctbal")).alias(" bal "), F.when(k % 5 > 0, F.col("c_mktsegment")).otherwise("NA").alias("segment")).write.option("header", True).csv(f"{folder}/a.csv")
    c.where("c_custkey % 2 = 0").select(k.alias("fa_id"), F.col("c_nationkey").alias("nation")).write.option("header", True).csv(f"{folder}/b.csv")
    return merged(spark, [f"{folder}/*.csv"]).select("ID", "bal", "segment", "nation")


@query("SELECT vec_id::VARCHAR AS id, round(list_sum(embedding::DOUBLE[]), 6) AS total, len(embedding)::INT AS n FROM embeddings")
def vectors_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "vectors")
    vectors(spark, d).select(F.col("vec_id").alias("id"), F.to_json(F.col("embedding").cast("array<double>")).alias("embedding")).write.option("header", True).option("escape", '"').csv(path)
    e = src.read_vectors(spark.read.option("header", True).option("escape", '"').csv(path))
    return e.select("id", r6(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), "total"), F.size("embedding").alias("n"))


@query("SELECT DISTINCT upper(p_name) AS member FROM part WHERE p_size % 2 = 0")
def members_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "members")
    table(spark, d, "part").select(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("  "), "p_name", F.lit(" "))).otherwise(F.concat(F.lit("# "), "p_name")).alias("value")).write.text(path)
    return src.read_accessions(spark, path)


@query(f"SELECT id AS \"ID\", sequence FROM ({_LETTERS})")
def designs_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "designs") + ".tsv"
    letters(spark, d).select(F.col("id").alias(" Name"), F.col("sequence").alias("AA_Seq")).write.option("header", True).option("sep", "\t").csv(path)
    return src.read_designs(spark, path)


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_totalprice >= 200000 ORDER BY o_orderkey")
def wide_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "wide")
    src.write_wide(table(spark, d, "orders").where("o_totalprice >= 200000").select("o_orderkey", "o_totalprice", "o_orderpriority"), path, "csv")
    return v.infer_numbers(spark.read.option("header", True).csv(path)).select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_totalprice", "o_orderpriority")


@query(f"SELECT id AS \"ID\", sequence, length(sequence)::BIGINT AS score FROM ({_LETTERS}) ORDER BY length(sequence) DESC, id LIMIT 9")
def survivors_file(spark: SparkSession, d: str) -> DataFrame:
    """The nine best, written as a table and as FASTA; both read again."""
    prefix = scratch(spark, "run")
    pool = letters(spark, d).select(F.col("id").alias("ID"), "sequence", F.length("sequence").cast("long").alias("score"))
    src.write_selection(select.take_top_n(pool, 9), prefix, "nine")
    kept = spark.read.parquet(f"{prefix}_survivors.parquet").select("ID", "score")
    return src.read_fasta(spark, f"{prefix}_survivors.fasta").select(F.col("id").alias("ID"), "sequence").join(kept, "ID").select("ID", "sequence", "score")


_PIECES = """c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment END AS seg, c_nationkey::DOUBLE AS nation, CASE WHEN c_custkey % 4 > 0 THEN c_acctbal END AS bal, CASE WHEN c_custkey % 3 > 0 THEN 'True' ELSE 'False' END AS flag FROM customer),
x AS (SELECT 'nation' AS stat_column, seg, nation AS x, NULL AS t FROM c UNION ALL SELECT 'bal', seg, bal, NULL FROM c UNION ALL SELECT 'flag', seg, NULL, flag FROM c),
g AS (SELECT stat_column, NULL AS labeling, NULL AS label, x, t FROM x UNION ALL SELECT stat_column, 'seg', seg, x, t FROM x WHERE seg IS NOT NULL)"""


def _customers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    df = c.select(k.cast("string").alias("ID"), F.col("c_nationkey").alias("nation"), F.when(k % 4 > 0, F.col("c_acctbal")).alias("bal"), F.when(k % 3 > 0, "True").otherwise("False").alias("flag"))
    return df, c.where(k % 7 > 0).select(k.cast("string").alias("id"), F.col("c_mktsegment").alias("label"))


@query(f"""WITH {_PIECES} SELECT stat_column, labeling, label, CASE WHEN stat_column = 'flag' THEN 'categorical' ELSE 'numeric' END AS kind, count(coalesce(x::VARCHAR, t)) AS n, count(*) - count(coalesce(x::VARCHAR, t)) AS n_missing, CASE WHEN stat_column = 'flag' THEN count(DISTINCT t) END AS n_unique,
  round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min, max(x) AS max, {', '.join(f'round(quantile_cont(x, {p}), 6) AS {k}' for k, p in stats.PERCENTS.items())} FROM g GROUP BY 1, 2, 3""")
def table_summary(spark: SparkSession, d: str) -> DataFrame:
    df, labels = _customers(spark, d)
    s, _ = stats.table_statistics(df, {"seg": labels})
    return s.select("stat_column", "labeling", "label", "kind", "n", "n_missing", "n_unique", r6(F.col("mean"), "mean"), r6(F.col("std"), "std"), "min", "max", *[r6(F.col(k), k) for k in stats.PERCENTS])


@query(f"WITH {_PIECES} SELECT stat_column, labeling, label, t AS value, count(*) AS freq FROM g WHERE t IS NOT NULL GROUP BY ALL")
def table_frequencies(spark: SparkSession, d: str) -> DataFrame:
    df, labels = _customers(spark, d)
    return stats.table_statistics(df, {"seg": labels})[1]


@query("SELECT 'd' || l_orderkey AS \"ID\", min(l_extendedprice) FILTER (l_linenumber <> 2) AS sc_rmsd_min, round(avg(l_extendedprice) FILTER (l_linenumber <> 2), 6) AS sc_rmsd_mean, count(*) FILTER (l_linenumber <> 2) AS n_samples FROM lineitem GROUP BY 1")
def refolding_scores(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.concat(F.lit("d"), "l_orderkey").alias("ID"), F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")).otherwise(F.lit(float("nan"))).alias("rmsd"))
    return stats.self_consistency(li).select("ID", "sc_rmsd_min", r6(F.col("sc_rmsd_mean"), "sc_rmsd_mean"), "n_samples")


@query(f"""WITH {_VOTE.replace("0.43", "0.0")}, r AS (SELECT nn.nn, (win.label = e.label)::INT AS ok FROM win JOIN nn ON nn.q = win.q JOIN e ON e.vec_id = win.q), cand AS (SELECT i / 100.0::DOUBLE AS c FROM range(101) t(i)), ac AS (SELECT c, count(*) AS n, avg(ok) AS acc FROM cand JOIN r ON nn >= c GROUP BY 1),
tau AS (SELECT greatest(coalesce(min(c) FILTER (n >= 20 AND acc >= 0.05), 0.0), 0.0)::DOUBLE AS tau FROM ac),
c2 AS (SELECT q, label, sum(sim) AS w, count(*) AS n, min(rk) AS fr FROM s, tau WHERE sim >= tau GROUP BY 1, 2), v2 AS (SELECT q, label, w / sum(w) OVER (PARTITION BY q) AS post, fr FROM c2), w2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(post, 9) DESC, fr, label::VARCHAR) AS k FROM v2) WHERE k = 1),
r2 AS (SELECT nn.nn, (w2.label = e.label)::INT AS ok FROM w2 JOIN nn ON nn.q = w2.q JOIN e ON e.vec_id = w2.q), b AS (SELECT round(i / 20.0::DOUBLE, 4) AS lo, round((i + 1) / 20.0::DOUBLE, 4) AS hi FROM range(20) t(i))
SELECT lo, hi, count(nn) AS n, round(avg(ok), 6) AS accuracy, any_value(tau) AS tau, (SELECT count(*) FROM r2) AS n_predicted, (SELECT count(*) FROM e) AS n_queries FROM b CROSS JOIN tau LEFT JOIN r2 ON nn >= lo AND nn < hi GROUP BY 1, 2""")
def calibration(spark: SparkSession, d: str) -> DataFrame:
    """Leave-one-out calibration of one space, from the dictionary that is saved."""
    c = knn.calibrate({"embedding": neighbour_edges(spark, d)}, _labels(spark, d), target=0.05)["spaces"]["embedding"]
    rows = [(b["lo"], b["hi"], b["n"], b["accuracy"], float(c["tau"]), c["n_predicted"], c["n_queries"]) for b in c["calibration_curve"]]
    df = spark.createDataFrame(rows, "lo double, hi double, n long, accuracy double, tau double, n_predicted long, n_queries long")
    return df.withColumn("accuracy", F.round("accuracy", 6))


# ------------------------------------------------------------------ other tools' tables


@query("SELECT 'pocket' || l_linenumber || '_' || l_orderkey || '_' || l_partkey || '_' || l_suppkey AS pocket, l_extendedprice AS x, l_discount AS y, l_tax AS z, CASE WHEN l_quantity > 10 THEN l_quantity END AS score FROM lineitem")
def pocket_predictions_file(spark: SparkSession, d: str) -> DataFrame:
    path, li = scratch(spark, "pockets"), table(spark, d, "lineitem")
    name = F.concat(F.lit("  pocket"), "l_linenumber", F.lit("_"), "l_orderkey", F.lit("_"), "l_partkey", F.lit("_"), "l_suppkey")
    li.select(name.alias("name "), F.when(F.col("l_quantity") > 10, F.col("l_quantity").cast("string")).otherwise(" - ").alias(" score"), F.col("l_extendedprice").alias(" center_x"), F.col("l_discount").alias(" center_y"), F.col("l_tax").alias(" center_z")).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return src.read_pocket_predictions(spark, path).select("pocket", "x", "y", "z", "score")


@query("SELECT count(*) AS n_residues, round(sum(c_acctbal), 4) AS total, min(c_acctbal) AS least FROM customer WHERE c_custkey % 5 > 0")
def residue_scores_file(spark: SparkSession, d: str) -> DataFrame:
    """The fifth cell of each row; rows whose fifth cell is no number are left out."""
    path, c = scratch(spark, "scores"), table(spark, d, "customer")
    c.select(F.lit("A"), "c_custkey", "c_mktsegment", F.lit("x"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal").cast("string")).otherwise("score")).write.csv(path)
    s = src.read_residue_scores(spark, path).agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("t"), F.min("score").alias("l"))
    return s.select(F.col("n").alias("n_residues"), F.round("t", 4).alias("total"), F.col("l").alias("least"))


@query("SELECT s_suppkey::VARCHAR AS \"ID\", s_acctbal AS tm FROM supplier")
def melting_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "melting")
    table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("Prediction")).write.option("header", True).csv(path)
    return src.read_melting(spark.read.option("header", True).csv(path))


@query("SELECT 's' || s_suppkey AS \"ID\", round(10 ** (s_nationkey / 8.0::DOUBLE), 6) AS kcat FROM supplier")
def kinetics_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "kinetics")
    table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey", F.lit("_wild")).alias("fa_id"), (F.col("s_nationkey") / 8.0).alias("kcat")).write.option("header", True).csv(path)
    return src.read_kinetics(spark.read.option("header", True).csv(path), ["kcat"]).select("ID", r6(F.col("kcat"), "kcat"))


@query("SELECT 'r' || p_partkey % 50 AS reference_id, p_size AS resnum FROM part WHERE p_partkey % 4 > 0")
def panel_file(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose number is none are left out."""
    path, k = scratch(spark, "panel"), F.col("p_partkey")
    p = table(spark, d, "part").select(F.concat(F.lit("r"), k % 50).alias("reference_id"), F.when(k % 4 > 0, F.col("p_size").cast("string")).otherwise("twelve").alias("resnum"))
    p.write.option("header", True).csv(path)
    return src.read_panel(spark, path)


@query("SELECT c_custkey::VARCHAR AS \"ID\", c_acctbal AS \"isTPS\", c_nationkey::DOUBLE AS \"FPP\" FROM customer")
def predictor_scores(spark: SparkSession, d: str) -> DataFrame:
    """The calibrated score goes before the raw one."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias(" id"), F.lit("0.5").alias("TPS_score"), F.col("c_acctbal").cast("string").alias("TPS_p_calibrated "), F.col("c_nationkey").cast("string").alias("FPP_score"))
    return src.predictor_schema(c, "FPP")


@query("""WITH a AS (SELECT c_custkey || '' AS "ID", c_acctbal AS bal FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT c_custkey || '' AS "ID", c_nationkey AS near, c_mktsegment AS hit FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(a."ID", b."ID") AS "ID", bal, near AS near_self, hit AS hit_self FROM a FULL JOIN b ON a."ID" = b."ID" """)
def results_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Chosen result tables on the first token of their ids; a self-comparison under names of its own; bookkeeping left out."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    a = c.where(k % 2 == 0).select(F.concat(k.cast("string"), F.lit(" a note")).alias("ID"), F.col("c_acctbal").alias("bal"), k.alias("fa_id"))
    b = c.where(k % 3 == 0).select(k.cast("string").alias("ID"), F.col("c_nationkey").alias("near"), F.col("c_mktsegment").alias("hit"))
    return src.load_results(spark, {"a": a, "b": b, "c": a}, ["a", "b"], ("b",))


@query("""WITH b AS (SELECT l_returnflag AS c, quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN b ON l_returnflag = c WHERE l_extendedprice BETWEEN lo AND hi""")
def bands_text(spark: SparkSession, d: str) -> DataFrame:
    """Bands exported as JSON and read by the filter."""
    li = table(spark, d, "lineitem")
    bands = stats.export_bands(stats.numeric_stats(li, ["l_extendedprice"], ["l_returnflag"]), {"l_extendedprice": {}}, labeling="l_returnflag")
    return select.band_filter(li, json.loads(stats.bands_json(bands, "l_returnflag"))).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"SELECT id AS \"ID\", id AS name, sequence, 'CC(C)' AS smiles, 'MG' AS ion, 4 AS n_chains FROM ({_LETTERS})")
def folding_inputs(spark: SparkSession, d: str) -> DataFrame:
    """The job table of a folding run with two ions and a ligand, as JSON, read again."""
    jobs = src.cofold_jobs(letters(spark, d).withColumnRenamed("id", "ID"), 2, "CC(C)")
    made = src.fold_inputs(jobs, ["sequence"], ["ligand"], ["ion_1", "ion_2"])
    at = lambda p: F.get_json_object("json", p)
    chains = F.json_array_length(at("$.sequences"))
    return made.select("ID", at("$.name").alias("name"), at("$.sequences[0].protein.sequence").alias("sequence"), at("$.sequences[1].ligand.smiles").alias("smiles"), at("$.sequences[3].ligand.ccdCodes[0]").alias("ion"), chains.alias("n_chains"))


@query("""WITH t AS (SELECT * FROM orders WHERE o_totalprice >= 100000), c AS (SELECT o.*, c_acctbal FROM t o JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0)
SELECT "ID", bal FROM (SELECT o_orderkey || '' AS "ID", o_orderstatus, c_acctbal AS bal, row_number() OVER (PARTITION BY o_orderstatus ORDER BY c_acctbal DESC, o_orderkey || '') AS k FROM c) WHERE k <= 20""")
def funnel_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Two tiers: what the second needs is only made for those that the first keeps, and merged over what is carried forward."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("ID"), "o_custkey", "o_orderstatus", "o_totalprice")
    c = table(spark, d, "customer")
    balance = lambda kept: kept.join(c, kept.o_custkey.cast("long") == c.c_custkey).select("ID", F.col("c_acctbal").alias("bal"))
    first = {"spec": {"ops": [{"op": "gate", "conditions": [{"col": "o_totalprice", "ge": 100000}]}]}}
    second = {"metrics": [balance], "spec": {"group_by": "o_orderstatus", "n_out_per_group": 20, "ops": [{"op": "gate", "conditions": [{"col": "bal", "ge": 0}]}, {"op": "score", "terms": [{"col": "bal", "direction": "higher"}]}]}}
    return run_funnel(spark, o, [first, second], scratch(spark, "funnel")).select("ID", F.col("bal").cast("double").alias("bal"))


@query(f"SELECT p_partkey, CASE p_partkey % 4 {' '.join(f'WHEN {i} THEN {chr(39)}{seq.SMILES[k]}{chr(39)}' for i, k in enumerate(('DMAPP', 'GPP', 'C35')))} END AS smiles, p_partkey % 4 = 1 AS cofoldable FROM part")
def substances(spark: SparkSession, d: str) -> DataFrame:
    code = F.array(*map(F.lit, ("dmapp", "GPP", "C35", "EDSQ")))[(F.col("p_partkey") % 4).cast("int")]
    return table(spark, d, "part").select("p_partkey", seq.smiles(code).alias("smiles"), seq.cofoldable(code).alias("cofoldable"))
