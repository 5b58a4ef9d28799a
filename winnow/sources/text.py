"""FASTA, CSV and hit-table sources and sinks."""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnow.functions import values as v
from winnow.sources.lines import numbered

# Columns of the tools' headerless tables, and column aliases.
DIAMOND = "query string, target string, identity double, similarity double, coverage double, bits double"
MMSEQS = "query string, target string, fident double, qcov double, bits double, evalue double"
FOLDSEEK = ("query", "target", "fident", "alnlen", "mismatch", "gapopen", "qstart", "qend", "tstart", "tend", "evalue", "bits", "alntmscore", "qtmscore", "ttmscore", "lddt")
ORDER_IDS = ("id", "name", "identifier", "seq_id", "sequence_id", "design_id")
ORDER_SEQUENCES = ("sequence", "aa", "aa_sequence", "amino_acid_sequence", "aa_seq", "protein", "protein_sequence", "seq")
BOOKKEEPING = {"ID", "runtime_id", "fa_id", "id", "reference_id", "ddxxd_motif", "ddxxd_start", "nse_dte_motif", "nse_dte_start"}


def read_fasta(spark: SparkSession, path: str, keep_gaps: bool = False, token: bool = False) -> DataFrame:
    """id, sequence, file_pos: records are split at '>' by the text source, so a file is
    read in parallel; token: the id ends at the first blank."""
    r = numbered(spark.read.option("lineSep", ">").text(path), "file_pos").filter(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*[\r\n]*", ""), r"\s", "")
    name = v.first_token(head) if token else F.trim(head)
    return r.select(name.alias("id"), (body if keep_gaps else F.translate(body, "-", "")).alias("sequence"), "file_pos")


def fasta_map(df: DataFrame) -> DataFrame:
    """One row per id: the last one in the file."""
    return df.groupBy("id").agg(F.max_by("sequence", "file_pos").alias("sequence"))


def write_fasta(df: DataFrame, path: str, width: int = 0) -> None:
    body = F.rtrim(F.regexp_replace("sequence", f"(.{{{width}}})", "$1\n")) if width else F.col("sequence")
    df.select(F.format_string(">%s\n%s", "id", body).alias("value")).write.mode("overwrite").text(path)


def fasta_to_csv(spark: SparkSession, path: str, out: str) -> None:
    read_fasta(spark, path).select(F.col("id").alias("ID"), "sequence").write.mode("overwrite").option("header", True).csv(out)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Files of a folder in any store that Spark reads, sorted by name."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []


def resolve_paths(spark: SparkSession, entries: list[str], suffix: str = ".csv") -> list[str]:
    """Files, folders (their files of the suffix) and patterns, in order, each once."""
    out: list[str] = []
    for e in entries:
        if any(c in e for c in "*?["):
            folder, pattern = e.rsplit("/", 1)
            found = [f for f in list_files(spark, folder) if fnmatch.fnmatch(f.rsplit("/", 1)[1], pattern)]
        elif e.endswith(suffix):
            found = [e]
        else:
            found = [f for f in list_files(spark, e) if f.endswith(suffix)]
        out += [f for f in found if f not in out]
    return out


def read_metric(spark: SparkSession, path: str) -> DataFrame:
    """A metric CSV as text, with NULL for what is missing, headers trimmed and the key as ID."""
    df = spark.read.option("header", True).csv(path)
    return v.without_missing(v.with_id(v.strip_names(df)))


def discover_metrics(spark: SparkSession, folder: str, comparative: tuple[str, ...] = ()) -> dict[str, str]:
    """Metric name -> file: every CSV but labels and comparative ones; the last of a name wins."""
    out = {}
    for f in list_files(spark, folder):
        name = f.rsplit("/", 1)[1]
        if name.endswith(".csv") and not name.endswith("_labels.csv"):
            metric = name.removesuffix(".csv")
            if not any(c in metric for c in comparative):
                out[metric] = f
    return out


def result_paths(fasta: str, tools: list[str]) -> dict[str, str]:
    """Conventional result names beside a FASTA file."""
    for ext in (".fasta", ".fa"):
        if fasta.endswith(ext):
            return {t: f"{fasta.removesuffix(ext)}_{t}.csv" for t in tools}
    raise ValueError("a FASTA file ends in .fasta or .fa")


def load_results(spark: SparkSession, frames: dict[str, DataFrame], load: list[str] | None = None, self_names: tuple[str, ...] = ()) -> DataFrame:
    """The chosen metric tables joined on ID: keys cut to their first token, self-comparisons
    under names of their own, bookkeeping columns left out."""
    from winnow.operators.merge import outer_chain, with_self

    out = []
    for name, df in frames.items():
        if load is not None and name not in load:
            continue
        d = df.withColumn("ID", v.first_token(F.col("ID")))
        d = d.drop(*[c for c in d.columns if c in BOOKKEEPING and c != "ID"])
        out.append(with_self(d) if name in self_names else d)
    return outer_chain(out)


def predictor_schema(df: DataFrame, target: str | None = None, rename: str = "isTPS") -> DataFrame:
    """ID, the calibrated score if there is one, else the raw one, and a target's score column."""
    d = v.with_id(v.strip_names(df))
    col = next((c for c in ("TPS_p_calibrated", "TPS_score") if c in d.columns), None)
    if col is None:
        raise KeyError("neither TPS_p_calibrated nor TPS_score")
    extra = [v.number_of(d, f"{target}_score").alias(target)] if target and f"{target}_score" in d.columns else []
    return d.select("ID", v.number_of(d, col).alias(rename), *extra)


def read_labels(spark: SparkSession, path: str, keep_last: bool = False) -> DataFrame:
    """id, label from reference_id and label, or the first two columns; missing labels go, the last row of an id counts."""
    df = numbered(spark.read.option("header", True).csv(path), "_p")
    a, b = ("reference_id", "label") if {"reference_id", "label"} <= set(df.columns) else df.columns[:2]
    d = v.without_missing(df.select(F.col(f"`{a}`").alias("id"), F.col(f"`{b}`").alias("label"), "_p"))
    d = d.filter(F.col("id").isNotNull() & F.col("label").isNotNull())
    return d.groupBy("id").agg(F.max_by("label", "_p").alias("label"))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema("query_id string, rank int, neighbour_id string, score double").csv(path)


def neighbour_lists(edges: DataFrame) -> DataFrame:
    """query_id, neighbours: arrays in rank order, for small k."""
    return edges.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour_id", "score"))).alias("neighbours"))


def read_accessions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.upper(F.trim("value")).alias("member")).filter("member <> '' AND member NOT LIKE '#%'").distinct()


def read_vectors(df: DataFrame) -> DataFrame:
    """id, embedding: key by id, ID or the first column; the vector from one text cell or all other columns."""
    key = next((c for c in ("id", "ID") if c in df.columns), df.columns[0])
    if "embedding" in df.columns:
        t = df.schema["embedding"].dataType.typeName()
        e = F.from_json("embedding", "array<double>") if t == "string" else F.col("embedding").cast("array<double>")
    else:
        e = F.array(*[v.number_of(df, c) for c in df.columns if c != key])
    return df.select(F.col(key).cast("string").alias("id"), e.alias("embedding"))


def cap_hits(df: DataFrame, n: int, order: str = "bits") -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.col(order).desc_nulls_last(), "target")
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def read_diamond(spark: SparkSession, path: str, top_n: int | None = None) -> DataFrame:
    df = spark.read.option("sep", "\t").schema(DIAMOND).csv(path)
    return cap_hits(df, top_n) if top_n else df


def read_mmseqs(spark: SparkSession, path: str) -> DataFrame:
    """Identity and coverage in percent; there is no similarity."""
    df = spark.read.option("sep", "\t").schema(MMSEQS).csv(path)
    return df.select("query", "target", (F.col("fident") * 100).alias("identity"), F.lit(None).cast("double").alias("similarity"), (F.col("qcov") * 100).alias("coverage"), "bits")


def read_foldseek(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, then numbers; what is no number is NULL."""
    df = spark.read.option("sep", "\t").schema(", ".join(f"{c} string" for c in FOLDSEEK)).csv(path)
    return df.select("query", "target", *[v.number_of(df, c).alias(c) for c in FOLDSEEK[2:]])


def read_pocket_predictions(spark: SparkSession, path: str) -> DataFrame:
    df = v.strip_names(spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path))
    return df.select(F.col("name").alias("pocket"), *[v.number_of(df, f"center_{c}").alias(c) for c in "xyz"], *[v.number_of(df, c).alias(c) for c in ("score", "probability") if c in df.columns])


def read_residue_scores(spark: SparkSession, path: str) -> DataFrame:
    """The fifth column as a number; other rows are skipped."""
    df = spark.read.csv(path)
    return df.select(F.input_file_name().alias("file"), v.number(F.col(df.columns[4])).alias("score")).filter("score IS NOT NULL")


def read_melting(df: DataFrame) -> DataFrame:
    return v.with_id(df).select("ID", v.number_of(df, next(c for c in df.columns if c.lower() in ("tm", "prediction", "melting_temperature"))).alias("tm"))


def read_kinetics(df: DataFrame, columns: list[str]) -> DataFrame:
    """log10 values to absolute ones; ids without their _wild."""
    d = v.with_id(df)
    return d.select(F.regexp_replace("ID", "_wild$", "").alias("ID"), *[F.pow(F.lit(10.0), v.number_of(d, c)).alias(c) for c in columns])


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("comment", "#").csv(path)
    return df.select("reference_id", F.col("resnum").try_cast("int").alias("resnum")).filter("resnum IS NOT NULL")


def read_designs(spark: SparkSession, path: str) -> DataFrame:
    """ID, sequence from FASTA, CSV or TSV; a row without id takes its number."""
    if path.endswith((".csv", ".tsv")):
        df = numbered(spark.read.option("header", True).option("sep", "\t" if path.endswith(".tsv") else ",").csv(path), "_row")
        low = {c.strip().lower(): c for c in df.columns}
        seq = next((low[c] for c in ORDER_SEQUENCES if c in low), None)
        if seq is None:
            raise ValueError(f"no sequence column among {df.columns}")
        key = next((low[c] for c in ORDER_IDS if c in low), None)
        i = F.col(f"`{key}`") if key else F.col("_row").cast("string")
        return df.select(i.alias("ID"), F.col(f"`{seq}`").alias("sequence"))
    return read_fasta(spark, path).select(F.col("id").alias("ID"), "sequence")


#: The columns of the two tables that searches leave.
TOP_K = "query_id string, rank long, neighbour_id string, score double"
NEAREST = "ID string, min_embedding_distance double, hit string"


def write_top_k(edges: DataFrame, path: str) -> None:
    """query_id, rank, neighbour_id and score as CSV with a header, in the order of query and rank."""
    e = edges.select(F.col("query_id").cast("string"), F.col("rank").cast("long"), F.col("neighbour_id").cast("string"), F.col("score").cast("double"))
    e.orderBy("query_id", "rank").write.mode("overwrite").option("header", True).csv(path)


def read_top_k(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(TOP_K).csv(path)


def write_nearest(nearest: DataFrame, path: str) -> None:
    """ID, min_embedding_distance and hit as CSV with a header, by ID; a query without neighbour keeps its row."""
    n = nearest.select(F.col("ID").cast("string"), F.col("min_embedding_distance").cast("double"), F.col("hit").cast("string"))
    n.orderBy("ID").write.mode("overwrite").option("header", True).csv(path)


def read_nearest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(NEAREST).csv(path)


def write_order(order: DataFrame, prefix: str) -> None:
    """All rows as CSV, the good ones as 'ID<tab>construct' text."""
    order.write.mode("overwrite").option("header", True).csv(f"{prefix}_order.csv")
    order.filter("status = 'ok'").select(F.concat_ws("\t", "ID", "construct").alias("value")).write.mode("overwrite").text(f"{prefix}_order.txt")


def write_wide(df: DataFrame, path: str, kind: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    w.option("header", True).csv(path) if kind == "csv" else w.parquet(path)


def write_selection(survivors: DataFrame, prefix: str, manifest: str | None = None) -> None:
    """Survivors as Parquet and FASTA, and the manifest as text."""
    survivors.write.mode("overwrite").parquet(f"{prefix}_survivors.parquet")
    if "sequence" in survivors.columns:
        write_fasta(survivors.filter("sequence IS NOT NULL").select(F.col("ID").alias("id"), "sequence"), f"{prefix}_survivors.fasta")
    if manifest is not None:
        survivors.sparkSession.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{prefix}_manifest")


def cofold_jobs(designs: DataFrame, n_ions: int, ligand: str | None) -> DataFrame:
    """ID, sequence, ions and ligand columns of a folding job table."""
    return designs.select("ID", "sequence", *[F.lit("MG").alias(f"ion_{i + 1}") for i in range(n_ions)], F.lit(ligand).alias("ligand"))


def fold_inputs(df: DataFrame, proteins: list[str], ligands: list[str], ions: list[str], seeds: int = 1) -> DataFrame:
    """ID, json: one folding input per row, chains named from one pool of 26 letters."""
    total = len(proteins) + len(ligands) + len(ions)
    if total > 26:
        raise ValueError("more chains than letters")
    names = iter("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    one = lambda kind, fields: F.to_json(F.struct(F.struct(*fields).alias(kind)))
    parts = [one("protein", [F.array(F.lit(next(names))).alias("id"), F.col(c).alias("sequence")]) for c in proteins]
    parts += [one("ligand", [F.array(F.lit(next(names))).alias("id"), F.col(c).alias("smiles")]) for c in ligands]
    parts += [one("ligand", [F.array(F.lit(next(names))).alias("id"), F.array(F.col(c)).alias("ccdCodes")]) for c in ions]
    name = F.regexp_extract(F.to_json(F.struct(F.col("ID").cast("string").alias("n"))), r"(?s)^\{\"n\":(.*)\}$", 1)
    seeds_json = ",".join(map(str, range(1, seeds + 1)))
    body = F.concat(F.lit('{"name":'), name, F.lit(f',"modelSeeds":[{seeds_json}],"sequences":['), F.concat_ws(",", *parts), F.lit('],"dialect":"alphafold3","version":1}'))
    return df.select("ID", body.alias("json"))
