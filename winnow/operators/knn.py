"""Calibrated k-nearest-neighbour label transfer over edge tables."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the method.
PRIOR_TAU = {"sequence": 0.40, "embedding": 0.0, "structural": 0.50}
LARGER_IS_CLOSER = {"sequence": True, "embedding": False, "structural": True}
SPACES = list(PRIOR_TAU)
UNKNOWN = "unknown"
BINS = 20
CARBONS = {"DMAPP": 5, "GPP": 10, "FPP": 15, "GGPP": 20, "GFPP": 25, "EDSQ": 30, "C35": 35, "2xGGPP": 40}
TYPE_TO_SUBSTRATE = {"mono": "GPP", "sesq": "FPP", "di": "GGPP", "sester": "GFPP", "tri": "EDSQ", "sqs": "EDSQ", "psy": "2xGGPP", "tetra": "2xGGPP", "pt": "IDS", "hemi": "DMAPP", "sesquar": "C35"}
VOLUME_BANDS = ((400.0, "GPP"), (900.0, "FPP"), (1600.0, "GGPP"))


def similarity(space: str, score: Column) -> Column:
    """sequence: percent / 100; structural: as it is; embedding: 1 / (1 + distance)."""
    if space not in PRIOR_TAU:
        raise ValueError(f"unknown space {space!r}")
    return {"sequence": score / 100, "structural": score, "embedding": 1 / (1 + score)}[space]


def labelled_edges(edges: DataFrame, labels: DataFrame, space: str, top_k: int | None = None, self_mode: bool = False) -> DataFrame:
    """query_id, rank, sim, label of the neighbours that have a label (labels: id, label)."""
    e = edges
    if space == "structural":
        from winnow.operators.hits import strip_chain

        e = strip_chain(e, labels.select("id"))
    if top_k is not None:
        e = e.filter(F.col("rank") <= top_k)
    lab = labels.filter(F.col("label").isNotNull()).select(F.col("id").alias("neighbour_id"), "label")
    sim = similarity(space, F.col("score"))
    out = e.join(lab, "neighbour_id").select("query_id", "rank", sim.alias("sim"), "label")
    return out.filter(F.col("sim").isNotNull() & ~F.isnan("sim"))


def posteriors(edges: DataFrame, tau: float, digits: int = 9) -> DataFrame:
    """query_id, label, posterior, agreement, first_rank, nn: the weighted vote of the
    neighbours at tau or closer; nn is the best similarity among all of them."""
    nn = edges.groupBy("query_id").agg(F.max("sim").alias("nn"))
    v = edges.filter(F.col("sim") >= tau).groupBy("query_id", "label").agg(F.sum("sim").alias("w"), F.count(F.lit(1)).alias("n"), F.min("rank").alias("first_rank"))
    q = Window.partitionBy("query_id")
    v = v.select("query_id", "label", (F.col("w") / F.sum("w").over(q)).alias("posterior"), (F.col("n") / F.sum("n").over(q)).alias("agreement"), "first_rank", F.sum("n").over(q).alias("n_voters"))
    return v.join(nn, "query_id")


def winners(post: DataFrame, digits: int = 9) -> DataFrame:
    """The label of the greatest posterior; ties go to the one whose first neighbour is nearest."""
    w = Window.partitionBy("query_id").orderBy(F.round("posterior", digits).desc(), "first_rank", F.col("label").cast("string"))
    p = post.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    return p.select("query_id", F.col("label").alias("predicted"), (F.col("posterior") * F.col("agreement") * F.greatest("nn", F.lit(0.0))).alias("confidence"), "nn", "n_voters")


def vote(queries: DataFrame, edges: DataFrame, tau: float) -> DataFrame:
    """Every query with its vote; abstainers have predicted 'unknown' and confidence 0."""
    nn = edges.groupBy("query_id").agg(F.max("sim").alias("nn"))
    w = winners(posteriors(edges, tau)).drop("nn")
    out = queries.select("query_id").join(nn, "query_id", "left").join(w, "query_id", "left")
    return out.select("query_id", F.coalesce(F.col("predicted").cast("string"), F.lit(UNKNOWN)).alias("predicted"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "nn", F.coalesce("n_voters", F.lit(0)).alias("n_voters"))


def _records(edges: DataFrame, labels: DataFrame, tau: float) -> DataFrame:
    """nn, correct (0/1) of each labelled query that doesn't abstain."""
    truth = labels.select(F.col("id").alias("query_id"), F.col("label").alias("truth"))
    return winners(posteriors(edges, tau)).join(truth, "query_id").select("query_id", "nn", (F.col("predicted") == F.col("truth")).cast("double").alias("correct"))


def calibration_curve(records: DataFrame) -> DataFrame:
    """lo, hi, n, accuracy of 20 half-open bins; a similarity of exactly 1 is in none."""
    spark = records.sparkSession
    bins = spark.range(BINS).select(F.col("id").cast("int").alias("b"), F.round(F.col("id") / BINS, 4).alias("lo"), F.round((F.col("id") + 1) / BINS, 4).alias("hi"))
    # the bin of a value by its own borders, which are no binary fractions
    k = F.floor(F.col("nn") * BINS).cast("int")
    k = F.when(F.col("nn") >= F.round((k + 1) / BINS, 4), k + 1).when(F.col("nn") < F.round(k / BINS, 4), k - 1).otherwise(k)
    agg = records.filter(F.col("nn") < 1.0).groupBy(k.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.avg("correct").alias("accuracy"))
    return bins.join(agg, "b", "left").select("lo", "hi", F.coalesce("n", F.lit(0)).alias("n"), "accuracy")


def choose_tau(records: DataFrame, prior: float, target: float = 0.5, support: int = 20) -> DataFrame:
    """One row, tau: the lowest c in 0, .01 .. 1 at which the records of nn >= c are
    ``support`` or more and ``target`` of them correct; never below the prior.

    Records are counted by the last candidate they reach (101 rows), so the
    sweep is a running sum over that small table.
    """
    spark = records.sparkSession
    reach = F.least(F.floor(F.col("nn") * 100 + 1e-9), F.lit(100)).cast("int")
    per = records.filter(F.col("nn").isNotNull()).groupBy(reach.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum("correct").alias("k"))
    down = Window.orderBy(F.col("c").desc()).rowsBetween(Window.unboundedPreceding, 0)  # 101 rows
    cum = spark.range(101).select(F.col("id").cast("int").alias("c")).join(per, "c", "left").select("c", F.sum("n").over(down).alias("n"), F.sum("k").over(down).alias("k"))
    ok = cum.filter((F.col("n") >= support) & (F.col("k") / F.col("n") >= target))
    return ok.agg(F.greatest(F.coalesce(F.min("c") / 100.0, F.lit(prior)), F.lit(prior)).alias("tau"))


def calibrate(edges: dict[str, DataFrame], labels: DataFrame, top_k: int | None = None, target: float = 0.5, labeling: str = "labeling") -> dict:
    """Leave-one-out calibration: tau per space at its prior, then curves at tau, then the ensemble.

    Only aggregates (a tau, 20 bins and counts per space) come to the driver.
    """
    lab = labels.filter(F.col("label").isNotNull())
    known = lab.select(F.col("id").alias("query_id"))
    e = {s: labelled_edges(x, lab, s, top_k).join(known, "query_id", "left_semi").cache() for s, x in edges.items()}
    queries = reduce(DataFrame.union, [x.select("query_id") for x in edges.values()]).distinct().join(known, "query_id", "left_semi")
    n = queries.count()
    classes = sorted(str(r.label) for r in lab.select("label").distinct().collect())
    out: dict = {"labeling": labeling, "classes": classes, "n_classes": len(classes), "spaces": {}, "top_k": top_k, "target_accuracy": target}

    def entry(rec: DataFrame) -> dict:
        rec = rec.cache()
        k, acc = rec.agg(F.count(F.lit(1)), F.avg("correct")).first()
        curve = [r.asDict() for r in calibration_curve(rec).orderBy("lo").collect()]
        rec.unpersist()
        return {"n_predicted": k, "n_abstained": n - k, "n_queries": n, "accuracy": acc, "calibration_curve": curve}

    taus = {}
    for s, x in e.items():
        taus[s] = choose_tau(_records(x, lab, PRIOR_TAU[s]), PRIOR_TAU[s], target).first().tau
        out["spaces"][s] = {"tau": taus[s], "prior_tau": PRIOR_TAU[s], "larger_is_closer": LARGER_IS_CLOSER[s], **entry(_records(x, lab, taus[s]))}
    truth = lab.select(F.col("id").alias("query_id"), F.col("label").alias("truth"))
    ens = ensemble({s: posteriors(x, taus[s]) for s, x in e.items()}).join(truth, "query_id")
    out["ensemble"] = entry(ens.select("query_id", F.col("max_nn").alias("nn"), (F.col("predicted") == F.col("truth")).cast("double").alias("correct")))
    for x in e.values():
        x.unpersist()
    return out


def ensemble(post: dict[str, DataFrame]) -> DataFrame:
    """query_id, predicted, max_nn: the label of the greatest sum of posteriors over the
    spaces; ties go to the space that comes first, then the nearest first neighbour."""
    parts = [p.select("query_id", "label", "posterior", "nn", F.lit(i).alias("space_no"), "first_rank") for i, p in enumerate(post.values())]
    u = reduce(DataFrame.union, parts)
    nn = u.groupBy("query_id").agg(F.max("nn").alias("max_nn"))
    s = u.groupBy("query_id", "label").agg(F.sum("posterior").alias("p"), F.min(F.struct("space_no", "first_rank")).alias("o"))
    w = Window.partitionBy("query_id").orderBy(F.round("p", 9).desc(), "o", F.col("label").cast("string"))
    return s.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("query_id", F.col("label").alias("predicted")).join(nn, "query_id")


def calibrated(nn: Column, curve: list[dict]) -> Column:
    """Accuracy of the bin that holds nn if it has records, else of the nearest lower
    one that has, else of the lowest."""
    full = [b for b in curve if b["n"] and b["accuracy"] is not None]
    if not full:
        return F.lit(None).cast("double")
    out = F.when(nn.isNull(), F.lit(None).cast("double"))
    for b in reversed(full):
        out = out.when(nn >= b["lo"], float(b["accuracy"]))
    return out.otherwise(float(full[0]["accuracy"]))


def transfer(edges: dict[str, DataFrame], labels: DataFrame, calibration: dict, top_k: int | None = None) -> DataFrame:
    """Predictions of each space, calibrated, and of the ensemble, for every query in any space."""
    lab = labels.filter(F.col("label").isNotNull())
    queries = reduce(DataFrame.union, [x.select("query_id") for x in edges.values()]).distinct()
    out, post = queries, {}
    for s, x in edges.items():
        spec = calibration["spaces"][s]
        le = labelled_edges(x, lab, s, top_k)
        post[s] = posteriors(le, spec["tau"])
        v = vote(queries, le, spec["tau"])
        conf = F.when(F.col("predicted") == UNKNOWN, 0.0).otherwise(calibrated(F.col("nn"), spec["calibration_curve"]))
        out = out.join(v.select("query_id", F.col("predicted").alias(f"{s}_label"), conf.alias(f"{s}_confidence"), F.col("nn").alias(f"{s}_nn_similarity")), "query_id", "left")
    ens = ensemble(post)
    fallback = reduce(lambda a, b: a + b, [F.coalesce(F.when(F.col(f"{s}_label") != UNKNOWN, F.col(f"{s}_confidence")), F.lit(0.0)) for s in edges])
    voting = reduce(lambda a, b: a + b, [F.when(F.col(f"{s}_label") != UNKNOWN, 1).otherwise(0) for s in edges])
    out = out.join(ens, "query_id", "left")
    conf = F.coalesce(calibrated(F.col("max_nn"), calibration["ensemble"]["calibration_curve"]), fallback / F.nullif(voting, F.lit(0)), F.lit(0.0))
    return out.withColumn("label", F.coalesce(F.col("predicted").cast("string"), F.lit(UNKNOWN))).withColumn("confidence", F.when(F.col("predicted").isNull(), 0.0).otherwise(conf)).drop("predicted", "max_nn")


def calibrated_spaces(calibration: dict, wanted: list[str]) -> list[str]:
    return [s for s in wanted if s in calibration["spaces"]]


def save_calibration(calibration: dict, path: str) -> None:
    with open(path, "w") as f:
        json.dump(calibration, f, indent=1, allow_nan=False)


def load_calibration(path: str) -> dict:
    with open(path) as f:
        return json.load(f)


# ------------------------------------------------------------------ fusion


def volume_band(v: Column) -> Column:
    out = None
    for most, band in VOLUME_BANDS:
        out = F.when(v < most, band) if out is None else out.when(v < most, band)
    return F.when(v.isNotNull() & ~F.isnan(v), out.otherwise("GFPP"))


def within_one_size(a: Column, b: Column) -> Column:
    """Whether two classes are next to each other by carbon count; NULL where either has none."""
    order = sorted(CARBONS, key=CARBONS.get)
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(order) for x in (k, i)])
    return F.abs(rank[a] - rank[b]) <= 1


def ee_argmax(df: DataFrame, id_col: str = "ID") -> DataFrame:
    """ID, ee_substrate, ee_score: the substrate of the best score over its columns."""
    from winnow.functions.values import greatest, number_of
    from winnow.operators.select import score_columns

    cols = score_columns(df.columns)
    arr = F.array(*[F.struct(greatest([number_of(df, c) for c in v]).alias("s"), F.lit(-i).alias("o"), F.lit(k).alias("code")) for i, (k, v) in enumerate(cols.items())])
    best = F.array_max(F.filter(arr, lambda x: x["s"].isNotNull()))
    return df.select(F.col(id_col).alias("ID"), best["code"].alias("ee_substrate"), best["s"].alias("ee_score"))


def fuse(knn: DataFrame, pocket: DataFrame | None = None, ee: DataFrame | None = None) -> DataFrame:
    """The class of record (k-NN, else EE) with the signals that agree.
    knn: ID, knn_substrate, knn_confidence; pocket: ID, volume; ee: ID, ee_substrate, ee_score."""
    spark = knn.sparkSession
    pocket = pocket if pocket is not None else spark.createDataFrame([], "ID string, volume double")
    ee = ee if ee is not None else spark.createDataFrame([], "ID string, ee_substrate string, ee_score double")
    j = knn.join(pocket, "ID", "full_outer").join(ee, "ID", "full_outer")
    k = F.coalesce("knn_substrate", F.lit(UNKNOWN))
    known = k != UNKNOWN
    band = volume_band(F.col("volume"))
    pocket_ok = F.when(known, within_one_size(k, band))
    ee_ok = F.when(known & F.col("ee_substrate").isNotNull(), k == F.col("ee_substrate"))
    by_ee = ~known & F.col("ee_substrate").isNotNull()
    return j.select(
        "ID", F.when(known, k).when(by_ee, F.col("ee_substrate")).otherwise(UNKNOWN).alias("predicted_substrate"), F.when(known, "knn").when(by_ee, "ee").otherwise("none").alias("predicted_substrate_source"),
        F.coalesce("knn_confidence", F.lit(0.0)).alias("confidence"), k.alias("knn_substrate"), F.col("volume").alias("pocket_volume"), band.alias("pocket_volume_band"), pocket_ok.alias("substrate_agreement"),
        "ee_substrate", "ee_score", ee_ok.alias("ee_agreement"), (F.coalesce(pocket_ok.cast("int"), F.lit(0)) + F.coalesce(ee_ok.cast("int"), F.lit(0))).alias("n_signals_agree"),
    )
