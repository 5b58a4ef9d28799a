"""Geometry of structures over an atom table.

Atoms: struct_id, model, chain, res_seq, res_idx (0-based in the sequence), res_name, hetero,
atom_name, element, x, y, z, b.  Centroids, counts and distances are joins and
aggregates; eigenvalues, plane normals and superpositions are small matrices in vectorised Python.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.seq import coordinating_relaxed

# Fixed values of the measures.
OXYGENS = [("ASP", "OD1"), ("ASP", "OD2"), ("GLU", "OE1"), ("GLU", "OE2"), ("ASN", "OD1"), ("SER", "OG"), ("THR", "OG1")]
ONE = {"ALA": "A", "CYS": "C", "ASP": "D", "GLU": "E", "PHE": "F", "GLY": "G", "HIS": "H", "ILE": "I", "LYS": "K", "LEU": "L", "MET": "M", "ASN": "N", "PRO": "P", "GLN": "Q", "ARG": "R", "SER": "S", "THR": "T", "VAL": "V", "TRP": "W", "TYR": "Y"}
IONS = ("MG", "MN")
DIPHOSPHATES = ("POP", "PPV", "PPK")
SKIPPED_LIGANDS = ("HOH", "WAT", "POP", "PPV", "PPK")
GROUPS = {"frac_aromatic": "FYW", "frac_aliphatic": "AVLIM", "frac_acidic": "DE", "frac_basic": "KRH", "frac_polar": "STNQC", "frac_glycine": "G", "frac_proline": "P"}
RINGS = {"PHE": ("CG", "CD1", "CD2", "CE1", "CE2", "CZ"), "TYR": ("CG", "CD1", "CD2", "CE1", "CE2", "CZ"), "TRP": ("CD2", "CE2", "CE3", "CZ2", "CZ3", "CH2")}


def dist(a: str = "", b: str = "m") -> Column:
    """Between (x, y, z) and (bx, by, bz)."""
    return F.sqrt(sum(((F.col(f"{a}{c}") - F.col(f"{b}{c}")) * (F.col(f"{a}{c}") - F.col(f"{b}{c}")) for c in "xyz"), F.lit(0.0)))


def letters() -> Column:
    m = F.create_map(*[F.lit(v) for kv in ONE.items() for v in kv])
    return F.coalesce(m[F.col("res_name")], F.lit("X"))


def sequences(atoms: DataFrame) -> DataFrame:
    """struct_id, sequence, n_residues of the polymer residues, in order."""
    r = atoms.filter(~F.col("hetero")).groupBy("struct_id", "res_idx").agg(F.first("res_name").alias("res_name"))
    g = r.groupBy("struct_id").agg(F.array_sort(F.collect_list(F.struct("res_idx", letters().alias("a")))).alias("r"))
    return g.select("struct_id", F.array_join(F.transform("r", lambda e: e["a"]), "").alias("sequence"), F.size("r").alias("n_residues"))


def calphas(atoms: DataFrame) -> DataFrame:
    return atoms.filter(~F.col("hetero") & (F.col("atom_name") == "CA")).select("struct_id", "res_idx", "res_name", "x", "y", "z", "b")


def plddt_summary(atoms: DataFrame, confident: float = 70.0) -> DataFrame:
    p = calphas(atoms).groupBy("struct_id").agg(F.avg("b").alias("mean_plddt"), F.expr("percentile(b, 0.5)").alias("median_plddt"), F.min("b").alias("min_plddt"), F.avg((F.col("b") >= confident).cast("double")).alias("fraction_confident"), F.count(F.lit(1)).alias("n_residues"))
    return p


def score_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, total, extremes, the sum of the positive ones and the count of per-residue scores."""
    v = F.col(value)
    return df.groupBy(key).agg(F.avg(v).alias("avg_score"), F.sum(v).alias("total_score"), F.max(v).alias("max_score"), F.min(v).alias("min_score"), F.sum(F.greatest(v, F.lit(0.0))).alias("positive_sum"), F.count(v).alias("n_residues"))


def gyration(points: DataFrame, key: str = "struct_id") -> DataFrame:
    """Rg, asphericity, acylindricity and principal radii of the points of each key:
    six covariances from one aggregate, then a 3 x 3 eigenproblem per key."""
    cov = [F.covar_pop(a, b).alias(f"c{a}{b}") for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")]
    g = points.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *cov)

    @F.pandas_udf("struct<l1 double, l2 double, l3 double>")
    def eig(xx: pd.Series, yy: pd.Series, zz: pd.Series, xy: pd.Series, xz: pd.Series, yz: pd.Series) -> pd.DataFrame:
        m = np.stack([np.stack([xx, xy, xz], -1), np.stack([xy, yy, yz], -1), np.stack([xz, yz, zz], -1)], -2).astype(float)
        v = np.clip(np.linalg.eigvalsh(m), 0, None)
        return pd.DataFrame({"l1": v[:, 0], "l2": v[:, 1], "l3": v[:, 2]})

    e = g.withColumn("e", eig("cxx", "cyy", "czz", "cxy", "cxz", "cyz"))
    a, b, c = F.col("e.l1"), F.col("e.l2"), F.col("e.l3")
    return e.select(key, "n", F.sqrt(a + b + c).alias("radius_of_gyration"), (c - (a + b) / 2).alias("asphericity"), (b - a).alias("acylindricity"), F.sqrt(a).alias("r1"), F.sqrt(b).alias("r2"), F.sqrt(c).alias("r3"))


def gyration_radius(points: DataFrame, key: str = "struct_id") -> DataFrame:
    """Only the radius: no eigenproblem, all native."""
    return points.groupBy(key).agg(F.sqrt(F.var_pop("x") + F.var_pop("y") + F.var_pop("z")).alias("radius_of_gyration"), F.count(F.lit(1)).alias("n"))


def cage(atoms: DataFrame) -> DataFrame:
    """The coordinating oxygens: struct_id, res_idx, res_name, x, y, z."""
    s = sequences(atoms).select("struct_id", F.explode(coordinating_relaxed(F.col("sequence"))).alias("res_idx"))
    is_o = F.lit(False)
    for r, a in OXYGENS:
        is_o = is_o | ((F.col("res_name") == r) & (F.col("atom_name") == a))
    return atoms.filter(~F.col("hetero") & is_o).join(s, ["struct_id", "res_idx"], "left_semi").select("struct_id", "res_idx", "res_name", "x", "y", "z")


def metal_point(atoms: DataFrame) -> DataFrame:
    """struct_id, mx, my, mz: the centroid of the cage; structures without one are absent."""
    return cage(atoms).groupBy("struct_id").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg("z").alias("mz"), F.count(F.lit(1)).alias("n_coordinating_oxygens"))


def active_site(atoms: DataFrame) -> DataFrame:
    """Per structure: convergence radius of the cage, number of oxygens, distance to the nearest other atom."""
    m = metal_point(atoms)
    c = cage(atoms).join(m, "struct_id").groupBy("struct_id").agg(F.avg(dist()).alias("carboxylate_convergence_radius"), F.first("n_coordinating_oxygens").alias("n_coordinating_oxygens"))
    void = atoms.filter(~F.col("hetero")).join(m, "struct_id").groupBy("struct_id").agg(F.min(dist()).alias("metal_point_void"))
    return sequences(atoms).select("struct_id", "n_residues").join(c, "struct_id", "left").join(void, "struct_id", "left")


def motif_distance(atoms: DataFrame) -> DataFrame:
    """Between the C-alphas of the two motifs' residues: centroid distance and least distance."""
    from winnow.functions.seq import DDXXD, DDXXD_OFFSETS, NSE_DTE, NSE_DTE_OFFSETS, coordinating, locate

    s = sequences(atoms)
    ca = calphas(atoms)
    sets = []
    for name, p, off in (("a", DDXXD, DDXXD_OFFSETS), ("b", NSE_DTE, NSE_DTE_OFFSETS)):
        i = s.select("struct_id", F.explode(coordinating(locate(F.col("sequence"), p)[1], off)).alias("res_idx"))
        sets.append(ca.join(i, ["struct_id", "res_idx"], "left_semi").select("struct_id", *[F.col(c).alias(f"{name}{c}") for c in "xyz"]))
    ab = sets[0].join(sets[1], "struct_id").groupBy("struct_id").agg(F.min(dist("a", "b")).alias("motif_min_distance"), *[F.avg(f"{n}{c}").alias(f"{n}{c}") for n in "ab" for c in "xyz"])
    return ab.select("struct_id", dist("a", "b").alias("motif_centroid_distance"), "motif_min_distance")


def near_residues(atoms: DataFrame, radius: float) -> DataFrame:
    """struct_id, res_idx, res_name of residues with an atom within the radius of the metal point."""
    j = atoms.filter(~F.col("hetero")).join(metal_point(atoms), "struct_id")
    return j.filter(dist() <= radius).select("struct_id", "res_idx", "res_name").distinct()


def aromatic_lining(atoms: DataFrame, cutoff: float = 10.0, near: float = 3.5, far: float = 6.0, angle: float = 45.0) -> DataFrame:
    """Pocket residues, counts of the aromatic ones and how many rings face the metal point."""
    pocket = near_residues(atoms, cutoff)
    n = pocket.groupBy("struct_id").agg(F.count(F.lit(1)).alias("n_pocket_residues"), *[F.count(F.when(F.col("res_name") == r, 1)).alias(f"n_{r.lower()}") for r in ("TRP", "TYR", "PHE", "HIS")])
    n = n.withColumn("n_pocket_aromatics", F.col("n_trp") + F.col("n_tyr") + F.col("n_phe")).withColumn("aromatic_fraction", F.col("n_pocket_aromatics") / F.col("n_pocket_residues"))
    ring = F.lit(False)
    for r, names in RINGS.items():
        ring = ring | ((F.col("res_name") == r) & F.col("atom_name").isin(*names))
    r = atoms.filter(ring).join(pocket.select("struct_id", "res_idx"), ["struct_id", "res_idx"], "left_semi").join(metal_point(atoms), "struct_id")

    rings = r.groupBy("struct_id", "res_idx").agg(F.collect_list(F.array("x", "y", "z")).alias("p"), F.first(F.array("mx", "my", "mz")).alias("m"))

    def facing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            n = np.array([len(p) for p in b["p"]])
            x = np.full((len(b), n.max(), 3), np.nan)
            for k, p in enumerate(b["p"]):
                x[k, : n[k]] = np.stack(p)
            c = np.nanmean(x, axis=1)
            to = np.stack(b["m"]) - c
            d = np.linalg.norm(to, axis=1)
            normal = np.linalg.svd(np.nan_to_num(x - c[:, None]))[2][:, 2]  # all rings of a batch at once; missing points are at the centre
            tilt = np.degrees(np.arccos(np.clip(np.abs((normal * to).sum(1)) / np.maximum(d, 1e-12), 0, 1)))
            yield pd.DataFrame({"struct_id": b["struct_id"], "facing": ((n >= 3) & (d >= near) & (d <= far) & (tilt <= angle)).astype(int)})

    f = rings.mapInPandas(facing, "struct_id string, facing int").groupBy("struct_id").agg(F.sum("facing").alias("n_inward_rings"))
    return n.join(f, "struct_id", "left").fillna(0, ["n_inward_rings"])


def diphosphate_sensor(atoms: DataFrame, cutoff: float = 12.0, ry: float = 6.0, window: int = 2) -> DataFrame:
    """Basic residues whose tip is nearer to the metal point than their C-alpha and within the
    cutoff, and whether an Arg-Tyr pair is among them (near in sequence or in space)."""
    m = metal_point(atoms)
    tips = atoms.filter(((F.col("res_name") == "ARG") & F.col("atom_name").isin("NE", "NH1", "NH2")) | ((F.col("res_name") == "LYS") & (F.col("atom_name") == "NZ"))).join(m, "struct_id").groupBy("struct_id", "res_idx", "res_name").agg(F.min(dist()).alias("tip"))
    ca = calphas(atoms).join(m, "struct_id").select("struct_id", "res_idx", dist().alias("ca"))
    basic = tips.join(ca, ["struct_id", "res_idx"]).filter((F.col("tip") <= cutoff) & (F.col("tip") < F.col("ca")))
    arg = basic.filter("res_name = 'ARG'").select("struct_id", F.col("res_idx").alias("ri"))
    guan = atoms.filter((F.col("res_name") == "ARG") & F.col("atom_name").isin("NE", "NH1", "NH2", "CZ")).groupBy("struct_id", F.col("res_idx").alias("ri")).agg(*[F.avg(c).alias(f"g{c}") for c in "xyz"])
    oh = atoms.filter((F.col("res_name") == "TYR") & (F.col("atom_name") == "OH")).select("struct_id", F.col("res_idx").alias("yi"), *[F.col(c).alias(f"o{c}") for c in "xyz"])
    pair = arg.join(guan, ["struct_id", "ri"]).join(oh, "struct_id").filter((F.abs(F.col("ri") - F.col("yi")) <= window) | (dist("g", "o") <= ry)).groupBy("struct_id").agg(F.count(F.lit(1)).alias("n_ry"))
    n = basic.groupBy("struct_id").agg(F.count(F.lit(1)).alias("n_diphosphate_basic_residues"), F.min("tip").alias("min_basic_distance"))
    return m.select("struct_id").join(n, "struct_id", "left").join(pair, "struct_id", "left").select("struct_id", F.coalesce("n_diphosphate_basic_residues", F.lit(0)).alias("n_diphosphate_basic_residues"), "min_basic_distance", (F.coalesce("n_ry", F.lit(0)) > 0).alias("has_RY_pair"))


def ions(atoms: DataFrame) -> DataFrame:
    """Ion atoms: by residue name or by element."""
    return atoms.filter(F.col("hetero") & (F.upper("res_name").isin(*IONS) | F.upper("element").isin(*IONS)))


def ion_site_check(atoms: DataFrame, site_radius: float = 5.0, cutoff: float = 2.8, contacts: int = 2) -> DataFrame:
    """Per structure with a cage: ions, their least distance to its centroid, and how many touch its oxygens."""
    m = metal_point(atoms)
    # an ion is known by its place, so that reruns number alike
    i = ions(atoms).select("struct_id", F.struct("x", "y", "z").alias("ion"), "x", "y", "z")
    d = i.join(m, "struct_id").select("struct_id", "ion", dist().alias("d"))
    o = cage(atoms).select("struct_id", *[F.col(c).alias(f"b{c}") for c in "xyz"])
    t = near_pairs(i, o, cutoff).groupBy("struct_id", "ion").agg(F.count(F.lit(1)).alias("touch"))
    per = d.join(t, ["struct_id", "ion"], "left").fillna(0, ["touch"])
    g = per.groupBy("struct_id").agg(F.count(F.lit(1)).alias("n_ions_modelled"), F.min("d").alias("min_ion_to_cage_dist"), F.count(F.when(F.col("d") <= site_radius, 1)).alias("n_ions_in_site"), F.count(F.when(F.col("touch") >= contacts, 1)).alias("n_ions_coordinated"), F.max("touch").alias("max_contacts"))
    return m.select("struct_id").join(g, "struct_id", "left").fillna(0, ["n_ions_modelled", "n_ions_in_site", "n_ions_coordinated", "max_contacts"]).withColumn("well_placed", F.col("n_ions_coordinated") > 0)


def motif_positions(seqs: DataFrame, pattern: str, overlapping: bool = False) -> DataFrame:
    """struct_id, start of every match in one pass, left to right: without overlap, or at every place where one begins."""
    import re

    p = re.compile(f"(?={pattern})" if overlapping else pattern)

    @F.pandas_udf("array<int>")
    def starts(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [m.start() for m in p.finditer(t or "")])

    return seqs.select("struct_id", F.explode(starts("sequence")).alias("start"))


def near_pairs(a: DataFrame, b: DataFrame, radius: float, key: str = "struct_id") -> DataFrame:
    """The rows of a (key, x, y, z) beside those of b (key, bx, by, bz) of the same key within the radius, and their distance d.

    Points are put into cells as wide as the radius, and each of b into the 27 around its own, so that only points of
    neighbouring cells meet and not all pairs of a key.
    """
    cell = lambda p: [F.floor(F.col(f"{p}{c}") / F.lit(float(radius))) for c in "xyz"]
    around = F.explode(F.array(*[F.array(F.lit(i), F.lit(j), F.lit(k)) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
    left = a.withColumns({f"_c{i}": c for i, c in enumerate(cell(""))})
    right = b.withColumn("_o", around).withColumns({f"_c{i}": c + F.col("_o")[i] for i, c in enumerate(cell("b"))}).drop("_o")
    j = left.join(right, [key, "_c0", "_c1", "_c2"]).drop("_c0", "_c1", "_c2").withColumn("d", dist("", "b"))
    return j.where(F.col("d") <= radius)


def motif_coordination(atoms: DataFrame, cutoff: float = 2.8) -> DataFrame:
    """Of each structure with ions: the residues of either motif, over all its occurrences, that have an oxygen within the cutoff of an
    ion, whether both motifs have one, and the least distance from the ions' centroid to that of an occurrence of the first motif."""
    from winnow.functions.seq import DDXXD, DDXXD_OFFSETS, NSE_DTE, NSE_DTE_OFFSETS

    s = sequences(atoms)
    is_o = F.lit(False)
    for r, a in OXYGENS:
        is_o = is_o | ((F.col("res_name") == r) & (F.col("atom_name") == a))
    oxygens = atoms.filter(~F.col("hetero") & is_o).select("struct_id", "res_idx", "x", "y", "z")
    near = ions(atoms).select("struct_id", *[F.col(c).alias(f"b{c}") for c in "xyz"])
    held = near_pairs(oxygens, near, cutoff).select("struct_id", "res_idx").distinct()
    out = near.groupBy("struct_id").agg(*[F.avg(f"b{c}").alias(f"b{c}") for c in "xyz"])
    for name, pattern, offsets in (("asp", DDXXD, DDXXD_OFFSETS), ("nse", NSE_DTE, NSE_DTE_OFFSETS)):
        at = motif_positions(s, pattern)
        member = at.select("struct_id", "start", F.explode(F.array(*[F.col("start") + o for o in offsets])).alias("res_idx"))
        n = member.select("struct_id", "res_idx").distinct().join(held, ["struct_id", "res_idx"]).groupBy("struct_id").agg(F.count(F.lit(1)).alias(f"n_motif_coord_{name}"))
        if name == "asp":
            first = member.join(oxygens, ["struct_id", "res_idx"]).groupBy("struct_id", "start").agg(*[F.avg(c).alias(c) for c in "xyz"])
            first = first.join(out, "struct_id").groupBy("struct_id").agg(F.min(dist("", "b")).alias("mg_to_motif_dist"))
            out = out.join(first, "struct_id", "left")
        out = out.join(n, "struct_id", "left").fillna(0, [f"n_motif_coord_{name}"])
    both = (F.col("n_motif_coord_asp") > 0) & (F.col("n_motif_coord_nse") > 0)
    return out.select("struct_id", both.alias("mg_canonical_motif_coordination"), "n_motif_coord_asp", "n_motif_coord_nse", "mg_to_motif_dist")


def ligand(atoms: DataFrame, min_carbons: int = 5, res_name: str | None = None) -> DataFrame:
    """Atoms of the substrate of each structure: the hetero residue with a phosphorus and the most carbons."""
    h = atoms.filter(F.col("hetero") & ~F.upper("res_name").isin(*SKIPPED_LIGANDS))
    h = h.filter(F.col("res_name") == res_name) if res_name else h
    key = ["struct_id", "chain", "res_seq", "res_name"]
    n = h.groupBy(*key).agg(F.count(F.when(F.upper("element") == "C", 1)).alias("n_c"), F.count(F.when(F.upper("element") == "P", 1)).alias("n_p")).filter((F.col("n_p") >= 1) & (F.col("n_c") >= min_carbons))
    w = Window.partitionBy("struct_id").orderBy(F.col("n_c").desc(), "chain", "res_seq")
    best = n.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*key)
    return h.join(best, key, "left_semi")


def substrate_positioning(atoms: DataFrame, cutoff: float = 4.0) -> DataFrame:
    """Distances from the substrate's diphosphate and its nearest carbon to the cage and the ions."""
    m, lig = metal_point(atoms), ligand(atoms)
    dp = lig.filter(F.upper("element").isin("P", "O"))
    cen = dp.groupBy("struct_id").agg(*[F.avg(c).alias(c) for c in "xyz"]).join(m, "struct_id").select("struct_id", dist().alias("diphosphate_to_cage_dist"))
    o = cage(atoms).select("struct_id", *[F.col(c).alias(f"m{c}") for c in "xyz"])
    i = ions(atoms).select("struct_id", *[F.col(c).alias(f"m{c}") for c in "xyz"])
    near_o = dp.join(o, "struct_id").groupBy("struct_id").agg(F.min(dist()).alias("min_diphosphate_to_oxygen"))
    near_i = dp.join(i, "struct_id").groupBy("struct_id").agg(F.min(dist()).alias("min_diphosphate_to_ion"))
    carbon = lig.filter(F.upper("element") == "C").join(m, "struct_id").groupBy("struct_id").agg(F.min(dist()).alias("reactive_carbon_to_cage_dist"))
    out = m.select("struct_id")
    for x in (cen, near_o, near_i, carbon):
        out = out.join(x, "struct_id", "left")
    return out.withColumn("diphosphate_in_site", F.coalesce(F.least("min_diphosphate_to_oxygen", F.coalesce("min_diphosphate_to_ion", "min_diphosphate_to_oxygen")) <= cutoff, F.lit(False)))


def cyclisation(atoms: DataFrame, aromatic_cutoff: float = 6.0, far_bonds: int = 6, bond: float = 1.9) -> DataFrame:
    """Radius of gyration of the substrate's carbons, how near atoms far_bonds bonds apart come, and aromatic contacts."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf[["x", "y", "z"]].to_numpy(float)
        d = np.linalg.norm(p[:, None] - p[None], axis=2)
        best = np.nan
        for s in range(len(p)):
            hops, todo = {s: 0}, deque([s])
            while todo:
                u = todo.popleft()
                for v in np.flatnonzero((d[u] < bond) & (d[u] > 0)):
                    if v not in hops:
                        hops[int(v)] = hops[u] + 1
                        todo.append(int(v))
            far = [d[s, v] for v, k in hops.items() if k >= far_bonds]
            if far:
                best = np.nanmin([best, min(far)])
        c = p.mean(0)
        return pd.DataFrame({"struct_id": [pdf["struct_id"].iloc[0]], "ligand_rg": [float(np.sqrt(((p - c) ** 2).sum(1).mean()))], "fold_back": [None if np.isnan(best) else float(best)]})

    lig = ligand(atoms).filter(F.upper("element") == "C")
    f = lig.groupBy("struct_id").applyInPandas(fold, "struct_id string, ligand_rg double, fold_back double")
    arom = atoms.filter(F.col("res_name").isin("TRP", "TYR", "PHE")).select("struct_id", "res_idx", *[F.col(c).alias(f"m{c}") for c in "xyz"])
    n = lig.select("struct_id", "x", "y", "z").join(arom, "struct_id").filter(dist() <= aromatic_cutoff).groupBy("struct_id").agg(F.countDistinct("res_idx").alias("n_aromatic_contacts"))
    return f.join(n, "struct_id", "left").fillna(0, ["n_aromatic_contacts"])


def site_features(atoms: DataFrame, radius: float = 12.0, inner: float = 8.0) -> DataFrame:
    """Shares of residue groups and of the 20 residues near the metal point, and five measures of its shell."""
    r = near_residues(atoms, radius).withColumn("a", letters())
    shares = [F.avg(F.col("a").isin(*list(v)).cast("double")).alias(k) for k, v in GROUPS.items()] + [F.avg((F.col("a") == a).cast("double")).alias(f"frac_aa_{a}") for a in sorted(set(ONE.values()))]
    g = r.groupBy("struct_id").agg(F.count(F.lit(1)).alias("n_shell_residues"), *shares)
    ca = calphas(atoms).join(r.select("struct_id", "res_idx"), ["struct_id", "res_idx"], "left_semi").join(metal_point(atoms), "struct_id")
    shell = ca.groupBy("struct_id").agg(F.sqrt(F.var_pop("x") + F.var_pop("y") + F.var_pop("z")).alias("shell_radius_of_gyration"), F.avg(dist()).alias("mean_dist_to_metal_point"), F.count(F.when(F.col("res_name").isin("PHE", "TYR", "TRP") & (dist() <= inner), 1)).alias("n_aromatic_within_8A"))
    a = active_site(atoms).select("struct_id", "carboxylate_convergence_radius", "n_coordinating_oxygens", "n_residues")
    return g.join(shell, "struct_id").join(a, "struct_id")


# ------------------------------------------------------------------ pockets


def choose_pocket(pockets: DataFrame, points: DataFrame, limit: float = 12.0) -> DataFrame:
    """struct_id, pocket: of the pockets (struct_id, pocket, x, y, z per sphere) one that
    encloses the metal point (within its own radius), then the nearest, up to the limit;
    depth is the mean distance of its spheres to their centroid."""
    c = pockets.groupBy("struct_id", "pocket").agg(*[F.avg(k).alias(f"c{k}") for k in "xyz"])
    j = pockets.join(c, ["struct_id", "pocket"]).join(points.select("struct_id", "mx", "my", "mz"), "struct_id")
    g = j.groupBy("struct_id", "pocket").agg(F.min(dist()).alias("dmin"), F.avg(dist("", "c")).alias("pocket_depth"), F.max(dist("", "c")).alias("reach"), F.first(dist("c", "m")).alias("centre"))
    g = g.withColumn("enclosed", F.col("centre") <= F.col("reach")).filter(F.col("dmin") <= limit)
    w = Window.partitionBy("struct_id").orderBy(F.col("enclosed").desc(), "dmin", "pocket")
    return g.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("struct_id", "pocket", "dmin", "enclosed", "pocket_depth")


def nearest_pocket(centres: DataFrame, points: DataFrame, limit: float = 12.0) -> DataFrame:
    """The pocket whose centre is nearest to the metal point."""
    d = centres.join(points.select("struct_id", "mx", "my", "mz"), "struct_id").select("struct_id", "pocket", dist().alias("d")).filter(F.col("d") <= limit)
    return d.groupBy("struct_id").agg(F.min(F.struct("d", "pocket")).alias("b")).select("struct_id", F.col("b.pocket").alias("pocket"), F.col("b.d").alias("distance"))


def pca_2d(df: DataFrame, id_col: str, vec_col: str, standardise: bool = True) -> tuple[DataFrame, list[float]]:
    """ID, pc1, pc2 and the share of variance: moments from one pass, the axes on the driver (dim x dim)."""
    d = len(df.filter(F.col(vec_col).isNotNull()).select(vec_col).first()[0])

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, q = 0, np.zeros(d), np.zeros((d, d))
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[vec_col]).astype(float)
                n, s, q = n + len(x), s + x.sum(0), q + x.T @ x
        i, j = np.indices((d, d))
        yield pd.DataFrame({"i": [-1, *[-2] * d, *i.ravel()], "j": [0, *range(d), *j.ravel()], "v": [float(n), *s, *q.ravel()]})

    rows = df.filter(F.col(vec_col).isNotNull()).select(vec_col).mapInPandas(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # d * d numbers
    s, q, n = np.zeros(d), np.zeros((d, d)), 0.0
    for r in rows:
        if r.i == -1:
            n = r.v
        elif r.i == -2:
            s[r.j] = r.v
        else:
            q[r.i, r.j] = r.v
    mean = s / n
    cov = q / n - np.outer(mean, mean)
    sd = np.sqrt(np.diag(cov)) if standardise else np.ones(d)
    sd[sd == 0] = 1
    vals, vecs = np.linalg.eigh(cov / np.outer(sd, sd))
    top = vecs[:, ::-1][:, :2]
    top = top * np.where(top[np.abs(top).argmax(0), range(top.shape[1])] < 0, -1, 1)
    if top.shape[1] < 2:
        top = np.hstack([top, np.zeros((d, 1))])
    axes = [F.array(*[F.lit(float(x)) for x in top[:, k] / sd]) for k in (0, 1)]
    shift = [float(mean @ (top[:, k] / sd)) for k in (0, 1)]
    dot = lambda a, c: F.aggregate(F.zip_with(F.col(vec_col), a, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda t, v: t + v) - c
    share = [float(v / max(vals.sum(), 1e-300)) for v in vals[::-1][:2]]
    return df.select(id_col, dot(axes[0], shift[0]).alias("pc1"), dot(axes[1], shift[1]).alias("pc2")), share


def pcoa(pairs: DataFrame, block: int = 8, steps: int = 12, tolerance: float = 1e-10) -> tuple[DataFrame, list[float]]:
    """id, pc1 and pc2 by classical scaling of a table of distances (a, b, d), both ways round, and the eigenvalues of the two axes.

    The doubly centred matrix is never built: its product with a few vectors follows from the rows' squared distances and their means.
    Rows are stored once as arrays; a block of vectors (points x block numbers, all that the driver holds) is multiplied again and again,
    and the best axes are taken from the space of all products, until their residual is below the tolerance.  A missing distance is 0;
    the larger share of each axis is positive.
    """
    from winnow.store import stored

    spark = pairs.sparkSession
    ids = [r.a for r in pairs.select("a").distinct().orderBy("a").collect()]  # the points
    n = len(ids)
    kind = pairs.schema["a"].dataType.simpleString()
    index = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], f"id {kind}, k int")
    near = pairs.join(F.broadcast(index.select(F.col("id").alias("a"), F.col("k").alias("i"))), "a").join(F.broadcast(index.select(F.col("id").alias("b"), F.col("k").alias("j"))), "b")
    rows = stored(near.groupBy("i").agg(F.collect_list("j").alias("j"), F.collect_list((F.col("d") * F.col("d")).cast("double")).alias("d2"), F.sum(F.col("d") * F.col("d")).alias("total")))
    mean = np.zeros(n)
    for r in rows.select("i", "total").collect():
        mean[r.i] = r.total / n

    def product(v: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"i": b["i"], "v": [np.asarray(d) @ v[np.asarray(j)] for j, d in zip(b["j"], b["d2"], strict=True)]})

        out = np.zeros_like(v)
        for r in rows.select("i", "j", "d2").mapInPandas(run, "i int, v array<double>").collect():
            out[r.i] = r.v
        s = v.sum(0)
        return -0.5 * (out - mean[:, None] * s - mean @ v + mean.mean() * s)

    block = min(block, n)
    new = np.linalg.qr(np.random.default_rng(0).normal(size=(n, block)))[0]
    basis, image = np.zeros((n, 0)), np.zeros((n, 0))
    values, axes = np.zeros(2), np.zeros((n, 2))
    for _ in range(steps):
        w = product(new)
        basis, image = np.hstack([basis, new]), np.hstack([image, w])
        t = basis.T @ image
        vals, vecs = np.linalg.eigh((t + t.T) / 2)
        top = vecs[:, ::-1][:, :2]
        values[: top.shape[1]], axes[:, : top.shape[1]] = vals[::-1][: top.shape[1]], basis @ top
        off = np.abs(image @ top - axes[:, : top.shape[1]] * vals[::-1][: top.shape[1]]).max()
        for _ in range(2):  # twice, so that the basis stays orthogonal
            w = w - basis @ (basis.T @ w)
        q, r = np.linalg.qr(w)
        new = q[:, np.abs(np.diag(r)) > 1e-12 * max(1.0, np.abs(values).max())]
        if off <= tolerance * max(1.0, np.abs(values).max()) or not new.shape[1] or basis.shape[1] + new.shape[1] > n:
            break
    points = axes * np.sqrt(np.clip(values, 0, None)) * np.where(axes.sum(0) < 0, -1, 1)
    return spark.createDataFrame([(i, float(p[0]), float(p[1])) for i, p in zip(ids, points, strict=True)], f"id {kind}, pc1 double, pc2 double"), values.tolist()


def pcoa_2d(distances: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """Classical scaling of a square distance matrix (a few thousand rows, on the driver)."""
    n = len(distances)
    j = np.eye(n) - 1 / n
    vals, vecs = np.linalg.eigh(-0.5 * j @ distances**2 @ j)
    vals, vecs = vals[::-1], vecs[:, ::-1]
    pos = np.clip(vals, 0, None)
    return vecs[:, :2] * np.sqrt(pos[:2]), [float(v / max(pos.sum(), 1e-300)) for v in pos[:2]]
