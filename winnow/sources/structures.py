"""Structure files to atom tables, confidence files to matrices, pocket reports to rows."""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnow.functions.geometry import ONE

ATOMS = "struct_id string, model int, chain string, res_seq int, res_idx int, res_name string, hetero boolean, atom_name string, element string, x double, y double, z double, b double, error string"
PREFERENCE = (".pdb", ".cif", ".mmcif")


def structure_files(spark: SparkSession, folder: str) -> DataFrame:
    """struct_id, path, content: <job>/<job>_model.cif where there are such, else the
    files of the folder; of a name the .pdb before .cif before .mmcif."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "content")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    f = f.withColumn("name", name).withColumn("stem", F.regexp_replace("name", r"\.(pdb|cif|mmcif)$", "")).filter(F.col("name").rlike(r"\.(pdb|cif|mmcif)$"))
    parent = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    f = f.withColumn("af3", F.col("stem") == F.concat(parent, F.lit("_model")))
    f = f.crossJoin(F.broadcast(f.agg(F.max("af3").alias("any_af3"))))  # one row
    f = f.filter(F.col("af3") == F.col("any_af3")).withColumn("struct_id", F.regexp_replace("stem", "_model$", ""))
    rank = F.when(F.col("name").endswith(".pdb"), 0).when(F.col("name").endswith(".mmcif"), 2).otherwise(1)
    w = Window.partitionBy("struct_id").orderBy(rank, "path")
    return f.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("struct_id", "path", "content")


def _pdb_rows(text: str) -> list[tuple]:
    rows, model = [], 1
    for line in text.splitlines():
        tag = line[:6]
        if tag == "ENDMDL":
            break
        if tag in ("ATOM  ", "HETATM"):
            if line[16] not in (" ", "A", "1"):
                continue
            name = line[12:16].strip()
            element = line[76:78].strip() or re.sub(r"[^A-Za-z].*", "", re.sub(r"^\d+", "", name))[:1]
            rows.append((model, line[21], int(line[22:26]), line[17:20].strip(), tag == "HETATM", name, element, float(line[30:38]), float(line[38:46]), float(line[46:54]), float(line[60:66] or 0)))
    return rows


def _cif_rows(text: str) -> list[tuple]:
    rows, names, inside = [], [], False
    for line in text.splitlines():
        if line.startswith("_atom_site."):
            names.append(line.split()[0][11:])
            inside = True
        elif inside and names and (line.startswith(("ATOM", "HETATM"))):
            r = dict(zip(names, re.findall(r"\"[^\"]*\"|'[^']*'|\S+", line), strict=False))
            if r.get("pdbx_PDB_model_num", "1") != "1" or r.get("label_alt_id", ".") not in (".", "?", "A", "1"):
                continue
            seq = r.get("auth_seq_id", r.get("label_seq_id", "0"))
            rows.append((1, r.get("auth_asym_id", r.get("label_asym_id", "A")), int(seq) if re.fullmatch(r"-?\d+", seq) else 0, r.get("label_comp_id", "UNK"), r["group_PDB"] == "HETATM", r.get("label_atom_id", "").strip("\"'"), r.get("type_symbol", ""), float(r["Cartn_x"]), float(r["Cartn_y"]), float(r["Cartn_z"]), float(r.get("B_iso_or_equiv", 0) or 0)))
        elif inside and rows and line.startswith("#"):
            break
    return rows


def atoms_of(struct_id: str, path: str, content: bytes) -> list[tuple]:
    """Rows of ATOMS of the first model; a file that can't be read is one row with its error."""
    try:
        text = content.decode("utf-8", "replace")
        rows = _pdb_rows(text) if path.endswith(".pdb") else _cif_rows(text)
        if not rows:
            raise ValueError("no atoms")
    except (ValueError, KeyError, IndexError) as e:
        return [(struct_id, *[None] * 12, f"{type(e).__name__}: {e}")]
    out, index, last = [], -1, None
    for r in rows:
        key = (r[1], r[2], r[3])
        if not r[4] and key != last:
            index, last = index + 1, key
        out.append((struct_id, *r[:3], None if r[4] else index, *r[3:], None))
    return out


def parse_structures(files: DataFrame) -> DataFrame:
    """The atom table of (struct_id, path, content)."""
    names = [x.split()[0] for x in ATOMS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                f = pd.DataFrame(atoms_of(r.struct_id, r.path, bytes(r.content)), columns=names)
                yield f.astype({"model": "Int32", "res_seq": "Int32", "res_idx": "Int32"})

    return files.mapInPandas(run, ATOMS)


def good_atoms(atoms: DataFrame) -> DataFrame:
    return atoms.filter("error IS NULL").drop("error")


def failures(atoms: DataFrame) -> DataFrame:
    return atoms.filter("error IS NOT NULL").select("struct_id", "error")


def pdb_lines(atoms: DataFrame, chain: str | None = None, polymer_only: bool = False) -> DataFrame:
    """struct_id, text in PDB columns: no water, residue names of three characters, on request one chain or polymer only."""
    a = atoms.filter(~F.col("res_name").isin("HOH", "WAT"))
    a = a.filter(F.col("chain") == chain) if chain else a
    a = a.filter(~F.col("hetero")) if polymer_only else a
    w = Window.partitionBy("struct_id").orderBy("hetero", "chain", "res_seq", "atom_name")
    a = a.withColumn("n", F.row_number().over(w))
    line = F.format_string("%-6s%5d %-4s %3s %1s%4d    %8.3f%8.3f%8.3f%6.2f%6.2f          %2s", F.when(F.col("hetero"), "HETATM").otherwise("ATOM"), "n", F.rpad(F.concat(F.lit(" "), "atom_name"), 4, " "), F.substring("res_name", 1, 3), F.substring("chain", 1, 1), "res_seq", "x", "y", "z", F.lit(1.0), "b", F.substring("element", 1, 2))
    g = a.groupBy("struct_id").agg(F.array_sort(F.collect_list(F.struct("n", line.alias("l")))).alias("ls"))
    return g.select("struct_id", F.concat(F.array_join(F.transform("ls", lambda e: e["l"]), "\n"), F.lit("\nEND\n")).alias("text"))


def read_pae(spark: SparkSession, folder: str) -> DataFrame:
    """ID, residue_ids, pae (rows), ptm, iptm of *_pae.npz files; a bad file is a row with an error."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                row = {"ID": re.sub(r"(_pae)?\.npz$", "", r.path.rsplit("/", 1)[1]), "residue_ids": None, "pae": None, "ptm": None, "iptm": None, "error": None}
                try:
                    z = np.load(io.BytesIO(bytes(r.content)))
                    m, ids = z["pae"], z["residue_ids"]
                    if m.ndim != 2 or m.shape[0] != m.shape[1] or len(ids) != len(m):
                        raise ValueError("pae is not square or has other residues")
                    row |= {"residue_ids": ids.astype("int32").tolist(), "pae": m.astype("float32").tolist()}
                    row |= {k: float(z[k]) for k in ("ptm", "iptm") if k in z.files}
                except (ValueError, KeyError, OSError) as e:
                    row["error"] = f"{type(e).__name__}: {e}"
                yield pd.DataFrame([row])

    return f.select("path", "content").mapInPandas(run, "ID string, residue_ids array<int>, pae array<array<float>>, ptm double, iptm double, error string")


def pae_long(pae: DataFrame) -> DataFrame:
    """ID, i, j (residue numbers), value."""
    r = pae.filter("pae IS NOT NULL").select("ID", "residue_ids", F.posexplode("pae").alias("p", "row"))
    r = r.select("ID", "residue_ids", F.element_at("residue_ids", F.col("p") + 1).alias("i"), F.posexplode("row").alias("q", "value"))
    return r.select("ID", "i", F.element_at("residue_ids", F.col("q") + 1).alias("j"), F.col("value").cast("double").alias("value"))


def fold_confidence(text: str) -> dict:
    """The matrix of a folding confidence file restricted to its largest chain."""
    d = json.loads(text)
    chains = d["token_chain_ids"]
    largest = max(sorted(set(chains)), key=chains.count)
    keep = [i for i, c in enumerate(chains) if c == largest]
    pae = np.array(d["pae"], float)[np.ix_(keep, keep)]
    return {"residue_ids": [int(d["token_res_ids"][i]) for i in keep], "pae": pae.tolist()}


def summary_scores(text: str) -> tuple[float | None, float | None]:
    d = json.loads(text)
    one = lambda x: float(np.mean(x)) if isinstance(x, list) and x else float(x) if isinstance(x, (int, float)) else None
    return one(d.get("ptm")), one(d.get("iptm"))


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """ID, module_id, domain, tmscore, residues of a detections file (ID -> regions)."""
    t = spark.read.text(path, wholetext=True)
    s = "map<string,array<struct<module_id:string,domain:string,tmscore:double,residues_mapping:map<string,string>>>>"
    e = t.select(F.explode(F.from_json("value", s)).alias("ID", "regions")).select("ID", F.explode_outer("regions").alias("r"))
    return e.select("ID", "r.module_id", "r.domain", "r.tmscore", F.sort_array(F.transform(F.map_keys("r.residues_mapping"), lambda k: k.cast("int"))).alias("residues"))


def read_pocket_info(spark: SparkSession, path: str) -> DataFrame:
    """file, pocket, name, value of pocket reports ('Pocket n :' then 'name : value' lines)."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.explode(F.split("value", r"(?m)^Pocket\s+")).alias("p"))
    t = t.select("file", F.regexp_extract("p", r"^(\d+)", 1).try_cast("int").alias("pocket"), F.explode(F.split("p", "\n")).alias("line")).filter("pocket IS NOT NULL")
    return t.select("file", "pocket", F.lower(F.trim(F.regexp_extract("line", r"^\s*(.*?)\s*:", 1))).alias("name"), F.trim(F.regexp_extract("line", r":\s*(\S+)\s*$", 1)).try_cast("double").alias("value")).filter("name <> '' AND value IS NOT NULL")


def read_spheres(spark: SparkSession, path: str) -> DataFrame:
    """file, x, y, z of the STP records of pocket vertex files."""
    t = spark.read.text(path).select(F.input_file_name().alias("file"), "value").filter(F.col("value").contains("STP"))
    return t.select("file", *[F.trim(F.substring("value", k, 8)).try_cast("double").alias(c) for c, k in (("x", 31), ("y", 39), ("z", 47))])


def three_to_one(name: str) -> str:
    return ONE.get(name.upper(), "X")
