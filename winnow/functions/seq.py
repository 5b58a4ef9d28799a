"""Sequence functions as column expressions: motifs, identifiers, alphabets, DNA."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two metal-binding motifs and the offsets of their coordinating residues.
DDXXD = r"[DE][DE]..[DE]"
NSE_DTE = r"(N|D)D(L|I|V).(S|T)...E"
DDXXD_OFFSETS = (0, 1, 4)
NSE_DTE_OFFSETS = (0, 1, 4, 8)
AMINO = "ACDEFGHIKLMNPQRSTVWY"

GC = np.array([ord(x) for x in "GCgc"], np.uint32)


def find_motifs(df: DataFrame, motifs: list[str], column: str = "sequence") -> DataFrame:
    """A boolean column per expression, named like it; NULL text matches nothing."""
    return df.select("*", *[F.coalesce(F.col(column).rlike(m), F.lit(False)).alias(m) for m in motifs])


def locate(c: Column, pattern: str) -> tuple[Column, Column]:
    """(matched text, 0-based start) of the first match, NULL if there is none."""
    text = F.regexp_extract(c, pattern, 0)
    text = F.when(text != "", text)
    return text, F.when(text.isNotNull(), F.instr(c, text) - 1)


def locate_exact(c: Column, pattern: str) -> tuple[Column, Column]:
    """As locate(), for expressions whose matched text may stand earlier without matching."""
    text = F.regexp_extract(c, pattern, 0)
    head = F.length(F.regexp_extract(c, rf"(?s)^(.*?)(?:{pattern})", 1))
    return F.when(text != "", text), F.when(text != "", head)


def coordinating(start: Column, offsets: tuple[int, ...]) -> Column:
    return F.when(start.isNotNull(), F.array(*[start + o for o in offsets]))


def motif_pair(df: DataFrame, column: str = "sequence") -> DataFrame:
    """Both motifs' text and start, the difference of the starts and the gap between them."""
    a, sa = locate(F.col(column), DDXXD)
    b, sb = locate(F.col(column), NSE_DTE)
    return df.select("*", F.coalesce(a, F.lit("")).alias("ddxxd_motif"), sa.alias("ddxxd_start"), F.coalesce(b, F.lit("")).alias("nse_dte_motif"), sb.alias("nse_dte_start"), (sb - sa).alias("motif_start_distance"), (sb - (sa + 5)).alias("motif_gap"))


def coordinating_relaxed(c: Column) -> Column:
    """Indices of the first motif's residues, with those of the second where it is found."""
    _, a = locate(c, DDXXD)
    _, b = locate(c, NSE_DTE)
    return F.when(a.isNotNull(), F.concat(coordinating(a, DDXXD_OFFSETS), F.coalesce(coordinating(b, NSE_DTE_OFFSETS), F.array().cast("array<int>"))))


# Substances by code, of which some are folded together with a protein.
SMILES = {
    "DMAPP": "CC(C)=CCOP([O-])(=O)OP([O-])([O-])=O",
    "GPP": "CC(C)=CCCC(C)=CCOP([O-])(=O)OP([O-])([O-])=O",
    "FPP": "CC(C)=CCCC(C)=CCCC(C)=CCOP([O-])(=O)OP([O-])([O-])=O",
    "GGPP": "CC(C)=CCCC(C)=CCCC(C)=CCCC(C)=CCOP([O-])(=O)OP([O-])([O-])=O",
    "GFPP": "CC(C)=CCCC(C)=CCCC(C)=CCCC(C)=CCCC(C)=CCOP([O-])(=O)OP([O-])([O-])=O",
    "C35": "CC(C)=CCCC(C)=CCCC(C)=CCCC(C)=CCCC(C)=CCCC(C)=CCCC(C)=CCOP([O-])(=O)OP([O-])([O-])=O",
}
COFOLDABLE = ("GPP", "FPP", "GGPP", "GFPP")


def smiles(code: Column) -> Column:
    """The SMILES of a substance code in any case, NULL for one that has none."""
    return F.create_map(*[F.lit(x) for kv in SMILES.items() for x in kv])[F.upper(code)]


def cofoldable(code: Column) -> Column:
    return F.coalesce(F.upper(code).isin(*COFOLDABLE), F.lit(False))


def accession(c: Column) -> Column:
    """sp|ACC|NAME and AF-ACC-F1... give ACC; anything else stays."""
    bar, af = F.regexp_extract(c, r"^[a-z]{2}\|([^|]+)\|", 1), F.regexp_extract(c, r"^AF-([A-Za-z0-9]+)-F\d+", 1)
    return F.when(bar != "", bar).when(af != "", af).otherwise(c)


def query_stem(c: Column) -> Column:
    """A structure's name without its folder, extension and _model."""
    s = F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"\.(pdb|cif|mmcif)(\.gz)?$", "")
    return F.regexp_replace(s, r"_model$", "")


def module_parts(c: Column, types: list[str]) -> Column:
    """struct(id, type, no) of <id>_<type>_<n>, read from the right, for known types."""
    p = rf"^(.*)_({'|'.join(types)})_(\d+)$"
    no = F.regexp_extract(c, p, 3)
    return F.when(no != "", F.struct(F.regexp_extract(c, p, 1).alias("id"), F.regexp_extract(c, p, 2).alias("type"), no.try_cast("int").alias("no")))


def safe_id(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_")


def from_log10(c: Column) -> Column:
    return F.pow(F.lit(10.0), c)


def pseudo_perplexity(mean_pll: Column) -> Column:
    return F.exp(-mean_pll)


def revcomp(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGTacgt", "TGCAtgca"))


def odd_characters(c: Column) -> Column:
    """Sorted distinct characters that are no canonical residue."""
    rest = F.regexp_replace(c, f"[{AMINO}]", "")
    return F.when(rest == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.regexp_extract_all(rest, F.lit("(?s)."), F.lit(0)))))


def max_homopolymer(c: Column) -> Column:
    """The longest run of one letter."""
    runs = F.regexp_extract_all(c, F.lit(r"(?s)((.)\2*)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def gc_window(c: Column, width: int) -> tuple[Column, Column]:
    """Least and greatest GC fraction over all windows (one window, if the text is shorter).

    Prefix sums in Arrow batches: built-in expressions would count every window anew,
    which takes quadratic time on long texts."""

    @F.pandas_udf("struct<lo double, hi double>")
    def extremes(texts: pd.Series) -> pd.DataFrame:
        out = np.full((len(texts), 2), np.nan)
        for i, t in enumerate(texts):
            if t:
                x = np.frombuffer(t.encode("utf-32-le"), np.uint32)
                k = np.concatenate([[0], np.cumsum(np.isin(x, GC))])
                w = min(width, len(x))
                share = (k[w:] - k[:-w]) / w
                out[i] = share.min(), share.max()
        return pd.DataFrame(out, columns=["lo", "hi"])

    e = extremes(c)
    return F.nanvl(e["lo"], F.lit(None).cast("double")), F.nanvl(e["hi"], F.lit(None).cast("double"))


def load_labels_by_type(df: DataFrame, key: str, kind: str) -> DataFrame:
    """Modal substrate of each key over its rows' types; ties: fewest carbons, then the name."""
    from winnow.operators.knn import CARBONS, TYPE_TO_SUBSTRATE
    from winnow.operators.stats import mode_label

    m = F.create_map(*[F.lit(x) for kv in TYPE_TO_SUBSTRATE.items() for x in kv])
    return mode_label(df.select(key, m[F.col(kind)].alias("substrate")), key, "substrate", CARBONS | {"IDS": 999})
