"""Superposition of many point sets at once, catalytic constellations, and residues that differ where structures are alike."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions.geometry import sequences
from winnow.functions.seq import DDXXD, DDXXD_OFFSETS, NSE_DTE, NSE_DTE_OFFSETS, coordinating, locate
from winnow.operators.alignment import Scores, align_places
from winnow.operators.similarity import packed
from winnow.store import stored

# The atoms of a constellation's residues.
CONSTELLATION = ("CA", "CB")
#: Points of a constellation: a place for each slot and atom.
PLACES = (len(DDXXD_OFFSETS) + len(NSE_DTE_OFFSETS)) * len(CONSTELLATION)
#: Structures and templates in one packed block, and blocks of templates in one part; templates and pairs that are compared at once.
AT_A_TIME, PART_BLOCKS, COLUMNS_AT_A_TIME, PAIRS_AT_A_TIME = 4096, 8, 512, 1 << 15
#: The alignment that anchors a superposition: match 2, mismatch -1, gaps -10 and -0.5, all doubled.
ANCHOR = Scores(opening=-20, extend=-1, match=4, mismatch=-2)


def superpose(a: np.ndarray, b: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs of point sets a[p] and b[p] (points, 3), over the points used[p]: rotation, shift and RMSD that lay a on b.

    One stacked decomposition of 3 x 3 matrices for all pairs; RMSD is NaN where fewer than three points are used.
    """
    w = used[..., None].astype(float)
    n = np.maximum(w.sum(1), 1)
    a, b = np.where(w > 0, a, 0.0), np.where(w > 0, b, 0.0)
    ca, cb = a.sum(1) / n, b.sum(1) / n
    x, y = (a - ca[:, None]) * w, (b - cb[:, None]) * w
    u, _, vt = np.linalg.svd(np.einsum("pki,pkj->pij", x, y))
    turned = np.sign(np.linalg.det(u) * np.linalg.det(vt))
    d = np.ones((len(a), 3))
    d[:, 2] = np.where(turned == 0, 1, turned)
    r = np.einsum("pji,pj,pkj->pik", vt, d, u)
    off = np.einsum("pij,pkj->pki", r, x) - y
    rmsd = np.sqrt((off * off).sum((1, 2)) / n[:, 0])
    return r, cb - np.einsum("pij,pj->pi", r, ca), np.where(used.sum(1) >= 3, rmsd, np.nan)


def rmsd_pairs(pairs: DataFrame) -> DataFrame:
    """query, target, rmsd, n after superposition of the rows (query, target, x, y, z, mx, my, mz) of each pair; NULL below three."""
    point = F.array(*[F.col(c).cast("double") for c in ("x", "y", "z", "mx", "my", "mz")])
    g = pairs.groupBy("query", "target").agg(F.collect_list(point).alias("p"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 256):
                q = b.iloc[lo : lo + 256]
                n = np.array([len(p) for p in q["p"]])
                x = np.full((len(q), n.max(), 6), np.nan)
                for k, p in enumerate(q["p"]):
                    x[k, : n[k]] = np.stack(p)
                rmsd = superpose(x[..., :3], x[..., 3:], np.isfinite(x).all(2))[2]
                yield pd.DataFrame({"query": q["query"], "target": q["target"], "rmsd": rmsd, "n": n})

    out = g.mapInPandas(run, "query string, target string, rmsd double, n long")
    return out.withColumn("rmsd", F.when(~F.isnan("rmsd"), F.col("rmsd")))


# ---------------------------------------------------------------- constellations


def constellations(atoms: DataFrame) -> DataFrame:
    """struct_id and points: PLACES points in the order of slot and atom, NULL where an atom is missing, of the structures with both motifs.

    A slot is the place of a residue among the coordinating ones of the first and then the second motif, wherever these stand.
    """
    s = sequences(atoms)
    a, b = locate(F.col("sequence"), DDXXD)[1], locate(F.col("sequence"), NSE_DTE)[1]
    slots = s.where(a.isNotNull() & b.isNotNull()).select("struct_id", F.posexplode(F.concat(coordinating(a, DDXXD_OFFSETS), coordinating(b, NSE_DTE_OFFSETS))).alias("slot", "res_idx"))
    which = F.array_position(F.array(*map(F.lit, CONSTELLATION)), F.col("atom_name")) - 1
    found = atoms.where(~F.col("hetero") & F.col("atom_name").isin(*CONSTELLATION)).join(slots, ["struct_id", "res_idx"])
    place = (F.col("slot") * len(CONSTELLATION) + which).cast("int")
    point = F.array(*[F.col(c).cast("double") for c in "xyz"])
    m = found.groupBy("struct_id", place.alias("place")).agg(F.min(point).alias("point"))
    m = m.groupBy("struct_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "point"))).alias("m"))
    return m.select("struct_id", F.transform(F.sequence(F.lit(0), F.lit(PLACES - 1)), lambda i: F.col("m")[i]).alias("points"))


def _at_most(c: np.ndarray) -> np.ndarray:
    """Of covariances c (pairs, 3, 3) a number not below the trace that any rotation gives them, near it for most.

    With the singular values s, the last with the sign of the determinant, that trace is t = s1 + s2 + s3, so
    t^2 = |c|^2 + 2 e and e^2 = |cofactors|^2 + 2 det t; t is between |c| / sqrt(3) and |c| sqrt(3).
    """
    u, v, w = c[:, 0].T, c[:, 1].T, c[:, 2].T
    cross = lambda p, q: (p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0])
    vw, wu, uv = cross(v, w), cross(w, u), cross(u, v)
    size = (c * c).sum((1, 2))
    minors = sum(m * m for row in (vw, wu, uv) for m in row)
    det = u[0] * vw[0] + u[1] * vw[1] + u[2] * vw[2]
    up, least = np.sqrt(3 * size), np.sqrt(size / 3)
    for _ in range(2):
        up = np.minimum(up, np.sqrt(size + 2 * np.sqrt(np.maximum(minors + 2 * det * np.where(det < 0, least, up), 0))))
    return up


def best_of(x: np.ndarray, y: np.ndarray, digits: int = 9, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of each set x the least RMSD to any set y and which that is (the first of those equal to so many digits), -1 where none shares three points.

    n times the squared RMSD is the sum of the squares of both sets about their centres, less twice the greatest trace that a rotation
    gives their covariance C.  That is at most sqrt(3) |C|, which leaves few pairs; of these a narrower bound leaves about one, which is
    superposed.  C comes of products in single precision, whose error is added to the bounds.  The y that have the same points meet the
    x together: these are centred over the points shared, so nothing is left to subtract for a pair.
    known: what each x has met elsewhere; then -1 is also where no y is as near to so many digits.
    """
    fx, fy = np.isfinite(x).all(2), np.isfinite(y).all(2)
    x0, y0 = np.where(fx[..., None], x, 0.0), np.where(fy[..., None], y, 0.0)
    scale = max(np.abs(x0).max(initial=0), np.abs(y0).max(initial=0)) or 1.0
    x0, y0 = x0 / scale, y0 / scale
    best, which = np.full(len(x), np.inf) if known is None else known.astype(float), np.full(len(x), len(y))
    masks, mask_of = np.unique(fx, axis=0, return_inverse=True) if len(x) else (fx, np.zeros(0, int))
    mask_of = mask_of.reshape(-1)

    def meet(i: np.ndarray, j: np.ndarray) -> None:
        for lo in range(0, len(i), 1 << 14):
            p, q = i[lo : lo + (1 << 14)], j[lo : lo + (1 << 14)]
            used = fx[p] & fy[q]
            rmsd = superpose(y[q], x[p], used)[2]
            order = np.lexsort((q, rmsd.round(digits), p))
            p, q, rmsd = p[order], q[order], rmsd[order]
            first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
            p, q, rmsd = p[first], q[first], rmsd[first]
            new, old = rmsd.round(digits), best[p].round(digits)
            better = (new < old) | ((new == old) & (q < which[p]))
            best[p[better]], which[p[better]] = rmsd[better], q[better]

    def most(i: np.ndarray) -> np.ndarray:
        """The squared RMSD, to scale, up to which one is met: no more above the least so far than a rounding."""
        return ((best[i] + 1.1 * 10.0**-digits + 1e-6) / scale) ** 2

    def meet_tile(cols: np.ndarray, mask: np.ndarray) -> None:
        """All x and some y that have the points of one mask."""
        used = fx & mask
        at = np.flatnonzero(used.sum(1) >= 3)
        n = used[at].sum(1).astype(float)
        a = x0[at] * mask[:, None]
        a = np.where(used[at][..., None], a - (a.sum(1) / n[:, None])[:, None], 0.0)
        b = y0[cols] - (y0[cols].sum(1) / max(1, mask.sum()))[:, None] * mask[:, None]
        own = (a * a).sum((1, 2))
        shared = (masks & mask).astype(float)
        other = shared @ (b * b).sum(2).T  # of each mask of x the squares of y over the points shared
        for axis in range(3):
            other -= (shared @ b[..., axis].T) ** 2 / np.maximum(shared.sum(1), 1)[:, None]
        slack = 2e-5 * (own + (b * b).sum((1, 2)).max())  # products of single precision, on twice the trace
        other = other.astype(np.float32)
        left = np.ascontiguousarray(a.transpose(2, 0, 1), np.float32)
        right = np.ascontiguousarray(b.transpose(1, 2, 0), np.float32).reshape(len(mask), -1)
        step = max(1, PAIRS_AT_A_TIME // len(cols))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        room = [np.empty((3, min(step, len(at)), 3 * len(cols)), np.float32), *(np.empty((min(step, len(at)), len(cols)), np.float32) for _ in range(3))]
        for lo in range(0, len(at), step):
            part = slice(lo, lo + step)
            rows = at[part]
            c, size, e, square = room[0][:, : len(rows)], *(r[: len(rows)] for r in room[1:])
            np.matmul(left[:, part], right, out=c)
            c = c.reshape(3, len(rows), 3, len(cols))
            np.multiply(c[0, :, 0], c[0, :, 0], out=size)
            for k in range(1, 9):
                np.multiply(c[k // 3, :, k % 3], c[k // 3, :, k % 3], out=square)
                size += square
            np.take(other, mask_of[rows], axis=0, out=e)
            new = np.flatnonzero(np.isinf(best[rows]))
            if len(new):
                meet(rows[new], cols[(e[new] - np.sqrt(12 * size[new])).argmin(1)])
            e += np.maximum(own[part] - slack[part] - n[part] * most(rows), -1e30)[:, None].astype(np.float32)
            np.maximum(e, 0, out=e)
            e *= e
            size *= 12
            i, j = np.divmod(np.flatnonzero(e <= size), len(cols))
            if len(i):
                bound = own[lo + i] + other[mask_of[rows[i]], j] - slack[lo + i] - 2 * _at_most(c[:, i, :, j].astype(float))
                near = bound <= n[lo + i] * most(rows[i])
                found.append((rows[i[near]], cols[j[near]], (bound / n[lo + i])[near]))
        if found:  # of each x first the one with the least bound, then those that this doesn't rule out
            i, j, bound = (np.concatenate(v) for v in zip(*found, strict=True))
            order = np.lexsort((bound, i))
            i, j, bound = i[order], j[order], bound[order]
            first = np.append(True, i[1:] != i[:-1])[: len(i)]
            meet(i[first], j[first])
            rest = ~first & (bound <= most(i))
            meet(i[rest], j[rest])

    if len(x) and len(y):
        kinds, kind_of = np.unique(fy, axis=0, return_inverse=True)
        order = np.argsort(kind_of.reshape(-1), kind="stable")
        ends = np.cumsum(np.bincount(kind_of.reshape(-1)))
        for mask, end, begin in zip(kinds, ends, [0, *ends[:-1]], strict=True):
            for lo in range(begin, end, COLUMNS_AT_A_TIME):
                meet_tile(order[lo : min(end, lo + COLUMNS_AT_A_TIME)], mask)
    found = which < len(y)
    return np.where(found, best, np.nan), np.where(found, which, -1)


def best_templates(found: DataFrame, templates: DataFrame, digits: int = 9) -> DataFrame:
    """struct_id, catalytic_constellation_rmsd and template: of rows of constellations(), the template of the least RMSD (ties: the least id).

    RMSDs that are the same to so many digits are ties; the RMSD is that of the template named.

    Both sides are dealt and packed once, in blocks of bounded size; a task holds one of structures while a part of the templates
    streams past.  NULL where no template shares three points.
    """
    kind = found.schema["struct_id"].dataType.simpleString()
    found = stored(found.select("struct_id", "points"))
    templates = stored(templates.groupBy("points").agg(F.min("struct_id").alias("struct_id")))  # of equal ones the others are never named
    nothing = F.array(*[F.lit(None).cast("double")] * 3)
    flat = lambda df: df.select(F.col("struct_id").alias("id"), F.flatten(F.transform("points", lambda p: F.coalesce(p.cast("array<double>"), nothing))).alias("v"))
    parts = lambda n, rows: max(1, -(-n // rows))
    a = packed(flat(found), parts(found.count(), AT_A_TIME), AT_A_TIME, kind)
    b = packed(flat(templates), parts(templates.count(), PART_BLOCKS * AT_A_TIME), AT_A_TIME, kind).select(F.col("ids").alias("names"), F.col("v").alias("tv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, np.ndarray] = {}
        points = lambda v, n: np.frombuffer(v.as_buffer(), float).reshape(n, -1, 3)
        for batch in batches:
            for i, block in enumerate(batch["block"].to_pylist()):
                ids, names = batch["ids"][i].values, batch["names"][i].values
                by_name = pc.sort_indices(names).to_numpy()
                known = met.setdefault(block, np.full(len(ids), np.inf))
                rmsd, which = best_of(points(batch["v"][i], len(ids)), points(batch["tv"][i], len(names))[by_name], digits, known)
                good = np.flatnonzero(which >= 0)
                known[good] = rmsd[good]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(good)), pa.array(rmsd[good]), names.take(pa.array(by_name[which[good]]))], ["struct_id", "rmsd", "template"])

    pairs = b.crossJoin(a.hint("shuffle_replicate_nl"))  # neither side is sent to all tasks or shuffled again: a task reads its two parts
    near = pairs.mapInArrow(run, f"struct_id {kind}, rmsd double, template {kind}")
    near = near.groupBy("struct_id").agg(F.min(F.struct(F.round("rmsd", digits).alias("k"), "template", "rmsd")).alias("b"))
    return found.select("struct_id").join(near, "struct_id", "left").select("struct_id", F.col("b.rmsd").alias("catalytic_constellation_rmsd"), F.col("b.template").alias("template"))


# ---------------------------------------------------------------- divergence


def divergence(neighbours: DataFrame, structures: DataFrame, panels: DataFrame, tau_high: float = 0.6, tau_low: float = 0.7, tolerance: float = 4.0) -> DataFrame:
    """How the panel residues of a neighbour differ in the design that is like it as a whole.

    neighbours: design, neighbour, similarity (0 to 1); structures: id, sequence, ca (a point a residue, NULL where it is missing),
    resnums (optional); panels: id, residues (0-based).  The design is laid on its neighbour by the residues that a global alignment
    puts in one column; a panel residue is mapped to the nearest residue of the design within the tolerance.  Returns design, neighbour,
    similarity, n_sdr_positions, sdr_identity, n_sdr_mismatches, divergent_positions and specificity_divergence.  Pairs below tau_high,
    without structures, panel or three anchors keep a row without positions; the structures of the first are not even joined.
    """
    s = structures if "resnums" in structures.columns else structures.withColumn("resnums", F.lit(None).cast("array<int>"))
    side = lambda name, p: s.select(F.col("id").alias(name), F.col("sequence").alias(f"{p}s"), F.col("ca").alias(f"{p}x"), F.col("resnums").alias(f"{p}r"))
    near = neighbours.where(F.col("similarity") >= tau_high).join(panels.select(F.col("id").alias("neighbour"), "residues"), "neighbour")
    j = near.join(side("design", "d"), "design").join(side("neighbour", "n"), "neighbour").select("design", "neighbour", "residues", "ds", "dx", "ns", "nx", "nr")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for lo in range(0, len(whole), 256):
                b = whole.iloc[lo : lo + 256]
                yield pd.DataFrame(_diverged(b, tolerance), columns=["design", "neighbour", "n", "same", "list"])

    got = j.mapInPandas(run, "design string, neighbour string, n long, same long, list string")
    out = neighbours.select("design", "neighbour", "similarity").join(got, ["design", "neighbour"], "left")
    share = F.col("same") / F.col("n")
    return out.select(
        "design", "neighbour", "similarity", F.coalesce("n", F.lit(0)).cast("long").alias("n_sdr_positions"), share.alias("sdr_identity"), (F.col("n") - F.col("same")).alias("n_sdr_mismatches"),
        F.coalesce("list", F.lit("")).alias("divergent_positions"), F.coalesce(share <= tau_low, F.lit(False)).alias("specificity_divergence"))


def _points(rows: pd.Series) -> list[np.ndarray]:
    return [np.array([[np.nan] * 3 if p is None else list(p) for p in row], float).reshape(-1, 3) for row in rows]


def _diverged(b: pd.DataFrame, tolerance: float) -> list[tuple]:
    """design, neighbour, panel residues mapped, those that are the same, and the list of the others."""
    design, other = _points(b["dx"]), _points(b["nx"])
    places = align_places(b["ds"].tolist(), b["ns"].tolist(), ANCHOR)
    most = max((len(i) for i, _ in places), default=0)
    x, y = np.full((len(b), most, 3), np.nan), np.full((len(b), most, 3), np.nan)
    for k, (i, j) in enumerate(places):
        ok = (i < len(design[k])) & (j < len(other[k]))
        x[k, : ok.sum()], y[k, : ok.sum()] = design[k][i[ok]], other[k][j[ok]]
    r, t, rmsd = superpose(x, y, np.isfinite(x).all(2) & np.isfinite(y).all(2)) if most else (None, None, np.full(len(b), np.nan))
    out = []
    for k, (name, neighbour, panel, ds, ns, numbers) in enumerate(zip(b["design"], b["neighbour"], b["residues"], b["ds"], b["ns"], b["nr"], strict=True)):
        panel = np.array(sorted({int(v) for v in panel if v is not None and 0 <= v < len(other[k])}), int)
        if np.isnan(rmsd[k]) or not len(panel):
            continue
        moved = design[k] @ r[k].T + t[k]
        d = np.sqrt(((moved[None] - other[k][panel][:, None]) ** 2).sum(2))
        d = np.where(np.isnan(d), np.inf, d)
        near = d.argmin(1)
        hit = d[np.arange(len(panel)), near] <= tolerance
        if hit.any():
            letter = [(ns[p] if p < len(ns) else "X", ds[q] if q < len(ds) else "X", p) for p, q in zip(panel[hit], near[hit], strict=True)]
            number = lambda p, numbers=numbers: int(numbers[p]) if numbers is not None and p < len(numbers) else p + 1
            out.append((name, neighbour, len(letter), sum(u == v for u, v, _ in letter), ";".join(f"{u}{number(p)}{v}" for u, v, p in letter if u != v)))
    return out
