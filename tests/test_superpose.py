"""Stacked superposition, templates and divergence against plain code."""

import random

import numpy as np
import pytest

from winnow.functions import geometry as g
from winnow.functions import superpose as sp


def plain_fit(a, b):
    """One pair by the textbook: rotation, shift and RMSD."""
    ca, cb = a.mean(0), b.mean(0)
    u, _, vt = np.linalg.svd((a - ca).T @ (b - cb))
    r = vt.T @ np.diag([1, 1, np.sign(np.linalg.det(vt.T @ u.T))]) @ u.T
    return r, cb - r @ ca, float(np.sqrt((((a - ca) @ r.T - (b - cb)) ** 2).sum(1).mean()))


def turned(x, seed):
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(3, 3)))
    q = q * np.sign(np.diag(r))
    q[:, 0] *= np.sign(np.linalg.det(q))
    return x @ q.T + [4, -2, 9]


def test_stacked_against_one_by_one():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(40, 12, 3)), rng.normal(size=(40, 12, 3))
    b[:10] = [turned(x, 5) for x in a[:10]]
    a[10:15] *= [1, 1, 0]  # flat
    b[15] = a[15] * [1, 1, -1]  # a mirror image can't be laid on
    used = rng.random((40, 12)) < 0.8
    used[39, 2:] = False
    a[~used], b[0, ~used[0]] = np.nan, np.nan
    r, t, rmsd = sp.superpose(a, b, used)
    assert np.isnan(rmsd[39]) and rmsd[:10].max() < 1e-9 and rmsd[15] > 0.1
    for k in range(39):
        x, y = a[k][used[k]], b[k][used[k]]
        assert rmsd[k] == pytest.approx(plain_fit(x, y)[2], abs=1e-9)
        assert np.sqrt(((x @ r[k].T + t[k] - y) ** 2).sum(1).mean()) == pytest.approx(rmsd[k], abs=1e-9)
        assert np.linalg.det(r[k]) == pytest.approx(1)


def test_least_rmsd_over_templates(spark, monkeypatch):
    """Against every pair: missing points, twins among the templates, sets that share too few, and several blocks."""
    monkeypatch.setattr(sp, "AT_A_TIME", 9)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(5, sp.PLACES, 3)) * 5
    sets = {f"s{k:02}": turned(base[k % 5] + rng.normal(size=(sp.PLACES, 3)) * 0.3 * (k % 4), k) for k in range(40)}
    for k, v in enumerate(sets.values()):
        v[rng.random(sp.PLACES) < 0.15 * (k % 3)] = np.nan
    sets["few"] = np.full((sp.PLACES, 3), np.nan)
    sets["few"][:2] = 1.0
    sets["t_twin"] = sets["s03"].copy()
    names = ["s03", "s10", "s11", "s17", "s22", "t_twin"] + [f"s{k:02}" for k in range(25, 37)]
    rows = [(n, [None if np.isnan(p).any() else p.tolist() for p in v]) for n, v in sets.items()]
    df = spark.createDataFrame(rows, "struct_id string, points array<array<double>>")
    got = {r.struct_id: r for r in sp.best_templates(df, df.where(df.struct_id.isin(names))).collect()}
    assert len(got) == len(sets)
    for n, x in sets.items():
        all_ = []
        for t in sorted(names):
            ok = np.isfinite(x).all(1) & np.isfinite(sets[t]).all(1)
            if ok.sum() >= 3:
                all_.append((round(plain_fit(sets[t][ok], x[ok])[2], 8), t))
        if all_:
            v, t = min(all_)
            assert got[n].catalytic_constellation_rmsd == pytest.approx(v, abs=1e-7) and got[n].template == t
        else:
            assert got[n].template is None and got[n].catalytic_constellation_rmsd is None
    assert [r.template for r in sp.best_templates(df.limit(2), df.limit(0)).collect()] == [None, None]


def test_rmsds_equal_to_the_digits_asked_for_are_ties(spark, monkeypatch):
    """The lesser name wins, in one block and between blocks, though the other's RMSD is less by a millionth."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(sp.PLACES, 3)) * 5
    off = rng.normal(size=(sp.PLACES, 3))
    sets = {"x": x, "a": x + off * (1 + 1e-6), "b": x + off}
    df = spark.createDataFrame([(n, v.tolist()) for n, v in sets.items()], "struct_id string, points array<array<double>>")
    r = [plain_fit(sets[n], x)[2] for n in "ab"]
    assert r[0] - r[1] > 1e-9 and round(r[0], 4) == round(r[1], 4)
    for at_a_time in (2048, 1):
        monkeypatch.setattr(sp, "AT_A_TIME", at_a_time)
        named = [sp.best_templates(df.where("struct_id = 'x'"), df.where("struct_id <> 'x'"), d).first().template for d in (9, 4)]
        assert named == ["b", "a"]


def unlike(seed, n, size=1.0):
    """Sets without structure, some of whose points are missing in one of a few ways, far from each other."""
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, sp.PLACES, 3)) + rng.normal(size=(n, 1, 3)) * 10) * size
    x[(rng.random((6, sp.PLACES)) < 0.15)[rng.integers(0, 6, n)]] = np.nan
    return x


def of_all(x, y, digits=4):
    """The least RMSD of each x and which y has it, by every pair."""
    p, q = (v.reshape(-1) for v in np.indices((len(x), len(y))))
    rmsd = sp.superpose(y[q], x[p], np.isfinite(x[p]).all(2) & np.isfinite(y[q]).all(2))[2].reshape(len(x), -1)
    which = np.where(np.isnan(rmsd), np.inf, rmsd.round(digits)).argmin(1)
    return rmsd[np.arange(len(x)), which], which


def test_few_pairs_are_superposed(monkeypatch):
    """Even where no set is like another."""
    x, y = unlike(7, 150), unlike(8, 1200)
    rmsd, which = of_all(x, y)
    plain, met = sp.superpose, []
    monkeypatch.setattr(sp, "superpose", lambda a, b, used: met.append(len(a)) or plain(a, b, used))
    got = sp.best_of(x, y, 4)
    assert (got[1] == which).all() and got[0] == pytest.approx(rmsd, abs=1e-9)
    assert sum(met) < 0.05 * len(x) * len(y)


@pytest.mark.parametrize("size", [1.0, 1e-3, 1e-25, 1e21])
def test_best_of_parts_is_that_of_all(size, monkeypatch):
    """Coordinates of any size, some columns and pairs at a time, and what was met before."""
    monkeypatch.setattr(sp, "COLUMNS_AT_A_TIME", 7)
    monkeypatch.setattr(sp, "PAIRS_AT_A_TIME", 50)
    x, y = unlike(9, 40, size), unlike(10, 90, size)
    y[70:] = y[:20] * [1, 1, -1] + 3 * size
    x[5, 2:], x[6:12] = np.nan, y[70:76]
    rmsd, which = of_all(x, y)
    got = sp.best_of(x, y, 4)
    ok = np.arange(len(x)) != 5
    assert got[1][5] == -1 and np.isnan(got[0][5])
    assert (got[1][ok] == which[ok]).all() and got[0][ok] == pytest.approx(rmsd[ok], abs=1e-9, rel=1e-9)
    first = sp.best_of(x, y[:45], 4)
    known = np.where(np.isnan(first[0]), np.inf, first[0])
    then = sp.best_of(x, y[45:], 4, known)
    tie = np.array([r == s for r, s in zip(then[0].round(4), known.round(4), strict=True)])
    assert (np.where((then[1] >= 0) & ~tie, then[1] + 45, first[1])[ok] == which[ok]).all()
    assert [v.tolist() for v in sp.best_of(x[:0], y)] == [[], []] and (sp.best_of(x, y[:0])[1] == -1).all()


def test_the_bound_is_not_below_the_trace():
    rng = np.random.default_rng(11)
    c = rng.normal(size=(3000, 3, 3)) * 10.0 ** rng.integers(-3, 4, (3000, 1, 1))
    c[:500, :, 2], c[500:900, :, 1:], c[900:1000] = 0, 0, 0
    c[1000:1100] = np.eye(3) * [1, 1, -1] * rng.random((100, 1, 1))
    s = np.linalg.svd(c, compute_uv=False)
    t = s[:, 0] + s[:, 1] + np.sign(np.linalg.det(c)) * s[:, 2]
    size = s.sum(1)
    assert (sp._at_most(c) >= t - 1e-6 * size).all() and np.median((sp._at_most(c) - t)[1100:] / size[1100:]) < 0.01


def test_equal_templates_in_several_parts(spark, monkeypatch):
    """Many have the same points; the least id is named though it may be in any part."""
    monkeypatch.setattr(sp, "AT_A_TIME", 3)
    monkeypatch.setattr(sp, "PART_BLOCKS", 1)
    x, y = unlike(12, 10), unlike(13, 12)
    y = np.concatenate([y, y, y[:6]])
    names = [f"t{k}" for k in np.random.default_rng(14).permutation(len(y))]
    frame = lambda ids, v: spark.createDataFrame([(n, [None if np.isnan(p).any() else p.tolist() for p in w]) for n, w in zip(ids, v, strict=True)], "struct_id string, points array<array<double>>")
    order = np.argsort(names)
    rmsd, which = of_all(x, y[order])
    got = {r.struct_id: r for r in sp.best_templates(frame([f"x{k}" for k in range(10)], x), frame(names, y), 4).collect()}
    for k in range(10):
        assert got[f"x{k}"].template == names[order[which[k]]] and got[f"x{k}"].catalytic_constellation_rmsd == pytest.approx(rmsd[k], abs=1e-9)


def test_divergence_of_panel_residues(spark):
    """Gaps in the alignment, missing residues, numbers of the file, pairs that are not looked at."""
    r = random.Random(3)
    x = np.array([[r.gauss(0, 12) for _ in range(3)] for _ in range(60)])
    seq = "".join(r.choices("ACDEFGHIKLMNPQRSTVWY", k=60))
    design = seq[:20] + seq[24:]  # four residues fewer
    design = design[:5] + ("W" if design[5] != "W" else "Y") + design[6:]
    points = turned(np.delete(x, range(20, 24), 0), 8).tolist()
    points[7] = None
    s = spark.createDataFrame([("n", seq, x.tolist(), list(range(101, 161))), ("d", design, points, None), ("far", seq, x.tolist(), None), ("short", "AC", x[:2].tolist(), None)], "id string, sequence string, ca array<array<double>>, resnums array<int>")
    e = spark.createDataFrame([("d", "n", 0.9), ("far", "n", 0.2), ("short", "n", 0.8), ("gone", "n", 0.9), ("n", "d", 0.7)], "design string, neighbour string, similarity double")
    p = spark.createDataFrame([("n", [5, 7, 10, 21, 30, 99])], "id string, residues array<int>")
    got = {v.design: v for v in sp.divergence(e, s, p, tolerance=1.0).collect()}
    d = got["d"]
    assert (d.n_sdr_positions, d.n_sdr_mismatches, d.divergent_positions, d.specificity_divergence) == (3, 1, f"{seq[5]}106{design[5]}", True)
    assert d.sdr_identity == pytest.approx(2 / 3)
    for k in ("far", "short", "gone", "n"):
        assert got[k].n_sdr_positions == 0 and got[k].sdr_identity is None and not got[k].specificity_divergence
    one = {(v.query, v.target): (v.rmsd, v.n) for v in sp.rmsd_pairs(spark.createDataFrame([("a", "b", *map(float, q), *map(float, w)) for q, w in zip(x, turned(x, 4), strict=True)] + [("a", "c", *[1.0] * 6)] * 2, "query string, target string, x double, y double, z double, mx double, my double, mz double")).collect()}
    assert one["a", "b"] == (pytest.approx(0, abs=1e-9), 60) and one["a", "c"] == (None, 2)


def test_points_near_each_other(spark):
    r = random.Random(5)
    pts = lambda n, p: [(r.choice("st"), k, *[round(r.uniform(-6, 6), 1) for _ in range(3)]) for k in range(n)]
    a, b = pts(150, ""), pts(60, "b")
    got = {(v.i, v.j) for v in g.near_pairs(spark.createDataFrame(a, "struct_id string, i int, x double, y double, z double"), spark.createDataFrame(b, "struct_id string, j int, bx double, by double, bz double"), 2.0).collect()}
    assert got == {(p[1], q[1]) for p in a for q in b if p[0] == q[0] and sum((u - v) ** 2 for u, v in zip(p[2:], q[2:], strict=True)) ** 0.5 <= 2.0}


def test_all_occurrences_of_a_motif(spark):
    s = spark.createDataFrame([("s", "DDADDAADDE"), ("n", None), ("e", "")], "struct_id string, sequence string")
    at = lambda over: sorted((r.struct_id, r.start) for r in g.motif_positions(s, "[DE][DE]..[DE]", over).collect())
    assert at(False) == [("s", 0)] and at(True) == [("s", 0), ("s", 3)]
