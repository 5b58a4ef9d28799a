"""Parsing, geometry and ordering on small made-up structures."""

import io

import numpy as np
import pytest

from winnow.functions import geometry as g
from winnow.functions import order, seq
from winnow.sources import structures as st


def pdb(rows):
    return "".join(f"{'HETATM' if het else 'ATOM':<6}{i + 1:>5} {' ' + name:<4} {res:>3} A{num:>4}    {x:8.3f}{y:8.3f}{z:8.3f}{1:6.2f}{b:6.2f}          {el:>2}\n" for i, (het, res, num, name, el, x, y, z, b) in enumerate(rows)) + "END\n"


SEQ = ["ASP", "ASP", "ALA", "ALA", "ASP"]


@pytest.fixture()
def atoms(spark, tmp_path):
    rows = []
    for k, r in enumerate(SEQ):
        rows.append((False, r, k + 10, "CA", "C", float(k), 0.0, 0.0, 60.0 + 10 * k))
        if r == "ASP":
            rows += [(False, r, k + 10, "OD1", "O", float(k), 1.0, 0.0, 50.0), (False, r, k + 10, "OD2", "O", float(k), -1.0, 0.0, 50.0)]
    rows += [(True, "MG", 90, "MG", "MG", 5 / 3, 0.0, 0.5, 0.0), (True, "HOH", 91, "O", "O", 9.0, 9.0, 9.0, 0.0)]
    rows += [(True, "FPP", 92, f"C{i}", "C", 1.5 * i, 3.0, 0.0, 0.0) for i in range(8)] + [(True, "FPP", 92, "P1", "P", -1.5, 3.0, 0.0, 0.0)]
    (tmp_path / "s1.pdb").write_text(pdb(rows))
    (tmp_path / "s1.cif").write_text("junk")
    (tmp_path / "bad.pdb").write_text("nothing\n")
    return st.parse_structures(st.structure_files(spark, str(tmp_path)))


def test_parse(atoms):
    assert {r.struct_id for r in st.failures(atoms).collect()} == {"bad"}
    a = st.good_atoms(atoms)
    r = g.sequences(a).first()
    assert (r.struct_id, r.sequence, r.n_residues) == ("s1", "DDAAD", 5)
    p = g.plddt_summary(a).first()
    assert (p.mean_plddt, p.min_plddt, p.fraction_confident) == (80.0, 60.0, 0.8)
    text = st.pdb_lines(a, polymer_only=True).first().text
    assert len(st._pdb_rows(text)) == 11 and "HOH" not in text


def test_cif():
    head = "loop_\n" + "".join(f"_atom_site.{c}\n" for c in ("group_PDB", "type_symbol", "label_atom_id", "label_comp_id", "auth_asym_id", "auth_seq_id", "Cartn_x", "Cartn_y", "Cartn_z", "B_iso_or_equiv", "pdbx_PDB_model_num"))
    rows = st.atoms_of("x", "x.cif", (head + "ATOM C CA ALA A 7 1.0 2.0 3.0 50.0 1\nATOM C CA ALA A 7 1.0 2.0 3.0 50.0 2\n#\n").encode())
    assert len(rows) == 1 and rows[0][3:6] == (7, 0, "ALA")


def test_site(atoms):
    a = st.good_atoms(atoms)
    m = g.metal_point(a).first()
    assert (m.mx, m.my, m.n_coordinating_oxygens) == (pytest.approx(5 / 3), 0.0, 6)
    s = g.active_site(a).first()
    want = np.mean([np.hypot(x - 5 / 3, 1) for x in (0, 1, 4)])
    assert s.carboxylate_convergence_radius == pytest.approx(want) and s.metal_point_void == pytest.approx(1 / 3)
    i = g.ion_site_check(a).first()
    assert (i.n_ions_modelled, i.n_ions_in_site, i.well_placed) == (1, 1, True) and i.min_ion_to_cage_dist == pytest.approx(0.5)
    p = g.substrate_positioning(a).first()
    assert p.diphosphate_in_site and p.reactive_carbon_to_cage_dist == pytest.approx(np.hypot(1.5 - 5 / 3, 3))
    c = g.cyclisation(a).first()
    assert c.fold_back == pytest.approx(9.0)
    f = g.site_features(a).first()
    assert f.frac_acidic == pytest.approx(0.6) and f.frac_aa_A == pytest.approx(0.4)


def test_gyration_and_superposition(spark):
    x = np.random.default_rng(0).normal(size=(50, 3)) * [1, 2, 3]
    df = spark.createDataFrame([("s", *map(float, p)) for p in x], "struct_id string, x double, y double, z double")
    r = g.gyration(df).first()
    c = x - x.mean(0)
    lam = np.linalg.eigvalsh(c.T @ c / 50)
    assert r.radius_of_gyration == pytest.approx(np.sqrt(lam.sum())) and r.asphericity == pytest.approx(lam[2] - lam[:2].mean())


def test_pca(spark):
    x = np.random.default_rng(1).normal(size=(80, 4)) * [5, 1, 1, 1]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    out, share = g.pca_2d(df, "id", "v", standardise=False)
    got = np.array([[r.pc1, r.pc2] for r in out.orderBy("id").collect()])
    c = x - x.mean(0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    assert abs(abs(np.corrcoef(got[:, 0], u[:, 0])[0, 1]) - 1) < 1e-9 and share[0] == pytest.approx(s[0] ** 2 / (s**2).sum())
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert abs(abs(np.corrcoef(g.pcoa_2d(d)[0][:, 0], u[:, 0])[0, 1]) - 1) < 1e-6


def test_pae(spark, tmp_path):
    b = io.BytesIO()
    np.savez(b, pae=np.arange(9).reshape(3, 3), residue_ids=[5, 6, 9], ptm=0.8)
    (tmp_path / "x_pae.npz").write_bytes(b.getvalue())
    b = io.BytesIO()
    np.savez(b, pae=np.zeros((2, 3)), residue_ids=[1, 2])
    (tmp_path / "y_pae.npz").write_bytes(b.getvalue())
    p = st.read_pae(spark, str(tmp_path)).cache()
    assert {r.ID: r.error is None for r in p.collect()} == {"x": True, "y": False}
    long = {(r.i, r.j): r.value for r in st.pae_long(p).collect()}
    assert long[5, 9] == 2.0 and long[9, 5] == 6.0 and len(long) == 9
    assert st.summary_scores('{"ptm": [0.5, 0.7], "iptm": null}') == (pytest.approx(0.6), None)


def test_motifs(spark):
    df = spark.createDataFrame([("MADDAADKKNDLASKKKE",), ("MK",), (None,)], "sequence string")
    r = seq.motif_pair(df).collect()
    assert (r[0].ddxxd_motif, r[0].ddxxd_start, r[0].nse_dte_start) == ("DDAAD", 2, 9)
    assert r[1].ddxxd_motif == "" and r[1].ddxxd_start is None


def test_constructs():
    pre, suf = order.overhangs()
    assert pre == "actcgacaacCGTCTCatcGGTCTCaT" and suf == "ATCCtGAGACCtGAGACGgttgtggtgt"
    import random

    r = random.Random(0)
    for _ in range(25):
        p = "M" + "".join(r.choices("ACDEFGHIKLMNPQRSTVWY", k=60))
        out = order.prepare_one(p)
        assert out["status"] == "ok" and order.validate(out["construct"], p)[0] == []
        cds = out["construct"][len(pre) : -len(suf)].upper()
        assert not any(s in cds for s in ("GGTCTC", "GAGACC", "CGTCTC", "GAGACG")) and order.translate(cds) == p + "*"
    assert order.prepare_one("MXB")["status"] == "FAILED" and order.prepare_one("")["status"] == "FAILED"
    assert order.normalise(" akv* ") == ("MAKV", ["removed stop", "added M"])
    assert len(order.optimise("M" + "K" * 80)[1]) <= 1


def test_orders_table(spark):
    df = spark.createDataFrame([("a", "MKVLAAGG"), ("b", "M1"), ("c", None)], "ID string, sequence string")
    assert {r.ID: r.status for r in order.prepare_order(df).collect()} == {"a": "ok", "b": "FAILED", "c": "FAILED"}
