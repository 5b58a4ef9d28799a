"""Batched alignment, the bound from q-grams and the search, against plain code."""

import random

import numpy as np
import pytest

from winnow.operators import alignment as al
from winnow.operators import sequence_search as ss
from winnow.operators.similarity import align

AMINO = "ACDEFGHIKLMNPQRSTVWY"


def every_alignment(a, b, s):
    """The best (score, equal letters, positive columns, fewest columns) over all alignments, one by one."""
    best = None

    def go(i, j, last, score, same, good, columns):
        nonlocal best
        if i == len(a) and j == len(b):
            best = max(best or (-(10**9),), (score, same, good, -columns))
            return
        if i < len(a) and j < len(b):
            v = s.of(a[i], b[j])
            go(i + 1, j + 1, "", score + v, same + (a[i] == b[j]), good + (v > 0), columns + 1)
        if i < len(a):
            go(i + 1, j, "a", score + (s.extend if last == "a" else s.opening), same, good, columns + 1)
        if j < len(b):
            go(i, j + 1, "b", score + (s.extend if last == "b" else s.opening), same, good, columns + 1)

    go(0, 0, "", 0, 0, 0, 0)
    return best


@pytest.mark.parametrize("scores", [al.Scores(), al.Scores(-3, -1, 2, -1), al.Scores(-1, -1, 1, -1), al.Scores(-4, -2, matrix={("A", "A"): 5, ("B", "B"): 4, ("A", "B"): 1, ("C", "C"): 6, ("A", "C"): -3, ("B", "C"): -2})])
def test_against_every_alignment(scores):
    r = random.Random(5)
    pairs = [("".join(r.choices("AB", k=r.randint(0, 5))), "".join(r.choices("ABC", k=r.randint(0, 5)))) for _ in range(120)]
    got = al.align_pairs([x for x, _ in pairs], [y for _, y in pairs], scores)
    for k, (x, y) in enumerate(pairs):
        assert (got["score"][k], got["matches"][k], got["positives"][k], -got["columns"][k]) == every_alignment(x, y, scores), (x, y)


def test_scores_of_long_pairs_and_either_order(monkeypatch):
    r = random.Random(6)
    pairs = [("".join(r.choices("ACDE", k=r.choice([0, 1, 30, 200, 700]))), "".join(r.choices("ACDEé東", k=r.randint(0, 200)))) for _ in range(40)]
    first, second = map(list, zip(*pairs, strict=True))
    got = al.align_pairs(first, second)
    assert [align(x, y)[0] for x, y in pairs] == got["score"].tolist()
    for width in (1, 1000):  # one pair at a time, and a few
        monkeypatch.setattr(al, "WIDTH", width)
        assert all((v == got[k]).all() for k, v in al.align_pairs(first, second).items())
    assert all((v == got[k]).all() for k, v in al.align_pairs(second, first).items())
    with pytest.raises(ValueError, match="letters"):
        al.align_pairs(["A" * 40_000], ["A"])


def relatives(r, base, n, most):
    out = []
    for _ in range(n):
        s = list(base)
        for _ in range(r.randrange(most)):
            at = r.randrange(len(s))
            s[at : at + 1] = r.choice([[], [r.choice(AMINO)], [s[at], r.choice(AMINO)]])
            s = s or ["A"]
        out.append("".join(s))
    return out


@pytest.mark.parametrize("q", [1, 2, 3])
def test_the_bound_holds(q):
    r = random.Random(q)
    seqs = [s for n in (1, 2, 5, 12, 40, 90) for s in relatives(r, "".join(r.choices("ACD" if n % 2 else AMINO, k=n)), 8, n)]
    seqs += ["A" * 30, "A" * 29, "AC" * 15, "CA" * 15]
    shared = al.shared_grams(seqs * 2, len(seqs), q)
    i, j = np.nonzero(np.ones(shared.shape, bool))
    same, _ = al.identities([seqs[x] for x in i], [seqs[x] for x in j])
    n = np.array([len(s) for s in seqs])
    assert (same <= al.identity_bound(n[i], n[j], shared[i, j], q) + 1e-12).all()
    assert (ss._shared_each([seqs[x] for x in i], [seqs[x] for x in j], q) == shared[i, j]).all()
    for want in (0.5, 0.75, 0.9):
        need = np.array([al.least_shared(int(x), want, q) for x in n])
        good = same >= want
        assert (shared[i, j][good] >= np.maximum(need[i], need[j])[good]).all()


def brute(seqs, queries, k, apart=True):
    out = {}
    for a in queries:
        if not seqs[a]:
            continue
        row = [(-round(float(al.identities([seqs[a]], [s])[0][0]), 12), b) for b, s in seqs.items() if s and (a != b or not apart)]
        out[a] = [(b, -v) for v, b in sorted(row)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.neighbour_id, round(r.identity, 12)))
    return out


def made(r):
    seqs = {f"f{f}_{k}": s for f in range(7) for k, s in enumerate(relatives(r, "".join(r.choices(AMINO, k=r.choice([8, 30, 60, 61]))), 9, 14))}
    seqs |= {"twin": seqs["f0_0"], "a_twin": seqs["f0_0"], "one": "A", "two": "AC", "aa": "A" * 40, "aaa": "A" * 44, "aaaa": "A" * 37 + "CC", "none": ""}
    return seqs


def test_search_in_blocks_against_all_pairs(spark, monkeypatch):
    """Several blocks, ties, twins, and a side that is not all of the other."""
    r = random.Random(8)
    seqs = made(r)
    monkeypatch.setattr(ss, "MOST_ROWS", 20)
    monkeypatch.setattr(ss, "LEAST_ROWS", 8)
    monkeypatch.setattr(ss, "AT_A_TIME", 50)
    df = spark.createDataFrame([*seqs.items(), ("null", None), (None, "ACD"), ("one", "A")], "id string, sequence string")
    assert found(ss.most_identical(df, df, 3, self_mode=True)) == brute(seqs, seqs, 3)
    some = [x for x in seqs if x.startswith("f1") or x in ("twin", "two")]
    part = df.where(df.id.isin(some))
    assert found(ss.most_identical(part, df, 2, self_mode=True)) == brute(seqs, some, 2)
    assert found(ss.most_identical(part, df, 1)) == brute(seqs, some, 1, apart=False)
    assert ss.most_identical(part, df.limit(0), 1).collect() == []


def test_the_index_loses_no_pair(spark):
    r = random.Random(9)
    seqs = made(r)
    df = spark.createDataFrame(list(seqs.items()), "id string, sequence string")
    full = {a: row for a, row in brute(seqs, seqs, 10**6).items()}
    for want in (0.75, 0.9):
        pairs = {(x.query_id, x.neighbour_id): round(x.identity, 12) for x in ss.identical_pairs(df, df, want, apart=True).collect()}
        assert pairs == {(a, b): v for a, row in full.items() for b, v in row if v >= want}
        top = {a: [x for x in row if x[1] >= want][:2] for a, row in full.items()}
        assert found(ss.most_identical(df, df, 2, self_mode=True, min_identity=want)) == {a: row for a, row in top.items() if row}
    with pytest.raises(ValueError, match="no bound"):
        ss.identical_pairs(df, df, 0.5)


def test_summary_has_a_row_for_every_query(spark):
    df = spark.createDataFrame([("a", "ACDEF"), ("b", "ACDEY"), ("c", None)], "id string, sequence string")
    got = {r.ID: (r.max_identity, r.identity_hit, r.similarity_hit) for r in ss.summary(ss.most_identical(df, df, 1, self_mode=True), df).collect()}
    assert got == {"a": (80.0, "b", "b"), "b": (80.0, "a", "a"), "c": (None, None, None)}
