"""The model against a plain dictionary form, shards, verdicts, odd inputs."""

import math
from collections import Counter, defaultdict

import pytest

from made import DOCUMENTS, prose, rows_of
from winnow.llm import perplexity as P

LABELS = "doc_id long, quality int"


def plain_model(texts, trusted):
    """Interpolated modified Kneser-Ney over characters, by the book."""
    pad = "\x01" * (P.ORDER - 1)
    seqs = [pad + " ".join(t.split()) if t.split() else "" for t in texts]
    grams = [[s[i : i + P.ORDER] for i in range(len(s) - P.ORDER + 1)] for s in seqs]
    c = {P.ORDER: Counter()}
    for g, ok in zip(grams, trusted, strict=True):
        for x in g:
            c[P.ORDER][x] += ok
    for k in range(P.ORDER - 1, 0, -1):
        c[k] = Counter()
        for x, n in c[k + 1].items():
            c[k][x[1:]] += n > 0

    def discounts(t):
        n = [sum(v == k for v in t.values()) for k in range(1, 5)]
        if not n[0] or not n[1]:
            return [0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2 for k in (1, 2, 3)]
        return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw, strict=True)]

    d = {k: discounts(c[k]) for k in c}
    disc = lambda k, n: 0.0 if n == 0 else d[k][min(n, 3) - 1]
    total, spare = defaultdict(float), defaultdict(float)
    for k in c:
        for x, n in c[k].items():
            total[k, x[:-1]] += n
            spare[k, x[:-1]] += disc(k, n)

    def p(x):
        k = len(x)
        if k == 1:
            t, r = total[1, ""] or 1.0, spare[1, ""] if total[1, ""] else 1.0
            return (c[1][x] - disc(1, c[1][x])) / t + r / t / (len(c[1]) + 1)
        low = p(x[1:])
        t = total[k, x[:-1]]
        return low if not t else (c[k][x] - disc(k, c[k][x])) / t + spare[k, x[:-1]] / t * low

    return [math.exp(-sum(math.log(p(x)) for x in g) / len(g)) if g else None for g in grams]


def test_matches_the_plain_form_and_any_number_of_shards(spark, rng):
    texts = [prose(rng, rng.randint(5, 40)) for _ in range(30)] + ["", "  \n ", "Zz!! Qq### 9"]
    trusted = [i % 2 == 0 and i < 30 for i in range(len(texts))]
    docs = spark.createDataFrame(rows_of(texts), DOCUMENTS)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(trusted)], LABELS)
    want = plain_model(texts, trusted)
    for shard in (10**6, 97):
        got = {r.doc_id: r for r in P.classify(docs, labels, shard_grams=shard).collect()}
        for i, w in enumerate(want):
            assert (got[i].perplexity is None and w is None) or got[i].perplexity == pytest.approx(w, rel=1e-5)
        assert not got[30].kept and not got[31].kept


def test_junk_is_rejected_and_clean_kept(spark, rng):
    clean = [prose(rng, 150) for _ in range(120)]
    junk = [prose(rng, 150).upper().replace(" ", "%% ") for _ in range(12)]
    docs = spark.createDataFrame(rows_of([*clean, *junk]), DOCUMENTS)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 120, 2)], LABELS)
    got = {r.doc_id: r.kept for r in P.classify(docs, labels).collect()}
    assert all(got[i] for i in range(120)) and not any(got[i] for i in range(120, 132))


def test_odd_tables(spark, odd_texts):
    none = spark.createDataFrame([], LABELS)
    assert P.classify(spark.createDataFrame([], DOCUMENTS), none).collect() == []
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(odd_texts)], DOCUMENTS)
    got = P.classify(docs, none).collect()  # no trusted text at all
    assert len(got) == len(odd_texts)
    bad = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (4, None)], LABELS)
    assert P.with_trust(docs, bad).filter("trusted").count() == 0
