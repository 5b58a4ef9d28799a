"""Base counts against a plain reading, the verdicts on planted outliers, odd inputs."""

import re
from collections import Counter

import numpy as np

from made import DOCUMENTS, prose, rows_of
from winnow.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(t):
    w = WORD.findall(t or "")
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(win)
    cov = {i + k for i, x in enumerate(win) if c[x] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cov)


def run(spark, rows):
    return {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, DOCUMENTS)).collect()}


def test_base_counts(spark, odd_texts, rng):
    texts = [*odd_texts, *("".join(rng.choices("ab \n\t#|é", k=rng.randint(0, 200))) for _ in range(200))]
    got = run(spark, rows_of(texts))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(t), repr((t or "")[:60])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_clean_stay(spark, rng):
    clean = [prose(rng, rng.randint(60, 400)) for _ in range(300)]
    junk = [" ".join(w + "###" for w in prose(rng, 120).split()) for _ in range(25)] + [prose(rng, 150).upper().replace(" ", "!! ") for _ in range(25)]
    got = run(spark, rows_of([*clean, *junk]))
    assert sum(got[i].kept for i in range(300)) >= 297
    assert not any(got[i].kept for i in range(300, 350))


def test_majority_of_copies_does_not_break_the_estimate(spark, rng):
    one = prose(rng, 200)
    clean = [prose(rng, rng.randint(60, 400)) for _ in range(200)]
    got = run(spark, rows_of([one] * 110 + clean))
    assert np.mean([r.kept for r in got.values()]) > 0.97


def plain_mcd(x):
    """Concentration by sorting, from the same kinds of starts, until nothing moves: squared distances of all rows."""
    half = quality.FLOOR**2
    median, mean = np.median(x, 0), x.mean(0)
    wide = np.diag(np.maximum((np.quantile(x, 0.75, 0) - np.quantile(x, 0.25, 0)) / 1.349, quality.FLOOR) ** 2)
    cov = np.cov(x.T, bias=True) + np.diag(half)
    best = None
    for m, c in ((median, wide), (mean, cov), (median, (wide + cov) / 2)):
        for _ in range(40):
            d = np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)
            near = x[np.argsort(d, kind="stable")[: int(np.ceil(quality.SUPPORT * len(x)))]]
            m, c = near.mean(0), np.cov(near.T, bias=True) + np.diag(half)
        if best is None or np.linalg.det(c) < best[0]:
            best = np.linalg.det(c), m, c
    d = np.einsum("ni,ij,nj->n", x - best[1], np.linalg.inv(best[2]), x - best[1])
    return d / max(1.0, np.median(d) / quality.chi2_median(quality.P))


def test_estimate_and_verdicts_against_plain_mcd(spark, rng):
    """Two groups with a third of junk of different kinds; one too small, which takes its language's estimate."""
    rows, n = [], 0
    for lang, source, many in (("en", "a", 240), ("en", "b", 200), ("en", "c", 20), ("de", None, 150)):
        for _ in range(many):
            t = prose(rng, rng.randint(60, 300))
            kind = rng.random()
            if kind < 0.15:
                t = " ".join(w + rng.choice(["", "##"]) for w in t.split())
            elif kind < 0.3:
                t = "\n".join([t[:200]] * 2 + [t])
            elif kind < 0.4:
                t = t.title()
            rows.append((n, t, lang, source, 0))
            n += 1
    df = spark.createDataFrame(rows, DOCUMENTS)
    got = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    x = quality.statistics(df).select("doc_id", "lang", "source", *[c.alias(k) for k, c in quality._feature_columns().items()]).toPandas().sort_values("doc_id")
    body = x[[not got[i].base_failed for i in x.doc_id]]
    want = {}
    for keys, g in (((("en", "a"),), None), ((("en", "b"),), None), ((("de", None),), None), ((("en", "c"),), body[body.lang == "en"])):
        (lang, source), = keys
        own = body[(body.lang == lang) & (body.source.isna() if source is None else body.source == source)]
        base = own if g is None else g
        want |= {i: d for i, d in zip(base.doc_id, plain_mcd(base[list(quality.FEATURES)].to_numpy()), strict=True) if i in set(own.doc_id)}
    cut = quality.chi2_cutoff()
    near = sum(got[i].kept == (d <= cut) for i, d in want.items())
    assert near >= 0.99 * len(want) and 0.1 < np.mean([d > cut for d in want.values()]) < 0.6
    ratio = np.array([(got[i].distance + 1) / (d + 1) for i, d in want.items()])
    assert np.mean(np.abs(np.log(ratio)) < 0.2) > 0.9


def test_cutoff_is_the_quantile():
    assert abs(quality.chi2_cutoff(7, 40) - 16.0128) < 1e-3 and abs(quality.chi2_cutoff(1, 20) - 3.8415) < 1e-3


def test_long_clean_text_large_and_null_ids(spark, rng):
    rows = [(i + (1 << 60), prose(rng, rng.randint(60, 300)), "en", "a", 0) for i in range(100)]
    rows += [(None, rows[0][1], "en", "a", 0), ((1 << 60) + 500, prose(rng, 20_000), "en", "a", 0)]
    out = quality.quality_rules(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert {r.doc_id for r in out} == {r[0] for r in rows} and all(r.kept for r in out)


def test_odd_tables(spark):
    assert run(spark, []) == {}
    r = run(spark, [(1, prose(__import__("random").Random(1), 80), None, None, 0)])
    assert r[1].kept
    extra = spark.createDataFrame([(1, "w " * 60, "en", "s", 5, 1, "x")], DOCUMENTS + ", n_words int, kept string")
    out = quality.quality_rules(extra).collect()
    assert out[0].n_words == 60 and out[0].base_failed
    clash = spark.createDataFrame([(1, "w " * 60, "en", "s", 5, 1)], "doc_id long, text string, lang string, source string, TEXT int, Lang int")
    assert quality.quality_rules(clash).first().n_words == 60


def test_models_sent_or_joined_give_the_same(spark, rng, monkeypatch):
    rows = [(i, prose(rng, rng.randint(30, 200)) + rng.choice(["", " ### $$$", " A B C D"]), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), 0) for i in range(400)]
    d = spark.createDataFrame(rows, DOCUMENTS)
    got = []
    for most in (10_000, 0):
        monkeypatch.setattr(quality, "MAX_BROADCAST_GROUPS", most)
        got.append(sorted((r.doc_id, None if r.distance is None else round(r.distance, 6), r.kept) for r in quality.quality_rules(d).collect()))
    assert got[0] == got[1]
