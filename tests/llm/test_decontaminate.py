"""Verbatim and altered passages are found, clean text is not; blocks don't matter."""

import numpy as np
import pytest

from made import DOCUMENTS, prose, rows_of
from winnow.llm import decontaminate as D

ITEMS = "item_id long, text string"


def brute_best(same, least):
    best = None
    for s in np.flatnonzero(same):
        for e in np.flatnonzero(same):
            n = e + 1 - s
            if n >= least and same[s : e + 1].sum() >= D.IDENTITY * n - 1e-9 and (best is None or n > best):
                best = n
    return best


def test_best_run_is_the_longest(rng):
    for _ in range(300):
        same = np.array([rng.random() < 0.75 for _ in range(rng.randint(1, 40))])
        got = D.best_run(same, 13)
        assert (got[1] if got else None) == brute_best(same, 13)
        if got:
            s, n, k = got
            assert same[s] and same[s + n - 1] and same[s : s + n].sum() == k


def test_passages(spark, rng, odd_texts):
    items = [prose(rng, 40) for _ in range(30)] + ["four words only here"]
    docs = []
    for t in items[:30]:  # whole passage inside other text, other case and marks
        docs.append(f"{prose(rng, 80)} {t.upper().replace(' ', ', ')} {prose(rng, 50)}")
    for t in items[:30]:  # every ninth word replaced
        docs.append(f"{prose(rng, 60)} {' '.join('other' if k % 9 == 4 else w for k, w in enumerate(t.split()))}")
    docs.append("so: Four words, only here!")
    clean = [prose(rng, 300) for _ in range(100)]
    table = spark.createDataFrame(rows_of([*docs, *clean, *odd_texts]), DOCUMENTS)
    bench = spark.createDataFrame([*enumerate(items), (98, None), (99, "")], ITEMS)
    got = {(r.doc_id, r.item_id): r for r in D.overlaps(table, bench).collect()}
    assert set(got) == {(i, i) for i in range(30)} | {(30 + i, i) for i in range(30)} | {(60, 30)}
    assert all(got[i, i].n_words == got[i, i].n_equal == 40 and got[i, i].first_word == 80 for i in range(30))


def test_blocks(spark, rng, monkeypatch):
    items = [prose(rng, 30) for _ in range(12)]
    table = spark.createDataFrame(rows_of([f"{t} {prose(rng, 20)}" for t in items]), DOCUMENTS)
    bench = spark.createDataFrame(list(enumerate(items)), ITEMS)
    whole = sorted(map(tuple, D.overlaps(table, bench).collect()))
    monkeypatch.setattr(D, "BLOCK_ITEMS", 5)
    assert sorted(map(tuple, D.overlaps(table, bench).collect())) == whole and len(whole) == 12


@pytest.mark.parametrize("which", ["docs", "bench"])
def test_empty_tables(spark, which):
    docs = spark.createDataFrame([] if which == "docs" else [(1, "a b", "", "", 0)], DOCUMENTS)
    bench = spark.createDataFrame([] if which == "bench" else [(1, "a b c d")], ITEMS)
    assert D.overlaps(docs, bench).collect() == []


def test_every_accepted_pattern_has_a_seed():
    import itertools

    for n in range(5, 22):
        masks = [[k for k, x in enumerate(m) if x == "1"] for m in (*D.MASKS, *(D.SHORT_MASKS if n < D.MIN_OVERLAP else ()))]
        for out in itertools.combinations(range(1, n - 1), n // 5):
            assert any(all(at + k < n and at + k not in out for k in m) for m in masks for at in range(n - 3)), (n, out)


def test_short_altered_passages_and_text_ends(spark, rng):
    """Passages of 13 to 20 words with up to a fifth replaced, within, at the ends and cut off."""
    items, docs, want = [], [], set()
    for n in range(5, 21):
        for bad in range(n // 5 + 1):
            for side in range(3):
                item = [f"i{len(items)}n{k}" for k in range(n)]
                got = list(item)
                for k in rng.sample(range(1, n - 1), bad):
                    got[k] = "other"
                docs.append(" ".join([*(prose(rng, 30).split() if side != 1 else []), *got, *(prose(rng, 30).split() if side != 2 else [])]))
                want.add((len(docs) - 1, len(items)))
                items.append(" ".join(item))
    long = [f"long{k}" for k in range(40)]
    items.append(" ".join(long))
    for part in (long[:13], long[-13:], long[10:23]):  # 13 words of a longer item at the end of a text, at its start, and as all of it
        docs += [prose(rng, 20) + " " + " ".join(part), " ".join(part) + " " + prose(rng, 20), " ".join(part)]
        want |= {(len(docs) - k, len(items) - 1) for k in (1, 2, 3)}
    docs.append(" ".join(long[:12]))
    table, bench = spark.createDataFrame(rows_of(docs), DOCUMENTS), spark.createDataFrame(list(enumerate(items)), ITEMS)
    assert {(r.doc_id, r.item_id) for r in D.overlaps(table, bench).collect()} == want
