"""The filter audit against plain code that walks through every order."""

from itertools import permutations

import numpy as np
import pytest

from made import DOCUMENTS, prose, rows_of
from winnow.llm import audit


def plain(docs, labels):
    """Every row of the result by going through each part's documents once for each order and step."""
    import re

    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    judged = []
    for doc_id, text, lang, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= x <= "Z" for x in text) > 3 * len(text),
            "D": any(x in "#$%&*|" for x in text),
            "E": doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in docs),
        }
        judged.append((doc_id, lang or "", fails))
    out = {}
    for part in {j[1] for j in judged}:
        own = [j for j in judged if j[1] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [j for j in left if j[2][f]]
                stay = [j for j in left if not j[2][f]]
                total[f] += len(gone)
                redundant = sum(j[2][f] for j in own) - len(gone)
                alone = sum(j[2][f] and sum(j[2].values()) == 1 for j in own)
                out[part, "".join(order), step] = [len(stay), len(gone), redundant, alone, sum(j[0] in good for j in gone), sum(j[0] in toxic for j in gone)]
                left = stay
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def result(spark, docs, labels):
    d = spark.createDataFrame(docs, DOCUMENTS)
    a = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): [r[c] for c in cols] for r in audit.audit(d, a).collect()}


def test_every_order_against_plain_code(spark, rng, odd_texts):
    texts = odd_texts + [prose(rng, rng.choice([20, 150, 250, 400])) + rng.choice(["", " #", " ABCDEFGHIJ" * 8, " a b" * 200]) for _ in range(60)]
    texts += texts[20:40] + [texts[25]] * 6
    docs = [(i, t, rng.choice(["en", "de", None]), "a", 0) for i, t in enumerate(texts)]
    docs += [(None, texts[25], "en", "a", 0), (None, None, None, None, None), (3, texts[30], "en", "a", 0), docs[40], docs[40]]
    rng.shuffle(docs)
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 80, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (5, None, 1), (9999, 1, 1)]
    assert result(spark, docs, labels) == plain(docs, labels)


def test_empty_tables_and_clashing_names(spark, rng):
    assert result(spark, [], []) == {}
    docs = rows_of([prose(rng, 250), "x", "x"])
    assert result(spark, docs, []) == plain(docs, [])
    d = spark.createDataFrame([(*r, "other", "bits", "sha") for r in docs], DOCUMENTS + ", TEXT string, part string, subset string")
    a = spark.createDataFrame([(0, 1, 0, 9)], "doc_id long, quality int, toxic int, good int")
    got = {(r.part, r.filter_order, r.step): r.kept for r in audit.audit(d, a).collect()}
    assert got == {k: v[0] for k, v in plain(docs, [(0, 1, 0)]).items()}


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_blocks_of_the_index_do_not_matter(spark, monkeypatch, block):
    """The same counts however many documents a bitset holds; every part has bitsets of its own."""
    rng = np.random.default_rng(block)
    bits = rng.integers(0, 128, 500)
    parts = rng.choice(["a", "b", "c", ""], 500)
    monkeypatch.setattr(audit, "BLOCK_ROWS", block)
    rows = spark.createDataFrame([(str(p), int(b)) for p, b in zip(parts, bits, strict=True)], "part string, bits smallint").repartition(3)
    for r in audit.subset_counts(audit.index(rows)).collect():
        own = bits[parts == r.part]
        alive = own[own & r.subset == 0]
        gone = alive[(alive >> r.filter & 1) == 1]
        assert (r.kept, r.removed, r.lost_0, r.lost_1) == (len(alive) - len(gone), len(gone), (gone >> 5 & 1).sum(), (gone >> 6 & 1).sum())
