"""Locally consistent parsing against plain code, and the fingerprints of edited texts."""

import hashlib

import numpy as np

from made import DOCUMENTS, prose, rows_of
from winnow.llm import phrases as P
from winnow.llm import textscan as ts

MASK = 2**64 - 1


def mix(h):
    return int(ts.mix(np.array([h & MASK], np.uint64))[0])


def toss(x, left):
    d = x ^ left
    j = (d & -d).bit_length() - 1
    return 2 * j + (x >> j & 1)


def plain_level(names, bits):
    """One level by its definition: runs in pairs, the rest between local maxima of the tossed labels."""
    cut, i = [], 0
    while i < len(names):
        j = i
        while j + 1 < len(names) and names[j + 1] == names[i]:
            j += 1
        if j > i:  # a run
            k = i
            while k <= j:
                step = 3 if j - k + 1 == 3 else 2
                cut.append((k, min(k + step, j + 1)))
                k += step
            i = j + 1
            continue
        j = i  # up to the next run
        while j + 1 < len(names) and names[j + 1] != names[j] and not (j + 2 < len(names) and names[j + 2] == names[j + 1]):
            j += 1
        part = names[i : j + 1]
        label, width = part, bits
        for _ in range(P.ROUNDS):
            none = int(P._NONE) & (2**width - 1)
            label, width = [toss(x, label[k - 1] if k else none) for k, x in enumerate(label)], 8
        starts = [0] + [k for k in range(2, len(part) - 1) if label[k] > label[k - 1] and label[k] > label[k + 1]]
        cut += [(i + a, i + b) for a, b in zip(starts, starts[1:] + [len(part)], strict=True)]
        i = j + 1
    return [mix(sum(mix(names[k] + (k - a + 1) * int(P._STEP)) for k in range(a, b)) + b - a) for a, b in cut]


def plain_levels(text):
    names, out, bits = [ord(x) for x in text], [], 32
    while names and (not out or len(names) > 1):
        names, bits = plain_level(names, bits), 64
        out.append(names)
    return out


def plain_sketch(text):
    values = np.zeros(P.BUCKETS, np.int64)
    least = {}
    for level, names in enumerate(plain_levels(text), 1):
        at, n = (0, P.LOW_BUCKETS) if level == 1 else (P.LOW_BUCKETS, P.BUCKETS - P.LOW_BUCKETS)
        for x in names:
            h = mix(x ^ int(P._STEP))
            b = at + ((h >> 32) * n >> 32)
            least[b] = min(least.get(b, MASK), h)
    for b, h in least.items():
        values[b] = mix(h) % 65535 + 1
    return values


def plain_fingerprint(text):
    levels = plain_levels(text)
    return f"{levels[-1][0] if levels else 0:016x}" + "".join(f"{x:04x}" for x in plain_sketch(text))


def plain_like(a, b):
    a, b = plain_sketch(a), plain_sketch(b)
    used, both = ((a > 0) | (b > 0)).sum(), ((a == b) & (a > 0)).sum()
    return 2 * both / (used + both) if used else 1.0


def plain(docs):
    order = sorted(((d[0] is not None, d[0] or 0, d[1] or "") for d in docs))
    out = []
    for k, (has, i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        e = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        out.append((str(i if has else None), len(t), hashlib.sha256(e.encode()).hexdigest(), plain_fingerprint(t), plain_fingerprint(e), round(plain_like(t, e), 9), round(plain_like(t, after), 9)))
    return sorted(out)


def result(d):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in P.revised(d).collect())


def test_against_plain_code(spark, rng, odd_texts, monkeypatch):
    """In many ranges and in one: the ranges are made small so that their borders are met often."""
    texts = [t if t is None or len(t) < 5000 else t[:3000] for t in odd_texts]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)] + [prose(rng, rng.randint(3, 90)) for _ in range(60)]
    docs = rows_of(texts) + [(None, "without an id", "en", "a", 0), (2**60 + 1, "far away", "en", "a", 0)]
    rng.shuffle(docs)
    want = plain(docs)
    for chars in (200, 2000, 1 << 23):
        monkeypatch.setattr(P, "RANGE_CHARS", chars)
        assert result(spark.createDataFrame(docs, DOCUMENTS).repartition(3)) == want


def test_slices_do_not_matter(rng):
    ids, texts = list(range(40)), [prose(rng, rng.randint(1, 200)) for _ in range(40)]
    whole, last = P.compare(ids, texts)
    got, known = {}, None
    for a, b in ((0, 1), (1, 5), (5, 20), (20, 39)):
        part, known = P.compare(ids[a : b + 1], texts[a : b + 1], known)
        for k, v in part.items():
            got.setdefault(k, []).extend(v)
    assert {k: list(v) for k, v in whole.items()} == got and known["name"] == last["name"]


def test_equal_substrings_share_their_inner_phrases(rng):
    """At any offset, and beside anything: all but a few names at the ends of a common part are the same."""
    shared = prose(rng, 1500)
    a, b = prose(rng, 40) + shared + prose(rng, 30), "x" * 1001 + shared
    for level, (x, y) in enumerate(zip(plain_levels(a)[:5], plain_levels(b)[:5], strict=True)):
        alone = plain_levels(shared)[level]
        assert len(set(alone) - set(x)) <= 14 and len(set(alone) - set(y)) <= 14
    for row in (a, b, "ab" * 5000, "a" * 9999, "aab" * 3000):
        sizes = [len(row), *map(len, plain_levels(row))]
        assert sizes[-1] == 1 and all(n <= 2 / 3 * m + 2 for m, n in zip(sizes, sizes[1:], strict=False) if m > 2)


def test_likeness_follows_what_is_shared(spark, rng):
    texts = [prose(rng, rng.randint(150, 900)) for _ in range(200)]
    rows = P.revised(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()
    assert abs(np.mean([r.near_edited for r in rows]) - 0.75) < 0.04 and min(r.near_edited for r in rows) > 0.5
    assert max(r.near_next for r in rows) < 0.35
    same = P.revised(spark.createDataFrame(rows_of(["the same text", "the same text"]), DOCUMENTS)).collect()
    assert {r.near_next for r in same} == {1.0} and len({r.fingerprint for r in same}) == 1


def test_repeated_rows_empty_tables_and_clashing_names(spark, monkeypatch):
    assert P.revised(spark.createDataFrame([], DOCUMENTS)).collect() == []
    assert result(spark.createDataFrame(rows_of(["only one text"]), DOCUMENTS)) == plain(rows_of(["only one text"]))
    monkeypatch.setattr(P, "RANGE_CHARS", 100)  # a third of the rows alike, over several ranges
    docs = [(5, "alike in all", "en", "a", 0)] * 40 + [(5, "other text", "en", "a", 0), (None, None, None, None, None), (None, "", None, None, None)]
    docs += [(i, f"text {i}", "en", "a", 0) for i in range(20)]
    got = result(spark.createDataFrame([(*r, "h", 1) for r in docs], DOCUMENTS + ", TEXT string, place int"))
    assert len(got) == len(docs)
    assert sum(r[0] == "5" and r[-1] == 1.0 for r in got) >= 39  # alike rows follow one another
