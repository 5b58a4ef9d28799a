"""XXH64, fingerprints, thresholds, links and components against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from made import DOCUMENTS, prose, rows_of
from winnow.llm import simhash


def fingerprint(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius=3):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_xxh64_all_lengths():
    raw = np.frombuffer(random.Random(1).randbytes(400), np.uint8)
    start, size = np.arange(150), np.arange(150)
    got = simhash.xxh64(raw, start, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(raw[i : 2 * i].tobytes(), 42) for i in range(150)]


def test_fingerprints_and_components(spark, odd_texts, rng):
    base = prose(rng, 400)
    near = [" ".join(w if k != j else "changed" for k, w in enumerate(base.split())) for j in range(0, 400, 40)]
    texts = [*odd_texts, base, base.upper(), *near, *(prose(rng, rng.randint(1, 60)) for _ in range(150))]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    fps = {i: fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == components(fps)


@pytest.mark.parametrize(("radius", "heavy"), [(3, 10**9), (3, 12), (5, 10**9), (5, 10)])
def test_links_of_clustered_fingerprints(spark, radius, heavy):
    """Correlated bits and dense clusters, with and without divided keys."""
    r = random.Random(radius + heavy)
    fps = set()
    for _ in range(25):
        c = r.getrandbits(64) & 0x0000FFFFFFFFFFFF
        fps |= {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(25)}
    nodes = dict(enumerate(sorted(fps)))
    rows = [(i, int(np.uint64(f).view(np.int64))) for i, f in nodes.items()]
    reps = spark.createDataFrame(rows, "first long, fp long")
    edges = [(e.a, e.b) for e in simhash.links(reps, simhash.Near(radius), heavy).collect()]
    assert all((nodes[a] ^ nodes[b]).bit_count() <= 64 for a, b in edges)
    root = {i: i for i in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {i: find(i) for i in nodes} == components(nodes, radius)


def test_thresholds_add_up_and_cost_least():
    rng = np.random.default_rng(0)
    for m, tau in ((2, 3), (3, 3), (4, 3), (4, 6)):
        widths, budget = [64 // m] * m, tau - m + 1
        top = budget + 1
        est = [np.cumsum(rng.integers(0, 1000, (40, top + 2)), axis=1).astype(float) for _ in range(m)]
        for e in est:
            e[:, 0] = 0
        t = simhash.allocate(est, widths, budget, top)
        assert (t.sum(1) == budget).all()
        import math

        cost = lambda row, i, k: simhash.COST_SIGNATURE * sum(math.comb(widths[i], j) for j in range(k + 1)) + simhash.COST_CANDIDATE * est[i][row, k + 1]
        for row in range(5):
            best = min(sum(cost(row, i, k) for i, k in enumerate(ks)) for ks in itertools.product(range(-1, top + 1), repeat=m) if sum(ks) == budget)
            assert sum(cost(row, i, int(t[row, i])) for i in range(m)) == pytest.approx(best)


def test_chain_and_star_components(spark):
    edges = [(i + 1, i) for i in range(60)] + [(100 + i, 100) for i in range(1, 50)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}


def test_near_copies(spark, rng):
    base = [prose(rng, 300) for _ in range(20)]
    texts = [*base]
    for b in base:  # three words of three hundred differ
        w = b.split()
        for k in rng.sample(range(300), 3):
            w[k] = "edited"
        texts.append(" ".join(w))
    texts += [prose(rng, 300) for _ in range(60)]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    assert sum(got[20 + i] == i for i in range(20)) >= 19
    assert all(got[i] == i for i in range(40, 100))


def test_odd_tables(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCUMENTS)).collect() == []
    d = spark.createDataFrame([(None, "a b c", "en"), (1, "a b c", "fp"), (1, "a b c", "x")], "doc_id long, text string, fp string")
    got = simhash.near_duplicates(d).collect()
    assert len(got) == 3 and {r.component_id for r in got} == {1}


def test_alike_compares_whole_sets(spark, rng):
    base = prose(rng, 60)
    texts = [base, None, "", " \n", "one two", "ONE  two"]
    for n in (1, 2, 3, 4, 6, 9):  # edited words next to each other, so that similarities lie around the bound
        w = base.split()
        at = rng.randrange(len(w) - n)
        w[at : at + n] = ["edited"] * n
        texts.append(" ".join(w))
    pairs = list(itertools.combinations(range(len(texts)), 2))
    rows = rows_of(texts)
    docs = spark.createDataFrame([*rows, rows[0]], DOCUMENTS)  # a row twice
    got = {(r.a, r.b) for r in simhash.alike(docs, spark.createDataFrame([(b, a) for a, b in pairs], "a long, b long")).collect()}

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in texts]
    want = {(b, a) for a, b in pairs if len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b])}
    empty = {(b, a) for a, b in pairs if not sets[a] and not sets[b]}  # one class by their bits, whatever this says
    assert got - empty == want - empty
    assert len(want - empty) > 3 and len(want) < len(pairs)


def near_classes(texts):
    """By brute force: classes of the pairs within the default bits that share 0.8 of their shingles; and their bits' distances."""
    from winnow.llm import textscan as ts

    import pyarrow as pa

    bits = np.concatenate([simhash.sketch_chunk(c) for c in ts.chunks(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.large_string())}))])
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    far = []
    for a, b in itertools.combinations(range(len(texts)), 2):
        d = np.bitwise_count(bits[a] ^ bits[b]).astype(int)
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            far.append((int(d[0]), a, b))
            if d[0] <= 8 and d[1] <= simhash.LOOSE_WORD and d[1:].sum() <= 60:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(texts))}, far


def edited(r, words, n):
    w = list(words)
    for k in r.sample(range(len(w)), n):
        w[k] = f"edit{r.randrange(10**6)}"
    return w


def test_near_copies_of_seven_and_eight_bits(spark):
    r, texts = random.Random(3), []
    for _ in range(250):
        w = [f"w{r.randrange(3000)}" for _ in range(100)]
        texts += [" ".join(w), " ".join(edited(r, w, 2))]
    want, far = near_classes(texts)
    got = {x.doc_id: x.component_id for x in simhash.near_copies(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    assert sum(d in (7, 8) for d, _, _ in far) > 5
    assert got == want


def test_dense_groups_are_proved_on_shingles(spark):
    """Groups of near copies of each other, whose centres are alike in some 0.7."""
    r = random.Random(4)
    w = [f"w{r.randrange(3000)}" for _ in range(400)]
    texts = []
    for n in (0, 14, 15, 16):
        centre = edited(r, w, n)
        texts += [" ".join(edited(r, centre, 1)) for _ in range(30)]
    want, _ = near_classes(texts)
    assert 1 < len(set(want.values())) < len(texts) / 8
    got = {x.doc_id: x.component_id for x in simhash.near_copies(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    assert got == want


def test_large_groups_in_blocks(spark, monkeypatch):
    """One base with 1 to 12 edits: many classes in one dense group, dealt over blocks, some of them by their equal fingerprints."""
    monkeypatch.setattr(simhash, "BLOCK_NODES", 40)
    monkeypatch.setattr(simhash, "SAME", 3)
    r = random.Random(8)
    w = [f"w{r.randrange(3000)}" for _ in range(300)]
    texts = [" ".join(edited(r, w, r.randint(1, 12))) for _ in range(150)]
    texts += [" ".join([*w[:k], *w[k + 1 :]]) for k in range(0, 60, 5)] + [" ".join([*w, w[k]]) for k in range(12)]
    want, _ = near_classes(texts)
    got = {x.doc_id: x.component_id for x in simhash.near_copies(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    assert 20 < len(set(want.values())) < 140
    assert got == want
