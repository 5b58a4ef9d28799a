"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64 bits, each the majority over the XXH64 hashes of the text's
three-word shingles.  Two fingerprints are linked at ``radius`` or fewer
differing bits.

Search.  Equal fingerprints are one node, so copies cost nothing further.
Bits that vary together go into the same of m partitions.  For thresholds
t_1 .. t_m (each -1 or more) that add up to radius - m + 1, two linked
fingerprints differ in at most t_i bits in some partition i.  A dynamic
programme picks the thresholds of each fingerprint on its own: the sum of the
signatures it has to probe and of the candidates expected there, estimated from
the values that many fingerprints share and from the mean of the rest.  Every
fingerprint is filed under the exact value of each partition and probes the
values within its thresholds; what meets under a key is verified on all bits.

A key's rows are verified where they meet, and only the edges of a spanning
forest leave the task, so a dense group costs as many edges as it has members.
Keys that many fingerprints share are divided further by the other bits: those
fall into radius + 1 groups, of which a linked pair has one in common.
Components come from alternating star contractions, each written to the shared
folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import common, textscan as ts

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints under one partition value from which the value is divided by the other bits.
HEAVY = 20_000
#: At most so many values are that heavy: they hold HEAVY_SHARE of all fingerprints or more.
HEAVY_SHARE = 1e-5
COST_SIGNATURE, COST_CANDIDATE = 1.0, 0.025
#: Links a row under a key beyond which its pairs aren't listed: they get a spanning forest instead.
DENSE = 4
#: Of near_copies: shingle width, radius over the distinct words' fingerprint, and how many of the 256 checking bits may
#: differ in a pair whose shingles are compared after it.  At a similarity of 0.8 of five-word shingles 39 do on average,
#: with a standard deviation of 6.
SKETCH_SHINGLE, SKETCH_RADIUS, SKETCH_LOOSE = 5, 8, 60
CHECK = ["v0", "v1", "v2", "v3"]
#: Of the first 64 of these, which go along in the search: how many may differ.  At a similarity of 0.8 ten do on average,
#: with a standard deviation of 3, and 32 with one of 4 where texts have nothing in common.
LOOSE_WORD = 22
#: Bits of each number in the tag of a filed row, and the share that stands for none.
TAG, NO_SHARE = 4, 15
#: Nodes of one fingerprint from which one of them stands for all in the search; they are a group to be proved then.
SAME = 64
#: Nodes and shingles of a dense group that are compared in one task.
BLOCK_NODES, BLOCK_SHINGLES = 2048, 2_000_000

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
U = np.uint64


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of every data[start : start + length], by the published definition."""
    pad = np.concatenate([data, np.zeros(32, np.uint8)])
    lanes = np.ndarray(len(pad) - 7, "<u8", pad, strides=(1,))
    halves = np.ndarray(len(pad) - 3, "<u4", pad, strides=(1,))
    s = U(seed)
    with np.errstate(over="ignore"):
        h = np.full(len(start), s + _P5, np.uint64)
        at = start.astype(np.int64)
        left = length.astype(np.int64)
        big = np.flatnonzero(left >= 32)
        if len(big):
            v = [np.full(len(big), x, np.uint64) for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            stripes = left[big] // 32
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                p = at[big[on]] + 32 * k
                for i in range(4):
                    v[i][on] = _rotl(v[i][on] + lanes[p + 8 * i] * _P2, 31) * _P1
            acc = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for x in v:
                acc = (acc ^ (_rotl(x * _P2, 31) * _P1)) * _P1 + _P4
            h[big] = acc
            at[big] += 32 * stripes
            left[big] -= 32 * stripes
        h += length.astype(np.uint64)
        for k in range(3):
            on = np.flatnonzero(left >= 8 * (k + 1))
            if not len(on):
                break
            x = _rotl(lanes[at[on] + 8 * k] * _P2, 31) * _P1
            h[on] = _rotl(h[on] ^ x, 27) * _P1 + _P4
        at += left // 8 * 8
        left %= 8
        on = np.flatnonzero(left >= 4)
        h[on] = _rotl(h[on] ^ (halves[at[on]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[on] += 4
        left[on] -= 4
        for k in range(3):
            on = np.flatnonzero(left > k)
            h[on] = _rotl(h[on] ^ (pad[at[on] + k].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> U(33))) * _P2
        h = (h ^ (h >> U(29))) * _P3
        return h ^ (h >> U(32))


def majority(h: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Of each run h[border[i]:border[i + 1]]: the bits set in over half of it; none: 0."""
    n = np.diff(border)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n > 0)
    if not len(full):
        return out
    # eight counters of a byte share a word, so a block is of 255 hashes at most
    blocks = -(-n[full] // 255)
    first = np.concatenate([[0], np.cumsum(blocks)])
    within = np.arange(first[-1]) - np.repeat(first[:-1], blocks)
    starts = np.repeat(border[:-1][full], blocks) + 255 * within
    ones = U(0x0101010101010101)
    for k in range(8):
        sums = np.add.reduceat((h >> U(k)) & ones, starts).view(np.uint8).reshape(-1, 8)
        total = np.add.reduceat(sums.astype(np.int64), first[:-1], axis=0)
        over = 2 * total > n[full][:, None]
        for byte in range(8):
            out[full] |= over[:, byte].astype(np.uint64) << U(8 * byte + k)
    return out


def _shingles(wb: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of every shingle, repeats included, and the borders of
    the rows; a row of fewer words is one shingle, one without words none."""
    n_words = np.diff(wb)
    count = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    sb = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(wb[:-1], count) + np.arange(sb[-1]) - np.repeat(sb[:-1], count)
    return first, first + np.repeat(np.minimum(n_words, width), count) - 1, sb


def fingerprint_chunk(c: ts.Chunk) -> np.ndarray:
    """The contract's fingerprints: majority over XXH64 of the shingles' bytes."""
    start, end, wb = ts.words(c)
    if not len(start):
        return np.zeros(c.n, np.uint64)
    # words of the lower-cased text with one space between
    size = end - start
    to = np.concatenate([[0], np.cumsum(size + 1)])
    keep = np.zeros(int(to[-1]), bool)
    keep[to[1:] - 1] = True
    flat = np.full(int(to[-1]), 0x20, np.uint8)
    flat[~keep] = ts.LOWER[c.data[ts.NOT_SPACE[c.data]]]
    first, last, sb = _shingles(wb, SHINGLE)
    return majority(xxh64(flat, to[first], to[last] + size[last] - to[first]), sb)


def _shingle_hashes(wb: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every five-word shingle from its words' hashes, and the borders of the rows."""
    first, last, sb = _shingles(wb, SKETCH_SHINGLE)
    k = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SKETCH_SHINGLE):
            k = np.where(first + i <= last, ts.mix(k + h[np.minimum(first + i, len(h) - 1)]), k)
    return k, sb


def _distinct(h: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, sorted, and the borders of the rows."""
    row = ts.row_of(border)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.zeros(0, bool)
    return h[new], np.searchsorted(row[new], np.arange(len(border)))


def sketch_chunk(c: ts.Chunk) -> np.ndarray:
    """Five words of bits a row: the majority over the distinct words, which near
    copies hardly change, and 256 bits over the five-word shingles, from which
    their similarity is told."""
    c = ts.Chunk(c.first, c.n, ts.LOWER[c.data], c.border)
    start, end, wb = ts.words(c)
    out = np.zeros((c.n, 5), np.uint64)
    if not len(start):
        return out
    h = ts.range_hashes(c.data, start, end)
    out[:, 0] = majority(*_distinct(h, wb))
    k, sb = _shingle_hashes(wb, h)
    with np.errstate(over="ignore"):
        for i in range(4):
            out[:, i + 1] = majority(ts.mix(k + U((i + 1) * 0xD1B54A32D192ED03 % (1 << 64))), sb)
    return out


def _fingerprints(sketch: bool):
    names = ["fp", *CHECK] if sketch else ["fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [sketch_chunk(c) if sketch else fingerprint_chunk(c)[:, None] for c in ts.chunks(b)]
            if got:
                bits = np.concatenate(got).view(np.int64)
                yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), **{x: pa.array(bits[:, i].copy()) for i, x in enumerate(names)}})

    return run


def fingerprints(docs: DataFrame, sketch: bool = False) -> DataFrame:
    """doc_id and the fingerprint (as a signed long) of every whole text; null counts as empty.
    With sketch, that of sketch_chunk and its checking bits."""
    d = common.pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    return d.mapInArrow(_fingerprints(sketch), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, fp long" + "".join(f", {x} long" for x in CHECK) * sketch)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for c in ts.chunks(b):
            low = ts.Chunk(c.first, c.n, ts.LOWER[c.data], c.border)
            start, end, wb = ts.words(low)
            h = ts.range_hashes(low.data, start, end) if len(start) else np.zeros(0, np.uint64)
            values, border = _distinct(*_shingle_hashes(wb, h)) if len(start) else (h, np.zeros(c.n + 1, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(border.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").slice(c.first, c.n), "h": lists})


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and h, the distinct shingles, of the documents whose doc_id is among _id."""
    d = common.pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.join(ids, d.doc_id == ids._id, "left_semi").mapInArrow(_sets, "doc_id long, h array<long>").dropDuplicates()


def alike(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of doc_ids whose texts share 0.8 or more of their distinct five-word shingles.

    Only texts that are in a pair are hashed; their sets are stored once and joined to both sides.
    """
    sets = common.kept(_sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct()), "sets")
    one, other = (sets.select(F.col("doc_id").alias(x), F.col("h").alias(f"h{x}")) for x in "ab")
    same = F.size(F.array_intersect("ha", "hb"))
    # same / (size a + size b - same) >= 4 / 5
    return pairs.join(one, "a").join(other, "b").where(9 * same >= 4 * (F.size("ha") + F.size("hb"))).select("a", "b").distinct()


# ---------------------------------------------------------------- partitions


def _co_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros((65, 65), np.int64)
    for pdf in batches:
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        for part in np.array_split(fp, max(1, len(fp) // 65_536)):
            x = ((part[:, None] >> np.arange(64, dtype=np.uint64)) & U(1)).astype(np.float32)
            x = np.hstack([x, np.ones((len(x), 1), np.float32)])
            total += np.rint(x.T @ x).astype(np.int64)
    i, j = np.triu_indices(65)
    yield pd.DataFrame({"i": i.astype(np.int32), "j": j.astype(np.int32), "n": total[i, j]})


def bit_groups(co: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m groups: each grows by the bit that varies most with those in it."""
    n = max(co[64, 64], 1)
    p = co[:64, 64] / n
    var = np.maximum(p * (1 - p), 1e-12)
    r = np.abs(co[:64, :64] / n - np.outer(p, p)) / np.sqrt(np.outer(var, var))
    np.fill_diagonal(r, 0)
    left, out = set(range(64)), []
    for k in range(m):
        width = 64 // m + (k < 64 % m)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (r[b, rest].sum(), -b))]
        left.discard(group[0])
        while len(group) < width:
            b = max(sorted(left), key=lambda b: (r[b, group].sum(), -b))
            group.append(b)
            left.discard(b)
        out.append(sorted(group))
    return out


def gather(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """Those bits of each fingerprint as one number."""
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> U(b)) & U(1)) << U(k)
    return out


def flips(width: int, t: int) -> np.ndarray:
    """Masks of exactly t bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), t)], np.uint64)


def collision(co: np.ndarray, bits: list[int]) -> float:
    """The chance that two fingerprints agree in all these bits, were the bits independent."""
    p = co[bits, 64] / max(co[64, 64], 1)
    return float(np.prod(p**2 + (1 - p) ** 2))


def choose_m(co: np.ndarray, radius: int) -> int:
    """The number of partitions at which signatures and expected candidates cost least."""
    n = co[64, 64]

    def cost(m: int) -> float:
        groups = bit_groups(co, m)
        t, spare = [0] * m, radius - m + 1
        for k in range(spare):
            t[k % m] += 1
        probes = [sum(math.comb(len(g), x) for x in range(y + 1)) for g, y in zip(groups, t, strict=True)]
        return sum(COST_SIGNATURE * q + COST_CANDIDATE * q * n * collision(co, g) for q, g in zip(probes, groups, strict=True)) + m

    return min(range(2, radius + 2), key=cost)


def allocate(estimate: list[np.ndarray], widths: list[int], budget: int, top: int) -> np.ndarray:
    """Thresholds (rows by partitions) that add up to ``budget`` at the least cost.

    estimate[i][:, t + 1]: candidates expected in partition i at threshold t
    (t = -1: none).  The programme runs over the partitions for all rows at once.
    """
    n, m = len(estimate[0]), len(widths)
    low = -m  # sums on the way lie between -m and budget + m
    span = budget + 2 * m + 1
    best = np.full((n, span), np.inf)
    best[:, -low] = 0
    choice = np.zeros((m, n, span), np.int8)
    for i in range(m):
        new = np.full((n, span), np.inf)
        for t in range(-1, top + 1):
            sig = sum(math.comb(widths[i], k) for k in range(t + 1))
            c = COST_SIGNATURE * sig + COST_CANDIDATE * estimate[i][:, t + 1]
            moved = np.full((n, span), np.inf)
            if t < 0:
                moved[:, :-1] = best[:, 1:]
            else:
                moved[:, t:] = best[:, : span - t]
            moved += c[:, None]
            less = moved < new
            new = np.where(less, moved, new)
            choice[i][less] = t
        best = new
    out = np.zeros((n, m), np.int8)
    at = np.full(n, budget - low)
    for i in reversed(range(m)):
        out[:, i] = choice[i][np.arange(n), at]
        at = at - out[:, i]
    return out


def shares(group: list[int], radius: int) -> list[list[int]]:
    """The bits outside a group in radius + 1 shares, one of which two linked fingerprints agree in."""
    others = sorted(set(range(64)) - set(group))
    return [others[j :: radius + 1] for j in range(radius + 1)]


def mask(bits: list[int]) -> np.uint64:
    return U(sum(1 << b for b in bits))


class Probe:
    """Keys under which a fingerprint is filed and looked for."""

    def __init__(self, groups: list[list[int]], radius: int, light: list[float], heavy: dict[int, dict[int, int]]) -> None:
        self.groups, self.radius, self.light = groups, radius, light
        self.values = [np.array(sorted(heavy.get(i, {})), np.int64).view(np.uint64) for i in range(len(groups))]
        self.counts = [np.array([heavy[i][v] for v in sorted(heavy.get(i, {}))], float) for i in range(len(groups))]

    def _heavy(self, i: int, v: np.ndarray) -> np.ndarray:
        """Fingerprints under heavy value v of partition i; 0 where it isn't heavy."""
        if not len(self.values[i]):
            return np.zeros(len(v))
        at = np.minimum(np.searchsorted(self.values[i], v), len(self.values[i]) - 1)
        return np.where(self.values[i][at] == v, self.counts[i][at], 0.0)

    def keys(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, number of the fingerprint, tag) rows.

        A tag holds where the key comes from: in four bits each the partition, the share of the other bits by which a
        heavy value is divided (15: none), whether the key is the fingerprint's own value, and its thresholds plus one.
        """
        m = len(self.groups)
        budget = self.radius - m + 1
        top = max(0, budget + 1)
        parts = [gather(fp, g) for g in self.groups]
        est = []
        for i, v in enumerate(parts):
            e = np.zeros((len(fp), top + 2))
            for t in range(top + 1):
                sig = sum(math.comb(len(self.groups[i]), k) for k in range(t + 1))
                near = self._heavy(i, v) if t == 0 else e[:, 1] - self.light[i]
                if t == 1:
                    for x in flips(len(self.groups[i]), 1) if len(self.values[i]) else ():
                        near = near + self._heavy(i, v ^ x)
                e[:, t + 1] = sig * self.light[i] + near
            est.append(e)
        t = allocate(est, [len(g) for g in self.groups], budget, top)
        held = sum(((t[:, i].astype(np.uint64) + U(1)) << U(TAG * (i + 3)) for i in range(m)), np.zeros(len(fp), np.uint64))
        keys, rows, tags = [], [], []

        def add(key: np.ndarray, who: np.ndarray, i: int, j: int, exact: bool) -> None:
            keys.append(key)
            rows.append(who)
            tags.append(held[who] | U(i | j << TAG | exact << 2 * TAG))

        def file(i: int, value: np.ndarray, who: np.ndarray, exact: bool) -> None:
            hot = self._heavy(i, value) > 0
            base = ts.mix(value + U((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            add(base[~hot], who[~hot], i, NO_SHARE, exact)
            if hot.any():
                for j, bits in enumerate(shares(self.groups[i], self.radius)):
                    sub = gather(fp[who[hot]], bits)
                    add(ts.mix(base[hot] + ts.mix(sub + U(j + 101))), who[hot], i, j, exact)

        everyone = np.arange(len(fp))
        for i, v in enumerate(parts):
            file(i, v, everyone, True)
            for s in range(1, top + 1):
                on = np.flatnonzero(t[:, i] >= s)
                if len(on):
                    for x in flips(len(self.groups[i]), s):
                        file(i, v[on] ^ x, on, False)
        return np.concatenate(keys), np.concatenate(rows), np.concatenate(tags)


# ---------------------------------------------------------------- verification


class Near:
    """Whether two nodes are linked: their bits (rows of 64-bit words, the fingerprint
    first) differ in ``radius`` bits of the first and, if given, ``loose`` of the others
    at most.  With ``loose``, the texts decide afterwards."""

    def __init__(self, radius: int, loose: int | None = None) -> None:
        self.radius, self.loose = radius, loose

    def pairs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Element by element; the leading dimensions broadcast."""
        ok = np.bitwise_count(x[..., 0] ^ y[..., 0]) <= self.radius
        if self.loose is not None and ok.any():
            ok &= sum(np.bitwise_count(x[..., i] ^ y[..., i]).astype(np.int16) for i in range(1, x.shape[-1])) <= self.loose
        return ok


class Linked:
    """Rows of fingerprints, their first checking words and the tags of their keys: which of them are linked.
    One that stands for many nodes has the checking word of one of them only, so it is not asked for that.
    Two that both only probe the key aren't: one of them probes the other's own value too."""

    def __init__(self, groups: list[list[int]], radius: int, fp: np.ndarray, tag: np.ndarray, word: np.ndarray, many: np.ndarray) -> None:
        self.groups, self.radius = groups, radius
        self.fp, self.tag, self.word, self.many = fp, tag, word, many
        self.own = (tag >> U(2 * TAG)) & U(1) > 0

    def __len__(self) -> int:
        return len(self.fp)

    def part(self, at: np.ndarray) -> Linked:
        return Linked(self.groups, self.radius, self.fp[at], self.tag[at], self.word[at], self.many[at])

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether rows i and j are, element by element; the shapes broadcast."""
        ok = np.bitwise_count(self.fp[i] ^ self.fp[j]) <= self.radius
        at = np.nonzero(ok)
        if len(at[0]):
            x, y = (z[at] for z in np.broadcast_arrays(i, j))
            ok[at] = (self.own[x] | self.own[y]) & ((np.bitwise_count(self.word[x] ^ self.word[y]) <= LOOSE_WORD) | self.many[x] | self.many[y])
        return ok

    def first(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of linked rows i and j of one key: whether no key before it has both of them, in the order of the
        partitions, of the shares of a heavy value, and last of which of the two owns the key."""
        differ = self.fp[i] ^ self.fp[j]
        here = (self.tag[i] & U(15)).astype(np.int64)
        share = ((self.tag[i] >> U(TAG)) & U(15)).astype(np.int64)
        ok = np.ones(len(i), bool)
        for g, bits in enumerate(self.groups):
            apart = np.bitwise_count(differ & mask(bits)).astype(np.int64)
            reach = [np.maximum(((self.tag[x] >> U(TAG * (g + 3))) & U(15)).astype(np.int64) - 1, 0) for x in (i, j)]
            ok &= (here <= g) | (apart > np.maximum(*reach))
            # under the value of one alone: that of the lesser, unless only the other's is probed
            at = here == g
            least = self.fp[i] < self.fp[j]
            twice = (apart > 0) & (apart <= np.minimum(*reach))
            ok &= ~at | ~twice | np.where(least, self.own[i], self.own[j])
            if (at & (share != NO_SHARE)).any():
                for k, some in enumerate(shares(bits, self.radius)):
                    ok &= ~at | (share == NO_SHARE) | (share <= k) | (differ & mask(some) != 0)
        return ok


def forest(linked: Linked) -> tuple[np.ndarray, np.ndarray]:
    """Edges (pairs of row numbers) of a spanning forest of the links among these rows.

    Breadth first: each reached row meets only those not reached yet, so a group
    in which most are linked takes little more than one look each.
    """
    left, a, b = np.arange(len(linked)), [], []
    while len(left):
        root, left = left[:1], left[1:]
        front = root
        while len(front) and len(left):
            head, front = front[:16], front[16:]
            hit = np.zeros(len(left), bool)
            for lo in range(0, len(left), 65_536):
                some = left[lo : lo + 65_536]
                hit[lo : lo + len(some)] = linked(head[:, None], some[None]).any(0)
            if hit.any():
                new = left[hit]
                a.append(new)
                b.append(np.broadcast_to(root, len(new)))
                front = np.concatenate([front, new])
                left = left[~hit]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def _edges_of(key: np.ndarray, linked: Linked) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (row numbers) of every run of equal keys that join what its links join,
    and whether they are of a spanning forest instead of being links themselves.

    Runs are compared side by side, all at once: the rows whose own value the key is,
    few among those that probe it, come first in theirs, and the d-th of each meets
    all after it.  A run that turns out to have more than DENSE links a row leaves this and
    gets a spanning forest.  The others give each link under the first of its keys only.
    """
    order = np.lexsort((~linked.own, key))
    key, linked = key[order], linked.part(order)
    border = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    size = np.diff(border)
    run = np.repeat(np.arange(len(size)), size)
    own = np.bincount(run[linked.own], minlength=len(size))
    a, b, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    listed = (size > 1) & (own > 0)
    found = np.zeros(len(size), np.int64)
    live = np.flatnonzero(listed[run])
    for d in range(int(own.max(initial=0))):
        live = live[(listed & (own > d))[run[live]]]
        head = border[run[live]] + d
        live, head = live[live > head], head[live > head]
        if not len(live):
            break
        hit = linked(head, live)
        if hit.any():
            i, j = head[hit], live[hit]
            found += np.bincount(run[i], minlength=len(size))
            one = linked.first(i, j)
            a.append(i[one])
            b.append(j[one])
            of.append(run[i[one]])
            listed &= found <= DENSE * size
    x, y, r = np.concatenate(a), np.concatenate(b), np.concatenate(of)
    a, b = [x[listed[r]]], [y[listed[r]]]
    n = len(a[0])
    for k in np.flatnonzero(found > DENSE * size):
        # in the order of the fingerprints, so that a group has the same edges under most of its keys
        at = border[k] + np.argsort(linked.fp[border[k] : border[k + 1]], kind="stable")
        x, y = forest(linked.part(at))
        a.append(at[x])
        b.append(at[y])
    x, y = np.concatenate(a), np.concatenate(b)
    return order[x], order[y], np.arange(len(x)) >= n


def _proved(near: Near):
    """Of some nodes, each in a class already: edges that join those classes which
    a pair near by its bits that shares 0.8 or more of its distinct shingles joins."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        node = pdf["node"].to_numpy(np.int64)
        _, cls = np.unique(pdf["cls"].to_numpy(np.int64), return_inverse=True)
        order = np.argsort(cls, kind="stable")
        members = np.split(order, np.flatnonzero(np.diff(cls[order])) + 1)
        bits = np.stack([pdf[x].to_numpy(np.int64) for x in ("fp", *CHECK)], axis=1).view(np.uint64)
        size = pdf["h"].map(len).to_numpy(np.int64)
        values, code = np.unique(np.concatenate([np.asarray(h, np.int64) for h in pdf["h"]]), return_inverse=True)
        start = np.concatenate([[0], np.cumsum(size)])
        mark = np.zeros(len(values), bool)
        waits, a, b = np.ones(len(node), bool), [], []
        for first in range(len(members)):
            front = [] if not waits[members[first][0]] else members[first].tolist()
            waits[members[first]] = False
            while front:
                head = front.pop()
                near_by = np.flatnonzero(waits)
                near_by = near_by[near.pairs(bits[head][None], bits[near_by])]
                own = code[start[head] : start[head + 1]]
                mark[own] = True
                for lo in range(0, len(near_by), 4096):
                    at = near_by[lo : lo + 4096]
                    n = size[at]
                    to = np.concatenate([[0], np.cumsum(n)])
                    flat = code[np.repeat(start[at] - to[:-1], n) + np.arange(to[-1])]
                    same = np.diff(np.concatenate([[0], np.cumsum(mark[flat])])[to])
                    new = at[9 * same >= 4 * (size[head] + n)]
                    a += node[new].tolist()
                    b += [node[head]] * len(new)
                    for c in np.unique(cls[new]):
                        if waits[members[c][0]]:
                            waits[members[c]] = False
                            front += members[c].tolist()
                mark[own] = False
        e = pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
        return pd.DataFrame({"a": e.max(axis=1), "b": e.min(axis=1)})

    return run


def _emit(probe: Probe, names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 8192):
                part = pdf.iloc[lo : lo + 8192]
                key, who, tag = probe.keys(part["fp"].to_numpy(np.int64).view(np.uint64))
                yield pd.DataFrame({"key": key.view(np.int64), **{x: part[x].to_numpy()[who] for x in names}, "tag": tag.view(np.int64)})

    return run


def _verify(groups: list[list[int]], radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by key; the last key of a batch waits for the next one."""
        held: list[pd.DataFrame] = []

        def out(pdf: pd.DataFrame) -> pd.DataFrame:
            many = pdf["many"].to_numpy(bool)
            linked = Linked(groups, radius, *[pdf[x].to_numpy(np.int64).view(np.uint64) for x in ("fp", "tag", "word")], many)
            i, j, dense = _edges_of(pdf["key"].to_numpy(), linked)
            x, y = pdf["first"].to_numpy()[i], pdf["first"].to_numpy()[j]
            dense |= many[i] | many[j]
            e = pd.DataFrame({"a": np.maximum(x, y), "b": np.minimum(x, y), "dense": dense})
            return e[e["a"] != e["b"]].drop_duplicates()

        for pdf in batches:
            if not len(pdf):
                continue
            held.append(pdf)
            last = pdf["key"].iloc[-1]
            if held[0]["key"].iloc[0] == last:
                continue  # one key so far
            both = pd.concat(held, ignore_index=True)
            cut = int(both["key"].searchsorted(last))
            yield out(both.iloc[:cut])
            held = [both.iloc[cut:]]
        if held:
            yield out(pd.concat(held, ignore_index=True))

    return run


def links(reps: DataFrame, near: Near, heavy_from: int = HEAVY) -> DataFrame:
    """(a, b, dense): edges between nodes, named by column first, whose components are those of all
    pairs within near.radius.  Those that are not dense are such pairs; dense ones only span a group of them.

    reps has one row per node: first and fp, with near.loose also the checking bits, of which the first word goes
    along, so that no more pairs leave a task than may be alike, and the others stay behind, to save disk.
    Of SAME or more nodes with one fingerprint only the least is searched for, and it and its links are dense.
    """
    spark = reps.sparkSession
    names = ["first", "fp", "word", "many"]
    reps = reps.select("first", "fp", (F.lit(0).cast("long") if near.loose is None else F.col(CHECK[0])).alias("word")).where("first IS NOT NULL")
    same = None
    if near.loose is not None:  # else fingerprints differ
        one = common.kept(reps.groupBy("fp").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= SAME), "same")
        hub = one.select(F.col("fp").alias("_fp"), F.col("first").alias("hub"))
        found = reps.join(hub, F.col("fp") == F.col("_fp"), "left")
        same = found.where("first <> hub").select(F.col("first").alias("a"), F.col("hub").alias("b"), F.lit(True).alias("dense"))
        reps = found.where("hub IS NULL OR first = hub").select("first", "fp", "word", F.col("hub").isNotNull().alias("many"))
    else:
        reps = reps.withColumn("many", F.lit(False))
    co = np.zeros((65, 65), np.int64)
    for r in reps.select("fp").mapInPandas(_co_counts, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():  # 2145 numbers
        co[r.i, r.j] = co[r.j, r.i] = r.n
    n = int(co[64, 64])
    if n < 2:
        return spark.createDataFrame([], "a long, b long, dense boolean")
    groups = bit_groups(co, choose_m(co, near.radius))
    least = max(heavy_from, int(n * HEAVY_SHARE))

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            for i, g in enumerate(groups):
                yield pd.DataFrame({"i": np.int32(i), "v": gather(fp, g).view(np.int64)})

    heavy: dict[int, dict[int, int]] = {}
    if n > least:  # else no value can be
        values = reps.select("fp").mapInPandas(parts, "i int, v long").groupBy("i", "v").count()
        for r in values.where(F.col("count") >= least).collect():  # len(groups) / HEAVY_SHARE values at most
            heavy.setdefault(r.i, {})[r.v] = r["count"]
    probe = Probe(groups, near.radius, [n * collision(co, g) for g in groups], heavy)
    keyed = reps.mapInPandas(_emit(probe, names), "key long, first long, fp long, word long, many boolean, tag long")
    found = keyed.repartition("key").sortWithinPartitions("key").mapInPandas(_verify(groups, near.radius), "a long, b long, dense boolean")
    return (found if same is None else found.union(same)).distinct()


# ---------------------------------------------------------------- components


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): every node of the edges with the least node of its component.

    Alternates the large-star and small-star contractions until nothing moves.
    """
    e = common.kept(edges.select("a", "b").where("a <> b").distinct(), "edges")
    for _ in range(most_rounds):
        before = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        # large star: every larger neighbour moves to the least of the neighbourhood
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a node and its smaller neighbours move to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        new = common.kept(small, "edges")
        after = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        common.dropped(e)
        e = new
        if tuple(before) == tuple(after):
            break
    else:
        raise RuntimeError(f"components are not settled after {most_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b"), F.col("b"))).distinct()


def _in_groups(docs: DataFrame, reps: DataFrame, member: DataFrame, near: Near) -> DataFrame:
    """(a, b): edges that join what the proved links within each dense group (node, root) join.

    A group of any size is dealt in blocks of bounded nodes and shingles.  Blocks are proved each by itself; then
    one node of every class found, in blocks again; and where a group still has several classes,
    every two of its blocks meet, so that no link between classes is lost.
    """
    sets = _sets_of(docs, member.select(F.col("node").alias("_id")))
    rows = member.join(reps, member["node"] == reps["first"]).join(sets, member["node"] == sets["doc_id"]).select("root", "node", "fp", *CHECK, "h")
    rows = common.kept(rows, "groups")

    def dealt(some: DataFrame) -> DataFrame:
        """With the block of each node among those of its group, and their number."""
        n = some.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum(F.size("h")) / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        return some.join(n, "root").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))

    def proved(some: DataFrame, *by: str) -> DataFrame:
        return some.select(*by, "node", "cls", "fp", *CHECK, "h").groupBy(*by).applyInPandas(_proved(near), "a long, b long")

    def classed(some: DataFrame, edges: DataFrame) -> DataFrame:
        c = components(edges).select(F.col("node").alias("_node"), F.col("root").alias("_cls"))
        return some.join(c, F.col("node") == F.col("_node"), "left").withColumn("cls", F.coalesce("_cls", "node")).drop("_node", "_cls")

    edges = common.kept(proved(dealt(rows).withColumn("cls", F.col("node")), "root", "block"), "proved")
    large = dealt(rows).where("blocks > 1")
    if not large.limit(1).count():
        return edges
    hubs = classed(large, edges).where("node = cls").drop("blocks", "block")
    edges = common.kept(edges.union(proved(dealt(hubs), "root", "block")), "proved")
    nodes = common.kept(classed(large, edges), "classed")
    several = nodes.groupBy("root").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x < y").select(F.col("root").alias("_root"))
    each = nodes.join(several, F.col("root") == F.col("_root"), "left_semi").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other <> block")
    each = each.select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return edges.union(proved(each, "root", "low", "high"))


def _compared(docs: DataFrame, reps: DataFrame, edges: DataFrame, near: Near) -> DataFrame:
    """(a, b): edges that join what those pairs of links() join whose checking bits are near
    and whose shingles are alike.

    The nodes of dense groups, and no others, are proved in blocks with their sets; all
    other pairs are joined to the bits of both sides and then to their sets.
    """
    member = common.kept(components(edges.where("dense")), "dense")
    of = [member.select(F.col("node").alias(x), F.col("root").alias(f"root{x}")) for x in "ab"]
    bits = [reps.select(F.col("first").alias(x), *[F.col(v).alias(f"{v}{x}") for v in CHECK]) for x in "ab"]
    differ = sum((F.bit_count(F.col(f"{v}a").bitwiseXOR(F.col(f"{v}b"))) for v in CHECK), F.lit(0))
    pairs = edges.where("NOT dense").select("a", "b").join(of[0], "a", "left").join(of[1], "b", "left").where("NOT coalesce(roota = rootb, false)")
    pairs = common.kept(pairs.join(bits[0], "a").join(bits[1], "b").where(differ <= near.loose).select("a", "b").distinct(), "pairs")
    return alike(docs, pairs).union(_in_groups(docs, reps, member, near))


def _classes(docs: DataFrame, fps: DataFrame, near: Near, heavy_from: int) -> DataFrame:
    """fps with component_id: the least doc_id reachable over links and equal bits."""
    names = ["fp", *(CHECK if near.loose is not None else [])]
    fps = common.kept(fps, "fps")
    reps = common.kept(fps.groupBy(*names).agg(F.min("doc_id").cast("long").alias("first")), "reps")
    edges = links(reps, near, heavy_from)
    if near.loose is not None:
        edges = _compared(docs, reps, common.kept(edges, "links"), near)
    member = components(edges)
    label = reps.join(member, reps["first"] == member["node"], "left").select(*[F.col(x).alias(f"_{x}") for x in names], F.coalesce("root", "first").alias("component_id"))
    on = [F.col(x) == F.col(f"_{x}") for x in names]
    return fps.join(label, on).drop(*[f"_{x}" for x in names])


def near_duplicates(docs: DataFrame, radius: int = RADIUS, heavy_from: int = HEAVY) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id: the least doc_id reachable over links.

    A null or empty text, or one of white space, has fingerprint zero and is
    linked like any other.  Repeated rows have equal fingerprints and share a
    component.  Rows without doc_id take part in none but their own
    fingerprint's.  An empty table gives no rows.  Only doc_id and text are read.
    """
    out = _classes(docs, fingerprints(docs), Near(radius), heavy_from)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_copies(docs: DataFrame, radius: int = SKETCH_RADIUS, loose: int = SKETCH_LOOSE, heavy_from: int = HEAVY) -> DataFrame:
    """doc_id and component_id, links being pairs alike in 0.8 of their five-word shingles.

    Candidates come from the SimHash of the distinct words within ``radius``
    bits by the same search.  Those of which ``loose`` or fewer of 256 SimHash bits
    over the five-word shingles differ are compared shingle by shingle, also in
    groups so dense that their pairs are not listed (DENSE), whatever their size.  Texts without words
    are one class.  Else as near_duplicates().
    """
    return _classes(docs, fingerprints(docs, sketch=True), Near(radius, loose), heavy_from).select("doc_id", "component_id")
