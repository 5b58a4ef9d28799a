"""Global alignments with affine gaps, many at a time, and a bound on identity from shared q-grams.

Pairs of like length are laid side by side and their tables filled along
anti-diagonals, on which no cell depends on another.  A cell holds one 64-bit
integer: the score above, and below it what the best path has counted, so that
one maximum picks the path and carries its counts, and no table is kept for a
trace.  Of paths with the best score, the one with the most equal letters counts,
then with the most positive ones, then the shortest; that choice doesn't depend
on which of the two comes first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

#: Bits of each count below the score; so sequences may have 2**BITS - 1 letters.
BITS = 15
MOST_LETTERS = (1 << BITS) - 1
#: Cells on one anti-diagonal of a batch, about: its arrays stay in a core's cache.
WIDTH = 1 << 16
_NONE = np.int64(-(1 << 60))


@dataclass(frozen=True)
class Scores:
    """Gap scores, and those of two letters: a matrix by pairs, or match and mismatch for all."""

    opening: int = -11
    extend: int = -1
    match: int = 4
    mismatch: int = -2
    matrix: dict | None = field(default=None, hash=False)

    def of(self, x: str, y: str) -> int:
        if self.matrix:
            return self.matrix.get((x, y), self.matrix.get((y, x), self.mismatch))
        return self.match if x == y else self.mismatch


def _coded(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Letters as small numbers, one after another; the letters; the lengths."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    letters, codes = np.unique(points, return_inverse=True)
    return codes.astype(np.int64), [chr(x) for x in letters], np.array([len(t) for t in texts], np.int64)


def _table(letters: list[str], s: Scores) -> np.ndarray:
    """What a step along both sequences adds, for every two letters; the last row and column are padding."""
    k = len(letters) + 1
    out = np.zeros((k, k), np.int64)
    for i, x in enumerate(letters):
        for j, y in enumerate(letters):
            v = s.of(x, y)
            out[i, j] = (v << 3 * BITS) + (int(x == y) << 2 * BITS) + (int(v > 0) << BITS) + 1
    return out


def _batch(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, table: np.ndarray, s: Scores, steps: np.ndarray | None = None) -> np.ndarray:
    """The packed result of each pair: columns a[: n[p], p] and b[: m[p], p] of letter numbers.

    steps[d, i, p], if given, gets where the cell (i, d - i) of a pair comes from: 0 along both, 1 from above, 2 from the left, and
    4 and 8 where a gap that ends here, from above or the left, begins here too.  Arrays are (letter, pair), so that a stretch of an anti-diagonal is one run of memory; they are used in turn.
    """
    (high, pairs), wide = a.shape, len(b)
    flat, first = table.ravel(), a * len(table)
    back = np.ascontiguousarray(b[::-1])  # so that the letters met on an anti-diagonal lie in a row
    opening, extend = np.int64(s.opening) << np.int64(3 * BITS), np.int64(s.extend) << np.int64(3 * BITS)
    make = lambda: np.full((high + 1, pairs), _NONE)
    before, best, new, up, new_up, left, new_left, spare = (make() for _ in range(8))
    best[0] = 0
    place = np.empty((high + 1, pairs), np.int64)
    out = np.zeros(pairs, np.int64)
    ends = n + m
    for d in range(1, int(ends.max(initial=0)) + 1):
        lo, hi = max(0, d - wide), min(high, d)  # cells (i, d - i)
        x, y = max(lo, 1), min(hi, d - 1)
        # a gap in the second: from the cell above
        np.add(best[x - 1 : hi], opening, out=new_up[x : hi + 1])
        np.add(up[x - 1 : hi], extend, out=spare[x : hi + 1])
        np.maximum(new_up[x : hi + 1], spare[x : hi + 1], out=new_up[x : hi + 1])
        # a gap in the first: from the cell to the left
        np.add(best[lo : y + 1], opening, out=new_left[lo : y + 1])
        np.add(left[lo : y + 1], extend, out=spare[lo : y + 1])
        np.maximum(new_left[lo : y + 1], spare[lo : y + 1], out=new_left[lo : y + 1])
        if lo == 0:
            new_up[0] = _NONE
        if hi == d:
            new_left[d] = _NONE
        np.maximum(new_up[lo : hi + 1], new_left[lo : hi + 1], out=new[lo : hi + 1])
        if steps is not None:
            steps[d, lo : hi + 1] = np.where(new_up[lo : hi + 1] >= new_left[lo : hi + 1], 1, 2)
            steps[d, x : hi + 1] += 4 * (new_up[x : hi + 1] == best[x - 1 : hi] + opening).astype(np.uint8)
            steps[d, lo : y + 1] += 8 * (new_left[lo : y + 1] == best[lo : y + 1] + opening).astype(np.uint8)
        if x <= y:
            np.add(first[x - 1 : y], back[x + wide - d : y + wide - d + 1], out=place[x : y + 1])
            np.take(flat, place[x : y + 1], out=spare[x : y + 1], mode="clip")
            np.add(before[x - 1 : y], spare[x : y + 1], out=spare[x : y + 1])
            if steps is not None:
                steps[d, x : y + 1] &= np.where(spare[x : y + 1] >= new[x : y + 1], 12, 15).astype(np.uint8)
            np.maximum(new[x : y + 1], spare[x : y + 1], out=new[x : y + 1])
        before, best, new = best, new, before
        up, new_up, left, new_left = new_up, up, new_left, left
        done = np.flatnonzero(ends == d)
        if len(done):
            out[done] = best[n[done], done]
    return out


def align_pairs(first: list[str], second: list[str], scores: Scores = Scores()) -> dict[str, np.ndarray]:  # noqa: B008
    """score, matches, positives and columns of each pair first[i], second[i]."""
    count = len(first)
    codes, letters, size = _coded([*first, *second])
    if size.max(initial=0) > MOST_LETTERS:
        raise ValueError(f"a sequence of more than {MOST_LETTERS} letters")
    at = np.cumsum(size) - size
    n, m = size[:count], size[count:]
    table = _table(letters, scores)
    packed = np.zeros(count, np.int64)
    order = np.lexsort((m, n // 24))
    done = 0
    while done < count:
        # as many pairs as fit the width; sorted, so that little is padded
        take = max(1, WIDTH // (int(n[order[done]]) + 24))
        rows = order[done : done + take]
        high, wide = int(n[rows].max()), int(m[rows].max())
        pad = len(letters)
        a, b = np.full((high, len(rows)), pad), np.full((wide, len(rows)), pad)
        for k, r in enumerate(rows):
            a[: n[r], k] = codes[at[r] : at[r] + n[r]]
            b[: m[r], k] = codes[at[count + r] : at[count + r] + m[r]]
        packed[rows] = _batch(a, n[rows], b, m[rows], table, scores)
        done += len(rows)
    low = (1 << BITS) - 1
    both = packed & low
    return {"score": packed >> 3 * BITS, "matches": packed >> 2 * BITS & low, "positives": packed >> BITS & low, "columns": n + m - both}


def align_places(first: list[str], second: list[str], scores: Scores = Scores(), cells: int = 1 << 26) -> list[tuple[np.ndarray, np.ndarray]]:  # noqa: B008
    """Of each pair the places, in either sequence, of the letters that stand in one column; cells: bytes for the way back, about."""
    count = len(first)
    codes, letters, size = _coded([*first, *second])
    at, table = np.cumsum(size) - size, _table(letters, scores)
    n, m = size[:count], size[count:]
    order, done, out = np.lexsort((m, n)), 0, [None] * count
    while done < count:
        biggest = (n[order[done:]] + m[order[done:]] + 1) * (n[order[done:]] + 1)
        take = max(1, int(np.searchsorted(np.maximum.accumulate(biggest) * np.arange(1, len(biggest) + 1), cells, "right")))
        rows = order[done : done + take]
        done += len(rows)
        high, wide, pad = int(n[rows].max()), int(m[rows].max()), len(letters)
        a, b = np.full((high, len(rows)), pad), np.full((wide, len(rows)), pad)
        for k, r in enumerate(rows):
            a[: n[r], k] = codes[at[r] : at[r] + n[r]]
            b[: m[r], k] = codes[at[count + r] : at[count + r] + m[r]]
        steps = np.zeros((high + wide + 1, high + 1, len(rows)), np.uint8)
        _batch(a, n[rows], b, m[rows], table, scores, steps)
        # all pairs walk back together; state 1 and 2: within a gap
        i, j, state, p = n[rows].copy(), m[rows].copy(), np.zeros(len(rows), np.uint8), np.arange(len(rows))
        seen = []
        while (walking := (i > 0) | (j > 0)).any():
            step = steps[i + j, i, p]
            state = np.where(state == 0, step & 3, state)
            both, up = walking & (state == 0), walking & (state == 1)
            left = walking & (state == 2)
            seen.append((p[both], i[both] - 1, j[both] - 1))
            i, j = i - (both | up), j - (both | left)
            state = np.where(up & (step & 4 > 0) | left & (step & 8 > 0), 0, state).astype(np.uint8)
        pair, x, y = (np.concatenate([v[k] for v in seen] or [np.zeros(0, np.int64)])[::-1] for k in range(3))
        by = np.argsort(pair, kind="stable")
        cut = np.searchsorted(pair[by], np.arange(len(rows) + 1))
        for k, r in enumerate(rows):
            out[r] = (x[by][cut[k] : cut[k + 1]], y[by][cut[k] : cut[k + 1]])
    return out


def identities(first: list[str], second: list[str], scores: Scores = Scores()) -> tuple[np.ndarray, np.ndarray]:  # noqa: B008
    """Identity and similarity of each pair: equal and positive columns by all columns; 0 where both are empty."""
    r = align_pairs(first, second, scores)
    columns = np.maximum(r["columns"], 1)
    return r["matches"] / columns, r["positives"] / columns


# ---------------------------------------------------------------- the bound


def identity_bound(n: np.ndarray, m: np.ndarray, shared: np.ndarray, q: int) -> np.ndarray:
    """No alignment of sequences of n and m letters that share so many q-grams (as multisets) has a greater identity.

    A column that isn't a match breaks at most q q-grams of the longer one, so there are e >= (max - q + 1 - shared) / q such
    columns, and no fewer than the lengths differ by; the matches are min(n, m) at most, and (n + m - e) / 2.
    """
    long, short = np.maximum(n, m), np.minimum(n, m)
    e = np.maximum(np.ceil((long - q + 1 - shared) / q), np.maximum(long - short, 0))
    matches = np.maximum(np.minimum(short, np.floor((n + m - e) / 2)), 0)
    return matches / np.maximum(matches + e, 1)


def least_shared(n: int, identity: float, q: int) -> int:
    """The fewest q-grams that a sequence of n letters shares with any other that it could be so identical to; 0 or less: none need be shared."""
    least = n
    for m in range(int(np.floor(n * identity)), int(np.ceil(n / max(identity, 1e-9))) + 1):
        long, short = max(n, m), min(n, m)
        # the most columns that aren't matches: e grows as long as the bound stays at the identity
        e = 0
        lo, hi = 0, long
        while lo <= hi:
            mid = (lo + hi) // 2
            top = min(short, (n + m - mid) // 2)
            if top >= 0 and top + 1e-9 >= identity * (top + mid):
                e, lo = mid, mid + 1
            else:
                hi = mid - 1
        least = min(least, long - q + 1 - q * e)
    return least


def gram_counts(texts: list[str], q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: text number, gram number and count, for each gram of each text; grams numbered through all texts."""
    codes, letters, size = _coded(texts)
    base = len(letters) + 1
    row = np.repeat(np.arange(len(texts)), size)
    at = np.flatnonzero(row[: len(row) - q + 1] == row[q - 1 :]) if len(row) >= q else np.zeros(0, np.int64)
    gram = np.zeros(len(at), np.int64)
    for k in range(q):
        gram = gram * base + codes[at + k]
    _, gram = np.unique(gram, return_inverse=True)
    key, count = np.unique(row[at] * (int(gram.max(initial=0)) + 1) + gram, return_counts=True)
    return key // (int(gram.max(initial=0)) + 1), key % (int(gram.max(initial=0)) + 1), count


def shared_grams(texts: list[str], n_first: int, q: int) -> np.ndarray:
    """The q-grams that each of the first texts shares with each of the others, as multisets."""
    row, gram, count = gram_counts(texts, q)
    out = np.zeros((n_first, len(texts) - n_first), np.int32)
    order = np.argsort(gram, kind="stable")
    row, gram, count = row[order], gram[order], count[order]
    for lo, hi in _groups(gram):
        own = row[lo:hi] < n_first
        if own.any() and not own.all():
            a, b = row[lo:hi][own], row[lo:hi][~own] - n_first
            out[np.ix_(a, b)] += np.minimum(count[lo:hi][own][:, None], count[lo:hi][~own][None]).astype(np.int32)
    return out


def _groups(sorted_keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(sorted_keys)) + 1
    yield from zip([0, *cut.tolist()], [*cut.tolist(), len(sorted_keys)], strict=True)
