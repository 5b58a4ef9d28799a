"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over four or five consecutive tokens; only the tokens at
its ones are hashed.  The hashes of all benchmark windows are joined with those
of all training windows, and along every hit the benchmark item is laid on the
document and compared word by word: an overlap counts if it spans MIN_OVERLAP
tokens or the whole of a shorter item and at least IDENTITY of its words agree.

Every such overlap has a seed.  A run of n words, the first and last equal, of
which e <= n / 5 differ, has n - e equal words in e + 1 stretches at most.
From 13 words on that is a stretch of four, but where 15 words are stretches of
three with one word between them, which 11101 meets; of 5 to 12 words a stretch
of four, or one of three or two with equal words one place on, which one of the
four masks meets.  An item of fewer than five words has to agree in all.

The benchmark is the query side.  It goes to the tasks in blocks of at most
BLOCK_WINDOWS windows (a bound in bytes), one pass over the documents for each
block, so neither side is shuffled, and a passage that many documents share
costs no more than any other text.

Tokens are runs of ASCII letters and digits and of bytes beyond ASCII, A-Z
lower-cased; all else separates.  Defined results: null or empty texts on
either side match nothing; an item shorter than MIN_OVERLAP tokens is matched
as a whole; repeated documents are each reported; an item without item_id is
matched like any other and reported with a null; ties go to the first start; an
empty table gives no rows.  Only doc_id and text, item_id and text are read, by
name, exact case first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import common
from winnow.llm import textscan as ts

#: Fixed masks of four tokens each, and those that only items shorter than MIN_OVERLAP need.
MASKS = ("1111", "11101")
SHORT_MASKS = ("11011", "10111")
MIN_OVERLAP = 13
IDENTITY = 0.8
BLOCK_WINDOWS = 1_000_000
BLOCK_ITEMS = 20_000

_U = np.uint64


def _token_hashes(c: ts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    c = ts.Chunk(c.first, c.n, ts.LOWER[c.data], c.border)
    start, end, wb = ts.words(c, ts.ALNUM)
    return ts.range_hashes(c.data, start, end), wb


def _seed_hashes(h: np.ndarray, at: np.ndarray, mask: str) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(len(at), int(mask, 2), np.uint64)
        for k, bit in enumerate(mask):
            if bit == "1":
                out = out * _U(0x9E3779B97F4A7C15) + h[at + k]
        return ts.mix(out)


class Block:
    """Hashes of some benchmark items, in sorted arrays."""

    def __init__(self, item_ids: list, texts: list[str]) -> None:
        batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.large_string())})
        parts = [(*_token_hashes(c), c) for c in ts.chunks(batch)]
        self.ids = np.array(item_ids)
        sizes = np.concatenate([np.diff(wb) for _, wb, _ in parts]) if parts else np.zeros(0, int)
        self.border = np.concatenate([[0], np.cumsum(sizes)])
        self.tokens = np.concatenate([h for h, _, _ in parts]) if parts else np.zeros(0, np.uint64)
        keys, items, offs = [], [], []
        row = ts.row_of(self.border)
        self.masks = MASKS + SHORT_MASKS * bool(((sizes >= 5) & (sizes < MIN_OVERLAP)).any())
        for mask in self.masks:
            at = ts.windows_of(self.border, len(mask))
            if mask in SHORT_MASKS:
                at = at[sizes[row[at]] < MIN_OVERLAP]
            keys.append(_seed_hashes(self.tokens, at, mask))
            items.append(row[at])
            offs.append(at - self.border[row[at]])
        # items of fewer than five tokens: their whole sequence, found by length
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in np.unique(sizes[(sizes > 0) & (sizes < 5)]):
            who = np.flatnonzero(sizes == n)
            k = _seed_hashes(self.tokens, self.border[who], "1" * int(n))
            order = np.argsort(k)
            self.short[int(n)] = (k[order], who[order])
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.off = key[order], np.concatenate(items)[order], np.concatenate(offs)[order]
        #: One bit per hash prefix: most training windows stop here.
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.key >> _U(42)).astype(np.int64)] = True

    def hits(self, h: np.ndarray, wb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, diagonal) where a seed agrees; the diagonal is the row's token at which the item starts."""
        row = ts.row_of(wb)
        rows, items, diag = [], [], []

        def meet(at: np.ndarray, k: np.ndarray, key: np.ndarray, item: np.ndarray, off: np.ndarray) -> None:
            lo, hi = np.searchsorted(key, k), np.searchsorted(key, k, "right")
            n = hi - lo
            which = np.repeat(np.arange(len(at)), n)
            j = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rows.append(row[at[which]])
            items.append(item[j])
            diag.append(at[which] - off[j])

        for mask in self.masks:
            at = ts.windows_of(wb, len(mask))
            k = _seed_hashes(h, at, mask)
            on = self.sieve[(k >> _U(42)).astype(np.int64)]
            if on.any():
                meet(at[on], k[on], self.key, self.item, self.off)
        for n, (key, item) in self.short.items():
            w = ts.windows_of(wb, n)
            k = _seed_hashes(h, w, "1" * n)
            on = np.isin(k, key)
            if on.any():
                meet(w[on], k[on], key, item, np.zeros(len(item), int))
        if not rows:
            return (np.zeros(0, int),) * 3
        r, i, d = np.concatenate(rows), np.concatenate(items), np.concatenate(diag)
        order = np.lexsort((d, i, r))
        r, i, d = r[order], i[order], d[order]
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (d[1:] != d[:-1])])[: len(r)]
        return self._enough(h, wb, r[new], i[new], d[new])

    def _enough(self, h: np.ndarray, wb: np.ndarray, row: np.ndarray, item: np.ndarray, diag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of these, where so many words agree along the diagonal as the shortest overlap needs."""
        n = self.border[item + 1] - self.border[item]
        lo, hi = np.maximum(diag, wb[row]), np.minimum(diag + n, wb[row + 1])
        least = np.minimum(MIN_OVERLAP, n)
        on = np.zeros(len(row), bool)
        worth = np.flatnonzero(hi - lo >= least)
        ends = np.cumsum((hi - lo)[worth])
        for some in np.split(worth, np.flatnonzero(np.diff(ends // 4_000_000)) + 1) if len(worth) else ():
            size = (hi - lo)[some]
            to = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(lo[some] - to[:-1], size) + np.arange(to[-1])
            same = h[at] == self.tokens[at + np.repeat(self.border[item[some]] - diag[some], size)]
            on[some] = np.add.reduceat(same, to[:-1], dtype=np.int64) >= least[some] * IDENTITY - 1e-9
        return row[on], item[on], diag[on]

    def overlaps(self, h: np.ndarray, wb: np.ndarray) -> list[tuple]:
        """(row, item, first word in the row, words, equal words) of the best verified overlap of each pair."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for r, i, d in zip(*self.hits(h, wb), strict=True):
            a, b = self.border[i], self.border[i + 1]
            lo, hi = max(int(d), int(wb[r])), min(int(d) + int(b - a), int(wb[r + 1]))
            same = h[lo:hi] == self.tokens[a + lo - int(d) : a + hi - int(d)]
            got = best_run(same, min(MIN_OVERLAP, int(b - a)))
            if got and (got[2] > best.get((r, i), (0, 0, 0))[2]):
                best[r, i] = (lo - int(wb[r]) + got[0], got[1], got[2])
        return [(r, i, *v) for (r, i), v in sorted(best.items())]


def best_run(same: np.ndarray, least: int) -> tuple[int, int, int] | None:
    """The longest run that starts and ends with an equal word, has at least
    ``least`` words and IDENTITY of them equal: (start, words, equal)."""
    on = np.flatnonzero(same)
    if len(on) < least * IDENTITY or not len(on):
        return None
    # equal - IDENTITY * words must not be negative from a start to an end
    score = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - IDENTITY, -IDENTITY))]).round(6)
    low = np.minimum.accumulate(score[:-1])
    best = None
    for e in on[::-1]:
        s = int(np.searchsorted(-low, -score[e + 1], "left"))  # the first start with score[s] <= score[e + 1]
        s = int(on[np.searchsorted(on, s)]) if s < len(low) else len(low)
        n = e + 1 - s
        if n >= least and (best is None or n > best[1]):
            k = int(same[s : e + 1].sum())
            if k >= IDENTITY * n - 1e-9:
                best = (s, int(n), k)
        if best is not None and e + 1 <= best[1]:
            break
    return best


def _scan(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            rows, cols = [], [[], [], [], []]
            for c in ts.chunks(b):
                h, wb = _token_hashes(c)
                for r, i, s, n, k in block.overlaps(h, wb):
                    rows.append(c.first + int(r))
                    for col, v in zip(cols, (block.ids[i], s, n, k), strict=True):
                        col.append(None if v is None else int(v))
            if rows:
                yield pa.RecordBatch.from_pydict({"doc_id": ids.take(pa.array(rows)), **{k: pa.array(v, pa.int64()) for k, v in zip(("item_id", "first_word", "n_words", "n_equal"), cols, strict=True)}})

    return run


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks of bounded size; one is held at a time."""
    ids: list = []
    texts: list[str] = []
    size = 0
    b = common.pick(benchmark, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for r in b.toLocalIterator(prefetchPartitions=False):
        ids.append(r.item_id)
        texts.append(r.text)
        size += len(r.text) // 2 + 1
        if size >= BLOCK_WINDOWS or len(ids) >= BLOCK_ITEMS:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Block(ids, texts)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word, n_words, n_equal: the best verified overlap of
    each document and item that share one.  One row per pair; a document
    row that is repeated is reported once per row."""
    spark: SparkSession = docs.sparkSession
    d = common.pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    schema = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, item_id long, first_word long, n_words long, n_equal long"
    out = None
    for block in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)
        part = d.mapInArrow(lambda it, sent=sent: _scan(sent.value)(it), schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out
