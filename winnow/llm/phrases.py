"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up.  At each level the names (code points first) are
grouped into phrases, and a phrase is named by a hash of the names in it:

* a run of one name repeated is cut into pairs, the last of three if need be;
* elsewhere neighbours differ, and deterministic coin tossing gives each a small
  label from itself and its left neighbour alone: the lowest bit in which the
  two differ, and its value.  Four rounds bring any alphabet down to six labels,
  in which neighbours still differ; a phrase begins at each local maximum.

Where a phrase begins depends on a few names around it, so equal substrings are
parsed alike but for their ends, wherever they stand, and share the names of all
their inner phrases at every level.  Each level has half as many names or fewer
where there is no run, two thirds at most where there are, so a text has a
logarithmic number of levels; the last name is that of the whole text.

The fingerprint is that last name (16 digits) and a sketch of the set of phrase
names: one-permutation MinHash, BUCKETS values of 16 bits, an eighth of them over
the first level, for the shortest texts, and the rest over all others.  Its size
is fixed, whatever the text.  The likeness of two fingerprints is the share of phrases
that they have in common (Dice's coefficient from the sketches).

``revised()`` puts each text beside one whose end is replaced by the beginning of
the next document.  Documents are dealt into ranges of their order, so that a task
has consecutive ones and streams through them: texts move once.  Only the last
document of each range is joined with the first of the next range.

Defined results: a null text is empty; empty texts are alike (1) and unlike all
others (0).  The order is by doc_id, nulls first, then by text, so rows that
repeat a doc_id follow one another and have each other as next; an only row is
its own next.  A long text is parsed whole, in a chunk of its own; an empty table
gives no rows.  Columns are taken by name, exact case first; others, whatever
their names, are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import common
from winnow.llm import textscan as ts

#: Rounds of coin tossing that bring 64-bit names down to six labels.
ROUNDS = 4
#: Values of a sketch; the first few are over phrases of the first level, the rest over those of all others.
BUCKETS, LOW_BUCKETS = 64, 8
#: Code points parsed side by side, and in one range of documents, about; and ranges at most.
SLICE_CHARS, RANGE_CHARS, MOST_RANGES = 1 << 18, 1 << 23, 50_000
#: Roles of the rows that a range hands to its neighbours.
FIRST, LAST = 1, 2
#: The left neighbour of a name that has none.
_NONE = np.uint64(0xD1B54A32D192ED03)
_STEP = np.uint64(0xA0761D6478BD642F)


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    one = np.array(1, x.dtype)
    return np.bitwise_count((x & (~x + one)) - one)


def _toss(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """New labels: the lowest bit in which each differs from its left neighbour, doubled, plus the bit."""
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[start] = _NONE.astype(x.dtype)
    j = _lowest_bit(x ^ left)
    return (2 * j + ((x >> j.astype(x.dtype)) & np.array(1, x.dtype)).astype(np.uint8)).astype(np.uint8)


def phrase_starts(names: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Where the phrases of a level begin; rows are names[border[i]:border[i + 1]]."""
    n = len(names)
    first = np.zeros(n + 1, bool)
    first[border] = True
    first = first[:n]
    same = np.zeros(n + 1, bool)
    same[1:n] = names[1:] == names[:-1]
    same[:n] &= ~first
    run = same[:n] | same[1:]
    start = first | ~same[:n] & run
    start[1:] |= run[1:] != run[:-1]
    at = np.flatnonzero(start)
    length = np.diff(np.append(at, n))
    place = np.arange(n) - np.repeat(at, length)
    to_end = np.repeat(length, length) - place  # 1 at the last
    begins = run & (place % 2 == 0) & (to_end > 1)
    begins |= start
    lone = ~run
    label = names
    for _ in range(ROUNDS):
        label = _toss(label, start)
    top = np.zeros(n, bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    return np.flatnonzero(begins | (top & lone & (place >= 2) & (to_end >= 2)))


def phrase_names(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The name of each phrase: a hash of its names in their places, and of its length."""
    n = len(names)
    length = np.diff(np.append(at, n))
    with np.errstate(over="ignore"):
        place = (np.arange(n) - np.repeat(at, length) + 1).astype(np.uint64)
        return ts.mix(np.add.reduceat(ts.mix(names.astype(np.uint64) + place * _STEP), at) + length.astype(np.uint64))


def levels(points: np.ndarray, border: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names and row borders of each level above the code points; a row that has come down to one name has none after that."""
    names = points
    while len(names):
        at = phrase_starts(names, border)
        names, border = phrase_names(names, at), np.searchsorted(at, border)
        yield names, border
        count = np.diff(border)
        names = names[np.repeat(count > 1, count)]
        border = np.concatenate([[0], np.cumsum(np.where(count > 1, count, 0))])


def _sketch(rows: list[np.ndarray], names: list[np.ndarray], n: int, buckets: int) -> np.ndarray:
    """Of each row the 16-bit values of the least hash in each bucket, 0 where there is none."""
    none = np.uint64(2**64 - 1)
    least = np.full(n * buckets, none)
    for row, own in zip(rows, names, strict=True):
        h = ts.mix(own ^ _STEP)
        slot = row * buckets + ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(least, slot, h)
    return np.where(least == none, 0, ts.mix(least) % np.uint64(65535) + np.uint64(1)).astype(np.uint16).reshape(n, buckets)


def fingerprints(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The fingerprints of texts as bytes, and their sketches as numbers."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    border = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    n = len(texts)
    whole, low, high = np.zeros(n, np.uint64), ([], []), ([], [])
    for level, (names, own) in enumerate(levels(points, border), 1):
        one = np.diff(own) == 1
        whole[one] = names[own[:-1][one]]
        rows, kept = low if level == 1 else high
        rows.append(ts.row_of(own))
        kept.append(names)
    sketch = np.concatenate([_sketch(*low, n, LOW_BUCKETS), _sketch(*high, n, BUCKETS - LOW_BUCKETS)], axis=1)
    joined = np.concatenate([whole.astype(">u8").view(np.uint8).reshape(n, 8), sketch.astype(">u2").view(np.uint8).reshape(n, 2 * BUCKETS)], axis=1)
    return [x.tobytes() for x in joined], sketch


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of sketches, the share of phrases in common: 2c / (u + c) with c equal buckets of u that either has."""
    used = ((a != 0) | (b != 0)).sum(1)
    common_ = ((a == b) & (a != 0)).sum(1)
    return np.where(used > 0, 2.0 * common_ / np.maximum(used + common_, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by as much of the beginning of the following text, or all of it."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


# ---------------------------------------------------------------- the next document


def compare(ids: list, texts: list[str], sketch: dict | None = None) -> tuple[dict[str, list], dict]:
    """The result of all but the last of consecutive documents, and the last one's fingerprint; sketch: the first one's, if known."""
    m = len(texts) - 1
    revised = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    known = sketch is not None
    names, values = fingerprints(texts[known:] + revised)
    if known:
        names, values = [sketch["name"], *names], np.concatenate([sketch["value"][None], values])
    own, new = values[: m + 1], values[m + 1 :]
    out = {
        "doc_id": ids[:m], "n_chars": [len(t) for t in texts[:m]], "edited_sha256": [hashlib.sha256(t.encode()).digest() for t in revised],
        "fingerprint": names[:m], "edited_fingerprint": names[m + 1 :], "near_edited": likeness(own[:m], new), "near_next": likeness(own[:m], own[1:]),
    }
    return out, {"name": names[m], "value": own[m]}


def _result(kind: str) -> str:
    return f"doc_id {kind}, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _arrays(cols: dict, doc: pa.DataType, **more) -> pa.RecordBatch:
    kinds = {"doc_id": doc, "n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
    cols = {k: pa.array(v, kinds.get(k, pa.binary())) for k, v in cols.items()}
    n = len(cols["doc_id"])
    return pa.RecordBatch.from_pydict(cols | {k: pa.array([v] * n, t) for k, (v, t) in more.items()})


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The results of the documents of one range, in their order, and its first and last document for the ranges beside it."""
    here = TaskContext.get().partitionId()
    ids, texts, chars, known, begun, kind = [], [], 0, None, False, None
    end = lambda role, i, t: _arrays({"doc_id": [i], "n_chars": [None], "edited_sha256": [None], "fingerprint": [None], "edited_fingerprint": [None], "near_edited": [None], "near_next": [None]}, kind, role=(role, pa.int32()), place=(here, pa.int32()), text=(t, pa.string()))
    for b in batches:
        kind = b.column("doc_id").type
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
            t = t.as_py()
            if not begun:
                begun = True
                yield end(FIRST, i, t)
            ids.append(i)
            texts.append(t)
            chars += len(t)
            if chars >= SLICE_CHARS and len(texts) > 1:
                cols, known = compare(ids, texts, known)
                yield _arrays(cols, kind, role=(0, pa.int32()), place=(here, pa.int32()), text=(None, pa.string()))
                ids, texts, chars = ids[-1:], texts[-1:], 0
    if len(texts) > 1:
        cols, known = compare(ids, texts, known)
        yield _arrays(cols, kind, role=(0, pa.int32()), place=(here, pa.int32()), text=(None, pa.string()))
    if texts:
        yield end(LAST, ids[-1], texts[-1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kind = b.column("doc_id").type
        for r in b.to_pylist():
            yield _arrays(compare([r["doc_id"], None], [r["text"], r["following"]])[0], kind)


def revised(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every document."""
    spark = docs.sparkSession
    d = common.pick(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, min(MOST_RANGES, -(-chars // RANGE_CHARS)))
    # rows alike in doc_id and text may stand in any order, so their place in the input tells them apart: no range must hold them all
    keyed = d.withColumn("h", F.xxhash64("text")).withColumn("r", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(n, "doc_id", "h", "r").sortWithinPartitions("doc_id", "h", "r").select("doc_id", "text")
    found = common.kept(dealt.mapInArrow(_in_order, _result(kind) + ", role int, place int, text string"), "ranges")
    result = [c for c in found.columns if c not in ("role", "place", "text")]
    # the last document of each range meets the first of the next range that has any: a row or two a range
    places = sorted(r.place for r in found.where(F.col("role") == FIRST).select("place").collect())  # MOST_RANGES at most
    after = spark.createDataFrame(list(zip(places, places[1:] + places[:1], strict=True)), "place int, beyond int")
    firsts = found.where(F.col("role") == FIRST).select(F.col("place").alias("beyond"), F.col("text").alias("following"))
    lasts = found.where(F.col("role") == LAST).select("place", "doc_id", "text").join(F.broadcast(after), "place").join(firsts, "beyond")
    out = found.where("role = 0").select(*result).union(lasts.select("doc_id", "text", "following").mapInArrow(_pairs, _result(kind)))
    return out.select(*[F.lower(F.hex(c)).alias(c) if t == "binary" else F.col(c) for c, t in out.dtypes])
