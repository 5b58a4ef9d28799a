"""How corpus filters interact: what each removes after which others.

One scan of the whole texts decides the filters of every document.  The
decisions become a packed bitmap index: rows of (part, block) with one bitset
for each filter and label, one bit a document, all bits of a row belonging to
one part.  Of each row, AND-NOT gives the documents left after each subset of
filters and popcount the number of them that a further filter, or a filter and
a label, hits; these counts are summed over blocks.  An order of filters is a
walk through the subsets, so all orders are read from the same sums: 2^k
subsets instead of k! passes.

Defined results: a null text is empty, and as such equal to other empty ones; a
null lang is the part ''.  A document fails E if its text is that of a document
of smaller doc_id; one without doc_id is neither smaller nor larger than others
and passes E, and has no labels.  Rows that repeat a doc_id are documents of
their own; those of the least doc_id of a text pass E all.  A label holds if any
row of ``labels`` gives 1 to the doc_id.  A long text is read whole, an empty
table has no parts and gives no rows.  Columns are taken by name, exact case
first; others, whatever their names, are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm import common
from winnow.llm import textscan as ts

#: The filters that the scan decides; the last needs the other documents.
SCANNED, FILTERS, LABELS = "ABCD", "ABCDE", ("good", "toxic")
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
#: Documents in one block of the index, at most.
BLOCK_ROWS = 1 << 20

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(x) for x in "#$%&*|"]] = True


def _distinct(c: ts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Words and distinct words of each row."""
    start, end, border = ts.words(c)
    row = ts.row_of(border)
    with np.errstate(over="ignore"):
        key = ts.mix(ts.range_hashes(c.data, start, end) + ts.mix(row.astype(np.uint64) + ts.U64(1)))
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    return np.diff(border), np.bincount(row[order[new]], minlength=c.n)


def failures(c: ts.Chunk) -> np.ndarray:
    """Of each row, a bit for every SCANNED filter that it fails."""
    n_words, n_distinct = _distinct(c)
    points = ts.per_row((c.data & 0xC0) != 0x80, c.border)
    fails = (
        n_words < MIN_WORDS,
        100 * n_distinct < MIN_DISTINCT_PERCENT * n_words,
        100 * ts.per_row(_UPPER[c.data], c.border) > MAX_UPPER_PERCENT * points,
        ts.per_row(_MARKS[c.data], c.border) > 0,
    )
    return sum(f.astype(np.uint8) << k for k, f in enumerate(fails))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [(failures(c), [hashlib.sha256(c.data[x:y]).digest() for x, y in zip(c.border[:-1], c.border[1:], strict=True)]) for c in ts.chunks(b)]
        if got:
            bits = np.concatenate([g[0] for g in got]).astype(np.int16)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "part": pc.fill_null(b.column("lang"), ""), "bits": bits, "sha": pa.array([x for g in got for x in g[1]], pa.binary())})


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, bits (one for each filter failed) and sha (of the text) of every document."""
    d = common.pick(docs, "doc_id", "text", "lang").select("doc_id", *[F.col(x).cast("string").alias(x) for x in ("text", "lang")])
    kind = d.schema["doc_id"].dataType.simpleString()
    rows = common.kept(d.mapInArrow(_judge, f"doc_id {kind}, part string, bits smallint, sha binary"), "judged")
    # only the least doc_id of a text passes E, so the rows meet a table of such by their own ids, however many share a text
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_first"), F.col("sha").alias("_sha"))
    e = F.when(F.col("doc_id").isNotNull() & F.col("_first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(first, (F.col("doc_id") == F.col("_first")) & (F.col("sha") == F.col("_sha")), "left").select("doc_id", "part", F.col("bits").bitwiseOR(e.cast("smallint")).alias("bits"), "sha")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the labels good (quality 1) and toxic as further bits."""
    a = common.pick(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
    a = a.groupBy(F.col("doc_id").cast(rows.schema["doc_id"].dataType).alias("_doc")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    bit = lambda c, k: F.shiftleft(F.coalesce(F.col(c), F.lit(0)), k)
    bits = F.col("bits").cast("int").bitwiseOR(bit("good", len(FILTERS))).bitwiseOR(bit("toxic", len(FILTERS) + 1))
    return rows.join(common.kept(a, "labels"), F.col("doc_id") == F.col("_doc"), "left").select("part", bits.cast("smallint").alias("bits"))


def _pack(width: int):
    """Rows (part, bits) to rows (part, n, set_0 ... set_width-1): a bitset for each bit, of one part each."""

    def block(part: pa.Array, bits: np.ndarray) -> pa.RecordBatch:
        coded = part.dictionary_encode()
        code = coded.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        bits, border = bits[order], np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
        sets = {f"set_{k}": pa.array([np.packbits((bits[x:y] >> k) & 1).tobytes() for x, y in zip(border[:-1], border[1:], strict=True)], pa.binary()) for k in range(width)}
        return pa.RecordBatch.from_pydict({"part": coded.dictionary, "n": np.diff(border).astype(np.int64)} | sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bits, n = [], [], 0
        for b in batches:
            parts.append(b.column("part"))
            bits.append(b.column("bits").to_numpy())
            n += b.num_rows
            if n >= BLOCK_ROWS:
                yield block(pa.concat_arrays(parts), np.concatenate(bits))
                parts, bits, n = [], [], 0
        if n:
            yield block(pa.concat_arrays(parts), np.concatenate(bits))

    return run


def index(rows: DataFrame, width: int = len(FILTERS) + len(LABELS)) -> DataFrame:
    """The packed bitmap index of rows (part, bits): part, n, set_0, set_1, ..., in blocks of a partition's rows."""
    return rows.select("part", "bits").mapInArrow(_pack(width), "part string, n long, " + ", ".join(f"set_{k} binary" for k in range(width)))


def _words(b: bytes) -> np.ndarray:
    return np.frombuffer(b.ljust(-(-len(b) // 8) * 8, b"\0"), np.uint64)


def _ones(a: np.ndarray) -> int:
    return int(np.bitwise_count(a).sum(dtype=np.int64))


def _count(n_filters: int, n_labels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                sets = [_words(r[f"set_{k}"]) for k in range(n_filters + n_labels)]
                fails, marks = sets[:n_filters], sets[n_filters:]
                left = [_words(np.packbits(np.ones(r["n"], np.uint8)).tobytes())]
                rows = []
                for s in range(1 << n_filters):
                    if s:  # what the subset without its highest filter leaves, AND-NOT that filter
                        top = s.bit_length() - 1
                        left.append(left[s ^ (1 << top)] & ~fails[top])
                    n_left = _ones(left[s])
                    for f in range(n_filters):
                        if not s >> f & 1:
                            hit = left[s] & fails[f]
                            removed = _ones(hit)
                            rows.append((s, f, n_left - removed, removed, *[_ones(hit & m) for m in marks]))
                cols = np.array(rows, np.int64).T
                names = ["subset", "filter", "kept", "removed", *[f"lost_{k}" for k in range(n_labels)]]
                yield pa.RecordBatch.from_pydict({"part": pa.array([r["part"]] * len(rows), pa.string())} | {k: pa.array(v) for k, v in zip(names, cols, strict=True)})

    return run


def subset_counts(bitmaps: DataFrame, n_filters: int = len(FILTERS), n_labels: int = len(LABELS)) -> DataFrame:
    """part, subset (a bit for each filter applied before), filter, and the documents that it then keeps, removes, and removes of each label."""
    counts = ["kept", "removed", *[f"lost_{k}" for k in range(n_labels)]]
    found = bitmaps.mapInArrow(_count(n_filters, n_labels), "part string, subset long, filter long, " + ", ".join(f"{c} long" for c in counts))
    return found.groupBy("part", "subset", "filter").agg(*[F.sum(c).alias(c) for c in counts])


def orders(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row for each part, order of the filters and step of it, from subset_counts()."""
    k = len(filters)
    every = Window.partitionBy("part", "filter")  # 2^(k-1) rows each
    size = F.bit_count("subset")
    weight = F.element_at(F.array(*[F.lit(factorial(i) * factorial(k - 1 - i)) for i in range(k)]), size + 1)
    of = lambda s: F.max(F.when(F.col("subset") == s, F.col("removed"))).over(every)
    others = F.expr(f"{(1 << k) - 1} ^ shiftleft(1, cast(filter AS int))")
    c = counts.withColumn("redundant", of(F.lit(0)) - F.col("removed")).withColumn("unique_fails", of(others)).withColumn("shapley", F.sum(weight * F.col("removed")).over(every))
    walks = [("".join(p), i + 1, sum(1 << filters.index(x) for x in p[:i]), filters.index(p[i])) for p in permutations(filters) for i in range(k)]
    table = counts.sparkSession.createDataFrame(walks, "filter_order string, step int, subset long, filter long")
    names = {f"lost_{i}": f"{x}_lost" for i, x in enumerate(LABELS)}
    return c.join(F.broadcast(table), ["subset", "filter"]).withColumnsRenamed(names).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *[x for x in names.values() if f"lost_{LABELS.index(x[:-5])}" in counts.columns], "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return orders(subset_counts(common.kept(index(labelled(judged(docs), labels)), "bitmaps")))


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    (len(w) < 200)::INT
    + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)::INT AS bits
  FROM t LEFT JOIN l ON t.doc_id = l.doc_id
), m AS (
  SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), p AS (
  SELECT '' AS filter_order, 0 AS step, 0 AS before, 0 AS own
  UNION ALL
  SELECT filter_order || x.c, step + 1, before + own, x.b FROM p, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(c, b) WHERE (before + own) & x.b = 0
), walk AS (
  SELECT o.filter_order, p.step, p.before, p.own FROM p JOIN (SELECT filter_order FROM p WHERE step = 5) o ON starts_with(o.filter_order, p.filter_order) WHERE p.step > 0
), c AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN bits & (before | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN bits & before = 0 AND bits & own > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN bits & before > 0 AND bits & own > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN bits = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN bits & before = 0 AND bits & own > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN bits & before = 0 AND bits & own > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM m, walk GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM c
"""
