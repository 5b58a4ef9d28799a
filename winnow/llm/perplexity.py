"""Quality classifier: an interpolated modified Kneser-Ney model of characters.

The model is of order 5 over the characters of trusted text (documents that
the labels call good).  White space runs count as one blank, and four start
marks stand before a text.  A character takes twelve bits: code points under
FOLD stand for themselves, others fall into 256 classes, so five of them are
one long, and suffixes and prefixes are shifts and masks.

Counting: each task sums the n-grams of its whole texts and sends each distinct
one once.  Lower orders count distinct left neighbours (continuations).  Each
order has three discounts from its counts of counts; probabilities of an order
come from two joins, with the sums of its contexts and with the order below.

Scoring: the table of all n-grams of the corpus with their log probabilities
is cut by key into shards of at most SHARD_GRAMS, and one shard at a time is
joined to the texts in the tasks that read them.  A document's sums over the
shards give its perplexity.  Nothing about the texts is shuffled, and however
large the table grows, a task holds one shard.

Verdict: per language, log perplexity may exceed the median by SPREAD times
the distance from the median to the upper quartile.

Defined results: null or empty texts, or such of white space only, have no
perplexity and are not kept.  A null language is one of its own.  Without
trusted text all n-grams are alike and only the spread decides.  Repeated
doc_ids are scored row by row.  Columns besides doc_id, text and lang,
and doc_id and quality of the labels, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import common, textscan as ts

ORDER, BITS, FOLD = 5, 12, 3840
START = 1
SHARD_GRAMS = 8_000_000
SPREAD = 8.0
MAX_BROADCAST_LABELS = 2_000_000
_HOLD = 1_500_000


def codes(c: ts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Twelve-bit codes of all rows, each after ORDER - 1 start marks, and their borders."""
    # decode UTF-8 in bulk: lead bytes give the length of a character
    d = c.data
    lead = np.flatnonzero((d & 0xC0) != 0x80)
    pad = np.concatenate([d, np.zeros(3, np.uint8)]).astype(np.uint32)
    b = pad[lead]
    cp = b.copy()
    two, three, four = (b >= 0xC0) & (b < 0xE0), (b >= 0xE0) & (b < 0xF0), b >= 0xF0
    i = lead[two]
    cp[two] = ((pad[i] & 0x1F) << 6) | (pad[i + 1] & 0x3F)
    i = lead[three]
    cp[three] = ((pad[i] & 0x0F) << 12) | ((pad[i + 1] & 0x3F) << 6) | (pad[i + 2] & 0x3F)
    i = lead[four]
    cp[four] = ((pad[i] & 0x07) << 18) | ((pad[i + 1] & 0x3F) << 12) | ((pad[i + 2] & 0x3F) << 6) | (pad[i + 3] & 0x3F)
    border = np.searchsorted(lead, c.border)
    blank = (cp == 0x20) | ((cp >= 0x09) & (cp <= 0x0D))
    cp[blank] = 0x20
    first = np.zeros(len(cp) + 1, bool)
    first[border] = True
    again = np.zeros(len(cp), bool)
    again[1:] = blank[1:] & blank[:-1]
    again[border[:-1][border[:-1] < len(cp)]] = False
    keep = ~again & ~(blank & first[:-1])  # leading blanks go too
    cp = np.where(cp < FOLD, cp, FOLD + (cp * np.uint32(2654435761) >> np.uint32(24)))
    border = np.concatenate([[0], np.cumsum(keep)])[border]
    cp = cp[keep]
    n = np.diff(border)
    mark = (ORDER - 1) * (n > 0)
    to = np.concatenate([[0], np.cumsum(n + mark)])
    out = np.full(int(to[-1]), START, np.int64)
    at = np.arange(len(cp)) + np.repeat(to[:-1] + mark - border[:-1], n)
    out[at] = cp
    return out, to


def grams(c: ts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character of each row, and their borders."""
    x, border = codes(c)
    w = ts.windows_of(border, ORDER)
    g = np.zeros(len(w), np.int64)
    for k in range(ORDER):
        g = (g << BITS) | x[w + k]
    return g, np.searchsorted(w, border)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    g = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    order = np.argsort(g, kind="stable")
    g, n = g[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, int)
    return g[first], np.add.reduceat(n, first) if len(first) else n


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list = []
    size = 0

    def sent(parts: list) -> pa.RecordBatch:
        g, n = _merged(parts)
        return pa.RecordBatch.from_pydict({"g": pa.array(g), "c": pa.array(n)})

    for b in batches:
        trusted = b.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        for c in ts.chunks(b):
            g, border = grams(c)
            good = np.repeat(trusted[c.first : c.first + c.n], np.diff(border))
            u, n = np.unique(g[good], return_counts=True)
            held += [(u, n.astype(np.int64)), ((o := np.unique(g[~good])), np.zeros(len(o), np.int64))]
            size += len(u) + len(o)
            if size > _HOLD:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > _HOLD // 2:
                    yield sent(held)
                    held, size = [], 0
    if held:
        yield sent(held)


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ from the numbers of n-grams counted once to four times."""
    r = counts.agg(*[F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in range(1, 5)]).first()
    n = [r[f"n{k}"] or 0 for k in range(1, 5)]
    if not n[0] or not n[1]:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw, strict=True)]


def model(docs: DataFrame) -> DataFrame:
    """(g, logp): every n-gram of the texts with its interpolated log probability.

    docs has text and trusted (boolean).
    """
    top = common.kept(docs.select(F.col("text").cast("string").alias("text"), "trusted").mapInArrow(_counts, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")), "grams")
    tables = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):  # continuations: distinct left neighbours of what is counted
        low = tables[k + 1].select(F.col("g").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("g"), (F.col("c") > 0).cast("long").alias("c"))
        tables[k] = common.kept(low.groupBy("g").agg(F.sum("c").alias("c")), "grams")
    below = None
    for k in range(1, ORDER + 1):
        t = tables[k]
        d1, d2, d3 = _discounts(t)
        c = F.col("c")
        discount = F.when(c == 0, 0.0).when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        spare = F.sum(discount).alias("spare")
        if k == 1:
            size, total, rest = t.agg(F.count(F.lit(1)), F.sum("c"), F.sum(discount)).first()
            total, rest = (float(total), float(rest)) if total else (1.0, 1.0)
            below = t.select("g", ((c - discount) / total + rest / total / ((size or 0) + 1)).alias("p"))
            continue
        context = t.where("c > 0").groupBy(F.shiftright("g", BITS).alias("_ctx")).agg(F.sum("c").cast("double").alias("total"), spare)
        lower = below.select(F.col("g").alias("_low"), F.col("p").alias("_p"))
        x = t.join(context, F.shiftright("g", BITS) == F.col("_ctx"), "left").join(lower, F.col("g").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)) == F.col("_low"))
        p = F.when(F.col("total").isNull(), F.col("_p")).otherwise((c - discount) / F.col("total") + F.col("spare") / F.col("total") * F.col("_p"))
        below = common.kept(x.select("g", p.alias("p")), "probabilities")
    return below.select("g", F.log("p").cast("float").alias("logp"))


def _scored(g: np.ndarray, logp: np.ndarray, first: bool):
    """Sums over the n-grams of this shard; the first shard also counts characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums, sizes = [], []
            for c in ts.chunks(b):
                x, border = grams(c)
                total = np.zeros(len(x) + 1)
                if len(g):
                    at = np.searchsorted(g, x)
                    at[at == len(g)] = 0
                    np.cumsum(np.where(g[at] == x, logp[at], 0.0), out=total[1:])
                sums.append(total[border[1:]] - total[border[:-1]])
                sizes.append(np.diff(border) if first else np.zeros(c.n, np.int64))
            if sums:
                yield pa.RecordBatch.from_pydict({"row": b.column("row"), "doc_id": b.column("doc_id"), "lang": b.column("lang"), "logp": pa.array(np.concatenate(sums)), "n_chars": pa.array(np.concatenate(sizes).astype(np.int64))})

    return run


def scores(docs: DataFrame, table: DataFrame, shard_grams: int = SHARD_GRAMS) -> DataFrame:
    """doc_id, lang, n_chars, perplexity of every row."""
    spark = docs.sparkSession
    shards = max(1, -(-table.count() // shard_grams))
    d = docs.select(F.lit(0).cast("long").alias("row") if shards == 1 else F.monotonically_increasing_id().alias("row"), "doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    schema = f"row long, doc_id {d.schema['doc_id'].dataType.simpleString()}, lang string, logp double, n_chars long"
    out = None
    for s in range(shards):
        part = table if shards == 1 else table.where(F.pmod(F.xxhash64("g"), F.lit(shards)) == s)
        t = part.toArrow()
        g, p = (t.column(x).to_numpy() for x in ("g", "logp"))
        order = np.argsort(g)
        sent = spark.sparkContext.broadcast((g[order], p[order]))
        got = d.mapInArrow(lambda it, sent=sent, s=s: _scored(*sent.value, s == 0)(it), schema)
        out = got if out is None else out.union(got)
    if shards > 1:
        out = out.groupBy("row", "doc_id", "lang").agg(F.sum("logp").alias("logp"), F.sum("n_chars").alias("n_chars"))
    return out.select("doc_id", "lang", "n_chars", F.when(F.col("n_chars") > 0, F.exp(-F.col("logp") / F.col("n_chars"))).alias("perplexity"))


def with_trust(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with trusted: whether a label calls the document good and none calls it bad."""
    good = common.kept(common.pick(labels, "doc_id", "quality").where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q >= 1").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_good")), "trusted")
    few = good.count() <= MAX_BROADCAST_LABELS  # 16 bytes each
    return docs.join(F.broadcast(good) if few else good, docs.doc_id == F.col("_id"), "left").withColumn("trusted", F.coalesce("_good", F.lit(False))).drop("_id", "_good")


def classify(docs: DataFrame, labels: DataFrame, spread: float = SPREAD, shard_grams: int = SHARD_GRAMS) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, threshold (of the language) and kept."""
    d = common.pick(docs, "doc_id", "text", "lang")
    s = common.kept(scores(d, model(with_trust(d, labels)), shard_grams), "scores")
    q = s.where("perplexity IS NOT NULL").groupBy("lang").agg(F.percentile_approx(F.log("perplexity"), F.array(F.lit(0.5), F.lit(0.75)), F.lit(10_000)).alias("q"))
    limit = q.select(F.col("lang").alias("_lang"), F.exp(F.col("q")[0] + spread * F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(0.005))).alias("threshold"))
    few = limit.count() <= 10_000  # languages
    out = s.join(F.broadcast(limit) if few else limit, s.lang.eqNullSafe(F.col("_lang")), "left").drop("_lang")
    return out.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
