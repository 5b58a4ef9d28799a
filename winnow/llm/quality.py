"""Quality rules: robust multivariate outliers.

One pass over the whole texts takes a few counts per document.  Transformed,
they make a vector per document.  For every language and source a minimum
covariance determinant (MCD) estimate gives the centre and the shape of the
main body of those vectors, and a document is rejected where its robust
Mahalanobis distance is too large.

The estimate runs over all rows.  A concentration step is one grouped
aggregate: rows are binned by their distance to the present estimate, counts
and moments are summed per group and bin, and the bins that hold the nearest
``SUPPORT`` of the group, the last of them in part, give the next estimate.  A
group has three starts: medians with quartile widths, mean and covariance of
all rows, and the medians with half of either.  Each is concentrated until its
determinant settles, and the least determinant wins.  A task sends one row per
group, start and bin at most, so a source with a third of all rows costs no
more than any other, and nothing is sampled.

A document is rejected beyond the quantile of chi-squared that a normal body of
documents exceeds once in TAIL, scaled to the group's median where that is
wider than a normal one's.

Defined results: a null text is an empty one (no words, base_failed).  Null
language or source is a group of its own.  A group with fewer than MIN_GROUP
rows takes the estimate of its language, and one of those with too few that of
the whole table; an empty table gives no rows.  Repeated rows give equal
verdicts, and so do ties: equal statistics in one group have equal distances.
A null doc_id stays null.  A long text is one row like any other: all features are rates, so its
length alone moves none.  Columns besides doc_id, text, lang and source are not read,
whatever their names.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import common, textscan as ts

log = logging.getLogger(__name__)

MIN_WORDS = 50
#: Share of a group that the estimate rests on; under half of it may be anything.
SUPPORT = 0.6
#: A normal body of so many documents has one beyond the cut-off.
TAIL = 1e9
#: Concentration steps at most, and the change of a log determinant that is none.
MOST_STEPS, SETTLED = 15, 1e-3
STARTS = 3
MIN_GROUP = 60
MAX_BROADCAST_GROUPS = 10_000
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(x) for x in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(x) for x in "!?=[]{}~^_/\\@+;:"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_letters", "n_lines"]
#: Name, and the least standard deviation that an estimate may give it: most of these are constant over the main body.
FEATURES = {"word_length": 0.04, "symbols": 0.35, "upper": 0.25, "marks": 0.35, "letters": 0.03, "dup_lines": 0.08, "repeats": 0.05}
P = len(FEATURES)
_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
#: Bytes of text scanned at a time: the arrays made of them stay in a core's cache.
SCAN_BYTES = 1 << 18
#: Logarithmic bins of a squared distance: so many a doubling, the first of all at 2**LEAST.
PER_DOUBLING, LEAST, BINS = 16, -20, 16 * 60


def count_chunk(c: ts.Chunk) -> dict[str, np.ndarray]:
    """The COUNTS of each row of a chunk."""
    start, end, wb = ts.words(c)
    out = {"n_words": np.diff(wb)}
    lead = (c.data & 0xC0) != 0x80
    out["word_chars"] = ts.per_row(lead & ts.NOT_SPACE[c.data], c.border)
    for name, mask in (("n_symbols", _SYMBOLS), ("n_upper", _UPPER), ("n_marks", _MARKS), ("n_letters", _LETTER)):
        out[name] = ts.per_row(mask[c.data], c.border)

    # lines: row borders and newlines cut; those with a word count
    at = np.flatnonzero(c.data == 0x0A)
    ls = np.sort(np.concatenate([c.border[:-1], at + 1]))
    le = np.sort(np.concatenate([c.border[1:], at]))
    row = np.sort(np.concatenate([np.arange(c.n), np.searchsorted(c.border, at, "right") - 1]))
    full = np.searchsorted(start, le) > np.searchsorted(start, ls)
    ls, le, row = ls[full], le[full], row[full]
    key = ts.range_hashes(c.data, ls, le)
    pair = ts.mix(key + ts.mix(row.astype(np.uint64) + ts.U64(1)))
    order = np.argsort(pair, kind="stable")
    again = np.zeros(len(pair), bool)
    again[order[1:]] = pair[order[1:]] == pair[order[:-1]]
    lines = np.bincount(row, minlength=c.n)
    out["n_lines"] = lines
    out["n_dup_lines"] = np.bincount(row[again], minlength=c.n)

    # three-word windows found twice or more in their text
    h = ts.range_hashes(c.data, start, end)
    w = ts.windows_of(wb, 3)
    covered = np.zeros(len(h) + 1, bool)
    if len(w):
        owner = ts.row_of(wb)[w].astype(np.uint64)
        with np.errstate(over="ignore"):
            seq = ts.mix(ts.mix(ts.mix(h[w]) + h[w + 1]) + h[w + 2]) + ts.mix(owner + ts.U64(1))
        hit = w[ts.repeated(ts.mix(seq))]
        for k in range(3):
            covered[hit + k] = True
    out["n_repeat_words"] = ts.per_row(covered[:-1], wb)
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [count_chunk(c) for c in ts.chunks(b, limit=SCAN_BYTES)]
        if not got:
            continue
        cols = {"doc_id": b.column("doc_id"), "lang": b.column("lang"), "source": b.column("source")}
        cols |= {k: pa.array(np.concatenate([g[k] for g in got]).astype(np.int64)) for k in COUNTS}
        yield pa.RecordBatch.from_pydict(cols)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the COUNTS of every whole text."""
    d = common.pick(docs, "doc_id", "text", "lang", "source")
    d = d.select("doc_id", *[F.col(x).cast("string").alias(x) for x in ("text", "lang", "source")])
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(_counts, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def _feature_columns() -> dict:
    w, c = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "word_length": F.log(F.col("word_chars") / w + 0.5),
        "symbols": F.log(F.col("n_symbols") / w + 0.02),
        "upper": F.log(F.col("n_upper") / c + 0.01),
        "marks": F.log(F.col("n_marks") / w + 0.02),
        "letters": F.col("n_letters") / c,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / w,
    }


def chi2_median(p: int) -> float:
    """Median of a chi-squared variable (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p)) ** 3


def chi2_beyond(x: float, p: int) -> float:
    """The chance that a chi-squared variable of odd p exceeds x."""
    term, total = math.sqrt(2 * x / math.pi) * math.exp(-x / 2), 0.0
    for k in range(1, p, 2):
        total += term
        term *= x / (k + 2)
    return math.erfc(math.sqrt(x / 2)) + total


def chi2_cutoff(p: int = P, tail: float = TAIL) -> float:
    """What one of ``tail`` chi-squared variables exceeds."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_beyond(mid, p) * tail > 1 else (low, mid)
    return high


FLOOR = np.array(list(FEATURES.values()))
_SUMS = ["n", *[f"s{i}" for i in range(P)], *[f"q{k}" for k in range(len(_PAIRS))]]
_BINNED = "scope int, lang string, source string, start int, bin int, " + ", ".join(f"{x} double" for x in _SUMS)
#: By start: centre and whitening matrix (upper triangle of rows), log determinant, scale.
_MODEL = "scope int, lang string, source string, n double, est array<double>, det array<double>, scale array<double>, settled boolean"
_WIDTH = P + len(_PAIRS)
_UPPER_AT = np.triu_indices(P)


def _packed(mean: np.ndarray, cov: np.ndarray) -> tuple[list[float], float]:
    """mean and W with |(x - mean) W|**2 the squared distance, and log det cov."""
    w = np.linalg.cholesky(np.linalg.inv(cov))  # lower: its transpose is kept
    return [*mean.tolist(), *w.T[_UPPER_AT].tolist()], float(np.linalg.slogdet(cov)[1])


def _distances(x: np.ndarray, est: np.ndarray) -> np.ndarray:
    """Squared distances (rows by starts) of the rows x to their estimates."""
    est = est.reshape(len(x), -1, _WIDTH)
    d = x[:, None, :] - est[:, :, :P]
    out = np.zeros(d.shape[:2])
    at = P
    for i in range(P):  # row i of the upper triangle meets features i and on
        out += ((d[:, :, i:] * est[:, :, at : at + P - i]).sum(2)) ** 2
        at += P - i
    return out


def _bin(d2: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(PER_DOUBLING * (np.log2(np.maximum(d2, 2.0**LEAST)) - LEAST)), 0, BINS - 1).astype(np.int64)


def _features(b: pa.RecordBatch) -> np.ndarray:
    return np.stack([b.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)


def _estimates(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The rows that carry this list, and the lists."""
    col = b.column(name)
    on = np.flatnonzero(col.is_valid().to_numpy(zero_copy_only=False))
    return on, col.drop_null().flatten().to_numpy().reshape(len(on), -1 if len(on) else 0)


def _carried(b: pa.RecordBatch, scope: int, field: str) -> tuple[np.ndarray, np.ndarray]:
    """The rows that a join gave this field of the model, and its values."""
    return _estimates(b, f"{field}{scope}")


def _sent(model: DataFrame) -> Callable:
    """The same from the model itself, sent to all tasks: at most MAX_BROADCAST_GROUPS groups of a few hundred numbers."""
    groups: dict[int, dict] = {0: {}, 1: {}, 2: {}}
    fields = {k: {"est": [], "scale": []} for k in groups}
    for r in model.select("scope", "lang", "source", "est", "scale").collect():
        if r.est is not None:
            groups[r.scope][r.lang if r.scope < 2 else None, r.source if r.scope < 1 else None] = len(fields[r.scope]["est"])
            fields[r.scope]["est"].append(r.est)
            fields[r.scope]["scale"].append(r.scale)
    told = model.sparkSession.sparkContext.broadcast((groups, {k: {f: np.array(v, float) for f, v in x.items()} for k, x in fields.items()}))

    def found(b: pa.RecordBatch, scope: int, field: str) -> tuple[np.ndarray, np.ndarray]:
        groups, fields = told.value
        names = [b.column(k).dictionary_encode() for k in ("lang", "source")]
        words = [[*n.dictionary.to_pylist(), None] for n in names]
        codes = [n.indices.fill_null(len(n.dictionary)).to_numpy().astype(np.int64) for n in names]
        keys, where = np.unique(codes[0] * len(words[1]) + codes[1], return_inverse=True)
        at = np.array([groups[scope].get((words[0][k // len(words[1])] if scope < 2 else None, words[1][k % len(words[1])] if scope < 1 else None), -1) for k in keys.tolist()], np.int64)[where]
        on = np.flatnonzero(at >= 0)
        return on, fields[scope][field][at[on]]

    return found


def _binned(batches: Iterator[pa.RecordBatch], estimates: Callable) -> Iterator[pa.RecordBatch]:
    """Moments by group, start and bin of what a task reads, for each scope that the model has an estimate of."""
    held: dict[tuple, np.ndarray] = {}

    def rows() -> pa.RecordBatch:
        sums = np.array(list(held.values()))
        cols = [pa.array([k[i] for k in held], t) for i, t in enumerate((pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()))]
        return pa.RecordBatch.from_arrays([*cols, *[pa.array(sums[:, i]) for i in range(len(_SUMS))]], names=["scope", "lang", "source", "start", "bin", *_SUMS])

    for b in batches:
        x = _features(b)
        if not len(x):
            continue
        moments = np.concatenate([np.ones((len(x), 1)), x, np.stack([x[:, i] * x[:, j] for i, j in _PAIRS], axis=1)], axis=1)
        names = [b.column(k).dictionary_encode() for k in ("lang", "source")]
        codes = [n.indices.fill_null(len(n.dictionary)).to_numpy().astype(np.int64) for n in names]
        words = [[*n.dictionary.to_pylist(), None] for n in names]
        for scope in range(3):
            on, est = estimates(b, scope, "est")
            if not len(on):
                continue
            lang = codes[0][on] if scope < 2 else np.full(len(on), len(words[0]) - 1)
            source = codes[1][on] if scope < 1 else np.full(len(on), len(words[1]) - 1)
            bins = _bin(_distances(x[on], est))
            for start in range(bins.shape[1]):
                key = (lang * len(words[1]) + source) * BINS + bins[:, start]
                values, where = np.unique(key, return_inverse=True)
                order = np.argsort(where, kind="stable")
                first = np.searchsorted(where[order], np.arange(len(values)))
                for v, m in zip(values.tolist(), np.add.reduceat(moments[on[order]], first, axis=0), strict=True):
                    k = (scope, words[0][v // BINS // len(words[1])], words[1][v // BINS % len(words[1])], start, v % BINS)
                    held[k] = held[k] + m if k in held else m
        if len(held) > 60_000:
            yield rows()
            held = {}
    if held:
        yield rows()


def concentrated(bins: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """From the sums (n, s, q) by bin of one group and start: mean and covariance of
    the nearest SUPPORT of it, and how much wider than a normal body's its median distance is."""
    order = np.argsort(bins)
    bins, sums = bins[order], sums[order]
    upto = np.cumsum(sums[:, 0])
    most = SUPPORT * upto[-1]
    last = min(int(np.searchsorted(upto, most - 1e-9)), len(bins) - 1)
    share = np.ones(last + 1)
    share[last] = 1 - (upto[last] - most) / sums[last, 0]
    near = share @ sums[: last + 1]
    mean = near[1 : P + 1] / near[0]
    cov = np.zeros((P, P))
    for (i, j), q in zip(_PAIRS, near[P + 1 :], strict=True):
        cov[i, j] = cov[j, i] = q / near[0] - mean[i] * mean[j]
    mid = bins[int(np.searchsorted(upto, 0.5 * upto[-1] - 1e-9))]
    return mean, cov + np.diag(FLOOR**2), max(1.0, 2.0 ** ((mid + 1) / PER_DOUBLING + LEAST) / chi2_median(P))


def _next(pdf: pd.DataFrame) -> pd.DataFrame:
    """From the summed bins of one group: the next estimate of each start."""
    est, det, scale = [], [], []
    for _, g in pdf.groupby("start"):
        mean, cov, wide = concentrated(g["bin"].to_numpy(), g[_SUMS].to_numpy(float))
        packed, log_det = _packed(mean, cov)
        est += packed
        det.append(log_det)
        scale.append(wide)
    before = np.asarray(pdf["det"].iloc[0], float)
    done = bool(np.all(np.abs(before - det) < SETTLED)) if len(before) == len(det) else False
    n = float(pdf.loc[pdf["start"] == 0, "n"].sum())
    return pd.DataFrame([{"scope": pdf["scope"].iloc[0], "lang": pdf["lang"].iloc[0], "source": pdf["source"].iloc[0], "n": n, "est": est, "det": det, "scale": scale, "settled": done}])


def _starts(pdf: pd.DataFrame) -> pd.DataFrame:
    """From medians, widths, means and products: the starts of each group."""
    rows = []
    for r in pdf.itertuples():
        low, mid, high = (np.array([getattr(r, f)[k] for f in FEATURES], float) for k in range(3))
        mean = np.array([getattr(r, f"m{i}") for i in range(P)])
        cov = np.zeros((P, P))
        for k, (i, j) in enumerate(_PAIRS):
            cov[i, j] = cov[j, i] = getattr(r, f"v{k}")
        cov += np.diag(FLOOR**2)
        wide = np.diag(np.maximum((high - low) / 1.349, FLOOR) ** 2)
        est, det = zip(*[_packed(*x) for x in ((mid, wide), (mean, cov), (mid, (wide + cov) / 2))], strict=True)
        rows.append({"scope": r.scope, "lang": r.lang, "source": r.source, "n": r.n, "est": sum(est, []), "det": [], "scale": [1.0] * STARTS, "settled": False})
    return pd.DataFrame(rows, columns=["scope", "lang", "source", "n", "est", "det", "scale", "settled"])


def _first(stats: DataFrame) -> DataFrame:
    """The starts of every group of MIN_GROUP rows or more; of the languages and of the
    table where a group below them is too small."""
    names = list(FEATURES)
    agg = [F.percentile_approx(f, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(1000)).alias(f) for f in names]
    agg += [F.avg(f).alias(f"m{i}") for i, f in enumerate(names)] + [F.covar_pop(names[i], names[j]).alias(f"v{k}") for k, (i, j) in enumerate(_PAIRS)]
    sizes = common.kept(stats.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "sizes")
    langs = sizes.groupBy("lang").agg(F.sum("n").alias("n"), F.min("n").alias("least"))
    small = langs.where(F.col("least") < MIN_GROUP).select(F.col("lang").alias("_lang"))
    no_lang, no_source = F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")
    some = F.lit(langs.where(F.col("n") < MIN_GROUP).limit(1).count() > 0)
    parts = [
        stats.groupBy("lang", "source").agg(F.count(F.lit(1)).cast("double").alias("n"), *agg).where(F.col("n") >= MIN_GROUP).select(F.lit(0).alias("scope"), "lang", "source", "n", *_columns()),
        stats.join(small, F.col("lang").eqNullSafe(F.col("_lang")), "left_semi").groupBy("lang").agg(F.count(F.lit(1)).cast("double").alias("n"), *agg).where(F.col("n") >= MIN_GROUP).select(F.lit(1).alias("scope"), "lang", no_source, "n", *_columns()),
        stats.where(some).groupBy().agg(F.count(F.lit(1)).cast("double").alias("n"), *agg).where("n > 0").select(F.lit(2).alias("scope"), no_lang, no_source, "n", *_columns()),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).mapInPandas(lambda it: map(_starts, it), _MODEL)


def _columns() -> list[str]:
    return [*FEATURES, *[f"m{i}" for i in range(P)], *[f"v{k}" for k in range(len(_PAIRS))]]


def _joined(stats: DataFrame, model: DataFrame) -> DataFrame:
    """Each row with the estimates of its group, its language and the table, where the model has such."""
    out = stats
    for scope, keys in ((0, ["lang", "source"]), (1, ["lang"]), (2, [])):
        m = model.where(F.col("scope") == scope).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("est").alias(f"est{scope}"), F.col("scale").alias(f"scale{scope}"))
        if not keys:  # one row
            out = out.join(F.broadcast(m), F.lit(True), "left")
            continue
        on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        out = out.join(m, on, "left").drop(*[f"_{k}" for k in keys])
    return out


def _with_model(rows: DataFrame, model: DataFrame, n_groups: int, run: Callable, schema: str) -> DataFrame:
    """run(batches, estimates) over the rows: the model of few groups is sent to the tasks, so that rows carry nothing
    of it; that of more is joined to them, and adaptive execution splits the large partitions."""
    if n_groups <= MAX_BROADCAST_GROUPS:
        estimates = _sent(model)
        return rows.mapInArrow(lambda it: run(it, estimates), schema)
    return _joined(rows, model).mapInArrow(lambda it: run(it, _carried), schema)


def fit(stats: DataFrame) -> tuple[DataFrame, int]:
    """The MCD estimate of every group: the start of least determinant, once all are settled."""
    sums = [F.sum(x).alias(x) for x in _SUMS]
    keys = ["scope", "lang", "source"]
    model = common.kept(_first(stats), "mcd")
    n_groups = model.count()
    for _ in range(MOST_STEPS):
        todo = model.where("NOT settled")
        if not n_groups or not todo.limit(1).count():
            break
        binned = _with_model(stats, todo, n_groups, _binned, _BINNED).groupBy(*keys, "start", "bin").agg(*sums)
        was = todo.select(*[F.col(k).alias(f"_{k}") for k in keys], "det")
        rows = binned.join(was, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).drop(*[f"_{k}" for k in keys])
        model = common.kept(rows.groupBy(*keys).applyInPandas(_next, _MODEL).unionByName(model.where("settled")), "mcd")
    open_ = model.where("NOT settled").count() if n_groups else 0
    if open_:
        log.warning("%d of %d groups hadn't settled after %d steps; their last estimates are used", open_, n_groups, MOST_STEPS)
    best = F.expr("array_position(det, array_min(det)) - 1").cast("int")
    model = model.withColumn("best", best).withColumn("est", F.slice("est", F.col("best") * _WIDTH + 1, F.lit(_WIDTH))).withColumn("scale", F.array(F.get("scale", F.col("best"))))
    return model.drop("best"), n_groups


def _verdicts(batches: Iterator[pa.RecordBatch], estimates: Callable) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = _features(b)
        d2 = np.full(len(x), np.nan)
        for scope in range(3):
            on, est = estimates(b, scope, "est")
            new = np.isnan(d2[on])
            if new.any():
                _, scale = estimates(b, scope, "scale")
                d2[on[new]] = _distances(x[on[new]], est[new])[:, 0] / scale[new, 0]
        yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", *COUNTS[:5])] + [pa.array(d2, mask=np.isnan(d2))], names=["doc_id", *COUNTS[:5], "distance"])


def quality_rules(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """doc_id, the base counts, base_failed, the squared robust distance, and kept.

    base_failed: under MIN_WORDS words, or over half of the words in repeated
    three-word windows.  kept: not base_failed, and a distance within the cut-off
    for ``tail``.  See the module for nulls, empty texts and small groups.
    """
    stats = common.kept(statistics(docs), "stats")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    x = stats.select("doc_id", "lang", "source", *COUNTS[:5], *[v.alias(k) for k, v in _feature_columns().items()])
    model, n_groups = fit(x.where(~failed).select("lang", "source", *FEATURES))  # rows that the base drops anyway don't shape the estimate
    kind = stats.schema["doc_id"].dataType.simpleString()
    out = _with_model(x, model, n_groups, _verdicts, f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS[:5])}, distance double")
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= chi2_cutoff(P, tail)))
