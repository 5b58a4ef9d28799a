"""The most identical references of each sequence, by global alignment.

Without a wanted identity every query meets every reference: both are dealt into
blocks by a hash of the id, and each pair of blocks is one group of bounded size.
Inside a group a bound from shared 2-grams orders the pairs, and those that
can't come among the k best of their query are not aligned.

With a wanted identity an index of q-grams finds the pairs instead.  A sequence
must share so many of its q-grams with any other that is so identical (see
``least_shared``), so such a pair shares one of its rarest few: only those are
joined.  The pairs found are held against the bound from all their q-grams and
then aligned; none that reaches the identity is lost.  Sequences so short that
no q-gram need be shared meet each other in blocks as above.

A null or empty sequence finds nothing and is found by none; rows alike in id and
sequence are one; ties go to the least id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.operators import alignment
from winnow.operators.alignment import Scores

#: Rows of one side in a group, at least and at most; pairs aligned at a time; tasks at most.
LEAST_ROWS, MOST_ROWS, AT_A_TIME, MOST_TASKS = 32, 512, 4096, 20_000
GRAM = 3
#: So many of the most frequent grams are told to all tasks, to be looked up last.
COMMON = 4096
FOUND = "query_id string, neighbour_id string, identity double, similarity double"


def _clean(df: DataFrame) -> DataFrame:
    return df.where("id IS NOT NULL AND sequence <> ''").select(F.col("id").cast("string").alias("id"), "sequence").distinct()


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.round("identity", 12).desc(), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("long").alias("rank"), "neighbour_id", "identity", "similarity")


def _raise(kth: np.ndarray, row: np.ndarray, value: np.ndarray) -> None:
    """Put values into the k best of their rows (ascending in each)."""
    for i in np.unique(row):
        v = np.concatenate([kth[i], value[row == i]])
        kth[i] = np.sort(v)[len(v) - kth.shape[1] :]


def _cell(a: pd.DataFrame, b: pd.DataFrame, k: int | None, scores: Scores, apart: bool, both_ways: bool, within: bool) -> pd.DataFrame:
    """The pairs of a group that may be among the k best of their query. both_ways: b's rows are queries too; within: a and b are one block."""
    k = k or max(len(a), len(b))
    ai, bi = a["id"].to_numpy(), b["id"].to_numpy()
    texts = [*a["sequence"], *b["sequence"]]
    n = np.array([len(t) for t in texts])
    bound = np.minimum(*[alignment.identity_bound(n[: len(a), None], n[None, len(a) :], alignment.shared_grams(texts, len(a), q), q) for q in (1, 2)])
    i, j = np.nonzero((ai[:, None] != bi[None] if apart else np.ones(bound.shape, bool)) & (np.arange(len(a))[:, None] < np.arange(len(b))[None] if within else True))
    top = bound[i, j]
    order = np.argsort(-top, kind="stable")
    i, j, top = i[order], j[order], top[order]
    kth_a, kth_b = np.full((len(a), k), -1.0), np.full((len(b), k), -1.0)
    out, at = [], 0
    while at < len(i):
        part = slice(at, at + AT_A_TIME)
        at += AT_A_TIME
        x, y, u = i[part], j[part], top[part] + 1e-12
        may = u >= kth_a[x, 0]
        if both_ways:
            may |= u >= kth_b[y, 0]
        x, y = x[may], y[may]
        if len(x):
            same, near = alignment.identities([texts[p] for p in x], [texts[len(a) + p] for p in y], scores)
            _raise(kth_a, x, same)
            out.append((ai[x], bi[y], same, near, x))
            if both_ways:
                _raise(kth_b, y, same)
    if not out:
        return pd.DataFrame({"query_id": [], "neighbour_id": [], "identity": [], "similarity": []}).astype({"query_id": str, "neighbour_id": str})
    q, r, same, near, x = (np.concatenate(v) for v in zip(*out, strict=True))
    found = pd.DataFrame({"query_id": q, "neighbour_id": r, "identity": same, "similarity": near})
    if both_ways:
        found = pd.concat([found, found.rename(columns={"query_id": "neighbour_id", "neighbour_id": "query_id"})])
    found = found.sort_values(["identity", "neighbour_id"], ascending=[False, True], kind="stable")
    return found.groupby("query_id", sort=False).head(k)[["query_id", "neighbour_id", "identity", "similarity"]]


def _blocks(n: int, parallel: int) -> int:
    rows = min(MOST_ROWS, max(LEAST_ROWS, int(n / (8 * parallel) ** 0.5)))
    return max(1, -(-n // rows))


def all_pairs(queries: DataFrame, ref: DataFrame, k: int | None, scores: Scores, apart: bool, both_ways: bool) -> DataFrame:
    """The k best of every query in each group of blocks, all of which together hold the k best of all, or every pair; sides as of _clean()."""
    spark = queries.sparkSession
    parallel = spark.sparkContext.defaultParallelism
    rows, cols = _blocks(queries.count(), parallel), _blocks(ref.count(), parallel)
    deal = lambda c, n: F.pmod(F.xxhash64(F.lit("block"), c), F.lit(n)).cast("int")
    if both_ways:  # a block meets itself and those after it
        first = queries.withColumn("i", deal("id", rows)).withColumn("j", F.explode(F.sequence(F.col("i"), F.lit(rows - 1)))).withColumn("side", F.lit(0))
        second = queries.withColumn("j", deal("id", rows)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("j")))).withColumn("side", F.lit(1)).where("i < j")
    else:
        first = queries.withColumn("i", deal("id", rows)).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(cols - 1)))).withColumn("side", F.lit(0))
        second = ref.withColumn("j", deal("id", cols)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("side", F.lit(1))
    both = first.select("i", "j", "side", "id", "sequence").union(second.select("i", "j", "side", "id", "sequence"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "sequence"])
        within = both_ways and key[0] == key[1]
        a = group[group["side"] == 0]
        return _cell(a, a if within else group[group["side"] == 1], k, scores, apart, both_ways, within)

    # groups are few rows and much work: a number given is not made smaller by their bytes
    both = both.repartition(min(MOST_TASKS, rows * (rows + 1) if both_ways else 2 * rows * cols), "i", "j")
    return both.groupBy("i", "j").applyInPandas(run, FOUND)


# ---------------------------------------------------------------- the index


def _tokens(q: int, identity: float, common: dict[str, int]):
    """Of each sequence the q-grams of its rarest few, of which any so identical sequence shares one; n and whether it need share any."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = cache(lambda n: alignment.least_shared(n, identity, q))
        for b in batches:
            out = []
            for i, s in zip(b["id"], b["sequence"], strict=True):
                count, tokens = Counter(), []
                for p in range(len(s) - q + 1):
                    g = s[p : p + q]
                    count[g] += 1  # the same gram for the second time is another token
                    tokens.append((common.get(g, -1), g, count[g]))
                need = least(len(s))
                tokens.sort()
                if need > 0:
                    tokens = tokens[: max(len(tokens) - need + 1, 0)]
                out += [(i, len(s), f"{c} {g}") for _, g, c in tokens]
            if out:
                yield pd.DataFrame(out, columns=["id", "n", "token"])

    return run


def _verify(identity: float, q: int, scores: Scores):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), AT_A_TIME):
                p = b.iloc[lo : lo + AT_A_TIME]
                first, second = p["sa"].tolist(), p["sb"].tolist()
                n, m = np.array([len(x) for x in first]), np.array([len(x) for x in second])
                may = alignment.identity_bound(n, m, _shared_each(first, second, q), q) >= identity - 1e-12
                p = p[may]
                if len(p):
                    same, near = alignment.identities(p["sa"].tolist(), p["sb"].tolist(), scores)
                    good = same >= identity - 1e-12
                    yield pd.DataFrame({"query_id": p["a"].to_numpy()[good], "neighbour_id": p["b"].to_numpy()[good], "identity": same[good], "similarity": near[good]})

    return run


def _shared_each(first: list[str], second: list[str], q: int) -> np.ndarray:
    """The q-grams that first[i] and second[i] share, as multisets."""
    row, gram, count = alignment.gram_counts([*first, *second], q)
    n = len(first)
    width = int(gram.max(initial=0)) + 1
    key = row % n * width + gram
    order = np.lexsort((row, key))
    key, count, row = key[order], count[order], row[order]
    pair = np.flatnonzero(key[1:] == key[:-1])
    return np.bincount(row[pair] % n, np.minimum(count[pair], count[pair + 1]), minlength=n) if n else np.zeros(0)


def identical_pairs(queries: DataFrame, ref: DataFrame, identity: float, scores: Scores = Scores(), apart: bool = False, q: int = GRAM) -> DataFrame:  # noqa: B008
    """query_id, neighbour_id, identity and similarity of all pairs of the wanted identity or more, each once."""
    a, b = _clean(queries), _clean(ref)
    grams = b.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("sequence") - q + 1, F.lit(1))), lambda p: F.substring(F.col("sequence"), p, F.lit(q)))).alias("g"))
    common = {r.g: int(r["count"]) for r in grams.groupBy("g").count().orderBy(F.col("count").desc(), "g").limit(COMMON).collect()}
    schema = "id string, n int, token string"
    x = a.mapInPandas(_tokens(q, identity, common), schema).select(F.col("id").alias("a"), F.col("n").alias("na"), "token")
    y = b.mapInPandas(_tokens(q, identity, common), schema).select(F.col("id").alias("b"), F.col("n").alias("nb"), "token")
    near = (F.col("nb") >= F.col("na") * identity - 1e-9) & (F.col("na") >= F.col("nb") * identity - 1e-9)
    pairs = x.join(y, "token").where(near & (F.col("a") != F.col("b") if apart else F.lit(True))).select("a", "b").distinct()
    pairs = pairs.join(a.select(F.col("id").alias("a"), F.col("sequence").alias("sa")), "a").join(b.select(F.col("id").alias("b"), F.col("sequence").alias("sb")), "b")
    found = pairs.mapInPandas(_verify(identity, q, scores), FOUND)
    # those that need share no q-gram with others so short
    short = _short_lengths(identity, q)
    if short:
        loose = lambda d: d.where(F.length("sequence").isin(*short))
        rest = all_pairs(loose(a), loose(b), None, scores, apart, False).where(F.col("identity") >= identity - 1e-12)
        found = found.union(rest).dropDuplicates(["query_id", "neighbour_id", "identity"])
    return found


@cache
def _short_lengths(identity: float, q: int) -> tuple[int, ...]:
    """The lengths of sequences that need share no q-gram; the identity must leave none beyond a few."""
    out = [n for n in range(1, 1001) if alignment.least_shared(n, identity, q) <= 0]
    if out and out[-1] > 100:
        raise ValueError(f"no bound from {q}-grams at an identity of {identity}: take a smaller q, a greater identity, or none")
    return tuple(out)


def most_identical(queries: DataFrame, ref: DataFrame, k: int = 1, self_mode: bool = False, scores: Scores = Scores(), min_identity: float | None = None, q: int = GRAM) -> DataFrame:  # noqa: B008
    """query_id, rank, neighbour_id, identity and similarity (fractions) of the k most identical references of each query, of those that
    reach min_identity if one is given. self_mode: a query's own id is no neighbour."""
    if min_identity:
        return _best(identical_pairs(queries, ref, min_identity, scores, self_mode, q), k)
    a = _clean(queries)
    if ref is queries and self_mode:
        return _best(all_pairs(a, a, k, scores, True, True), k)
    return _best(all_pairs(a, _clean(ref), k, scores, self_mode, False), k)


def summary(top: DataFrame, queries: DataFrame) -> DataFrame:
    """ID, max_identity and max_similarity in percent, each with the reference that has it, of the pairs in top; NULL where there are none."""
    best = lambda c: F.max(F.struct(F.round(c, 12).alias("v"), (-F.col("rank")).alias("r"), F.col("neighbour_id").alias("hit")))
    s = top.groupBy(F.col("query_id").alias("ID")).agg(best("identity").alias("i"), best("similarity").alias("p"))
    s = s.select("ID", (F.col("i.v") * 100).alias("max_identity"), F.col("i.hit").alias("identity_hit"), (F.col("p.v") * 100).alias("max_similarity"), F.col("p.hit").alias("similarity_hit"))
    return queries.select(F.col("id").cast("string").alias("ID")).join(s, "ID", "left")
