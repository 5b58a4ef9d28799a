"""Native sequence clustering: candidates from minimisers, batched alignment, greedy by length.

Sequences that share minimisers (the least hashed k-mer of every few in a row)
and whose lengths allow the coverage are candidates.  Under a minimiser and
length band a sequence meets the first CENTRES others of it by length, so the
candidates grow with the sequences however common a minimiser is; what is left
unclaimed meets again, under centres that are left too, until a round finds
nothing new.  With shared = 0 all pairs of compatible length are compared: the
exact way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.operators import alignment
from winnow.store import stored

#: Letters of a k-mer, k-mers of which the least is taken, and minimisers that candidates share.
KMER, WINDOW, SHARED = 5, 3, 2
#: Sequences of a minimiser that all others of it meet; pairs from which on the greedy rule is run in rounds; meetings at most.
CENTRES, LAST_PAIRS, MOST_MEETINGS = 16, 200_000, 8


def identities_and_coverages(first: list[str], second: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair the equal share of the columns with both letters, and those columns by the longer length."""
    r = alignment.align_pairs(first, second)
    n, m = np.array([len(x) for x in first], float), np.array([len(x) for x in second], float)
    both = n + m - r["columns"]
    return np.where(both > 0, r["matches"] / np.maximum(both, 1), 0.0), both / np.maximum(np.maximum(n, m), 1)


def identity_and_coverage(a: str, b: str) -> tuple[float, float]:
    i, c = identities_and_coverages([a], [b])
    return float(i[0]), float(c[0])


def minimisers(s: str, k: int = KMER, window: int = WINDOW) -> np.ndarray:
    """The distinct minimisers of a sequence, as hashes; all of it where it is shorter than a k-mer."""
    codes = np.frombuffer(s.encode("utf-32-le"), np.uint32).astype(np.uint64)
    k = min(k, len(codes))
    with np.errstate(over="ignore"):
        h = np.zeros(len(codes) - k + 1, np.uint64)
        for i in range(k):
            h = (h + codes[i : len(codes) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    if len(h) > window:
        h = np.lib.stride_tricks.sliding_window_view(h, window).min(1)
    return np.unique(h).view(np.int64)


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            keys = [minimisers(s) for s in b["sequence"]]
            count = [len(x) for x in keys]
            yield pd.DataFrame({"_g": np.repeat(b["_g"], count), "ID": np.repeat(b["ID"], count), "n": np.repeat([len(s) for s in b["sequence"]], count), "key": np.concatenate(keys)})


def _banded(k: DataFrame, coverage: float) -> tuple[DataFrame, DataFrame]:
    """Members by the band of their length, and centres by the bands of all that they could cover."""
    band = F.floor(F.log(F.col("n").cast("double")) / -F.log(F.lit(coverage))).cast("int")
    members = k.withColumn("band", band)
    centres = k.select("_g", "key", F.col("ID").alias("centre"), F.col("n").alias("nc"), F.explode(F.array(band, band - 1)).alias("band"))
    return members, centres


def _fits(coverage: float):
    longer = (F.col("nc") > F.col("n")) | ((F.col("nc") == F.col("n")) & (F.col("centre") < F.col("ID")))
    return longer & (F.col("n") >= coverage * F.col("nc"))


def candidate_pairs(k: DataFrame, shared: int = SHARED, coverage: float = 0.8) -> DataFrame:
    """Pairs (centre, ID) of rows (_g, ID, n, key) that share ``shared`` keys or more; the centre is the longer, of equal ones
    the lesser ID. With shared = 0 all pairs of such lengths."""
    members, centres = _banded(k if shared else k.select("_g", "ID", "n").distinct().withColumn("key", F.lit(0)), coverage)
    if shared:
        # each map output is cut to so many before the shuffle; stored, so that a common key's members can be split in the join
        w = Window.partitionBy("_g", "key", "band").orderBy(F.col("nc").desc(), "centre")
        centres = stored(centres.withColumn("k", F.row_number().over(w)).where(F.col("k") <= CENTRES).drop("k"))
    p = members.join(centres, ["_g", "key", "band"]).where(_fits(coverage))
    return p.groupBy("centre", "ID").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= shared).select("centre", "ID")


def _greedy_rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rule itself, on pairs (centre, nc, ID, n) that are few."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    p = pd.concat(parts, ignore_index=True)
    links: dict = {}
    size = dict(zip(p["centre"], p["nc"], strict=True)) | dict(zip(p["ID"], p["n"], strict=True))
    for c, i in zip(p["centre"], p["ID"], strict=True):
        links.setdefault(i, []).append(c)
    claimed: dict = {}
    for i in sorted(size, key=lambda x: (-size[x], x)):
        free = [c for c in links.get(i, ()) if c not in claimed]
        if free:
            claimed[i] = min(free, key=lambda c: (-size[c], c))
    yield pd.DataFrame({"member": list(claimed), "representative": list(claimed.values())})


def greedy(pairs: DataFrame, order: DataFrame) -> DataFrame:
    """member, representative by the greedy rule (longest unclaimed first) over pairs (centre, ID).

    order: ID and n, its length.  In a round every centre that no undecided one could claim takes what it is linked to (what is linked
    to several joins the first); two tables are written a round.  Once the pairs are at most LAST_PAIRS, one task ends it.
    """
    sizes = order.select("ID", "n")
    left = pairs.select("centre", "ID").join(sizes, "ID").join(sizes.select(F.col("ID").alias("centre"), F.col("n").alias("nc")), "centre")
    left, done = stored(left.select("centre", "nc", "ID", "n")), None
    while left.limit(LAST_PAIRS + 1).count() > LAST_PAIRS:
        bound = left.select(F.col("ID").alias("centre")).distinct()
        claimed = left.join(bound, "centre", "left_anti").groupBy("ID").agg(F.min(F.struct((-F.col("nc")).alias("n"), "centre")).alias("c"))
        new = stored(claimed.select(F.col("ID").alias("member"), F.col("c.centre").alias("representative")))
        done = new if done is None else done.union(new)
        gone = new.select(F.col("member").alias("ID"))
        # a pair counts as long as both are undecided
        left = stored(left.join(gone, "ID", "left_anti").join(gone.withColumnRenamed("ID", "centre"), "centre", "left_anti"))
    rest = left.coalesce(1).mapInPandas(_greedy_rest, "member string, representative string")
    claimed = stored(rest if done is None else done.union(rest))
    free = order.select(F.col("ID").alias("member")).join(claimed, "member", "left_anti")
    return claimed.union(free.select("member", F.col("member").alias("representative")))


def cluster_sequences(df: DataFrame, threshold: float = 0.7, coverage: float = 0.8, group: str | None = None, thresholds: dict[str, float] | None = None, shared: int = SHARED) -> DataFrame:
    """member, representative: the longest unclaimed sequence (then the least ID) is a representative and
    takes all that align with it at the identity threshold (of its group) and coverage; so on until none is left."""
    d = df.filter("sequence IS NOT NULL AND sequence <> ''").select(F.col("ID").cast("string").alias("ID"), "sequence", (F.col(f"`{group}`").cast("string") if group else F.lit("all")).alias("_g"))
    order = d.select("ID", F.length("sequence").alias("n"))
    if shared:
        keys = stored(d.select("_g", "ID", "sequence").mapInPandas(_keys, "_g string, ID string, n int, key long"))
    else:
        keys = d.select("_g", "ID", F.length("sequence").alias("n"))
    good = _verified(candidate_pairs(keys, shared, coverage), d, threshold, coverage, thresholds or {})
    out = stored(greedy(good, order))
    # a common minimiser's centres may themselves have been claimed: representatives that are left meet under new ones
    for _ in range(MOST_MEETINGS if shared else 0):
        reps = out.where("member = representative").select(F.col("member").alias("ID"))
        good = stored(_verified(candidate_pairs(keys.join(reps, "ID", "left_semi"), shared, coverage), d, threshold, coverage, thresholds or {}))
        if not good.limit(1).count():
            break
        again = greedy(good, order.join(reps, "ID", "left_semi")).select(F.col("member").alias("representative"), F.col("representative").alias("_r"))
        out = stored(out.join(again, "representative").select("member", F.col("_r").alias("representative")))
    return out


def _verified(pairs: DataFrame, d: DataFrame, threshold: float, coverage: float, thresholds: dict[str, float]) -> DataFrame:
    """The pairs that align so well."""
    a = d.select(F.col("ID").alias("centre"), F.col("sequence").alias("sa"))
    b = d.select("_g", "ID", F.col("sequence").alias("sb"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for lo in range(0, len(p), 4096):
                q = p.iloc[lo : lo + 4096]
                same, cover = identities_and_coverages(q["sa"].tolist(), q["sb"].tolist())
                yield q[["centre", "ID"]][(same >= np.array([thresholds.get(g, threshold) for g in q["_g"]])) & (cover >= coverage)]

    return pairs.join(a, "centre").join(b, "ID").select("_g", "centre", "ID", "sa", "sb").mapInPandas(run, "centre string, ID string")
