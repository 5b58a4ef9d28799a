"""Exact quantiles of many groups, without a buffer of any group's values.

Up to EXACT_ROWS rows Spark's own exact aggregate is used, whose buffer holds
the distinct values of a group and is bounded by that.  Beyond it every wanted
rank is narrowed down: a pass deals the values of a span into bins of equal
width and counts them, which tells the bin that holds the rank; its own least
and greatest value are the next span.  A row is in one bin however many ranks
are wanted, and a pass only counts, in the map tasks first.  Each third pass
deals by powers of two, for values that crowd about zero.  The few values left
are sorted last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.store import sent_if_small, stored

#: Rows up to which the exact aggregate is used; values of a span that are sorted at last.
EXACT_ROWS, LAST_VALUES = 1_000_000, 4096
#: Bins of a span.
CUTS = 1024
#: Of the sketches that an earlier form took; tests set it still, nothing reads it.
_FRACTIONS = None


def _same(keys: list[str]):
    """Keys of two sides are the same, nulls included; the other side's are named _<key>."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return out


def _other(d: DataFrame, keys: list[str], *rest: Column | str) -> DataFrame:
    return d.select(*[F.col(k).alias(f"_{k}") for k in keys], *rest)


def exact_quantiles(x: DataFrame, keys: list[str], fractions: dict[str, float], exact_rows: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """keys and a column for each fraction: the quantiles of x.x (linear between the two nearest ranks) in each group of the
    other columns; NULL for a group without values.  sizes: keys, n, a and b (values, least and greatest), if they are known."""
    exact_rows = EXACT_ROWS if exact_rows is None else exact_rows
    if sizes is None:
        sizes = stored(x.groupBy(*keys).agg(F.count("x").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")))
    if (sizes.agg(F.sum("n")).first()[0] or 0) <= exact_rows:
        p = F.expr(f"percentile(x, array({', '.join(map(str, fractions.values()))}))").alias("_p")
        return x.groupBy(*keys).agg(p).select(*keys, *[F.col("_p")[i].alias(k) for i, k in enumerate(fractions)])
    value = {}
    found = _found(x, keys, fractions, sizes).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    out = sizes.join(_other(found, keys, "at"), _same(keys), "left")
    for name, p in fractions.items():
        place = F.lit(p) * (F.col("n") - 1)
        low, high = F.col("at")[F.floor(place)], F.col("at")[F.ceil(place)]  # linear between the two ranks around the place
        part = place - F.floor(place)
        value[name] = F.when(low == high, low).otherwise(low * (1 - part) + high * part)
    return out.select(*keys, *[F.when(F.col("n") > 0, v).alias(k) for k, v in value.items()])


def _bin(step: int) -> Column:
    """The bin of x in the span from a to b, which never falls as x grows; the ends have bins of their own."""
    x, a, b = F.col("x"), F.col("a"), F.col("b")
    if step % 3 == 2:
        power = F.least(F.floor(F.log2(F.abs(x))), F.lit(2000)) + 1100
        inside, last = F.when(x == 0, F.lit(4000)).otherwise(4000 + F.signum(x).cast("int") * power), 8000
    else:  # halves, so that no difference overflows; where the width is none or infinite all is one bin
        part = (x / 2 - a / 2) / F.nullif(b / 2 - a / 2, F.lit(0.0))
        inside, last = 1 + F.greatest(F.least(F.coalesce(F.floor(part * CUTS), F.lit(0)), F.lit(CUTS - 1)), F.lit(0)), CUTS + 1
    return F.when(x == a, F.lit(0)).when(x == b, F.lit(last)).otherwise(inside).cast("int")


def _met(x: DataFrame, levels: list[DataFrame], keys: list[str]) -> DataFrame:
    """keys, x, below, a, b: the values that lie in a span of the last level, with it (below: values of the group before the span)."""
    m = x.where("x IS NOT NULL").select(*keys, "x").join(levels[0], _same(keys)).select(*keys, "x", "below", "a", "b")
    for step, spans in enumerate(levels[1:]):
        m = m.withColumn("bin", _bin(step)).withColumnRenamed("below", "up").drop("a", "b")
        m = m.join(spans, _same(keys) & (F.col("up") == F.col("_up")) & (F.col("bin") == F.col("_bin"))).select(*keys, "x", "below", "a", "b")
    return m


def _found(x: DataFrame, keys: list[str], fractions: dict[str, float], sizes: DataFrame) -> DataFrame:
    """keys, rank (from 0) and the value there, for the ranks around every fraction."""
    places = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(F.lit(p) * (F.col("n") - 1)), F.ceil(F.lit(p) * (F.col("n") - 1))) for p in fractions.values()])))
    wanted = sizes.where("n > 0").select(*keys, F.explode(places).alias("rank"))
    # the spans of a pass: keys, bin of the span before (up), below, size, a and b
    zero = F.lit(0).cast("long")
    spans = sizes.where("n > 0").select(*keys, zero.alias("up"), F.lit(0).alias("bin"), zero.alias("below"), F.col("n").alias("size"), "a", "b")
    found, levels = [], []
    while True:
        holds = _same(keys) & (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("size"))
        found.append(wanted.join(_other(spans.where("a = b"), keys, "below", "size", "a"), holds).select(*keys, "rank", F.col("a").alias("value")))
        open_ = spans.where("a <> b")
        levels.append(sent_if_small(_other(open_, keys, F.col("up").alias("_up"), F.col("bin").alias("_bin"), "below", "a", "b")))
        if not open_.where(f"size > {LAST_VALUES}").limit(1).count():
            break
        m = _met(x, levels, keys).withColumn("bin", _bin(len(levels) - 1))
        bins = m.groupBy(*keys, F.col("below").alias("up"), "bin").agg(F.count("x").alias("size"), F.min("x").alias("a"), F.max("x").alias("b"))
        before = F.sum("size").over(Window.partitionBy(*keys, "up").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")  # the bins of a span
        bins = bins.withColumn("below", F.col("up") + before)
        spans = stored(bins.join(_other(wanted, keys, "rank"), holds, "left_semi").select(*keys, "up", "bin", "below", "size", "a", "b"))
    few = _met(x, levels, keys).groupBy(*keys, "below").agg(F.sort_array(F.collect_list("x")).alias("v"))
    few = _other(few.withColumn("size", F.size("v")), keys, "below", "size", "v")
    last = wanted.join(few, holds).select(*keys, "rank", F.element_at("v", (F.col("rank") - F.col("below") + 1).cast("int")).alias("value"))
    return reduce(DataFrame.union, [*found, last])
