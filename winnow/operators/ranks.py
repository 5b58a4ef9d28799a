"""Places in a total order, and ranks within groups, however large a group is.

Rows are dealt into ranges of the order and sorted there; the numbers of rows
before each range are prefix sums of one count a range.  A group's rank is the
place less that of the group's first row.  So a single group is spread over all
tasks like any others, where a window would gather it in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.store import sent_if_small, stored

#: Rows of a range, about; and ranges at most.
RANGE_ROWS, MOST_RANGES = 1_000_000, 20_000
#: monotonically_increasing_id() has the partition above so many bits.
_ROW_BITS = 33


def placed(df: DataFrame, order: list[Column], name: str = "place", ranges: int | None = None) -> DataFrame:
    """The rows with their places from 1 by a total order. Runs jobs: the rows are sorted and stored once.

    ranges: how many to deal the rows into, by default one for RANGE_ROWS rows, and no fewer than there are cores.
    """
    if not ranges:
        cores = df.sparkSession.sparkContext.defaultParallelism
        ranges = max(cores, min(MOST_RANGES, -(-df.count() // RANGE_ROWS)))
    at = stored(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    before, base = 0, {}
    for r in sorted(at.groupBy(part.alias("part")).count().collect()):  # a row a range
        base[r.part] = before
        before += r["count"]
    if not base:
        return at.withColumn(name, F.lit(None).cast("long")).drop("_at")
    bases = F.broadcast(df.sparkSession.createDataFrame(list(base.items()), "_part long, _base long"))
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return at.join(bases, part == F.col("_part")).withColumn(name, F.col("_base") + row + 1).drop("_at", "_part", "_base")


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str = "rank", ranges: int | None = None) -> DataFrame:
    """The rows with their ranks from 1 within groups (a null is a group like others) by an order that is total there."""
    keys = [F.col(f"`{g}`") for g in group]
    at = placed(df, [*[k.asc_nulls_first() for k in keys], *order], "_place", ranges)
    if not group:
        return at.withColumnRenamed("_place", name)
    first = sent_if_small(stored(at.groupBy(*[k.alias(f"_g{i}") for i, k in enumerate(keys)]).agg((F.min("_place") - 1).alias("_first"))))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & k.eqNullSafe(F.col(f"_g{i}"))
    return at.join(first, on).withColumn(name, F.col("_place") - F.col("_first")).drop("_place", "_first", *[f"_g{i}" for i in range(len(keys))])
