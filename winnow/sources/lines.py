"""Row numbers of files that don't depend on how the files are split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.store import sent_if_small


def numbered(read: DataFrame, name: str = "row") -> DataFrame:
    """The rows of a frame just read from files (text, CSV) with their numbers from 0, in the order of the files' paths and of the rows
    in each.

    Rows keep their order within a split, and a split knows the byte at which it starts: its first row's number is the sum of the
    rows of the splits before it, one count each.  The same under any number of splits; blank rows that the reader skips don't count.
    """
    at = read.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
    # not stored: counted under the same split sizes as the rows themselves, whenever these are read
    splits = at.groupBy(F.col("_file").alias("_f"), F.col("_start").alias("_s")).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_least"))
    before = Window.orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    splits = sent_if_small(splits.select("_f", "_s", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("_least")).alias("_add")), 1_000_000)
    out = at.join(splits, (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s")))
    return out.withColumn(name, F.col("_at") + F.col("_add")).drop("_file", "_start", "_at", "_f", "_s", "_add")


def labels_by_position(features: DataFrame, labels: DataFrame, label: str, row: str = "row") -> DataFrame:
    """The features with the label in the same row of another file; both numbered(), and as long as each other."""
    n, m = features.count(), labels.count()
    if n != m:
        raise ValueError(f"{m} labels for {n} rows")
    return features.join(labels.select(row, F.col(f"`{label}`").alias("label")), row, "left")
