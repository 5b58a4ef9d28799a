"""Merging per-tool metric tables into one wide relation keyed by ID."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.values import with_id, without_missing

log = logging.getLogger(__name__)


def first_wins(frames: list[DataFrame], keep_blank: bool = False, max_columns: int | None = None) -> DataFrame:
    """The union of IDs and columns; each cell from the first frame that has a value.

    One shuffle whatever the number of frames: all are stacked with their
    position and grouped by ID.  Within a frame the first row of an ID counts (rows
    are ordered by their values, as a relation has no order).  All columns are taken; only where
    max_columns is given are wider frames left out, with a warning.  keep_blank: the first frame that has the ID and
    the column wins even if its cell is missing.
    """
    parts = []
    for pos, df in enumerate(frames):
        d = without_missing(with_id(df))
        if max_columns is not None and len(d.columns) - 1 > max_columns:
            log.warning("frame %d has %d columns, more than %d: not merged", pos, len(d.columns) - 1, max_columns)
            continue
        d = d.filter(F.col("ID").isNotNull())
        parts.append(d.select("ID", F.lit(pos).alias("_pos"), *[F.struct(F.lit(pos).alias("pos"), F.col(f"`{c}`").cast("string").alias("v")).alias(c) if keep_blank else F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(pos).alias("pos"), F.col(f"`{c}`").alias("v"))).alias(c) for c in d.columns if c != "ID"]))
    if not parts:
        raise ValueError("nothing to merge")
    names = list(dict.fromkeys(c for p in parts for c in p.columns if c not in ("ID", "_pos")))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy("ID").agg(*[F.min_by(F.col(f"`{c}`.v"), F.col(f"`{c}`.pos")).alias(c) for c in names])


def outer_chain(frames: list[DataFrame], key: str = "ID") -> DataFrame:
    """Full outer joins on the key; a non-key column in two frames gets the suffix of its position."""
    out, seen = None, {key}
    for i, df in enumerate(frames):
        d = df.select(key, *[F.col(f"`{c}`").alias(c if c not in seen else f"{c}_{i}") for c in df.columns if c != key])
        seen |= set(d.columns)
        out = d if out is None else out.join(d, key, "full_outer")
    if out is None:
        raise ValueError("nothing to join")
    return out


def with_self(df: DataFrame, key: str = "ID") -> DataFrame:
    """All columns of a self-comparison under names of their own."""
    return df.select(key, *[F.col(f"`{c}`").alias(f"{c}_self") for c in df.columns if c != key])


def reindex(ids: DataFrame, df: DataFrame, key: str = "ID", fill: dict | None = None) -> DataFrame:
    """Every id keeps a row; what is missing is filled."""
    out = ids.select(key).join(df, key, "left")
    return out.fillna(fill) if fill else out


def first_row(df: DataFrame, key: str, order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once: none, for a valid key."""
    return df.groupBy(key).count().filter(F.col("count") > 1)


def labels_join(ids: DataFrame, labels: DataFrame, key: str = "ID", default: int = -1) -> DataFrame:
    """Every id with its least label, or the default."""
    la = labels.groupBy(key).agg(F.min("label").alias("label"))
    return ids.select(key).join(la, key, "left").select(key, F.coalesce("label", F.lit(default)).alias("label"))
