"""Tables that later steps start from, written to the shared folder so that the lineage ends there, and sides of a checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored(df: DataFrame) -> DataFrame:
    """A checkpoint in spark.checkpoint.dir; where a session on one machine has none, as in tests, a folder is set."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="winnow-"))
    return df.checkpoint()


def sent_if_small(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """Marked to be sent to all tasks if it has so few rows, which is counted; else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for files that a query writes and reads again."""
    stored_in = spark.conf.get("spark.checkpoint.dir", None)
    if not stored_in:
        stored(spark.range(1))  # sets a folder where a session on one machine has none
        stored_in = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{stored_in.rstrip('/')}/{name}-{uuid.uuid4().hex}"
