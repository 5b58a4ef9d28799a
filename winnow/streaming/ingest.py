"""Incremental ingestion of metric files: what is new since the last call is read once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def ingest_available(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of all new CSV files to a Parquet table and stop."""
    df = spark.readStream.schema(schema).option("header", True).csv(folder)
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
