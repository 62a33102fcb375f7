"""Unbounded inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources.connectors import stream_topic

__all__ = ["stream_files", "stream_topic", "event_time"]


def stream_files(spark: SparkSession, path: str, schema: StructType, fmt="parquet", files_per_batch: int = 1000) -> DataFrame:
    """Files that arrive under a folder or glob; a backlog is taken in batches of `files_per_batch` files."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a timestamp with zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))
