"""Bounded stream runs and the tables they leave behind."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import upsert
from .versions import Versions


def run_available(writer, checkpoint: str, timeout: int | None = None) -> None:
    """Process what has arrived, then stop. A restart with the same checkpoint continues behind it."""
    query: StreamingQuery = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination(timeout) if timeout else query.awaitTermination()
    finally:
        query.stop()


def append_table(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Append result rows to a parquet table, exactly once per checkpoint."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    run_available(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint)


def append_batches(stream: DataFrame, path: str, checkpoint: str) -> None:
    """One folder per non-empty batch; a replayed batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run_available(stream.writeStream.outputMode("append").foreachBatch(write), checkpoint)


def _logged(table: Versions, rows: DataFrame, batch_id: int, shorten, compact_every: int, keep: int) -> None:
    """Add a batch to a table of versions; when more than `compact_every` folders are named, `shorten` makes them one."""
    held = [*table.before(batch_id), table.write(rows, "batch", batch_id)]
    if len(held) > compact_every:
        held = [table.write(shorten(held), "base", batch_id)]
    table.publish(batch_id, held)
    table.clean(keep)


def _newest_batch(spark: SparkSession, folders: list[tuple[str, int]], keys: list[str]) -> DataFrame:
    """Row of the newest batch per key."""
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(f).withColumn("_batch", F.lit(n)) for f, n in folders])
    rest = [c for c in rows.columns if c not in keys and c != "_batch"]
    newest_row = F.max_by(F.struct(*rest), F.col("_batch")).alias("_row")
    return rows.groupBy(*keys).agg(newest_row).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def update_table(stream: DataFrame, path: str, checkpoint: str, keys: list[str], compact_every: int = 100, keep: int = 2) -> None:
    """Changed aggregate rows of each batch as a folder of a table of versions; read with `current`.

    Once more than `compact_every` folders are named, the newest row per key is written as their successor, so the log stays that
    short. The newest `keep` versions can be read while the stream goes on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _logged(Versions(spark, path), batch, batch_id, lambda held: _newest_batch(spark, held, keys), compact_every, keep)

    run_available(stream.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def current(spark: SparkSession, path: str, keys: list[str], version: int | None = None) -> DataFrame:
    """Newest row per key of a table written by `update_table`, as of its newest version or of an older one that is kept."""
    return _newest_batch(spark, Versions(spark, path).folders(version), keys)


def upsert_table(stream: DataFrame, path: str, checkpoint: str, key: list[str], version: str, compact_every: int = 100, keep: int = 2) -> None:
    """Log of upserts as a table of versions: each batch adds a folder with its newest row per key.

    A batch only writes what it received, however large the table has grown. Once more than `compact_every` folders are named, they are
    replaced by one with the newest row per key. A replayed batch replaces its own version. Read with `merged`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            spark = batch.sparkSession

            def shorten(held: list[tuple[str, int]]) -> DataFrame:
                return newest(spark.read.parquet(*[f for f, _ in held]), key, version)

            _logged(Versions(spark, path), newest(batch, key, version), batch_id, shorten, compact_every, keep)

    run_available(stream.writeStream.outputMode("append").foreachBatch(write), checkpoint)


def newest(rows: DataFrame, key: list[str], version: str) -> DataFrame:
    return upsert(rows.limit(0), rows, key, version)


def merged(spark: SparkSession, path: str, key: list[str], version: str, number: int | None = None) -> DataFrame:
    """State of a table written by `upsert_table`, as of its newest version or of version `number` if that is kept."""
    return newest(spark.read.parquet(*[f for f, _ in Versions(spark, path).folders(number)]), key, version)
