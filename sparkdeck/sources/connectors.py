"""Topics, document stores and databases.

Each function only sets up Spark's own reader or writer. The format name is a parameter: `kafka`,
a document-store connector or `jdbc` where their jars are on the class path, or a file format whose
rows have the same schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TOPIC_SCHEMA = "key binary, value binary, topic string, timestamp timestamp"


def read_topic(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """Batch read of a topic with key and value as text."""
    reader = spark.read.format(fmt).options(**options)
    raw = reader.load() if fmt == "kafka" else reader.schema(TOPIC_SCHEMA).load(path)
    return raw.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


def stream_topic(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """Streaming read of a topic with key and value as text."""
    reader = spark.readStream.format(fmt).options(**options)
    raw = reader.load() if fmt == "kafka" else reader.schema(TOPIC_SCHEMA).load(path)
    return raw.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


def to_messages(df: DataFrame, key: str, topic: str, ts: str | None = None) -> DataFrame:
    """Rows as key/value messages; the value is the row as JSON."""
    stamp = F.col(ts).cast("timestamp") if ts else F.current_timestamp()
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*df.columns)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        stamp.alias("timestamp"),
    )


def write_topic(messages: DataFrame, fmt: str = "kafka", path: str | None = None, **options) -> None:
    writer = messages.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save(path)


def read_docs(spark: SparkSession, fmt: str, schema=None, path: str | None = None, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def write_docs(df: DataFrame, fmt: str, mode: str = "append", path: str | None = None, **options) -> None:
    writer = df.write.format(fmt).mode(mode).options(**options)
    writer.save(path) if path else writer.save()


def to_documents(df: DataFrame, out: str = "doc") -> DataFrame:
    """One JSON document per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))


def read_database(
    spark, url, query=None, table=None, partition=None, lower=None, upper=None, parts=None, **options
) -> DataFrame:
    """Database query or table. A table read is cut by `partition` between the bounds, so that many
    tasks read it; a query runs inside the database and arrives through one task."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if query is not None:
        return reader.option("query", query).load()
    reader = reader.option("dbtable", table)
    if partition:
        reader = (
            reader.option("partitionColumn", partition)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", parts)
        )
    return reader.load()
