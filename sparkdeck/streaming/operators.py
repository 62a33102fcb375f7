"""Operators that read the same on tables and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.records import EVENT_SCHEMA, parse_access_log
from ..functions.text import tokens


def windowed_count(df: DataFrame, ts: str, width: str, slide: str | None = None, keys=(), watermark: str | None = None):
    """Rows per event-time window and key: (start, end, *keys, n)."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    counted = df.groupBy(window.alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *keys, "n")


def words(df: DataFrame, ts: str, text: Column) -> DataFrame:
    return df.select(ts, F.explode(tokens(text)).alias("word"))


def of_site(df: DataFrame, value: str, site: str) -> DataFrame:
    """Events of one site, by equality on the parsed field."""
    return df.filter(F.from_json(F.col(value), EVENT_SCHEMA)["idsite"] == site)


def field_per_event(df: DataFrame, value: str, path: str, out: str) -> DataFrame:
    return df.withColumn(out, F.get_json_object(F.col(value), path)).filter(F.col(out).isNotNull())


def parsed_access_log(df: DataFrame, line: str) -> DataFrame:
    """Log fields and event day of the lines that match."""
    rows = df.withColumn("_f", parse_access_log(F.col(line))).filter(F.col("_f").isNotNull())
    return rows.select("event_id", "_f.*").withColumn("day", F.to_date("timestamp"))


def responses_per_minute(df: DataFrame, ts: str, lo: Column, hi: Column, watermark: str | None = None) -> DataFrame:
    """Rows per minute and response inside a time range; only minutes that have rows appear."""
    return windowed_count(df.filter(F.col(ts).between(lo, hi)), ts, "1 minute", keys=["response"], watermark=watermark)
