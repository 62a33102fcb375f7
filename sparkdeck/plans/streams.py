"""Stream queries: each runs to the end of the given table and must equal its batch check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.records import route_events
from ..session import fresh_path
from ..sources.connectors import stream_topic, to_messages, write_topic
from ..streaming import operators as ops, sinks
from ..streaming.sources import event_time, stream_files
from .registry import query
from .text import log_lines
from .views import VIEWS


def event_stream(t):
    stream = stream_files(t.spark, f"{t.sf_dir}/events*.parquet", t.events.schema)
    return event_time(stream, "ts")


def view_stream(t, name, stream=None):
    """A view text over the stream instead of the table."""
    (stream or event_stream(t)).createOrReplaceTempView("events")
    return t.spark.sql(VIEWS[name])


def folders(t, name):
    path = fresh_path(t.spark, name)
    return path, f"{path}-checkpoint"


#: stretches of time in which the events of a counted stream arrive
ARRIVALS = 3


def counted(t, aggregate, keys):
    """Final rows of an aggregate in update mode, with window starts in seconds.

    Events arrive in stretches of time, the stream is stopped and restarted after each, and the update log is
    compacted on the way.
    """
    arrived, (path, checkpoint) = fresh_path(t.spark, "arrived"), folders(t, "counts")
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    low, high = t.events.agg(F.min(at), F.max(at)).first()
    stretch = F.least(F.floor((at - low) * ARRIVALS / F.lit(max(high - low, 1))), F.lit(ARRIVALS - 1))
    for k in range(ARRIVALS):
        t.events.filter(F.coalesce(stretch, F.lit(0)) == k).write.mode("append").parquet(arrived)
        stream = event_time(stream_files(t.spark, arrived, t.events.schema), "ts")
        sinks.update_table(aggregate(stream), path, checkpoint, ["start", "end", *keys], compact_every=2)
    out = sinks.current(t.spark, path, ["start", "end", *keys])
    return out.select(F.unix_timestamp("start").alias("start"), F.unix_timestamp("end").alias("end"), *keys, "n")


def _tumbling(seconds, keys="", source="events", n="count(*)"):
    k = f", {keys}" if keys else ""
    start = f"CAST(floor(epoch(ts) / {seconds}) * {seconds} AS BIGINT)"
    return f"SELECT {start} AS start, {start} + {seconds} AS \"end\"{k}, {n} AS n FROM {source} GROUP BY ALL"


@query("i01_topic_stream", "SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type FROM events")
def topic_stream(t):
    topic, (path, checkpoint) = fresh_path(t.spark, "topic"), folders(t, "subscribed")
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    write_topic(to_messages(rows, "user_id", "events", "ts"), "parquet", topic)
    stream = stream_topic(t.spark, "parquet", topic)
    body = F.from_json("value", "event_id bigint, event_type string")
    sinks.append_table(stream.select("key", body.alias("m")).select("key", "m.*"), path, checkpoint)
    return t.spark.read.parquet(path)


@query("i02_count_per_interval", _tumbling(10))
def count_per_interval(t):
    return counted(t, lambda events: ops.windowed_count(events, "ts", "10 seconds", watermark="1 hour"), [])


@query(
    "i03_batch_word_count",
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(event_type || ' ' || props, ' ')) AS word FROM events)
       GROUP BY word""",
)
def batch_word_count(t):
    path, checkpoint = folders(t, "words")
    stream = ops.words(event_stream(t), "ts", F.concat_ws(" ", "event_type", "props"))

    def count(batch, batch_id):
        batch.groupBy("word").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    sinks.run_available(stream.writeStream.foreachBatch(count), checkpoint)
    return t.spark.read.parquet(path).groupBy("word").agg(F.sum("n").alias("n"))


_WORDS = "(SELECT ts, unnest(string_split(event_type || ' ' || props, ' ')) AS word FROM events)"


@query("i04_windowed_word_count", _tumbling(3600, "word", _WORDS))
def windowed_word_count(t):
    def count(events):
        words = ops.words(events, "ts", F.concat_ws(" ", "event_type", "props"))
        return ops.windowed_count(words, "ts", "1 hour", keys=["word"], watermark="1 hour")

    return counted(t, count, ["word"])


@query(
    "i05_sliding_word_count",
    """SELECT start, start + 10800 AS "end", event_type, count(*) AS n FROM (SELECT event_type,
         unnest(range(CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) - 7200, CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) + 1,
                      3600)) AS start FROM events) GROUP BY ALL""",
)
def sliding_word_count(t):
    return counted(t, lambda events: ops.windowed_count(events, "ts", "3 hours", "1 hour", ["event_type"], "1 hour"), ["event_type"])


@query("i06_events_of_site", "SELECT event_id FROM v_json WHERE json_extract_string(value, '$.idsite') = '1'")
def events_of_site(t):
    path, checkpoint = folders(t, "site")
    sinks.append_table(ops.of_site(view_stream(t, "v_json"), "value", "1").select("event_id"), path, checkpoint)
    return t.spark.read.parquet(path)


@query(
    "i07_event_routing",
    """SELECT kind, idsite, count(*) AS n, count(item) AS items FROM (SELECT
         CASE WHEN j ->> 'idgoal' <> '0' THEN 'page' WHEN j ->> 'ec_id' IS NULL THEN 'cart' ELSE 'purchase' END AS kind,
         j ->> 'idsite' AS idsite, CASE WHEN j ->> 'ec_items' IS NOT NULL THEN json_extract_string(j ->> 'ec_items', '$[0][0]') END AS item
         FROM (SELECT CAST(value AS JSON) AS j FROM v_json)) GROUP BY 1, 2""",
)
def event_routing(t):
    path, checkpoint = folders(t, "routed")
    routed = route_events(view_stream(t, "v_json"))
    rows = routed.select("event_id", "kind", "idsite", F.col("items")[0][0].alias("item"))
    sinks.append_table(rows, path, checkpoint, ["kind"])
    out = t.spark.read.parquet(path)
    return out.groupBy("kind", "idsite").agg(F.count(F.lit(1)).alias("n"), F.count("item").alias("items"))


@query("i08_user_per_action", "SELECT event_id, 'u' || user_id AS user FROM events")
def user_per_action(t):
    path, checkpoint = folders(t, "users")
    stream = ops.field_per_event(view_stream(t, "v_json"), "value", "$._id", "user")
    sinks.append_table(stream.select("event_id", "user"), path, checkpoint)
    return t.spark.read.parquet(path)


@query("i10_append_batches", "SELECT event_id, event_type, value FROM events WHERE value > 20")
def append_batches(t):
    path, checkpoint = folders(t, "batches")
    sinks.append_batches(event_stream(t).filter("value > 20").select("event_id", "event_type", "value"), path, checkpoint)
    return t.spark.read.parquet(path).drop("batch_id")


@query("i11_restart_without_duplicates", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def restart_without_duplicates(t):
    path, checkpoint = folders(t, "restart")
    for _ in range(2):
        sinks.append_table(event_stream(t).select("event_id"), path, checkpoint)
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("i12_bounded_run", "SELECT count(*) AS n FROM events")
def bounded_run(t):
    path, checkpoint = folders(t, "bounded")
    writer = event_stream(t).select("event_id").writeStream.format("parquet").option("path", path)
    sinks.run_available(writer, checkpoint, timeout=600)
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@query(
    "i13_log_stream",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, response, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes
       FROM v_log_fields GROUP BY 1, 2""",
)
def log_stream(t):
    path, checkpoint = folders(t, "logs")
    parsed = ops.parsed_access_log(log_lines(view_stream(t, "v_log_fields")), "line")
    sinks.append_table(parsed, path, checkpoint, ["day"])
    out = t.spark.read.parquet(path).groupBy("day", "response")
    per = out.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    return per.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("i14_refreshed_upsert", "SELECT id, max(version) AS version, arg_max(label, version) AS label FROM v_upsert GROUP BY id")
def refreshed_upsert(t):
    path, checkpoint = folders(t, "refreshed")
    stream = stream_files(t.spark, f"{t.sf_dir}/conversations*.parquet", t.conversations.schema)
    rows = stream.select(F.col("conv_id").alias("id"), F.col("turn").alias("version"), F.col("role").alias("label"))
    for _ in range(2):  # the second refresh finds nothing new and changes nothing
        sinks.upsert_table(rows, path, checkpoint, ["id"], "version")
    return sinks.merged(t.spark, path, ["id"], "version")


@query("i14_refreshed_in_versions", "SELECT id, max(version) AS version, arg_max(label, version) AS label FROM v_upsert GROUP BY id")
def refreshed_in_versions(t):
    """Rows arrive in four stretches of conversations; the log is shortened on the way."""
    arrived, (path, checkpoint) = fresh_path(t.spark, "arrived"), folders(t, "versions")
    for k in range(4):
        t.v_upsert.filter(F.pmod("id", F.lit(4)) == k).write.mode("append").parquet(arrived)
        sinks.upsert_table(stream_files(t.spark, arrived, t.v_upsert.schema), path, checkpoint, ["id"], "version", compact_every=2)
    return sinks.merged(t.spark, path, ["id"], "version")


_RANGE = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")


@query(
    "i15_responses_per_minute",
    f"""SELECT CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS start, CAST(epoch(date_trunc('minute', ts)) AS BIGINT) + 60 AS "end",
              response, count(*) AS n FROM v_log_fields WHERE ts BETWEEN '{_RANGE[0]}' AND '{_RANGE[1]}' GROUP BY ALL""",
)
def responses_per_minute(t):
    lo, hi = (F.lit(v).cast("timestamp") for v in _RANGE)
    def count(events):
        return ops.responses_per_minute(view_stream(t, "v_log_fields", events), "ts", lo, hi, "1 hour")

    return counted(t, count, ["response"])


@query(
    "i15_responses_per_minute_table",
    f"""SELECT CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS start, response, count(*) AS n FROM v_log_fields
       WHERE ts BETWEEN '{_RANGE[0]}' AND '{_RANGE[1]}' GROUP BY ALL""",
)
def responses_per_minute_table(t):
    lo, hi = (F.lit(v).cast("timestamp") for v in _RANGE)
    out = ops.responses_per_minute(event_time(t.v_log_fields, "ts"), "ts", lo, hi)
    return out.select(F.unix_timestamp("start").alias("start"), "response", "n")


@query(
    "i16_closed_windows",
    """SELECT start, "end", event_type, n FROM (SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS start,
         CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) + 3600 AS "end", event_type, count(*) AS n FROM events GROUP BY ALL)
       WHERE "end" <= (SELECT floor(epoch(max(ts)) * 1000) / 1000 FROM events) - 600""",
)
def closed_windows(t):
    path, checkpoint = folders(t, "closed")
    stream = ops.windowed_count(event_stream(t), "ts", "1 hour", keys=["event_type"], watermark="10 minutes")
    sinks.append_table(stream, path, checkpoint)
    out = t.spark.read.parquet(path)
    return out.select(F.unix_timestamp("start").alias("start"), F.unix_timestamp("end").alias("end"), "event_type", "n")
