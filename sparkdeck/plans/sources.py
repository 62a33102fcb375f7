"""Reading and writing: every query writes a given table to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import decimal_comma
from ..session import fresh_path
from ..sources import connectors, files
from .registry import query


@query(
    "a01_read_lines",
    """SELECT length(line) AS n_chars, count(*) AS n FROM (
         SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""",
)
def read_lines(t):
    path = fresh_path(t.spark, "lines")
    t.documents.select("text").write.text(path)
    lines = files.read_lines(t.spark, path)
    return lines.groupBy(F.length("value").cast("bigint").alias("n_chars")).agg(F.count(F.lit(1)).alias("n"))


@query("a04_csv_with_header", "SELECT * FROM part")
def csv_with_header(t):
    path = fresh_path(t.spark, "csv")
    t.part.write.option("header", True).csv(path)
    return files.read_delimited(t.spark, path, t.part.schema)


@query("a05_csv_without_header", "SELECT c_custkey AS id, c_mktsegment AS segment, c_acctbal AS balance FROM customer")
def csv_without_header(t):
    path = fresh_path(t.spark, "csv")
    t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").write.csv(path)
    raw = files.read_delimited(t.spark, path, "a string, b string, c string", header=False)
    return files.cast_columns(raw, ["id", "segment", "balance"], ["bigint", "string", "double"])


@query("a06_csv_keep_fields", "SELECT p_partkey, p_name FROM part")
def csv_keep_fields(t):
    path = fresh_path(t.spark, "csv")
    t.part.write.option("header", True).csv(path)
    return files.read_delimited(t.spark, path, t.part.schema).select("p_partkey", "p_name")


@query("a07_other_delimiters", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def other_delimiters(t):
    path = fresh_path(t.spark, "delimited")
    c = t.customer
    comma = F.regexp_replace(c.c_acctbal.cast("string"), r"\.", ",")
    c.select(F.concat_ws("::", c.c_custkey.cast("string"), c.c_name, comma)).write.text(path)
    raw = files.read_delimited(t.spark, path, "id bigint, name string, balance string", sep="::", header=False)
    return raw.withColumn("balance", decimal_comma(F.col("balance")))


@query("a08_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def json_lines(t):
    path = fresh_path(t.spark, "json")
    t.conversations.write.json(path)
    return files.read_json(t.spark, path, t.conversations.schema).select("conv_id", "turn", "role", "text")


@query("a09_multi_line_json", "SELECT p_partkey, p_name, p_size FROM part")
def multi_line_json(t):
    path = fresh_path(t.spark, "documents")
    # one document per file, each an array of at most a thousand parts written over many lines
    entry = F.struct("p_partkey", "p_name", "p_size")
    chunks = t.part.groupBy(F.floor(F.col("p_partkey") / 1000)).agg(F.collect_list(entry).alias("rows"))
    lines = chunks.select(F.to_json("rows", {"pretty": "true"}))
    lines.write.option("maxRecordsPerFile", 1).text(path)
    return files.read_json(t.spark, path, "p_partkey bigint, p_name string, p_size int", multi_line=True)


@query("a10_parquet_round_trip", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def parquet_round_trip(t):
    path = fresh_path(t.spark, "parquet")
    files.write_parquet(t.orders, path)
    return t.spark.read.schema(t.orders.schema).parquet(path).select("o_orderkey", "o_custkey", "o_totalprice")


@query("a11_topic_round_trip", "SELECT event_id, event_type, value, CAST(user_id AS VARCHAR) AS key FROM events")
def topic_round_trip(t):
    path = fresh_path(t.spark, "topic")
    columns = t.events.select("event_id", "user_id", "event_type", "value", "ts")
    connectors.write_topic(connectors.to_messages(columns, "user_id", "events", "ts"), "parquet", path)
    rows = connectors.read_topic(t.spark, "parquet", path)
    body = F.from_json("value", "event_id bigint, event_type string, value double")
    return rows.select("key", body.alias("m")).select("key", "m.*")


@query(
    "a12_topic_messages",
    """SELECT CAST(conv_id AS VARCHAR) AS key, json_object('conv_id', conv_id, 'turn', turn, 'role', role) AS value
       FROM conversations""",
)
def topic_messages(t):
    rows = t.conversations.select("conv_id", "turn", "role")
    messages = connectors.to_messages(rows, "conv_id", "talk")
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))


@query("a13_document_store_round_trip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def document_store_round_trip(t):
    path = fresh_path(t.spark, "docs")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    connectors.write_docs(rows, "json", "overwrite", path)
    return connectors.read_docs(t.spark, "json", rows.schema, path)


@query("a14_document_store_append", "SELECT o_orderpriority AS id, 2 * count(*) AS n FROM orders GROUP BY 1")
def document_store_append(t):
    path = fresh_path(t.spark, "docs")
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    connectors.write_docs(rows, "json", "overwrite", path)
    connectors.write_docs(rows, "json", "append", path)
    back = connectors.read_docs(t.spark, "json", rows.schema, path)
    return back.groupBy(F.col("o_orderpriority").alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a15_row_to_document",
    "SELECT json_object('s_suppkey', s_suppkey, 's_name', s_name, 's_nationkey', s_nationkey) AS doc FROM supplier",
)
def row_to_document(t):
    return connectors.to_documents(t.supplier.select("s_suppkey", "s_name", "s_nationkey"))


@query(
    "a16_source_side_predicate",
    """SELECT vid, pid, score FROM v_clicks
       WHERE vts_last > TIMESTAMP '2024-01-15 00:00:00' AND pid IN ('3', '14', '15', '92', '65')""",
)
def source_side_predicate(t):
    recent = F.col("vts_last") > F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    kept = t.v_clicks.filter(recent & files.in_list(F.col("pid"), ["3", "14", "15", "92", "65"]))
    return kept.orderBy(F.col("vts_last").desc()).select("vid", "pid", "score")


@query("a19_save_modes", "SELECT 2 * count(*) AS n, 2 * CAST(sum(p_size) AS BIGINT) AS size FROM part")
def save_modes(t):
    path = fresh_path(t.spark, "modes")
    rows = t.part.select("p_partkey", "p_size")
    for mode in ("overwrite", "overwrite", "append"):
        files.write_parquet(rows, path, mode)
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"))


@query("a20_append_one_file", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def append_one_file(t):
    path = fresh_path(t.spark, "single")
    files.append_one_file(t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), path)
    return t.spark.read.parquet(path)


@query("a21_rerun_replaces_partitions", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def rerun_replaces_partitions(t):
    path = fresh_path(t.spark, "rerun")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    files.write_parquet(rows, path, "overwrite", ["o_orderstatus"])
    # the second run covers one partition only; the others stay
    files.write_parquet(rows.filter("o_orderstatus = 'P'"), path, "overwrite", ["o_orderstatus"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("a22_sink_by_day", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def sink_by_day(t):
    path = fresh_path(t.spark, "days")
    files.write_by_day(t.events, path, "ts")
    per_day = t.spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return per_day.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("a23_upsert", "SELECT id, max(version) AS version, arg_max(label, version) AS label FROM v_upsert GROUP BY id")
def upsert(t):
    rows = t.v_upsert
    return files.upsert(rows.filter("version <= 3"), rows.filter("version >= 3"), ["id"], "version")


_PATHS = """
    SELECT concat('/img/S2_', CAST(o_orderkey % 40 AS STRING),
        CASE WHEN o_orderkey % 5 = 0 THEN '.ZIP/' ELSE '.SAFE/' END, 'T30_', CAST(o_orderkey AS STRING), '_B',
        CAST(o_orderkey % 11 AS STRING),
        CASE WHEN o_orderkey % 7 = 0 THEN '.jp2.xml' WHEN o_orderkey % 3 = 0 THEN '.tif' ELSE '.jp2' END) AS path
    FROM orders"""


@query(
    "a24_scene_catalog",
    f"""SELECT split_part(path, '/', 3) AS scene,
               regexp_extract(path, '_(B[0-9]+)\\.jp2$', 1) AS band, path
        FROM ({_PATHS}) WHERE path LIKE '%.SAFE/%' AND path LIKE '%.jp2'""",
)
def scene_catalog(t):
    return files.scene_catalog(t.sql(_PATHS))

