"""Content-addressed archive of web records.

An archive is two tables under one path. `payloads` holds the bytes of each distinct payload once, under
its SHA-256; a second hash guards the digest on writing. `records` holds one row per record: the
exact bytes of its WARC header block, its kind and the digest of its payload. Reading joins the two and
gives back whole records. Digests are computed anew from the stored bytes on reading and compared.

Records with equal payloads of at least `least_bytes` bytes: the one with the smallest id is a response,
the others are revisits that refer to it. Shorter payloads are always responses.

Nulls and odd cases: a null payload is empty; a null url leaves the header line out; control characters in
a url are percent-encoded, so that a url cannot add header lines; rows that share the smallest id are all
responses; rows without id revisit the smallest id there is, and are responses if there is none. Empty
tables give empty archives. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
# fixed values of the format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _safe(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x1F\\x7F]", "%00")


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 100, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write the payloads and the record headers of `pages` under `path`.

    The payloads move once (an aggregate that keeps one payload per digest, combined in the map tasks); the
    record table carries digests only, so a payload shared by a third of all rows costs narrow rows.
    """
    body = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("payload")
    ).withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    check = F.xxhash64("payload")
    payloads = rows.groupBy("digest", "n_bytes").agg(
        F.min("payload").alias("payload"), F.min("id").alias("response_id"), F.min(check).alias("low"), F.max(check).alias("high")
    )
    # equal digest and length but another second hash would be a broken digest: fail instead of mixing payloads
    payloads = payloads.select(
        "digest",
        F.when(F.col("low") == F.col("high"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("different payloads under digest "), F.col("digest"))))
        .alias("payload"),
        "response_id",
    )
    payloads.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/payloads")
    spark = pages.sparkSession
    first = spark.read.parquet(f"{path}/payloads").select("digest", "response_id")
    named = rows.select("id", "url", "digest", "n_bytes").join(first, "digest")
    revisit = (
        (F.col("n_bytes") >= least_bytes)
        & F.col("response_id").isNotNull()
        & ~F.col("id").eqNullSafe(F.col("response_id"))
    )
    key = lambda c: F.concat(F.lit("<urn:record:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", key("id")),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", _safe(F.col("url"))), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", key("response_id")), _line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        F.when(revisit, "").otherwise(_line("Content-Type", F.lit("text/html; charset=utf-8"))),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.lit(CRLF),
    )
    records = named.select(
        "id", F.encode(header, "UTF-8").alias("header"), "digest", F.when(revisit, "revisit").otherwise("response").alias("kind")
    )
    records.write.mode("overwrite").parquet(f"{path}/records")


def _field(name: str) -> Column:
    """The value of a header line, null if the header has no such line."""
    found = F.regexp_extract(F.decode("header", "UTF-8"), f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, rebuilt from headers and payloads.

    id, record_type, refers_to (text of the id), payload_bytes, payload_digest (of the stored bytes), payload
    (full, for revisits too), record (the exact bytes of the WARC record: a revisit has no block).
    A stored payload that does not have the digest it is filed under raises an error.
    """
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "payload").withColumn("actual", F.sha2("payload", 256))
    payloads = payloads.select(
        "digest",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("actual") == F.col("digest"), F.col("actual"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))))
        .alias("payload_digest"),
    )
    records = spark.read.parquet(f"{path}/records").withColumns(
        {
            "record_type": _field("WARC-Type"),
            "refers_to": F.regexp_extract(_field("WARC-Refers-To"), "^<urn:record:(.*)>$", 1),
            "claimed": F.regexp_extract(_field("WARC-Payload-Digest"), "^sha256:(.*)$", 1),
        }
    )
    joined = records.join(payloads.withColumnRenamed("digest", "claimed"), "claimed")
    end = F.encode(F.lit(CRLF + CRLF), "UTF-8")
    block = F.when(F.col("record_type") == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    return joined.select(
        "id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload",
        F.concat("header", block, end).alias("record"),
    )
