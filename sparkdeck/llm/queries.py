"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import align, bpe, chat, exact, language, licences, lines, mixing, near, pieces, ranked, vectors, warc
from .common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def tokenizer_path() -> str:
    """Where the tokenizer file of the queries lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def model_path() -> str:
    """Where the SentencePiece model of the queries lies."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(check: str | None = None):
    """Register `fn(spark, sf_dir)` under its own name."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if check:
            CHECKS[fn.__name__] = check
        return run

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_mixing(spark, sf_dir):
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")


@query(
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS body, chr(13) || chr(10) AS nl,
               regexp_replace(replace(replace(url, chr(13), '%0D'), chr(10), '%0A'), '[\\x00-\\x1F\\x7F]', '%00', 'g') AS url FROM pages),
    d AS (SELECT *, strlen(body) AS n, sha256(body) AS digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY digest, n) AS first FROM d),
    k AS (SELECT *, n >= 100 AND page_id <> first AS again FROM f),
    r AS (
        SELECT *, 'WARC/1.1' || nl || 'WARC-Type: ' || CASE WHEN again THEN 'revisit' ELSE 'response' END || nl
                  || 'WARC-Record-ID: <urn:record:' || page_id || '>' || nl || 'WARC-Date: 1970-01-01T00:00:00Z' || nl
                  || coalesce('WARC-Target-URI: ' || url || nl, '') || 'WARC-Payload-Digest: sha256:' || digest || nl
                  || CASE WHEN again THEN 'WARC-Refers-To: <urn:record:' || first || '>' || nl
                          || 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || nl
                          ELSE 'Content-Type: text/html; charset=utf-8' || nl END
                  || 'Content-Length: ' || CASE WHEN again THEN 0 ELSE n END || nl || nl
                  || CASE WHEN again THEN '' ELSE body END || nl || nl AS record
        FROM k)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to,
           CAST(strlen(record) AS BIGINT) AS record_bytes, sha256(record) AS record_sha256
    FROM r"""
)
def op2_warc(spark, sf_dir):
    path = fresh_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    found = warc.read_archive(spark, path)
    return found.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"),
        F.octet_length("record").cast("long").alias("record_bytes"), F.sha2("record", 256).alias("record_sha256"),
    )


@query(chat.CHECK_SQL)
def op3_chat(spark, sf_dir):
    return chat.collapse(table(spark, sf_dir, "conversations"))


@query()
def op4_bpe(spark, sf_dir):
    tokenizer = bpe.read_file(tokenizer_path())
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", bpe.round_trip(F.col("text"), tokenizer).alias("found"))
    found = found.select("doc_id", "found.ids", F.col("found.text").alias("decoded"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(licences.check_sql())
def op5_licences(spark, sf_dir):
    found = licences.scanned(table(spark, sf_dir, "documents"))
    marked = F.transform("sentences", lambda s: F.concat(F.lit("<"), s, F.lit(">")))
    return found.select(
        "doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join(marked, "").alias("sentences"),
        F.array_join("licences", ",").alias("licences"), F.array_join("rest", ",").alias("rest"),
    )


@query()
def op6_embeddings(spark, sf_dir):
    found = vectors.linked(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


@query(
    """
    WITH l AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
        FROM documents),
    k AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM l),
    r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    j AS (SELECT k.*, coalesce(r.last <> k.doc_id, false) AS gone FROM k LEFT JOIN r ON k.key = r.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM j GROUP BY doc_id"""
)
def op7_lines(spark, sf_dir):
    found = lines.drop_repeated(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op8_near(spark, sf_dir):
    found = near.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "kept")


@query(
    r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain
        FROM documents),
    g AS (SELECT plain, count(*) AS size, arg_max(doc_id, (n, -doc_id)) AS keep_id FROM d GROUP BY plain)
    SELECT doc_id, keep_id, size AS group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
    FROM d JOIN g USING (plain)"""
)
def op9_exact(spark, sf_dir):
    found = exact.duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query()
def op10_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH t AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents),
    p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
    d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY doc_id),
    a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
    f AS (
        SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * max(docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
        FROM p, a GROUP BY term),
    q AS (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    i AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY item_id, term),
    s AS (
        SELECT item_id, doc_id,
               CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words)))) AS BIGINT) AS score
        FROM i JOIN p USING (term) JOIN f USING (term) JOIN d USING (doc_id), a GROUP BY item_id, doc_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM r WHERE place <= 20"""
)
def op11_ranked_search(spark, sf_dir):
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_pieces(spark, sf_dir):
    model = pieces.read_file(model_path())
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pieces.round_trip(F.col("text"), model).alias("found"))
    return found.select(
        "doc_id",
        F.size("found.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("found.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("found.text", 256).alias("decoded_sha256"),
    )


@query()
def op13_alignment(spark, sf_dir):
    found = align.align(table(spark, sf_dir, "documents"), bpe.read_file(tokenizer_path()), pieces.read_file(model_path()))
    return found.withColumnRenamed("id", "doc_id")
